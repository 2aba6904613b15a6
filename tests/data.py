"""Small literal frames."""

from contextlib import contextmanager

from airstrata.schemas import MEASUREMENT_COLUMNS, measurement_schema

GOOD = {
    "Date de début": "2025-03-01T19:00:00",
    "Date de fin": "2025-03-01T20:00:00",
    "code zas": "FR75ZAG01",
    "Zas": "ZAG BORDEAUX",
    "code site": "FR31007",
    "nom site": "BASSENS",
    "type d'implantation": "Urbaine",
    "Polluant": "NO2",
    "type d'influence": "Fond",
    "valeur": 11.2,
    "valeur brute": 11.15,
    "unité de mesure": "µg-m3",
    "validité": 1,
}
STATIONS = [
    ("FRJ", "FR", "FR31007", "BASSENS", 44.900295, -0.515835),
    ("FRJ", "FR", "FR31002", "GRAND PARC", 44.85, -0.58),
    ("FRJ", "FR", "FR_UNUSED", "NOWHERE", 45.0, 1.0),
    ("FRJ", "FR", "FR_NO_GPS", "UNKNOWN", None, 2.0),
]
STATION_FIELDS = (
    "nuts3 string, nuts2 string, NatlStationCode string, Name string, "
    "Latitude double, Longitude double"
)


def reading(**changes):
    """One raw row; keyword names use ``_`` for blanks (``code_site``)."""
    row = dict(GOOD)
    names = {c.replace(" ", "_").replace("'", "_"): c for c in MEASUREMENT_COLUMNS}
    for name, value in changes.items():
        row[names[name]] = value
    return tuple(row[c] for c in MEASUREMENT_COLUMNS)


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), measurement_schema())


def stations(spark, rows=STATIONS):
    return spark.createDataFrame(rows, STATION_FIELDS)


def times(hour):
    return {
        "Date_de_début": f"2025/03/01 {hour:02d}:00:00",
        "Date_de_fin": f"2025/03/01 {hour + 1:02d}:00:00",
    }


@contextmanager
def settings(spark, **values):
    """Session settings for a while; ``__`` in a name stands for a dot."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for key, value in names.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
