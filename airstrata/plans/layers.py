"""From landed measurements to index documents, one function per layer.

Every function but the ``land``/``store`` writers is a lazy DataFrame step, so a
caller may run the layers in one plan or keep each as files.
"""

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.geo import lon_lat
from ..functions.keys import document_key
from ..functions.times import iso_text, parse_time
from ..operators.joins import join_stations
from ..operators.latest import latest_per_key
from ..operators.profile import observed
from ..operators.rows import (
    complete, copy_column, is_present, project, quoted, split_rejects, stamp_date,
)
from ..operators.stations import station_table
from ..schemas import (
    DATE, DOC_ID, END, GPS, LATITUDE, LONGITUDE, POLLUTANT, POLLUTANT_COPY,
    REQUIRED_COLUMNS, SITE, START, STATION_CODE, VALIDITY, VALUE,
)
from ..sinks import documents, versions
from ..sinks.layers import write_layer
from ..sources.listing import Landing
from ..sources.tables import read_measurements, read_parquet, read_stations

# Length of the period in which readings of a site and pollutant share a document.
GRAINS = {"day": "yyyy-MM-dd", "hour": "yyyy-MM-dd'T'HH"}


def typed_times(df: DataFrame, formats=()) -> DataFrame:
    """Start and end from text to timestamps, by the usual shape or ``formats`` in order; other types stay."""
    text = [c for c in (START, END) if df.schema[c].dataType.typeName() == "string"]
    return df.withColumns({c: parse_time(quoted(c), formats) for c in text})


def entry_rules(df: DataFrame, only_valid: bool = False, formats=()) -> dict:
    """What a raw row must meet to enter the cleaned layer, by reject reason, in order."""
    rules = {f"no {c}": is_present(df, c) for c in REQUIRED_COLUMNS}
    for c in (START, END):
        if df.schema[c].dataType.typeName() == "string":
            rules[f"unreadable {c}"] = parse_time(quoted(c), formats).isNotNull()
    rules[f"no {POLLUTANT}"] = is_present(df, POLLUTANT)
    if only_valid:
        rules["not valid"] = (quoted(VALIDITY) > 0) | quoted(VALIDITY).isNull()
        rules["negative"] = quoted(VALUE) >= 0
    return rules


def clean(raw: DataFrame, only_valid: bool = False, formats=()) -> DataFrame:
    """Raw to L1: 13 columns, required values present, times readable."""
    good, _ = split_rejects(project(raw), entry_rules(raw, only_valid, formats))
    return copy_column(typed_times(good, formats))


def rejected(raw: DataFrame, only_valid: bool = False, formats=()) -> DataFrame:
    """The raw rows ``clean`` leaves out, with the reason."""
    return split_rejects(project(raw), entry_rules(raw, only_valid, formats))[1]


def store_cleaned(cleaned: DataFrame, path: str) -> None:
    """L1 files, a folder per pollutant."""
    write_layer(cleaned, path)


def store_cleaned_audited(raw: DataFrame, path: str, only_valid: bool = False, formats=()) -> dict[str, int]:
    """L1 files as by ``clean`` and ``store_cleaned``; gives the rows per reject reason, and those accepted.

    The write itself counts them: the raw rows are read once.
    """
    rules = entry_rules(raw, only_valid, formats)
    counted, counts = observed(raw, rules)
    good, _ = split_rejects(counted, rules)
    store_cleaned(copy_column(typed_times(project(good), formats)), path)
    return counts.get


def combine(cleaned: DataFrame, stations: DataFrame, run_date: date | str | None = None) -> DataFrame:
    """L1 and stations to L2: one join over the whole layer, and the date."""
    return stamp_date(join_stations(cleaned, stations), run_date)


def store_combined(combined: DataFrame, path: str) -> None:
    """L2 files, a folder per date and pollutant; other dates are left alone."""
    write_layer(combined, path, (DATE, POLLUTANT), (SITE,), touched_only=True)


def _keyed(combined: DataFrame, grain: str) -> DataFrame:
    """ISO times, ``[lon, lat]`` and the document key."""
    moment = quoted(DATE) if grain == "day" else F.date_format(quoted(START), GRAINS[grain])
    keyed = combined.withColumns(
        {
            DOC_ID: document_key(moment, quoted(SITE), quoted(POLLUTANT_COPY)),
            LATITUDE: quoted(LATITUDE).cast("double"),
            LONGITUDE: quoted(LONGITUDE).cast("double"),
            START: iso_text(quoted(START)),
            END: iso_text(quoted(END)),
        }
    )
    return keyed.withColumn(GPS, lon_lat(quoted(LONGITUDE), quoted(LATITUDE)))


def to_documents(combined: DataFrame, grain: str = "day") -> DataFrame:
    """L2 to documents; a row with any gap is dropped.

    With ``grain="day"`` the readings of a day, site and pollutant share a key;
    ``"hour"`` keeps the hourly series. Of readings that share a key and, to the
    second, their times, the latest is taken while the times are still whole.
    """
    whole = complete(combined)
    seconds = [F.date_trunc("second", quoted(c)).alias(f"_{c}") for c in (START, END)]
    named = whole.select("*", *seconds)
    by = [DATE, SITE, POLLUTANT_COPY, *[f"_{c}" for c in (START, END)]]
    newest = latest_per_key(named, by, list(documents.NEWEST)).drop(*[f"_{c}" for c in (START, END)])
    return complete(_keyed(newest, grain))


def latest_documents(
    cleaned: DataFrame, stations: DataFrame, run_date=None, grain: str = "day"
) -> DataFrame:
    """L1 and stations straight to the current document per key, in one plan.

    The latest reading per date, site and pollutant, and the one station row per
    code, are taken *before* the join: readings cross the network once, as one
    row per task and key, and a site with a third of all readings has shrunk to
    its keys before it is joined. The outcome is that of joining first, since
    whether a row survives is decided on each side alone.
    """
    period = F.date_format(quoted(START), GRAINS[grain])
    dated = stamp_date(complete(cleaned), run_date).withColumn("_period", period)
    by = [DATE, SITE, POLLUTANT] + (["_period"] if grain != "day" else [])
    newest = latest_per_key(dated, by, list(documents.NEWEST)).drop("_period")
    known = complete(stations)
    one_each = latest_per_key(
        known, [STATION_CODE], [c for c in known.columns if c != STATION_CODE]
    )
    return _keyed(join_stations(newest, one_each), grain)


def raw_to_documents(
    spark: SparkSession, raw_path: str, station_path: str, work: str, run_date=None, batch="run", formats=()
) -> DataFrame:
    """All layers as files below ``work``, ending in the current documents.

    Only the dates of this run are read from L2 and published; the cost follows
    the run, not the history. The dates, a few per run, come to the driver.
    """
    stations = station_table(read_stations(spark, station_path))
    fresh = clean(read_measurements(spark, raw_path), formats=formats)
    store_cleaned(fresh, f"{work}/L1")
    cleaned = read_parquet(spark, f"{work}/L1", schema=fresh.schema)
    combined = combine(cleaned, stations, run_date)
    store_combined(combined, f"{work}/L2")
    dates = [r[0] for r in stamp_date(cleaned, run_date).select(DATE).distinct().collect()]
    layer = read_parquet(spark, f"{work}/L2", schema=combined.schema)
    docs = to_documents(layer.where(quoted(DATE).isin(dates)))
    documents.upsert(docs, f"{work}/documents", batch)
    return documents.read_documents(spark, f"{work}/documents", schema=docs.schema)


def new_files_to_documents(
    spark: SparkSession, raw_path: str, station_path: str, work: str, run_date=None, formats=()
) -> int | None:
    """The files that landed or changed since the last run, straight into the store with versions.

    Gives the store's new version, None if there was nothing new. Files known from earlier runs are
    listed but not read. The listing is accepted after the documents are committed: a run that breaks off is made up
    for by the next one, whose batch has the same name and so replaces nothing twice. Files that are
    gone leave their documents in the store.
    """
    landing = Landing(spark, raw_path, f"{work}/listings", ".csv")
    paths = landing.fresh()
    version = None
    if paths:
        cleaned = clean(read_measurements(spark, paths), formats=formats)
        docs = latest_documents(cleaned, station_table(read_stations(spark, station_path)), run_date)
        version = versions.upsert(docs, f"{work}/documents", f"landing-{landing.number + 1}")
    landing.accept()
    return version
