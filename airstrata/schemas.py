"""Column names and explicit schemas of the measurement layers."""

from pyspark.sql import types as T

# Column names of the published measurement files.
START = "Date de début"
END = "Date de fin"
ZONE_CODE = "code zas"
ZONE = "Zas"
SITE = "code site"
SITE_NAME = "nom site"
SETTING = "type d'implantation"
POLLUTANT = "Polluant"
INFLUENCE = "type d'influence"
VALUE = "valeur"
RAW_VALUE = "valeur brute"
UNIT = "unité de mesure"
VALIDITY = "validité"

MEASUREMENT_COLUMNS = [
    START, END, ZONE_CODE, ZONE, SITE, SITE_NAME, SETTING,
    POLLUTANT, INFLUENCE, VALUE, RAW_VALUE, UNIT, VALIDITY,
]
REQUIRED_COLUMNS = [START, END, VALUE, RAW_VALUE]

# Column names of the station list and of the derived layers.
STATION_CODE = "NatlStationCode"
STATION_NAME = "Name"
LATITUDE = "Latitude"
LONGITUDE = "Longitude"
GPS = "GPS"
POLLUTANT_COPY = "Polluant_copy"
DATE = "date"
DOC_ID = "doc_id"

STATION_COLUMNS = [STATION_CODE, STATION_NAME, LATITUDE, LONGITUDE]


def _fields(names, kind):
    return [T.StructField(name, kind, True) for name in names]


def measurement_schema(time_type: T.DataType = T.StringType()) -> T.StructType:
    """The 13 projected columns; times are text in the raw layer, typed later."""
    special = {
        START: time_type,
        END: time_type,
        VALUE: T.DoubleType(),
        RAW_VALUE: T.DoubleType(),
        VALIDITY: T.IntegerType(),
    }
    return T.StructType(
        [T.StructField(c, special.get(c, T.StringType()), True) for c in MEASUREMENT_COLUMNS]
    )


STATION_SCHEMA = T.StructType(
    _fields(["nuts3", "nuts2", STATION_CODE, STATION_NAME], T.StringType())
    + _fields([LATITUDE, LONGITUDE], T.DoubleType())
)

COMBINED_SCHEMA = T.StructType(
    measurement_schema(T.TimestampType()).fields + STATION_SCHEMA.fields
)

# A region's outline: the outer ring, then its holes.
_POINT = T.StructType(_fields(["x", "y"], T.DoubleType()))
SHAPE_SCHEMA = T.StructType(
    [
        T.StructField("region", T.LongType(), True),
        T.StructField("rings", T.ArrayType(T.ArrayType(_POINT)), True),
    ]
)
