"""Times: parsing, ISO text and the tokens of a run date."""

from pyspark.sql import Column, functions as F

# Fixed value: shape of measurement times, 2025/03/01 19:00[:00[.000000]], with "-" or "/"
# in the date and a blank or "T" after it.
TIME_SHAPE = r"^\d{4}([-/])\d\d\1\d\d[ T]\d\d:\d\d(:\d\d(\.\d{1,6})?)?$"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def parse_time(column: Column, formats=()) -> Column:
    """Text to timestamp, NULL when unreadable.

    Text of the usual shape goes through the plain cast, which is several times
    faster than a format pattern and raises nothing on bad text. Other
    ``formats`` are tried in order on what remains.
    """
    usual = F.when(column.rlike(TIME_SHAPE), F.translate(column, "/", "-").try_cast("timestamp"))
    return F.coalesce(usual, *[F.try_to_timestamp(column, F.lit(f)) for f in formats])


def iso_text(column: Column) -> Column:
    """Timestamp to ``2025-03-01T19:00:00``."""
    return F.date_format(column, ISO_FORMAT)


def day_text(column: Column) -> Column:
    """Date or timestamp to ``2025-03-01``."""
    return F.date_format(column, "yyyy-MM-dd")


def day_compact(column: Column) -> Column:
    """Date or timestamp to ``20250301``, the layer folder of a day."""
    return F.date_format(column, "yyyyMMdd")


def year_text(column: Column) -> Column:
    """Date or timestamp to ``2025``, the yearly folder of the download."""
    return F.date_format(column, "yyyy")


def days_before(column: Column, days: int) -> Column:
    """The date ``days`` days earlier."""
    return F.date_sub(F.to_date(column), days)


def landed_name(column: Column) -> Column:
    """Name of a day's measurement file, ``FR_E2_2025-03-01.csv``."""
    return F.concat(F.lit("FR_E2_"), day_text(column), F.lit(".csv"))
