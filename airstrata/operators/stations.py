"""The station table."""

from pyspark.sql import DataFrame

from ..functions.geo import lat_lon_text
from ..schemas import GPS, LATITUDE, LONGITUDE, STATION_COLUMNS
from .rows import project, quoted


def station_table(df: DataFrame) -> DataFrame:
    """Four columns of the station list and their coordinates as ``(lat, lon)`` text."""
    return project(df, STATION_COLUMNS).withColumn(
        GPS, lat_lon_text(quoted(LATITUDE), quoted(LONGITUDE))
    )
