"""Expressions over file paths."""

import re

from pyspark.sql import Column, functions as F

# Content type stated for each kind of landed file.
MEDIA_TYPES = {"csv": "application/csv", "json": "application/json", "zip": "application/zip"}
OTHER_MEDIA_TYPE = "text/plain"


def media_type(path: Column) -> Column:
    """Content type by file suffix."""
    kind = F.lit(OTHER_MEDIA_TYPE)
    for suffix, media in MEDIA_TYPES.items():
        kind = F.when(F.lower(path).endswith(f".{suffix}"), F.lit(media)).otherwise(kind)
    return kind


def percent_decode(column: Column) -> Column:
    return F.url_decode(F.replace(column, F.lit("+"), F.lit("%2B")))


def partition_value(path: Column, key: str) -> Column:
    """Value of the ``key=value`` folder in a file URI.

    Decoded twice: once for the URI, once for the escaping that Spark applies
    to characters such as ``:`` or ``%`` in folder names.
    """
    folder = F.regexp_extract(path, f"/{re.escape(key)}=([^/]+)/", 1)
    return F.nullif(percent_decode(percent_decode(folder)), F.lit(""))
