"""Document keys."""

from functools import reduce

from pyspark.sql import Column, functions as F


def document_key(*parts: Column) -> Column:
    """``date_site_pollutant``; NULL when a part is, unlike bare ``concat_ws``."""
    whole = reduce(lambda a, b: a & b, [p.isNotNull() for p in parts])
    return F.when(whole, F.concat_ws("_", *[p.cast("string") for p in parts]))


def key_array(*parts: Column) -> Column:
    """The key as an array of text parts."""
    return F.array(*[p.cast("string") for p in parts])
