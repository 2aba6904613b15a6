"""Casts that give NULL for text they cannot read."""

from pyspark.sql import Column


def as_double(column: Column) -> Column:
    return column.try_cast("double")


def as_integer(column: Column) -> Column:
    return column.try_cast("int")
