"""Projection, filters and reject reasons."""

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..schemas import (
    DATE, MEASUREMENT_COLUMNS, POLLUTANT, POLLUTANT_COPY, REQUIRED_COLUMNS, START,
)

ACCEPTED = "accepted"


def backticked(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def quoted(name: str) -> Column:
    """Column by exact name, whatever dots, blanks or quotes it holds."""
    return F.col(backticked(name))


def project(df: DataFrame, columns=MEASUREMENT_COLUMNS) -> DataFrame:
    """The named columns only."""
    return df.select(*[quoted(c) for c in columns])


def copy_column(df: DataFrame, source=POLLUTANT, target=POLLUTANT_COPY) -> DataFrame:
    """Keep a copy of a column that becomes a folder name."""
    return df.withColumn(target, quoted(source))


def stamp_date(df: DataFrame, run_date: date | str | None = None, start=START) -> DataFrame:
    """Add ``date`` text: the run's date, or by default the day each reading started.

    A daily file run with its own day gives the same either way.
    """
    day = F.lit(str(run_date)) if run_date is not None else F.date_format(quoted(start), "yyyy-MM-dd")
    return df.withColumn(DATE, day)


def _numeric(df: DataFrame) -> list[T.StructField]:
    return [f for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _present(field: T.StructField) -> Column:
    column = quoted(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return column.isNotNull() & ~F.isnan(column)
    return column.isNotNull()


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def require(df: DataFrame, columns=REQUIRED_COLUMNS) -> DataFrame:
    """Drop rows with a NULL or NaN in a named column.

    Spelled as one test per column rather than ``dropna``: these reach the scan
    as pushed filters, the null count behind ``dropna`` does not.
    """
    return df.where(_all([_present(df.schema[c]) for c in columns]))


def complete(df: DataFrame) -> DataFrame:
    """Drop rows with a NULL or NaN in any column; NULLs inside arrays do not count."""
    return require(df, df.columns)


def nonnegative(df: DataFrame) -> DataFrame:
    """Keep rows whose every numeric column is present and at least zero."""
    fields = _numeric(df)
    return df.where(_all([_present(f) & (quoted(f.name) >= 0) for f in fields]))


def with_reason(df: DataFrame, rules: dict[str, Column], reason: str = "reason") -> DataFrame:
    """Add the reason of the first rule a row fails, NULL for a good row.

    ``rules`` maps a reason to the condition a good row meets; a condition that
    is NULL is not met.
    """
    failed = {r: ~F.coalesce(good, F.lit(False)) for r, good in rules.items()}
    return df.withColumn(reason, F.coalesce(*[F.when(f, F.lit(r)) for r, f in failed.items()]))


def split_rejects(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows with their ``reason``; together the whole input.

    The good side is a plain conjunction, so its parts reach the scan.
    """
    bad = with_reason(df, rules).where(F.col("reason").isNotNull())
    return df.where(_all(list(rules.values()))), bad


def is_present(df: DataFrame, name: str) -> Column:
    """The column is neither NULL nor NaN."""
    return _present(df.schema[name])
