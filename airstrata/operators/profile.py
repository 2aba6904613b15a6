"""Counts and profiles, each in one pass."""

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from ..schemas import POLLUTANT, ZONE
from .rows import ACCEPTED, is_present, quoted, with_reason


def count_by(df: DataFrame, columns=(ZONE, POLLUTANT)) -> DataFrame:
    """Rows per group."""
    return df.groupBy(*[quoted(c) for c in columns]).count()


def distinct_values(df: DataFrame, column=POLLUTANT) -> DataFrame:
    """Distinct values of a column; they stay distributed."""
    return df.select(quoted(column)).distinct()


def count_audit(df: DataFrame, good: Column) -> DataFrame:
    """Rows before and after a filter."""
    return df.agg(F.count("*").alias("rows_before"), F.count_if(good).alias("rows_after"))


def profile(df: DataFrame) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum per numeric column, typed."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    wide = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(n).alias("column"),
                    F.count(quoted(n)).alias("count"),
                    F.mean(quoted(n)).alias("mean"),
                    F.stddev(quoted(n)).alias("stddev"),
                    F.min(quoted(n)).cast("double").alias("min"),
                    F.max(quoted(n)).cast("double").alias("max"),
                )
                for n in names
            ]
        ).alias("columns")
    )
    return wide.select(F.inline("columns"))


def gap_counts(df: DataFrame) -> DataFrame:
    """For each column the number of rows that ``complete`` drops on its account."""
    counts = [
        F.struct(F.lit(n).alias("column"), F.count_if(~is_present(df, n)).alias("missing"))
        for n in df.columns
    ]
    return df.agg(F.array(*counts).alias("columns")).select(F.inline("columns"))


def reject_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows per reject reason; rows without a reason are the accepted ones."""
    return with_reason(df, rules).groupBy("reason").agg(F.count("*").alias("rows"))


def _reason_counts(rules: dict[str, Column]) -> list[Column]:
    """Rows per first failed rule, and the accepted ones, as aggregates."""
    failed = {r: ~F.coalesce(good, F.lit(False)) for r, good in rules.items()}
    reason = F.coalesce(*[F.when(f, F.lit(r)) for r, f in failed.items()], F.lit(ACCEPTED))
    return [F.count_if(reason == r).alias(r) for r in [*rules, ACCEPTED]]


def observed(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """(rows, counts): the same rows, counted per reject reason by the action that consumes them.

    After that action ``counts.get`` is a dict. Nothing is read a second time; conditions applied later
    do not reach the scan, because all rows must pass here.
    """
    counts = Observation()
    return df.observe(counts, *_reason_counts(rules)), counts


def observed_stream(df: DataFrame, rules: dict[str, Column], name: str = "audit") -> DataFrame:
    """A stream whose progress reports tell, per micro-batch under ``name``, the rows per reject reason."""
    return df.observe(name, *_reason_counts(rules))


def stream_counts(query, name: str = "audit") -> list[dict]:
    """What ``observed_stream`` counted in each micro-batch that the query still remembers."""
    metrics = [p.observedMetrics.get(name) for p in query.recentProgress]
    return [m.asDict() for m in metrics if m is not None]
