"""The latest row per key."""

from pyspark.sql import DataFrame, functions as F

from .rows import quoted


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the greatest by ``order``, ties settled by the other columns.

    A maximum over the row itself, not ``row_number``: each task first reduces
    its own rows to one per key, so a key with a third of all rows sends one
    row per task through the shuffle. The result does not depend on the order
    of arrival, and applying it again, or to a union of earlier results, changes
    nothing. NULL orders lowest. Columns must be of comparable type (no maps).
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    row = F.struct(*[quoted(c) for c in [*order, *rest]])
    best = df.groupBy(*[quoted(k) for k in keys]).agg(F.max(row).alias("_row"))
    return best.select(
        *[
            quoted(c) if c in keys else F.col("_row").getField(c).alias(c)
            for c in df.columns
        ]
    )
