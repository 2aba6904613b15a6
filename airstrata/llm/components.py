"""Connected components of a large graph by alternating star contractions."""

from pyspark.sql import DataFrame, functions as F

from .common import stored

ROUNDS = 40


def linked(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger to the smaller end."""
    return (
        edges.where(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )


def large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node below its smallest neighbour."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    larger = edges.select(F.col("v").alias("u"), F.col("u").alias("w"))  # w > u
    return linked(larger.join(least, "u").select(F.col("w").alias("u"), F.col("m").alias("v")))


def small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and all its smaller neighbours below the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked(moved.unionAll(least.select("u", F.col("m").alias("v"))))


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``u, v`` for every node u that is not the least of its component, v being the least.

    ``edges`` has columns u, v of one orderable type; loops, repeats and both
    directions are fine. A node with a great many neighbours costs a minimum that each task
    reduces first, and a join that adaptive execution can split. Every round is
    written to the shared folder, which cuts the lineage. Rounds are about the
    logarithm of the longest shortest path; an exceeded limit raises.
    """
    now = stored(linked(edges), label)
    for _ in range(ROUNDS):
        if now.isEmpty():
            return now
        after = stored(small_star(large_star(now)), label)
        # Stars alone are left once no node is both above and below another.
        middle = after.select("u").join(after.select(F.col("v").alias("u")), "u", "left_semi")
        if middle.isEmpty() and after.groupBy("u").count().where("count > 1").isEmpty():
            return after
        now = after
    raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
