import random

from pyspark.sql import functions as F

from airstrata.operators.latest import latest_per_key

FIELDS = "k string, t int, v double, note string"


def test_latest_row_and_ties(spark):
    df = spark.createDataFrame(
        [
            ("a", 1, 9.0, "old"), ("a", 2, 1.0, "new"),
            ("b", 5, 1.0, "x"), ("b", 5, 2.0, "w"),
            ("c", None, 1.0, "undated"), ("c", 0, None, "dated"),
            (None, 1, 1.0, "no key"),
        ],
        FIELDS,
    )
    got = sorted(map(tuple, latest_per_key(df, ["k"], ["t"]).collect()), key=repr)
    assert got == sorted(
        [("a", 2, 1.0, "new"), ("b", 5, 2.0, "w"), ("c", 0, None, "dated"), (None, 1, 1.0, "no key")],
        key=repr,
    )


def test_result_does_not_depend_on_layout(spark):
    rng = random.Random(7)
    rows = [
        ("hot" if i % 3 == 0 else f"k{i % 50}", rng.randrange(40), float(rng.randrange(5)), f"n{i % 9}")
        for i in range(3000)
    ]
    best = {}
    for row in rows:
        if row[0] not in best or row[1:] > best[row[0]][1:]:
            best[row[0]] = row
    for parts in (1, 3, 16):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, FIELDS).repartition(parts)
        got = {r.k: tuple(r) for r in latest_per_key(df, ["k"], ["t"]).collect()}
        assert got == best


def test_union_of_partial_results_is_the_whole_result(spark):
    df = spark.range(500).select(
        F.concat(F.lit("k"), F.col("id") % 7).alias("k"), F.xxhash64("id").alias("t"), "id"
    )
    whole = latest_per_key(df, ["k"], ["t"])
    parts = [latest_per_key(df.where(F.col("id") % 3 == i), ["k"], ["t"]) for i in range(3)]
    merged = latest_per_key(parts[2].union(parts[0]).union(parts[1]).union(parts[0]), ["k"], ["t"])
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, merged.collect()))
