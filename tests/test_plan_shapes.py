"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from airstrata.operators.rows import require
from airstrata.operators.joins import join_stations, unmatched
from airstrata.sinks.layers import write_layer
from airstrata.sources.tables import read_parquet
from airstrata.workspace import shared_folder, workspace

from data import settings

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_required_columns_reach_the_scan(spark, tmp_path):
    spark.createDataFrame([(1, 1.0, "a"), (2, None, "b")], "id int, v double, w string").write.parquet(
        str(tmp_path / "t")
    )
    text = plan(require(read_parquet(spark, str(tmp_path / "t")), ["id", "v"]).select("id"))
    assert "IsNotNull(id)" in text and "IsNotNull(v)" in text
    assert "ReadSchema: struct<id:int,v:double>" in text


def test_folder_filter_prunes(spark, tmp_path):
    df = spark.range(10).select(F.concat(F.lit("p"), F.col("id") % 3).alias("Polluant"), "id")
    write_layer(df, str(tmp_path / "L1"), cluster=("id",))
    one = read_parquet(spark, str(tmp_path / "L1")).where("Polluant = 'p1'")
    assert "Polluant" in plan(one).split("PartitionFilters: [")[1].split("]")[0]
    assert sorted(r.id for r in one.collect()) == [1, 4, 7]


def test_flagship_moves_readings_once(spark):
    """One exchange on the readings' side and one on the stations'; the join adds none when small."""
    text = plan(entry.queries()["latest_station_documents"](spark, FOLDER))
    assert text.count("Exchange hashpartitioning") == 2
    assert text.count("BroadcastHashJoin") == 1
    assert text.index("BroadcastHashJoin") < text.index("partial_max")


def test_large_stations_are_not_broadcast(spark):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="1KB"):
        text = plan(entry.queries()["join_station_inner"](spark, FOLDER))
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text


def test_salted_join_reads_readings_once_more_and_broadcasts_nothing(spark):
    """The sites are counted when the join is asked for; the plan itself has one scan a side."""
    text = plan(entry.queries()["join_station_salted"](spark, FOLDER))
    assert text.count("FileScan") == 2
    assert "SortMergeJoin" in text and "Broadcast" not in text


def test_sites_are_counted_before_they_are_joined(spark):
    left = spark.range(9).select("id", F.concat(F.lit("S"), F.col("id") % 3).alias("code site"))
    right = spark.createDataFrame([("S1",)], "NatlStationCode string")
    text = plan(unmatched(left, right))
    assert text.index("Join") < text.index("partial_count")


@pytest.mark.parametrize("name", ["upsert_latest", "count_by_zone_pollutant", "latest_station_documents"])
def test_result_does_not_depend_on_shuffle_partitions(spark, name):
    results = []
    for partitions in ("1", "13"):
        with settings(spark, spark__sql__shuffle__partitions=partitions):
            results.append(sorted(map(repr, entry.queries()[name](spark, FOLDER).collect())))
    assert results[0] == results[1]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_site_is_split_by_adaptive_join(spark, how):
    """With stations too large to broadcast, a site with a third of the rows is cut up."""
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
    ):
        site = F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("S"), F.col("id") % 997))
        left = spark.range(0, 40000, 1, 8).select("id", site.alias("code site"))
        code = F.when(F.col("id") == 997, "HOT").otherwise(F.concat(F.lit("S"), F.col("id")))
        right = spark.range(998).select(code.alias("NatlStationCode"))
        joined = join_stations(left, right, how)
        assert len(joined.collect()) == 40000
        assert "skew=true" in plan(joined)


def test_workspace_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    first, second = workspace(spark, "x"), workspace(spark, "x")
    assert first.startswith(f"{named}/airstrata/x-") and first != second


def test_cluster_without_shared_folder_is_refused():
    class Context:
        master = "yarn"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session)
