"""What changed in a folder, and runs that read only that."""

import pytest
from pyspark.sql import functions as F

from airstrata.plans import layers
from airstrata.sinks import versions
from airstrata.sinks.layers import write_delimited
from airstrata.sources.listing import Landing, compare_listings, list_files

from data import raw, reading, stations, times


def changes(landing):
    return sorted((r.path.rsplit("/", 1)[1], r.change) for r in landing.changes.collect())


def test_changes_of_a_folder(spark, tmp_path):
    root, state = tmp_path / "in", str(tmp_path / "state")
    root.mkdir()
    for name in ("a.csv", "b.csv", "c.json"):
        (root / name).write_text("x\n")
    first = Landing(spark, str(root), state, ".csv")
    assert changes(first) == [("a.csv", "added"), ("b.csv", "added")] and len(first.fresh()) == 2
    assert changes(Landing(spark, str(root), state, ".csv")) == changes(first)  # not accepted yet
    first.accept()
    (root / "a.csv").write_text("longer\n")
    (root / "b.csv").unlink()
    (root / "d.csv").write_text("y\n")
    second = Landing(spark, str(root), state, ".csv")
    assert changes(second) == [("a.csv", "changed"), ("b.csv", "gone"), ("d.csv", "added")]
    second.accept()
    third = Landing(spark, str(root), state, ".csv")
    assert changes(third) == [("a.csv", "same"), ("d.csv", "same")] and third.fresh() == []


def test_comparison_without_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a").write_text("x")
    now = list_files(spark, str(tmp_path / "in"))
    assert [r.change for r in compare_listings(now, now.limit(0)).collect()] == ["added"]
    assert [r.change for r in compare_listings(now.limit(0), now).collect()] == ["gone"]
    assert compare_listings(now.limit(0), now.limit(0)).isEmpty()


def test_runs_read_new_files_only(spark, tmp_path, monkeypatch):
    work, landing = str(tmp_path / "work"), str(tmp_path / "raw")
    write_delimited(stations(spark), str(tmp_path / "stations"))

    def land(name, *rows):
        write_delimited(raw(spark, *rows).coalesce(1), f"{landing}/{name}", sep=";")

    def run():
        return layers.new_files_to_documents(spark, landing, str(tmp_path / "stations"), work)

    def current():
        return {r.doc_id[11:]: r.valeur for r in versions.read_documents(spark, f"{work}/documents").collect()}

    seen = []
    reader = layers.read_measurements
    monkeypatch.setattr(layers, "read_measurements", lambda s, paths: (seen.append(len(paths)), reader(s, paths))[1])
    land("one", reading(**times(10), valeur=1.0))
    assert run() == 1 and current() == {"FR31007_NO2": 1.0}
    land("two", reading(**times(9), valeur=2.0), reading(**times(9), code_site="FR31002", valeur=3.0))
    assert run() == 2 and current() == {"FR31007_NO2": 1.0, "FR31002_NO2": 3.0}
    assert run() is None
    land("one", reading(**times(10), valeur=0.5))
    with monkeypatch.context() as broken:
        broken.setattr(versions, "_claimed", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run()
    assert current() == {"FR31007_NO2": 1.0, "FR31002_NO2": 3.0}
    assert run() == 3 and current() == {"FR31007_NO2": 0.5, "FR31002_NO2": 3.0}
    assert seen == [1, 1, 1, 1]


def test_the_write_counts_its_rows(spark, tmp_path):
    df = raw(spark, reading(), reading(valeur=None), reading(valeur_brute=None, Date_de_début="?"), reading(Date_de_fin="?"), reading())
    write_delimited(df, str(tmp_path / "raw"), sep=";")
    from airstrata.sources.tables import read_measurements

    counts = layers.store_cleaned_audited(read_measurements(spark, str(tmp_path / "raw")), str(tmp_path / "L1"))
    assert {k: n for k, n in counts.items() if n} == {
        "accepted": 2, "no valeur": 1, "no valeur brute": 1, "unreadable Date de fin": 1,
    }
    assert spark.read.parquet(str(tmp_path / "L1")).count() == 2


def test_a_stream_counts_its_rows(spark, tmp_path):
    from airstrata.operators.profile import observed_stream, stream_counts

    spark.range(10).write.parquet(str(tmp_path / "in"))
    rows = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
    counted = observed_stream(rows, {"odd": F.col("id") % 2 == 0, "small": F.col("id") > 3})
    query = counted.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    total = {}
    for counts in stream_counts(query):
        for name, n in counts.items():
            total[name] = total.get(name, 0) + n
    assert total == {"odd": 5, "small": 2, "accepted": 3}


def test_profiles_merge(spark, tmp_path):
    from airstrata.operators.sketches import day_profiles, merged_profile, store_profiles

    path = str(tmp_path / "profiles")
    df = spark.range(20000).selectExpr(
        "concat('2025-03-0', id % 4 + 1) AS day", "CASE WHEN id % 10 <> 0 THEN double(id) END AS v", "id % 1500 AS site"
    )
    store_profiles(day_profiles(df, "day", "v", "site"), path)
    whole = merged_profile(spark, path).first()
    assert (whole.rows, whole.present, whole.lowest, whole.highest) == (20000, 18000, 1.0, 19999.0)
    assert whole.total == sum(i for i in range(20000) if i % 10)
    assert all(abs(q - p * 20000) < 0.02 * 20000 for q, p in zip(whole["quantiles"], (0.25, 0.5, 0.75)))
    assert abs(whole.members / 1500 - 1) < 0.06
    two = merged_profile(spark, path, "2025-03-02", "2025-03-03")
    assert two.first().rows == 10000
    plan = two._jdf.queryExecution().executedPlan().toString()
    assert "doc_day" in plan.split("PartitionFilters: [")[1].split("]")[0]
    again = df.where("day = '2025-03-01'").withColumn("v", F.lit(None).cast("double"))
    store_profiles(day_profiles(again, "day", "v", "site"), path)
    assert merged_profile(spark, path, last="2025-03-01").first().asDict() | {"members": 0} == {
        "rows": 5000, "present": 0, "total": None, "lowest": None, "highest": None, "members": 0, "quantiles": None,
    }
    nothing = merged_profile(spark, path, first="2026").first()
    assert (nothing.rows, nothing.members, nothing["quantiles"]) == (0, 0, None)


def test_colocated_join_moves_nothing(spark, tmp_path):
    from airstrata.operators.joins import join_stations, join_stations_colocated
    from airstrata.sinks.layers import write_bucketed

    readings = raw(spark, reading(), reading(code_site="FR31002"), reading(code_site=None), reading(code_site="X"), reading())
    known = stations(spark)
    write_bucketed(readings, "colocated_readings", str(tmp_path / "r"), "code site", 4)
    write_bucketed(known, "colocated_stations", str(tmp_path / "s"), "NatlStationCode", 4)
    joined = join_stations_colocated(spark, "colocated_readings", "colocated_stations")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(repr, joined.collect())) == sorted(map(repr, join_stations(readings, known).collect()))
    for name in ("colocated_readings", "colocated_stations"):
        spark.sql(f"DROP TABLE {name}")
