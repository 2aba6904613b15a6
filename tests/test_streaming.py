import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from airstrata.plans.layers import clean, combine, to_documents
from airstrata.operators.stations import station_table
from airstrata.sinks import documents
from airstrata.sinks.layers import write_delimited
from airstrata.streaming.landing import landed_files, stream_upsert

from data import raw, reading, stations, times


def prepare_with(table):
    return lambda batch: to_documents(combine(clean(batch), table))


def current(spark, root):
    return {r.doc_id: r.valeur for r in documents.read_documents(spark, root).collect()}


def land(spark, folder, name, *rows):
    """One landed file, put in place whole."""
    staged = folder / f"staged-{name}"
    write_delimited(raw(spark, *rows).coalesce(1), str(staged), sep=";")
    part = next(staged.glob("part-*.csv"))
    (folder / "landing").mkdir(exist_ok=True)
    (folder / "landing" / f"{name}.csv").write_bytes(part.read_bytes())


def test_files_as_they_land(spark, tmp_path):
    table = station_table(stations(spark))
    root, checkpoint = str(tmp_path / "store"), str(tmp_path / "checkpoint")

    def run():
        files = landed_files(spark, str(tmp_path / "landing"), files_per_batch=1)
        query = stream_upsert(files, root, checkpoint, prepare_with(table))
        query.awaitTermination()
        return len([p for p in query.recentProgress if p.numInputRows > 0])

    # Each hour's file repeats the day so far; a late file brings an older hour.
    land(spark, tmp_path, "h1", reading(**times(10), valeur=1.0))
    land(spark, tmp_path, "h2", reading(**times(10), valeur=1.0), reading(**times(11), valeur=2.0))
    assert run() == 2
    assert current(spark, root) == {"2025-03-01_FR31007_NO2": 2.0}
    land(spark, tmp_path, "late", reading(**times(9), valeur=0.5), reading(**times(9), Polluant="O3"))
    assert run() == 1
    assert current(spark, root) == {"2025-03-01_FR31007_NO2": 2.0, "2025-03-01_FR31007_O3": 11.2}
    run()
    assert current(spark, root) == {"2025-03-01_FR31007_NO2": 2.0, "2025-03-01_FR31007_O3": 11.2}


def test_columns_are_picked_by_name(spark, tmp_path):
    df = raw(spark, reading(**times(10), valeur=4.0))
    wide = df.select(F.lit("new").alias("further"), *[F.col(f"`{c}`") for c in reversed(df.columns)])
    write_delimited(wide, str(tmp_path / "landing"), sep=";")
    files = landed_files(spark, str(tmp_path / "landing"))
    prepare = prepare_with(station_table(stations(spark)))
    stream_upsert(files, str(tmp_path / "store"), str(tmp_path / "ck"), prepare).awaitTermination()
    assert current(spark, str(tmp_path / "store")) == {"2025-03-01_FR31007_NO2": 4.0}
    other = df.select(*[F.col(f"`{c}`") for c in df.columns])
    write_delimited(other, str(tmp_path / "other"), sep=";")
    for part in (tmp_path / "other").glob("part-*.csv"):
        (tmp_path / "landing" / f"x{part.name}").write_bytes(part.read_bytes())
    query = stream_upsert(files, str(tmp_path / "store"), str(tmp_path / "ck"), prepare)
    with pytest.raises(StreamingQueryException):
        query.awaitTermination()


def test_corrections_come_through_the_stream(spark, tmp_path):
    prepare = prepare_with(station_table(stations(spark)))
    for name, value in (("a", 5.0), ("b", 3.0)):
        land(spark, tmp_path, name, reading(**times(10), valeur=value))
        files = landed_files(spark, str(tmp_path / "landing"))
        stream_upsert(files, str(tmp_path / "store"), str(tmp_path / "ck"), prepare).awaitTermination()
    assert current(spark, str(tmp_path / "store")) == {"2025-03-01_FR31007_NO2": 3.0}


def test_one_batch_many_batches_and_batch_job_agree(spark, tmp_path):
    table = station_table(stations(spark))
    rows = [reading(**times(h), valeur=float(h), Polluant=p) for h in range(3) for p in ("NO2", "O3")]
    for i, row in enumerate(rows):
        land(spark, tmp_path, f"f{i}", row)
    results = []
    for name, size in (("one", None), ("many", 4)):
        files = landed_files(spark, str(tmp_path / "landing"), files_per_batch=size)
        root, checkpoint = str(tmp_path / name), str(tmp_path / f"ck-{name}")
        stream_upsert(files, root, checkpoint, prepare_with(table)).awaitTermination()
        results.append(current(spark, str(tmp_path / name)))
    documents.upsert(prepare_with(table)(raw(spark, *rows)), str(tmp_path / "batch"), "all")
    results.append(current(spark, str(tmp_path / "batch")))
    assert results[0] == results[1] == results[2] == {
        "2025-03-01_FR31007_NO2": 2.0, "2025-03-01_FR31007_O3": 2.0,
    }


def test_lost_checkpoint_replays_without_harm(spark, tmp_path):
    """A stream that starts afresh on other files leaves the first one's batches alone."""
    table = station_table(stations(spark))
    land(spark, tmp_path, "a", reading(**times(11), valeur=2.0))
    for name in ("first", "second"):
        if name == "second":
            (tmp_path / "landing" / "a.csv").unlink()
            land(spark, tmp_path, "b", reading(**times(10), valeur=1.0))
        files = landed_files(spark, str(tmp_path / "landing"), files_per_batch=1)
        stream_upsert(files, str(tmp_path / "store"), str(tmp_path / name), prepare_with(table)).awaitTermination()
    assert current(spark, str(tmp_path / "store")) == {"2025-03-01_FR31007_NO2": 2.0}


def test_replays_leave_the_stream(spark, tmp_path):
    """What arrives again passes once, however late its reading; corrections pass; state is let go in time."""
    import time

    from airstrata.streaming.landing import landed_files, without_replays

    fields = "k int, at timestamp, v double"
    schema = spark.createDataFrame([], fields).schema
    old, new = "1999-01-01 00:00:00", "2025-03-01 00:00:00"

    def land(*rows):
        df = spark.createDataFrame([(k, None, v) for k, _, v in rows], fields)
        times = {k: t for k, t, _ in rows}
        cases = " ".join(f"WHEN {k} THEN timestamp'{t}'" for k, t in times.items())
        df.selectExpr("k", f"CASE k {cases} END AS at", "v").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def run(within):
        rows = without_replays(landed_files(spark, str(tmp_path / "in"), schema, "parquet", 1), within)
        query = (
            rows.writeStream.format("parquet").option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]

    def passed():
        return sorted((r.k, r.v) for r in spark.read.schema(schema).parquet(str(tmp_path / "out")).collect())

    land(*[(i, new, float(i)) for i in range(50)])
    assert run("3 seconds")[-1] == 50
    land(*[(i, new, float(i)) for i in range(50)], (50, old, 1.0))
    land((7, new, 70.0), (50, old, 1.0))
    run("3 seconds")
    want = sorted([(i, float(i)) for i in range(50)] + [(50, 1.0), (7, 70.0)])
    assert passed() == want
    time.sleep(5)
    land((90, old, 9.0))
    land((91, old, 9.0))
    assert run("3 seconds")[-1] <= 4
    assert passed() == sorted([*want, (90, 9.0), (91, 9.0)])
