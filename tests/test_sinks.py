import json
import os

import pytest
from pyspark.sql import functions as F

from airstrata.catalog.tables import as_documents
from airstrata.plans import layers
from airstrata.schemas import DATE, POLLUTANT
from airstrata.sinks import documents
from airstrata.sinks.layers import write_delimited, write_layer

from data import raw, reading, settings, stations, times

DOC = "doc_id string, date string, `Date de début` string, `Date de fin` string, valeur double"


def docs(spark, *rows):
    full = [(k, d, f"{d}T{h:02d}:00:00", f"{d}T{h + 1:02d}:00:00", v) for k, d, h, v in rows]
    return spark.createDataFrame(full, DOC)


def current(spark, root, **options):
    return {r.doc_id: r.valeur for r in documents.read_documents(spark, root, **options).collect()}


def test_layer_folders_and_replacement(spark, tmp_path):
    root = str(tmp_path / "L1")
    df = raw(spark, reading(), reading(Polluant="PM2.5"), reading(Polluant="O3"))
    write_layer(df, root)
    assert sorted(d for d in os.listdir(root) if "=" in d) == ["Polluant=NO2", "Polluant=O3", "Polluant=PM2.5"]
    write_layer(raw(spark, reading(valeur=1.0)), root)
    assert [r.valeur for r in spark.read.parquet(root).collect()] == [1.0]


def test_touched_only_leaves_other_folders(spark, tmp_path):
    root = str(tmp_path / "L2")
    rows = [("2025-03-01", "NO2", 1), ("2025-03-01", "O3", 2), ("2025-03-02", "NO2", 3)]
    fields = "date string, Polluant string, n int"
    write_layer(spark.createDataFrame(rows, fields), root, (DATE, POLLUTANT), ("n",), touched_only=True)
    again = spark.createDataFrame([("2025-03-01", "NO2", 9)], fields)
    write_layer(again, root, (DATE, POLLUTANT), ("n",), touched_only=True)
    assert sorted(r.n for r in spark.read.parquet(root).collect()) == [2, 3, 9]


def test_hot_folder_is_split_over_tasks(spark, tmp_path):
    """A folder with most rows gets several files, each row once."""
    hot = F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 5))
    df = spark.range(0, 60000, 1, 8).select(
        hot.alias(POLLUTANT), F.sha2(F.col("id").cast("string"), 256).alias("Zas"), "id"
    )
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB"):
        write_layer(df, str(tmp_path / "hot"))
    files = [f for f in os.listdir(tmp_path / "hot" / "Polluant=hot") if f.endswith(".parquet")]
    assert len(files) > 1
    stored = spark.read.parquet(str(tmp_path / "hot"))
    assert stored.count() == 60000 and stored.select("id").distinct().count() == 60000


def test_null_pollutant_cannot_enter_the_layer(spark, tmp_path):
    df = layers.clean(raw(spark, reading(Polluant=None), reading()))
    layers.store_cleaned(df, str(tmp_path / "L1"))
    assert [d for d in os.listdir(tmp_path / "L1") if "=" in d] == ["Polluant=NO2"]


def test_csv_is_replaced(spark, tmp_path):
    path = str(tmp_path / "csv")
    for n in (3, 2):
        write_delimited(spark.range(n), path)
    assert spark.read.option("header", True).csv(path).count() == 2


def test_upsert_is_by_time_not_by_arrival(spark, tmp_path):
    root = str(tmp_path / "store")
    documents.upsert(docs(spark, ("a", "2025-03-01", 9, 9.0), ("b", "2025-03-02", 1, 1.0)), root, "1")
    documents.upsert(docs(spark, ("a", "2025-03-01", 3, 3.0), ("c", "2025-03-02", 1, 5.0)), root, "2")
    assert current(spark, root) == {"a": 9.0, "b": 1.0, "c": 5.0}
    documents.upsert(docs(spark, ("a", "2025-03-01", 12, 12.0)), root, "3")
    assert current(spark, root) == {"a": 12.0, "b": 1.0, "c": 5.0}
    assert current(spark, root, days=["2025-03-02"]) == {"b": 1.0, "c": 5.0}


def test_corrections_replace_whatever_their_value(spark, tmp_path):
    root, target = str(tmp_path / "store"), str(tmp_path / "compact")
    first = docs(spark, ("a", "2025-03-01", 9, 5.0), ("b", "2025-03-01", 9, 1.0))
    documents.upsert(first, root, "first")
    documents.upsert(docs(spark, ("a", "2025-03-01", 9, 3.0)), root, "second")
    documents.upsert(first, root, "first")
    assert current(spark, root) == {"a": 3.0, "b": 1.0}
    documents.compact(spark, root, target)
    assert current(spark, target) == {"a": 3.0, "b": 1.0}
    documents.upsert(docs(spark, ("a", "2025-03-01", 9, 2.0)), target, "third")
    assert current(spark, target) == {"a": 2.0, "b": 1.0}


def test_columns_of_a_later_batch_are_kept(spark, tmp_path):
    root = str(tmp_path / "store")
    documents.upsert(docs(spark, ("a", "2025-03-01", 1, 1.0)), root, "1")
    documents.upsert(docs(spark, ("b", "2025-03-01", 1, 1.0)).withColumn("note", F.lit("n")), root, "2")
    assert {r.doc_id: r.note for r in documents.read_documents(spark, root).collect()} == {"a": None, "b": "n"}


def test_second_run_leaves_other_days_alone(spark, tmp_path):
    work = tmp_path / "work"
    write_delimited(stations(spark), str(tmp_path / "stations"))
    for n, day in enumerate(("2025-03-01", "2025-03-02")):
        slashed = day.replace("-", "/")
        at = {k: v.replace("2025-03-01", day).replace("2025/03/01", slashed) for k, v in times(10).items()}
        write_delimited(raw(spark, reading(**at)), str(tmp_path / f"raw{n}"), sep=";")
        layers.raw_to_documents(
            spark, str(tmp_path / f"raw{n}"), str(tmp_path / "stations"), str(work), batch=f"run{n}"
        )
    folders = sorted(str(p.relative_to(work / "documents")) for p in (work / "documents").glob("*/*"))
    assert [f for f in folders if "=" in f] == [
        "doc_day=2025-03-01/batch=run0", "doc_day=2025-03-02/batch=run1",
    ]


def test_text_survives_delimited_files(spark, tmp_path):
    from airstrata.sources.tables import read_delimited

    texts = [" padded ", "", None, 'a "quote", x', "back\\slash\\", "two\nlines", '\\"', ";,"]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    write_delimited(df, str(tmp_path / "csv"))
    got = read_delimited(spark, str(tmp_path / "csv"), df.schema, sep=",", multiline=True)
    assert [r.text for r in got.orderBy("n").collect()] == texts


def test_publish_sends_once(spark, tmp_path):
    folder = str(tmp_path)

    def send(pairs):
        for key, _ in pairs:
            with open(f"{folder}/{key}", "a") as file:
                file.write("x")
        return [None if key != "k3" else "no" for key, _ in pairs]

    refused = documents.publish(docs(spark, *[(f"k{i}", "2025-03-01", 1, 1.0) for i in range(40)]), send)
    refused.take(1)
    assert refused.count() == 1
    assert [os.path.getsize(f"{folder}/k{i}") for i in range(40)] == [1] * 40


def test_replayed_batch_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "store")
    batch = docs(spark, ("a", "2025-03-01", 9, 9.0), ("a", "2025-03-01", 8, 8.0))
    for _ in range(3):
        documents.upsert(batch, root, "1")
    assert current(spark, root) == {"a": 9.0}
    assert spark.read.parquet(root).count() == 1


def test_compacted_store_reads_the_same_and_takes_more(spark, tmp_path):
    root, target = str(tmp_path / "store"), str(tmp_path / "compact")
    for i in range(3):
        delivery = docs(spark, ("a", "2025-03-01", i, float(i)), (f"k{i}", "2025-03-02", 0, 0.5))
        documents.upsert(delivery, root, str(i))
    documents.compact(spark, root, target)
    assert current(spark, target) == current(spark, root) == {"a": 2.0, "k0": 0.5, "k1": 0.5, "k2": 0.5}
    assert spark.read.parquet(target).count() == 4
    documents.upsert(docs(spark, ("a", "2025-03-01", 7, 7.0)), target, "later")
    assert current(spark, target)["a"] == 7.0


def test_empty_batch_is_a_no_op(spark, tmp_path):
    root = str(tmp_path / "store")
    nothing = docs(spark, ("a", "2025-03-01", 1, 1.0)).limit(0)
    documents.upsert(nothing, root, "0")
    assert current(spark, root, schema=nothing.schema) == {}
    documents.upsert(docs(spark, ("a", "2025-03-01", 1, 1.0)), root, "1")
    documents.upsert(nothing, root, "2")
    assert current(spark, root) == {"a": 1.0}


def test_days_prune_folders(spark, tmp_path):
    root = str(tmp_path / "store")
    documents.upsert(docs(spark, ("a", "2025-03-01", 1, 1.0), ("b", "2025-03-02", 1, 1.0)), root, "1")
    df = documents.read_documents(spark, root, days=["2025-03-02"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "doc_day" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_append_gives_new_ids(spark, tmp_path):
    path = str(tmp_path / "appended")
    for _ in range(2):
        documents.append(spark.range(3), path)
    stored = spark.read.parquet(path)
    assert stored.count() == 6 and stored.select("doc_id").distinct().count() == 6


def test_bulk_file_alternates(spark, tmp_path):
    df = docs(spark, ("a", "2025-03-01", 1, 1.5), ('q"', "2025-03-01", 2, None))
    documents.write_bulk(df, str(tmp_path / "bulk"), "readings")
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "bulk")).collect()]
    assert len(lines) == 4
    actions, bodies = lines[0::2], lines[1::2]
    assert {a["index"]["_id"] for a in actions} == {"a", 'q"'}
    assert all(a["index"]["_index"] == "readings" for a in actions)
    assert all("date" in b and "doc_id" not in b for b in bodies)


def test_publish_lists_what_the_index_refuses(spark):
    def send(pairs):
        return [None if json.loads(body)["valeur"] < 2 else f"refused {key}" for key, body in pairs]

    df = docs(spark, *[(f"k{i}", "2025-03-01", 1, float(i)) for i in range(4)])
    for writers in (None, 2):
        errors = documents.publish(df, send, chunk=3, writers=writers)
        assert sorted(map(tuple, errors.collect())) == [("k2", "refused k2"), ("k3", "refused k3")]


def test_publish_nothing(spark):
    df = docs(spark, ("a", "2025-03-01", 1, 1.0)).limit(0)
    assert documents.publish(df, lambda pairs: [None] * len(pairs)).count() == 0


def test_write_through_a_connector(spark, tmp_path):
    documents.write_index(docs(spark, ("a", "2025-03-01", 1, 1.0)), "json", path=str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).first().doc_id == "a"


@pytest.fixture
def landed(spark, tmp_path):
    df = raw(
        spark,
        reading(**times(10), valeur=1.0), reading(**times(12), valeur=3.0), reading(**times(11), valeur=2.0),
        reading(**times(12), Polluant="PM2.5"),
        reading(**times(9), code_site="FR31002"),
        reading(**times(9), code_site="FR_ABSENT"), reading(**times(9), code_site=None),
        reading(**times(9), code_site="FR_NO_GPS"),
        reading(**times(9), code_site="FR31002", Polluant="O3", unité_de_mesure=None),
        reading(valeur=None), reading(Date_de_début="?"),
    )
    write_delimited(df, str(tmp_path / "raw"), sep=";")
    write_delimited(stations(spark), str(tmp_path / "stations"))
    return tmp_path


def test_all_layers(spark, landed):
    docs_ = layers.raw_to_documents(spark, str(landed / "raw"), str(landed / "stations"), str(landed / "work"))
    got = {r.doc_id: r for r in docs_.collect()}
    assert set(got) == {
        "2025-03-01_FR31007_NO2", "2025-03-01_FR31007_PM2.5", "2025-03-01_FR31002_NO2",
    }
    newest = got["2025-03-01_FR31007_NO2"]
    assert newest.valeur == 3.0 and newest["Date de début"] == "2025-03-01T12:00:00"
    assert newest.GPS == [-0.515835, 44.900295] and newest.date == "2025-03-01"
    assert newest.Polluant == newest.Polluant_copy == "NO2"
    again = layers.raw_to_documents(spark, str(landed / "raw"), str(landed / "stations"), str(landed / "work"))
    assert sorted(map(repr, again.collect())) == sorted(map(repr, got.values()))


def test_layers_of_empty_input(spark, tmp_path):
    write_delimited(raw(spark, reading()).limit(0), str(tmp_path / "raw"), sep=";")
    write_delimited(stations(spark), str(tmp_path / "stations"))
    got = layers.raw_to_documents(spark, str(tmp_path / "raw"), str(tmp_path / "stations"), str(tmp_path / "work"))
    assert got.isEmpty()


def test_run_date_replaces_the_day(spark, landed):
    got = layers.raw_to_documents(
        spark, str(landed / "raw"), str(landed / "stations"), str(landed / "work"), run_date="2025-02-28"
    )
    assert {r.date for r in got.collect()} == {"2025-02-28"}


@pytest.mark.parametrize("grain, count", [("day", 3), ("hour", 5)])
def test_one_plan_agrees_with_stored_layers(spark, landed, grain, count):
    from airstrata.operators.latest import latest_per_key
    from airstrata.operators.stations import station_table
    from airstrata.sources.tables import read_measurements, read_stations

    cleaned = layers.clean(read_measurements(spark, str(landed / "raw")))
    known = station_table(read_stations(spark, str(landed / "stations")))
    twice = known.unionByName(known.withColumn("Name", F.lit("AAA")))
    for table in (known, twice):
        joined_first = latest_per_key(
            layers.to_documents(layers.combine(cleaned, table), grain), ["doc_id"], ["Date de début"]
        )
        direct = layers.latest_documents(cleaned, table, grain=grain)
        columns = sorted(direct.columns)
        assert sorted(joined_first.columns) == columns
        got = sorted(map(repr, direct.select(*[f"`{c}`" for c in columns]).collect()))
        assert got == sorted(map(repr, joined_first.select(*[f"`{c}`" for c in columns]).collect()))
        assert len(got) == count


def test_documents_of_the_fixture_tables(spark):
    fields = "event_id long, user_id long, event_type string, value double"
    events = spark.createDataFrame([(1, 7, "NO2", 1.0)], fields)
    df = as_documents(events.withColumn("ts", F.lit("2025-03-01 10:00:00").cast("timestamp_ntz")))
    assert df.first().doc_id == "2025-03-01_FR7_NO2"
