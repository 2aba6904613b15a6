import math

from pyspark.sql import functions as F

from airstrata.operators import profile, rows
from airstrata.plans.layers import clean, entry_rules, rejected
from airstrata.schemas import MEASUREMENT_COLUMNS

from data import raw, reading


def gaps(spark):
    return spark.createDataFrame(
        [
            (1, 1.0, [1.0, None], "a"),
            (2, None, [1.0, 2.0], "b"),
            (3, math.nan, [1.0, 2.0], "c"),
            (4, -1.0, None, "d"),
            (5, 0.0, [], None),
        ],
        "id int, number double, pair array<double>, name string",
    )


def ids(df):
    return sorted(r.id for r in df.collect())


def test_require_drops_null_and_nan_in_named_columns_only(spark):
    assert ids(rows.require(gaps(spark), ["number"])) == [1, 4, 5]
    assert ids(rows.require(gaps(spark), ["name"])) == [1, 2, 3, 4]


def test_complete_keeps_a_null_inside_an_array(spark):
    assert ids(rows.complete(gaps(spark))) == [1]


def test_nonnegative_needs_every_numeric_column(spark):
    assert ids(rows.nonnegative(gaps(spark))) == [1, 5]


def test_agrees_with_dropna(spark):
    df = gaps(spark)
    assert ids(rows.complete(df)) == ids(df.dropna())
    assert ids(rows.require(df, ["number", "name"])) == ids(df.dropna(subset=["number", "name"]))


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1.0, "x")], ["PM2.5", "type d'`influence`"])
    assert rows.project(df, ["PM2.5"]).columns == ["PM2.5"]
    assert rows.complete(df).count() == 1
    assert rows.copy_column(df, "PM2.5", "copy").first()["copy"] == 1.0
    assert profile.profile(df).first()["column"] == "PM2.5"


def test_stamp_date(spark):
    df = spark.sql("SELECT TIMESTAMP '2025-03-01 23:59:59' AS `Date de début`")
    assert rows.stamp_date(df).first().date == "2025-03-01"
    assert rows.stamp_date(df, "2025-02-28").first().date == "2025-02-28"


def test_split_rejects_covers_every_row_once(spark):
    df = gaps(spark)
    rules = {
        "no number": rows.is_present(df, "number"),
        "negative": F.col("number") >= 0,
        "no name": F.col("name").isNotNull(),
    }
    good, bad = rows.split_rejects(df, rules)
    assert ids(good) == [1]
    assert {r.id: r.reason for r in bad.collect()} == {
        2: "no number", 3: "no number", 4: "negative", 5: "no name",
    }
    assert good.columns == df.columns


def test_clean_layer_and_its_rejects(spark):
    df = raw(
        spark,
        reading(),
        reading(valeur=None),
        reading(valeur_brute=math.nan),
        reading(Date_de_début=None),
        reading(Date_de_fin="soon"),
        reading(Polluant=None),
        reading(valeur=-3.0, validité=-1),
    )
    kept = clean(df)
    assert kept.columns == [*MEASUREMENT_COLUMNS, "Polluant_copy"]
    assert sorted(r.valeur for r in kept.collect()) == [-3.0, 11.2]
    assert kept.schema["Date de début"].dataType.typeName() == "timestamp"
    assert sorted(r.reason for r in rejected(df).collect()) == [
        "no Date de début", "no Polluant", "no valeur", "no valeur brute", "unreadable Date de fin",
    ]
    assert clean(df, only_valid=True).count() == 1
    assert "not valid" in [r.reason for r in rejected(df, only_valid=True).collect()]


def test_validity_is_optional_in_the_strict_mode(spark):
    df = raw(spark, reading(validité=None), reading(validité=0))
    assert clean(df, only_valid=True).count() == 1
    assert "not valid" not in entry_rules(df)


def test_profile_and_audit(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 3.0), (3, None)], "n int, x double")
    by_name = {r["column"]: r for r in profile.profile(df).collect()}
    assert by_name["x"]["count"] == 2 and by_name["x"]["mean"] == 2.0
    assert by_name["n"]["min"] == 1.0 and by_name["n"]["max"] == 3.0
    assert abs(by_name["x"]["stddev"] - math.sqrt(2)) < 1e-12
    audit = profile.count_audit(df, rows.is_present(df, "x")).first()
    assert (audit.rows_before, audit.rows_after) == (3, 2)


def test_count_by_and_distinct(spark):
    df = raw(spark, reading(), reading(), reading(Polluant="O3"), reading(Zas=None))
    counted = {(r.Zas, r.Polluant): r["count"] for r in profile.count_by(df).collect()}
    assert counted == {("ZAG BORDEAUX", "NO2"): 2, ("ZAG BORDEAUX", "O3"): 1, (None, "NO2"): 1}
    assert sorted(r.Polluant for r in profile.distinct_values(df).collect()) == ["NO2", "O3"]


def test_gaps_and_rejects_are_counted(spark):
    df = gaps(spark)
    assert {r["column"]: r.missing for r in profile.gap_counts(df).collect()} == {
        "id": 0, "number": 2, "pair": 1, "name": 1,
    }
    rules = {"no number": rows.is_present(df, "number"), "no name": rows.is_present(df, "name")}
    counted = {r.reason: r.rows for r in profile.reject_counts(df, rules).collect()}
    assert counted == {None: 2, "no number": 2, "no name": 1}


def test_further_time_formats_are_tried_in_order(spark):
    odd = {"Date_de_début": "01/03/2025 19:00", "Date_de_fin": "2025-03-01 20h"}
    df = raw(spark, reading(**odd), reading())
    assert clean(df).count() == 1
    formats = ("dd/MM/yyyy HH:mm", "yyyy-MM-dd HH'h'")
    kept = clean(df, formats=formats)
    assert kept.select("Date de début", "Date de fin").distinct().count() == 1 and kept.count() == 2
    assert rejected(df, formats=formats).isEmpty()
