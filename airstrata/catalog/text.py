"""Text, JSON, bytes, geometry text and search."""

from pyspark.sql import functions as F

from ..functions.geo import multipolygon_wkt, polygon_wkt
from ..functions.text import json_number_map, squeeze_whitespace, utf8_text
from ..functions.times import iso_text
from ..operators.search import bm25, first_documents
from .registry import query
from .tables import table


@query(
    "json_map_parse",
    """SELECT event_id, CASE WHEN event_id % 23 <> 0 THEN user_id::DOUBLE END AS map_key,
        CASE WHEN event_id % 23 <> 0 THEN value + 1 END AS map_value,
        CASE WHEN event_id % 23 <> 0 THEN event_id + 0.5::DOUBLE END AS next_key,
        CASE WHEN event_id % 23 <> 0 THEN value END AS next_value,
        CASE WHEN event_id % 23 <> 0 THEN 2 END::INTEGER AS keys, (props::JSON ->> 'k')::DOUBLE AS k
    FROM events""",
)
def json_map_parse(spark, folder):
    """Maps of two numbers, the first given twice in two spellings, and a key that is no number."""
    value, user = F.col("value"), F.col("user_id")
    pairs = (
        (user, value), (F.col("event_id") + 0.5, value), (F.lit("n/a"), value),
        (F.concat(user, F.lit(".0")), value + 1),
    )
    parts = [F.concat(F.lit('"'), k, F.lit('": '), v) for k, v in pairs]
    numbers = F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))
    text = F.when(F.col("event_id") % 23 != 0, numbers).otherwise("{bad")
    parsed = table(spark, folder, "events").select(
        "event_id",
        json_number_map(text).alias("numbers"),
        F.from_json("props", "map<string,double>").alias("named"),
    )
    return parsed.select(
        "event_id",
        F.get(F.map_keys("numbers"), F.lit(0)).alias("map_key"),
        F.get(F.map_values("numbers"), F.lit(0)).alias("map_value"),
        F.get(F.map_keys("numbers"), F.lit(1)).alias("next_key"),
        F.get(F.map_values("numbers"), F.lit(1)).alias("next_value"),
        F.cardinality(F.map_keys("numbers")).alias("keys"),
        F.try_element_at("named", F.lit("k")).alias("k"),
    )


@query(
    "decode_utf8",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS time, octet_length(encode('µ' || event_type))
        AS bytes, 'µ' || event_type AS text FROM events""",
)
def decode_utf8(spark, folder):
    coded = table(spark, folder, "events").select(
        "event_id",
        F.encode(F.col("ts").cast("string"), "UTF-8").alias("time_bytes"),
        F.encode(F.concat(F.lit("µ"), F.col("event_type")), "UTF-8").alias("text_bytes"),
    )
    return coded.select(
        "event_id",
        iso_text(utf8_text(F.col("time_bytes")).try_cast("timestamp")).alias("time"),
        F.octet_length("text_bytes").cast("bigint").alias("bytes"),
        utf8_text(F.col("text_bytes")).alias("text"),
    )


@query(
    "rings_to_wkt",
    """WITH c AS (SELECT c_custkey AS k, c_nationkey AS n FROM customer),
    r AS (SELECT k, '(' || n || ' ' || k || ', ' || (n + 4) || ' ' || k || ', ' || (n + 4) || ' '
            || (k + 4) || ', ' || n || ' ' || k || ')' AS outer_ring,
        '(' || n || '.5 ' || (k + 1) || ', ' || (n + 2) || ' ' || (k + 1) || '.25, '
            || (n + 1) || ' ' || k || ', ' || n || '.5 ' || (k + 1) || ')' AS hole FROM c)
    SELECT k AS region, CASE WHEN k % 10 = 9 THEN 'POLYGON EMPTY'
        WHEN k % 3 = 0 THEN 'POLYGON (' || outer_ring || ', ' || hole || ')'
        ELSE 'POLYGON (' || outer_ring || ')' END AS polygon,
        'MULTIPOLYGON ((' || outer_ring || '), (' || hole || '))' AS multipolygon
    FROM r""",
)
def rings_to_wkt(spark, folder):
    """A triangle at each customer, some with a hole, some with no ring at all."""
    n, k = F.col("c_nationkey").cast("double"), F.col("c_custkey").cast("double")

    def ring(*points):
        return F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in points])

    outer = ring((n, k), (n + 4, k), (n + 4, k + 4), (n, k))
    hole = ring((n + 0.5, k + 1), (n + 2, k + 1.25), (n + 1, k), (n + 0.5, k + 1))
    key = F.col("c_custkey")
    rings = F.when(key % 10 == 9, F.slice(F.array(outer), 1, 0)).when(
        key % 3 == 0, F.array(outer, hole)
    ).otherwise(F.array(outer))
    return table(spark, folder, "customer").select(
        key.alias("region"),
        polygon_wkt(rings).alias("polygon"),
        multipolygon_wkt(F.array(F.array(outer), F.array(hole))).alias("multipolygon"),
    )


@query(
    "reduce_whitespace",
    r"""SELECT doc_id, CASE WHEN n_chars % 2 = 0
        THEN trim(regexp_replace(text, '[ \t\r\n]+', ' ', 'g')) ELSE text END AS text
    FROM documents""",
)
def reduce_whitespace(spark, folder):
    wanted = F.col("n_chars") % 2 == 0
    return table(spark, folder, "documents").select(
        "doc_id", squeeze_whitespace(F.col("text"), wanted).alias("text")
    )


@query(
    "match_all_limit",
    "SELECT doc_id, text, lang, source, n_chars FROM documents ORDER BY doc_id LIMIT 5",
)
def match_all_limit(spark, folder):
    return first_documents(table(spark, folder, "documents"), "doc_id")


SEARCHED = "That inesea, mentoi!"


def _bm25_sql(*terms):
    tf = ", ".join(f"len(list_filter(w, lambda x: x = '{t}')) AS tf{i}" for i, t in enumerate(terms))
    df = ", ".join(f"count(*) FILTER (tf{i} > 0) AS df{i}" for i in range(len(terms)))
    score = " + ".join(
        f"ln(1 + (n - df{i} + 0.5) / (df{i} + 0.5)) * tf{i} * 2.2::DOUBLE"
        f" / (tf{i} + 1.2::DOUBLE * (1 - 0.75::DOUBLE + 0.75::DOUBLE * dl / mean_dl))"
        for i in range(len(terms))
    )
    some = " + ".join(f"tf{i}" for i in range(len(terms)))
    return rf"""WITH s AS (SELECT doc_id, list_filter(
            regexp_split_to_array(lower(text || ' ' || source), '[^\p{{L}}\p{{N}}]+'),
            lambda x: x <> '') AS w FROM documents),
        f AS (SELECT doc_id, len(w) AS dl, {tf} FROM s),
        c AS (SELECT count(*) AS n, avg(dl) AS mean_dl, {df} FROM f)
    SELECT doc_id, round(score, 6) AS score FROM (
        SELECT doc_id, {score} AS score FROM f, c WHERE {some} > 0)
    ORDER BY score DESC, doc_id LIMIT 10"""


@query("search_bm25", _bm25_sql("that", "inesea", "mentoi"))
def search_bm25(spark, folder):
    found = bm25(table(spark, folder, "documents"), SEARCHED, "doc_id", ["text", "source"])
    return found.withColumn("score", F.round("score", 6))
