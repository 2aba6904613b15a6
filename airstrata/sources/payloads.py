"""JSON replies whose shape nobody knows beforehand, as typed tables.

Replies are parsed into variants. One aggregate over all records finds the type
of every field; where records disagree, the kind that most of them hold counts, and the
others become rejects with a reason. Nothing is dropped in silence.
"""

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.rows import split_rejects

NO_JSON = "no JSON"
NO_RECORD = "no record"
# Kinds of values that may stand for each other; a kind not named here is one of its own.
KINDS = {"BIGINT": "number", "DOUBLE": "number", "FLOAT": "number", "DECIMAL": "number"}


def read_records(
    spark: SparkSession, path, at: str = "$", whole_file: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(records, rejects): ``record`` is a variant that holds an object, ``fields`` its values by name.

    A reply is one line, or with ``whole_file`` a file, and holds an object or an array of objects
    at the path ``at``. An empty array has no records; blank replies are none. Rejects
    have ``text`` and ``reason``. A pass over either parses every reply once.
    """
    replies = spark.read.text(path, wholetext=whole_file).where(F.trim("value") != "")
    parsed = replies.select(F.col("value").alias("text"), F.try_parse_json("value").alias("reply"))
    inner = F.try_variant_get("reply", at, "variant")
    many = F.try_variant_get(inner, "$", "array<variant>")
    items = F.transform(
        F.coalesce(many, F.when(inner.isNotNull(), F.array(inner))),
        lambda v: F.struct(v.alias("record"), F.try_variant_get(v, "$", "map<string,variant>").alias("fields")),
    )
    found = parsed.select("text", "reply", (F.size(many) == 0).alias("none"), F.explode_outer(items).alias("item"))
    others = found.where(F.col("item.fields").isNull() & ~F.coalesce("none", F.lit(False)))
    rejects = others.select(
        F.coalesce(F.to_json("item.record"), "text").alias("text"),
        F.when(F.col("reply").isNull(), NO_JSON).otherwise(NO_RECORD).alias("reason"),
    )
    return found.where("item.fields IS NOT NULL").select("item.record", "item.fields"), rejects


def _value(name: str) -> Column:
    return F.try_element_at("fields", F.lit(name))


def _as_ddl(shape: str) -> str:
    """A variant's schema text as the type of a column: objects are structs, fractions doubles."""
    shape = re.sub(r"\bOBJECT<", "STRUCT<", shape)
    shape = re.sub(r"\bDECIMAL\(\d+, ?\d+\)", "DOUBLE", shape)
    return re.sub(r"\bVOID\b", "STRING", shape)


def _kind(shape: Column) -> Column:
    plain = F.regexp_extract(shape, "^([A-Z_]+)", 1)
    kind = plain
    for name, group in KINDS.items():
        kind = F.when(plain == name, F.lit(group)).otherwise(kind)
    return kind


def record_schema(records: DataFrame) -> T.StructType:
    """The fields of all records with their types, in the order of their names.

    A field whose records disagree has the kind that most of them hold (of equally many the first by
    name): numbers are ``bigint`` if none has a fraction, else ``double``; objects and arrays of
    such a field stay variants. A field that is always null is text.
    """
    shape = records.agg(F.schema_of_variant_agg("record")).first()[0]
    if not shape or not shape.startswith("OBJECT<"):
        return T.StructType()
    schema = T.DataType.fromDDL(_as_ddl(shape))
    unsettled = [f.name for f in schema.fields if isinstance(f.dataType, T.VariantType)]
    if not unsettled:
        return schema
    # One row per field and kind comes back.
    seen = (
        records.select(F.explode("fields").alias("name", "value"))
        .where(F.col("name").isin(unsettled) & ~F.is_variant_null("value"))
        .withColumn("shape", F.schema_of_variant("value"))
        .groupBy("name", _kind(F.col("shape")).alias("kind"))
        .agg(F.count("*").alias("rows"), F.bool_and(F.col("shape") == "BIGINT").alias("whole"))
        .collect()
    )
    best = {}
    for row in sorted(seen, key=lambda r: (r["rows"], [-ord(c) for c in r["kind"]])):
        best[row["name"]] = row
    return T.StructType([
        T.StructField(f.name, _settled(best[f.name])) if f.name in best else f for f in schema.fields
    ])


def _settled(row) -> T.DataType:
    if row["kind"] == "number":
        return T.LongType() if row["whole"] else T.DoubleType()
    if row["kind"] in ("OBJECT", "ARRAY"):
        return T.VariantType()
    return T.DataType.fromDDL(row["kind"])


def _fits(name: str, kind: T.DataType) -> Column:
    """Absent, null, or readable as the type. Text that spells a number is one; a variant field takes no scalars."""
    value = _value(name)
    absent = value.isNull() | F.is_variant_null(value)
    if isinstance(kind, T.VariantType):
        return absent | F.schema_of_variant(value).rlike("^(OBJECT|ARRAY)")
    return absent | F.try_variant_get(value, "$", kind.simpleString()).isNotNull()


def typed_records(records: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): one typed column per field; a record of which a field does not fit is a reject.

    A field that a record lacks is NULL; a field that the schema lacks is left out.
    """
    if not schema.fields:
        return records.select(), records.where(F.lit(False)).select(F.lit("").alias("text"), F.lit("").alias("reason"))
    rules = {f"{f.name} is no {f.dataType.simpleString()}": _fits(f.name, f.dataType) for f in schema.fields}
    good, bad = split_rejects(records, rules)
    rows = good.select(
        *[F.try_variant_get(_value(f.name), "$", f.dataType.simpleString()).alias(f.name) for f in schema.fields]
    )
    return rows, bad.select(F.to_json("record").alias("text"), "reason")


def read_payload(
    spark: SparkSession, path, at: str = "$", whole_file: bool = False, schema: T.StructType | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of landed JSON replies, typed by what they hold or by the given ``schema``.

    Without a schema the replies are read twice: once for the types, by one aggregate that every
    task reduces before it is shuffled (a second one only where records disagree), once for the rows.
    """
    records, rejects = read_records(spark, path, at, whole_file)
    rows, misfits = typed_records(records, schema if schema is not None else record_schema(records))
    return rows, rejects.unionByName(misfits)


def shape_of(records: DataFrame) -> DataFrame:
    """field, kind, rows: what the records hold under each name, NULLs apart."""
    fields = records.select(F.explode("fields").alias("field", "value"))
    return fields.groupBy("field", _kind(F.schema_of_variant("value")).alias("kind")).agg(F.count("*").alias("rows"))

