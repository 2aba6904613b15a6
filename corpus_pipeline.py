"""A training corpus from the documents table: five stages, each one operator of airstrata.llm.

Every stage takes all that the one before kept, written as Parquet, and its decisions
take effect. All but the last return the columns of documents.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from airstrata.llm import decontamination, language, packing, simhash, suffix_dedup
from airstrata.llm.common import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Bytes that a passage of over 50 words nearly always has; figures are in the README.
PASSAGE = 250


def keyed(docs: DataFrame) -> DataFrame:
    """With ``row``, the id and a hash of the text: rows of one id that differ are told apart."""
    mark = F.hex(F.xxhash64("text"))
    return docs.withColumn("row", F.concat_ws("-", F.col("doc_id").cast("string"), mark))


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier tells; those that it rejects go."""
    rows, model = keyed(docs), language.fit(docs.where(~language.held_out()))
    named = language.predict(rows, model, "row").where(~F.col("rejected"))
    return rows.join(named.select(F.col("doc_id").alias("row")).distinct(), "row", "left_semi").select(COLUMNS)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: of the smallest id, then of the smallest hash of
    the text, then of the smallest other columns. An id that is NULL comes last."""
    rows = keyed(docs)
    marks = stored(simhash.fingerprints(rows, "row"), "simhash")
    id_ = F.expr("try_cast(regexp_extract(doc_id, '^(.+)-', 1) AS bigint)")
    order = F.struct(id_.isNull().alias("none"), id_.alias("id"), F.col("doc_id").alias("row"))
    first = simhash.groups(marks.select(order.alias("doc_id"), "fp")).select("component_id.row").distinct()
    # Every task reduces rows that repeat before they are shuffled.
    once = rows.groupBy("row").agg(F.min(F.struct(*COLUMNS)).alias("one"))
    return once.join(first, "row", "left_semi").select("one.*")


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of PASSAGE bytes that are found elsewhere too, in whole characters.

    A document with nothing left is dropped; texts from which nothing is cut stay as they are.
    """
    cut = suffix_dedup.without_repeats(docs, PASSAGE, carried=("lang", "source"), characters=True)
    return (
        cut.where(F.length("kept") > 0)
        .withColumn("text", F.col("kept").cast("string"))
        .withColumn("n_chars", F.length("text").cast("long"))
        .select(COLUMNS)
    )


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item; the others go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = keyed(docs)
    found = decontamination.contamination(rows, items, id_column="row")
    found = stored(found.select(F.col("doc_id").alias("row")).distinct(), "contaminated")
    return rows.join(found, "row", "left_anti").select(COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 ids, as pieces of documents."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language identification", identified),
    ("near duplicates", without_near_copies),
    ("suffix-array dedup", without_repeated_passages),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

# Classifier, fingerprints and ids cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
