"""An index of words on disk: kept up with each delivery of documents, read for a query's words only.

Below its folder, ``postings/bucket=.../sequence=.../`` has a row per word and document, sorted by word
within a bucket that follows from the word; ``lengths``, ``replaced`` and ``summary`` have a
folder per sequence: the documents with their number of words, the ids that replaced an
earlier document, and by how much the delivery changed the number of documents and words. A
search reads the buckets of its words, the replaced ids and the few summary rows - never texts nor lengths.
"""

from zlib import crc32

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.text import NON_WORD
from ..sinks.layers import write_layer
from ..workspace import workspace
from .rows import quoted
from .search import query_words

BUCKETS = 256
ID = "id"
FIELDS = {
    "postings": f"term string, {ID} string, tf long, length long, bucket long, sequence long",
    "lengths": f"{ID} string, length long, sequence long",
    "replaced": f"{ID} string, sequence long",
    "summary": "documents long, words long, sequence long",
}


def _read(spark: SparkSession, root: str, part: str) -> DataFrame:
    try:
        return spark.read.schema(FIELDS[part]).parquet(f"{root}/{part}")
    except Exception as missing:  # nothing is indexed yet
        if getattr(missing, "getCondition", lambda: "")() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FIELDS[part])


def _write(rows: DataFrame, root: str, part: str, sequence: int, folders=("sequence",), cluster=()) -> None:
    write_layer(rows.withColumn("sequence", F.lit(sequence)), f"{root}/{part}", folders, cluster, touched_only=True)


def add_documents(
    docs: DataFrame, root: str, sequence: int, id_column: str, text_columns: list[str], buckets: int = BUCKETS
) -> None:
    """Index a delivery; its documents replace those of the same id that came with a lower ``sequence``.

    The number of the store's version serves well as sequence. A delivery that is indexed again under its
    number, with the same documents, changes nothing; deliveries are to be indexed in the order of their numbers. Ids are kept as
    text and must not repeat within a delivery. Texts are read and cut once; the words of a
    document are counted by the task that reads it, before they are shuffled to their buckets. Of the index only ids and
    lengths are read.
    """
    spark = docs.sparkSession
    body = F.lower(F.concat_ws(" ", *[quoted(c) for c in text_columns]))
    words = F.filter(F.split(body, NON_WORD), lambda w: w != "")
    cut = workspace(spark, "words")
    docs.select(quoted(id_column).cast("string").alias(ID), words.alias("words")).select(
        ID, F.size("words").cast("long").alias("length"), "words"
    ).write.parquet(cut)
    texts = spark.read.schema(f"{ID} string, length long, words array<string>").parquet(cut)
    lengths = texts.select(ID, "length")
    earlier = _current(spark, root, sequence)
    replaced = workspace(spark, "replaced")
    lengths.select(ID).join(earlier, ID).select(ID, "length").write.parquet(replaced)
    old = spark.read.schema(f"{ID} string, length long").parquet(replaced)
    added = lengths.agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("w")).first()
    gone = old.agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("w")).first()

    counted = texts.select(ID, "length", F.explode("words").alias("term")).groupBy("term", ID, "length")
    rows = counted.agg(F.count("*").alias("tf")).withColumn("bucket", F.crc32(F.encode("term", "UTF-8")) % buckets)
    _write(rows.select("term", ID, "tf", "length", "bucket"), root, "postings", sequence, ("bucket", "sequence"), ("term",))
    _write(lengths, root, "lengths", sequence)
    _write(old.select(ID), root, "replaced", sequence)
    change = spark.createDataFrame([(added.n - gone.n, added.w - gone.w)], "documents long, words long")
    _write(change, root, "summary", sequence)


def _current(spark: SparkSession, root: str, before: int) -> DataFrame:
    """id and length of the documents that stood before a sequence."""
    lengths = _read(spark, root, "lengths").where(F.col("sequence") < before)
    replaced = _read(spark, root, "replaced").where(F.col("sequence") < before)
    return _standing(lengths, replaced).select(ID, "length")


def _standing(rows: DataFrame, replaced: DataFrame) -> DataFrame:
    """Rows of documents that no later delivery replaced."""
    last = replaced.groupBy(F.col(ID).alias("gone")).agg(F.max("sequence").alias("until"))
    later = (F.col(ID) == F.col("gone")) & (F.col("until") > F.col("sequence"))
    return rows.join(last, later, "left_anti")


def search(
    spark: SparkSession,
    root: str,
    queries: dict[str, str],
    k: int = 10,
    buckets: int = BUCKETS,
    k1: float = 1.2,
    b: float = 0.75,
) -> DataFrame:
    """query, id, score: for each of the named queries its ``k`` best documents by Okapi BM25.

    All queries are answered in one pass over the buckets of their words. Postings of
    documents that were replaced do not count. The hits of a word are spread over
    tasks by document; per query every task first keeps its own ``k`` best. Ties go to
    the smaller id, as text.
    """
    words = {name: query_words(text) for name, text in queries.items()}
    terms = sorted({t for found in words.values() for t in found})
    if not terms:
        return spark.createDataFrame([], f"query string, {ID} string, score double")
    wanted = spark.createDataFrame([(n, t) for n, found in words.items() for t in found], "query string, term string")
    places = sorted({crc32(t.encode()) % buckets for t in terms})
    hits = _read(spark, root, "postings").where(F.col("bucket").isin(places) & F.col("term").isin(terms))
    hits = _standing(hits, _read(spark, root, "replaced")).select("term", ID, "tf", "length")
    rarity = hits.groupBy("term").agg(F.count("*").alias("df"))
    corpus = _read(spark, root, "summary").agg(
        F.struct(F.sum("documents").alias("documents"), (F.sum("words") / F.sum("documents")).alias("mean"))
    )
    idf = F.log(1 + (F.col("_corpus.documents") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = k1 * (1 - b + b * F.col("length") / F.col("_corpus.mean"))
    scored = (
        hits.join(rarity, "term")
        .withColumn("_corpus", corpus.scalar())
        .withColumn("part", idf * F.col("tf") * (k1 + 1) / (F.col("tf") + norm))
        .join(wanted, "term")
        .groupBy("query", ID)
        .agg(F.sum("part").alias("score"))
    )
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), ID))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank")
