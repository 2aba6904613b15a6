"""Ranked text search over a table of documents."""

import re

from pyspark.sql import DataFrame, functions as F

from ..functions.text import NON_WORD
from ..workspace import workspace
from .rows import quoted


def first_documents(df: DataFrame, id_column: str, n: int = 5) -> DataFrame:
    """The first ``n`` documents by id; a top-n per task, then among those."""
    return df.orderBy(quoted(id_column)).limit(n)


def query_words(query: str) -> list[str]:
    """Distinct lower-case words of a query, in order."""
    return list(dict.fromkeys(re.findall(r"[^\W_]+", query.lower())))


def word_counts(df: DataFrame, terms: list[str], id_column: str, text_columns: list[str]):
    """Per document its number of words, and how often each term is one of them.

    The text is cut once, into words each between two blanks of its own, so that
    counting is replacing and comparing lengths; no array of words is built.
    """
    body = F.concat_ws(" ", *[quoted(c) for c in text_columns])
    spaced = F.trim(F.regexp_replace(F.lower(body), NON_WORD, "  "))
    cut = df.select(quoted(id_column), F.concat(F.lit(" "), spaced, F.lit(" ")).alias("_text"))
    empty = F.length("_text") == 2

    def removed(part: str):
        return F.length("_text") - F.length(F.replace("_text", F.lit(part), F.lit("")))

    return cut.select(
        quoted(id_column),
        F.when(empty, 0).otherwise((removed(" ") / 2).cast("int")).alias("_length"),
        *[
            (removed(f" {t} ") / (len(t) + 2)).cast("int").alias(f"_tf{i}")
            for i, t in enumerate(terms)
        ],
    )


def bm25(
    df: DataFrame,
    query: str,
    id_column: str,
    text_columns: list[str],
    k: int = 10,
    k1: float = 1.2,
    b: float = 0.75,
) -> DataFrame:
    """The ``k`` best documents by Okapi BM25 over all ``text_columns`` together.

    The text is read and cut once and never shuffled: its counts - an id and a
    few numbers per document - are written to the shared folder when this is
    called. The corpus figures are one aggregate over them, read back as a
    scalar subquery, and the ranking ends in a distributed top-k.
    """
    terms = query_words(query)
    if not terms:
        return df.select(quoted(id_column), F.lit(0.0).alias("score")).where(F.lit(False))
    spark = df.sparkSession
    stored = workspace(spark, "word-counts")
    # Rebalanced, so that many scan tasks do not leave as many tiny files.
    word_counts(df, terms, id_column, text_columns).hint("rebalance").write.parquet(stored)
    counts = spark.read.parquet(stored)

    corpus = counts.agg(
        F.struct(
            F.count("*").alias("documents"),
            F.avg("_length").alias("mean_length"),
            *[F.count_if(F.col(f"_tf{i}") > 0).alias(f"df{i}") for i in range(len(terms))],
        )
    )
    found, score = F.lit(False), F.lit(0.0)
    for i in range(len(terms)):
        tf, df_i = F.col(f"_tf{i}"), F.col(f"_corpus.df{i}")
        idf = F.log(1 + (F.col("_corpus.documents") - df_i + 0.5) / (df_i + 0.5))
        norm = k1 * (1 - b + b * F.col("_length") / F.col("_corpus.mean_length"))
        found, score = found | (tf > 0), score + idf * tf * (k1 + 1) / (tf + norm)
    return (
        counts.where(found)
        .withColumn("_corpus", corpus.scalar())
        .select(quoted(id_column), score.alias("score"))
        .orderBy(F.desc("score"), quoted(id_column))
        .limit(k)
    )
