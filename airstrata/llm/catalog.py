"""The queries of this subpackage and the SQL some of them must agree with."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import line_rules, merkle, sql, substring_dedup, suffix_dedup
from .common import documents
from .decontamination import contamination
from .importance import resample
from .language import identify
from .packing import pack
from .quality import weak_label_quality
from .simhash import near_duplicates
from .token_counts import token_counts
from .token_files import token_files
from .winnowing import with_next

QUERIES = {}
ORACLES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def byte_bpe() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(documents(spark, folder))


@query
def op2_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    return with_next(documents(spark, folder))


@query
def op3_weak_label_quality(spark: SparkSession, folder: str) -> DataFrame:
    return weak_label_quality(documents(spark, folder))


@query
def op4_retrieval_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(documents(spark, folder), byte_bpe())


@query
def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files(documents(spark, folder), byte_bpe())


@query
def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.digest(documents(spark, folder))


@query
def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(documents(spark, folder), byte_bpe())


@query
def op8_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


@query
def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.digest(documents(spark, folder))


@query
def op10_nearest_centroid_language(spark: SparkSession, folder: str) -> DataFrame:
    return identify(documents(spark, folder)).select(
        "doc_id", "held_out", "lang_pred", "score", "rejected"
    )


@query
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.tampering(documents(spark, folder))


@query
def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    target = spark.read.parquet(f"{folder}/benchmark.parquet")
    return resample(documents(spark, folder), target).drop("n_words")


@query
def op13_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    return line_rules.digest(documents(spark, folder))


ORACLES |= {
    "op11_merkle_manifest": sql.MERKLE,
    "op12_importance_resampling": sql.IMPORTANCE,
    "op13_line_rules": sql.LINE_RULES,
}
