"""Small helpers shared by the operators of this subpackage."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.rows import quoted
from ..workspace import workspace


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Later steps start from files that outlive any executor, and a result that is
    used twice is computed once.
    """
    path = workspace(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Only ``doc_id`` and ``text`` of the given columns; NULL text stays NULL."""
    return docs.select(quoted(id_column).alias("doc_id"), quoted(text_column).alias("text"))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def utf8_bytes(column: str = "text"):
    """The text as UTF-8 bytes; NULL as empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))
