import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from samples import FIELDS, FOLDER, odd_texts  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    """A table of odd texts, with repeated rows and columns of clashing names."""
    rows = [(i * 3, t, "en" if i % 2 else None, "s", 0) for i, t in enumerate(odd_texts())]
    rows += [rows[7], rows[9]]
    df = spark.createDataFrame(rows, FIELDS)
    for name in ("fp", "mark", "core", "place", "u", "v", "part", "score", "ids"):
        df = df.selectExpr("*", f"'x' AS {name}")
    return df.repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], FIELDS)


@pytest.fixture(scope="session")
def table(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")
