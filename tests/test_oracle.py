"""Every registered query against its SQL, over the whole smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import differences, duck

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


IN_PYTHON = {"resize_images", "labelled_pictures"}


def check_plan(name, df):
    """No pairing of all rows; Python only where no built-in exists, and in operators for text collections."""
    text = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text
    if name not in IN_PYTHON and not name.startswith("op"):
        assert "Python" not in text and "InPandas" not in text


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_agrees_with_sql(spark, connection, name):
    df = entry.queries()[name](spark, FOLDER)
    check_plan(name, df)
    assert differences(df, connection, entry.oracle_sql()[name]) == ""


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_query_without_sql_gives_rows(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert "doc_id" in df.columns and not df.isEmpty()
