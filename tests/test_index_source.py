"""Writing into an index as one commit."""

import json
import os
from pathlib import Path

import pytest

from airstrata.sinks import index_source
from airstrata.sinks.index_source import FolderIndex, read_published, write_documents

from test_sinks import docs


PICKY = "picky_index:Picky"


@pytest.fixture(scope="module", autouse=True)
def transport(spark):
    """The tasks import the transport by its name."""
    spark.sparkContext.addPyFile(str(Path(__file__).with_name("picky_index.py")))


def some(spark, n):
    return docs(spark, *[(f"k{i}", "2025-03-01", 1, float(i)) for i in range(n)]).repartition(4)


def published(spark, path):
    return {r.id: json.loads(r.body)["valeur"] for r in read_published(spark, path).collect()}


def test_commits(spark, tmp_path):
    path = str(tmp_path / "index")
    assert published(spark, path) == {}
    write_documents(some(spark, 9), path)
    assert published(spark, path) == {f"k{i}": float(i) for i in range(9)}
    write_documents(some(spark, 3).selectExpr("concat('m', doc_id) AS doc_id", "valeur"), f"file://{path}", writers=1)
    assert len(published(spark, path)) == 12
    commits = {(r.commit, r.id[0]) for r in read_published(spark, path).collect()}
    assert len(commits) == 2


@pytest.mark.parametrize("writers, files", [(1, 1), (3, 3)])
def test_writers_are_bounded(spark, tmp_path, writers, files):
    path = str(tmp_path / "index")
    write_documents(some(spark, 40), path, writers=writers)
    assert len(os.listdir(f"{path}/staged")) == files
    assert len(published(spark, path)) == 40


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "index")
    write_documents(some(spark, 2), path)
    with pytest.raises(Exception, match="too high"):
        write_documents(some(spark, 9), path, transport=PICKY)
    assert published(spark, path) == {"k0": 0.0, "k1": 1.0}
    listed = {json.loads(line)["file"] for name in os.listdir(f"{path}/published") if name.endswith("json")
              for line in open(f"{path}/published/{name}")}
    assert set(os.listdir(f"{path}/staged")) == listed


def test_tolerated_refusals(spark, tmp_path):
    path = str(tmp_path / "index")
    write_documents(some(spark, 6), path, transport=PICKY, refusals=10)
    assert published(spark, path) == {"k0": 0.0, "k1": 1.0, "k2": 2.0}


def test_nothing_to_write(spark, tmp_path):
    path = str(tmp_path / "index")
    write_documents(some(spark, 3).limit(0), path)
    assert published(spark, path) == {}


def test_staged_files_of_a_lost_job_are_not_read(spark, tmp_path):
    path = str(tmp_path / "index")
    write_documents(some(spark, 2), path)
    index = FolderIndex({"path": path})
    index.send(index.begin("lost"), [("x", '{"valeur": 1}')])
    assert set(published(spark, path)) == {"k0", "k1"}


def test_a_remote_folder_needs_a_transport(spark):
    with pytest.raises(ValueError):
        index_source.local_path("s3a://bucket/index")
