from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

import __spark_entry__ as entry
from airstrata.catalog.features import PICTURES_A_TASK
from airstrata.functions.pixels import gray_planes, normalize_planes, resize
from airstrata.operators.learn import (
    class_index, class_means, evaluate, loss_gradient, predict, predict_linear, train_head,
)
from airstrata.workspace import shared_folder


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 4))
    noise = rng.normal(size=(300, 3)) * 2
    y = (x @ rng.normal(size=(4, 3)) + noise).argmax(axis=1)
    return x, y


def frame(spark, points):
    rows = [(i, row.tolist(), int(label)) for i, (row, label) in enumerate(zip(*points))]
    return spark.createDataFrame(rows, "id int, v array<float>, label int")


def test_head_reaches_the_optimum_of_the_loss(spark, points, tmp_path):
    x, y = points
    x = x.astype(np.float32).astype(float)
    df = frame(spark, points)
    path = str(tmp_path / "head")
    train_head(df, "v", "label").write().overwrite().save(path)
    model = PipelineModel.load(path)
    w, b = model.stages[0].coefficientMatrix.toArray(), model.stages[0].interceptVector.toArray()
    logits = x @ w.T + b
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    gradient = (p - np.eye(3)[y]).T @ x / len(x)
    assert np.abs(gradient).max() < 1e-3

    scored = predict(model, df, "v")
    got = {r.id: (r.prediction, r.probabilities) for r in scored.collect()}
    assert all(got[i][0] == p[i].argmax() for i in range(len(x)))
    assert np.allclose([got[i][1] for i in range(len(x))], p)
    result = evaluate(scored, "label").first()
    assert result.rows == 300
    assert abs(result.accuracy - 100 * (p.argmax(axis=1) == y).mean()) < 1e-9
    assert abs(result.loss + np.log(p[np.arange(len(y)), y]).sum()) < 1e-6


def test_gradient_tells_an_optimum_from_another_head(spark, points):
    df = frame(spark, points)
    best = loss_gradient(predict(train_head(df, "v", "label"), df, "v"), "v", "label").collect()
    assert max(r.gradient for r in best) < 1e-4
    assert {r.class_index: r.rows for r in best} == dict(enumerate(np.bincount(points[1])))
    means = predict_linear(class_means(df, "v", "label"), df, "v")
    assert max(r.gradient for r in loss_gradient(means, "v", "label").collect()) > 1e-2


def test_unfinished_training_fails(spark, points):
    with pytest.raises(RuntimeError, match="no optimum"):
        train_head(frame(spark, points), "v", "label", epochs=2)


def test_nearest_mean(spark, points):
    x, y = points[0].astype(np.float32).astype(float), points[1]
    df = frame(spark, points)
    means = np.stack([x[y == k].mean(axis=0) for k in range(3)])
    away = ((x[:, None] - means) ** 2).sum(axis=2)
    chances = np.exp(-away / 2) / np.exp(-away / 2).sum(axis=1, keepdims=True)
    got = predict_linear(class_means(df, "v", "label"), df, "v").orderBy("id").collect()
    assert [r.prediction for r in got] == away.argmin(axis=1).tolist()
    assert np.allclose([r.probabilities for r in got], chances)


def test_evaluate_counts_rows_not_batches(spark):
    df = spark.createDataFrame(
        [("a", 0, 0.0, [1.0, 0.0]), ("a", 1, 0.0, [0.75, 0.25]), ("b", 1, 1.0, [0.5, 0.5])],
        "part string, label int, prediction double, probabilities array<double>",
    )
    got = {r.part: (r.rows, r.accuracy, r.loss) for r in evaluate(df, "label", ["part"]).collect()}
    assert got["a"] == (2, 50.0, pytest.approx(-np.log(0.25)))
    assert got["b"] == (1, 100.0, pytest.approx(np.log(2)))


def test_classes_are_numbered_in_name_order(spark):
    df = spark.createDataFrame([("grass",), ("dandelion",), ("grass",), ("grass",)], "name string")
    model = class_index(df, "name")
    assert model.labels == ["dandelion", "grass"]
    assert [r.class_index for r in model.transform(df).collect()] == [1.0, 0.0, 1.0, 1.0]


def test_normalised_planes(spark):
    df = spark.createDataFrame([([0, 255, 51],)], "p array<int>")
    got = df.select(normalize_planes(gray_planes(F.col("p"))).alias("x")).first().x
    x = np.array([0, 1, 0.2])
    wanted = [(x - m) / s for m, s in zip((0.485, 0.456, 0.406), (0.229, 0.224, 0.225))]
    assert np.allclose(got, np.concatenate(wanted))


IMAGE = "image struct<origin:string,height:int,width:int,nChannels:int,mode:int,data:binary>"


def picture(grid):
    height, width, channels = grid.shape
    return (("", height, width, channels, 0, grid.astype(np.uint8).tobytes()),)


def slow_resize(plane, height, width):
    """Direct sum over every source pixel."""
    def weights(old, new, o):
        scale = old / new
        reach = max(scale, 1.0)
        w = [max(0.0, 1 - abs((i + 0.5) - (o + 0.5) * scale) / reach) for i in range(old)]
        return [v / sum(w) for v in w]

    out = np.zeros((height, width))
    for r in range(height):
        for c in range(width):
            for i, wi in enumerate(weights(plane.shape[0], height, r)):
                for j, wj in enumerate(weights(plane.shape[1], width, c)):
                    out[r, c] += wi * wj * plane[i, j]
    return out


@pytest.mark.parametrize("channels", [1, 3, 4])
@pytest.mark.parametrize("size", [(3, 2), (9, 11), (6, 7)])
def test_resize(spark, channels, size):
    grid = np.random.default_rng(channels).integers(0, 256, (6, 7, channels))
    df = spark.createDataFrame([picture(grid)], IMAGE)
    got = df.select(resize(F.col("image"), *size, whole_pixels=False).alias("x")).first().x
    order = [0, 0, 0] if channels == 1 else [2, 1, 0]
    wanted = np.stack([slow_resize(grid[..., c], *size) for c in order])
    assert np.allclose(np.reshape(got, wanted.shape), wanted)
    rounded = df.select(resize(F.col("image"), *size).alias("x")).first().x
    assert np.abs(np.array(rounded) - wanted.ravel()).max() <= 0.5 + 1e-9


def test_unreadable_picture_gives_null(spark):
    df = spark.createDataFrame([(("", -1, -1, -1, -1, None),), (None,)], IMAGE)
    assert [r.x for r in df.select(resize(F.col("image"), 2, 2).alias("x")).collect()] == [None, None]


def test_pictures_are_dealt_over_tasks(spark, tmp_path):
    """600 pictures in one split are written by several tasks, each a file of its own."""
    rows = [(i, [(i % 200 - 100) / 100 + k / 1000 for k in range(64)], i % 3) for i in range(600)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    frame.coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    shared = Path(shared_folder(spark))
    before = set(shared.glob("airstrata/pictures-*"))
    found = entry.queries()["labelled_pictures"](spark, str(tmp_path))
    assert found.count() == 600
    (made,) = set(shared.glob("airstrata/pictures-*")) - before
    files = [f.name for f in made.rglob("*.txt")]
    tasks = Counter(name.split("-")[1] for name in files)
    assert len(files) == 600 and len(tasks) > 1 and max(tasks.values()) <= 2 * PICTURES_A_TASK
