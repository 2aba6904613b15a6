"""Pixels, class numbers and the linear classifier."""

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from ..functions.pixels import gray_planes, normalize_planes, resize
from ..operators.learn import (
    class_index, class_means, evaluate, loss_gradient, predict, predict_linear, train_head,
)
from ..plans.classifier import train_and_validate
from ..sources.images import read_labelled_images
from ..workspace import workspace
from .registry import query
from .tables import table

# An embedding's 64 numbers, scaled to bytes, serve as a grey picture of 8 x 8.
PIXELS = "list_transform(embedding, lambda x: greatest(0, least(255, floor((x::DOUBLE + 1) * 127.5::DOUBLE))))"


def _pixels():
    scaled = lambda x: F.floor((x.cast("double") + 1) * 127.5)
    return F.transform(
        "embedding", lambda x: F.greatest(F.lit(0), F.least(F.lit(255), scaled(x))).cast("int")
    )


def _millionths(numbers):
    """Whole millionths as text: the same digits in every engine."""
    return F.array_join(
        F.transform(numbers, lambda x: F.round(x * 1000000).cast("bigint").cast("string")), ","
    )


def _as_picture(pixels):
    """Spark's ``image`` struct for one grey 8 x 8 picture."""
    digits = F.transform(pixels, lambda x: F.lpad(F.hex(x), 2, "0"))
    return F.struct(
        F.lit("").alias("origin"), F.lit(8).alias("height"), F.lit(8).alias("width"),
        F.lit(1).alias("nChannels"), F.lit(0).alias("mode"),
        F.unhex(F.array_join(digits, "")).alias("data"),
    )


@query(
    "class_to_index",
    """SELECT doc_id, source, CAST(dense_rank() OVER (ORDER BY source) - 1 AS INTEGER)
        AS class_index FROM documents""",
)
def class_to_index(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "source")
    numbered = class_index(documents, "source").transform(documents)
    return numbered.withColumn("class_index", F.col("class_index").cast("int"))


def _normalized_sql():
    planes = ((0.485, 0.229), (0.456, 0.224), (0.406, 0.225))
    parts = [
        f"list_transform(p, lambda x: round((x / 255.0::DOUBLE - {m}::DOUBLE) / {s}::DOUBLE * 1000000)"
        "::BIGINT::VARCHAR)"
        for m, s in planes
    ]
    joined = f"list_concat(list_concat({parts[0]}, {parts[1]}), {parts[2]})"
    return f"""SELECT vec_id, array_to_string({joined}, ',') AS planes
        FROM (SELECT vec_id, {PIXELS} AS p FROM embeddings)"""


@query("channel_normalize", _normalized_sql())
def channel_normalize(spark, folder):
    pictures = table(spark, folder, "embeddings").select("vec_id", _pixels().alias("pixels"))
    planes = normalize_planes(gray_planes(F.col("pixels")))
    return pictures.select("vec_id", _millionths(planes).alias("planes"))


@query(
    "resize_images",
    f"""WITH p AS (SELECT vec_id, {PIXELS} AS p FROM embeddings),
    taps AS (SELECT o, i, greatest(0, 1 - abs((i + 0.5::DOUBLE) - (o + 0.5::DOUBLE) * 2) / 2) AS w
        FROM range(4) a(o), range(8) b(i)),
    weights AS (SELECT o, i, w / sum(w) OVER (PARTITION BY o) AS w FROM taps),
    px AS (SELECT vec_id, unnest(p) AS x, generate_subscripts(p, 1) - 1 AS n FROM p),
    sums AS (SELECT vec_id, r.o AS r, c.o AS c, sum(x * r.w * c.w) AS x
        FROM px JOIN weights r ON r.i = n // 8 AND r.w > 0
            JOIN weights c ON c.i = n % 8 AND c.w > 0 GROUP BY ALL),
    plane AS (SELECT vec_id,
        string_agg(round(x * 1000000)::BIGINT::VARCHAR, ',' ORDER BY r, c) AS plane
        FROM sums GROUP BY vec_id)
    SELECT vec_id, plane || ',' || plane || ',' || plane AS planes FROM plane""",
)
def resize_images(spark, folder):
    """Pictures halved in both directions, as red, green and blue planes."""
    pictures = table(spark, folder, "embeddings").select(
        "vec_id", _as_picture(_pixels()).alias("image")
    )
    small = resize(F.col("image"), 4, 4, whole_pixels=False)
    return pictures.select("vec_id", _millionths(small).alias("planes"))


def _sets(spark, folder):
    """Training and validation rows, four to one."""
    vectors = table(spark, folder, "embeddings")
    held_out = F.col("vec_id") % 5 == 0
    return vectors.where(~held_out), vectors.where(held_out)


@query(
    "linear_head_train",
    """SELECT label::INTEGER AS class_index, count(*) AS rows, 0.0::DOUBLE AS gradient
    FROM embeddings WHERE vec_id % 5 <> 0 GROUP BY 1""",
)
def linear_head_train(spark, folder):
    """The stored head is at the optimum: per class, the loss's gradient over all training rows."""
    training, _ = _sets(spark, folder)
    path = workspace(spark, "head")
    train_head(training, "embedding", "label").write().overwrite().save(path)
    scored = predict(PipelineModel.load(path), training, "embedding")
    return loss_gradient(scored, "embedding", "label").withColumn("gradient", F.round("gradient", 5))


CLASS_MEANS = """WITH x AS (SELECT vec_id, label::INTEGER AS label, unnest(embedding)::DOUBLE AS x,
        generate_subscripts(embedding, 1) AS i FROM embeddings),
    means AS (SELECT label AS k, i, avg(x) AS m FROM x WHERE vec_id % 5 <> 0 GROUP BY ALL),
    scores AS (SELECT vec_id, label, k, sum(x * m - m * m / 2) AS s FROM x JOIN means USING (i) GROUP BY ALL),
    chances AS (SELECT *, ln(sum(exp(s)) OVER v) - s AS loss, row_number() OVER (v ORDER BY s DESC, k) AS place
        FROM scores WINDOW v AS (PARTITION BY vec_id)),
    rated AS (SELECT vec_id, CASE WHEN vec_id % 5 = 0 THEN 'validation' ELSE 'train' END AS part, label,
        min(k) FILTER (place = 1) AS prediction, min(loss) FILTER (k = label) AS loss
        FROM chances GROUP BY ALL)"""


def _nearest(spark, folder):
    """All rows with the class whose mean over the training rows is nearest."""
    training, validation = _sets(spark, folder)
    rows = training.withColumn("part", F.lit("train")).unionByName(
        validation.withColumn("part", F.lit("validation"))
    )
    return predict_linear(class_means(training, "embedding", "label"), rows, "embedding")


@query("class_means_predict", f"{CLASS_MEANS} SELECT vec_id, part, label, prediction FROM rated")
def class_means_predict(spark, folder):
    return _nearest(spark, folder).select(
        "vec_id", "part", F.col("label").cast("int").alias("label"),
        F.col("prediction").cast("int").alias("prediction"),
    )


@query(
    "class_means_eval",
    f"""{CLASS_MEANS} SELECT part, count(*) AS rows,
        round(100 * avg((prediction = label)::INTEGER), 6) AS accuracy, round(sum(loss), 4) AS loss
    FROM rated GROUP BY 1""",
)
def class_means_eval(spark, folder):
    rated = evaluate(_nearest(spark, folder), "label", ["part"])
    return rated.withColumns({"accuracy": F.round("accuracy", 6), "loss": F.round("loss", 4)})


# The head of a bitmap file of 4 x 4 pixels in three channels, lines from the bottom up.
BITMAP = "424d66000000000000003600000028000000040000000400000001001800000000003000000000000000" + "00" * 12
PICTURES_A_TASK = 250  # files that a task creates one after another
BYTES = "list_transform(embedding[1:48], lambda x: greatest(0, least(127, floor((x::DOUBLE + 1) * 63.5)))::INTEGER)"


def _plane(channel):
    return f"list_transform(range(16), lambda i: p[{channel} + 3 * i] * 1000000)"


@query(
    "labelled_pictures",
    f"""WITH b AS (SELECT label, {BYTES} AS p FROM embeddings)
    SELECT 'class_name=' || label AS class_name, 4::INTEGER AS height, 4::INTEGER AS width,
        3::INTEGER AS channels, array_to_string(list_concat({_plane(3)}, {_plane(2)}, {_plane(1)}), ',')
        AS planes FROM b""",
)
def labelled_pictures(spark, folder):
    """A picture file per embedding in its class folder, read back as red, green and blue planes.

    No byte is above 127, so Spark's text writer can write the files. The root bears the name of a class.
    Files are dealt evenly over tasks, however few splits the table has, and every task moves its own
    to their place (version 2 of the committer), not the driver those of all.
    """
    root = f"{workspace(spark, 'pictures')}/class_name=3"
    scaled = lambda x: F.floor((x.cast("double") + 1) * 63.5)
    pixels = F.transform(
        F.slice("embedding", 1, 48), lambda x: F.greatest(F.lit(0), F.least(F.lit(127), scaled(x)))
    )
    digits = F.transform(pixels, lambda x: F.lpad(F.hex(x), 2, "0"))
    lines = [F.array_join(F.slice(digits, first, 12), "") for first in (37, 25, 13, 1)]
    embeddings = table(spark, folder, "embeddings")
    files = embeddings.select(
        F.col("label").alias("class_name"),
        F.unhex(F.concat(F.lit(BITMAP), *lines)).cast("string").alias("file"),
    ).repartition(embeddings.count() // PICTURES_A_TASK + 1)
    writer = files.write.option("mapreduce.fileoutputcommitter.algorithm.version", 2)
    writer.partitionBy("class_name").option("maxRecordsPerFile", 1).text(root)
    pictures = read_labelled_images(spark, root, "*.txt").where(F.col("reason").isNull())
    planes = resize(F.col("image"), 4, 4, whole_pixels=False)
    return pictures.select(
        "class_name", "image.height", "image.width", F.col("image.nChannels").alias("channels"),
        _millionths(planes).alias("planes"),
    )


def _scored(spark, folder):
    training, validation = _sets(spark, folder)
    model = train_head(training, "embedding", "label")
    rows = training.withColumn("part", F.lit("train")).unionByName(
        validation.withColumn("part", F.lit("validation"))
    )
    return predict(model, rows, "embedding")


@query("linear_head_predict")
def linear_head_predict(spark, folder):
    return _scored(spark, folder).select(
        "vec_id", "part", "label", F.col("prediction").cast("int").alias("prediction")
    )


@query("linear_head_eval")
def linear_head_eval(spark, folder):
    return evaluate(_scored(spark, folder), "label", ["part"])


@query("classifier_layer")
def classifier_layer(spark, folder):
    """Train, store, load and validate on the held-out rows."""
    training, validation = _sets(spark, folder)
    path = workspace(spark, "classifier")
    return train_and_validate(training, validation, "embedding", "label", path)
