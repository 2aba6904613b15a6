"""A linear classifier on given features."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StringIndexer, StringIndexerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

FEATURES = "_features"


def class_index(df: DataFrame, column: str) -> StringIndexerModel:
    """Class names numbered from zero in name order; the model keeps the names only."""
    return StringIndexer(
        inputCol=column, outputCol="class_index", stringOrderType="alphabetAsc"
    ).fit(df)


def with_features(df: DataFrame, column: str) -> DataFrame:
    """Add the vector the classifier reads."""
    return df.withColumn(FEATURES, array_to_vector(F.col(column)))


def train_head(
    df: DataFrame, features: str, label: str, epochs: int = 100, depth: int = 2
) -> PipelineModel:
    """Linear layer with cross-entropy loss on frozen features.

    That is an unpenalised multinomial logistic regression. Gradients are
    summed across executors in a tree of ``depth``; raise it for very many tasks.
    Fails where ``epochs`` steps end before the optimum is reached.
    """
    head = LogisticRegression(
        featuresCol=FEATURES, labelCol=label, family="multinomial", regParam=0.0,
        maxIter=epochs, aggregationDepth=depth, standardization=False,
    )
    rows = with_features(df, features).select(FEATURES, F.col(label).cast("double").alias(label))
    model = Pipeline(stages=[head]).fit(rows)
    if model.stages[0].summary.totalIterations >= epochs:
        raise RuntimeError(f"no optimum after {epochs} steps: raise epochs")
    return model


def class_means(df: DataFrame, features: str, label: str) -> DataFrame:
    """A closed-form head, the class whose mean is nearest: ``class_index``, ``intercept``, ``weights``.

    Expanding ``-|x - mean|^2 / 2`` gives a linear score but for a term that all classes share.
    """
    mean = vector_to_array(Summarizer.mean(array_to_vector(F.col(features))))
    means = df.groupBy(F.col(label).cast("int").alias("class_index")).agg(mean.alias("weights"))
    square = F.aggregate("weights", F.lit(0.0), lambda total, x: total + x * x)
    return means.select("class_index", (-square / 2).alias("intercept"), "weights")


def predict_linear(head: DataFrame, df: DataFrame, features: str) -> DataFrame:
    """As ``predict``, from a table of weights: a row per class, classes numbered from zero."""

    def score(row):
        products = F.zip_with(features, F.lit(list(row.weights)), lambda x, w: x.cast("double") * w)
        return F.aggregate(products, F.lit(row.intercept), lambda total, x: total + x)

    scores = F.array(*[score(row) for row in head.orderBy("class_index").collect()])
    scored = df.withColumn("probabilities", scores)
    above = F.transform("probabilities", lambda x: F.exp(x - F.array_max("probabilities")))
    scored = scored.withColumn("probabilities", above)
    total = F.aggregate("probabilities", F.lit(0.0), lambda total, x: total + x)
    scored = scored.withColumn("probabilities", F.transform("probabilities", lambda x: x / total))
    best = F.array_position("probabilities", F.array_max("probabilities")) - 1
    return scored.withColumn("prediction", best.cast("double"))


def predict(model: PipelineModel, df: DataFrame, features: str) -> DataFrame:
    """Add ``prediction`` and the class ``probabilities``."""
    scored = model.transform(with_features(df, features))
    return scored.withColumn("probabilities", vector_to_array("probability")).drop(
        FEATURES, "rawPrediction", "probability"
    )


def evaluate(predictions: DataFrame, label: str, by: list[str] = ()) -> DataFrame:
    """Rows, accuracy in percent of rows, and summed cross-entropy loss.

    A chance below 1e-300 counts as that, so the loss stays finite.
    """
    hit = (F.col("prediction") == F.col(label)).cast("double")
    chance = F.get("probabilities", F.col(label).cast("int"))
    return predictions.groupBy(*by).agg(
        F.count("*").alias("rows"),
        (100 * F.avg(hit)).alias("accuracy"),
        F.sum(-F.log(F.greatest(chance, F.lit(1e-300)))).alias("loss"),
    )


def loss_gradient(predictions: DataFrame, features: str, label: str) -> DataFrame:
    """Per class its rows and the largest component of the mean loss's gradient.

    The optimum of the loss is where all components are zero. Every task adds up its
    own rows, so one vector per class and task is shuffled.
    """
    own = F.col(label).cast("int")
    surplus = F.transform("probabilities", lambda p, k: p - (k == own).cast("double"))
    each = predictions.select(
        own.alias("_label"), F.col(features).alias("_x"),
        F.posexplode(surplus).alias("class_index", "_surplus"),
    )
    parts = F.transform("_x", lambda x: x.cast("double") * F.col("_surplus"))
    scaled = array_to_vector(F.concat(parts, F.array("_surplus")))
    sums = each.groupBy("class_index").agg(
        F.count_if(F.col("_label") == F.col("class_index")).alias("rows"),
        F.count("*").alias("_all"),
        vector_to_array(Summarizer.sum(scaled)).alias("_sums"),
    )
    largest = F.array_max(F.transform("_sums", F.abs)) / F.col("_all")
    return sums.select("class_index", "rows", largest.alias("gradient"))
