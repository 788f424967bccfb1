"""Template classifier: a pyspark.ml pipeline in place of the tabular AutoML of the domain."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import FeatureHasher, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from . import predictions


#: Features that may list several codes, of which a model reads the first.
CODES = ("industry_code",)


def prepare(rows: DataFrame, features: list[str]) -> DataFrame:
    """Text features trimmed with missing words to a mark of their own, codes up to their first semicolon, numbers with 0 for null."""
    kinds = dict(rows.dtypes)

    def of(c: str) -> Column:
        if kinds[c] != "string":
            return F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        value = text.leading_code(F.col(c)) if c in CODES else F.trim(F.col(c))
        return F.coalesce(F.when(~value.isin("", "nan", "None", "<NA>"), value), F.lit("?"))

    out = {c: of(c) for c in features}
    return rows.withColumns(out)


def fit(rows: DataFrame, features: list[str], label: str = "label", width: int = 1 << 12, rounds: int = 20) -> PipelineModel:
    """Hashed features and multinomial regression; the hash width bounds the model whatever the number of values."""
    stages = [
        StringIndexer(inputCol=label, outputCol="label_index", handleInvalid="keep"),
        FeatureHasher(inputCols=features, outputCol="features", numFeatures=width),
        LogisticRegression(featuresCol="features", labelCol="label_index", maxIter=rounds, regParam=0.01),
    ]
    return Pipeline(stages=stages).fit(prepare(rows, features))


def predict_top(model: PipelineModel, rows: DataFrame, features: list[str], n: int = 3) -> DataFrame:
    """``rows`` as they are with ``top``, the n likeliest labels with their probabilities; null if the whole vector isn't sane (three classes or more)."""
    labels = model.stages[0].labels
    names = F.array(*[F.lit(x) for x in labels])
    kept = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row"), *features)
    out = model.transform(prepare(kept, features)).withColumn("_all", vector_to_array("probability")).withColumn("_p", F.slice("_all", 1, len(labels)))
    whole = F.when(F.lit(len(labels) < 3) | predictions.sane(F.col("_all")), predictions.top(names, F.col("_p"), n))
    return out.select("_row.*", whole.alias("top"))


def save(model: PipelineModel, spark: SparkSession, path: str, features: list[str]) -> None:
    """The model and a manifest with the features that it was fitted on."""
    model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(i, f) for i, f in enumerate(features)], "at int, feature string").coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest")


def load(spark: SparkSession, path: str, features: list[str]) -> PipelineModel:
    """The model, if its manifest has exactly these features in this order."""
    known = [r["feature"] for r in spark.read.schema("at int, feature string").parquet(f"{path}/manifest").orderBy("at").collect()]
    if known != list(features):
        raise ValueError(f"the model was fitted on {known}")
    return PipelineModel.load(f"{path}/model")
