"""Jobs over published data: train and evaluate, validate a run, predict what is pending."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dataset, features, matching, model, predictions, split
from .pipeline import Run


def train(spark: SparkSession, path: str, version: int, model_path: str, predictors: list[str] = features.PREDICTORS, fraction: float = 0.2, max_months: int = 2, recent_months: int = 0, factor: int = 1, least: int = 2, **fit) -> DataFrame:
    """Fit on the months before the test months of a published version, save the model; returns its measures on the test rows.

    With ``recent_months`` the training rows of that many months before the test months count
    ``factor`` times.  Classes with fewer than ``least`` training rows are left out, and two
    must remain.
    """
    rows = dataset.read_version(spark, path, version)
    cut = split.split_start(rows, "date", fraction, max_months).first()["test_start"]
    parts = split.temporal_split(rows, "date", fraction, max_months)
    known = split.trainable(parts.where("part = 'train'"), "label", least)
    classes = split.class_counts(known, "label")
    if classes.limit(2).count() < 2:
        raise ValueError("fewer than two classes to train on")
    fed = known
    if recent_months and factor > 1:
        since = spark.range(1).select(F.add_months(F.lit(cut), -recent_months).alias("d")).first()["d"]
        fed = split.oversample(known, "date", since, factor).drop("copy")
    fitted = model.fit(fed, predictors, **fit)
    model.save(fitted, spark, model_path, predictors)
    best = split.majority(known, "label").first()["majority"]
    test = model.predict_top(fitted, parts.where("part = 'test'"), predictors).withColumn("top", F.transform("top", lambda e: e["label"]))
    seen = classes.select("label", F.lit(True).alias("known"))
    return split.accuracy(test.join(seen, "label", "left").withColumns({"known": F.coalesce("known", F.lit(False)), "majority": F.lit(best)}))


def validate(run: Run, reference: DataFrame | None = None) -> dict[str, DataFrame]:
    """Coverage by state and, with a reference run of unique keys, where both agree: counts by (side, same_state, same_entry)."""
    out = {"coverage": run.coverage}
    if reference is not None:
        both = matching.compare(run.matches, dataset.require(reference, "invoice_key"))
        out["comparison"] = both.groupBy("side", "same_state", "same_entry").agg(F.count(F.lit(1)).alias("n"))
    return out


def predict(spark: SparkSession, model_path: str, invoices: DataFrame, trained: DataFrame, stored: DataFrame, identity: dict, since, limit: int | None = None, predictors: list[str] = features.PREDICTORS) -> DataFrame:
    """Predictions for pending invoices, with the outcome of registering each.

    ``identity`` has the model's client_id, dataset_version, model_name, model_hash and
    manifest_hash.  ``invoices`` has ``extracted_at``; pending are those extracted after
    ``since``, when the dataset was made, that were neither trained on nor predicted by this
    model.  Rows whose three best labels break their contract are rejected.
    """
    fitted = model.load(spark, model_path, predictors)
    known = {c: F.lit(identity[c]) for c in ("client_id", "dataset_version", "model_name", "model_hash", "manifest_hash")}
    todo = predictions.pending(features.invoice_features(invoices), trained, stored, identity["model_hash"], F.lit(since), limit)
    hashed = todo.withColumn("feature_hash", predictions.feature_hash({c: F.col(c).cast("string") for c in predictors}))
    out = model.predict_top(fitted, hashed, predictors).select("xml_id", "top", "feature_hash", F.lit(predictions.EXTRACTOR).alias("extractor_version"), *[v.alias(c) for c, v in known.items()])
    datasets = spark.range(1).select(known["dataset_version"].alias("dataset_version"), known["client_id"].alias("client_id"), F.lit(since).alias("created_at"))
    current = invoices.select(known["client_id"].alias("client_id"), "xml_id", "extracted_at")
    return predictions.register(out, stored, datasets, current, trained.select(known["dataset_version"].alias("dataset_version"), "xml_id"))
