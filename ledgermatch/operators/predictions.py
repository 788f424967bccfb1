"""Top predictions, their contract, and idempotent registration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import hashing, numbers, text

#: The one version of the extractor, and the longest name of a model.
EXTRACTOR, NAME_LENGTH = 1, 120
HASHES = ("model_hash", "manifest_hash", "feature_hash")
CONTENT = ("extractor_version", "dataset_version", "model_name", "manifest_hash", "feature_hash")
#: Difference of probabilities up to which two registrations are the same.
TOLERANCE = 1e-6
SUM_TOLERANCE = 1e-4
REVIEW = {"PENDIENTE": ("APROBADA", "CORREGIDA", "RECHAZADA"), "APROBADA": (), "CORREGIDA": (), "RECHAZADA": ()}


def sane(probabilities: Column) -> Column:
    """Finite, within [0, 1], summing to 1, three classes or more?"""
    within = F.forall(probabilities, lambda p: p.isNotNull() & ~F.isnan(p) & p.between(0, 1))
    total = F.aggregate(probabilities, F.lit(0.0), lambda s, p: s + p)
    return F.coalesce(within & (F.size(probabilities) >= 3) & (F.abs(total - 1) <= SUM_TOLERANCE), F.lit(False))


def top(labels: Column, probabilities: Column, n: int = 3) -> Column:
    """The n likeliest (label, probability), likeliest first; ties keep the order of classes."""
    pairs = F.transform(F.arrays_zip(labels.alias("label"), probabilities.alias("p")), lambda e, i: F.struct((-e["p"]).alias("np"), i.alias("i"), e["label"].alias("label"), e["p"].alias("p")))
    return F.transform(F.slice(F.array_sort(pairs), 1, n), lambda e: F.struct(e["label"].alias("label"), numbers.probability(e["p"]).alias("probability")))


def feature_hash(features: dict[str, Column]) -> Column:
    return hashing.row_hash(features)


def contract_error() -> Column:
    """The first part of its contract that a prediction breaks, or null.

    Columns: client_id, xml_id, extractor_version, dataset_version, model_name, three hashes
    and ``top``, an array of (label, probability).
    """
    known = lambda c: F.coalesce(F.col(c) > 0, F.lit(False))
    name = text.blank_to_null(F.col("model_name"))
    labels = F.transform("top", lambda e: text.blank_to_null(e["label"]))
    named = (F.size("top") == 3) & F.forall(labels, lambda x: x.isNotNull()) & (F.size(F.array_distinct(F.transform("top", lambda e: e["label"]))) == 3)
    falling = (F.col("top")[0]["probability"] >= F.col("top")[1]["probability"]) & (F.col("top")[1]["probability"] >= F.col("top")[2]["probability"])
    within = F.forall("top", lambda e: e["probability"].isNotNull() & e["probability"].between(0, 1))
    hashes = hashing.is_hex(F.lower(F.trim("model_hash")), 64) & hashing.is_hex(F.lower(F.trim("manifest_hash")), 64) & hashing.is_hex(F.lower(F.trim("feature_hash")), 64)
    return (
        F.when(~(known("client_id") & known("xml_id") & known("dataset_version") & F.coalesce(F.col("extractor_version") == EXTRACTOR, F.lit(False))), "ids")
        .when(name.isNull() | (F.length(name) > NAME_LENGTH), "model name")
        .when(~hashes, "hashes")
        .when(~F.coalesce(named, F.lit(False)), "labels")
        .when(~F.coalesce(within & falling, F.lit(False)), "probabilities")
    )


def register(batch: DataFrame, stored: DataFrame, datasets: DataFrame, invoices: DataFrame, trained: DataFrame) -> DataFrame:
    """``outcome`` of each prediction (REGISTRADA, YA_EXISTE, CONFLICTO or RECHAZADA) and the ``reason`` of a rejection.

    ``batch`` and ``stored`` have the columns of ``contract_error``, each (xml_id, model_hash)
    once; ``datasets`` dataset_version, client_id and created_at; ``invoices`` the current ones
    with client_id, xml_id and extracted_at; ``trained`` dataset_version and xml_id.  A stored
    prediction is the same if all its columns are and each probability differs by no more than
    the tolerance.  What a dataset was trained on, or saw when it was made, gets no prediction.
    """
    clean = lambda df: df.withColumns({c: F.lower(F.trim(c)) for c in HASHES} | {"model_name": F.trim("model_name")})
    key = ["xml_id", "model_hash"]
    old = clean(stored).select(*key, F.struct(*CONTENT, "top").alias("_old"))
    owners = datasets.select("dataset_version", F.col("client_id").alias("_owner"), "created_at")
    current = invoices.select("client_id", "xml_id", "extracted_at")
    used = trained.select("dataset_version", "xml_id").distinct().withColumn("_trained", F.lit(True))
    joined = clean(batch.withColumn("reason", contract_error())).join(old, key, "left").join(owners, "dataset_version", "left")
    joined = joined.join(current, ["client_id", "xml_id"], "left").join(used, ["dataset_version", "xml_id"], "left")
    close = lambda a, b: (a["label"] == b["label"]) & (F.abs(a["probability"].cast("decimal(18,12)") - b["probability"].cast("decimal(18,12)")) <= F.lit(TOLERANCE).cast("decimal(18,12)"))
    same = F.forall(F.zip_with("top", "_old.top", close), lambda x: F.coalesce(x, F.lit(False)))
    for c in CONTENT:
        same = same & F.col(c).eqNullSafe(F.col(f"_old.{c}"))
    owned = F.coalesce(F.col("_owner") == F.col("client_id"), F.lit(False))
    fresh = F.when(F.col("extracted_at").isNull(), "no current invoice").when(F.col("_trained"), "trained").when(F.col("extracted_at") <= F.col("created_at"), "historical")
    reason = F.coalesce("reason", F.when(~owned, "dataset of another client"), F.when(F.col("_old").isNull(), fresh))
    outcome = F.when(F.col("reason").isNotNull(), "RECHAZADA").when(F.col("_old").isNull(), "REGISTRADA").when(same, "YA_EXISTE").otherwise("CONFLICTO")
    return joined.withColumn("reason", reason).withColumn("outcome", outcome).drop("_old", "_owner", "created_at", "extracted_at", "_trained")


def pending(extracted: DataFrame, trained: DataFrame, predicted: DataFrame, model_hash: str, since: Column, limit: int | None = None) -> DataFrame:
    """Extracted documents after the snapshot that were neither trained on nor predicted by this model, by id."""
    done = predicted.where(F.col("model_hash") == model_hash).select("xml_id")
    out = extracted.where(F.col("extracted_at") > since).join(trained.select("xml_id"), "xml_id", "left_anti").join(done, "xml_id", "left_anti")
    return out.orderBy("xml_id").limit(limit) if limit is not None else out


def may_move(before: Column, after: Column) -> Column:
    """Is a change of review state allowed?"""
    out = F.lit(False)
    for state, to in REVIEW.items():
        out = out | ((before == state) & after.isin(*to)) if to else out
    return out


def review_form() -> Column:
    """Has a review event the values that its state asks for, and no others?  Columns: state, option, corrected, reviewer, at."""
    signed = text.blank_to_null(F.col("reviewer")).isNotNull() & F.col("at").isNotNull()
    plain = F.col("option").isNull() & F.col("corrected").isNull()
    good = (
        F.when(F.col("state") == "APROBADA", signed & F.col("option").between(1, 3) & F.col("corrected").isNull())
        .when(F.col("state") == "CORREGIDA", signed & F.col("option").isNull() & text.blank_to_null(F.col("corrected")).isNotNull())
        .when(F.col("state") == "RECHAZADA", signed & plain)
        .when(F.col("state") == "PENDIENTE", plain & F.col("reviewer").isNull() & F.col("at").isNull())
    )
    return F.coalesce(good, F.lit(False))


def review(events: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """``events`` with the state ``before`` each and its ``outcome``: APLICADA, INVALIDA (its form) or ILEGAL (its state doesn't follow).

    A prediction starts as PENDIENTE.  Rejected events change nothing.  As every state but the first is
    final, the state before an event is the first applicable one ahead of it: a running window, whatever the number of events.
    """
    applicable = review_form() & may_move(F.lit("PENDIENTE"), F.col("state"))
    ahead = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.first(F.when(applicable, F.col("state")), ignorenulls=True).over(ahead), F.lit("PENDIENTE"))
    marked = events.withColumn("before", before)
    return marked.withColumn("outcome", F.when(~review_form(), "INVALIDA").when(may_move(F.col("before"), F.col("state")), "APLICADA").otherwise("ILEGAL"))


def review_state(reviewed: DataFrame, key: list[str]) -> DataFrame:
    """The state of each prediction after its events."""
    return reviewed.groupBy(*key).agg(F.coalesce(F.max(F.when(F.col("outcome") == "APLICADA", F.col("state"))), F.lit("PENDIENTE")).alias("state"))
