"""The match run from raw invoices and movements, and the training dataset made of it."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hashing
from ..operators import audit, dataset, entries, features, history, matching

#: Columns that tell the target to a model.
LEAKS = ("matched_entry", "accounts", "account_natures", "target", "state", "score", "reasons")


@dataclass(frozen=True)
class Run:
    """The frames of a match run, each lazy: what is not used is not computed."""

    invoices: DataFrame
    movements: DataFrame
    entries: DataFrame
    scored: DataFrame
    matches: DataFrame

    @cached_property
    def rows(self) -> DataFrame:
        """Every invoice with its match, target and is_ok."""
        return dataset.model_rows(self.invoices, self.matches)

    @cached_property
    def history(self) -> DataFrame:
        return history.line_history(self.matches, self.movements, self.invoices)

    @cached_property
    def profile(self) -> DataFrame:
        return history.ratio_profile(self.history)

    @cached_property
    def quality(self) -> DataFrame:
        return audit.quality_summary(self.invoices, self.entries, self.scored, self.matches)

    @cached_property
    def counters(self) -> DataFrame:
        fc = entries.invoice_movements(self.movements)
        return audit.quality_counters(self.invoices, self.movements, fc, self.entries, None, self.matches, self.rows)

    @cached_property
    def coverage(self) -> DataFrame:
        return matching.coverage(self.matches)

    def training(self, predictors: list[str] = features.PREDICTORS) -> DataFrame:
        return dataset.training_rows(self.rows, predictors)

    def published(self, predictors: list[str] = features.PREDICTORS) -> DataFrame:
        """The training rows with the columns that their contract asks for."""
        more = self.rows.select("xml_id", F.lit(1).cast("smallint").alias("extractor_version"), F.lower("key").alias("key"), "state", F.col("matched_entry").alias("entry"), "total")
        return self.training([c for c in predictors if c != "total"]).join(more, "xml_id")

    def audit(self, columns: list[str] | None = None) -> DataFrame:
        """The column audit of the model rows; arrays are left out."""
        plain = [c for c, kind in self.rows.dtypes if not kind.startswith(("array", "struct", "map"))]
        return audit.column_audit(self.rows, columns or plain, LEAKS)


def match_run(invoices: DataFrame, movements: DataFrame, pair_missing: bool = True, dealt: bool = False) -> Run:
    """Raw invoices and movements (``schemas.INVOICES``, ``schemas.MOVEMENTS``) to resolved matches: one lazy plan.

    Shuffles: movements by their entry's year and number (not if they already lie by number, ``dealt``), invoices and tiles of entries by tax id, a row for each of their meetings by invoice.
    """
    own, moves = features.invoice_features(invoices), features.movement_features(movements)
    found = entries.entries(entries.invoice_movements(moves), dealt)
    scored = matching.candidates(own, found, pair_missing)
    return Run(own, moves, found, scored, matching.match(own, found, pair_missing))


def generate_dataset(
    spark: SparkSession, invoices: DataFrame, movements: DataFrame, client: str, source: str, path: str, parameters: str = "", predictors: list[str] = features.PREDICTORS, current: DataFrame | None = None
) -> tuple[str, int]:
    """Match, take the training rows and publish them: ("PUBLICADA" or "YA_EXISTE", version).

    Both sources must have rows and unique keys.  The version is identified by client, source,
    parameters, the code's hash and the hashes of both sources and of the rows.

    With ``current`` (xml_id, extractor_version, key, date of the current invoices) the published
    rows also have key, state, entry and total, and are only published if they meet their contract
    and the view; ``invoices`` has ``key`` then.
    """
    dataset.require(invoices, "xml_id")
    dataset.require(movements, "movement_id")
    run = match_run(invoices, movements)
    rows = run.training(predictors) if current is None else run.published(predictors)
    identity = {
        "client": client,
        "source": source.strip().upper(),
        "invoices_hash": hashing.frame_hash(invoices, "xml_id").first()["hash"],
        "movements_hash": hashing.frame_hash(movements, "movement_id").first()["hash"],
        "code_hash": hashing.code_hash(Path(__file__).parent.parent / "operators"),
        "parameters": parameters,
    }
    return dataset.publish(spark, rows, identity, path, current=current, universe=None if current is None else invoices.count())
