"""Line histories of accepted matches, and profiles of their ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numbers, text
from .entries import MONEY, nature, template_label
from .matching import accepted


def line_history(matches: DataFrame, movements: DataFrame, invoices: DataFrame | None, dealt: bool = False) -> DataFrame:
    """Sums of an accepted entry's lines by account and nature, with their ratios to the invoice's total.

    ``movements`` has entry_key; the join is on that key.  With ``dealt`` they lie by doc_number, no number is null and no
    type holds "|": then the accepted entries go to their lines by the number in their key, and no line moves.
    Without ``invoices`` the matches have nit and total, as ``matching.match`` gives accepted ones.
    """
    own = matches.where(accepted(F.col("state"))).select("invoice_key", *([] if invoices is not None else ["nit", "total"]), F.col("matched_entry").alias("entry_key"), template_label(F.col("account_natures")).alias("template"))
    number = ["doc_number"] if dealt else []
    lines = movements.select(
        "entry_key", *number, "movement_id", F.concat_ws("_", F.trim("account"), nature(F.col("debit"), F.col("credit"))).alias("account_nature"), F.col("debit").cast(MONEY), F.col("credit").cast(MONEY), text.collapse(F.col("concept")).alias("concept")
    )
    if invoices is not None:
        own = own.join(invoices.select("invoice_key", "nit", "total"), "invoice_key")
    if dealt:
        # Two bounds instead of an equality of keys, by which the lines would be dealt anew.
        key, lines = F.col("_key"), lines.withColumnRenamed("entry_key", "_key")
        own = own.withColumn("_number", F.split("entry_key", r"\|", 3)[2])
        joined = own.join(lines, (F.col("_number") == F.col("doc_number")) & (F.col("entry_key") <= key) & (F.col("entry_key") >= key))
    else:
        joined = own.join(lines, "entry_key")
    grouped = joined.groupBy("invoice_key", "entry_key", *number, "nit", "total", "template", "account_nature").agg(
        F.sum("debit").cast("double").alias("debit"),
        F.sum("credit").cast("double").alias("credit"),
        F.min_by("concept", F.when(F.col("concept").isNotNull(), F.col("movement_id"))).alias("concept"),
        F.count(F.lit(1)).alias("lines"),
    )
    amount = F.greatest("debit", "credit")
    return grouped.drop(*number).withColumn("amount", amount).withColumn("ratio", numbers.ratio(F.col("amount"), F.col("total")))


def ratio_profile(history: DataFrame) -> DataFrame:
    """Median, mean, sample deviation (null for one value) and count of ratios by tax id, template and account."""
    clean = history.withColumn("ratio", F.when(~F.isnan("ratio"), F.col("ratio")))
    return clean.groupBy("nit", "template", "account_nature").agg(
        F.median("ratio").alias("ratio_median"), F.avg("ratio").alias("ratio_mean"), F.stddev_samp("ratio").alias("ratio_std"), F.count("ratio").alias("n")
    )
