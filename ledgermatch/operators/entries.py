"""Ledger movements to ledger entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text

ENTRY_KEY = ("entry_year", "doc_type", "doc_number")
#: Decimal places of money in sums: exact in any order, cast to double once.
MONEY = "decimal(19,4)"


def invoice_movements(movements: DataFrame, kind: str = "fc") -> DataFrame:
    """Movements whose document type is the one of invoices."""
    # Written without binding, so that it vanishes from the plan for a type that is a constant.
    return movements.where(F.regexp_replace(F.lower(text.strip_marks(F.col("doc_type"))), "[^a-z0-9]", "") == kind)


def nature(debit: Column, credit: Column) -> Column:
    """DC, D, C or N by which of the amounts are above 0."""
    d, c = F.coalesce(debit > 0, F.lit(False)), F.coalesce(credit > 0, F.lit(False))
    return F.when(d & c, "DC").when(d, "D").when(c, "C").otherwise("N")


def template_label(accounts: Column) -> Column:
    """A set as text: ('a', 'b'), with a comma after a single element, () if empty or null."""
    inner = F.concat(F.lit("('"), F.array_join(accounts, "', '"), F.when(F.size(accounts) == 1, "',)").otherwise("')"))
    return F.when(F.coalesce(F.size(accounts), F.lit(0)) > 0, inner).otherwise("()")


def entry_key(year: Column, doc_type: Column, number: Column) -> Column:
    """year|type|number with "-1" for no year and nothing for other nulls."""
    return F.concat(F.coalesce(year.cast("string"), F.lit("-1")), F.lit("|"), F.coalesce(doc_type, F.lit("")), F.lit("|"), F.coalesce(number, F.lit("")))


def _distinct(values: Column) -> Column:
    """Without nulls and repeats, in order."""
    return F.array_except(values, F.array(F.lit(None).cast("string")))


def commonest(values: Column) -> Column:
    """The most frequent value of a short array, the smallest of several; nulls don't count."""
    found = _distinct(values)
    often = F.array_min(F.transform(found, lambda v: F.struct((-F.size(F.filter(values, lambda x: x == v))).alias("n"), v.alias("v"))))["v"]
    return F.when(F.size(found) > 1, often).otherwise(F.get(found, F.lit(0)))


def entries(movements: DataFrame, dealt: bool = False) -> DataFrame:
    """One row per (year, type, number), nulls being a value of their own.

    Lines are dealt by year and number, unless they already lie by number (``dealt``), as after a join on it.

    The row order that first values and joined texts depend on is (date, movement_id).  An
    entry's lines are one accounting document, so its arrays are short.
    """
    present = ~text.is_missing(F.col("account"))
    name = F.trim("account")
    line = F.struct(
        F.col("date").isNull().alias("undated"), "date", "movement_id", text.collapse(F.col("concept")).alias("concept"), "third_id", F.when(present, name).alias("account"),
        F.when(present, F.concat_ws("_", name, nature(F.col("debit"), F.col("credit")))).alias("account_nature"),
    )
    rows = movements.select(F.year("date").alias("entry_year"), "doc_type", "doc_number", "date", F.col("debit").cast(MONEY).alias("debit"), F.col("credit").cast(MONEY).alias("credit"), line.alias("line"))
    # Dealt by parts of their key first, as lists made before a shuffle save nothing.
    grouped = (rows if dealt else rows.repartition("entry_year", "doc_number")).groupBy(*ENTRY_KEY).agg(
        F.min("date").alias("entry_date"),
        F.sum("debit").cast("double").alias("debit"),
        F.sum("credit").cast("double").alias("credit"),
        F.count(F.lit(1)).alias("lines"),
        F.sort_array(F.collect_list("line")).alias("of"),
    )
    grouped = grouped.select(
        *ENTRY_KEY, "entry_date", commonest(F.col("of.third_id")).alias("third_id"), F.nullif(F.array_join(F.array_distinct("of.concept"), " | "), F.lit("")).alias("concept"),
        "debit", "credit", F.sort_array(_distinct(F.col("of.account"))).alias("accounts"), F.sort_array(_distinct(F.col("of.account_nature"))).alias("account_natures"), "lines",
    )
    key = entry_key(F.col("entry_year"), F.col("doc_type"), F.col("doc_number"))
    return grouped.withColumns({"amount": F.greatest("debit", "credit"), "entry_key": key, "concept_key": text.alnum_key(F.col("concept"))})
