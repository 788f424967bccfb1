"""Invoices and movements from the supplied orders and lineitem tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import entries, matching


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tax_id(split: bool, entry: bool = False):
    """The customer as tax id; ``split`` gives each eight ids by order key, so that ids have few entries, and every tenth order's entries an id without invoices."""
    customer = F.col("o_custkey").cast("string")
    if not split:
        return customer
    part = (F.col("o_orderkey") % 8).cast("string")
    return F.concat(customer, F.lit("-"), F.when(F.col("o_orderkey") % 10 == 3, "9").otherwise(part) if entry else part)


def invoices(spark: SparkSession, sf_dir: str, split: bool = False) -> DataFrame:
    """An order is an invoice: customer = tax id, order key = number."""
    nit, number = _tax_id(split), F.col("o_orderkey").cast("string")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("xml_id"), nit.alias("nit"), number.alias("invoice"), F.to_date("o_orderdate").alias("date"), F.col("o_totalprice").alias("total"), matching.invoice_key(nit, number).alias("invoice_key")
    )


def movements(spark: SparkSession, sf_dir: str, split: bool = False) -> DataFrame:
    """A line is a movement of the entry (ship year, FC, order key): debit on odd lines, credit on even ones.  Every line takes part.

    Lines meet their order by its key as text, so that they lie by their document's number from there on.
    """
    lines = table(spark, sf_dir, "lineitem")
    owner = table(spark, sf_dir, "orders").select("o_orderkey", _tax_id(split, entry=True).alias("third_id"))
    odd = F.col("l_linenumber") % 2 == 1
    amount = F.col("l_extendedprice").cast("decimal(19,4)")
    number = F.col("l_orderkey").cast("string")
    date = F.to_date("l_shipdate")
    return lines.join(owner, number == F.col("o_orderkey").cast("string")).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("movement_id"),
        date.alias("date"),
        F.lit("FC").alias("doc_type"),
        number.alias("doc_number"),
        F.concat(F.lit("51"), (F.col("l_partkey") % 10).cast("string")).alias("account"),
        "third_id",
        F.concat(F.lit("factura "), number).alias("concept"),
        F.when(odd, amount).otherwise(F.lit(0).cast("decimal(19,4)")).alias("debit"),
        F.when(odd, F.lit(0).cast("decimal(19,4)")).otherwise(amount).alias("credit"),
        entries.entry_key(F.year(date), F.lit("FC"), number).alias("entry_key"),
    )


def ledger(spark: SparkSession, sf_dir: str, split: bool = False) -> DataFrame:
    return entries.entries(entries.invoice_movements(movements(spark, sf_dir, split)), dealt=True)


def scored(spark: SparkSession, sf_dir: str, split: bool = False) -> DataFrame:
    return matching.candidates(invoices(spark, sf_dir, split), ledger(spark, sf_dir, split))


def matched(spark: SparkSession, sf_dir: str, split: bool = False, accepted_only: bool = False) -> DataFrame:
    return matching.match(invoices(spark, sf_dir, split), ledger(spark, sf_dir, split), accepted_only=accepted_only)
