"""Reports, status history, and an outbox with delays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def report(df: DataFrame, path: str, form: str = "csv", order: list[str] | None = None) -> None:
    """A report as CSV with header or as JSON lines, its files and rows by ``order``; arrays and structs become JSON text in CSV."""
    df = df.orderBy(*order) if order else df
    if form == "json":
        df.write.mode("overwrite").json(path)
        return
    flat = [F.to_json(c).alias(c) if kind.startswith(("array", "struct", "map")) else F.col(c) for c, kind in df.dtypes]
    df.select(*flat).write.mode("overwrite").option("header", True).csv(path)


def status_history(before: DataFrame, after: DataFrame, key: str, at: Column) -> DataFrame:
    """(key, from, to, at) for every key whose state has changed, or is new."""
    old = before.select(key, F.col("state").alias("from_state"))
    joined = after.select(key, F.col("state").alias("to_state")).join(old, key, "left")
    return joined.where(~F.col("from_state").eqNullSafe(F.col("to_state"))).withColumn("at", at)


def outbox(rows: DataFrame, columns: list[str], delay_s: int, now: Column) -> DataFrame:
    """Messages (value, available_at) of schema version 1 that may be read after a delay."""
    value = F.to_json(F.struct(F.lit(1).alias("schemaVersion"), *columns))
    return rows.select(value.alias("value"), (now.cast("timestamp") + F.make_interval(secs=F.lit(delay_s))).alias("available_at"))
