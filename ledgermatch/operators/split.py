"""Calendar split, trainable classes and oversampling."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def split_start(rows: DataFrame, day: str, fraction: float = 0.2, max_months: int = 2) -> DataFrame:
    """One row (test_start, n): the month from which rows are test rows.

    Whole months are taken from the last backwards until they hold ceil(fraction x n) rows,
    ``max_months`` of them at most.  Only months with their counts meet in one task.
    """
    months = rows.where(F.col(day).isNotNull()).groupBy(F.trunc(day, "MM").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy()
    back = Window.orderBy(F.col("month").desc())
    months = months.withColumns(
        {
            "total": F.sum("n").over(whole),
            "taken": F.sum("n").over(back.rowsBetween(Window.unboundedPreceding, 0)),
            "ago": F.months_between(F.max("month").over(whole), F.col("month")).cast("int"),
        }
    )
    enough = F.col("taken") >= F.ceil(F.col("total") * fraction)
    recent = months.where(F.col("ago") < max_months)
    cut = F.coalesce(F.max(F.when(enough, F.col("month"))), F.min("month"))
    return recent.agg(cut.alias("test_start"), F.max("total").alias("n"))


def temporal_split(rows: DataFrame, day: str, fraction: float = 0.2, max_months: int = 2) -> DataFrame:
    """Rows with a column ``part``: train or test.  The cut is one row and is broadcast."""
    cut = split_start(rows, day, fraction, max_months)
    return rows.crossJoin(F.broadcast(cut.select("test_start"))).withColumn("part", F.when(F.col(day) >= F.col("test_start"), "test").otherwise("train")).drop("test_start")


def trainable(rows: DataFrame, label: str, least: int = 2) -> DataFrame:
    """Rows whose class has at least ``least`` rows."""
    common = rows.groupBy(label).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least).select(label)
    return rows.join(common, label, "left_semi")


def oversample(rows: DataFrame, day: str, cut: date, factor: int) -> DataFrame:
    """Rows from ``cut`` on ``factor`` times, earlier ones once; ``copy`` numbers them."""
    times = F.when(F.col(day) >= F.lit(cut), factor).otherwise(1)
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), times)))


def accuracy(scored: DataFrame) -> DataFrame:
    """One row of measures from rows (label, known, majority, top array of labels).

    Accuracy, top-3 accuracy, accuracy over known classes (null without any) and that of the
    majority class.
    """
    hit = lambda c: F.avg(c.cast("double"))
    first = F.col("top")[0] == F.col("label")
    return scored.agg(
        F.count(F.lit(1)).alias("n"),
        hit(first).alias("accuracy"),
        hit(F.array_contains("top", F.col("label"))).alias("top3_accuracy"),
        hit(F.when(F.col("known"), first)).alias("known_accuracy"),
        hit(F.col("label") == F.col("majority")).alias("majority_accuracy"),
    )


def class_counts(rows: DataFrame, label: str) -> DataFrame:
    return rows.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def majority(rows: DataFrame, label: str) -> DataFrame:
    """One row: the most frequent class, ties to the smallest."""
    return class_counts(rows, label).agg(F.min_by(label, F.struct(-F.col("n"), F.col(label))).alias("majority"))


def partition_report(parts: DataFrame, known: DataFrame, key: str = "xml_id", date: str = "date") -> DataFrame:
    """(key, date, part, trainable) of every row, by key: which part of a split it is in, and whether its class was trained on."""
    fed = known.select(key).distinct().withColumn("trainable", F.lit(True))
    return parts.select(key, date, "part").join(fed, key, "left").na.fill(False, ["trainable"]).orderBy(key)
