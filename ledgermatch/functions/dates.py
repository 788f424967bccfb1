"""Dates as column expressions; formats that don't fit give null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _first(x: Column, patterns: dict[str, str]) -> Column:
    """The first format whose shape fits; the shape is tested first, as parsers are lenient."""
    text = F.trim(x)
    return F.coalesce(*(F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(form))) for form, shape in patterns.items()))


def listing_date(x: Column) -> Column:
    return _first(x, {"dd-MM-yyyy": r"^\d\d-\d\d-\d{4}$", "yyyy-MM-dd": r"^\d{4}-\d\d-\d\d$", "dd/MM/yyyy": r"^\d\d/\d\d/\d{4}$"}).cast("date")


def listing_datetime(x: Column) -> Column:
    """ISO with any offset dropped as text, or day first; to the second."""
    text = F.regexp_replace(F.regexp_replace(F.trim(x), r"(Z|[+-]\d\d:?\d\d)$", ""), r"\.\d+$", "")
    forms = {"yyyy-MM-dd'T'HH:mm:ss": r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d$", "yyyy-MM-dd HH:mm:ss": r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$", "dd-MM-yyyy HH:mm:ss": r"^\d\d-\d\d-\d{4} \d\d:\d\d:\d\d$", "dd/MM/yyyy HH:mm:ss": r"^\d\d/\d\d/\d{4} \d\d:\d\d:\d\d$"}
    return _first(text, forms)


def ledger_date(x: Column) -> Column:
    return _first(x, {"yyyy/MM/dd": r"^\d{4}/\d\d/\d\d$", "yyyy-MM-dd": r"^\d{4}-\d\d-\d\d$"}).cast("date")


def day_distance(a: Column, b: Column) -> Column:
    """Days between two instants: the signed difference is floored first, so -1.5 days are 2 and 1.5 days 1."""
    return micro_days(micros(a), micros(b))


def micros(x: Column) -> Column:
    return F.unix_micros(x.cast("timestamp"))


def micro_days(a: Column, b: Column) -> Column:
    """``day_distance`` of instants that ``micros`` has turned into numbers, as for many pairs of them."""
    return F.abs(F.floor((a - b) / 86_400_000_000)).cast("long")


def month_start(d: Column) -> Column:
    return F.trunc(d, "MM")


def calendar(d: Column, prefix: str = "") -> list[Column]:
    """Year, month, quarter and year-month of a date."""
    return [F.year(d).alias(f"{prefix}year"), F.month(d).alias(f"{prefix}month"), F.quarter(d).alias(f"{prefix}quarter"), F.date_format(d, "yyyy-MM").alias(f"{prefix}year_month")]
