"""Money, flags and ratios as column expressions.  The two money parsers differ on purpose."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import is_missing_flag, present, strip

# Words that mean yes.
YES = ("1", "1.0", "true", "verdadero", "si", "sí", "yes", "y", "x")


def engine_money(x: Column) -> Column:
    """Double from text after dropping spaces, $, % and every comma: "1.234,56" is 1.23456."""
    return F.regexp_replace(present(x), r"[\s\u00A0$%,]", "").try_cast("double")


def listing_money(x: Column, blank: float | None = None) -> Column:
    """decimal(19,4) from text whose last of , and . is the decimal mark; a lone comma is one too."""
    text = F.regexp_replace(x, r"[\s\u00A0$]", "")
    comma, dot = F.instr(F.reverse(text), ","), F.instr(F.reverse(text), ".")
    european = F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    plain = F.when((comma > 0) & ((dot == 0) | (comma < dot)), european).otherwise(F.replace(text, F.lit(","), F.lit("")))
    value = plain.try_cast("decimal(19,4)")
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit(blank).cast("decimal(19,4)")).otherwise(value)


def xml_decimal(x: Column) -> Column:
    """decimal(38,18) from text: finite, below 1e20, at most 18 decimals; otherwise null."""
    text = strip(x)
    ok = text.rlike(r"^[+-]?(\d+(\.\d*)?|\.\d+)$") & ~text.rlike(r"\.\d{18}0*[1-9]")
    return F.when(ok, text.try_cast("decimal(38,18)"))


def too_precise(x: Column) -> Column:
    """Has a number more than four significant decimals?"""
    return x.try_cast("decimal(38,10)") != x.try_cast("decimal(19,4)")


def flag(x: Column) -> Column:
    """1 for the words that mean yes and for numbers other than 0, else 0."""
    text = F.lower(strip(x.cast("string")))
    number = text.try_cast("double")
    return F.when(is_missing_flag(x.cast("string")), 0).when(text.isin(*YES), 1).when(number.isNotNull() & (number != 0), 1).otherwise(0)


def ratio(a: Column, b: Column) -> Column:
    """a / b; null if b is 0 or null."""
    return F.when(b != 0, a / b)


def probability(p: Column) -> Column:
    """A probability to 12 decimals, half to even; null outside [0, 1]."""
    return F.when(p.between(0, 1), F.bround(p.cast("decimal(38,18)"), 12).cast("decimal(18,12)"))
