"""Invoice and movement features: one projection each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers, text
from .entries import entry_key
from .matching import invoice_key

# The tax unit, and the thresholds as multiples of it.
UNIT = 52374
THRESHOLDS = (2, 4, 27)
MISMATCH = 0.01
#: Columns of an invoice that a source may lack.
OPTIONAL = {"city": "string", "tax_level": "string", "scheme_id": "string", "scheme_name": "string", "item_codes": "string"}
#: What the template classifier reads.
PREDICTORS = (
    "nit city_text tax_level_text scheme_id_text scheme_name_text industry_code payable discount charge has_iva has_inc has_discount has_charge "
    "over_2_units over_4_units over_27_units payable_mismatch item_codes_text"
).split()


def ensure_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``df`` with the columns that it lacks added as nulls of the given type."""
    return df.withColumns({c: F.lit(None).cast(kind) for c, kind in columns.items() if c not in df.columns})


def rename_present(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns})


def threshold_flags(tax_exclusive: Column, unit: int = UNIT) -> dict[str, Column]:
    base = F.coalesce(tax_exclusive, F.lit(0.0))
    return {f"over_{n}_units": (base >= n * unit).cast("int") for n in THRESHOLDS}


def invoice_features(raw: DataFrame) -> DataFrame:
    """Typed invoice rows to matching and model features.

    The total is the payable amount as it is; the payable amount itself is filled with 0.
    Columns in ``OPTIONAL`` that the source lacks are null.
    """
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    base, taxes = zero("line_extension"), zero("iva") + zero("inc")
    nit, number = text.tax_id(F.col("nit")), text.alnum_key(F.col("invoice"))
    return ensure_columns(raw, OPTIONAL).withColumns(
        {
            "city_text": text.model_text(F.col("city")),
            **{f"{c}_text": text.basic_text(F.col(c)) for c in ("tax_level", "scheme_id", "scheme_name", "item_codes")},
            "nit": nit,
            "invoice": number,
            "invoice_prefix": text.letter_prefix(number),
            "invoice_key": invoice_key(nit, number),
            "supplier_text": text.model_text(F.col("supplier_name")),
            "industry_code": text.first_code(F.col("industry")),
            "description": text.description(F.col("item_1"), F.col("supplier_name"), F.col("notes")),
            "total": F.col("payable"),
            "payable": zero("payable"),
            "base": base,
            "taxes": taxes,
            "base_and_taxes": base + taxes,
            "tax_gap": F.col("payable") - (base + taxes),
            "has_iva": (zero("iva") > 0).cast("int"),
            "has_inc": (zero("inc") > 0).cast("int"),
            "has_discount": ((zero("discount") > 0) | (numbers.flag(F.col("discount_flag")) == 1)).cast("int"),
            "has_charge": ((zero("charge") > 0) | (numbers.flag(F.col("charge_flag")) == 1)).cast("int"),
            **threshold_flags(F.col("tax_exclusive")),
            "payable_mismatch": F.coalesce(F.abs(F.col("payable") - F.col("tax_inclusive")) > MISMATCH, F.lit(False)).cast("int"),
            "no_nit": nit.isNull().cast("int"),
            "no_invoice": number.isNull().cast("int"),
            "no_date": F.col("date").isNull().cast("int"),
            "no_total": F.col("payable").isNull().cast("int"),
            "year": F.year("date"),
            "month": F.month("date"),
            "quarter": F.quarter("date"),
            "year_month": F.date_format("date", "yyyy-MM"),
        }
    )


def movement_features(raw: DataFrame) -> DataFrame:
    """Movements with normalized ids, dates and their entry's key."""
    year = F.year("date")
    return raw.withColumns(
        {
            "third_id": text.tax_id(F.col("third_id")),
            "concept_text": text.model_text(F.col("concept")),
            "entry_year": year,
            "entry_key": entry_key(year, F.col("doc_type"), F.col("doc_number")),
            "debit": F.coalesce(F.col("debit"), F.lit(0)).cast("decimal(19,4)"),
            "credit": F.coalesce(F.col("credit"), F.lit(0)).cast("decimal(19,4)"),
            "month": F.month("date"),
            "quarter": F.quarter("date"),
            "year_month": F.date_format("date", "yyyy-MM"),
        }
    )


