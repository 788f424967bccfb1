"""Document listings and ledger sheets as typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, hashing, numbers, rules, text
from . import xlsx

# Folded headers of a listing; the column of each is named by its words.
TEXTS = ("tipo de documento", "cufe cude", "folio", "prefijo", "divisa", "forma de pago", "medio de pago", "nit emisor", "nombre emisor", "nit receptor", "nombre receptor", "estado", "grupo")
TAXES = ("iva", "ica", "ic", "inc", "timbre", "inc bolsas", "in carbono", "in combustibles", "ic datos", "icl", "inpp", "ibua", "icui", "rete iva", "rete renta", "rete ica")
REQUIRED = ("tipo de documento", "cufe cude", "folio", "fecha emision", "fecha recepcion", "nit emisor", "nombre emisor", "nit receptor", "nombre receptor", "total", "estado", "grupo")
#: Headers whose accented letter was lost.
DAMAGED = {"fecha emisin": "fecha emision", "fecha recepcin": "fecha recepcion"}
RESPONSES = ("application response",)

# Folded headers of a ledger sheet that must be there, and those that may be.
LEDGER_REQUIRED = ("FECHA", "DOCUMENTO", "TIPODOC", "NUMDOC", "CUENTA", "NATURALEZA", "DEBITO", "CREDITO", "IDENTIDADTERCERO", "INDCONTABILIDAD")
LEDGER_OPTIONAL = ("NOMCUENTA", "CONCEPTO", "CENTRO", "CODIGOCTABANCARIA", "CODIGOUSUARIO", "DOCFUENTE", "FECHASISTEMA", "DV", "NOMBRETERCERO", "CUENTABANCARIA", "NOMCENTRO", "DESCRIPCIONCORTA", "DIRECCION", "TELEFONOS", "NUMEROMOVIL", "NOMCIUDAD", "CC")


def listing_header(name: str) -> str:
    folded = text.fold_header(name)
    return DAMAGED.get(folded, folded)


def listing_rows(spark: SparkSession, path: str, table: str | None = None, by_table: bool = False) -> DataFrame:
    """Typed listing rows with their original cells, row hash, content hash and parse errors.

    Tax amounts default to 0, the total doesn't; a row with a value that can't be read has the
    content hash "".  The rows are those below the first header that fits; with ``table`` those
    of the named table, with ``by_table`` those of the first table or sheet.
    """
    raw = xlsx.read_tables(spark, path, set(REQUIRED), listing_header, table) if by_table or table else xlsx.read_records(spark, path, set(REQUIRED), listing_header)
    cell = lambda h: text.blank_to_null(F.col("cells").getItem(h))
    name = lambda h: h.replace(" ", "_")
    values: dict[str, Column] = {name(h): cell(h) for h in TEXTS}
    values["cufe_cude"] = F.lower(cell("cufe cude"))
    values["fecha_emision"] = dates.listing_date(cell("fecha emision"))
    values["fecha_recepcion"] = F.coalesce(dates.listing_datetime(cell("fecha recepcion")), dates.listing_date(cell("fecha recepcion")).cast("timestamp"))
    values |= {name(h): numbers.listing_money(cell(h), 0) for h in TAXES}
    values["total"] = numbers.listing_money(cell("total"))
    failed = {"fecha emision": "fecha_emision", "fecha recepcion": "fecha_recepcion", "total": "total", **{h: name(h) for h in TAXES}}
    typed = raw.withColumns(values).withColumn("key_type", text.key_type(F.col("tipo_de_documento")))
    errors = F.concat_ws("; ", *(F.when(cell(h).isNotNull() & F.col(c).isNull(), F.lit(f"{h} no es valido")) for h, c in failed.items()))
    typed = typed.withColumn("parse_errors", errors)
    content = hashing.row_hash({c: F.col(c).cast("string") for c in sorted(values)})
    original = F.to_json(F.map_from_entries(F.array_sort(F.map_entries("original"))), {"ignoreNullFields": "false"})
    return typed.withColumns({"original_json": original, "row_hash": F.sha2(original, 256), "content_hash": F.when(F.col("parse_errors") == "", content).otherwise("")}).drop("cells", "original")


def without_responses(rows: DataFrame) -> DataFrame:
    """Rows but those of response documents, which are only counted."""
    return rows.where(~F.coalesce(text.model_text(F.col("tipo_de_documento")).isin(*RESPONSES), F.lit(False)))


def ledger_rows(spark: SparkSession, path: str, sheet: str | None = None, max_rows: int = xlsx.MAX_ROWS) -> DataFrame:
    """Ledger movements as texts and typed dates and amounts, with the first rule that each breaks."""
    raw = xlsx.read_records(spark, path, set(LEDGER_REQUIRED), text.fold_ledger_header, sheet, max_rows)
    cell = lambda h: text.blank_to_null(F.col("cells").getItem(h))
    values = rules.movement(lambda member: cell(member.upper()), F.col("error"))
    values["rule"] = values.pop("error")
    return raw.withColumns(values).drop("cells", "original", "error")


def engine_rows(spark: SparkSession, path: str, required: set[str], table: str | None = None, recover: tuple[str, ...] = ("nit_proveedor",)) -> DataFrame:
    """(path, row, cells, error) of an engine's sheet: all cells as text by snake-case name; a wholly empty column of ``recover`` gets the raw text of its cells."""
    return xlsx.read_tables(spark, path, required, text.snake_name, table, recover=recover).drop("original")
