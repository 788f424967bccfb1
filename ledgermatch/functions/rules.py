"""Rules of registry rows: what a row must have, and how long its values may be.

Listing rows report every rule that they break, movements the first one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import dates, hashing, numbers
from .text import blank_to_null

# Messages of the rules of a listing row in their order, with the column, whether it must be there, and its greatest length.
LISTING = (
    ("Tipo de documento inválido", "tipo_de_documento", True, 80),
    ("Folio inválido", "folio", True, 50),
    ("Prefijo demasiado largo", "prefijo", False, 30),
    ("Divisa demasiado larga", "divisa", False, 10),
    ("Forma de pago demasiado larga", "forma_de_pago", False, 20),
    ("Medio de pago demasiado largo", "medio_de_pago", False, 20),
    ("Fecha de emisión obligatoria", "fecha_emision", True, None),
    ("Fecha de recepción obligatoria", "fecha_recepcion", True, None),
    ("NIT del emisor inválido", "nit_emisor", True, 20),
    ("Nombre del emisor inválido", "nombre_emisor", True, 300),
    ("NIT del receptor inválido", "nit_receptor", True, 20),
    ("Nombre del receptor inválido", "nombre_receptor", True, 300),
    ("Total obligatorio", "total", True, None),
    ("Estado DIAN inválido", "estado", True, 100),
    ("Grupo de origen inválido", "grupo", True, 50),
)
KEY_TYPES = ("CUFE", "CUDE")

# Members of a movement's payload; those of the hash contract in its order; greatest lengths of optional ones by message.
MEMBERS = (
    "Fecha", "Documento", "TipoDoc", "NumDoc", "Cuenta", "NomCuenta", "Concepto", "Naturaleza", "Centro", "CodigoCtaBancaria", "CodigoUsuario", "Debito", "Credito", "IdentidadTercero", "DocFuente",
    "FechaSistema", "IndContabilidad", "Dv", "NombreTercero", "CuentaBancaria", "NomCentro", "DescripcionCorta", "Direccion", "Telefonos", "NumeroMovil", "NomCiudad", "CC",
)
HASHED = ("Fecha", "Documento", "TipoDoc", "NumDoc", "Cuenta", "Concepto", "Naturaleza", "Centro", "CC", "Debito", "Credito", "IdentidadTercero", "DocFuente")
OPTIONAL = (
    ("Nombre demasiado largo.", 300, ("NomCuenta", "NombreTercero", "NomCentro")),
    ("Concepto demasiado largo.", 2000, ("Concepto",)),
    ("Codigo o identificador demasiado largo.", 100, ("Centro", "CodigoCtaBancaria", "CodigoUsuario", "DocFuente", "CuentaBancaria", "NumeroMovil", "CC")),
    ("Dv demasiado largo.", 20, ("Dv",)),
    ("DescripcionCorta demasiado larga.", 1000, ("DescripcionCorta",)),
    ("Direccion demasiado larga.", 500, ("Direccion",)),
    ("Telefonos o NomCiudad demasiado largo.", 200, ("Telefonos", "NomCiudad")),
)


def _longer(x: Column, most: int) -> Column:
    return F.coalesce(F.length(x) > most, F.lit(False))


def listing_errors() -> Column:
    """The messages of all rules that a row of ``listing.listing_rows`` breaks, joined by "; "; empty if valid."""
    text = lambda name: blank_to_null(F.col(name))
    broken = [
        ("CUFE/CUDE inválido", ~hashing.is_hex(F.lower(text("cufe_cude")), 96)),
        ("Tipo de clave inválido", ~F.coalesce(F.upper(text("key_type")).isin(*KEY_TYPES), F.lit(False))),
    ]
    for message, name, needed, most in LISTING:
        value = F.col(name) if most is None else text(name)
        rule = F.lit(False) if most is None else _longer(value, most)
        broken.append((message, rule | value.isNull() if needed else rule))
    broken += [
        ("Hash de fila inválido", ~hashing.is_hex(F.lower(text("row_hash")), 64)),
        ("Hash de contenido inválido", ~hashing.is_hex(F.lower(text("content_hash")), 64)),
        ("JSON de origen inválido", ~hashing.is_json(F.col("original_json"))),
    ]
    return F.concat_ws("; ", *(F.when(rule, F.lit(message)) for message, rule in broken))


def _decimal(x: Column) -> Column:
    return F.when(x.rlike(r"^[+-]?(\d+(\.\d*)?|\.\d+)$"), x.try_cast("decimal(19,4)"))


def movement(cell: Callable[[str], Column], payload_error: Column | None = None) -> dict[str, Column]:
    """Columns of a movement whose members ``cell`` gives as texts: its values by lower-case name, ``error`` and ``content_hash``.

    ``error`` is the message of the first broken rule, or null; only valid movements have a
    hash.  System date, contact data and the id are no part of the hash.
    """
    raw = {m: blank_to_null(cell(m)) for m in MEMBERS}
    typed = raw | {
        "Fecha": dates.ledger_date(F.replace(raw["Fecha"], F.lit("/"), F.lit("-"))),
        "FechaSistema": F.when(raw["FechaSistema"].rlike(r"^\d{4}-\d\d-\d\d(T\d\d:\d\d:\d\d(\.\d{1,7})?)?$"), raw["FechaSistema"].try_cast("timestamp_ntz")),
        "Naturaleza": F.upper(raw["Naturaleza"]),
        "Debito": _decimal(raw["Debito"]),
        "Credito": _decimal(raw["Credito"]),
    }
    wrong = lambda m, most: raw[m].isNull() | _longer(raw[m], most)
    precise = lambda m: F.coalesce(numbers.too_precise(raw[m]), F.lit(False))
    rules = [
        (wrong("IndContabilidad", 100), "IndContabilidad obligatorio o demasiado largo."),
        (typed["Fecha"].isNull(), "Fecha invalida; use aaaa-mm-dd."),
        (wrong("Documento", 100), "Documento obligatorio o demasiado largo."),
        (wrong("TipoDoc", 50), "TipoDoc obligatorio o demasiado largo."),
        (wrong("NumDoc", 100), "NumDoc obligatorio o demasiado largo."),
        (wrong("Cuenta", 50), "Cuenta obligatoria o demasiado larga."),
        (~F.coalesce(typed["Naturaleza"].isin("D", "C"), F.lit(False)), "Naturaleza debe ser D o C."),
        (typed["Debito"].isNull() | typed["Credito"].isNull(), "Debito y Credito deben ser decimales."),
        (precise("Debito") | precise("Credito"), "Debito o Credito tienen mas de 4 decimales significativos."),
        (wrong("IdentidadTercero", 100), "IdentidadTercero obligatorio o demasiado largo."),
        (raw["FechaSistema"].isNotNull() & typed["FechaSistema"].isNull(), "FechaSistema invalida."),
    ]
    for message, most, names in OPTIONAL:
        longer = F.lit(False)
        for name in names:
            longer = longer | _longer(raw[name], most)
        rules.append((longer, message))
    first = [F.when(rule, F.lit(message)) for rule, message in rules]
    error = F.coalesce(*([payload_error] if payload_error is not None else []), *first)
    digest = hashing.movement_hash({m: typed[m].cast("string") for m in HASHED})
    return {m.lower(): typed[m] for m in MEMBERS} | {"error": error, "content_hash": F.when(error.isNull(), digest)}


def movements_of_json(rows: DataFrame, payload: str) -> DataFrame:
    """``rows`` and the columns of ``movement``, from JSON objects with one member per value; they are read once."""
    members = F.when(F.col(payload).rlike(r"^\s*\{"), F.from_json(payload, ", ".join(f"{m} string" for m in MEMBERS)))
    read = rows.withColumns({"_members": members, "_wrong": hashing.payload_error(F.col(payload))})
    # The rules name a member often and are too long for one compiled method, so they run on what is bound once.
    bound = F.struct(*[blank_to_null(F.col("_members")[m]).alias(m) for m in MEMBERS], F.col("_wrong").alias("wrong"))
    error = F.transform(F.array(bound), lambda x: movement(lambda m: x[m], x["wrong"])["error"])[0]
    read = read.withColumn("error", error)
    own = movement(lambda m: F.col("_members")[m])
    return read.withColumns({n: c for n, c in own.items() if n not in ("error", "content_hash")} | {"content_hash": F.when(F.col("error").isNull(), own["content_hash"])}).drop("_members", "_wrong")
