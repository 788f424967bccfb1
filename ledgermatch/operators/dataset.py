"""Training dataset: model rows, guards, and publication under a hash identity."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import hashing
from .entries import template_label
from .matching import accepted

IDENTITY = ("client", "source", "invoices_hash", "movements_hash", "rows_hash", "code_hash", "parameters")
MANIFEST = ", ".join(f"{c} string" for c in IDENTITY) + ", n long, version int"


def model_rows(invoices: DataFrame, matches: DataFrame) -> DataFrame:
    """Every invoice with its match; the target is the account_nature set, else the accounts."""
    renamed = [F.col(c).alias(f"{c}_match") if c in invoices.columns and c != "invoice_key" else F.col(c) for c in matches.columns]
    joined = invoices.join(matches.select(*renamed), "invoice_key", "left")
    target = F.when(F.size("account_natures") > 0, F.col("account_natures")).otherwise(F.col("accounts"))
    return joined.withColumns({"target": target, "is_ok": F.coalesce(accepted(F.col("state")), F.lit(False))})


def training_rows(rows: DataFrame, features: list[str]) -> DataFrame:
    """Accepted rows with a target: id, features (booleans as 0 and 1), day and label text.

    The plan itself fails on an accepted row that has lost its id.
    """
    kinds = dict(rows.dtypes)
    plain = [F.col(c).cast("int").alias(c) if kinds[c] == "boolean" else F.col(c) for c in features]
    own = F.coalesce("xml_id", F.raise_error(F.concat(F.lit("an accepted match has no source document: "), F.coalesce(F.col("invoice_key"), F.lit("?"))))).alias("xml_id")
    return rows.where(F.col("is_ok") & F.col("target").isNotNull()).select(own, *plain, "date", template_label(F.col("target")).alias("label"))


def guards(df: DataFrame, key: str) -> DataFrame:
    """One row of what a source must not have: no rows, null keys, repeated keys."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("null_keys"),
        F.count_if((F.col("n") > 1) & F.col(key).isNotNull()).alias("repeated_keys"),
    )


def require(df: DataFrame, key: str) -> DataFrame:
    """``df``, after the guards have passed."""
    found = guards(df, key).first()
    if not found["rows"] or found["null_keys"] or found["repeated_keys"]:
        raise ValueError(f"the source breaks its contract on {key}: {found.asDict()}")
    return df


def _folded(key: Column) -> Column:
    """Bytes that are equal where the key is, in lower case: those of the digits' pairs for a hash in hex, which are half as many, else those of the text.  A letter tells which."""
    return F.when(key.rlike("^([0-9a-fA-F]{2})+$"), F.concat(F.lit(b"h"), F.unhex(key))).otherwise(F.concat(F.lit(b"t"), F.lower(key).cast("binary")))


def _unfolded(folded: Column) -> Column:
    """The key in lower case."""
    rest = F.substring(folded, 2, 1 << 30)
    return F.when(F.substring(folded, 1, 1) == F.lit(b"h"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))


def must_find(rows: DataFrame, key: str, sources: DataFrame, source_key: str, columns: list[str], what: str = "no source for") -> DataFrame:
    """``rows`` with ``columns`` of the source of the same key, compared in lower case.

    Not an inner join: a row without a source, or whose key several sources share, fails the job that reads it (no second job counts rows).
    Rows meet by ``_folded`` keys, from which the message is made too, so that a key nobody reads further on doesn't move.
    """
    # Only a single source's values are ever read, so each column has its own minimum: these need no sort before the shuffle.
    own = sources.select(_folded(F.col(source_key).cast("string")).alias("_key"), F.struct(*columns).alias("_s")).groupBy("_key").agg(*[F.min(f"_s.{c}").alias(f"_found_{c}") for c in columns], F.count(F.lit(1)).alias("_n"))
    joined = rows.withColumn("_own", _folded(F.col(key).cast("string"))).join(own, F.col("_own") == F.col("_key"), "left")
    wrong = F.raise_error(F.concat(F.lit(what + " "), F.coalesce(_unfolded(F.col("_own")), F.lit("null"))))
    source = F.struct(*[F.col(f"_found_{c}").alias(c) for c in columns])
    found = F.when(F.col("_n") == 1, source).otherwise(F.coalesce(wrong, source))
    return joined.withColumn("_found", found).select(*rows.columns, *[F.col(f"_found.{c}").alias(c) for c in columns])


#: Columns that the contract of published rows asks for.
PUBLISHED = ("xml_id", "extractor_version", "key", "state", "entry", "label", "date", "total")


#: Members of a published row's payload.
ROW = {
    "documento_xml_id": "bigint", "version_extractor": "smallint", "cufe": "string", "estado_match": "string", "llave_asiento": "string", "nit_proveedor_norm": "string", "ciudad_proveedor_modelo": "string",
    "tax_level_proveedor_limpio": "string", "tax_scheme_id_limpio": "string", "tax_scheme_nombre_limpio": "string", "codigo_industria_proveedor_limpio": "string", "fecha_emision": "date", "payable_amount": "decimal(38,18)",
    "descuento_total": "decimal(38,18)", "recargo_total": "decimal(38,18)", "tiene_iva": "boolean", "tiene_inc": "boolean", "flag_descuento": "boolean", "flag_recargo": "boolean", "flag_umbral_rf_servicios": "boolean",
    "flag_umbral_reteica_bogota_servicios": "boolean", "flag_umbral_reteica_bogota_compras": "boolean", "flag_diferencia_payable_tax_inclusive": "boolean", "standard_item_identification_limpio": "string",
    "target_plantilla_cuentas": "string",
}
_AS_PUBLISHED = {"documento_xml_id": "xml_id", "version_extractor": "extractor_version", "cufe": "key", "estado_match": "state", "llave_asiento": "entry", "target_plantilla_cuentas": "label", "fecha_emision": "date", "payable_amount": "total"}


def rows_of_json(batches: DataFrame, column: str = "rows_json") -> DataFrame:
    """A row per element of the JSON arrays in ``column``, typed, the columns ``PUBLISHED`` by their own names.

    ``untyped`` names the members whose text is no value of their type, joined by "; "; a text
    that is no array of objects gives one row of nulls with ``untyped`` "json".
    """
    raw = F.from_json(column, "array<struct<" + ",".join(f"{c}:string" for c in ROW) + ">>")
    good = F.coalesce(F.try_parse_json(column).isNotNull() & F.col(column).rlike(r"^\s*\["), F.lit(False))
    each = batches.withColumn("_good", good).withColumn("_rows", F.when(good, raw)).select(*[c for c in batches.columns if c != column], "_good", F.explode_outer("_rows").alias("_r"))
    each = each.where(~F.col("_good") | F.col("_r").isNotNull())

    def typed(name: str, kind: str) -> Column:
        value = F.col(f"_r.{name}")
        if kind == "date":
            return F.when(value.rlike(r"^\d{4}-\d\d-\d\d$"), F.try_to_timestamp(value, F.lit("yyyy-MM-dd")).cast("date"))
        return value if kind == "string" else value.try_cast(kind)

    wrong = F.array_compact(F.array(*[F.when(F.col(f"_r.{c}").isNotNull() & typed(c, kind).isNull(), c) for c, kind in ROW.items() if kind != "string"]))
    others = [c for c in each.columns if c not in ("_good", "_r")]
    return each.select(*others, *[typed(c, kind).alias(_AS_PUBLISHED.get(c, c)) for c, kind in ROW.items()], F.when(F.col("_good"), F.array_join(wrong, "; ")).otherwise("json").alias("untyped"))


def publication_problem(current: str = "_current") -> Column:
    """What keeps a row from being published, or null: "contract", or what its current invoice says ("not current", "another key", "another date").

    A null date of the current invoice doesn't differ.
    """
    blank = lambda c: F.coalesce(F.trim(c) == "", F.lit(True))
    good = (F.col("xml_id") > 0) & (F.col("extractor_version") == 1) & hashing.is_hex(F.col("key"), 96) & accepted(F.col("state")) & ~blank("entry") & ~blank("label") & F.col("date").isNotNull() & F.col("total").isNotNull()
    differs = lambda c: F.coalesce(F.col(f"{current}.{c}") != F.col(c), F.lit(False))
    return (
        F.when(~F.coalesce(good, F.lit(False)), "contract").when(F.col(current).isNull(), "not current").when(differs("key"), "another key").when(differs("date"), "another date")
    )


def checked(rows: DataFrame, current: DataFrame) -> DataFrame:
    """``rows`` with ``problem``: their contract, and whether each still is what the current view says (xml_id, extractor_version, key, date)."""
    on = ["xml_id", "extractor_version"]
    view = current.groupBy(*on).agg(F.min(F.struct("key", "date")).alias("_current"))
    return rows.join(view, on, "left").withColumn("problem", publication_problem()).select(*rows.columns, "problem")


def publish(spark: SparkSession, rows: DataFrame, identity: dict[str, str], path: str, order: str = "xml_id", current: DataFrame | None = None, universe: int | None = None) -> tuple[str, int]:
    """Write a version and its manifest row once: ("PUBLICADA" or "YA_EXISTE", version).

    Rows are computed once, into a folder of their own; their hash is taken from what was
    written.  A new version's folder is then renamed, and the manifest row, written last, makes
    it a version: what a lost run leaves behind is not one.  The same identity with the same
    rows' hash is the same version.

    With ``current`` (the view of current invoices) the rows have the columns ``PUBLISHED`` and
    are checked while they are written, by metrics that the write itself observes: any problem,
    a repeated xml_id or key, no row, or more than ``universe`` rows, and nothing is published.
    """
    missing = set(IDENTITY) - set(identity) - {"rows_hash"}
    if missing:
        raise ValueError(f"identity without {sorted(missing)}")
    pending = f"{path}/pending/{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path
    files = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if current is None:
        rows.write.parquet(pending)
    else:
        seen = Observation()
        kinds = ("contract", "not current", "another key", "another date")
        watched = checked(rows, current).observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col("problem") == k).alias(k) for k in kinds])
        watched.drop("problem").write.parquet(pending)
        wrong = {k: n for k, n in seen.get.items() if k != "rows" and n}
        written = spark.read.schema(rows.schema).parquet(pending)
        wrong |= {f"repeated {k}": n for k in ("xml_id", "key") if (n := guards(written, k).first()["repeated_keys"])}
        if not seen.get["rows"] or (universe is not None and seen.get["rows"] > universe):
            wrong["rows"] = seen.get["rows"]
        if wrong:
            files.delete(at(pending), True)
            raise ValueError(f"the rows break the contract of publication: {wrong}")
    found = hashing.frame_hash(spark.read.schema(rows.schema).parquet(pending), order).first()
    identity = identity | {"rows_hash": found["hash"]}
    last = 0
    if files.exists(at(f"{path}/manifest")):
        manifest = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
        same = manifest
        for c in IDENTITY:
            same = same.where(F.col(c) == identity[c])
        if again := same.first():
            files.delete(at(pending), True)
            return "YA_EXISTE", again["version"]
        last = manifest.agg(F.max("version")).first()[0] or 0
    own = at(f"{path}/rows/version={last + 1}")
    files.delete(own, True)  # of a run that was lost before its manifest row
    files.mkdirs(own.getParent())
    if not files.rename(at(pending), own):
        raise OSError(f"{pending} could not become {own.toString()}")
    spark.createDataFrame([tuple(identity[c] for c in IDENTITY) + (found["n"], last + 1)], MANIFEST).write.mode("append").parquet(f"{path}/manifest")
    return "PUBLICADA", last + 1


def read_version(spark: SparkSession, path: str, version: int) -> DataFrame:
    """The rows of a version, after their number and keys have been checked."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{path}/manifest").where(F.col("version") == version).first()
    if not manifest:
        raise ValueError(f"no version {version}")
    rows = spark.read.parquet(f"{path}/rows/version={version}")
    found = guards(rows, "xml_id").first()
    if found["rows"] != manifest["n"] or found["null_keys"] or found["repeated_keys"]:
        raise ValueError(f"version {version} has {found.asDict()}, its manifest {manifest['n']} rows")
    return rows
