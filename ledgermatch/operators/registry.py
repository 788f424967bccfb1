"""Registries: idempotent, versioned loads resolved a batch at a time.

The unit is a batch: every row is resolved by windows over (what is stored, what is new), and
what is new is appended.  Ids follow from a deterministic order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import hashing


def first_requests(rows: DataFrame, stored: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(new, repeated) rows of a batch keyed by (load_id, row).

    A row whose key is stored gets its stored columns back, with ``existing`` true; of rows
    with one key in the batch the first by ``order`` is new, the others are repeats of it and
    are left out.
    """
    key = ["load_id", "row"]
    first = rows.withColumn("_r", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_r = 1").drop("_r")
    return first.join(stored.select(*key), key, "left_anti"), stored.join(first.select(*key), key, "left_semi").withColumn("existing", F.lit(True))


def register_rows(batch: DataFrame, results: DataFrame, order: list[str], resolve: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The result of every row of a batch keyed by (load_id, row), with ``existing``.

    A key that has a stored result gets that back, whatever the row says now; rows that repeat
    a key within the batch get the result of its first.  Only the others go through
    ``resolve``, which adds ``outcome`` (and more); ``results`` has load_id, row and its columns.
    """
    key = ["load_id", "row"]
    fresh, _ = first_requests(batch, results, order)
    stored = [c for c in results.columns if c not in key]
    new = resolve(fresh).select(*key, *stored, F.lit(False).alias("existing"))
    known = new.unionByName(results.select(*key, *stored, F.lit(True).alias("existing")))
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return batch.withColumn("_place", place).join(known, key).withColumn("existing", F.col("existing") | (F.col("_place") > 1)).drop("_place")


def resolve_documents(rows: DataFrame, key: list[str], hash_col: str, order: list[str], valid: Column | None = None) -> DataFrame:
    """Outcome of each listing row: NUEVO, DUPLICADO, NUEVA_REVISION or RECHAZADO, with its revision.

    The first content seen under a key is revision 1 and NUEVO; a content seen before is
    DUPLICADO, also of an older revision, and changes nothing; any other content is the next
    revision.  Rows that aren't valid take no part.
    """
    ok = F.lit(True) if valid is None else valid
    marked = rows.withColumn("_ok", ok)
    by_content = Window.partitionBy("_ok", *key, hash_col).orderBy(*order)
    by_key = Window.partitionBy("_ok", *key).orderBy(*order)
    marked = marked.withColumn("_fresh", (F.row_number().over(by_content) == 1).cast("int"))
    marked = marked.withColumn("_seen", F.sum("_fresh").over(by_key.rowsBetween(Window.unboundedPreceding, 0)))
    by_hash = Window.partitionBy("_ok", *key, hash_col)
    outcome = F.when(~F.col("_ok"), "RECHAZADO").when(F.col("_fresh") == 0, "DUPLICADO").when(F.col("_seen") == 1, "NUEVO").otherwise("NUEVA_REVISION")
    revision = F.when(F.col("_ok"), F.min(F.when(F.col("_fresh") == 1, F.col("_seen"))).over(by_hash))
    return marked.withColumns({"outcome": outcome, "revision": revision}).drop("_ok", "_fresh", "_seen")


def current_revisions(resolved: DataFrame, key: list[str]) -> DataFrame:
    """The rows that brought the highest revision of each key."""
    fresh = resolved.where(F.col("outcome").isin("NUEVO", "NUEVA_REVISION"))
    return fresh.withColumn("_r", F.row_number().over(Window.partitionBy(*key).orderBy(F.col("revision").desc()))).where("_r = 1").drop("_r")


def resolve_movements(rows: DataFrame, key: list[str], hash_col: str, order: list[str], valid: Column | None = None) -> DataFrame:
    """Outcome of each movement: NUEVO, DUPLICADO, ID_CON_CONTENIDO_DISTINTO (the first version stays) or RECHAZADO."""
    marked = rows.withColumn("_ok", F.lit(True) if valid is None else valid)
    seen = Window.partitionBy("_ok", *key).orderBy(*order)
    first = F.first(hash_col).over(seen.rowsBetween(Window.unboundedPreceding, 0))
    outcome = (
        F.when(~F.col("_ok"), "RECHAZADO").when(F.row_number().over(seen) == 1, "NUEVO").when(F.col(hash_col) == first, "DUPLICADO").otherwise("ID_CON_CONTENIDO_DISTINTO")
    )
    return marked.withColumn("outcome", outcome).drop("_ok")


def append_new(stored: DataFrame, batch: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The rows of a batch to append: the first of each key that isn't stored yet."""
    first = batch.withColumn("_r", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_r = 1").drop("_r")
    return first.join(stored.select(*key), key, "left_anti")


def assign_ids(batch: DataFrame, order: list[str], start: int = 0, id_col: str = "id") -> DataFrame:
    """Surrogate ids start + 1, ... by a deterministic order, without sorting all rows in one task.

    Rows are range-partitioned by the order; a partition's first id follows from the counts of
    those before it.
    """
    placed = batch.repartitionByRange(*order).withColumn("_p", F.spark_partition_id())
    sizes = placed.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.select("_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_before"))  # one row per partition
    own = Window.partitionBy("_p").orderBy(*order)
    return placed.join(F.broadcast(starts), "_p").withColumn(id_col, F.lit(start) + F.col("_before") + F.row_number().over(own)).drop("_p", "_before")


def start_loads(requests: DataFrame, previous: DataFrame) -> DataFrame:
    """Outcome of load requests (client, item, etag, hash): SOLICITUD_EXISTENTE, REINTENTO, SIN_CAMBIOS or NUEVA_CARGA.

    ``previous`` has client, item, etag, hash, state, load_id.  The same request is known by
    (client, item, etag); else the original load of the same content is the finished one with
    the lowest id, and a load in ERROR is tried again.
    """
    same = previous.groupBy("client", "item", "etag").agg(F.min("load_id").alias("same_load"))
    rank = F.when(F.col("state").isin("OK", "PARCIAL", "REQUIERE_REVISION"), 0).otherwise(1)
    origin = previous.groupBy("client", "hash").agg(F.min(F.struct(rank.alias("r"), "load_id", "state")).alias("o"))
    joined = requests.join(same, ["client", "item", "etag"], "left").join(origin, ["client", "hash"], "left")
    outcome = F.when(F.col("same_load").isNotNull(), "SOLICITUD_EXISTENTE").when(F.col("o").isNull(), "NUEVA_CARGA").when(F.col("o.state") == "ERROR", "REINTENTO").otherwise("SIN_CAMBIOS")
    return joined.select("client", "item", "etag", "hash", outcome.alias("outcome"), F.coalesce("same_load", "o.load_id").alias("load_id"))


def start_ledger_loads(requests: DataFrame, previous: DataFrame, registered: DataFrame) -> DataFrame:
    """Outcome of ledger load requests (client, source, item, etag, hash, sheet).

    ``previous`` has client, source, item, etag, hash, sheet, state, expected, load_id;
    ``registered`` has load_id and n, the rows that a load has registered.  A load is known by
    (client, source, item, etag), else by (client, source, hash); sources compare in upper
    case.  CONFLICTO: the same item version with another hash, or the same file with another
    sheet.  REINTENTO: a load in ERROR, or a PARCIAL one whose rows did not all come.
    ARCHIVO_EXISTENTE: any other known load.  NUEVA_CARGA: the rest.
    """
    upper = lambda df: df.withColumn("source", F.upper(F.trim("source")))
    seen = upper(previous).join(registered.select("load_id", "n"), "load_id", "left")
    load = F.struct("load_id", "hash", "sheet", "state", (F.col("expected") > F.coalesce("n", F.lit(0))).alias("short"))
    by_item = seen.where("item is not null and etag is not null").groupBy("client", "source", "item", "etag").agg(F.min(load).alias("_item"))
    by_hash = seen.groupBy("client", "source", "hash").agg(F.min(load).alias("_hash"))
    joined = upper(requests).join(by_item, ["client", "source", "item", "etag"], "left").join(by_hash, ["client", "source", "hash"], "left").withColumn("_load", F.coalesce("_item", "_hash"))
    outcome = (
        F.when(F.col("_load").isNull(), "NUEVA_CARGA")
        .when((F.col("_load.hash") != F.col("hash")) | (F.col("_load.sheet") != F.col("sheet")), "CONFLICTO")
        .when((F.col("_load.state") == "ERROR") | ((F.col("_load.state") == "PARCIAL") & F.col("_load.short")), "REINTENTO")
        .otherwise("ARCHIVO_EXISTENTE")
    )
    return joined.select("client", "source", "item", "etag", "hash", "sheet", outcome.alias("outcome"), F.col("_load.load_id").alias("load_id"))


def load_counters(resolved: DataFrame, load: str, when: str, expected: DataFrame | None = None, ledger: bool = False) -> DataFrame:
    """Counters of each load and the state it ends in.

    ``expected`` has the load and its expected number of rows; rows that are still to come
    leave a load PARCIAL.  A listing load without a valid row is in ERROR, a ledger load only
    if it has no row at all.
    """
    n = lambda o: F.count_if(F.col("outcome") == o)
    out = resolved.groupBy(load).agg(
        F.count(F.lit(1)).alias("processed"), n("NUEVO").alias("new"), n("DUPLICADO").alias("duplicate"), n("NUEVA_REVISION").alias("revised"), n("ID_CON_CONTENIDO_DISTINTO").alias("conflict"), n("RECHAZADO").alias("rejected"), F.min(when).alias("first_at"), F.max(when).alias("last_at")
    )
    if expected is not None:
        out = expected.join(out, load, "left").na.fill(0, ["processed", "new", "duplicate", "revised", "conflict", "rejected"]).withColumn("pending", F.col("expected") - F.col("processed"))
    valid = F.col("processed") - F.col("rejected")
    failed = F.col("processed") == 0 if ledger else valid == 0
    waiting = F.col("pending") > 0 if expected is not None else F.lit(False)
    state = F.when(failed, "ERROR").when(waiting | (F.col("rejected") > 0) | (F.col("conflict") > 0), "PARCIAL").when(F.col("revised") > 0, "REQUIERE_REVISION").otherwise("OK")
    return out.withColumn("state", state)


def register_clients(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Outcome by upper-case tax id: NUEVO, EXISTENTE, or REQUIERE_REVISION if the name differs."""
    known = stored.select(F.upper(F.trim("nit")).alias("_nit"), F.col("name").alias("_name"))
    joined = rows.withColumn("_nit", F.upper(F.trim("nit"))).join(known, "_nit", "left")
    return joined.withColumn("outcome", F.when(F.col("_name").isNull(), "NUEVO").when(F.upper(F.trim("_name")) == F.upper(F.trim("name")), "EXISTENTE").otherwise("REQUIERE_REVISION")).drop("_nit", "_name")


def pending(items: DataFrame, done: list[DataFrame], key: str, order: list[str], limit: int | None = None) -> DataFrame:
    """Items that are in none of ``done``, oldest first, at most ``limit`` if the feature asks for a top n."""
    for other in done:
        items = items.join(other.select(key), key, "left_anti")
    return items.orderBy(*order).limit(limit) if limit is not None else items


def register_xml(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Outcome of XML files (document_id, path, sha256): XML_REGISTRADO, XML_EXISTENTE, or RECHAZADO if the path doesn't end with id and hash."""
    good = F.coalesce(F.col("path").endswith(F.concat(F.col("document_id").cast("string"), F.lit("/"), F.col("sha256"), F.lit(".xml"))), F.lit(False)) & hashing.is_hex(F.col("sha256"), 64)
    known = stored.select("document_id").distinct().withColumn("_known", F.lit(True))
    first = F.row_number().over(Window.partitionBy("document_id").orderBy(~good, "path")) == 1
    marked = batch.withColumns({"_good": good, "_first": first}).join(known, "document_id", "left")
    outcome = F.when(~F.col("_good"), "RECHAZADO").when(F.col("_known") | ~F.col("_first"), "XML_EXISTENTE").otherwise("XML_REGISTRADO")
    return marked.withColumn("outcome", outcome).drop("_good", "_first", "_known")


def register_extractions(parsed: DataFrame, extracted: DataFrame, failed: DataFrame) -> DataFrame:
    """Outcome of parsed documents (xml_id, error): REGISTRADA or EXISTENTE, ERROR_REGISTRADO or YA_EXTRAIDO.

    An error sticks: a document that has one is not tried again and keeps it.
    """
    done = extracted.select("xml_id").distinct().withColumn("_done", F.lit(True))
    bad = failed.select("xml_id").distinct().withColumn("_bad", F.lit(True))
    joined = parsed.join(done, "xml_id", "left").join(bad, "xml_id", "left")
    has = lambda c: F.coalesce(F.col(c), F.lit(False))
    outcome = F.when(F.col("error").isNull(), F.when(has("_done"), "EXISTENTE").when(has("_bad"), "ERROR_REGISTRADO").otherwise("REGISTRADA")).otherwise(F.when(has("_done"), "YA_EXTRAIDO").otherwise("ERROR_REGISTRADO"))
    return joined.withColumn("outcome", outcome).drop("_done", "_bad")


def finish_loads(counters: DataFrame, finished: DataFrame, load: str) -> DataFrame:
    """Counters with a column ``finish``: the state a load ends in now, or YA_FINALIZADA if it has ended before."""
    before = finished.select(load).distinct().withColumn("_ended", F.lit(True))
    return counters.join(before, load, "left").withColumn("finish", F.when(F.col("_ended"), "YA_FINALIZADA").otherwise(F.col("state"))).drop("_ended")
