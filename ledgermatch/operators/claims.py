"""Claims of documents for download, as a batch view over attempt events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Limits of a claim.
TIMEOUT_S, RETRY_S, ATTEMPTS = 540, 60, 5
TERMINAL = ("OK", "NO_ENCONTRADO", "ERROR")


def outcome_of(error: Column) -> Column:
    """State after an attempt by the kind of its error (null: none)."""
    return F.when(error.isNull(), "OK").when(error == "not_found", "NO_ENCONTRADO").when(error.isin("config", "fault", "value", "xml"), "ERROR").otherwise("REINTENTO")


def number_attempts(events: DataFrame, key: str = "document_id", at: str = "at") -> DataFrame:
    return events.withColumn("attempt", F.row_number().over(Window.partitionBy(key).orderBy(at, "event_id")))


def claim_states(attempts: DataFrame, now: Column, attempts_allowed: int = ATTEMPTS, timeout_s: int = TIMEOUT_S) -> DataFrame:
    """State of each document after its numbered attempts (document_id, attempt, at, outcome; outcome null while in progress).

    A terminal outcome stands, whatever a later stale attempt says; an attempt in progress
    expires after the timeout; a retry beyond the allowed attempts is an error.
    """
    final = F.min_by("outcome", F.when(F.col("outcome").isin(*TERMINAL), F.col("attempt")))
    last = attempts.groupBy("document_id").agg(
        final.alias("final"), F.max("attempt").alias("attempts"), F.max_by("outcome", "attempt").alias("last_outcome"), F.max("at").alias("last_at")
    )
    age = F.unix_timestamp(now.cast("timestamp")) - F.unix_timestamp("last_at")
    state = (
        F.when(F.col("final").isNotNull(), F.col("final"))
        .when(F.col("last_outcome").isNull() & (age < timeout_s), "EN_CURSO")
        .when(F.col("attempts") >= attempts_allowed, "ERROR")
        .when(F.col("last_outcome").isNull(), "VENCIDO")
        .otherwise("REINTENTO")
    )
    return last.select("document_id", "attempts", "last_at", state.alias("state"))


def finish_attempts(asked: DataFrame, attempts: DataFrame, documents: DataFrame, xml: DataFrame, attempts_allowed: int = ATTEMPTS) -> DataFrame:
    """What becomes of attempts that end: asked (attempt_id, result), attempts (attempt_id, document_id, attempt, state),
    documents (document_id, state) and xml (attempt_id: those whose XML is registered).

    ``outcome`` is the attempt's final state, ``document_state`` the document's.  An attempt
    that isn't INICIADA has ended before (``operation`` YA_FINALIZADA) and changes nothing.  A
    registered XML makes it OK whatever was asked, and OK without one is an error; a retry
    beyond the allowed attempts is an error; a stale attempt can't overwrite a later state.
    """
    done = xml.select("attempt_id").distinct().withColumn("_xml", F.lit(True))
    before = documents.select("document_id", F.col("state").alias("_before"))
    rows = asked.join(attempts, "attempt_id").join(before, "document_id").join(done, "attempt_id", "left")
    ended, has_xml = F.col("state") != "INICIADA", F.coalesce("_xml", F.lit(False))
    result = (
        F.when(has_xml, "OK")
        .when(F.col("result") == "OK", "ERROR")
        .when((F.col("result") == "REINTENTO") & (F.col("attempt") >= attempts_allowed), "ERROR")
        .otherwise(F.col("result"))
    )
    current = F.col("_before") == "CONSULTANDO_DIAN"
    stale = ~current & (F.col("_before") != "REQUIERE_REVISION")
    moved = F.when(F.col("_result") == "OK", "XML_DESCARGADO").when(F.col("_result") == "NO_ENCONTRADO", "NO_ENCONTRADO").when(F.col("_result") == "REINTENTO", "PENDIENTE_DESCARGA").otherwise("ERROR")
    return rows.withColumn("_result", result).select(
        "attempt_id",
        "document_id",
        F.when(ended, "YA_FINALIZADA").otherwise("FINALIZADA").alias("operation"),
        F.when(ended, F.col("state")).when(stale, "ERROR").otherwise(F.col("_result")).alias("outcome"),
        F.when(~ended & current, moved).otherwise(F.col("_before")).alias("document_state"),
        (~ended & current & (F.col("_result") == "REINTENTO")).alias("retry"),
    )


#: A list of targets up to this many rows is sent to the other side's tasks, a longer one is joined by shuffles.
TARGETS = 10_000


def repairable(targets: DataFrame, documents: DataFrame, attempts: DataFrame, versions: DataFrame, load_rows: DataFrame, xml: DataFrame, client: int, load_id: int, error: str = "config") -> DataFrame:
    """``targets`` (document_id, attempt_id, version_id) with the ``problem`` that keeps each from being tried again, or null.

    A document can be repaired if it is the client's, last seen in this load and in ERROR, its
    version is current and has a valid row in the load, the attempt is its first, ended in an error of
    this kind, no later attempt exists, and no current XML does.  Repeated targets are a problem of
    each.  The others are looked for among the targets' documents only: the list is broadcast below a checked size.
    """
    small = targets.limit(TARGETS + 1).count() <= TARGETS
    hinted = F.broadcast(targets) if small else targets
    asked = F.broadcast(targets.select("document_id").distinct()) if small else targets.select("document_id").distinct()
    of = lambda df: df.join(asked, "document_id", "left_semi")
    mark = lambda df, keys, name: of(df).select(*keys).distinct().withColumn(name, F.lit(True))
    own = mark(documents.where((F.col("client_id") == client) & (F.col("load_id") == load_id) & (F.col("state") == "ERROR")), ["document_id"], "_own")
    first = mark(attempts.where((F.col("attempt") == 1) & (F.col("state") == "ERROR") & (F.col("error") == error)), ["document_id", "attempt_id"], "_first")
    later = mark(attempts.where("attempt > 1"), ["document_id"], "_later")
    current = mark(versions.where("is_current"), ["document_id", "version_id"], "_current")
    valid = mark(load_rows.where((F.col("load_id") == load_id) & (F.col("outcome") != "RECHAZADO")), ["document_id", "version_id"], "_valid")
    has_xml = mark(xml.where("is_current"), ["document_id"], "_xml")
    rows = hinted.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("document_id")))
    for part, keys in ((own, ["document_id"]), (first, ["document_id", "attempt_id"]), (later, ["document_id"]), (current, ["document_id", "version_id"]), (valid, ["document_id", "version_id"]), (has_xml, ["document_id"])):
        rows = rows.join(part, keys, "left")
    problem = (
        F.when(F.col("_n") > 1, "twice")
        .when(F.col("_own").isNull(), "document")
        .when(F.col("_current").isNull(), "version")
        .when(F.col("_first").isNull(), "attempt")
        .when(F.col("_valid").isNull(), "no valid row")
        .when(F.col("_later"), "tried again")
        .when(F.col("_xml"), "has XML")
    )
    return rows.select("document_id", "attempt_id", "version_id", problem.alias("problem"))


def repair_effects(judged: DataFrame, load_id: int, actor: str) -> dict[str, DataFrame]:
    """New states, events and queue messages of a repair batch, for ``commits.commit``; any target with a problem fails the whole batch."""
    wrong = F.raise_error(F.concat(F.lit("document "), F.coalesce(F.col("document_id").cast("string"), F.lit("null")), F.lit(" can't be repaired: "), F.col("problem")))
    good = judged.withColumn("document_id", F.when(F.col("problem").isNotNull(), wrong.cast("long")).otherwise(F.col("document_id").cast("long")))
    detail = F.to_json(F.struct(F.col("attempt_id").alias("attemptId"), F.lit("certificado_corregido").alias("reason")))
    message = F.to_json(F.struct(F.lit(1).alias("schemaVersion"), F.col("document_id").alias("documentId"), F.lit(load_id).alias("loadId")))
    return {
        "states": good.select("document_id", F.lit("PENDIENTE_DESCARGA").alias("state")),
        "events": good.select("document_id", F.lit(load_id).alias("load_id"), F.lit("ERROR").alias("from_state"), F.lit("PENDIENTE_DESCARGA").alias("to_state"), F.lit("REINTENTO_MANUAL").alias("kind"), F.lit(actor).alias("actor"), detail.alias("detail")),
        "messages": good.select("document_id", message.alias("value")),
    }


def repair_report(judged: DataFrame) -> DataFrame:
    """(problem, n): how many targets each problem has, "" those without one."""
    return judged.groupBy(F.coalesce("problem", F.lit("")).alias("problem")).agg(F.count(F.lit(1)).alias("n")).orderBy("problem")
