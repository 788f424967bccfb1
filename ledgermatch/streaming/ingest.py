"""Streaming ingestion: messages to registries, at least once in, once out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import registry

VERSION = 1


def messages(stream: DataFrame, schema: str, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """(good, bad) messages: JSON of a fixed schema with schemaVersion 1; whatever doesn't fit is bad."""
    read = stream.withColumn("_m", F.from_json(F.col(column), f"schemaVersion int, {schema}"))
    good = F.coalesce(F.col("_m.schemaVersion") == VERSION, F.lit(False))
    return read.where(good).select("_m.*").drop("schemaVersion"), read.where(~good).drop("_m")


def read_folder(spark: SparkSession, path: str, schema: str, per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def register_stream(rows: DataFrame, table: str, key: list[str], order: list[str], checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append each key once to the Parquet folder ``table``.

    A micro-batch is resolved against what is stored, so a batch that is delivered again adds
    nothing.
    """

    def add(batch: DataFrame, _id: int) -> None:
        spark = batch.sparkSession
        try:
            stored = spark.read.schema(batch.schema).parquet(table)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            stored = batch.limit(0)
        registry.append_new(stored, batch, key, order).write.mode("append").parquet(table)

    writer = rows.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="5 minutes")).start()


def dead_letters(bad: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return bad.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def poison(deliveries: DataFrame, allowed: int = 5) -> DataFrame:
    """(message_id, value, deliveries) of messages whose ``allowed``-th delivery has failed, each once.

    ``deliveries`` is a stream (message_id, value, failed, at).  The number of failed
    deliveries is the message's state, so it goes on over micro-batches and restarts; a delivery that
    succeeds forgets it.  What is in the dead letters is not sent there again.  Append mode.
    """
    import pandas as pd
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def step(key: tuple, batches, state: GroupState):
        n = state.get[0] if state.exists else 0
        for _, row in pd.concat(list(batches)).sort_values("at", kind="stable").iterrows():
            if n >= allowed:
                continue
            n = n + 1 if row["failed"] else 0
            if n == allowed:
                yield pd.DataFrame({"message_id": [key[0]], "value": [row["value"]], "deliveries": [n]})
        state.update((n,)) if n else state.remove()

    keyed = deliveries.select("message_id", "value", F.coalesce("failed", F.lit(False)).alias("failed"), "at").groupBy("message_id")
    return keyed.applyInPandasWithState(step, "message_id string, value string, deliveries int", "n int", "append", GroupStateTimeout.NoTimeout)


def fetch_all(claimed: DataFrame, fetch: Callable[[str], bytes]) -> DataFrame:
    """(document_id, content, error) for claimed documents through a pluggable fetcher, in the workers."""
    import pandas as pd

    def of(batches):
        for batch in batches:
            rows = []
            for key in batch["document_id"]:
                try:
                    rows.append((key, fetch(key), None))
                except Exception as e:  # the outcome of an attempt is data
                    rows.append((key, None, type(e).__name__))
            yield pd.DataFrame(rows, columns=["document_id", "content", "error"])

    return claimed.select(F.col("document_id").cast("string")).mapInPandas(of, "document_id string, content binary, error string")


def claim_stream(events: DataFrame, timeout_s: int = 540, attempts_allowed: int = 5) -> DataFrame:
    """(document_id, attempts, state) after every batch of attempt events (document_id, outcome).

    A custom stateful operator: a null outcome starts an attempt, which expires by processing
    time; a terminal outcome stands against later events of stale workers.
    """
    import pandas as pd
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    from ..operators.claims import TERMINAL

    def step(key: tuple, batches, state: GroupState):
        attempts, current = state.get if state.exists else (0, "PENDIENTE")
        if state.hasTimedOut:
            current = "ERROR" if attempts >= attempts_allowed else "VENCIDO"
            state.update((attempts, current))
        else:
            for batch in batches:
                for outcome in batch["outcome"]:
                    if current in TERMINAL:
                        continue
                    if outcome is None or pd.isna(outcome):
                        attempts, current = attempts + 1, "EN_CURSO"
                    elif outcome == "REINTENTO" and attempts >= attempts_allowed:
                        current = "ERROR"
                    else:
                        current = outcome
            state.update((attempts, current))
            if current == "EN_CURSO":
                state.setTimeoutDuration(timeout_s * 1000)
        yield pd.DataFrame({"document_id": [key[0]], "attempts": [attempts], "state": [current]})

    return events.groupBy("document_id").applyInPandasWithState(step, "document_id string, attempts int, state string", "attempts int, state string", "update", GroupStateTimeout.ProcessingTimeTimeout)
