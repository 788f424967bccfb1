"""One batch to several tables: all of it, or nothing that a reader sees.

Every table of a batch is written to a folder of this attempt; a marker file that names batch
and attempt is created last, and only if no other attempt has created it.  Readers take the
attempts that markers name, so what a lost or slower attempt has left is never read.  A batch
that has its marker isn't written again.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DONE, AGAIN = "CONFIRMADO", "YA_CONFIRMADO"
_PARTS = "batch string, attempt string"


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _marker(root: str, batch_id: str) -> tuple[str, str]:
    name = hashlib.sha256(batch_id.encode()).hexdigest()[:32]
    return name, f"{root}/_batches/{name}.json"


def committed(spark: SparkSession, root: str, batch_id: str) -> bool:
    at, files = _files(spark, _marker(root, batch_id)[1])
    return files.exists(at)


def commit(spark: SparkSession, root: str, batch_id: str, tables: dict[str, DataFrame | Callable[[dict[str, DataFrame]], DataFrame]]) -> str:
    """Write a batch to its tables in the order given: CONFIRMADO, or YA_CONFIRMADO if it was there.

    A table may be a function of the tables of this batch written before it, which it reads
    as they were written: nothing that one table shows can differ from the others.
    """
    name, marker = _marker(root, batch_id)
    if committed(spark, root, batch_id):
        return AGAIN
    attempt, written = uuid.uuid4().hex, {}
    for table, rows in tables.items():
        rows = rows(written) if callable(rows) else rows
        path = f"{root}/{table}/batch={name}/attempt={attempt}"
        rows.write.parquet(path)
        written[table] = spark.read.schema(rows.schema).parquet(path)
    at, files = _files(spark, marker)
    files.mkdirs(at.getParent())
    try:
        out = files.create(at, False)
    except Exception as e:
        if "already exists" in str(e).lower() or "FileAlreadyExists" in str(e):
            return AGAIN
        raise
    out.write(bytearray(json.dumps({"batch": name, "attempt": attempt, "id": batch_id}).encode()))
    out.close()
    return DONE


def read(spark: SparkSession, root: str, table: str, schema: str) -> DataFrame:
    """The rows of all committed batches; an empty table if there is none."""
    if not all(files.exists(at) for at, files in (_files(spark, f"{root}/{x}") for x in ("_batches", table))):
        return spark.createDataFrame([], schema)
    markers = spark.read.schema(_PARTS).json(f"{root}/_batches")
    rows = spark.read.schema(f"{schema}, {_PARTS}").option("basePath", f"{root}/{table}").parquet(f"{root}/{table}")
    return rows.join(markers, ["batch", "attempt"], "left_semi").drop("batch", "attempt")
