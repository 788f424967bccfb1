"""Sharding by a two-pass external shuffle.

Pass one scatters the records uniformly over buckets by a seeded hash; the number of buckets
follows the number of bytes, so that one bucket fits in a task's memory whatever the size of
the table.  Pass two puts each bucket in Fisher-Yates order with a generator seeded by the
bucket.  The buckets one after the other are a random permutation of the whole table; of N
records that at position i goes to shard floor(i * n / N), so a shard is a run of positions
and a bucket lies in one shard or two: it is written by the task that has shuffled it.  This
is the law ``rows``: shard sizes differ by one row at most and slots have no gaps.

The hash takes all columns and the number of the copy among equal rows.  Keys of 128 bits tell
which rows may have an equal one; only those are counted before the shuffle and numbered, so
many equal rows, or one id or text in a third of the rows, spread over all buckets like any
others, and all other records cross the network once.  Null columns take part as such.  The
result depends on the rows and the seed only, not on how the input is split.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from . import common

SHARDS, SEED, BUCKET_BYTES = 16, 3, 4 << 20


def placed(df: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES, row_bytes: int = 100) -> DataFrame:
    """(row, shard int, slot long) of each row of ``df``; row is a struct of all its columns, whatever their names and types.

    ``row_bytes`` is the space of a row besides its strings.  The counts that come to the
    driver are two numbers.
    """
    key = [k.alias(f"k{i}") for i, k in enumerate(common.row_key(df), 1)]
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    sizes = [F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c, kind in df.dtypes if kind in ("string", "binary")]
    records = common.store(df.select(row, *key, sum(sizes, F.lit(row_bytes).cast("long")).alias("bytes")), "records")
    total, n = records.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count(F.lit(1))).first()
    buckets = max(1, -(-total // bucket_bytes))

    repeated = common.store(records.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("k1", "k2"), "repeated")
    once = records.join(repeated, ["k1", "k2"], "left_anti").select("row", "k1", "k2", F.lit(1).cast("long").alias("copy"))
    counted = records.join(repeated, ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.first("row").alias("row"), F.count(F.lit(1)).alias("_n"))
    again = common.unfolded(counted, "_n", "copy").select("row", "k1", "k2", "copy")
    copies = once.union(again).withColumn("h", F.xxhash64(F.lit(seed), "k1", "k2", "copy"))
    copies = copies.withColumn("bucket", F.pmod("h", F.lit(buckets))).select("bucket", "h", "copy", "row")

    # 4 MB of records are one bucket, 4096 buckets one run: what is summed in one task is a row per run
    counts = copies.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).withColumn("run", F.floor(F.col("bucket") / 4096))
    runs = counts.groupBy("run").agg(F.sum("n").alias("m"))
    runs = runs.select("run", (F.sum("m").over(Window.orderBy("run")) - F.col("m")).alias("before"))
    inside = F.sum("n").over(Window.partitionBy("run").orderBy("bucket")) - F.col("n")
    starts = common.store(counts.withColumn("inside", inside).join(runs, "run").select("bucket", (F.col("before") + F.col("inside")).alias("start")), "starts")

    def fisher_yates(group: pa.Table) -> pa.Table:
        group = group.sort_by([("h", "ascending"), ("copy", "ascending")])
        order = np.arange(group.num_rows)
        if group.num_rows:
            np.random.default_rng([seed, group["bucket"][0].as_py()]).shuffle(order)  # Fisher-Yates
            order += group["start"][0].as_py()
        return group.select(["row"]).append_column("at", pa.array(order, pa.int64()))

    schema = StructType([copies.schema["row"], StructField("at", LongType())])
    done = copies.join(starts, "bucket").groupBy("bucket").applyInArrow(fisher_yates, schema)
    n = max(n, 1)
    to = F.expr(f"(at * {shards}L) div {n}L")
    first = F.expr(f"(((at * {shards}L) div {n}L) * {n}L + {shards - 1}L) div {shards}L")  # the shard's first position
    return done.select("row", to.cast("int").alias("shard"), (F.col("at") - first).cast("long").alias("slot"))


def names(columns: list[str]) -> tuple[str, str]:
    """What the columns shard and slot are called beside ``columns``: with "_" before names that these have."""
    return common.free_name("shard", columns), common.free_name("slot", columns)


def external_shuffle(df: DataFrame, **options) -> DataFrame:
    """``df`` and the columns shard and slot (see ``names``) of each row."""
    shard, slot = names(df.columns)
    return placed(df, **options).select(*[F.col(f"row.`{c}`").alias(c) for c in df.columns], F.col("shard").alias(shard), F.col("slot").alias(slot))


def write_shards(df: DataFrame, path: str, **options) -> DataFrame:
    """Write the shuffled records as one folder per shard, and read them back with their shard and slot.

    Each task of the second pass writes one file per shard, in the order of slots, from the
    buckets it holds: the records are not moved again.
    """
    shard, slot = names(df.columns)
    external_shuffle(df, **options).sortWithinPartitions(shard, slot).write.partitionBy(shard).option("compression", "zstd").parquet(path)
    schema = StructType([*df.schema.fields, StructField(slot, LongType()), StructField(shard, IntegerType())])
    return common.adopt(df.sparkSession.read.schema(schema).parquet(path), path)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document, sharded by rows.

    The whole documents are shuffled and written to the shared folder as shards; size and
    text_crc32 come of the texts read from there.
    """
    docs = common.read_table(spark, sf_dir, "documents")
    done = write_shards(docs, f"{common.shared_dir(spark)}/ledgermatch/shards-{uuid.uuid4().hex}")
    shard, slot = names(docs.columns)
    text = F.coalesce(F.col("text"), F.lit(""))
    size = (F.octet_length(text) + 1).cast("long").alias("size")
    return done.select("doc_id", size, F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), F.col(shard).alias("shard"), F.col(slot).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
