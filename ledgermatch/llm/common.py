"""Helpers shared by the corpus operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words are the runs between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Paths of the tables that ``store`` has written and nobody has deleted.
_STORED: list[str] = []


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is ``spark.checkpoint.dir`` of the session.  Only a local session without that
    setting gets a temporary folder, which goes when the process ends.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="ledgermatch-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here, executors may go."""
    path = f"{shared_dir(df.sparkSession)}/ledgermatch/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    _STORED.append(path)
    return out


def adopt(df: DataFrame, path: str) -> DataFrame:
    """``df``, which reads a table that an operator has written itself: ``release`` deletes it as if ``store`` had written it."""
    df.stored_at = path
    _STORED.append(path)
    return df


def free_name(name: str, taken: list[str]) -> str:
    """``name``, with as many "_" before it as it takes to clash with none of ``taken``, whatever their case."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``store`` that nothing will read again."""
    for df in tables:
        if df.stored_at in _STORED:
            _STORED.remove(df.stored_at)
            _delete(df.sparkSession, df.stored_at)


def mark() -> int:
    """How many tables are stored now, for ``release``."""
    return len(_STORED)


def release(spark: SparkSession, since: int = 0, keep: tuple[DataFrame, ...] = ()) -> None:
    """Delete all tables stored after ``since`` but ``keep``: what reads them must be written or done with.

    A returned DataFrame may still read stored tables, so operators leave their last ones; the
    pipeline calls this once a stage is written, other callers when they have the rows.
    """
    kept = {df.stored_at for df in keep}
    for path in _STORED[since:]:
        if path not in kept:
            _STORED.remove(path)
            _delete(spark, path)


def id_crc(col: str) -> Column:
    """crc32 of an id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))


def word_count(text: Column) -> Column:
    """Number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_key(text: Column) -> list[Column]:
    """128 bits that stand for a text in joins, so that the text itself need not move.

    Two null texts are equal, and differ from the empty text.
    """
    return [F.xxhash64(text, F.lit(1)).alias("_k1"), F.xxhash64(F.lit(2), text).alias("_k2")]


def packed(docs: DataFrame) -> DataFrame:
    """``docs`` as one struct column ``row``, so that helper columns can't clash with its own."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def id_text(col: str) -> Column:
    """An id as text that is never null, to join on; null differs from every id."""
    return F.coalesce(F.concat(F.lit("="), F.col(col).cast("string")), F.lit("null"))


def unfolded(df: DataFrame, count: str, ordinal: str, block: int = 1 << 14) -> DataFrame:
    """Each row as often as its column ``count`` says, numbered from 1 in ``ordinal``; none for 0 or less.

    Two steps, so that no array of a row is longer than the number of blocks or a block.
    """
    blocks = df.where(F.col(count) > 0).withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(count) - 1) / block).cast("long"))))
    first = F.col("_block") * block
    return blocks.withColumn(ordinal, F.explode(F.sequence(first + 1, F.least(first + block, F.col(count).cast("long"))))).drop("_block")


def numbered_copies(df: DataFrame, keys: list[str], ordinal: str = "copy") -> DataFrame:
    """One row per row of ``df[keys]``, with equal rows numbered from 1.

    Equal rows are counted before the shuffle, so a row that makes up a third of the table
    reaches the reducer as a few counts, and spreads again when the counts are unfolded.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return unfolded(counted, "_n", ordinal).select(*keys, ordinal)


def row_key(df: DataFrame) -> list[Column]:
    """128 bits of a whole row, to put rows that share their id and text in a fixed order; maps go as JSON."""
    cols = [F.to_json(F.struct(F.col(f"`{c}`"))) if "map<" in kind or kind in ("variant", "void") else F.col(f"`{c}`") for c, kind in df.dtypes]
    nulls = F.concat(F.lit(""), *[F.when(F.col(f"`{c}`").isNull(), "1").otherwise("0") for c in df.columns])
    return [F.xxhash64(F.lit(i), nulls, *cols) for i in (11, 12)]


def best(df: DataFrame, key: str, value: str, n: int, descending: bool = True) -> DataFrame:
    """(key, array of its ``n`` best distinct values).

    The limit is a ranking window, which Spark applies in every partition before the shuffle
    too: of a key with very many values each task sends ``n``, and no array is longer.
    """
    order = F.col(value).desc() if descending else F.col(value).asc()
    ranked = df.select(key, value).distinct().withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(order))).where(F.col("_rank") <= n)
    return ranked.groupBy(key).agg(F.sort_array(F.collect_list(value), asc=not descending).alias(value))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of an undirected graph given as rows (a, b); component is the smallest node.

    Alternates the large-star and small-star steps of "Connected Components in MapReduce and
    Beyond" (2014) until the edges no longer change.  Each round is written to the shared
    folder; nothing of the graph comes to the driver but a row count and a checksum.
    Nodes without an edge to another node are not returned.
    """
    now = store(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, now = now, store(moved.union(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        discard(before)
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
