"""Compression of vectors to codes by Lloyd rounds whose members stay with their owners.

Every component x becomes the integer floor(4096 x); a vector is cut into ``PARTS`` equal
parts, and each part position has a codebook of ``ENTRIES`` entries.  The owner of an entry is
(length, position, entry, salt); its members, as blocks of at most about ``OWNER`` parts, are
resident: a round reads them where they are stored, joins the position's codebook (a row of a
few hundred numbers) and looks for each member's nearest entry.  Members that keep theirs stay
in their block and are not shuffled; only the others migrate, packed by their new entry, and
are merged into blocks of their new owner.  A new owner gets a salt for each ``OWNER`` arrivals,
so an entry that holds a third of all parts is many blocks, in many tasks.  Owners sum their
members block by block, and the sums of an entry meet as one row of partial sums a task.

Nothing is collected to the driver but the size of the codebooks: it is their proven bound
for a broadcast (at most ``BOOKS`` numbers; beyond that Spark chooses the join).  Each round is
a table in the shared folder, so executors may go at any time.

Defined cases: rows whose vector is null or holds null or non-finite components are dropped;
zero vectors take part.  The first codebook takes equal vec_ids in the order of their vectors,
null ids last; with fewer than ``ENTRIES`` vectors there are as many entries.  Vectors of
another length are a table of their own with codebooks of their own (so is their hash); a length that
``PARTS`` doesn't divide is filled up with zeros; an empty vector has entry 0 and no error.
Integers beyond +-2^62 count as that; where 64 bits don't hold a distance, Python's integers
are used, and errors beyond a long are the largest long.  Repeated rows each give a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .neardup_vectors import _vector

SCALE, PARTS, ENTRIES, ROUNDS, OWNER, BOOKS = 4096, 8, 16, 6, 4096, 1 << 22
#: ``entry`` is -1 before the first round; ``high`` and ``low`` are the members' sum, split at 32 bits.
BLOCK = "length int, position int, entry int, moved boolean, members array<long>, numbers array<long>, high array<long>, low array<long>"
LARGEST, EDGE = (1 << 63) - 1, 1 << 62
OWNED = ["length", "position", "entry"]


def finite(vector: Column) -> Column:
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))


def kept(table: DataFrame) -> DataFrame:
    """(member, vec_id, label, vector) of the rows that take part; member is a row's own number."""
    good = table.select(F.col("vec_id").cast("long"), "label", _vector(table)).where(finite(F.col("vector")))
    return common.store(good.select(F.monotonically_increasing_id().alias("member"), "*"), "vectors")


def integers(vectors: np.ndarray, parts: int) -> np.ndarray:
    """(vector, part, component) of floor(``SCALE`` x) for vectors of one length."""
    whole = np.clip(np.floor(SCALE * vectors.astype(np.float64)), -EDGE, EDGE).astype(np.int64)
    width = -(-whole.shape[1] // parts)
    return np.pad(whole, ((0, 0), (0, width * parts - whole.shape[1]))).reshape(len(whole), parts, width)


def _halves(numbers: np.ndarray) -> tuple[list[int], list[int]]:
    """The sum over the rows, split at 32 bits so that sums of many blocks don't overflow either half."""
    low = (numbers & 0xFFFFFFFF).sum(0)
    high = (numbers >> 32).sum(0) + (low >> 32)
    return high.tolist(), (low & 0xFFFFFFFF).tolist()


def _block(length: int, position: int, entry: int, moved: bool, members: np.ndarray, numbers: np.ndarray) -> tuple:
    return (length, position, entry, moved, members, numbers.ravel(), *_halves(numbers))


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[x.split()[0] for x in BLOCK.split(", ")])


def cut(vectors: DataFrame, parts: int, owner: int) -> DataFrame:
    """Blocks of parts that no entry owns yet."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for length, same in batch.groupby(batch["vector"].map(len)):
                for at in range(0, len(same), owner):
                    some = same.iloc[at : at + owner]
                    x = integers(np.stack(some["vector"].to_list()) if length else np.zeros((len(some), 0)), parts)
                    yield _frame([_block(length, p, -1, True, some["member"].to_numpy(), x[:, p]) for p in range(parts)])

    return vectors.select("member", "vector").mapInPandas(of, BLOCK)


def first_books(vectors: DataFrame, parts: int, entries: int) -> DataFrame:
    """(length, position, book): the parts of the vectors with the smallest ids, book a flat array of all entries."""
    rank = F.row_number().over(Window.partitionBy("length").orderBy(F.col("vec_id").asc_nulls_last(), "vector", "member"))
    seeds = vectors.select("vec_id", "vector", "member", F.size("vector").alias("length")).withColumn("rank", rank).where(F.col("rank") <= entries)

    def of(_: tuple, group: pd.DataFrame) -> pd.DataFrame:
        length, group = int(group["length"].iloc[0]), group.sort_values("rank")
        x = integers(np.stack(group["vector"].to_list()) if length else np.zeros((len(group), 0)), parts)
        return pd.DataFrame({"length": length, "position": range(parts), "entries": len(group), "book": [x[:, p].ravel() for p in range(parts)]})

    return seeds.groupBy("length").applyInPandas(of, "length int, position int, entries int, book array<long>")


def nearest(numbers: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of each part's nearest entry, ties to the lower one; exact at every size."""
    if not numbers.shape[1]:
        return np.zeros(len(numbers), np.int64), np.zeros(len(numbers), np.int64)
    top = max(abs(int(x)) for x in (numbers.min(), numbers.max(), book.min(), book.max()))
    exact = 4 * numbers.shape[1] * top * top
    if exact < 1 << 53:  # doubles hold all that is added up
        a, b = numbers.astype(np.float64), book.astype(np.float64)
        d = (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)
    else:
        kind = np.int64 if exact < 1 << 63 else object
        d = np.stack([((numbers.astype(kind) - b) ** 2).sum(1) for b in book.astype(kind)], axis=1)
    entry = d.argmin(1)
    return entry, np.minimum(d[np.arange(len(d)), entry], LARGEST if d.dtype == object else np.inf).astype(np.int64)


def _with_books(blocks: DataFrame, books: DataFrame) -> DataFrame:
    return blocks.join(books, ["length", "position"])


def _open(row) -> tuple[np.ndarray, np.ndarray]:
    return np.asarray(row.numbers, np.int64).reshape(len(row.members), -1), np.asarray(row.book, np.int64).reshape(row.entries, -1)


def step(blocks: DataFrame, books: DataFrame, owner: int) -> DataFrame:
    """Blocks of those that stay, and of those that move, packed by their new entry."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            stay, go = [], {}
            for row in batch.itertuples(index=False):
                numbers, book = _open(row)
                entry, _ = nearest(numbers, book)
                members = np.asarray(row.members, np.int64)
                for e in np.unique(entry).tolist():
                    mine = entry == e
                    if e == row.entry:
                        stay.append(_block(row.length, row.position, e, False, members[mine], numbers[mine]))
                    else:
                        go.setdefault((row.length, row.position, e), []).append((members[mine], numbers[mine]))
            for key, some in go.items():
                members, numbers = (np.concatenate(x) for x in zip(*some, strict=True))
                for at in range(0, len(members), owner):
                    stay.append(_block(*key, True, members[at : at + owner], numbers[at : at + owner]))
            yield _frame(stay)

    return _with_books(blocks, books).mapInPandas(of, BLOCK)


def migrated(moving: DataFrame, owner: int) -> DataFrame:
    """Arrivals merged to blocks of their new owners: the only rows of a round that are shuffled."""
    salts = moving.groupBy(*OWNED).agg(F.ceil(F.sum(F.size("members")) / owner).cast("int").alias("salts"))
    dealt = moving.join(salts, OWNED).withColumn("salt", F.pmod(F.xxhash64(F.col("members")[0], "position"), F.col("salts")))
    flat = lambda name: F.flatten(F.transform("got", lambda x: x[name])).alias(name)
    merged = dealt.groupBy(*OWNED, "salt").agg(F.collect_list(F.struct("members", "numbers")).alias("got"))
    return merged.select(*OWNED, F.lit(False).alias("moved"), flat("members"), flat("numbers"), F.lit(None).cast("array<long>").alias("high"), F.lit(None).cast("array<long>").alias("low"))


def updated(books: DataFrame, stepped: DataFrame) -> DataFrame:
    """Entries replaced by the floor of their members' mean; entries without members stay."""
    each = stepped.select(*OWNED, F.size("members").alias("n"), F.posexplode(F.arrays_zip("high", "low")).alias("at", "s"))
    total = F.sum(F.col("s.high").cast("decimal(38,0)")) * F.lit(1 << 32) + F.sum(F.col("s.low").cast("decimal(38,0)"))
    sums = each.groupBy(*OWNED, "at").agg(total.cast("decimal(38,0)").alias("total"), F.sum("n").cast("decimal(20,0)").alias("n"))
    means = sums.select(*OWNED, "at", F.expr("CAST((total - pmod(total, n)) div n AS bigint)").alias("mean"))
    old = books.select("length", "position", "entries", F.posexplode("book").alias("place", "x"))
    width = F.expr("count(1) OVER (PARTITION BY length, position) div entries")
    old = old.withColumn("width", width).select("length", "position", "entries", F.expr("CAST(place div width AS int)").alias("entry"), F.expr("CAST(place % width AS int)").alias("at"), "place", "x")
    new = old.join(means, [*OWNED, "at"], "left").groupBy("length", "position", "entries").agg(F.sort_array(F.collect_list(F.struct("place", F.coalesce("mean", "x").alias("x")))).alias("b"))
    empty = books.where(F.size("book") == 0)
    return new.select("length", "position", "entries", F.transform("b", lambda z: z["x"]).alias("book")).unionByName(empty)


def assigned(blocks: DataFrame, books: DataFrame) -> DataFrame:
    """(member, position, entry, error) of every part of every vector."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                entry, error = nearest(*_open(row))
                yield pd.DataFrame({"member": np.asarray(row.members, np.int64), "position": row.position, "entry": entry, "error": error})

    return _with_books(blocks, books).mapInPandas(of, "member long, position int, entry int, error long")


def lloyd(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, owner: int = OWNER) -> tuple[DataFrame, DataFrame]:
    """(resident blocks, codebooks) after all rounds."""
    books, blocks, tables = common.store(first_books(vectors, parts, entries), "books"), None, [common.store(cut(vectors, parts, owner), "parts")]
    # codebooks keep their size, so one look decides for all rounds
    hinted = F.broadcast if (books.agg(F.sum(F.size("book"))).first()[0] or 0) <= BOOKS else lambda x: x
    for _ in range(rounds):
        blocks = reduce(DataFrame.unionByName, tables).select("length", "position", "entry", "members", "numbers") if blocks is None else blocks
        stepped = common.store(step(blocks, hinted(books), owner), "parts")
        arrived = common.store(migrated(stepped.where("moved"), owner), "parts")
        before, books = books, common.store(updated(books, stepped), "books")
        common.discard(before, *tables)
        tables = [stepped, arrived]
        blocks = stepped.where("NOT moved").unionByName(arrived).select("length", "position", "entry", "members", "numbers")
    return blocks if blocks is not None else tables[0], hinted(books)


def codes(table: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, owner: int = OWNER) -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256: a row for each vector that takes part."""
    vectors = kept(table)
    blocks, books = lloyd(vectors, parts, entries, rounds, owner)
    bounded = lambda total: F.least(total, F.lit(LARGEST).cast("decimal(38,0)")).cast("long")
    digits = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("position", "entry"))), lambda z: F.lower(F.lpad(F.hex(z["entry"]), 2, "0"))), "")
    per = assigned(blocks, books).groupBy("member").agg(digits.alias("code"), bounded(F.sum(F.col("error").cast("decimal(38,0)"))).alias("error"))
    entry_text = F.array_join(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("position", "book"))), lambda z: z["book"])), ",")
    hashes = books.groupBy("length").agg(F.sha2(entry_text, 256).alias("codebooks_sha256"))
    rows = common.store(vectors.select("member", "vec_id", "label", F.size("vector").alias("length")).join(per, "member").join(hashes, "length").drop("member", "length"), "codes")
    # a label may hold a third of all rows: its sum is dealt to 16 salts
    sums = rows.groupBy("label").agg(bounded(F.sum(F.col("error").cast("decimal(38,0)"))).alias("label_error"))
    sums = sums.select(F.col("label").alias("_label"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("_salt"))
    salted = rows.withColumn("_s", F.pmod(F.xxhash64("vec_id", "code"), F.lit(16)).cast("int"))
    return salted.join(sums, F.col("label").eqNullSafe(F.col("_label")) & (F.col("_s") == F.col("_salt"))).select("vec_id", "label", "code", "error", "label_error", "codebooks_sha256")


def op12_vectorcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes, errors and the codebooks' hash of every vector."""
    return codes(common.read_table(spark, sf_dir, "embeddings")).drop("label")


def _sql() -> str:
    """The same rounds, unrolled over a table of single components."""
    body = [
        f"""kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, embedding, len(embedding) // {PARTS} AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        """parts AS MATERIALIZED (SELECT r, (i - 1) // w AS p, (i - 1) % w AS j, CAST(floor(4096 * CAST(embedding[i] AS DOUBLE)) AS HUGEINT) AS x
  FROM (SELECT r, w, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM kept))""",
        f"b0 AS MATERIALIZED (SELECT p, r - 1 AS e, j, x AS c FROM parts WHERE r <= {ENTRIES})",
    ]
    for k in range(ROUNDS + 1):
        body.append(
            f"""a{k} AS MATERIALIZED (SELECT r, p, e, d FROM (SELECT r, p, e, sum((x - c) * (x - c)) AS d FROM parts JOIN b{k} USING (p, j) GROUP BY r, p, e)
  QUALIFY row_number() OVER (PARTITION BY r, p ORDER BY d, e) = 1)"""
        )
        if k < ROUNDS:
            body.append(
                f"""b{k + 1} AS MATERIALIZED (SELECT p, e, j, coalesce(CAST((s - ((s % n) + n) % n) // n AS HUGEINT), c) AS c FROM b{k}
  LEFT JOIN (SELECT p, e, j, sum(x) AS s, count(*) AS n FROM parts JOIN a{k} USING (r, p) GROUP BY p, e, j) USING (p, e, j))"""
            )
    last = f"""SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, j)) FROM b{ROUNDS}) AS codebooks_sha256
FROM kept JOIN (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY r) USING (r)"""
    return "WITH " + ",\n".join(body) + "\n" + last


OP12_SQL = _sql()
