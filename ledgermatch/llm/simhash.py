"""SimHash near duplicates: a byte-position inverted index with count filtering.

A text's fingerprint has 64 bits.  Bit i is 1 if more than half of the XXH64 values (seed 42)
of its word shingles have bit i; repeated shingles count each time.  Fingerprints of 2 or
fewer differing bits are linked.

Two differing bits touch at most two of the eight bytes, so linked fingerprints share at
least six bytes at equal positions.  Postings of single bytes would hold 1/256 of all
fingerprints each, so the index is keyed by the ``GRAM`` = 4 bytes at each of the 70 choices
of four positions.  A posting tallies the bytes that two of its members share at equal positions,
keeps the pairs with the guaranteed minimum of six, and verifies these bit by bit.  A pair meets
in as many postings as it has choices of four shared positions; it is tallied in the posting of
its first four alone, so it comes out once and only links leave a posting.

Tallying compares the members of a posting with each other.  In a posting of more than ``DENSE``
members links are found by neighbourhood instead: every member is listed under itself and each
of its 32 one-bit changes within the four free bytes, and two members link exactly if they meet
under one of those.  Equal fingerprints are merged before all this, so a group of copies of any
size is one member.

Null and empty texts and texts without a word have fingerprint 0 and link like any other.
A group whose doc_ids are all null has a null component_id.

``similar`` serves corpora instead of the definition above: shingles of five words, each once,
and only pairs whose sets of shingles are 0.8 alike (Jaccard) link.  Copies as far apart differ in
15 of 100 bits, so no byte of eight need be shared.  Its fingerprint has ``BYTES`` = 128 bytes, and
a text is indexed by its ``SURE`` = 18 surest ones only: those whose bits the shingles decide by such majorities
that a copy most likely has the same byte, and the same one among its surest.  The count filter asks that two texts
share at least ``COUNT`` = 2 of these at equal positions, so the index is keyed by two positions and their
bytes.  Members of a posting are compared by 128 bits, those of large postings by all 1024, then by their shingles.
"""

from __future__ import annotations

from itertools import combinations, repeat
from math import acos, pi, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from . import common

SHINGLE, SEED, MAX_BITS, DENSE = 3, 42, 2, 64
#: Of ``similar``: bytes of a fingerprint, surest ones of a text, how many of these two texts share, members that are compared at once.
WORDS, ALIKE, BYTES, SURE, COUNT, TILE = 5, 0.8, 128, 18, 2, 256
#: Postings of ``similar`` up to this size list all their pairs.
FEW = 12
#: Bytes of a key of the index; bytes that linked fingerprints share at least.
GRAM = 4
MIN_SHARED = 8 - MAX_BITS


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit fingerprint of one whole text, as an unsigned int."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    hashes = np.fromiter(map(xxh64_intdigest, grams, repeat(seed)), dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(text: Column, shingle: int = SHINGLE, seed: int = SEED) -> Column:
    """Fingerprints as signed longs, Arrow batch by Arrow batch."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(x, shingle, seed) for x in texts], dtype=np.uint64).view(np.int64))

    return of(text)


def hex16(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def _mask(positions) -> int:
    """The bytes at ``positions`` as a signed 64-bit mask."""
    m = sum(0xFF << (8 * p) for p in positions)
    return m - (1 << 64) if m >> 63 else m


def shared_bytes(x: Column) -> Column:
    """How many of the eight bytes of ``x`` are zero: the bytes that two fingerprints share, of their XOR."""
    for width in (4, 2, 1):
        x = x.bitwiseOR(F.shiftrightunsigned(x, width))
    return 8 - F.bit_count(x.bitwiseAND(F.lit(0x0101010101010101)))


def links(marks: DataFrame, dense: int = DENSE) -> DataFrame:
    """Edges (a, b) between the distinct fingerprints in column ``fp``.

    Each pair within ``MAX_BITS`` is connected by the edges, directly or over fingerprints
    that are linked to both.
    """
    chosen = list(combinations(range(8), GRAM))
    entries = [F.struct(F.lit(i).cast("byte").alias("choice"), F.col("fp").bitwiseAND(F.lit(_mask(c))).alias("shared")) for i, c in enumerate(chosen)]
    # 70 rows come of one: spread the fingerprints first, whatever the files that hold them.
    spread = marks.repartition(int(marks.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    index = spread.select("fp", F.explode(F.array(*entries)).alias("e")).select("fp", "e.*")
    # Lists have nothing to gain before the shuffle: plain rows are smaller there.
    postings = common.store(index.repartition("choice", "shared").groupBy("choice", "shared").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1), "postings")

    # Of a choice, the positions before its last that it leaves out: shared there, the pair belongs to an earlier choice.
    skipped = F.array(*[F.array(*[F.lit(_mask([p])) for p in range(c[-1]) if p not in c]).cast("array<bigint>") for c in chosen])

    def linked(a: Column, b: Column) -> Column:
        x = a.bitwiseXOR(b)
        first = F.forall("before", lambda m: x.bitwiseAND(m) != 0)
        return (a < b) & (shared_bytes(x) >= MIN_SHARED) & (F.bit_count(x) <= MAX_BITS) & first

    pairs = F.flatten(F.transform("fps", lambda a: F.transform(F.filter("fps", lambda b: linked(a, b)), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    small = postings.where(F.size("fps") <= dense).withColumn("before", F.element_at(skipped, F.col("choice") + 1))
    few = small.select(F.explode(pairs).alias("p")).select("p.*")

    def bit(i: int) -> int:
        return 1 << i if i < 63 else -(1 << 63)

    free = F.array(*[F.array(F.lit(0).cast("long"), *[F.lit(bit(8 * p + i)) for p in range(8) if p not in c for i in range(8)]) for c in chosen])
    full = postings.where(F.size("fps") > dense).select("choice", "shared", F.explode("fps").alias("fp"))
    full = full.withColumn("centre", F.explode(F.transform(F.element_at(free, F.col("choice") + 1), lambda m: m.bitwiseXOR(F.col("fp")))))
    # At most 33 members meet under a centre.
    stars = full.groupBy("choice", "shared", "centre").agg(F.sort_array(F.collect_list("fp")).alias("near")).where(F.size("near") > 1)
    stars = stars.select(F.col("near")[0].alias("a"), F.explode(F.slice("near", 2, 32)).alias("b"))
    return few.union(stars).distinct()


def near_duplicates(docs: DataFrame, dense: int = DENSE) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp, group (smallest fingerprint of the group), component_id, and the text's key."""
    rows = common.store(docs.select("doc_id", *common.text_key(F.col("text")), fingerprints(F.col("text")).alias("fp")), "fingerprints")
    marks = common.store(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "marks")
    found = common.components(links(marks.select("fp"), dense)).select(F.col("node").alias("fp"), F.col("component").alias("grp"))
    marks = marks.join(found, "fp", "left").withColumn("grp", F.coalesce("grp", "fp"))
    groups = marks.groupBy("grp").agg(F.min("first_id").alias("component_id"))
    classes = common.store(marks.join(groups, "grp").select("fp", "grp", "component_id"), "classes")
    return rows.join(classes, "fp")


def shingle_set(text: str | None, shingle: int = WORDS, seed: int = SEED) -> np.ndarray:
    """The distinct XXH64 values of a text's word shingles, sorted; a text of fewer words is one shingle."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    return np.unique(np.fromiter(map(xxh64_intdigest, grams, repeat(seed)), dtype="<u8"))


def wide(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ``BYTES`` bytes of the fingerprint of a set of shingles, and the places (position << 8 | byte) of its ``SURE`` surest, ascending."""
    ones = np.zeros(8 * BYTES, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 12):
        x, parts = hashes[at : at + (1 << 12)], []
        for _ in range(BYTES // 8):
            x = x * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD6E8FEB86659FD93)
            x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            x = x ^ (x >> np.uint64(32))
            parts.append(x)
        ones += np.unpackbits(np.stack(parts, axis=1).view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    fp = np.packbits(2 * ones > len(hashes), bitorder="little")
    # How likely a bit turns in a copy falls with its majority; a byte is as sure as its bits together.
    doubt = np.exp(-np.abs(2 * ones - len(hashes)) / sqrt(max(1, len(hashes)))).reshape(BYTES, 8).sum(axis=1).round(9)
    places = np.arange(BYTES, dtype=np.int64) << 8 | fp
    # Equally sure bytes stand in an order that all texts share.
    sure = np.lexsort((places * 0x9E3779B1 & 0xFFFFFFFF, doubt))[:SURE]
    return fp, np.sort(places[sure])


def differing(bits: int, similarity: float) -> int:
    """Bits of a fingerprint that texts of a Jaccard similarity differ in, and 3.3 standard deviations more."""
    turned = acos(2 * similarity / (1 + similarity)) / pi
    return min(bits, int(bits * turned + 3.3 * sqrt(bits * turned * (1 - turned))))


def similar(docs: DataFrame, shingle: int = WORDS, similarity: float = ALIKE, dense: int = FEW) -> DataFrame:
    """One row per row of ``docs``: doc_id, grp (a key of the group of near copies), and the text's key.

    In postings of more than ``dense`` texts each text first meets the first one and the one before it;
    members that these links leave in different groups are then compared with each other, tile by tile.
    """
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    firsts, seconds = np.array(list(combinations(range(SURE), COUNT))).T

    @F.pandas_udf("fp array<long>, sure array<int>")
    def mark(texts: pd.Series) -> pd.DataFrame:
        found = [wide(shingle_set(x, shingle)) for x in texts]
        return pd.DataFrame({"fp": [f.view(np.int64) for f, _ in found], "sure": [s.astype(np.int32) for _, s in found]})

    @F.pandas_udf("array<int>")
    def keys(sure: pd.Series) -> pd.Series:
        return pd.Series([(x[firsts] << 15) | x[seconds] for x in sure], dtype=object)

    @F.pandas_udf("array<long>")
    def shingles(texts: pd.Series) -> pd.Series:
        return pd.Series([shingle_set(x, shingle).view(np.int64) for x in texts], dtype=object)

    def bits(a: Column, b: Column) -> Column:
        return F.bit_count(a["fp0"].bitwiseXOR(b["fp0"])) + F.bit_count(a["fp1"].bitwiseXOR(b["fp1"]))

    rows = common.store(docs.select("doc_id", *common.text_key(F.col("text")), mark(F.col("text")).alias("m")).select("doc_id", "_k1", "_k2", "m.*"), "marks")
    nodes = rows.groupBy(F.col("_k1").alias("node")).agg(F.first("fp").alias("fp"), F.first("sure").alias("sure")).repartition(partitions, "node")
    index = nodes.select("node", F.col("fp")[0].alias("fp0"), F.col("fp")[1].alias("fp1"), F.explode(keys("sure")).alias("key"))

    # A posting is streamed in the order of its members, so that none is gathered whole.
    posting = Window.partitionBy("key").orderBy("node")
    whole = posting.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    me = F.struct("node", "fp0", "fp1")
    met = index.select("key", me.alias("e"), F.count(F.lit(1)).over(whole).alias("size"), F.first(me).over(whole).alias("first"), F.collect_list(me).over(posting.rowsBetween(-max(1, dense - 1), -1)).alias("before")).where("size > 1")
    others = F.when(F.col("size") <= dense, F.col("before")).otherwise(F.concat(F.array("first"), F.slice("before", -1, 1)))
    near = F.filter(others, lambda o: (o["node"] < F.col("e.node")) & (bits(o, F.col("e")) <= differing(128, similarity)))
    pair = F.transform(near, lambda o: F.struct(o["node"].alias("a"), F.col("e.node").alias("b"), bits(o, F.col("e")).alias("bits"), F.lit(None).cast("int").alias("key")))
    member = F.when(F.col("size") > dense, F.array(F.struct(F.col("e.node").alias("a"), F.lit(None).cast("long").alias("b"), F.lit(None).cast("int").alias("bits"), F.col("key")))).otherwise(F.array())
    # One pass gives the pairs and the members of large postings.
    seen = common.store(met.where((F.col("size") > dense) | (F.size("before") > 0)).select(F.explode(F.concat(pair, member)).alias("p")).select("p.*"), "met")
    pairs = common.store(seen.where("key IS NULL").select("a", "b", "bits").distinct(), "candidates")
    large = common.store(seen.where("key IS NOT NULL").select("key", F.col("a").alias("node")), "large")
    common.discard(seen)

    def sets_of(some: DataFrame) -> DataFrame:
        wanted = some.select(F.col("a").alias("node")).union(some.select("b")).distinct()
        texts = docs.select(common.text_key(F.col("text"))[0].alias("node"), "text").join(wanted, "node", "left_semi")
        return common.store(texts.select("node", shingles("text").alias("s")).dropDuplicates(["node"]), "shingles")

    def alike(some: DataFrame, sets: DataFrame) -> DataFrame:
        """The pairs (a, b) that are as similar as asked."""
        both = some.join(sets.select(F.col("node").alias("a"), F.col("s").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("s").alias("y")), "b")
        shared = F.size(F.array_intersect("x", "y"))
        return both.where(shared >= similarity * (F.size("x") + F.size("y") - shared)).select("a", "b")

    def nearest(some: DataFrame) -> DataFrame:
        """Of each text the pair of fewest bits and the one of the smallest partner."""
        ends = some.select("a", "b", F.col("a").alias("node"), "bits").union(some.select("a", "b", "b", "bits"))
        closest = ends.groupBy("node").agg(F.min(F.struct("bits", "a", "b")).alias("p")).select("p.a", "p.b")
        return closest.union(ends.groupBy("node").agg(F.min(F.struct("a", "b")).alias("p")).select("p.a", "p.b")).distinct()

    def apart(some: DataFrame, groups: DataFrame) -> DataFrame:
        of = lambda end: groups.select(F.col("node").alias(end), F.col("component").alias(f"c_{end}"))
        return some.join(of("a"), "a", "left").join(of("b"), "b", "left").where(F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).select(*some.columns)

    def settled(links: DataFrame, some: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Links and groups with those of ``some``: pairs that others have connected need no look."""
        sets = sets_of(some)
        links = common.store(links.union(alike(nearest(some), sets)), "links")
        links = common.store(links.union(alike(apart(some, common.components(links)), sets)), "links")
        common.discard(sets)
        return links, common.components(links)

    links, groups = settled(pairs.select("a", "b").limit(0), pairs)
    # Pairs looked at before are linked, dissimilar or connected by others.
    wanted = mixed(large.withColumn("i", F.lit(0)), groups)
    marked = wanted.join(nodes.select("node", F.col("fp")[0].alias("fp0"), F.col("fp")[1].alias("fp1"), "fp"), "node").select("i", "key", F.struct("node", "fp0", "fp1", "fp").alias("e"), "c", "size")
    every_bit = lambda a, b: F.aggregate(F.zip_with(a["fp"], b["fp"], lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    close = lambda a, b: (bits(a, b) <= differing(128, similarity)) & (every_bit(a, b) <= differing(8 * BYTES, similarity))
    ends = lambda a, b: F.struct(F.least(a["node"], b["node"]).alias("a"), F.greatest(a["node"], b["node"]).alias("b"), bits(a, b).alias("bits"))
    rest = common.store(between(marked, close, ends).join(pairs.select("a", "b"), ["a", "b"], "left_anti"), "candidates")
    if not rest.isEmpty():
        links, groups = settled(links, rest)
    found = groups.select(F.col("node").alias("_k1"), "component")
    return rows.select("doc_id", "_k1", "_k2").join(found, "_k1", "left").select("doc_id", F.coalesce("component", "_k1").alias("grp"), "_k1", "_k2")


def mixed(members: DataFrame, groups: DataFrame) -> DataFrame:
    """``members`` (i, key, node, ...) of postings with more than one of the ``groups``: with their group ``c`` and the posting's ``size``."""
    each = members.join(groups.select("node", F.col("component").alias("c")), "node", "left").withColumn("c", F.coalesce("c", "node"))
    sizes = each.groupBy("i", "key").agg(F.min("c").alias("least"), F.max("c").alias("most"), F.count(F.lit(1)).alias("size")).where("least <> most")
    return each.join(sizes.select("i", "key", "size"), ["i", "key"])


def across(large: DataFrame, groups: DataFrame, near, pair, tile: int = TILE) -> DataFrame:
    """(a, b, bits): the near pairs within large postings (i, key, of) whose ends are in different ``groups``."""
    members = large.select("i", "key", F.explode("of").alias("e")).select("i", "key", "e", "e.node")
    return between(mixed(members, groups).select("i", "key", "e", "c", "size"), near, pair, tile)


def between(members: DataFrame, near, pair, tile: int = TILE) -> DataFrame:
    """The near pairs (a, b, bits) of members (i, key, e, c, size) of a posting that are in different groups ``c``.

    A posting is cut into tiles of about ``tile`` members by a hash; two tiles meet in a row of their
    own, so the work on one posting spreads over the tasks.
    """
    sized = members.withColumn("tiles", F.ceil(F.col("size") / tile).cast("int"))
    sized = sized.withColumn("t", F.pmod(F.xxhash64("e.node"), F.col("tiles")).cast("int"))
    tiles = sized.groupBy("i", "key", "t", "tiles").agg(F.collect_list(F.struct("e.*", "c")).alias("of"))
    meet = tiles.select("i", "key", "of", F.explode(F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda u: F.struct(F.least("t", u).alias("lo"), F.greatest("t", u).alias("hi"), (F.col("t") > u).alias("second")))).alias("m"))
    meet = meet.groupBy("i", "key", "m.lo", "m.hi").agg(F.collect_list(F.when(~F.col("m.second"), F.col("of"))).alias("x"), F.collect_list(F.when(F.col("m.second"), F.col("of"))).alias("y"))
    meet = meet.withColumns({"x": F.flatten("x"), "y": F.flatten("y")}).withColumn("y", F.when(F.col("lo") == F.col("hi"), F.col("x")).otherwise(F.col("y")))
    every = F.flatten(F.transform("x", lambda a: F.transform(F.filter("y", lambda b: (a["c"] != b["c"]) & near(a, b)), lambda b: pair(a, b))))
    return meet.select(F.explode(every).alias("p")).select("p.*").distinct()


def drop_near_duplicates(docs: DataFrame, similarity: float | None = None, **options) -> DataFrame:
    """The documents without near copies: of each group the one with the smallest doc_id stays.

    With a ``similarity`` the groups are those of ``similar``, else those of ``near_duplicates``.
    Columns stay as they are.  Rows that tie on doc_id are told apart by the text's key, then by
    a hash of all columns, and complete repeats count as one.
    """
    own = near_duplicates(docs, **options) if similarity is None else similar(docs, similarity=similarity, **options)
    keep = own.groupBy("grp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_k1", "_k2")).alias("m")).select("m.doc_id", "m._k1", "m._k2")
    keep = keep.select(common.id_text("doc_id").alias("id"), "_k1", "_k2")
    key1, key2 = common.row_key(docs)
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.struct(key1.alias("r1"), key2.alias("r2")).alias("order"))
    keyed = keyed.select("row", "order", common.id_text("row.doc_id").alias("id"), *common.text_key(F.col("row.text")))
    return keyed.join(keep, ["id", "_k1", "_k2"], "left_semi").groupBy("id", "_k1", "_k2").agg(F.min_by("row", "order").alias("row")).select("row.*")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint, component_id of every document."""
    found = near_duplicates(common.read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")
