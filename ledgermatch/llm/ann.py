"""Approximate nearest neighbours by NN-descent and greedy graph search.

Nearness is the inner product.  Vectors are dealt into bands by length: band b holds those
whose length is between 2**-(b+1) and 2**-b of the longest.  Within a band the usual reduction
of inner products to angles applies: divided by the band's top length and given one more
coordinate, all vectors are equally long.  Each of them is kept as bytes on a scale of its
own, so no vector sets the resolution of another one, and sums of products are exact in any
order: the graph doesn't depend on how rows are dealt.  A double has room for some 2,200 bands.

1. Start: ``GROUPINGS`` random groupings of each band into groups of about ``GROUP`` vectors,
   in which all meet.  Nothing about the data is used; groups are small by the hash.
2. NN-descent: each node brings its neighbours and up to ``REVERSE`` nodes that have it as a
   neighbour (those that are new first, then by hash) together: neighbours of neighbours.  Two
   of them meet if one is new, that is, has not been brought together at this node before.
   Each is told of its ``SENT`` nearest there that beat its last neighbour.  Rounds go on until
   less than ``CHANGED`` of all entries are new; every table, also the smallest, runs them.
3. Search: a query starts, in each band, from its own node's neighbours and from ``ENTRIES``
   nodes of the band drawn by hash, and keeps the ``POOL`` nearest nodes seen.  Each step
   expands all of these that were not expanded yet, by a join with the graph, until no query
   has one left.  The pools are ranked by inner products of the original vectors in double
   precision.

A node with very many askers is a key of a plain join, which adaptive execution splits; lists
of the n nearest are cut by a ranking window, in each task before the shuffle too.

Exactly equal vectors are one node that remembers its ``TOP`` + 1 smallest ids; no query needs
more of them.  Vectors that are null, zero or hold null or non-finite components take part
neither as queries nor as candidates.  Vectors of another number of components have no inner
product: each number of components is a table of its own, searched after another, and a vec_id
that has vectors of several is a query in each.  Complete repeats count once.  Scores that exceed a double are infinite, and tie.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .neardup_vectors import _vector, log2_length, usable

TOP, EVERY = 20, 20
K, REVERSE, SENT, GROUPINGS, GROUP, CHANGED, ENTRIES, POOL, SEED = 32, 16, 8, 5, 8, 0.02, 8, 192, 1
FOUND = "node long, v long, s double"


def nodes_of(good: DataFrame, top: int = TOP) -> DataFrame:
    """(node, vector, ids): distinct vectors of ``good`` (vec_id, vector), each with its smallest vec_ids."""
    ids = common.best(good.withColumnRenamed("vec_id", "id"), "vector", "id", top + 1, descending=False).withColumnRenamed("id", "ids")
    return common.store(ids.select(F.col("ids")[0].alias("node"), "vector", "ids"), "nodes")


def quantized(nodes: DataFrame) -> DataFrame:
    """(node, band, q): a step in single precision, then one byte per coordinate and one for the added one."""
    sized = nodes.select("node", "vector", log2_length(F.col("vector")).alias("log"))
    longest = sized.agg(F.max("log")).first()[0] or 0.0
    sized = sized.withColumn("band", F.floor(F.lit(longest) - F.col("log")).cast("int"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows == 0:
                continue
            v = b["vector"].flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(b.num_rows, -1)
            largest = np.abs(v).max(1)
            top = longest - b["band"].to_numpy()
            w = v / largest[:, None] * np.exp2(np.log2(largest) - top)[:, None]
            w = np.concatenate([w, np.sqrt(np.maximum(1 - (w * w).sum(1), 0))[:, None]], axis=1)
            step = (np.abs(w).max(1) / 127).astype("<f4")
            q = np.clip(np.rint(w / step[:, None]), -127, 127).astype(np.int8)
            raw = np.concatenate([step[:, None].view(np.int8), q], axis=1)
            yield pa.RecordBatch.from_arrays([b["node"], b["band"], pa.array([x.tobytes() for x in raw], pa.binary())], names=["node", "band", "q"])

    return sized.select("node", "band", "vector").mapInArrow(of, "node long, band int, q binary")


def _read(q: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(steps, coordinates) of binary values of one length; sums of products of the coordinates are exact."""
    if not len(q):
        return np.zeros(0), np.zeros((0, 1), dtype=np.float32)
    ends = np.frombuffer(q.buffers()[1], dtype=np.int32)[q.offset : q.offset + len(q) + 1]
    raw = np.frombuffer(q.buffers()[2], dtype=np.int8)[ends[0] : ends[-1]].reshape(len(q), -1)
    steps = np.ascontiguousarray(raw[:, :4]).view("<f4")[:, 0].astype(np.float64)
    return steps, raw[:, 4:].astype(np.float32 if raw.shape[1] < 1000 else np.float64)


def _cut(keys: tuple[np.ndarray, ...], v: np.ndarray, s: np.ndarray, n: int) -> np.ndarray:
    """Places of the n entries (v, s) of largest s of each key, without repeats."""
    order = np.lexsort((v, -s, *keys))
    same = np.ones(len(order), dtype=bool)
    same[:1] = False
    for k in keys:
        same[1:] &= k[order][1:] == k[order][:-1]
    again = same.copy()
    again[1:] &= v[order][1:] == v[order][:-1]
    order, same = order[~again], same[~again]
    begin = np.flatnonzero(~same)
    rank = np.arange(len(order)) - np.repeat(begin, np.diff(np.append(begin, len(order))))
    return order[rank < n]


def meetings(groups: DataFrame, sent: int) -> DataFrame:
    """Rows (node, v, s) of what the members of groups (v, fresh, least, q: lists) tell each other."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = b["v"].value_lengths().to_numpy()
            begin = np.cumsum(sizes) - sizes
            ids, least = b["v"].flatten().to_numpy(), b["least"].flatten().to_numpy()
            fresh = b["fresh"].flatten().to_numpy(zero_copy_only=False)
            step, x = _read(b["q"].flatten())
            found: list[tuple] = []
            for lo in range(0, len(sizes), 128):
                own = sizes[lo : lo + 128]
                most = int(own.max())
                real = np.arange(most) < own[:, None]
                at = np.where(real, begin[lo : lo + 128, None] + np.arange(most), 0)
                m, t, f = ids[at], step[at], fresh[at] & real
                s = np.matmul(x[at], x[at].transpose(0, 2, 1)).astype(np.float64) * (t[:, :, None] * t[:, None, :])
                ok = (f[:, :, None] | f[:, None, :]) & real[:, :, None] & real[:, None, :] & (m[:, :, None] != m[:, None, :]) & (s > least[at][:, :, None])
                s[~ok] = -np.inf
                k = min(sent, most)
                best = np.argpartition(-s, k - 1, axis=2)[:, :, :k]
                top = np.take_along_axis(s, best, 2)
                g, i, j = np.nonzero(top > -np.inf)
                found.append((m[g, i], m[g, best[g, i, j]], top[g, i, j]))
            if found:
                node, v, s = (np.concatenate(c) for c in zip(*found, strict=True))
                keep = _cut((node,), v, s, K)
                yield pa.RecordBatch.from_arrays([pa.array(node[keep]), pa.array(v[keep]), pa.array(s[keep])], names=["node", "v", "s"])

    return groups.select("v", "fresh", "least", "q").mapInArrow(of, FOUND)


def merged(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """(keys, near): the n nearest distinct entries of rows (keys, v, s, fresh), nearest first; what comes as old anywhere stays old."""
    ranked = rows.withColumn("_r", F.dense_rank().over(Window.partitionBy(*keys).orderBy(F.desc("s"), "v"))).where(F.col("_r") <= n)
    lists = ranked.groupBy(*keys).agg(F.sort_array(F.collect_set(F.struct((-F.col("s")).alias("n"), "v"))).alias("near"), F.collect_set(F.when(~F.col("fresh"), F.col("v"))).alias("old"))
    entry = lambda e: F.struct((-e["n"]).alias("s"), e["v"].alias("v"), (~F.array_contains("old", e["v"])).alias("fresh"))
    return lists.select(*keys, F.transform("near", entry).alias("near"))


def _flat(lists: DataFrame, *keys: str) -> DataFrame:
    return lists.select(*keys, F.explode("near").alias("e")).select(*keys, "e.v", "e.s", "e.fresh")


def start_graph(vectors: DataFrame) -> DataFrame:
    """(node, near): neighbours among random groups of each band."""
    sizes = vectors.groupBy("band").agg(F.greatest(F.lit(1), F.floor(F.count(F.lit(1)) / GROUP)).alias("groups"))
    each = vectors.join(F.broadcast(sizes), "band")  # one row per band
    deal = lambda g: F.struct(F.lit(g).alias("g"), F.pmod(F.xxhash64(F.lit(SEED), F.lit(g), "node"), F.col("groups")).alias("at"))
    dealt = each.withColumn("d", F.explode(F.array(*[deal(g) for g in range(GROUPINGS)])))
    lists = dealt.groupBy("band", "d").agg(F.collect_list("node").alias("v"), F.collect_list("q").alias("q"))
    groups = lists.select("v", "q", F.transform("v", lambda _: F.lit(True)).alias("fresh"), F.transform("v", lambda _: F.lit(float("-inf"))).alias("least"))
    return common.store(merged(meetings(groups, 4 * GROUP).withColumn("fresh", F.lit(True)), ["node"], K), "graph")


def reverse(edges: DataFrame) -> DataFrame:
    """(u, v, fresh): of each node up to ``REVERSE`` nodes that have it as a neighbour."""
    order = Window.partitionBy("v").orderBy(F.desc("fresh"), F.xxhash64(F.lit(SEED), "u", "v"), "u")
    drawn = edges.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= REVERSE)
    return drawn.select(F.col("v").alias("u"), F.col("u").alias("v"), "fresh")


def descend(graph: DataFrame, vectors: DataFrame) -> DataFrame:
    """One round of NN-descent."""
    edges = _flat(graph, "node").select(F.col("node").alias("u"), "v", "fresh")
    last = graph.select(F.col("node").alias("v"), F.when(F.size("near") >= K, F.element_at("near.s", -1)).otherwise(F.lit(float("-inf"))).alias("least"))
    info = vectors.select(F.col("node").alias("v"), "q").join(last, "v")
    members = edges.union(reverse(edges)).join(info, "v")
    lists = [F.collect_list(c).alias(c) for c in ("v", "fresh", "least", "q")]
    met = members.groupBy("u").agg(*lists).where(F.exists("fresh", lambda f: f))
    news = meetings(met, SENT).withColumn("fresh", F.lit(True))
    return common.store(merged(_flat(graph, "node").withColumn("fresh", F.lit(False)).union(news), ["node"], K), "graph")


def build(vectors: DataFrame, changed: float = CHANGED, rounds: int | None = None) -> DataFrame:
    """The neighbour graph (node, near); ``rounds`` stops the descent early, for measurements."""
    graph, done = start_graph(vectors), 0
    while rounds is None or done < rounds:
        new, total = graph.agg(F.sum(F.size(F.filter("near", lambda e: e["fresh"]))), F.sum(F.size("near"))).first()
        if not total or new < changed * total:
            break
        before, graph, done = graph, descend(graph, vectors), done + 1
        common.discard(before)
    return graph


def scored(asks: DataFrame, pool: int) -> DataFrame:
    """Rows (node, band, v, s) of asks (node, band, q, least, vs, qs) that beat ``least``; s leaves the added coordinate out."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            node, band, least = (b[c].to_numpy() for c in ("node", "band", "least"))
            own_step, own = _read(b["q"])
            sizes = b["vs"].value_lengths().to_numpy()
            ends = np.cumsum(sizes)
            v, q = b["vs"].flatten().to_numpy(), b["qs"].flatten()
            found: list[tuple] = []
            for lo in range(0, len(sizes), 512):
                part = sizes[lo : lo + 512]
                row = lo + np.repeat(np.arange(len(part)), part)
                begin = int(ends[lo] - sizes[lo])
                step, x = _read(q.slice(begin, len(row)))
                ids = v[begin : begin + len(row)]
                s = np.einsum("ij,ij->i", own[row][:, :-1], x[:, :-1]).astype(np.float64) * (own_step[row] * step)
                ok = (s > least[row]) & (ids != node[row])
                found.append((node[row[ok]], band[row[ok]], ids[ok], s[ok]))
            if found:
                n, t, ids, s = (np.concatenate(c) for c in zip(*found, strict=True))
                keep = _cut((n, t), ids, s, pool)
                yield pa.RecordBatch.from_arrays([pa.array(n[keep]), pa.array(t[keep], pa.int32()), pa.array(ids[keep]), pa.array(s[keep])], names=["node", "band", "v", "s"])

    return asks.select("node", "band", "q", "least", "vs", "qs").mapInArrow(of, "node long, band int, v long, s double")


def search(queries: DataFrame, graph: DataFrame, vectors: DataFrame, pool: int = POOL) -> DataFrame:
    """(node, band, near): the pools of every query node (column node) after greedy search."""
    edges = _flat(graph, "node").select(F.col("node").alias("u"), "v", "fresh")
    around = edges.union(reverse(edges)).select("u", "v").distinct().join(vectors.select(F.col("node").alias("v"), "q"), "v")
    around = common.store(around.groupBy("u").agg(F.collect_list("v").alias("vs"), F.collect_list("q").alias("qs")), "around")
    own = common.store(queries.join(vectors, "node").select("node", F.col("band").alias("home"), "q"), "asked")

    drawn = Window.partitionBy("band").orderBy(F.xxhash64(F.lit(SEED), "node"), "node")
    entries = vectors.withColumn("_r", F.row_number().over(drawn)).where(F.col("_r") <= ENTRIES).orderBy("band", "node").collect()
    doors = F.array(*[F.struct(F.lit(r["band"]).alias("band"), F.lit(r["node"]).alias("v")) for r in entries])
    if not entries:
        return own.select("node", F.lit(0).alias("band"), F.lit(None).cast("array<struct<s:double,v:long,fresh:boolean>>").alias("near"))
    begin = own.select("node", F.explode(doors).alias("d")).select("node", "d.band", "d.v")
    begin = begin.union(own.join(graph, "node").select("node", F.col("home").alias("band"), F.explode("near.v").alias("v"))).distinct()
    begin = begin.join(vectors.select(F.col("node").alias("v"), F.col("q").alias("qv")), "v").join(own.select("node", "q"), "node")
    first = scored(begin.select("node", "band", "q", F.lit(float("-inf")).alias("least"), F.array("v").alias("vs"), F.array("qv").alias("qs")), pool)
    state = common.store(merged(first.withColumn("fresh", F.lit(True)), ["node", "band"], pool), "pool")
    while not state.where(F.exists("near", lambda e: e["fresh"])).isEmpty():
        least = F.when(F.size("near") >= pool, F.element_at("near.s", -1)).otherwise(F.lit(float("-inf")))
        asks = state.select("node", "band", least.alias("least"), F.explode(F.filter("near", lambda e: e["fresh"])["v"]).alias("u"))
        asks = asks.join(own.select("node", "q"), "node").join(around, "u")
        rows = _flat(state, "node", "band").withColumn("fresh", F.lit(False)).union(scored(asks, pool).withColumn("fresh", F.lit(True)))
        before, state = state, common.store(merged(rows, ["node", "band"], pool), "pool")
        common.discard(before)
    common.discard(around)
    return state


def nearest(table: DataFrame, is_query: Column, top: int = TOP, pool: int = POOL, rounds: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` nearest of each query row of (vec_id, embedding).

    ``is_query`` is a condition on a column ``vec_id``.
    """
    good = table.select(F.col("vec_id").cast("long"), _vector(table)).where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    sizes = sorted(r[0] for r in good.select(F.size("vector")).distinct().collect())  # as many as there are kinds of vectors
    parts = [_nearest(good.where(F.size("vector") == d), is_query, top, pool, rounds) for d in sizes or [0]]
    return reduce(DataFrame.union, parts)


def _nearest(good: DataFrame, is_query: Column, top: int, pool: int, rounds: int | None) -> DataFrame:
    """``nearest`` among vectors of one number of components."""
    nodes = nodes_of(good, top)
    vectors = common.store(quantized(nodes), "vectors")
    graph = build(vectors, rounds=rounds)
    asked = good.where(is_query).distinct()
    asked = common.store(asked.join(nodes.select("vector", "node"), "vector").select("vec_id", "node"), "queries")
    pools = search(asked.select("node").distinct(), graph, vectors, pool)

    # The query's own node is a candidate too: other ids may have the same vector.
    cand = pools.select("node", F.explode("near.v").alias("v")).union(asked.select("node", "node")).distinct()
    cand = cand.join(nodes.select("node", F.col("vector").alias("x")), "node").join(nodes.select(F.col("node").alias("v"), F.col("vector").alias("y"), "ids"), "v")
    double = lambda a, b: a.cast("double") * b.cast("double")
    score = F.aggregate(F.zip_with("x", "y", double), F.lit(0.0), lambda s, p: s + p)
    entry = F.struct((-F.col("score")).alias("s"), F.col("id").alias("id"))
    # Bounded groups: a pool per band with at most top + 1 ids a node.
    ranked = cand.select("node", score.alias("score"), F.explode("ids").alias("id")).groupBy("node").agg(F.slice(F.sort_array(F.collect_list(entry)), 1, top + 1).alias("best"))
    out = asked.join(ranked, "node").select(F.col("vec_id").alias("query_id"), F.slice(F.filter("best", lambda e: e["id"] != F.col("vec_id")), 1, top).alias("best"))
    return out.select("query_id", F.posexplode("best").alias("at", "e")).select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("e.id").alias("vec_id"), (-F.col("e.s")).alias("score"))


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20."""
    return nearest(common.read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % EVERY == 0)
