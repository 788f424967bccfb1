"""Embedding near duplicates by a subspace pigeonhole join.

Vectors are scaled to length 1 and turned by a seeded random rotation, which spreads their
variance evenly, and then split into blocks of ``BLOCK`` dimensions.  A cosine of at least t
is a squared distance of at most 2 - 2t; if two vectors are that near, then in one block at
least they are within that block's share of the squared distance, in proportion to its
dimensions.  So each block is range-joined under its own budget: vectors are dealt to cells of
two radii a side in the block's first two coordinates; a cell meets itself, and of two
neighbouring cells only those rows meet that are within a radius of the border between them.
Inside a task the rows are sorted by the third coordinate and compared within a radius there
too.  What is within the budget in the block is verified with the cosine of the original
vectors in double precision.  The union over the blocks misses no link.

A pair may qualify in several blocks and counts in the first only.  Cells are dealt in tiles
of at most about ``TILE`` rows a side, so a task's memory is bounded and a full cell is the
work of many tasks.  A tile gives counts of links per vector and the edges of a spanning
forest, never its pairs.  Exactly equal vectors are one class with a number of members; each
member links to the others of its class.  Vectors of different length have no cosine; their
lengths are part of the cell.

The work that remains grows with the product of the rows of neighbouring cells: the radius is
fixed by the cosine, so the cells don't become more as the table grows (see README).

Vectors that are null, zero or hold null or non-finite components, and rows without vec_id,
link with nothing (a row without vec_id has no component and isn't kept).  Lengths are taken
after division by the largest component, so no vector over- or underflows.  A vec_id that
comes more than once is one node with the links of all its vectors; complete repeats count
once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

COSINE, BLOCK, TILE, SEED = 0.95, 16, 16_384, 4
CELL = "dim int, block int, cx int, cy int, step int, side int"


def usable(vector: Column) -> Column:
    """Has the vector only finite components, and one that isn't 0?"""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _vector(table: DataFrame) -> Column:
    """The embeddings as they are if single, else in double precision."""
    kind = table.schema["embedding"].dataType.simpleString()
    return F.col("embedding").cast(kind if kind == "array<float>" else "array<double>").alias("vector")


def log2_length(vector: Column) -> Column:
    """Binary logarithm of a usable vector's length; nothing over- or underflows."""
    top = F.array_max(F.transform(vector, lambda x: F.abs(x.cast("double"))))
    parts = F.transform(vector, lambda x: F.pow(x.cast("double") / top, F.lit(2.0)))
    return F.log2(top) + F.log2(F.aggregate(parts, F.lit(0.0), lambda s, x: s + x)) / 2


@lru_cache(maxsize=8)
def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def classes(table: DataFrame) -> DataFrame:
    """(node, vector, members, ids): the distinct usable vectors; members counts their vec_ids, node is the smallest."""
    good = table.select(F.col("vec_id").cast("long"), _vector(table)).where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    return good.distinct().groupBy("vector").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("members"))


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the graph with edges (a, b)."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = top(x), top(y)
        if p != q:
            up[max(p, q)] = min(p, q)
            kept.append((x, y))
    return kept


def unit(v: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision, by way of their largest component."""
    v = v.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _link_tile(one: pd.DataFrame, two: pd.DataFrame | None, block: int, turn: np.ndarray, cosine: float, size: int) -> pd.DataFrame:
    """Links between two tiles (of one tile if two is None) whose first qualifying block is ``block``."""
    budget = (2 - 2 * cosine) * (1 + 1e-6) + 1e-9
    dim = len(turn)
    cuts = [(lo, min(lo + size, dim)) for lo in range(0, dim, size)]
    sort_at = min(cuts[block][0] + 2, cuts[block][1] - 1)

    def load(tile: pd.DataFrame):
        v = unit(np.stack(tile["vector"].to_numpy()))
        r = v @ turn
        order = np.argsort(r[:, sort_at], kind="stable")
        return tile["node"].to_numpy()[order], tile["members"].to_numpy()[order], v[order], r[order]

    ids, weight, v, r = load(one)
    ids2, weight2, v2, r2 = load(two) if two is not None else (ids, weight, v, r)
    lo, hi = cuts[block]
    x, y = np.ascontiguousarray(r[:, lo:hi]), np.ascontiguousarray(r2[:, lo:hi])
    xx, yy = (x * x).sum(1).astype(np.float32), (y * y).sum(1).astype(np.float32)
    x32, y32 = x.astype(np.float32), y.astype(np.float32)
    share = np.float32(budget * (hi - lo) / dim + 1e-5)  # single precision errs on the safe side
    count, count2 = np.zeros(len(ids), dtype=np.int64), np.zeros(len(ids2), dtype=np.int64)
    edges: list[tuple[int, int]] = []
    reach = float(np.sqrt(share)) + 1e-6
    for at in range(0, len(x), 512):
        part = r[at : at + 512, sort_at]
        first, end = np.searchsorted(r2[:, sort_at], [part[0] - reach, part[-1] + reach], side="left")
        first = max(first, at) if two is None else first
        near = (xx[at : at + 512, None] + yy[None, first:end]) - 2 * (x32[at : at + 512] @ y32[first:end].T) <= share
        i, j = np.nonzero(near)
        i, j = i + at, j + first
        if two is None:
            keep = i < j
            i, j = i[keep], j[keep]
        for part in range(0, len(i), 100_000):
            p, q = i[part : part + 100_000], j[part : part + 100_000]
            d = (r[p] - r2[q]) ** 2
            by_block = np.add.reduceat(d, [c[0] for c in cuts], axis=1)
            own = by_block <= budget * np.array([c[1] - c[0] for c in cuts]) / dim
            ok = own[:, block] & ~own[:, :block].any(axis=1)
            p, q = p[ok], q[ok]
            ok = np.einsum("ij,ij->i", v[p], v2[q]) >= cosine
            p, q = p[ok], q[ok]
            count += np.bincount(p, weights=weight2[q], minlength=len(ids)).astype(np.int64)
            count2 += np.bincount(q, weights=weight[p], minlength=len(ids2)).astype(np.int64)
            edges = _forest(np.concatenate([[e[0] for e in edges], ids[p]]).astype(np.int64), np.concatenate([[e[1] for e in edges], ids2[q]]).astype(np.int64)) if len(p) else edges
    out = pd.DataFrame({"node": np.concatenate([ids, ids2]), "links": np.concatenate([count, count2])})
    out = out[out["links"] > 0].assign(other=None)
    if edges:
        out = pd.concat([out, pd.DataFrame({"node": [e[0] for e in edges], "links": 0, "other": [e[1] for e in edges]})])
    return out.astype({"node": "int64", "links": "int64", "other": "Int64"})


def _radius(width: int, dim: int, cosine: float) -> float:
    return float(np.sqrt((2 - 2 * cosine) * 1.000001 * width / dim + 1e-9))


def _places(v: np.ndarray, cosine: float, size: int, seed: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(block, step, side, rows, cx, cy) for the rows of a matrix: where each has to be.

    A task is the cell (cx, cy) and a step: 0 the cell by itself, 1 to 4 the cell (side 0) with
    the one before it in x, in y, in both, and before in x but after in y (side 1).
    """
    r = unit(v) @ rotation(v.shape[1], seed)
    dim = v.shape[1]
    for block, lo in enumerate(range(0, dim, size)):
        width = min(size, dim - lo)
        side_of = 2 * _radius(width, dim, cosine)
        at = r[:, lo : lo + min(width, 2)] / side_of
        cell = np.floor(at).astype(np.int64)
        low, high = at - cell <= 0.5 + 1e-9, at - cell >= 0.5 - 1e-9
        if width == 1:
            cell, low, high = (np.concatenate([c, np.zeros_like(c)], axis=1) for c in (cell, low, high))
        (x, y), (lx, ly), (hx, hy) = cell.T, low.T, high.T
        every = np.ones(len(x), dtype=bool)
        for step, side, ok, dx, dy in ((0, 0, every, 0, 0), (1, 0, lx, 0, 0), (1, 1, hx, 1, 0), (2, 0, ly, 0, 0), (2, 1, hy, 0, 1), (3, 0, lx & ly, 0, 0), (3, 1, hx & hy, 1, 1), (4, 0, lx & hy, 0, 0), (4, 1, hx & ly, 1, -1)):
            rows = np.flatnonzero(ok)
            yield block, step, side, rows, x[rows] + dx, y[rows] + dy


def _batches(b: pa.RecordBatch, cosine: float, size: int, seed: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows of a batch (dim, node, members, vector) at their places: (columns of CELL, places in the batch)."""
    dims = b["dim"].to_numpy()
    for dim in np.unique(dims):
        own = np.flatnonzero(dims == dim)
        v = np.asarray(b["vector"].take(pa.array(own)).flatten().to_numpy(zero_copy_only=False)).reshape(len(own), -1)
        for block, step, side, rows, cx, cy in _places(v, cosine, size, seed):
            const = [pa.array(np.full(len(rows), c), pa.int32()) for c in (dim, block, step, side)]
            yield pa.RecordBatch.from_arrays([*const[:2], pa.array(cx, pa.int32()), pa.array(cy, pa.int32()), *const[2:]], names=[c.split()[0] for c in CELL.split(", ")]), own[rows]


def link_rows(nodes: DataFrame, cosine: float = COSINE, size: int = BLOCK, tile: int = TILE, seed: int = SEED) -> DataFrame:
    """Rows (node, links, other): numbers of links found in a tile (other null), and forest edges node - other."""
    kind = nodes.schema["vector"].dataType.simpleString()
    flat = nodes.select(F.size("vector").alias("dim"), "node", "members", "vector")
    cell = ["dim", "block", "cx", "cy", "step"]

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for places, _ in _batches(b, cosine, size, seed):
                counted = pa.Table.from_batches([places.append_column("one", pa.array(np.ones(places.num_rows, dtype=np.int64)))]).group_by(places.schema.names).aggregate([("one", "sum")])
                yield from counted.rename_columns([*places.schema.names, "n"]).to_batches()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for places, rows in _batches(b, cosine, size, seed):
                own = b.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([*places.columns, own["node"], own["members"], own["vector"]], names=[*places.schema.names, "node", "members", "vector"])

    counts = flat.mapInArrow(sizes, f"{CELL}, n long").groupBy(*cell).agg(F.sum(F.when(F.col("side") == 0, F.col("n"))).alias("n0"), F.sum(F.when(F.col("side") == 1, F.col("n"))).alias("n1"))
    # Cells without a counterpart, or with one row of their own, have nothing to compare.
    counts = counts.where(F.when(F.col("step") == 0, F.col("n0") > 1).otherwise(F.col("n0").isNotNull() & F.col("n1").isNotNull()))
    tiles = lambda c: F.ceil(F.col(c) / tile).cast("int")
    counts = common.store(counts.select(*cell, tiles("n0").alias("t0"), F.coalesce(tiles("n1"), tiles("n0")).alias("t1")), "tiles")

    mine = flat.mapInArrow(place, f"{CELL}, node long, members long, vector {kind}").join(counts, cell)
    own = F.pmod(F.xxhash64("node"), F.when(F.col("side") == 0, F.col("t0")).otherwise(F.col("t1"))).cast("int")
    pair = lambda i, j, side: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(side).alias("side"))
    t, upto = F.col("t"), lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    alone = F.concat(F.transform(F.filter(upto("t0"), lambda j: j >= t), lambda j: pair(t, j, 0)), F.transform(F.filter(upto("t0"), lambda i: i < t), lambda i: pair(i, t, 1)))
    to = F.when(F.col("step") == 0, alone).when(F.col("side") == 0, F.transform(upto("t1"), lambda j: pair(t, j, 0))).otherwise(F.transform(upto("t0"), lambda i: pair(i, t, 1)))
    dealt = mine.withColumn("t", own).select(*cell, "node", "members", "vector", F.explode(to).alias("d")).select(*cell, "node", "members", "vector", "d.*")

    def of(group: pd.DataFrame) -> pd.DataFrame:
        one, two = group[group["side"] == 0], group[group["side"] == 1]
        alone = bool(group["step"].iloc[0] == 0 and group["i"].iloc[0] == group["j"].iloc[0])
        if not len(one) or not (alone or len(two)):
            return pd.DataFrame({"node": [], "links": [], "other": []}).astype({"node": "int64", "links": "int64", "other": "Int64"})
        return _link_tile(one, None if alone else two, int(group["block"].iloc[0]), rotation(int(group["dim"].iloc[0]), seed), cosine, size)

    return dealt.groupBy(*cell, "i", "j").applyInPandas(of, "node long, links long, other long")


def near_vectors(table: DataFrame, **options) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of (vec_id, embedding)."""
    nodes = common.store(classes(table), "vectors")
    found = common.store(link_rows(nodes, **options), "links")
    counts = found.where("other is null").groupBy("node").agg(F.sum("links").alias("links"))
    groups = common.components(found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    info = nodes.select("node", "members", "vector").join(counts, "node", "left").join(groups, "node", "left")
    info = info.select("vector", (F.coalesce("links", F.lit(0)) + F.col("members") - 1).alias("n"), F.coalesce("component", "node").alias("c"))
    ids = table.select(F.col("vec_id").cast("long"), _vector(table))
    rows = ids.join(info, "vector", "left")
    out = rows.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("c", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op4_neardup_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of every vector at a cosine of 0.95."""
    return near_vectors(common.read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


OP4_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
link AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id
         WHERE list_dot_product(a.e, b.e) >= 0.95 * sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))),
reach AS (SELECT vec_id AS x, vec_id AS y FROM v UNION SELECT r.x, l.y FROM reach r JOIN link l ON l.x = r.y),
low AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
n AS (SELECT x, count(*) AS n_links FROM link GROUP BY x)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN low ON low.x = vec_id LEFT JOIN n ON n.x = vec_id
"""
