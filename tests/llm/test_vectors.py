import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgermatch.llm import ann, neardup_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, node long, vector string"


def table(spark, n=400, dim=16, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    for i in range(0, n, 5):  # near copies, some a chain
        x[i + 1] = x[i] + 0.05 * rng.normal(size=dim)
        x[i + 2] = 3 * x[i + 1] + 0.2 * rng.normal(size=dim)
    x[7] = x[3]
    x[8] = x[3]
    rows = [(int(i), [float(np.float32(v)) for v in x[i]], 1, 5, "c") for i in range(n)]
    bad = [(n, None, 1, None, None), (n + 1, [0.0] * dim, 1, None, None), (n + 2, [None, *[1.0] * (dim - 1)], 1, None, None), (n + 3, [float("nan"), *[1.0] * (dim - 1)], 1, None, None), (n + 4, [float("inf"), *[1.0] * (dim - 1)], 1, None, None), (n + 5, [], 1, None, None)]
    again = [rows[10], rows[10]]
    return spark.createDataFrame(rows + bad + again, SCHEMA), {r[0]: np.array(r[1], dtype=np.float32).astype(np.float64) for r in rows}, [r[0] for r in bad]


@pytest.mark.parametrize("tile,size", [(16_384, 8), (40, 8), (40, 5)])
def test_links_and_components_match_brute_force(spark, tile, size):
    df, vectors, bad = table(spark)
    ids = sorted(vectors)
    x = np.stack([vectors[i] for i in ids])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (u @ u.T >= 0.95) & ~np.eye(len(ids), dtype=bool)
    label = np.arange(len(ids))
    while True:
        new = np.array([min(label[i], *label[near[i]], label[i]) if near[i].any() else label[i] for i in range(len(ids))])
        if (new == label).all():
            break
        label = new
    found = neardup_vectors.near_vectors(df, tile=tile, size=size).collect()
    assert len(found) == len(ids) + len(bad) + 2
    for r in found:
        if r["vec_id"] in vectors:
            i = ids.index(r["vec_id"])
            assert (r["n_links"], r["component_id"], r["kept"]) == (near[i].sum(), ids[label[i]], label[i] == i)
        else:
            assert (r["n_links"], r["component_id"], r["kept"]) == (0, r["vec_id"], True)


def test_no_usable_vectors(spark):
    none = spark.createDataFrame([(1, None, 1, None, None), (2, [0.0], 1, None, None)], SCHEMA)
    assert [(r["vec_id"], r["n_links"]) for r in neardup_vectors.near_vectors(none).orderBy("vec_id").collect()] == [(1, 0), (2, 0)]
    empty = spark.createDataFrame([], SCHEMA)
    assert neardup_vectors.near_vectors(empty).count() == 0
    assert ann.nearest(empty, F.col("vec_id") % 20 == 0).count() == 0 and ann.nearest(none, F.col("vec_id") % 2 == 0).count() == 0


def brute_nearest(vectors, q, top=20):
    scores = {i: float(vectors[i] @ vectors[q]) for i in vectors if i != q}
    return sorted(scores, key=lambda i: (-scores[i], i))[:top], scores


def test_nearest_of_a_small_table_is_exact(spark):
    df, vectors, bad = table(spark)
    found = {}
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(found) == {i for i in vectors if i % 20 == 0}
    hits = 0
    for q, rows in found.items():
        rows.sort()
        best, scores = brute_nearest(vectors, q)
        assert [r[0] for r in rows] == list(range(1, 21)) and len({r[1] for r in rows}) == 20
        assert all(np.isclose(r[2], scores[r[1]], rtol=1e-9) for r in rows)
        assert [(-r[2], r[1]) for r in rows] == sorted((-r[2], r[1]) for r in rows)
        hits += len(set(best) & {r[1] for r in rows})
    assert hits >= 0.98 * 20 * len(found)


def test_copies_few_rows_and_self(spark):
    rows = [(i, [1.0, 0.0], 1, None, None) for i in range(40)] + [(100, [0.5, 0.5], 1, None, None)]
    out = ann.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0).collect()
    by = {q: [r["vec_id"] for r in sorted(out, key=lambda r: r["rank"]) if r["query_id"] == q] for q in (0, 20, 100)}
    assert by[0] == list(range(1, 21)) and by[20] == list(range(20)) and by[100] == list(range(20))
    two = ann.nearest(spark.createDataFrame(rows[:2], SCHEMA), F.col("vec_id") == 0).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in two] == [(0, 1, 1, 1.0)]


def recall_of(found, vectors, of):
    """Share of each query's nearest scores that were found; ties count by score."""
    shares = []
    for q in of:
        _, scores = brute_nearest(vectors, q)
        best = sorted(scores.values(), reverse=True)[:20]
        shares.append(np.mean([s >= best[-1] - 1e-9 for s in sorted(found[q], reverse=True)[:20]]))
    return np.mean(shares)


def mixed_table():
    """Vectors of several lengths, tight clusters, a vector shared by a third of all rows, and one a thousand times longer."""
    rng = np.random.default_rng(3)
    plain = rng.normal(size=(1400, 24)) * rng.uniform(0.3, 1.2, size=(1400, 1))
    tight = rng.normal(size=(30, 24))[rng.integers(0, 30, 600)] + 0.1 * rng.normal(size=(600, 24))
    x = np.concatenate([plain, tight, np.repeat(rng.normal(size=(1, 24)), 1000, axis=0)]).astype(np.float32)
    x = x[rng.permutation(len(x))]
    x[1] *= 1000
    return x


def searched(spark, x, **options):
    df = spark.createDataFrame([(i, v.tolist(), 1, None, None) for i, v in enumerate(x)], SCHEMA)
    found = {}
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0, **options).collect():
        found.setdefault(r["query_id"], []).append(r["score"])
    return found


def test_recall_with_an_outlier_clusters_copies_and_lengths(spark):
    x = mixed_table()
    vectors = {i: v.astype(np.float64) for i, v in enumerate(x)}
    found = searched(spark, x)
    assert set(found) == set(range(0, len(x), 20)) and all(len(s) == 20 for s in found.values())
    assert recall_of(found, vectors, found) >= 0.95


def test_descent_is_what_finds_neighbours(spark):
    x = np.random.default_rng(4).normal(size=(2000, 24)).astype(np.float32)
    vectors = {i: v.astype(np.float64) for i, v in enumerate(x)}
    with_it, without = (recall_of(f, vectors, f) for f in (searched(spark, x, pool=32), searched(spark, x, pool=32, rounds=0)))
    assert with_it >= 0.9 and without < with_it - 0.2


def test_vectors_near_the_ends_of_the_doubles(spark):
    schema = "vec_id long, embedding array<double>"
    rows = [(0, [1e200, 0.0]), (1, [1e-200, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (20, [1.0, 1e-300]), (4, [1e-320, 0.0])]
    df = spark.createDataFrame(rows, schema)
    out = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in ann.nearest(df, F.col("vec_id") % 20 == 0).collect()}
    assert [out[20, r][0] for r in range(1, 6)] == [0, 2, 1, 3, 4] and out[20, 1][1] == 1e200 and out[0, 1] == (2, 1e200)
    linked = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in neardup_vectors.near_vectors(df).collect()}
    assert linked == {0: (4, 0), 1: (4, 0), 2: (4, 0), 20: (4, 0), 4: (4, 0), 3: (0, 3)}


def test_links_of_vectors_of_several_lengths(spark):
    rng = np.random.default_rng(6)
    rows, vectors = [], {}
    for i in range(240):
        dim = (3, 17, 40)[i % 3]
        v = rng.normal(size=dim) if i < 120 else vectors[i - 120] + 0.05 * rng.normal(size=dim)
        vectors[i] = v
        rows.append((i, v.tolist()))
    found = {r["vec_id"]: r["n_links"] for r in neardup_vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), tile=20).collect()}
    cos = lambda a, b: a @ b / np.linalg.norm(a) / np.linalg.norm(b)
    for i, v in vectors.items():
        assert found[i] == sum(j != i and len(w) == len(v) and cos(v, w) >= 0.95 for j, w in vectors.items())


def test_nearest_among_vectors_of_several_lengths(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=(5, 12, 1)[i % 3]).tolist()) for i in range(150)] + [(151, [])]
    found = {}
    for r in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    vectors = {i: np.array(v) for i, v in rows if v}
    assert set(found) == {i for i in vectors if i % 20 == 0}
    for q, got in found.items():
        same = {i: v for i, v in vectors.items() if len(v) == len(vectors[q])}
        best, scores = brute_nearest(same, q)
        assert [r[0] for r in sorted(got)] == list(range(1, 21)) and {r[1] for r in got} <= set(same) - {q}
        assert len(set(best) & {r[1] for r in got}) >= 19


def test_the_queries_themselves(spark, small):
    rows = [r for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    x = {r["vec_id"]: np.array(r["embedding"], dtype=np.float64) for r in rows}
    found = {}
    for r in ann.op1_ann(spark, small).collect():
        found.setdefault(r["query_id"], []).append(r["score"])
    assert set(found) == {i for i in x if i % 20 == 0} and recall_of(found, x, found) >= 0.95
    links = {r["vec_id"]: r["n_links"] for r in neardup_vectors.op4_neardup_vectors(spark, small).collect()}
    assert links == {i: sum(j != i and v @ w >= 0.95 * np.linalg.norm(v) * np.linalg.norm(w) for j, w in x.items()) for i, v in x.items()}
