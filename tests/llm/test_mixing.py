import math
import random
from collections import defaultdict

from ledgermatch.llm import mixing

SCHEMA = "doc_id long, text string, source string, size long, copy string, rank string"


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total = sum(sizes.values()) * share
    full, left = {}, set(names)
    while left:
        rest = total - sum(full.values())
        t = {s: rest * w[s] / sum(w[x] for x in left) for s in left}
        over = [s for s in left if t[s] > cap * sizes[s]]
        if not over:
            return full | t
        for s in over:
            full[s] = cap * sizes[s]
            left.remove(s)
    return full


def make(n=600, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["hot"] * 6 + ["a", "b", "ü", None, "z", "tiny"])
        rows.append((rng.randrange(n) if i % 17 else None, rng.choice([None, ""]) if i % 29 == 0 else "w " * rng.randrange(1, 40), source, None, "x", "y"))
    return rows + [(1, "same text here", "rep", None, None, None)] * 200


def test_targets_and_taken(spark):
    rows = make()
    found = mixing.plan(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == len(rows)
    sizes = defaultdict(int)
    for _, text, source, *_ in rows:
        sizes[source] += len((text or "").split())
    targets = brute_targets(sizes)
    taken = defaultdict(int)
    for r in found:
        assert 0 <= r["copies"] <= 2
        assert r["source_size"] == sizes[r["source"]]
        assert math.isclose(r["target"], targets[r["source"]], rel_tol=1e-9)
        taken[r["source"]] += r["copies"] * r["size"]
    for s, t in targets.items():
        assert abs(taken[s] - t) <= 20, (s, taken[s], t)
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, mixing.plan(spark.createDataFrame(list(reversed(rows)), SCHEMA)).collect()), key=str)


def test_inclusion_follows_the_share(spark):
    rows = [(i, "w " * 10, s, None, None, None) for i in range(3000) for s in ("a", "b", "c")]
    found = mixing.plan(spark.createDataFrame(rows, SCHEMA)).groupBy("source").sum("copies").collect()
    assert {r[0]: r[1] for r in found} == {"a": 6000, "b": 5000, "c": 2500}  # equal weights


def test_weights_within_a_source(spark):
    rows = [(i, "w " * 10, "a", 3 if i % 2 else 1, None, None) for i in range(4000)]
    found = mixing.plan(spark.createDataFrame(rows, SCHEMA).withColumnRenamed("size", "w8"), share=0.5, weight_col="w8").collect()
    odd = sum(r["copies"] for r in found if r["doc_id"] % 2)
    even = sum(r["copies"] for r in found if not r["doc_id"] % 2)
    assert odd + even == 2000 and 2.6 < odd / even < 3.4


def test_mix_repeats_documents_with_their_columns(spark):
    rows = make(100)
    docs = spark.createDataFrame(rows, SCHEMA)
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    copies = sum(r["copies"] for r in mixing.plan(docs).collect())
    assert out.count() == copies


def test_no_words_and_no_rows(spark):
    none = spark.createDataFrame([(1, None, "a", None, None, None), (2, "", None, None, None, None)], SCHEMA)
    assert {(r["target"], r["size"] * r["copies"]) for r in mixing.plan(none).collect()} == {(0.0, 0)}
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.plan(empty).count() == 0 and mixing.mix(empty).count() == 0


def test_unfolded_in_blocks(spark):
    from ledgermatch.llm import common

    df = spark.createDataFrame([("a", 7), ("b", 0), ("c", 4), ("d", 1)], "x string, n long")
    got = sorted(tuple(r) for r in common.unfolded(df, "n", "i", block=4).select("x", "i").collect())
    assert got == [("a", i) for i in range(1, 8)] + [("c", i) for i in range(1, 5)] + [("d", 1)]


def naive_levels(weights, sizes, target, cap=2.0):
    """Expected copies of each document: proportional to the weight, capped, summing to the target in words."""
    full = set()
    while True:
        mass = sum(w * s for i, (w, s) in enumerate(zip(weights, sizes)) if i not in full)
        level = (target - cap * sum(sizes[i] for i in full)) / mass if mass else 0
        over = {i for i, w in enumerate(weights) if i not in full and w * level >= cap}
        if not over:
            return [cap if i in full else w * level for i, w in enumerate(weights)]
        full |= over


def test_unequal_odds_and_the_pareto_order(spark):
    rng = random.Random(9)
    rows = [(i, "w " * rng.choice([1, 3, 8, 40, 300]), s, None, None, None) for i in range(900) for s in ("a", "b", "c")]
    found = mixing.plan(spark.createDataFrame(rows, SCHEMA)).collect()
    for source in "abc":
        own = [r for r in found if r["source"] == source]
        sizes = [r["size"] for r in own]
        steps = [2 ** (math.floor(math.log2(mixing.BASE_WEIGHT + math.log2(s + 1)) * 16) / 16) for s in sizes]
        expected = naive_levels(steps, sizes, own[0]["target"])
        assert math.isclose(sum(e * s for e, s in zip(expected, sizes)), own[0]["target"], rel_tol=1e-9)
        by = defaultdict(list)
        for r, e in zip(own, expected):
            assert r["copies"] in (math.floor(e + 1e-9), math.floor(e + 1e-9) + 1)
            by[r["size"]].append((r["copies"], e))
        for size, pairs in by.items():  # inclusion follows the odds: five standard errors
            mean, e = sum(c for c, _ in pairs) / len(pairs), pairs[0][1]
            p = e % 1
            assert abs(mean - e) <= 5 * math.sqrt(p * (1 - p) / len(pairs)) + 0.02, (source, size, mean, e)
        if 0.01 < expected[0] % 1 < 0.99:
            assert len({round(e % 1, 6) for e in expected}) > 1


def test_capped_weights_share_their_excess(spark):
    rows = [(i, "w " * 10, "a", 100 if i < 10 else 1, None, None) for i in range(1000)]
    found = mixing.plan(spark.createDataFrame(rows, SCHEMA).withColumnRenamed("size", "w8"), share=0.5, weight_col="w8").collect()
    heavy = [r["copies"] for r in found if r["doc_id"] < 10]
    assert heavy == [2] * 10 and abs(sum(r["copies"] for r in found) - 500) <= 1


def test_the_query_itself(spark, small):
    texts = {r["doc_id"]: (r["source"], len((r["text"] or "").encode().split())) for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    sizes = defaultdict(int)
    for source, n in texts.values():
        sizes[source] += n
    targets, taken, most = brute_targets(sizes), defaultdict(int), defaultdict(int)
    for r in mixing.op8_mixing(spark, small).collect():
        source, n = texts[r["doc_id"]]
        assert r["size"] == n and r["source_size"] == sizes[source] and math.isclose(r["target"], targets[source], rel_tol=1e-9) and r["taken"] <= 2 * n
        taken[source] += r["taken"]
        most[source] = max(most[source], n)
    assert all(abs(taken[s] - t) <= most[s] for s, t in targets.items())
