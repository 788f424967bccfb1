import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from ledgermatch.llm import simhash
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, fp string"


def brute_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    ones = Counter(b for g in grams for b in range(64) if xxhash.xxh64(g.encode(), seed=42).intdigest() >> b & 1)
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))


def brute_components(marks):
    up = {m: m for m in marks}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    keys = sorted(up)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (a ^ b).bit_count() <= 2:
                p, q = top(a), top(b)
                up[max(p, q)] = min(p, q)
    return {m: top(m) for m in keys}


def near_texts():
    rng = random.Random(5)
    out = []
    for d in range(30):
        words = [f"w{rng.randrange(200)}é" for _ in range(rng.randrange(1, 300))]
        for _ in range(4):
            out.append(" ".join(words))
            if len(words) > 60:
                words = list(words)
                words[rng.randrange(len(words))] = "changed"
    return out + [None, "", " \t\n", "A b", "a B", "\u00a0 x", "Z" * 50_000 + " y z"]


def test_fingerprint_is_the_defined_one():
    for text in near_texts():
        assert simhash.fingerprint(text) == brute_fingerprint(text), text and text[:50]


@pytest.mark.parametrize("dense", [1, 64])
def test_components_match_brute_force(spark, dense):
    texts = near_texts()
    rows = [(i * 3 % 101, t, "en", "s", 1, "clash", "clash") for i, t in enumerate(texts)] + [(None, "only null", None, None, None, None, None), (7, texts[0], None, None, None, None, None), (7, texts[0], None, None, None, None, None)]
    found = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA), dense).collect()
    assert len(found) == len(rows)
    group = brute_components({brute_fingerprint(r[1]) for r in rows})
    first = {}
    for r in rows:
        g = group[brute_fingerprint(r[1])]
        if r[0] is not None:
            first[g] = min(first.get(g, r[0]), r[0])
    expected = Counter((r[0], brute_fingerprint(r[1]), first.get(group[brute_fingerprint(r[1])])) for r in rows)
    assert Counter((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in found) == expected


@pytest.mark.parametrize("dense", [1, 64])
def test_links_in_a_dense_cluster(spark, dense):
    rng = random.Random(1)
    base = rng.getrandbits(64)
    bits = rng.sample(range(64), 9)
    marks = {base} | {base ^ sum(1 << b for b in bits if rng.random() < 0.4) for _ in range(150)} | {rng.getrandbits(64) for _ in range(50)}
    signed = [m - (1 << 64) if m >> 63 else m for m in marks]
    edges = simhash.links(spark.createDataFrame([(m,) for m in signed], "fp long"), dense).collect()
    joined = {m: m for m in marks}

    def top(x):
        while joined[x] != x:
            x = joined[x]
        return x

    for a, b in edges:
        a, b = a % (1 << 64), b % (1 << 64)
        assert (a ^ b).bit_count() <= 2
        p, q = top(a), top(b)
        joined[max(p, q)] = min(p, q)
    assert {m: top(m) for m in marks} == brute_components(marks)


def test_drop_keeps_one_of_each_group(spark):
    rows = [(5, "a b c d", "x", "s", 7, "r", "f"), (3, "A B c  d", "y", "s", 7, "r", "f"), (3, "A B c  d", "y", "s", 7, "r", "f"), (9, "something else entirely here", None, None, None, None, None), (None, None, None, None, None, None, None), (4, "", None, None, None, None, None)]
    out = simhash.drop_near_duplicates(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "row", "fp"]
    assert sorted(r["doc_id"] for r in out.collect()) == [3, 4, 9]


def test_rows_that_differ_in_other_columns_leave_the_same_one(spark):
    rows = [(3, "same text here now", lang, "s", n, "r", "f") for n, lang in enumerate(["x", "y", None, "z"])]
    kept = {tuple(simhash.drop_near_duplicates(spark.createDataFrame(r, SCHEMA).repartition(3)).collect()[0]) for r in (rows, rows[::-1])}
    assert len(kept) == 1


def test_count_filter_keeps_what_shares_enough(spark):
    """Fingerprints that share a key or more but too few: tallied, and not linked."""
    rng = random.Random(3)
    marks = {0}
    for _ in range(400):  # four random bytes at equal places, and some within two bits
        m = rng.getrandbits(64)
        for p in rng.sample(range(8), 4):
            m &= ~(0xFF << (8 * p))
        marks |= {m, m ^ (1 << rng.randrange(64)), m ^ (3 << rng.randrange(63))}
    signed = [m - (1 << 64) if m >> 63 else m for m in marks]
    for dense in (64, 10_000):
        edges = {tuple(sorted((a % (1 << 64), b % (1 << 64)))) for a, b in simhash.links(spark.createDataFrame([(m,) for m in signed], "fp long"), dense).collect()}
        near = {(a, b) for a in marks for b in marks if a < b and (a ^ b).bit_count() <= 2}
        assert edges <= near and (dense == 64 or edges == near)


def test_the_query_itself(spark, small):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    marks = {d: brute_fingerprint(t) for d, t in docs.items()}
    group = brute_components(set(marks.values()))
    first = {}
    for d, m in marks.items():
        first[group[m]] = min(first.get(group[m], d), d)
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.op7_simhash(spark, small).collect()} == {d: (f"{m:016x}", first[group[m]]) for d, m in marks.items()}


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.drop_near_duplicates(docs).count() == 0


def test_hex(spark):
    row = spark.range(1).select(simhash.hex16(F.lit(-1).cast("long")), simhash.hex16(F.lit(10).cast("long"))).first()
    assert tuple(row) == ("f" * 16, "000000000000000a")


def test_similar_texts_link_and_repeated_passages_do_not(spark):
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(5000)}"
    base = [[word() for _ in range(400)] for _ in range(40)]
    near, passage = [], [word() for _ in range(12)]
    for words in base:
        copy = list(words)
        for at in rng.sample(range(400), 4):
            copy[at] = "changed"
        near.append(copy)
    odd = [passage * 60 + [word() for _ in range(100)] for _ in range(2)]
    texts = [" ".join(w) for w in base + near + odd] + ["", None, " \t", "one word", "one  WORD"]
    rows = [(i, t, None, None, None, None, None) for i, t in enumerate(texts)]
    found = simhash.similar(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == len(rows)
    grp = {r["doc_id"]: r["grp"] for r in found}
    caught = sum(grp[i] == grp[40 + i] for i in range(40))
    assert caught >= 36 and len({grp[i] for i in range(40)}) == 40
    assert grp[80] != grp[81]
    assert grp[82] == grp[83] == grp[84] and grp[85] == grp[86] and grp[82] != grp[85]


def test_large_postings_lose_no_link(spark):
    """Two families that share postings but no link to each other's texts, and chains of copies of copies."""
    rng = random.Random(4)
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]
    texts = []
    for family in range(3):
        words = base[:150] + [f"f{family}x{i}" for i in range(50)]
        for _ in range(60):
            copy = list(words)
            for at in rng.sample(range(200), 3):
                copy[at] = f"c{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    sets = [set(simhash.shingle_set(t).tolist()) for t in texts]
    up = list(range(len(texts)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if len(a & b) >= 0.8 * len(a | b):
                up[top(i)] = top(j)
    want = Counter(frozenset(i for i in range(len(texts)) if top(i) == r) for r in {top(i) for i in range(len(texts))})
    docs = spark.createDataFrame([(i, t, None, None, None, None, None) for i, t in enumerate(texts)], SCHEMA)
    for dense in (2, 64, 10_000):
        groups = {}
        for r in simhash.similar(docs, dense=dense).collect():
            groups.setdefault(r["grp"], set()).add(r["doc_id"])
        assert Counter(map(frozenset, groups.values())) == want, dense


def test_tiles_give_each_pair_between_groups(spark):
    rng = random.Random(6)
    members = [(n, rng.getrandbits(12), 10) for n in range(90)]
    large = spark.createDataFrame([(0, 5, members), (1, 5, members[:2])], "i int, key long, of array<struct<node:long,fp:long,n:int>>")
    groups = spark.createDataFrame([(n, n % 4) for n in range(0, 90, 2)], "node long, component long")
    near = lambda a, b: F.bit_count(a["fp"].bitwiseXOR(b["fp"])) <= 4
    pair = lambda a, b: F.struct(F.least(a["node"], b["node"]).alias("a"), F.greatest(a["node"], b["node"]).alias("b"), F.bit_count(a["fp"].bitwiseXOR(b["fp"])).alias("bits"))
    c = {n: n % 4 if n % 2 == 0 else n for n in range(90)}
    want = {(a, b) for a, x, _ in members for b, y, _ in members if a < b and c[a] != c[b] and (x ^ y).bit_count() <= 4}
    for tile in (7, 1000):
        got = [(r["a"], r["b"]) for r in simhash.across(large, groups, near, pair, tile).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_surest_bytes_meet_at_the_similarity_asked_for():
    """Two of the surest bytes are shared by nearly all pairs of sets at 0.8, and by no unlike ones to speak of."""
    rng = np.random.default_rng(2)
    draw = lambda n: rng.integers(0, 1 << 63, n).astype(np.uint64)
    met, unlike = 0, 0
    for _ in range(200):
        common = draw(160)
        (fa, a), (fb, b) = (simhash.wide(np.concatenate([common, draw(20)])) for _ in range(2))
        assert len(a) == simhash.SURE and all(fa[p >> 8] == p & 255 for p in a) and sorted(a) == list(a)
        met += len(set(a) & set(b)) >= simhash.COUNT and int(np.unpackbits(fa ^ fb).sum()) <= simhash.differing(8 * simhash.BYTES, 0.8)
        unlike += len(set(a) & set(simhash.wide(draw(180))[1])) >= simhash.COUNT
    assert met >= 190 and unlike == 0


def test_a_family_without_links_makes_few_pairs(spark, monkeypatch):
    """Texts of one family that are less than 0.8 alike: their wide fingerprints tell, so few pairs are looked at."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for i in range(120):
        words = list(base)
        for j in rng.sample(range(150), 4):
            words[j] = f"c{i}x{j}"
        texts.append(" ".join(words))
    looked, store = [], simhash.common.store

    def counted(df, label):
        out = store(df, label)
        looked.append(out.count() if label == "candidates" else 0)
        return out

    monkeypatch.setattr(simhash.common, "store", counted)
    docs = spark.createDataFrame([(i, t, None, None, None, None, None) for i, t in enumerate(texts)], SCHEMA)
    groups = {r["grp"] for r in simhash.similar(docs).collect()}
    sets = [set(simhash.shingle_set(t).tolist()) for t in texts]
    alike = sum(len(a & b) >= 0.8 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
    assert len(groups) > 100 and alike < 20 and sum(looked) < 120 * 119 / 2 / 2
