import math
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgermatch.llm import classlm

SCHEMA = "doc_id long, text string, word string, n string"


def docs_of(spark, small):
    rows = [(r["doc_id"], r["text"], "c", "c") for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    return rows + [(None, None, None, None), (3, "", None, None), (10_001, "NEW Ünseen word\tEND", None, None), (5, "same same", None, None), (5, "same same", None, None)]


def test_base_score_and_counts_match_brute_force(spark, small):
    rows = docs_of(spark, small)
    held = lambda d: zlib.crc32(str(d).encode() if d is not None else b"") % 7 == 2
    words = lambda t: [w for w in (t or "").encode().lower().split()]
    c = Counter()
    for d, t, *_ in rows:
        if not held(d):
            c.update(words(t))
            c[None] += 1
    n, v = sum(c.values()), len(c)
    expected = sorted((str(d), held(d), len(words(t)) + 1, sum(c[w] > 0 for w in [*words(t), None]), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in [*words(t), None]), 5)) for d, t, *_ in rows)
    found = classlm.score(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in found) == expected
    unseen = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)


def brute_model(rows, classes, label, of_word, groups, c, end_count):
    """The probability of a text by the formula, from classes of words and raw tokens of the training texts."""
    held = lambda d: zlib.crc32(str(d).encode() if d is not None else b"") % 7 == 2
    words = lambda t: (t or "").encode().lower().split()
    history = lambda w: 0 if w is None else groups(w)
    kind = lambda w: 0 if w is None else of_word.get(w, groups(w))
    steps, size, distinct = np.zeros((classes, classes)), np.zeros(classes), np.zeros(classes)
    for d, t, *_ in rows:
        if not held(d):
            line = [None, *words(t), None]
            for v, w in zip(line, line[1:]):
                steps[history(v), kind(w)] += 1
                size[kind(w)] += 1
    for w in of_word:
        distinct[kind(w)] += 1
    distinct[0] = 1
    n, v = size.sum(), len(of_word) + 1
    p = (steps + 1) / (steps.sum(1, keepdims=True) + classes)

    def score(t):
        line = [None, *words(t), None]
        return sum(math.log10((c.get(w, 0) + 1 if w is not None else end_count + 1) * (classlm.MIX * p[history(u), kind(w)] / (size[kind(w)] + distinct[kind(w)] + 1) + (1 - classlm.MIX) / (n + v + classes))) for u, w in zip(line, line[1:]))

    return score


@pytest.mark.parametrize("limit", [50_000, 300])
def test_score_matches_the_formula(spark, small, monkeypatch, limit):
    monkeypatch.setattr(classlm.head_of, "__defaults__", (limit,))
    rows = docs_of(spark, small)[-60:]
    model, tail = classlm.fit(spark.createDataFrame(rows, SCHEMA).where(~classlm.held_out()))
    tail = {bytes(r["word"]): (r["class"], r["n"]) for r in tail.collect()}
    head = model.elements.place
    assert len(head) <= limit and (limit > 300 or len(tail) > 300)
    c = {w: n for w, (_, n) in tail.items()} | {w: round(10 ** model.head[i]) - 1 for w, i in head.items()}
    of_word = {w: k for w, (k, _) in tail.items()} | {w: int(model.label[i + 1]) for w, i in head.items()}
    score = brute_model(rows, classlm.CLASSES, model.label, of_word, lambda w: int(model.label[model.elements.of([w])[0]]), c, round(10**model.end) - 1)
    by = {}
    for d, t, *_ in rows:
        by.setdefault(d, []).append(round(score(t), 6))
    found = {}
    for r in classlm.score(spark.createDataFrame(rows, SCHEMA)).collect():
        found.setdefault(r["doc_id"], []).append(round(r["score"], 6))
        assert math.isclose(r["perplexity"], 10 ** (-r["score"] / r["n_tokens"]))
    assert {k: sorted(v) for k, v in by.items()} == {k: sorted(v) for k, v in found.items()}


def test_probabilities_sum_to_one_or_less(spark, small, monkeypatch):
    monkeypatch.setattr(classlm.head_of, "__defaults__", (2000,))
    model, tail = classlm.fit(spark.createDataFrame(docs_of(spark, small), SCHEMA))
    size = np.zeros(classlm.CLASSES)
    np.add.at(size, model.label[1 : model.elements.first], 10**model.head)
    for r in tail.collect():
        size[r["class"]] += r["n"] + 1
    size[0] += 10**model.end
    for before in range(classlm.CLASSES):
        assert (10 ** model.terms[before] * (size + 1)).sum() <= 1 + 1e-6  # one slot for unknown words each


def packed(spark, rows):
    """PAIRS of (before, after, n)."""
    return spark.createDataFrame([(w % classlm.PARTS, *(np.array([x], kind).tobytes() for x, kind in ((v, "<i4"), (w, "<i4"), (n, "<i8")))) for v, w, n in rows], classlm.PAIRS)


def test_exchange_raises_the_likelihood_and_finds_blocks(spark):
    rng = np.random.default_rng(0)
    kind = rng.integers(0, 2, 40)
    rows = [(i + 1, j + 1, 50) for i in range(40) for j in range(40) if kind[i] != kind[j]] + [(0, 1, 3)]
    pairs = packed(spark, rows)
    label = classlm.exchange(pairs, 41, classes=3, blocks=3)
    assert label[0] == 0 and (label[1:] > 0).all()
    assert len({(k, c) for k, c in zip(kind, label[1:])}) == 2
    start = np.concatenate([[0], 1 + np.arange(40) % 2])
    assert classlm.likelihood(classlm.transitions(pairs, label, 3)) > classlm.likelihood(classlm.transitions(pairs, start, 3))


def test_neighbour_counts(spark):
    pairs = packed(spark, [(0, 1, 2), (1, 1, 3), (1, 2, 5), (2, 0, 7)])
    near = classlm.neighbours(pairs.coalesce(1), pairs.coalesce(1), np.array([0, 1, 1]), 2, 2)
    found = {}
    for r in near.collect():
        for k, n in zip(np.frombuffer(r["classes"], "<u2"), np.frombuffer(r["counts"], "<i8")):
            found[r["element"], r["side"], int(k)] = int(n)
    assert (classlm.class_table(near, np.array([0, 1, 1]), 2) == classlm.transitions(pairs, np.array([0, 1, 1]), 2)).all()
    assert found == {(0, 0, 1): 2, (1, 0, 1): 8, (2, 0, 0): 7, (1, 1, 0): 2, (1, 1, 1): 3, (2, 1, 1): 5, (0, 1, 1): 7, (1, 2, 0): 3}


def test_no_training_texts_and_empty_table(spark):
    only = classlm.score(spark.createDataFrame([(9, "a b", None, None)], SCHEMA).where("doc_id is not null")).collect()
    assert len(only) == 1 and np.isfinite(only[0]["score"])
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    alone = classlm.score(spark.createDataFrame([(i, "x y z", None, None) for i in ids], SCHEMA)).collect()
    assert all(r["held_out"] and r["n_known"] == 0 and r["train_tokens"] == 0 and np.isfinite(r["score"]) for r in alone)
    assert classlm.score(spark.createDataFrame([], SCHEMA)).count() == 0


def test_the_head_is_cut_exactly(spark):
    words = spark.createDataFrame([(f"w{i:03d}".encode(), 5) for i in range(30)] + [(b"top", 9), (b"low", 1)], "word binary, n long")
    assert classlm.head_of(words, 10) == [(b"top", 9)] + [(f"w{i:03d}".encode(), 5) for i in range(9)]
    assert classlm.head_of(words, 1) == [(b"top", 9)] and len(classlm.head_of(words, 32)) == len(classlm.head_of(words, 99)) == 32
    assert classlm.head_of(words.where("n = 5"), 29) == [(f"w{i:03d}".encode(), 5) for i in range(29)]


@pytest.mark.parametrize("held", [4_000_000, 3])
def test_bigrams_are_each_counted_once(spark, monkeypatch, held):
    monkeypatch.setattr(classlm, "HELD", held)
    texts = ["a b a b c", "", None, "b a", "x y z a"] * 3
    elements = classlm.Elements([b"a", b"b", b"c"])
    want = Counter()
    for t in texts:
        ids = [0, *elements.of(classlm.split_words(t)).tolist(), 0]
        want.update(zip(ids, ids[1:]))
    found = classlm.bigrams(spark.createDataFrame([(t,) for t in texts], "text string").repartition(4), elements).collect()
    got = [(v, w, n) for r in found for v, w, n in zip(*(np.frombuffer(r[c], k).tolist() for c, k in (("before", "<i4"), ("after", "<i4"), ("n", "<i8"))))]
    assert {(v, w): n for v, w, n in got} == dict(want) and len(got) == len(want)


def test_a_move_goes_where_the_likelihood_is_largest():
    rng = np.random.default_rng(5)
    size, classes = 30, 6
    n = rng.poisson(0.7, (size, size)) * rng.integers(1, 9, (size, size))
    label = np.concatenate([[0], 1 + np.arange(size - 1) % (classes - 1)])

    def counts(of):
        t = np.zeros((classes, classes))
        np.add.at(t, (of[:, None], of[None, :]), n)
        return t

    by = np.eye(classes)[label]
    for e in range(1, size):
        found = classlm.move(label, counts(label), np.array([e]), (n @ by)[[e]], (n.T @ by)[[e]], n[[e], [e]].astype(float))[0]
        tried = [classlm.likelihood(counts(np.where(np.arange(size) == e, k, label))) for k in range(1, classes)]
        assert np.isclose(tried[found - 1], max(tried))
