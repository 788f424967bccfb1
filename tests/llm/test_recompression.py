import hashlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgermatch.llm import recompression

SCHEMA = "doc_id long, text string, doc long, starts int"


def plain(rows, window=13):
    """(doc_id, n_words, n_removed, sha256) by a table of all windows."""
    rank = lambda i: (1 << 63) - 1 if i is None else i
    split = [(rank(i), i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for r, _, w in split:
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, r), r)
    out = []
    for r, i, w in split:
        gone = {k + x for k in range(len(w) - window + 1) if first[tuple(w[k : k + window])] < r for x in range(window)}
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df, **how):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in recompression.without_repeats(df, **how).collect()), key=str)


def corpus(seed=0):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(60)] + ["the", "of", "é", "漢字"]
    text = lambda n: [words[i] for i in rng.integers(0, len(words), n)]
    passages = [text(n) for n in (12, 13, 14, 20, 60, 200)]
    rows = []
    for i in range(80):
        body = text(int(rng.integers(0, 60)))
        for _ in range(int(rng.integers(0, 3))):
            body += passages[int(rng.integers(0, len(passages)))] + text(int(rng.integers(0, 4)))
        rows.append((i, " ".join(body)))
    rows += [(100 + i, rows[5][1]) for i in range(40)]  # a third are copies of one text
    rows += [(200 + i, rows[7][1].replace("w1 ", "w2 ", 1)) for i in range(10)]
    rows += [(300, "a " * 50), (301, "a\ta\n" * 40), (302, "b " + "a " * 13), (303, "x y " * 30), (304, "y x " * 30)]
    rows += [(None, rows[5][1]), (None, "only here " + " ".join(passages[5])), (5, rows[6][1]), (400, None), (401, ""), (402, " \n ")]
    return rows


def test_kept_words_match_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], SCHEMA).repartition(5)
    assert found(df) == plain(rows)
    texts = {r["doc_id"]: r["text"] for r in recompression.without_repeats(df).where("doc_id >= 100 AND doc_id < 140").collect()}
    assert all(t == texts[100] for t in texts.values()) and len(texts[100].split()) < len(rows[5][1].split())


def test_other_windows_and_small_chunks(spark, monkeypatch):
    rows = corpus(1)
    for name, value in (("PIECE", 300), ("CHUNK", 50), ("BUCKET", 1000)):
        monkeypatch.setattr(recompression, name, value)
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], SCHEMA).repartition(3)
    assert found(df, window=17) == plain(rows, 17)
    with pytest.raises(ValueError):
        recompression.without_repeats(df, window=12)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("a b c d e f".split()), min_size=13, max_size=40), st.lists(st.sampled_from("a b c".split()), max_size=12), st.lists(st.sampled_from("a b c".split()), max_size=12))
def test_equal_windows_share_a_context(window, before, behind):
    """Every window of a text has the same contexts, at least one, wherever the text stands."""
    alone, inside = recompression.Piece([" ".join(window)]), recompression.Piece([" ".join(before + window + behind)])
    sets = [dict(zip(*(x.tolist() for x in p.contexts()))) for p in (alone, inside)]
    r = recompression.REACH
    for s in range(len(window) - 12):
        mine = {k: sets[0][k] for k in range(s + r, s + 13 - r + 1) if k in sets[0]}
        theirs = {k: sets[1][k + len(before)] for k in range(s + r, s + 13 - r + 1) if k + len(before) in sets[1]}
        assert mine and mine == theirs


def test_long_words_and_texts():
    long = ["x" * 3_000_000, "y", "x" * 3_000_000, "é" * 10]
    a, b = recompression.Piece([" ".join(long), "q"]), recompression.Piece(["q", " ".join(reversed(long))])
    assert a.h[0] == a.h[2] != a.h[1] and a.h[:4].tolist() == b.h[1:][::-1].tolist() and a.h[4] == b.h[0]


def test_empty_table(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []


def test_the_query_equals_sql(spark, small):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{small}/documents.parquet'")
    want = con.execute(recompression.OP11_SQL)
    names = [d[0] for d in want.description]
    assert sorted(want.fetchall(), key=str) == sorted((tuple(r[c] for c in names) for r in recompression.op11_recompression(spark, small).collect()), key=str)
