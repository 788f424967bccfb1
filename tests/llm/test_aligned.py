import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgermatch.llm import aligned

A, B = public_tokenizers.path(aligned.LEFT), public_tokenizers.path(aligned.RIGHT)
SCHEMA = "doc_id long, text string, pairs string, n_a int"
MIX = ["a", "Z", " ", "  ", "\n", "\t", "é", "ß", "1", "23", "'s", "'", "<s>", "<|endoftext|>", "<0x41>", "▁", "😀", "𐍈", "漢字", "ก็", "́", " ", "ﬁ", "_", ".", "the ", " the", "\x00", "\x85", "한", "ᄀ", "ᅡ", "²"]


def whole(text):
    """Groups of a whole text by the decoded bytes alone; None without tokens."""
    (model_a, by_a), (model_b, by_b) = aligned.left(A), aligned.right(B)
    raw = b" " + (text or "").encode()
    a, b = model_a.encode(" " + (text or ""), add_special_tokens=False).ids, model_b.encode(text or "")
    if not text or b"".join(by_a[i] for i in a) != raw or b"".join(by_b[i] for i in b) != raw:
        return None
    ends_a, ends_b = (np.cumsum([len(x[i]) for i in t]).tolist() for x, t in ((by_a, a), (by_b, b)))
    at_a, at_b = ({e: k + 1 for k, e in enumerate(x)} for x in (ends_a, ends_b))
    groups, i, j = [], 0, 0
    for e in sorted(at_a.keys() & at_b.keys()):
        groups.append((a[i : at_a[e]], b[j : at_b[e]]))
        i, j = at_a[e], at_b[e]
    return groups


def text_of(groups):
    return ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)


def plain(rows):
    groups = [(i, whole(t)) for i, t in rows]
    n = Counter((a[-1], b[-1]) for _, g in groups if g for a, b in g)
    top = {}
    for (_, b), c in n.items():
        top[b] = max(top.get(b, 0), c)
    out = []
    for i, g in groups:
        if g is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        held = [n[a[-1], b[-1]] for a, b in g]
        best = sum(c == top[b[-1]] for c, (_, b) in zip(held, g))
        out.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(g), best, sum(held), hashlib.sha256(text_of(g).encode()).hexdigest()))
    return sorted(out, key=str)


NAMES = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(MIX), max_size=20).map("".join))
def test_segments_give_the_groups_of_the_whole(text):
    of = aligned.segments(A, B)
    numbers = of.of([text])[0]
    expected = whole(text)
    if expected is None:
        assert not len(numbers) or -1 in numbers
    else:
        assert ";".join(of.groups[i] for i in numbers) == text_of(expected)


def test_every_link_is_a_possible_pair():
    of = aligned.pairs(A, B)
    for text in ("an example of text", "ünïcödé 漢字 😀𐍈", "a\tb  c"):
        for a, b in whole(text) or ():
            assert of.codes[of.places([a[-1]], [b[-1]])[0]] == (a[-1] << 32) | b[-1]


def test_documents_match_brute_force(spark):
    texts = [None, "", " ", "the cat sat on the mat", "the cat sat on the mat", "Die Straße, 漢字 und 😀𐍈!", "two  spaces", "tab\there", "<s> </s> <|endoftext|> <0x41>", "▁x", "ﬁne print", "x" * 3000, "word " * 20_000, "漢" * 2000, "\x00"]
    rows = [(i if i != 4 else 3, t) for i, t in enumerate(texts)] + [(None, "the cat"), ((1 << 60) + 1, "the dog")]
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], SCHEMA).repartition(3)
    assert sorted((tuple(r[c] for c in NAMES) for r in aligned.alignment(df).collect()), key=str) == plain(rows)


def test_forgotten_segments_are_learnt_again(monkeypatch):
    monkeypatch.setattr(aligned, "REMEMBER", 4)
    of = aligned.Segments(A, B)
    for _ in range(3):
        for text in ("one two three four", "five six", "one two seven"):
            assert ";".join(of.groups[i] for i in of.of([text])[0]) == text_of(whole(text))


def test_empty_table(spark):
    assert aligned.alignment(spark.createDataFrame([], SCHEMA)).count() == 0


def test_missing_vocabulary():
    with pytest.raises(Exception):  # noqa: B017  the library's own kind
        aligned.left("/nowhere/file")


def test_the_query_itself(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r[c] for c in NAMES) for r in aligned.op13_aligned(spark, small).collect()), key=str) == plain(rows)
