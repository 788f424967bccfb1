import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgermatch.llm import pii

SCHEMA = "doc_id long, text string, source string, n_chars long, n_email string, spans string"


def brute_base(text):
    """The patterns as they are documented."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19:
            s = sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(d)))
            if s % 10 == 0:
                out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return [(a, b, pii.KINDS[k]) for a, k, b in sorted(out)]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab@@..--+_%  0123459()é\n", max_size=80))
def test_base_spans_are_the_documented_ones(text):
    assert pii.base_spans(text) == brute_base(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["4111 1111 1111 1111", "378282246310005", "1.2.3.4", "256.1.1.1", "+1 (555) 123-4567", "x@y.z", "a@b@c.de", "01.002.3.4.5.6.7.8", "-", " ", "é", "+"]), max_size=12))
def test_base_spans_of_pieces(parts):
    text = "".join(parts)
    assert pii.base_spans(text) == brute_base(text)


@pytest.mark.parametrize("text", ["a " * 100_000 + " dot ", "a at " * 50_000 + " dot ", "1:" * 100_000, "AB12 " * 40_000, "01 " * 70_000, "a" * 200_000, "1" * 200_000, "1." * 100_000, "@" * 100_000, "a@" * 100_000, "+1" + "(" * 200_000, "1 " * 100_000])
def test_long_runs_take_linear_time(text):
    pii.candidates(text)


def corpus():
    rng = random.Random(2)
    rows = []
    for i in range(300):
        parts = ["plain words here"] * 5
        if i % 3 == 0:
            parts.append(f"mail me at u{i}@mail.example.com")
        if i % 4 == 0:
            parts.append(f"phone: +1 (555) {rng.randrange(100, 999)}-{rng.randrange(1000, 9999)}")
        if i % 5 == 0:
            parts.append("card 4111 1111 1111 1111")
        if i % 6 == 0:
            parts.append(f"call me: 555-{rng.randrange(100, 999)}-{rng.randrange(1000, 9999)}")
        if i % 7 == 0:
            parts.append(f"order 9{rng.randrange(10**14, 10**15)}")
        rows.append((i, ". ".join(parts), "s", 1, "c", "c"))
    return rows + [(None, None, None, None, None, None), (1, "", "s", 0, None, None), (2, "a@b.cd", "s", 6, None, None), (2, "a@b.cd", "s", 6, None, None)]


def test_results_and_null_and_empty_texts(spark):
    rows = corpus()
    found = pii.find_personal_data(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == len(rows)
    expected = sorted((str(r[0]), hashlib.sha256(pii.written(brute_base(r[1] or "")).encode()).hexdigest(), *[sum(s[2] == k for s in brute_base(r[1] or "")) for k in pii.KINDS]) for r in rows)
    assert sorted((str(r["doc_id"]), r["base_sha256"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) for r in found) == expected
    for r in found:
        base = {pii.written([s]) for s in brute_base(next(x[1] for x in rows if x[0] == r["doc_id"] and (r["doc_id"] not in (1, 2))) or "")} if r["doc_id"] not in (None, 1, 2) else set()
        assert base <= set(r["spans"].split(","))


def test_the_method_adds_numbers_with_cues_and_leaves_others(spark):
    found = {r["doc_id"]: r["spans"] for r in pii.find_personal_data(spark.createDataFrame(corpus()[:300], SCHEMA)).collect()}
    assert "phone" in found[6]  # "call me: 555-..."
    assert found[7] == ""  # an order number that fails the card check


def test_reliabilities_are_learned():
    counts = [("card", (1, 1, 0, 0), (1, 0, 4), 500), ("card", (-1, -1, 0, 0), (1, 4, 4), 300), ("card", (-1, 1, 0, 0), (1, 4, 4), 20)]
    model = pii.fit(counts)
    rel = model.reliability["card"]
    assert rel[1, 0, 2] > 0.9 and rel[0, 0, 0] > 0.8 and 0.4 < model.prior["card"] < 0.8
    assert np.isfinite(model.weights).all() and np.isfinite(pii.fit([]).weights).all()


def test_mask(spark):
    rows = [(1, "write to a.b@c.de or 4111 1111 1111 1111!", "s", 99, "c", "c"), (2, None, "s", None, None, None), (3, "", None, 0, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = {r["doc_id"]: r for r in pii.mask(docs).collect()}
    assert out[1]["text"] == "write to <email> or <card>!" and out[1]["n_chars"] == 27
    assert out[2]["text"] is None and out[3]["text"] == "" and pii.mask(docs).columns == docs.columns


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert pii.find_personal_data(docs).count() == 0 and pii.mask(docs).count() == 0


#: Texts with personal data that no base pattern has, and their look-alikes.
PLANTED = [
    ("write to joe.smith [at] mail [dot] example [dot] com today", "email"),
    ("E-Mail: anna(AT)firma.de", "email"),
    ("contact: maria at correo dot es", "email"),
    ("courriel jean @ exemple . fr", "email"),
    ("login from server 2001:db8:85a3::8a2e:370:7334 at night", "ip"),
    ("host address 10[.]20[.]30[.]40 was seen", "ip"),
    ("IBAN DE89 3704 0044 0532 0130 00 bank", "card"),
    ("credit card 4111.1111.1111.1111 exp", "card"),
    ("call me on (212) 555-0187 please", "phone"),
    ("téléphone 01 42 68 53 00", "phone"),
    ("Tel. 030 / 1234567", "phone"),
    ("teléfono 912 345 678 de casa", "phone"),
    ("phone 0049 30 1234567 now", "phone"),
]
CLEAN = [
    "order number 9541066823582205 shipped",
    "version 1.2.3 of 12:30:45 today",
    "invoice 2024-0101-1234 total",
    "we met at noon. Then dot matrix printers",
    "ISBN 978 316 148410 page",
    'token = "8ef5f278dec875d2b96fdf291615913d21aee5ca"',
    "the score was 100-200 and 300",
    "time 10:20:30:40 of the run",
    "ref GB82 WEST 1234 5698 7654 00",
]


def planted(n=20):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        for j, (text, _) in enumerate(PLANTED):
            rows.append((1000 * (j + 1) + i, f"plain words {rng.randrange(100)} then {text}"))
        for j, text in enumerate(CLEAN):
            rows.append((-1000 * (j + 1) - i, f"plain words {rng.randrange(100)} then {text}"))
    return rows + [(i, t) for i, t, *_ in corpus() if i is not None and t]


def test_planted_data_beyond_the_base_patterns(spark):
    rows = planted()
    found = {}
    for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        found.setdefault(r["doc_id"], r["spans"])
    missed = {PLANTED[j][0] for j in range(len(PLANTED)) for i in range(20) if PLANTED[j][1] not in found[1000 * (j + 1) + i]}
    wrong = {CLEAN[j] for j in range(len(CLEAN)) for i in range(20) if found[-1000 * (j + 1) - i]}
    assert len(missed) <= 1 and not wrong, (missed, wrong)


def test_spoken_addresses_in_any_case():
    for text in ("joe[At]site[dot]com", "joe (aT) site (DoT) com", "joe[at]site.com", "JOE AT SITE DOT COM"):
        assert [c.kind for c in pii.candidates(text)] == ["email"], text


def test_ids_beyond_doubles_and_dotted_columns(spark):
    big = (1 << 60) + 1
    docs = spark.createDataFrame([(big, "a@b.cd"), (None, "x")], "doc_id long, text string").coalesce(1).withColumn("a.b", pii.F.lit(1))
    assert {r["doc_id"] for r in pii.find_personal_data(docs).collect()} == {big, None}
    assert pii.mask(docs).columns == docs.columns and {r["text"] for r in pii.mask(docs).collect()} == {"<email>", "x"}


def test_the_query_itself(spark, small):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in pii.op9_pii(spark, small).collect():
        base = brute_base(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(pii.written(base).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[2] == k for s in base) for k in pii.KINDS]
        assert {pii.written([s]) for s in base} <= set(r["spans"].split(",")) | {""}
