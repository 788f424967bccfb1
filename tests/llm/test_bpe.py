import hashlib
import tracemalloc

import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgermatch.llm import bpe, common

SCHEMA = "doc_id long, text string, ids string, bytes string"
ENC = bpe.encoding(public_tokenizers.path(bpe.RANKS), public_tokenizers.PATTERN)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab1' .,\n\t\r\u00a0\u2003\x1c\x85éñß😀's'll", max_size=300), st.integers(1, 40))
def test_cut_texts_have_the_same_tokens(text, long):
    assert bpe.encode(text, ENC, long) == ENC.encode_ordinary(text)
    assert "".join(bpe.pieces(text, long)) == text


def test_digests_and_round_trip(spark):
    texts = [None, "", "Hello, world's  end\n\n  x", "a" * 3000, "word " * 90_000, "<|endoftext|> é\u0301 😀 \u00a0 ", "same", "same"]
    rows = [(i if i else None, t, "clash", "clash") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.digests(docs).collect()}
    expected = set()
    for i, t in enumerate(texts):
        ids = ENC.encode_ordinary(t or "")
        expected.add((i or None, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert out == expected
    both = bpe.decode(bpe.tokens(docs)).select("text", "bytes").collect()
    assert all(bytes(r["bytes"]).decode() == (r["text"] or "") for r in both)


def test_empty_table(spark):
    assert bpe.digests(spark.createDataFrame([], SCHEMA)).count() == 0


def test_missing_file():
    with pytest.raises(FileNotFoundError):
        bpe.encoding("/nowhere/file", public_tokenizers.PATTERN)


def test_ids_beyond_doubles_and_other_columns(spark):
    big = (1 << 60) + 1
    docs = spark.createDataFrame([(big, "a b"), (None, "c")], "doc_id long, text string").coalesce(1).withColumn("a.b", bpe.F.lit(1))
    assert {r["doc_id"] for r in bpe.digests(docs).collect()} == {big, None}
    assert bpe.tokens(docs).columns == ["doc_id", "text", "a.b", "ids"]


def test_the_query_itself(spark, small):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in bpe.op10_bpe(spark, small).collect():
        ids = ENC.encode_ordinary(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest())


def test_columns_named_like_the_results_stay(spark):
    docs = spark.createDataFrame([(1, "a b", "keep", "too")], "doc_id long, text string, IDS string, bytes string")
    ids, raw = common.free_name("ids", docs.columns), common.free_name("bytes", docs.columns)
    out = bpe.decode(bpe.tokens(docs, column=ids), column=ids, to=raw)
    assert out.columns == ["doc_id", "text", "IDS", "bytes", "_ids", "_bytes"]
    row = out.first()
    assert row["IDS"] == "keep" and row["bytes"] == "too" and bytes(row["_bytes"]) == b"a b"


def test_a_batch_of_texts_makes_one_buffer_of_ids():
    texts = pa.array(["word " * 2000] * 200 + [None, ""])
    ids = bpe._ids(None, public_tokenizers.PATTERN, bpe.LONG).func
    ids(texts[-1:])  # the ranks are read
    tracemalloc.start()
    out = ids(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out.to_pylist() == [ENC.encode_ordinary(x or "") for x in texts.to_pylist()]
    assert peak < 2 * out.values.nbytes
