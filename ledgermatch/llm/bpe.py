"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

The rank file's path and the splitting pattern are parameters; the file is read by each
Python worker once and never shipped through the driver.  Texts of more than ``LONG``
characters are cut where the pattern always splits: before white space that follows a
character that is not white space.  No alternative of the pattern goes on across such a place
and none looks behind it, so the tokens of the pieces are the tokens of the whole.  A text
without such a place is passed whole.

Null and empty texts have no tokens.  No special tokens are made: their strings are text.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

RANKS = "byte_bpe_multi_50k.tiktoken"
LONG = 200_000
#: What stands on the left is white space for no regex library, what is on the right for all.
_CUT = re.compile(r"(?<=[!-~\w])(?=[ \n])")


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, lines))}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, long: int = LONG) -> Iterator[str]:
    """Parts of ``text`` of about ``long`` characters, cut at safe places only."""
    at = 0
    while len(text) - at > long:
        cut = _CUT.search(text, at + long)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def encode(text: str | None, enc: tiktoken.Encoding, long: int = LONG) -> list[int]:
    text = text or ""
    if len(text) <= long:
        return enc.encode_ordinary(text)
    return [i for part in pieces(text, long) for i in enc.encode_ordinary(part)]


def _ids(path: str | None, pattern: str, long: int):
    """The function of a text column that gives its token ids.

    Texts are taken from the batch one by one and the ids of all go into one growing buffer, which
    is the result: no second copy of a batch's texts or ids is made.
    """
    path = path or public_tokenizers.path(RANKS)

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        enc = encoding(path, pattern)
        flat, ends = array("i"), array("i", [0])
        for x in texts:
            flat.fromlist(encode(x.as_py(), enc, long))
            ends.append(len(flat))
        return pa.ListArray.from_arrays(_int32(ends), _int32(flat))

    return ids


def _int32(values: array) -> pa.Array:
    return pa.Array.from_buffers(pa.int32(), len(values), [None, pa.py_buffer(values)])


def _bytes(ids: pa.ListScalar, enc: tiktoken.Encoding) -> bytes:
    return enc.decode_bytes(ids.as_py() or [])


def tokens(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN, long: int = LONG, column: str = "ids") -> DataFrame:
    """``docs`` and a column of arrays of int with the token ids of ``text``; it replaces a column of that name (``common.free_name`` gives another)."""
    return docs.withColumn(column, _ids(path, pattern, long)(F.col("text")))


def decode(encoded: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN, column: str = "ids", to: str = "bytes") -> DataFrame:
    """``encoded`` and a column ``to`` (binary) with the raw bytes of the ids in ``column``; a null array gives no bytes."""
    path = path or public_tokenizers.path(RANKS)

    @F.arrow_udf("binary")
    def raw(ids: pa.Array) -> pa.Array:
        enc = encoding(path, pattern)
        return pa.array((_bytes(x, enc) for x in ids), pa.binary(), size=len(ids))

    return encoded.withColumn(to, raw(F.col(f"`{column}`")))


def digests(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN, long: int = LONG) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of the ids of ``tokens`` and the bytes that ``decode`` makes of them.

    The function of the ids is applied to that of the texts, so Spark runs both in one worker
    and neither ids nor bytes go back to the JVM.
    """
    path = path or public_tokenizers.path(RANKS)

    @F.arrow_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digest(ids: pa.Array) -> pa.Array:
        enc = encoding(path, pattern)
        sha = lambda raw: hashlib.sha256(raw).hexdigest()
        rows = [(len(x), sha(",".join(map(str, x.as_py())).encode()), sha(_bytes(x, enc))) for x in ids]
        names = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
        return pa.StructArray.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(names.values())], list(names))

    made = digest(_ids(path, pattern, long)(F.col("text"))).alias("d")
    return docs.select(F.col("doc_id").cast("long"), made).select("doc_id", "d.*")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token digests of every document."""
    return digests(common.read_table(spark, sf_dir, "documents"))
