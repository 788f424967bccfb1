"""Removal of word sequences that an earlier document holds, found by recompression.

A window is ``WINDOW`` consecutive words; a word goes if a window over it also starts in a
document with a smaller doc_id.  Words, pairs and runs get names that depend on nothing but
what they stand for (hashes), so equal substrings get equal symbols in every document:

1. *Reveal.*  Rounds join neighbours (a, b) with a in the left and b in the right half of the
   names; halves are drawn anew each round.  Three rounds join single words, a fourth joins symbols of
   up to two words (``SIDES``), so no symbol has more than four words and whether a symbol starts at a word depends on the ``REACH``
   words before and behind it only.  Hence equal windows have the same symbols inside, and at
   least one starts in the middle, at which the ``2 * REACH`` words around it are shared.  These contexts, about one
   for two words, are grouped by Spark; windows whose contexts are all shared by
   several documents are candidates.  No repeat is missed; what isn't one is dropped in 3.
2. *High symbols.*  The candidates' words are recompressed further (runs, then pairs, ``HIGH``
   rounds, some 16 words a symbol).  A high symbol stands for the windows that start in
   it; its key is a 128-bit hash of all words of these windows.  A symbol that a smaller document
   shares settles all its windows at once; so the copies of a long repeat cost a row for
   16 words.
3. *Verify.*  Of the symbols that are left (first occurrences, and the ends of repeats) each
   window is looked up by the 128-bit hash of its words.

Each lookup (``repeats``) packs its keys by bucket into few binary rows.  A task keeps
one row a key before the shuffle, whatever number of documents holds it, so a passage that a third of all documents
share reaches its bucket once per task; there are more buckets as the corpus grows.  Documents are
joined by id with what was found in them; no group of copies is ever gathered.

Defined cases: a null text has no words; empty texts keep the empty text.  A null doc_id
counts as larger than every other.  Rows that share a doc_id don't remove each other's words,
and each gets what is found in any of them.  Windows that overlap themselves, or come again in their own document only, stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

WINDOW = 13
#: Most words of either neighbour that a revealing round joins.
SIDES = (1, 1, 1, 2)
#: A round looks as far beyond what the round before depends on as its neighbours are long.
REACH = sum(SIDES)
HIGH = 10
#: Texts of together this many characters are looked at at once; keys a task packs at once; characters a bucket.
PIECE, CHUNK, BUCKET = 2_000_000, 2_000_000, 16_000_000
LAST = (1 << 63) - 1
PACKED = "bucket int, found boolean, docs binary, counts binary, keys binary"
FOUND = "doc long, keys binary"

_ODD = 0x9E3779B97F4A7C15
_BYTE = np.random.default_rng(11).integers(1, 1 << 63, 256).astype(np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class _Powers:
    """Powers of an odd number and of its inverse modulo 2^64, as far as they were asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = max(n + 1, 1 << 20)
            self.up = np.cumprod(np.append(np.uint64(1), np.full(size, _ODD, np.uint64)))
            self.down = np.cumprod(np.append(np.uint64(1), np.full(size, pow(_ODD, -1, 1 << 64), np.uint64)))
        return self.up, self.down


_POWERS = _Powers()


def sums(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of values[start:end] for each start and end."""
    up, down = _POWERS.to(len(values))
    total = np.append(np.uint64(0), np.cumsum(values * up[: len(values)]))
    return mixed((total[end] - total[start]) * down[start])


class Piece:
    """Some texts, their words one after another: hash, place in bytes and text of each word."""

    def __init__(self, texts: list[str]):
        self.texts = [b" ".join(x.encode().split()) for x in texts]
        self.raw = b"\n".join(self.texts) + b"\n"
        buf = np.frombuffer(self.raw, np.uint8)
        gap = (buf == 32) | (buf == 10)
        before = np.append(True, gap[:-1])
        self.start, self.end = np.flatnonzero(~gap & before), np.flatnonzero(gap & ~before)
        self.h = np.zeros(len(self.start), np.uint64)
        at = 0
        while at < len(self.start):  # in slices of whole words
            to = max(at + 1, int(np.searchsorted(self.end, self.start[at] + (1 << 20))))
            lo, hi = self.start[at], self.end[to - 1]
            self.h[at:to] = sums(_BYTE[buf[lo:hi]], self.start[at:to] - lo, self.end[at:to] - lo)
            at = to
        firsts = np.cumsum([0] + [len(x) + 1 for x in self.texts[:-1]]) if self.texts else np.zeros(0, int)
        self.text = np.searchsorted(firsts, self.start, side="right") - 1
        self.first = np.append(True, self.text[1:] != self.text[:-1])[: len(self.start)]
        #: where each text's words begin, and their number at the end
        self.bounds = np.searchsorted(self.text, np.arange(len(self.texts) + 1))

    def contexts(self) -> tuple[np.ndarray, np.ndarray]:
        """(word at which a symbol starts, hash of the words around it)."""
        at, name, size, first = np.arange(len(self.h)), self.h, np.ones(len(self.h), int), self.first
        for k, most in enumerate(SIDES):
            left = mixed(name + np.uint64(2 * k + 1)) >> np.uint64(63) == 1
            fits = size <= most
            joined = np.flatnonzero(left[:-1] & ~left[1:] & fits[:-1] & fits[1:] & ~first[1:])
            name, size = name.copy(), size.copy()
            name[joined], size[joined] = mixed(name[joined] * np.uint64(3) + name[joined + 1]), size[joined] + size[joined + 1]
            at, name, size, first = (np.delete(x, joined + 1) for x in (at, name, size, first))
        at = at[(at >= REACH) & (at + REACH <= len(self.h))]
        at = at[self.text[at - REACH] == self.text[at + REACH - 1]]
        return at, sums(self.h, at - REACH, at + REACH)

    def candidates(self, at: np.ndarray, shared: np.ndarray, window: int) -> np.ndarray:
        """Words at which a window starts whose contexts (at ``at``) are all shared."""
        starts = np.arange(max(0, len(self.h) - window + 1))
        starts = starts[self.text[starts] == self.text[starts + window - 1]]
        unshared = np.zeros(len(self.h) + 1, int)
        unshared[at[~shared] + 1] = 1
        unshared = unshared.cumsum()
        return starts[unshared[starts + window - REACH + 1] == unshared[starts + REACH]]

    def symbols(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first window, number of windows) of each high symbol of the candidates."""
        name = self.h[starts]
        first = np.append(True, (np.diff(starts) != 1) | (self.text[starts[1:]] != self.text[starts[:-1]]))[: len(starts)]
        at = np.arange(len(starts))
        for k in range(HIGH):
            run = np.append(False, (name[1:] == name[:-1]) & ~first[1:])[: len(name)]
            head = np.flatnonzero(~run)
            times = np.diff(np.append(head, len(name)))
            name = np.where(times > 1, mixed(name[head] + times.astype(np.uint64) * np.uint64(_ODD)), name[head])
            at, first = at[head], first[head]
            left = mixed(name + np.uint64(100 + k)) >> np.uint64(63) == 1
            joined = np.flatnonzero(left[:-1] & ~left[1:] & ~first[1:])
            name[joined] = mixed(name[joined] * np.uint64(3) + name[joined + 1])
            at, name, first = (np.delete(x, joined + 1) for x in (at, name, first))
        return starts[at], np.diff(np.append(at, len(starts)))

    def keys(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """128 bits of the words first to last of each symbol or window, as two columns."""
        view, digest = memoryview(self.raw), xxhash.xxh3_128_digest
        ends = zip(self.start[first].tolist(), self.end[last].tolist(), strict=True)
        return np.frombuffer(b"".join([digest(view[i:j]) for i, j in ends]), np.uint64).reshape(-1, 2)


def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, Piece]]:
    """Rows with a column ``text``, some at a time."""
    for batch in batches:
        size = batch["text"].str.len().fillna(0).cumsum() // PIECE
        for _, some in batch.groupby(size, sort=True):
            yield some, Piece(some["text"].fillna("").to_list())


def _among(keys: np.ndarray, docs: np.ndarray, every: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(keys, docs, found, first) of distinct rows by key and doc.

    found: with ``every``, that several docs have the key, else that a smaller doc has; first: its key's first row.
    """
    order = np.lexsort((docs, *keys.T))
    keys, docs = keys[order], docs[order]
    new = np.append(True, (keys[1:] != keys[:-1]).any(1))[: len(docs)]
    own = new | np.append(True, docs[1:] != docs[:-1])[: len(docs)]
    keys, docs, new = keys[own], docs[own], new[own]
    of = np.cumsum(new) - 1
    head = np.flatnonzero(new)
    if every:
        found = np.diff(np.append(head, len(docs)))[of] > 1 if len(docs) else np.zeros(0, bool)
    else:
        found = docs > docs[head][of] if len(docs) else np.zeros(0, bool)
    return keys, docs, found, new


def _pack(keys: np.ndarray, docs: np.ndarray, bucket: np.ndarray, found: bool) -> Iterator[tuple]:
    order = np.lexsort((docs, bucket))
    keys, docs, bucket = keys[order], docs[order], bucket[order]
    cut = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)]), len(bucket))
    for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        who, times = np.unique(docs[i:j], return_counts=True)
        yield int(bucket[i]), found, who.tobytes(), times.astype(np.int32).tobytes(), np.ascontiguousarray(keys[i:j]).tobytes()


def repeats(rows: DataFrame, made: Callable[[pd.DataFrame, Piece], tuple[np.ndarray, np.ndarray]], width: int, every: bool, buckets: int) -> DataFrame:
    """(doc, keys) that other documents have too, a row per doc.

    ``made`` gives keys (``width`` columns) and docs of some rows.  A doc may come in several rows.
    """

    names = [c.split()[0] for c in PACKED.split(", ")]

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def out(some: list) -> pd.DataFrame:
            keys, docs, found, first = _among(np.concatenate([k for k, _ in some]), np.concatenate([d for _, d in some]), every)
            by_key, by_doc = (keys[first][:, 0] % np.uint64(buckets)).astype(int), docs[found] % buckets
            return pd.DataFrame([*_pack(keys[first], docs[first], by_key, False), *_pack(keys[found], docs[found], by_doc, True)], columns=names)

        some, n = [], 0
        for frame, piece in pieces(batches):
            some.append(made(frame, piece))
            n += len(some[-1][1])
            if n >= CHUNK:
                yield out(some)
                some, n = [], 0
        if n:
            yield out(some)

    def opened(some: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        docs = np.repeat(np.frombuffer(b"".join(some["docs"]), np.int64), np.frombuffer(b"".join(some["counts"]), np.int32))
        return np.frombuffer(b"".join(some["keys"]), np.uint64).reshape(-1, width), docs

    def met(group: pd.DataFrame) -> pd.DataFrame:
        """A bucket of keys answers in a row per bucket of docs; what tasks have found is in its docs' bucket already."""
        keys, docs, found, _ = _among(*opened(group[~group["found"]]), every)
        answers = pd.DataFrame([*_pack(keys[found], docs[found], docs[found] % buckets, True)], columns=names)
        return pd.concat([group[group["found"]], answers])

    def per_doc(group: pd.DataFrame) -> pd.DataFrame:
        keys, docs = opened(group)
        order = np.argsort(docs, kind="stable")
        keys, docs = keys[order], docs[order]
        cut = np.append(np.flatnonzero(np.append(True, docs[1:] != docs[:-1])[: len(docs)]), len(docs))
        return pd.DataFrame({"doc": docs[cut[:-1]], "keys": [keys[i:j].tobytes() for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]})

    return rows.mapInPandas(packed, PACKED).groupBy("bucket").applyInPandas(met, PACKED).groupBy("bucket").applyInPandas(per_doc, FOUND)


def _with(rows: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """``rows`` and what was found in their doc, as a binary."""
    return rows.join(found.select("doc", F.col("keys").alias(name)), "doc", "left")


def _mine(frame: pd.DataFrame, piece: Piece, of_word: np.ndarray, keys: np.ndarray, column: str) -> np.ndarray:
    """Which keys, each at a word, were found in that word's own doc."""
    out = np.zeros(len(keys), bool)
    whole = np.dtype(np.uint64) if keys.shape[1] == 1 else np.dtype((np.void, 8 * keys.shape[1]))
    keys = np.ascontiguousarray(keys).view(whole).ravel()
    bounds = np.searchsorted(piece.text[of_word], np.arange(len(frame) + 1))
    for k, found in enumerate(frame[column]):
        i, j = bounds[k], bounds[k + 1]
        if found is not None and j > i:
            out[i:j] = np.isin(keys[i:j], np.frombuffer(found, whole))
    return out


def _starts(frame: pd.DataFrame, piece: Piece) -> np.ndarray:
    """Candidates stored with texts, as words of the piece."""
    if not len(frame):
        return np.zeros(0, int)
    return np.concatenate([np.frombuffer(x, np.int32).astype(int) + piece.bounds[k] for k, x in enumerate(frame["starts"])])


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, text (kept words, joined by one space; null if only numbers were asked), n_words, n_removed and kept_sha256 of each row of ``docs``."""
    if window - 2 * REACH + 1 < 2 * SIDES[-1]:
        raise ValueError(f"a window needs {2 * REACH - 1 + 2 * SIDES[-1]} words")
    spark = docs.sparkSession
    own = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), F.col("doc_id").cast("long").isNull().alias("unnamed"), F.col("text").cast("string").alias("text"))
    size = own.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // BUCKET + 1)

    def contexts(frame: pd.DataFrame, piece: Piece) -> tuple[np.ndarray, np.ndarray]:
        at, keys = piece.contexts()
        return keys[:, None], frame["doc"].to_numpy(np.int64)[piece.text[at]]

    revealed = common.store(repeats(own.drop("unnamed"), contexts, 1, True, buckets), "contexts")

    def opened(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, piece in pieces(batches):
            at, keys = piece.contexts()
            starts = piece.candidates(at, _mine(frame, piece, at, keys[:, None], "revealed"), window)
            bounds = np.searchsorted(piece.text[starts], np.arange(len(frame) + 1))
            rows = []
            for k, text in enumerate(piece.texts):
                mine = starts[bounds[k] : bounds[k + 1]] - piece.bounds[k]
                rows.append((text.decode(), int(piece.bounds[k + 1] - piece.bounds[k]), hashlib.sha256(text).hexdigest(), mine.astype(np.int32).tobytes()))
            out = pd.DataFrame(rows, columns=["text", "n_words", "sha", "starts"])
            yield out.assign(doc=frame["doc"].to_numpy(), unnamed=frame["unnamed"].to_numpy())

    shape = "doc long, unnamed boolean, text string, n_words long, sha string, starts binary"
    texts = common.store(_with(own, revealed, "revealed").mapInPandas(opened, shape), "texts")
    common.discard(revealed)
    candidates = texts.where(F.length("starts") > 0)

    def symbols(frame: pd.DataFrame, piece: Piece) -> tuple[np.ndarray, np.ndarray]:
        first, n = piece.symbols(_starts(frame, piece))
        return piece.keys(first, first + n + window - 2), frame["doc"].to_numpy(np.int64)[piece.text[first]]

    settled = common.store(repeats(candidates.select("doc", "text", "starts"), symbols, 2, False, buckets), "symbols")

    def left_over(frame: pd.DataFrame, piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(windows that a symbol settles, windows left, their keys, docs)."""
        first, n = piece.symbols(_starts(frame, piece))
        done = _mine(frame, piece, first, piece.keys(first, first + n + window - 2), "settled")
        each = lambda some: np.repeat(first[some] - (n[some].cumsum() - n[some]), n[some]) + np.arange(n[some].sum())
        rest = each(~done)
        return each(done), rest, piece.keys(rest, rest + window - 1), frame["doc"].to_numpy(np.int64)[piece.text[rest]]

    sure = _with(candidates.select("doc", "text", "starts"), settled, "settled")
    verified = common.store(repeats(sure, lambda frame, piece: left_over(frame, piece)[2:], 2, False, buckets), "windows")

    def kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, piece in pieces(batches):
            done, rest, keys, _ = left_over(frame, piece)
            done = np.concatenate([done, rest[_mine(frame, piece, rest, keys, "verified")]])
            cover = np.zeros(len(piece.h) + 1, int)
            np.add.at(cover, done, 1)
            np.add.at(cover, done + window, -1)
            gone = cover.cumsum()[:-1] > 0
            rows = []
            for k, text in enumerate(piece.texts):
                i, j = piece.bounds[k], piece.bounds[k + 1]
                stays = ~gone[i:j]
                if not stays.all():
                    words = text.split()
                    text = b" ".join([words[x] for x in np.flatnonzero(stays).tolist()])
                rows.append((text.decode(), int(j - i), int(j - i - stays.sum()), hashlib.sha256(text).hexdigest()))
            out = pd.DataFrame(rows, columns=["text", "n_words", "n_removed", "kept_sha256"])
            yield out.assign(doc=frame["doc"].to_numpy(), unnamed=frame["unnamed"].to_numpy())

    looked = _with(_with(candidates.select("doc", "unnamed", "text", "starts"), settled, "settled"), verified, "verified")
    changed = looked.mapInPandas(kept, "doc long, unnamed boolean, text string, n_words long, n_removed long, kept_sha256 string")
    same = texts.where(F.length("starts") == 0).select("doc", "unnamed", "text", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha").alias("kept_sha256"))
    both = changed.select(*same.columns).union(same)
    return both.select(F.when(~F.col("unnamed"), F.col("doc")).alias("doc_id"), "text", "n_words", "n_removed", "kept_sha256")


def op11_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words kept and removed of every document."""
    return without_repeats(common.read_table(spark, sf_dir, "documents")).drop("text")


#: Groups all windows; fit for small tables only.
OP11_SQL = rf"""WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
 s AS (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d),
 k AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY array_to_string(w[i : i + {WINDOW - 1}], ' ')) < doc_id AS again FROM s),
 gone AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW})) AS i FROM k WHERE again),
 words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
 kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)"""
