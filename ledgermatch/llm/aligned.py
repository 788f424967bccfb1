"""Alignment of two tokenizers over the same texts: byte-level BPE (A) and pieces with byte fallback (B).

A encodes a space and the text, B the text, to which it adds the space.  The character
offsets of A's tokens and the spans of B's tokens give coarse cuts, places where tokens of both
end between two characters; between two coarse cuts the decoded bytes of the tokens decide,
which also places tokens that are a part of a character or a byte of the fallback.  Where both
sides' bytes end together a group ends, and the tokens that end there are linked.

A text is encoded in segments (and new segments many at a time, joined): both tokenizers always break before a single space between a
printing and a word character, since no piece of B goes on across a space (checked when a
vocabulary is read) and A's pattern starts a new match there.  Equal segments are
encoded once a worker, as long as it remembers them (``REMEMBER`` segments at most).

Counts of linked id pairs: one token's bytes end with the other's, so there are no more pairs
than (suffix of a token, token with these bytes), a list that both vocabularies fix
(``Pairs``, some hundred thousand).  Tasks count into it, Spark sums, and the sums, bounded by
the vocabularies, are broadcast to a second look at the stored links.

Texts that are null or empty, or that either side's tokens don't spell byte by byte (B's
normalization can change a text), have no tokens: zeros, and '' for the digest.  Special
tokens are never made, their strings are text.  Neither vocabulary has an empty token.
Repeated rows count as often as they come; a null doc_id stays null.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import sentencepiece
import tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

LEFT, RIGHT = "byte_bpe_50k.json", "piece_bpe_32k.model"
REMEMBER, JOINED = 400_000, 500
SEGMENT = re.compile(r"(?<=[!-~\w]) (?=\w)")
#: Segments that can stand between others: a space joins them to a text that splits into them again.
INNER = re.compile(r"\w(?:.*[!-~\w])?\Z", re.S)
#: ``pairs`` and ``times`` are int32 arrays: places in the list of pairs, and how often a document links each.
LINKED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"


def byte_alphabet() -> dict[str, int]:
    """The characters that byte-level vocabularies write for the 256 bytes: printing ones stand for themselves."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def left(path: str) -> tuple[tokenizers.Tokenizer, list[bytes]]:
    """A and the bytes of each of its ids."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    model = tokenizers.Tokenizer.from_file(path)
    model.encode_special_tokens = True
    alphabet = byte_alphabet()
    spelled = [b""] * model.get_vocab_size()
    for token, i in model.get_vocab().items():
        if all(c in alphabet for c in token):
            spelled[i] = bytes(alphabet[c] for c in token)
    return model, spelled


@lru_cache(maxsize=2)
def right(path: str) -> tuple[sentencepiece.SentencePieceProcessor, list[bytes]]:
    """B and the bytes of each of its ids."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    if not all(re.match(r"▁*[^▁]*\Z", p) for p in pieces):
        raise ValueError("a piece goes on across a space: texts can't be encoded in segments")
    return model, [bytes([int(p[3:-1], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]


class Pairs:
    """All id pairs that can be linked, sorted: ids whose bytes end alike as far as the shorter goes."""

    def __init__(self, a: list[bytes], b: list[bytes]):
        def by_bytes(spelled):
            out: dict[bytes, list[int]] = {}
            for i, x in enumerate(spelled):
                if x:
                    out.setdefault(x, []).append(i)
            return out

        of_a, of_b = by_bytes(a), by_bytes(b)
        found = {(i, j) for i, x in enumerate(a) for k in range(len(x)) for j in of_b.get(x[k:], ())}
        found |= {(i, j) for j, x in enumerate(b) for k in range(1, len(x)) for i in of_a.get(x[k:], ())}
        self.codes = np.sort(np.fromiter(((i << 32) | j for i, j in found), np.int64, len(found)))

    def places(self, a: list[int] | np.ndarray, b: list[int] | np.ndarray) -> np.ndarray:
        return np.searchsorted(self.codes, (np.asarray(a, np.int64) << 32) | np.asarray(b, np.int64)).astype(np.int32)


@lru_cache(maxsize=2)
def pairs(a: str, b: str) -> Pairs:
    return Pairs(left(a)[1], right(b)[1])


def _refine(a: list[int], b: list[int], by_a: list[bytes], by_b: list[bytes], raw: bytes) -> list[tuple[list[int], list[int]]] | None:
    """Groups of the tokens between two coarse cuts by their decoded bytes, None if either side doesn't spell ``raw``."""
    if b"".join([by_a[i] for i in a]) != raw or b"".join([by_b[i] for i in b]) != raw:
        return None
    if len(a) == 1 or len(b) == 1:
        return [(a, b)]
    groups, i, j, end_a, end_b, from_a, from_b = [], 0, 0, 0, 0, 0, 0
    while i < len(a) or j < len(b):
        if end_a <= end_b:
            end_a += len(by_a[a[i]])
            i += 1
        else:
            end_b += len(by_b[b[j]])
            j += 1
        if end_a == end_b:
            groups.append((a[from_a:i], b[from_b:j]))
            from_a, from_b = i, j
    return groups


def align(text: str, encoded, spans: list[tuple[int, int]], by_a: list[bytes], by_b: list[bytes]) -> list[tuple[list[int], list[int]]] | None:
    """Groups (ids of A, ids of B) of a space and ``text``.

    ``encoded`` has A's ids and character offsets, ``spans`` B's ids and the bytes of ``text`` at which they end.
    """
    raw = b" " + text.encode()
    if raw.isascii():
        ends_a = [e for _, e in encoded.offsets]
    else:
        at = np.concatenate([[0], np.cumsum([len(c.encode()) for c in " " + text])]).tolist()
        ends_a = [at[e] for _, e in encoded.offsets]
    a, b = encoded.ids, [i for i, _ in spans]
    ends_b = [e + 1 for _, e in spans]
    last_a, last_b = dict(zip(ends_a, range(1, len(a) + 1))), dict(zip(ends_b, range(1, len(b) + 1)))
    groups, from_a, from_b, start = [], 0, 0, 0
    for end in sorted(last_a.keys() & last_b.keys() | {len(raw)}):
        to_a, to_b = (last_a.get(end, len(a)), last_b.get(end, len(b))) if end < len(raw) else (len(a), len(b))
        some = _refine(a[from_a:to_a], b[from_b:to_b], by_a, by_b, raw[start:end]) if to_a > from_a and to_b > from_b else None
        if some is not None:  # else offsets left out white space: the next cut decides
            groups += some
            from_a, from_b, start = to_a, to_b, end
    return groups if start == len(raw) and from_a == len(a) and from_b == len(b) else None


class Segments:
    """Aligned segments by number; -1 stands for one that has no alignment."""

    def __init__(self, a: str, b: str):
        (self.a, self.by_a), (self.b, self.by_b), self.pairs = left(a), right(b), pairs(a, b)
        self.length_a, self.length_b = (np.array([len(x) for x in by]) for by in (self.by_a, self.by_b))
        # ids as text with what follows them: "," in a group, "|" after A's last, ";" after B's last
        self.written = [f"{i}{c}" for n, last in ((len(self.by_a), "|"), (len(self.by_b), ";")) for c in (",", last) for i in range(n)]
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.texts: list[str] = []
        self.groups: list[str] = []
        self.sizes, self.seen = np.zeros((0, 3), np.int64), np.zeros(0, np.int64)
        #: all links after another, and where each segment's begin and the last one's end
        self.flat, self.at = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.news: list[tuple[list[str], np.ndarray, list[str], np.ndarray]] = []

    def _shrink(self) -> None:
        """Keep the half seen most often."""
        keep = np.sort(np.argsort(-self.seen, kind="stable")[: REMEMBER // 2])
        kept = [self.texts[i] for i in keep.tolist()], self.sizes[keep], [self.groups[i] for i in keep.tolist()], self.links(keep)
        self.forget()
        self.news.append(kept)
        self._take()

    def _take(self) -> None:
        """Number what has been learnt."""
        if not self.news:
            return
        texts, sizes, groups, links = zip(*self.news, strict=True)
        self.news = []
        for some in texts:
            self.number.update(zip(some, range(len(self.texts), len(self.texts) + len(some)), strict=True))
            self.texts += some
        for some in groups:
            self.groups += some
        self.sizes = np.concatenate([self.sizes, *sizes])
        self.seen = np.concatenate([self.seen, np.zeros(len(self.sizes) - len(self.seen), np.int64)])
        self.flat = np.concatenate([self.flat, *links])
        self.at = np.append(0, self.sizes[:, 2].cumsum())

    def links(self, numbers: np.ndarray) -> np.ndarray:
        """The links of the segments, after another."""
        n = self.sizes[numbers, 2]
        before = np.cumsum(n) - n
        return self.flat[np.repeat(self.at[numbers] - before, n) + np.arange(n.sum())]

    def _one(self, text: str) -> None:
        """Learn a segment by itself."""
        encoded = self.a.encode(" " + text, add_special_tokens=False)
        proto = self.b.encode(text, return_type="proto")
        groups = align(text, encoded, [(p.id, p.end) for p in proto.pieces], self.by_a, self.by_b)
        if groups is None:
            self.number[text] = -1
            return
        written = ";".join([f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups])
        places = self.pairs.places([a[-1] for a, _ in groups], [b[-1] for _, b in groups])
        self.news.append(([text], np.array([[len(encoded.ids), len(proto.pieces), len(groups)]]), [written], places))

    def _joined(self, texts: list[str]) -> None:
        """Learn segments that a space joins to a text which splits into them again: ``align`` for all at once, in arrays."""
        text = " ".join(texts)
        raw = b" " + text.encode()
        encoded = self.a.encode(" " + text, add_special_tokens=False)
        pieces = self.b.encode(text, return_type="proto").pieces
        a, b = np.array(encoded.ids), np.array([p.id for p in pieces])
        if b"".join([self.by_a[i] for i in encoded.ids]) != raw or b"".join([self.by_b[i] for i in b.tolist()]) != raw:
            if len(texts) == 1:
                return self._one(texts[0])
            for half in (texts[: len(texts) // 2], texts[len(texts) // 2 :]):
                self._joined(half)
            return None
        # spans are coarse; where they aren't where a token's bytes end, the bytes decide
        start = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
        ends_a = np.append(start, len(raw))[np.array(encoded.offsets)[:, 1]]
        ends_b = np.array([p.end for p in pieces]) + 1
        fine_a, fine_b = self.length_a[a].cumsum(), self.length_b[b].cumsum()
        ends_a, ends_b = np.where(ends_a == fine_a, ends_a, fine_a), np.where(ends_b == fine_b, ends_b, fine_b)
        ends = np.intersect1d(ends_a, ends_b, assume_unique=True)
        of_a, of_b = np.searchsorted(ends, ends_a), np.searchsorted(ends, ends_b)
        last_a, last_b = np.append(of_a[1:] != of_a[:-1], True), np.append(of_b[1:] != of_b[:-1], True)
        links = self.pairs.places(a[last_a], b[last_b])
        codes = np.concatenate([a + last_a * len(self.by_a), b + 2 * len(self.by_a) + last_b * len(self.by_b)])
        order = np.argsort(np.concatenate([2 * of_a, 2 * of_b + 1]), kind="stable")
        written = [self.written[c] for c in codes[order].tolist()]
        cuts = np.cumsum([(len(x) if x.isascii() else len(x.encode())) + 1 for x in texts])
        to = [np.searchsorted(e, cuts, side="right") for e in (ends_a, ends_b, ends)]
        sizes = np.diff(np.stack(to, axis=1), axis=0, prepend=0)
        bounds = [0, *(to[0] + to[1]).tolist()]
        self.news.append((texts, sizes, ["".join(written[i:j])[:-1] for i, j in zip(bounds, bounds[1:], strict=False)], links))

    def learn(self, texts: list[str]) -> None:
        inner = [x for x in texts if INNER.match(x)]
        for at in range(0, len(inner), JOINED):
            self._joined(inner[at : at + JOINED])
        for x in texts:
            if not INNER.match(x):
                self._one(x)
        self._take()

    def of(self, texts: list[str]) -> list[np.ndarray]:
        """Each text's segments by number."""
        cut = [SEGMENT.split(x) if x else [] for x in texts]
        if len(self.number) > REMEMBER:
            self._shrink()
        new = {s for some in cut for s in some if s not in self.number}
        if new:
            self.learn(list(new))
        number = self.number
        out = [np.array([number[s] for s in some], np.int64) for some in cut]
        used = np.unique(np.concatenate(out)) if out else np.zeros(0, np.int64)
        self.seen[used[used >= 0]] += 1
        return out


@lru_cache(maxsize=2)
def segments(a: str, b: str) -> Segments:
    return Segments(a, b)


def links(docs: DataFrame, a: str | None = None, b: str | None = None) -> DataFrame:
    """One row per document: token, group and link numbers, digest of the groups, and the linked pairs with their numbers."""
    a, b = a or public_tokenizers.path(LEFT), b or public_tokenizers.path(RIGHT)

    def row(of: Segments, numbers: np.ndarray) -> tuple:
        if not len(numbers) or numbers.min() < 0:
            return (0, 0, 0, 0, "", b"", b"")
        sizes = of.sizes[numbers].sum(0).tolist()
        found, times = np.unique(of.links(numbers), return_counts=True)
        digest = hashlib.sha256(";".join([of.groups[i] for i in numbers.tolist()]).encode()).hexdigest()
        return (*sizes, sizes[2], digest, found.tobytes(), times.astype(np.int32).tobytes())

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = segments(a, b)
        for batch in batches:
            for at in range(0, len(batch), 1000):
                some = batch.iloc[at : at + 1000]
                rows = [row(of, x) for x in of.of(some["text"].fillna("").to_list())]
                out = pd.DataFrame(rows, columns=[c.split()[0] for c in LINKED.split(", ")[1:]])
                out.insert(0, "doc_id", some["doc_id"].array)
                yield out

    ids = F.col("doc_id").cast("long").cast("string")  # a null keeps pandas from turning ids to doubles
    got = docs.select(ids.alias("doc_id"), F.col("text").cast("string")).mapInPandas(made, LINKED.replace("doc_id long", "doc_id string"))
    return got.withColumn("doc_id", F.col("doc_id").cast("long"))


def counts(linked: DataFrame, size: int) -> DataFrame:
    """(place, n): how many links of all documents hold each pair; ``size`` is the number of possible pairs."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for p, t in zip(batch["pairs"], batch["times"], strict=True):
                total[np.frombuffer(p, np.int32)] += np.frombuffer(t, np.int32)
        place = np.flatnonzero(total)
        yield pd.DataFrame({"place": place.astype(np.int32), "n": total[place]})

    return linked.select("pairs", "times").mapInPandas(of, "place int, n long").groupBy("place").agg(F.sum("n").alias("n"))


def alignment(docs: DataFrame, a: str | None = None, b: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    a, b = a or public_tokenizers.path(LEFT), b or public_tokenizers.path(RIGHT)
    codes = pairs(a, b).codes
    linked = common.store(links(docs, a, b), "linked")
    # as many rows as there are possible pairs at most, whatever the corpus
    found = counts(linked, len(codes)).toPandas()
    total = np.zeros(len(codes), np.int64)
    total[found["place"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    of_b = codes & 0xFFFFFFFF
    highest = np.zeros(int(of_b.max()) + 1 if len(codes) else 0, np.int64)
    np.maximum.at(highest, of_b, total)
    shared = docs.sparkSession.sparkContext.broadcast((total, (total == highest[of_b]) & (total > 0)))

    @F.pandas_udf("n_best long, count_sum long")
    def scored(pairs: pd.Series, times: pd.Series) -> pd.DataFrame:
        n, best = shared.value
        rows = []
        for p, t in zip(pairs, times, strict=True):
            p, t = np.frombuffer(p, np.int32), np.frombuffer(t, np.int32).astype(np.int64)
            rows.append((int(t[best[p]].sum()), int((t * n[p]).sum())))
        return pd.DataFrame(rows, columns=["n_best", "count_sum"])

    got = linked.withColumn("s", scored("pairs", "times"))
    return got.select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.col("s.n_best").alias("n_best"), F.col("s.count_sum").alias("count_sum"), "groups_sha256")


def op13_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of both tokenizers over every document."""
    return alignment(common.read_table(spark, sf_dir, "documents"))
