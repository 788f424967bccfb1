"""Document quality from a linear-chain conditional random field over lines.

Every line of a text is good (1) or bad (0).  A line's potentials come from its own features
(length, shares of letter cases, digits and symbols, word lengths, repeated words, whether the
line repeats in the document) and from those of the line before and after; a 2 x 2 matrix
scores the step from line to line.  The forward-backward algorithm gives each line's marginal
probability of being good, and the mean of the marginals weighted by line length (bytes + 1)
is the document's score between 0 and 1.

Training takes at most ``TRAIN_DOCS`` labelled documents of at most ``TRAIN_BYTES`` bytes and
``TRAIN_LINES`` lines together, those of smallest hash of their id: a bounded sample, whatever
the size of the corpus (its features take some 40 MB of the driver).  Labels are of documents,
so all lines of a labelled document carry its label, and the step matrix learns that lines
keep their kind: the chain passes evidence along the document.  Only the text is an input.
With fewer than one label of either kind all scores are 0.5.

Null and empty texts are one empty line.  Whole texts are scored, in pieces of ``PIECE``
bytes: what is open at a cut, a line or a word, is carried over it with its counts and
hashes, so features don't depend on where cuts fall.  A text's lines are scored ``ROWS`` at a time
and texts of more than ``LONG`` lines go by blocked scans, so a million lines take seconds.  Memory
grows with a text by some 350 bytes per line (counts, hashes and the chain's scores).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

TRAIN_DOCS, TRAIN_BYTES, TRAIN_LINES, PIECE, THRESHOLD = 4000, 200_000, 150_000, 1 << 20, 0.3
#: Texts of more lines go by blocked scans; lines whose features are held at a time when scoring.
LONG, ROWS = 2048, 1 << 16
FOLDS = 5

_CLASSES = 8
_CLASS = np.full(256, 7, dtype=np.uint8)  # 7: letters of other alphabets and whatever is left
for _k, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"%&*$#@^~=<>{}[]\\_+", b"|", b"!?", b".,;:", b" \t\n\r\x0b\x0c")):
    _CLASS[np.frombuffer(_chars, dtype=np.uint8)] = _k
_SPACE = 6
#: Odd, so that it has an inverse modulo 2**64.
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_OWN = 16  # features of a line itself
_NEAR = (3, 5, 6, 7, 10, 11)  # of these, the neighbours' are taken too
WIDTH = _OWN + 2 * (len(_NEAR) + 1)


@dataclass
class _Open:
    """What goes on after a cut: the line so far, its last whole word, and the word at the cut."""

    length: int = 0
    last: int | None = None  # hash of the line's last whole word
    size: int = 0  # bytes of the open word
    word: int = 0  # its hash so far


def _fragments(piece: np.ndarray, carry: _Open, ends_text: bool) -> tuple[np.ndarray, np.ndarray, _Open]:
    """Counts of each line, or part of a line, of some bytes, their share of the line's hash, and what stays open.

    Columns: length, 7 classes, words, short words, bytes of words, repeats of the word before, sentence end.
    Hashes are sums of (byte + 1) * P**place, with the place in the word or line, modulo 2**64.
    """
    n = len(piece)
    breaks = np.flatnonzero(piece == 10)
    whole = bool(n) and piece[-1] == 10
    ends = breaks if whole else np.append(breaks, n)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else np.zeros(0, dtype=np.int64)
    kinds = _CLASS[piece]
    out = np.zeros((len(ends), 13))
    out[:, 0] = ends - starts
    for k in range(7):
        total = np.concatenate([[0], np.cumsum(kinds == k, dtype=np.int32)])
        out[:, 1 + k] = total[ends] - total[starts]
    space = np.concatenate([[True], kinds == _SPACE, [True]])
    first, last = np.flatnonzero(space[:-1] & ~space[1:]), np.flatnonzero(~space[:-1] & space[1:])
    powers, inverse = np.full(n + 1, _P), np.full(n + 1, _P_INVERSE)
    powers[0] = inverse[0] = 1
    powers, inverse = np.cumprod(powers), np.cumprod(inverse)
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * powers[:-1])])
    word, size = (total[last] - total[first]) * inverse[first], last - first
    line = np.searchsorted(starts, first, side="right") - 1

    shift = lambda h, by: int(h) * pow(int(_P), by, 1 << 64) % (1 << 64)
    if carry.size and n and not space[1]:  # the open word goes on
        word[0] = np.uint64((carry.word + shift(word[0], carry.size)) % (1 << 64))
        size[0] += carry.size
    elif carry.size:  # it has ended at the cut
        word, size, line = np.concatenate([[np.uint64(carry.word)], word]), np.concatenate([[carry.size], size]), np.concatenate([[0], line])
    left = _Open()
    if not whole and not ends_text:
        left.length = int(out[-1, 0]) + (carry.length if len(ends) == 1 else 0)
        if n and not space[-2]:  # the last word is open
            left.size, left.word = int(size[-1]), int(word[-1])
            word, size, line = word[:-1], size[:-1], line[:-1]
        own = np.flatnonzero(line == len(ends) - 1)
        left.last = int(word[own[-1]]) if len(own) else (carry.last if len(ends) == 1 else None)
    same = np.zeros(len(word), dtype=bool)
    same[1:] = (word[1:] == word[:-1]) & (line[1:] == line[:-1])
    if len(word) and line[0] == 0 and carry.last is not None:
        same[0] = int(word[0]) == carry.last
    for k, values in ((8, None), (9, size <= 3), (10, size), (11, same)):
        out[:, k] = np.bincount(line, weights=values, minlength=len(ends))[: len(ends)]
    tail = np.where(ends > starts, piece[np.maximum(ends - 1, 0)] if n else 0, 0)
    out[:, 12] = np.isin(tail, np.frombuffer(b".!?:", dtype=np.uint8))
    hashes = (total[ends] - total[starts]) * inverse[starts]
    if carry.length and len(hashes):
        hashes[0] = np.uint64(shift(hashes[0], carry.length))
    return out, hashes, left


def _pieces(texts: list[bytes]) -> Iterator[bytes]:
    """The texts, each ended by a line break, in pieces of about PIECE bytes."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        for at in range(0, len(text) + 1, PIECE):
            part = text[at : at + PIECE] + (b"\n" if at + PIECE > len(text) else b"")
            held.append(part)
            size += len(part)
            if size >= PIECE:
                yield b"".join(held)
                held, size = [], 0
    if held:
        yield b"".join(held)


def line_counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(counts [lines, 13], whether a line repeats in its text, number of lines of each text)."""
    raw = [(x or "").encode() for x in texts]
    count = np.array([x.count(b"\n") + 1 for x in raw], dtype=np.int64)
    parts, marks, joined, carry = [], [], [], _Open()
    for piece in _pieces(raw):
        whole = piece.endswith(b"\n")
        counts, hashes, carry = _fragments(np.frombuffer(piece, dtype=np.uint8), carry, whole)
        parts.append(counts)
        marks.append(hashes)
        open_end = np.zeros(len(counts), dtype=bool)
        open_end[-1] = not whole  # the line goes on in the next piece
        joined.append(open_end)
    counts, goes_on, marks = np.concatenate(parts), np.concatenate(joined), np.concatenate(marks)
    parts.clear()
    if goes_on.any():
        begin = np.flatnonzero(np.concatenate([[True], ~goes_on[:-1]]))
        end_of = np.append(begin[1:], len(counts)) - 1
        # A line that ends right at a cut has an empty last part: its end is in the part before.
        last = np.where((counts[end_of, 0] == 0) & (end_of > begin), end_of - 1, end_of)
        tail = counts[last, 12]
        counts, marks = np.add.reduceat(counts, begin, axis=0), np.add.reduceat(marks, begin)
        counts[:, 12] = tail
    doc = np.repeat(np.arange(len(count)), count)
    order = np.lexsort((counts[:, 0], marks, doc))
    same = (np.diff(doc[order]) == 0) & (marks[order[1:]] == marks[order[:-1]]) & (np.diff(counts[order, 0]) == 0)
    again = np.zeros(len(counts), dtype=bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    return counts, again & (counts[:, 0] > 0), count


def _features(counts: np.ndarray, again: np.ndarray, starts: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Features [hi - lo, WIDTH] of the lines from ``lo`` to ``hi``; ``starts`` marks the first line of each text and, at the end, one more."""
    from_, to = max(lo - 1, 0), min(hi + 1, len(counts))
    some, back = counts[from_:to], again[from_:to]
    length, words = some[:, 0], np.maximum(some[:, 8], 1)
    share = some[:, 1:8] / np.maximum(length, 1)[:, None]
    x = np.zeros((len(some), WIDTH))
    x[:, 0] = 1
    x[:, 1] = np.log1p(length) / 8
    x[:, 2] = length == 0
    x[:, 3:9] = np.sqrt(share[:, :6])  # upper, digit, symbol, bar, ! and ?, sentence marks
    x[:, 9] = np.minimum(some[:, 10] / words / 10, 3)
    x[:, 10] = some[:, 11] / words
    x[:, 11] = back
    x[:, 12] = share[:, 6]
    x[:, 13] = length < 40
    x[:, 14] = some[:, 12]
    x[:, 15] = some[:, 9] / words
    has_before, has_after = ~starts[from_:to], ~starts[from_ + 1 : to + 1]
    at, near = _OWN, list(_NEAR)
    for there, shift in ((has_before, 1), (has_after, -1)):
        x[:, at] = there
        x[:, at + 1 : at + 1 + len(near)] = np.roll(x[:, near], shift, axis=0) * there[:, None]
        at += 1 + len(near)
    return x[lo - from_ : hi - from_]


def _starts(count: np.ndarray) -> np.ndarray:
    out = np.zeros(int(count.sum()) + 1, dtype=bool)
    out[np.cumsum(count) - count] = out[-1] = True
    return out


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features [lines, WIDTH], number of lines of each text, weight of each line)."""
    counts, again, count = line_counts(texts)
    return _features(counts, again, _starts(count), 0, len(counts)), count, counts[:, 0] + 1


@dataclass
class Model:
    """Weights of a line being good, and the scores of steps [from][to]."""

    weights: np.ndarray
    steps: np.ndarray


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of 2 x 2 matrices of logarithms."""
    return np.logaddexp(a[..., :, 0, None] + b[..., None, 0, :], a[..., :, 1, None] + b[..., None, 1, :])


def _prefixes(m: np.ndarray) -> np.ndarray:
    """Products of all leading matrices: root n blocks go along step by step together, then each block takes on those before it."""
    n = len(m)
    width = max(1, int(np.sqrt(n)))
    blocks = -(-n // width)
    out = np.full((blocks * width, 2, 2), -np.inf)
    out[:, 0, 0] = out[:, 1, 1] = 0
    out[:n] = m
    out = out.reshape(blocks, width, 2, 2)
    for t in range(1, width):
        out[:, t] = _times(out[:, t - 1], out[:, t])
    for i in range(1, blocks):
        out[i] = _times(out[i - 1, -1], out[i])
    return out.reshape(-1, 2, 2)[:n]


def _long_ahead(own: np.ndarray, steps: np.ndarray, piece: int = 1 << 16) -> np.ndarray:
    """Forward scores of one text, in pieces of lines that take on the last scores of the piece before."""
    out = np.empty_like(own)
    out[0] = own[0]
    for at in range(1, len(own), piece):
        part = own[at : at + piece]
        moved = _prefixes(steps + part[:, None, :])
        out[at : at + len(part)] = np.logaddexp(out[at - 1, 0] + moved[:, 0], out[at - 1, 1] + moved[:, 1])
    return out


def _long_behind(own: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Backward scores of one text: forward scores of its lines from the last to the first, without each line's own."""
    return (_long_ahead(own[::-1], steps.T) - own[::-1])[::-1]


def marginals(scores: np.ndarray, steps: np.ndarray, count: np.ndarray, long: int = LONG, pairs: bool = True) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """(P(good) of each line, expected steps [text][from][to] if asked for, log partition of each text).

    Texts of up to ``long`` lines go forward and backward together, line number by line number,
    longest first; longer ones go by blocked scans of matrix products.
    """
    order = np.argsort(-count, kind="stable")
    sizes, first = count[order], (np.cumsum(count) - count)[order]
    own = np.stack([np.zeros_like(scores), scores], axis=1)
    ahead, behind = np.empty_like(own), np.zeros_like(own)
    lengthy = int(np.searchsorted(-sizes, -long, side="left"))
    for at, n in zip(first[:lengthy].tolist(), sizes[:lengthy].tolist()):
        ahead[at : at + n] = _long_ahead(own[at : at + n], steps)
        behind[at : at + n] = _long_behind(own[at : at + n], steps)
    sizes, first = sizes[lengthy:], first[lengthy:]
    n_at = lambda t: int(np.searchsorted(-sizes, -t, side="left"))  # noqa: E731  texts with more than t lines
    longest = int(sizes[0]) if len(sizes) else 0
    active = [n_at(t) for t in range(longest)]
    for t in range(longest):
        at = first[: active[t]] + t
        if t == 0:
            ahead[at] = own[at]
        else:
            a = ahead[at - 1]
            ahead[at] = own[at] + np.stack([np.logaddexp(a[:, 0] + steps[0, k], a[:, 1] + steps[1, k]) for k in (0, 1)], axis=1)
    for t in range(longest - 2, -1, -1):
        at = first[: active[t + 1]] + t
        b = behind[at + 1] + own[at + 1]
        behind[at] = np.stack([np.logaddexp(b[:, 0] + steps[k, 0], b[:, 1] + steps[k, 1]) for k in (0, 1)], axis=1)
    last = np.cumsum(count) - 1
    total = np.logaddexp(ahead[last, 0], ahead[last, 1])
    line_total = np.repeat(total, count)
    good = np.exp(np.clip(ahead[:, 1] + behind[:, 1] - line_total, -700, 0))
    if not pairs:
        return good, None, total
    pair = np.zeros((len(count), 2, 2))
    inner = np.ones(len(scores), dtype=bool)
    inner[last] = False
    here = np.flatnonzero(inner)
    doc = np.repeat(np.arange(len(count)), count)[here]
    for j in (0, 1):
        for k in (0, 1):
            p = np.exp(ahead[here, j] + steps[j, k] + own[here + 1, k] + behind[here + 1, k] - line_total[here])
            pair[:, j, k] = np.bincount(doc, weights=p, minlength=len(count))
    return good, pair, total


def fit(x: np.ndarray, count: np.ndarray, label: np.ndarray, rounds: int = 250, ridge: float = 1e-4) -> Model:
    """Maximum likelihood by Adam; each text counts as one, its lines share its label."""
    model = Model(np.zeros(WIDTH), np.zeros((2, 2)))
    if len(count) == 0 or label.min() == label.max():
        return model
    weight = 1 / count
    per_line = np.repeat(weight, count) / len(count)
    seen = np.zeros((2, 2))
    for k in (0, 1):
        seen[k, k] = ((count - 1) * weight)[label == k].sum() / len(count)
    truth = np.repeat(label, count)
    theta = np.zeros(WIDTH + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for i in range(1, rounds + 1):
        good, pair, _ = marginals(x @ theta[:WIDTH], theta[WIDTH:].reshape(2, 2), count)
        slope = np.concatenate([x.T @ (per_line * (truth - good)), (seen - (pair * weight[:, None, None]).sum(0) / len(count)).ravel()]) - ridge * theta
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        theta = theta + 0.1 * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-8)
    return Model(theta[:WIDTH], theta[WIDTH:].reshape(2, 2))


def score_texts(texts: list[str | None], model: Model) -> np.ndarray:
    """Length-weighted means of the marginals."""
    if not texts:
        return np.zeros(0)
    counts, again, count = line_counts(texts)
    starts, n = _starts(count), len(counts)
    potentials = np.concatenate([_features(counts, again, starts, at, min(at + ROWS, n)) @ model.weights for at in range(0, n, ROWS)])
    weight = counts[:, 0] + 1
    del counts, again
    good, _, _ = marginals(potentials, model.steps, count, pairs=False)
    first = np.cumsum(count) - count
    return np.clip(np.add.reduceat(good * weight, first) / np.add.reduceat(weight, first), 0, 1)


def held_out(col: str = "doc_id") -> Column:
    return F.pmod(common.id_crc(col), F.lit(FOLDS)) == 0


def fit_labels(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCS) -> Model:
    """A model from the bounded sample of labelled rows outside the held-out fold.

    A doc_id with several labels has the larger one.  The features of the sample, not its
    texts, come to the driver.
    """
    known = labels.where("quality is not null and doc_id is not null").where(~held_out()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    known = known.select(F.col("doc_id").alias("id"), (F.col("quality") == 1).cast("int").alias("label"), F.xxhash64("doc_id").alias("h")).orderBy("h", "id").limit(limit)
    small = docs.select("doc_id", "text").where(F.coalesce(F.octet_length("text"), F.lit(0)) <= TRAIN_BYTES)
    # At most ``limit`` rows of three numbers are broadcast.
    sample = small.join(F.broadcast(known), F.col("doc_id") == F.col("id")).select("text", "label", "h", F.xxhash64("text").alias("t"), F.regexp_count("text", F.lit("\n")).alias("breaks"))
    # One window over at most ``limit`` rows: as many of them as the lines allow.
    lines = F.sum(F.coalesce("breaks", F.lit(0)) + 1).over(Window.orderBy("h", "t").rowsBetween(Window.unboundedPreceding, 0))
    sample = sample.orderBy("h", "t").limit(limit).withColumn("lines", lines).where(F.col("lines") <= TRAIN_LINES).select("text", "label", "h").repartition(16)

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x, count, _ = line_features(list(batch["text"]))
                yield pd.DataFrame({"h": batch["h"], "label": batch["label"], "count": count, "x": [a.astype("<f4").tobytes() for a in np.split(x, np.cumsum(count)[:-1])]})

    rows = sorted((tuple(r) for r in sample.mapInPandas(of, "h long, label int, count long, x binary").collect()), key=lambda r: (r[0], r[3]))
    if not rows:
        return Model(np.zeros(WIDTH), np.zeros((2, 2)))
    x = np.concatenate([np.frombuffer(r[3], dtype="<f4").reshape(-1, WIDTH) for r in rows]).astype(np.float64)
    return fit(x, np.array([r[2] for r in rows]), np.array([r[1] for r in rows]))


def _batches(texts: pd.Series, most: int = 4 << 20) -> Iterator[list]:
    """Consecutive texts of about ``most`` characters together."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text or "")
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def scores(text: Column, model: Model) -> Column:
    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.concatenate([score_texts(part, model) for part in _batches(texts)] or [np.zeros(0)]))

    return of(text)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score at least ``threshold``; columns as they are."""
    return docs.where(scores(F.col("text"), fit_labels(docs, labels)) >= threshold)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    docs = common.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_labels(docs, common.read_table(spark, sf_dir, "labels").select("doc_id", "quality"))
    scored = docs.select("doc_id", held_out().alias("held_out"), scores(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))
