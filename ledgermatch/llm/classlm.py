"""Language-model scores from class-based n-grams (Brown et al., 1992).

Tokens are the words of a text with A-Z in lower case and one end mark.  The probability of
word w after the token v is

    P(w | v) = (c(w) + 1) * (MIX * T(h(v), k(w)) / (N_k + V_k + 1)
                             + (1 - MIX) / (N + V + CLASSES))

with c the count of w in the training texts, k(w) the class of w, h(v) the class that v has as
history, T the add-one class-transition probability, N_k and V_k the tokens and distinct words
of the class, N and V those of the corpus.  Each class has one slot for all unknown words, so
the probabilities after any history sum to 1 or less.  The base score is
(c(w) + 1) / (N + V + 1) for each token.

Classes come from exchange clustering, in rounds of Spark jobs over the table of all bigrams
of elements.  Elements are the end mark, the ``HEAD`` most frequent words, and ``BUCKETS``
groups of the other words by their last three bytes.  In each round the counts of an element's
neighbours are summed by class, the elements are dealt to ``BLOCKS`` blocks, and in each block
the elements, most frequent first, move to the class that makes the bigrams likeliest, given the
classes that the other blocks had before the round.  Elements that move at once can spoil each
other's gain and move back in turn, so after ``WHOLE`` rounds each round moves every second
element only, the other half in the next one.  Rounds end when two in a row, a turn of all
elements, gain less than ``GAIN`` of the likelihood's value together; the best round counts.
There is no other limit: each two rounds before the end gain that share, and the likelihood is bounded.

A word beyond the head has a class of its own too: of its training bigrams (class of the word
before, word), the one that makes them likeliest.  As history such a word stands in its
suffix group's class, which is known without a lookup; so is the class of an unknown word.
Every word of the training texts is thus assigned by its own bigrams, and bigrams, words and
classes of words are tables that grow with the corpus.  What the workers hold has a fixed
bound: the head and its classes.

Counts of words are exact and cover all training texts.  Words beyond the head meet their
counts and classes in a shuffle join on the word.  They are rare by construction, so no join
key is hot.

Null texts count as empty: one end mark.  A document without training texts anywhere scores
against empty counts.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

HEAD, BUCKETS, CLASSES, BLOCKS, WHOLE, TRIED, GAIN, MIX = 50_000, 256, 64, 16, 3, 4, 1e-3, 0.95
FOLDS, HELD_OUT = 7, 2
FLUSH = 300_000
#: Bigrams travel as arrays: parts that they are dealt to, and how many a worker holds before it sums them.
PARTS, HELD = 128, 4_000_000


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def held_out(col: str = "doc_id") -> Column:
    return F.pmod(common.id_crc(col), F.lit(FOLDS)) == HELD_OUT


def word_counts(texts: DataFrame) -> DataFrame:
    """(word binary, n) over all rows of ``texts``; counted in the workers before the shuffle."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen.keys()), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for text in batch.column(0):
                seen.update(split_words(text.as_py()))
                if len(seen) >= FLUSH:
                    yield out()
                    seen.clear()
        yield out()

    return texts.select("text").mapInArrow(of, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def head_of(words: DataFrame, limit: int = HEAD) -> list[tuple[bytes, int]]:
    """The most frequent words, exactly ``limit`` if there are as many, most frequent first, ties by the word's bytes.

    A histogram of the counts (a thousand rows at most) gives the bins that fit whole; of the next bin come as many as are missing.
    """
    step = F.floor(F.log2("n") * 16).cast("int")
    bins = sorted(((r[0], r[1]) for r in words.groupBy(step.alias("b")).count().collect()), reverse=True)
    total, least, cut = 0, None, None
    for b, k in bins:
        if total + k > limit:
            cut = b
            break
        total, least = total + k, b
    rows = words.where(step >= least).collect() if least is not None else []
    if cut is not None and total < limit:
        rows += words.where(step == cut).orderBy(F.desc("n"), "word").limit(limit - total).collect()
    return sorted(((bytes(r["word"]), r["n"]) for r in rows), key=lambda r: (-r[1], r[0]))


def bucket(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % BUCKETS


class Elements:
    """Element numbers: 0 the end mark, then the words of ``head``, then the suffix groups of all others."""

    def __init__(self, head: list[bytes]) -> None:
        self.first = len(head) + 1
        self.size = self.first + BUCKETS
        self.place = {w: i for i, w in enumerate(head)}

    def look(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """(place in the head or -1, element) of each word, and the rare words."""
        get = self.place.get
        at = np.fromiter(map(get, words, repeat(-1)), dtype=np.int64, count=len(words))
        out, missing = at + 1, np.flatnonzero(at < 0)
        rare = [words[i] for i in missing.tolist()]
        out[missing] = self.first + np.fromiter(map(zlib.crc32, [w[-3:] for w in rare]), dtype=np.int64, count=len(rare)) % BUCKETS
        return at, out, rare

    def of(self, words: list[bytes]) -> np.ndarray:
        return self.look(words)[1]


PAIRS = "part int, before binary, after binary, n binary"


def _pairs_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(before, after, n) of packed bigrams."""
    return tuple(np.frombuffer(b"".join(batch[c].to_pylist()), dtype=kind).astype(np.int64) for c, kind in (("before", "<i4"), ("after", "<i4"), ("n", "<i8")))


def _summed(pair: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(pair, kind="stable")
    pair, n = pair[order], n[order]
    first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])) if len(pair) else np.zeros(0, dtype=np.int64)
    return pair[first], np.add.reduceat(n, first) if len(first) else n


def _packed(before: np.ndarray, after: np.ndarray, n: np.ndarray, part: np.ndarray) -> pa.RecordBatch:
    """PAIRS with one row per part."""
    order = np.argsort(part, kind="stable")
    parts, first = np.unique(part[order], return_index=True)
    cuts = np.append(first, len(part))
    cols = [v[order].astype(kind) for v, kind in ((before, "<i4"), (after, "<i4"), (n, "<i8"))]
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), *(pa.array([v[i:j].tobytes() for i, j in zip(cuts, cuts[1:])], pa.binary()) for v in cols)], names=["part", "before", "after", "n"])


def bigrams(texts: DataFrame, elements: Elements) -> DataFrame:
    """PAIRS: the bigrams of elements over all rows, each once, counted in the workers before the shuffle.

    They are dealt by the first element and summed there as they arrive, in bounded memory: a part
    has less than size * (size / ``PARTS`` + 1) different ones whatever the corpus.  The rows
    that come out are cut by the part of the second element, ready to be dealt by that.
    """
    size = elements.size

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, n = [], 0
        ends = np.zeros(1, dtype=np.int64)

        def out() -> pa.RecordBatch:
            pair, times = np.unique(np.concatenate(kept), return_counts=True)
            before = pair // size
            return _packed(before, pair % size, times, before % PARTS)

        for batch in batches:
            for text in batch.column(0):
                ids = np.concatenate([ends, elements.of(split_words(text.as_py())), ends])
                kept.append(ids[:-1] * size + ids[1:])
                n += len(ids)
                if n > 6_000_000:
                    yield out()
                    kept, n = [], 0
        if kept:
            yield out()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        total = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))
        for batch in batches:
            for i in range(batch.num_rows):
                before, after, n = _pairs_of(batch.slice(i, 1))
                held.append((before * size + after, n))
                rows += len(n)
                if rows > HELD:
                    total = _summed(*(np.concatenate(x) for x in zip(total, *held)))
                    held, rows = [], 0
        pair, n = _summed(*(np.concatenate(x) for x in zip(total, *held)))
        for i in range(0, len(pair), HELD):
            p = pair[i : i + HELD]
            yield _packed(p // size, p % size, n[i : i + HELD], p % size % PARTS)

    return texts.select("text").mapInArrow(of, PAIRS).repartition("part").mapInArrow(add, PAIRS)


def transitions(pairs: DataFrame, label: np.ndarray, classes: int, first: int | None = None) -> np.ndarray:
    """Counts [class before, class after] of all bigrams; what comes to the driver is the table of classes.

    With ``first`` the second elements from that number on count in further columns, class by class.
    """
    wide = 2 * classes
    column = label + classes * (np.arange(len(label)) >= (len(label) if first is None else first))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(classes * wide)
        for b in batches:
            before, after, n = _pairs_of(b)
            total += np.bincount(label[before] * wide + column[after], weights=n, minlength=classes * wide)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at].astype(np.int64))], names=["at", "n"])

    out = np.zeros(classes * wide)
    for r in pairs.mapInArrow(of, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[r["at"]] = r["n"]
    out = out.reshape(classes, wide)
    return out[:, :classes] if first is None else out


NEIGHBOURS = "block int, element int, side int, classes binary, counts binary"


def neighbours(pairs: DataFrame, by_after: DataFrame, label: np.ndarray, classes: int, blocks: int) -> DataFrame:
    """NEIGHBOURS: counts of each element's neighbours by class; side 0 after it, 1 before it, 2 itself.

    ``by_after`` has the rows of ``pairs`` dealt by the second element, so that on both sides an
    element's counts are summed in about one task.  Parts of an element add up.
    """
    size = len(label)

    def of(batches: Iterator[pa.RecordBatch], own: str) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def out(side: int, x: np.ndarray, k: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            sums = np.bincount(x.astype(np.int64) * classes + k, weights=n, minlength=0)
            at = np.flatnonzero(sums)
            element, first = np.unique(at // classes, return_index=True)
            cuts = np.append(first, len(at))
            k, n = (at % classes).astype("<u2"), sums[at].astype("<i8")
            parts = [pa.array([v[i:j].tobytes() for i, j in zip(cuts, cuts[1:])], pa.binary()) for v in (k, n)]
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int32()) for c in (element % blocks, element, np.full(len(element), side))), *parts], names=["block", "element", "side", "classes", "counts"])

        def flush() -> Iterator[pa.RecordBatch]:
            before, after, n = (np.concatenate(x) for x in zip(*held))
            x, y = (before, after) if own == "before" else (after, before)
            yield out(int(own == "after"), x, label[y], n)
            if own == "before":
                same = x == y
                yield out(2, x[same], np.zeros(same.sum(), dtype=np.int64), n[same])

        for b in batches:
            for i in range(b.num_rows):
                held.append(_pairs_of(b.slice(i, 1)))
                rows += len(held[-1][0])
                if rows > HELD:
                    yield from flush()
                    held, rows = [], 0
        if held:
            yield from flush()

    return pairs.mapInArrow(partial(of, own="before"), NEIGHBOURS).union(by_after.mapInArrow(partial(of, own="after"), NEIGHBOURS))


def _unpacked(classes, counts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, class, count) of packed rows."""
    n = np.array([len(c) // 8 for c in counts], dtype=np.int64)
    return np.repeat(np.arange(len(n)), n), np.frombuffer(b"".join(classes), dtype="<u2").astype(np.int64), np.frombuffer(b"".join(counts), dtype="<i8").astype(np.float64)


def class_table(near: DataFrame, label: np.ndarray, classes: int) -> np.ndarray:
    """Counts [class before, class after] of all bigrams from the neighbours of elements."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(classes * classes)
        for b in batches:
            row, k, n = _unpacked(b["classes"].to_pylist(), b["counts"].to_pylist())
            total += np.bincount(label[b["element"].to_numpy()][row] * classes + k, weights=n, minlength=classes * classes)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at].astype(np.int64))], names=["at", "n"])

    out = np.zeros(classes * classes)
    own = near.where("side = 0").select("element", "classes", "counts")
    for r in own.mapInArrow(of, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[r["at"]] = r["n"]
    return out.reshape(classes, classes)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(x + 1e-300)


def likelihood(table: np.ndarray) -> float:
    """Log likelihood of the bigrams under their classes, but for a part that no class changes."""
    return float(_xlogx(table).sum() - _xlogx(table.sum(0)).sum() - _xlogx(table.sum(1)).sum())


def move(label: np.ndarray, table: np.ndarray, elements: np.ndarray, after: np.ndarray, before: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The classes of some elements after each of them, most frequent first, has moved to its best one.

    ``after`` and ``before`` are the counts of each element's neighbours by class, ``own`` those
    of the element beside itself, ``table`` the class bigrams.  The likelihood is compared exactly for
    the own class and the ``TRIED`` classes to which its slope points.  Element 0 stays in class 0, alone.

    A sixteenth as many elements as have moved before, 64 at most, are compared at once with the table as it is.
    """
    out, t = label[elements].copy(), table.copy()
    right, left, each = after.copy(), before.copy(), np.arange(len(elements))
    right[each, out] -= own
    left[each, out] -= own
    order = np.argsort(-(after.sum(1) + before.sum(1)), kind="stable")
    order, at = order[elements[order] != 0], 0
    tried = min(TRIED, len(t) - 1)
    while at < len(order):
        some = order[at : at + min(max(1, at // 16), 64)]
        at += len(some)
        i, c, r, l, self_pair = np.arange(len(some)), out[some], right[some], left[some], own[some]
        r_all, l_all, row, col, logs = r.sum(1)[:, None], l.sum(1)[:, None], t.sum(1), t.sum(0), np.log(t + 1)
        from_own, to_own = t[c], t[:, c].T
        slope = r @ logs.T + l @ logs - r_all * np.log(row + 1) - l_all * np.log(col + 1)
        # The element's own pairs with members of its class are not there to follow.
        slope += r[i, c][:, None] * (np.log(np.maximum(to_own - l, 0) + 1) - np.log(to_own + 1))
        slope += l[i, c][:, None] * (np.log(np.maximum(from_own - r, 0) + 1) - np.log(from_own + 1))
        slope[:, 0] = slope[i, c] = -np.inf
        choice = np.concatenate([np.argpartition(-slope, tried - 1, axis=1)[:, :tried], c[:, None]], axis=1)
        r_choice, l_choice = np.take_along_axis(r, choice, 1), np.take_along_axis(l, choice, 1)
        # Rows and columns of the chosen classes without the element; the last choice is its own class.
        x, y, at_choice = t[choice], t.T[choice], np.arange(tried + 1)
        x[i[:, None], at_choice, c[:, None]] -= l_choice
        y[i[:, None], at_choice, c[:, None]] -= r_choice
        x[:, -1], y[:, -1] = from_own - r, to_own - l
        x[i, -1, c] = y[i, -1, c] = t[c, c] - r[i, c] - l[i, c] - self_pair
        # Other elements may have moved since the counts were taken.
        np.maximum(x, 0, out=x)
        np.maximum(y, 0, out=y)
        gain = (_xlogx(x + r[:, None]) - _xlogx(x)).sum(2) + (_xlogx(y + l[:, None]) - _xlogx(y)).sum(2)
        both = x[i[:, None], at_choice, choice]
        gain += _xlogx(both + r_choice + l_choice + self_pair[:, None]) + _xlogx(both) - _xlogx(both + r_choice) - _xlogx(both + l_choice)
        # The pairs of the element with others stay in those others' sums wherever it goes.
        for sums, more in ((row[choice], r_all[:, 0] + self_pair), (col[choice], l_all[:, 0] + self_pair)):
            sums[:, -1] = np.maximum(sums[:, -1] - more, 0)
            gain -= _xlogx(sums + more[:, None]) - _xlogx(sums)
        gain[choice == 0] = -np.inf
        best = np.argmax(gain, axis=1)
        for j in np.flatnonzero(gain[i, best] > gain[:, -1] + 1e-9):
            out[some[j]] = k = choice[j, best[j]]
            for one, sign in ((c[j], -1), (k, 1)):
                t[one] += sign * r[j]
                t[:, one] += sign * l[j]
                t[one, one] += sign * self_pair[j]
        np.maximum(t, 0, out=t)
    return out


def moves(label: np.ndarray, table: np.ndarray):
    """A function from the neighbour counts of a partition's blocks to their elements' new classes."""
    classes = len(table)

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches) or [pd.DataFrame({"block": [], "element": [], "side": [], "classes": [], "counts": []})])
        for _, group in rows.groupby("block"):
            yield moved(group)

    def moved(group: pd.DataFrame) -> pd.DataFrame:
        elements, at = np.unique(group["element"].to_numpy(), return_inverse=True)
        row, k, n = _unpacked(group["classes"], group["counts"])
        side = group["side"].to_numpy()[row]
        sums = [np.bincount(at[row[side == j]] * classes + k[side == j], weights=n[side == j], minlength=len(elements) * classes).reshape(-1, classes) for j in (0, 1, 2)]
        return pd.DataFrame({"element": elements.astype(np.int32), "class": move(label, table, elements, sums[0], sums[1], sums[2][:, 0]).astype(np.int32)})

    return of


def exchange(pairs: DataFrame, size: int, classes: int = CLASSES, blocks: int = BLOCKS, gain: float = GAIN) -> np.ndarray:
    """Class of each element, from PAIRS.  Elements start by rank in turn; the end mark keeps class 0 for itself."""
    label = np.zeros(size, dtype=np.int64)
    label[1:] = 1 + np.arange(size - 1) % (classes - 1)
    by_after = common.store(pairs.repartition("part"), "by-after")
    best, best_label, reached = -np.inf, label, []
    while True:
        near = common.store(neighbours(pairs, by_after, label, classes, blocks), "neighbours")
        table = class_table(near, label, classes)
        now = likelihood(table)
        if now > best:
            best, best_label = now, label
        reached.append(best)
        done = not table.any() or (len(reached) > WHOLE and best - reached[-3] <= gain * abs(best))
        if not done:
            turn = near if len(reached) <= WHOLE else near.where((F.floor(F.col("element") / blocks) + len(reached)) % 2 == 0)
            moved = turn.repartitionById(blocks, F.col("block")).mapInPandas(moves(label, table), "element int, class int").collect()  # HEAD + BUCKETS + 1 rows at most
            label = label.copy()
            label[[r["element"] for r in moved]] = [r["class"] for r in moved]
        common.discard(near)
        if done:
            break
    common.discard(by_after)
    return best_label


@dataclass
class Model:
    elements: Elements
    label: np.ndarray  # class of each element
    terms: np.ndarray  # log10 of the factor of c(w) + 1, [history class, class]
    head: np.ndarray  # log10(c + 1) of the head words
    end: float
    tokens: int
    distinct: int


def tail_classes(train: DataFrame, elements: Elements, label: np.ndarray, table: np.ndarray) -> DataFrame:
    """Words beyond the head (word, class, n), and rows without word that sum their bigrams: (class, history, n)."""
    classes = len(table)
    log_step = np.log((table + 1) / (table.sum(1, keepdims=True) + classes))
    log_step[:, 0] = -np.inf  # the end mark's
    log_size = np.log(table.sum(0) + 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        ends = np.zeros(1, dtype=np.int64)

        def out() -> pa.RecordBatch:
            keys = list(seen)
            return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.binary()), pa.array([k[1] for k in keys], pa.int32()), pa.array(list(seen.values()), pa.int64())], names=["word", "history", "n"])

        for batch in batches:
            for text in batch.column(0):
                at, ids, rare = elements.look(split_words(text.as_py()))
                if rare:
                    history = label[np.concatenate([ends, ids[:-1]])][at < 0]
                    seen.update(zip(rare, history.tolist(), strict=True))
                if len(seen) >= FLUSH:
                    yield out()
                    seen.clear()
        yield out()

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(classes * classes, dtype=np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            row = np.repeat(np.arange(b.num_rows), b["of"].value_lengths().to_numpy())
            flat = b["of"].flatten()
            history, n = flat.field("history").to_numpy(), flat.field("n").to_numpy()
            counts = np.zeros((b.num_rows, classes))
            np.add.at(counts, (row, history), n)
            best = np.argmax(counts @ np.maximum(log_step, -1e9) - counts.sum(1)[:, None] * log_size, axis=1)
            total += np.bincount(best[row] * classes + history, weights=n, minlength=classes * classes).astype(np.int64)
            yield pa.RecordBatch.from_arrays([b["word"], pa.array(best, pa.int32()), pa.nulls(b.num_rows, pa.int32()), pa.array(counts.sum(1).astype(np.int64))], names=["word", "class", "history", "n"])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(at), pa.binary()), pa.array(at // classes, pa.int32()), pa.array(at % classes, pa.int32()), pa.array(total[at])], names=["word", "class", "history", "n"])

    each = train.select("text").mapInArrow(count, "word binary, history int, n long")
    # A list has at most a row per task and history class, and no more than the word's count: less than any head word's.
    lists = each.repartition("word").groupBy("word").agg(F.collect_list(F.struct("history", "n")).alias("of"))
    return lists.mapInArrow(choose, "word binary, class int, history int, n long")


def fit(train: DataFrame) -> tuple[Model, DataFrame]:
    """(model, table (word, class, n) of the words beyond the head) of all rows of ``train``."""
    words = common.store(word_counts(train), "words")
    ends = train.count()
    sums = words.agg(F.count(F.lit(1)), F.sum("n")).first()
    tokens, distinct = (sums[1] or 0) + ends, sums[0] + (ends > 0)
    head = head_of(words)
    common.discard(words)
    elements = Elements([w for w, _ in head])
    pairs = common.store(bigrams(train, elements), "bigrams")
    label = exchange(pairs, elements.size)
    split = transitions(pairs, label, CLASSES, elements.first)
    common.discard(pairs)
    known, table = split[:, :CLASSES].copy(), split[:, :CLASSES] + split[:, CLASSES:]
    tail = common.store(tail_classes(train, elements, label, table), "tail")

    # Of bigrams whose second word is beyond the head, the word's own class counts instead of its group's.
    for r in tail.where("word is null").groupBy("class", "history").agg(F.sum("n").alias("n")).collect():
        known[r["history"], r["class"]] += r["n"]
    v_class = np.bincount(label[: elements.first], minlength=CLASSES).astype(np.float64)
    v_class[0] = ends > 0
    for r in tail.where("word is not null").groupBy("class").count().collect():
        v_class[r["class"]] += r["count"]
    steps = (known + 1) / (known.sum(1, keepdims=True) + CLASSES)
    terms = np.log10(MIX * steps / (known.sum(0) + v_class + 1) + (1 - MIX) / (tokens + distinct + CLASSES))
    model = Model(elements, label, terms, np.log10(np.array([n + 1.0 for _, n in head])), float(np.log10(ends + 1)), tokens, distinct)
    return model, tail.where("word is not null").select("word", "class", "n")


SCORED = "row long, doc_id long, held_out boolean, n_tokens long, known long, logs double, local double, word binary, history int, guess int, times long"


def partial_scores(docs: DataFrame, model: Model) -> DataFrame:
    """What a document's head words give (word null), and its other words with the class before, the class if unknown, and their number."""
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.int32(), pa.int32(), pa.int64()]
    schema = pa.schema([pa.field(c.split()[0], kind) for c, kind in zip(SCORED.split(", "), kinds, strict=True)])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = np.zeros(1, dtype=np.int64)
        end_known = int(model.tokens > 0)
        for batch in batches:
            cols: list[list] = [[] for _ in schema]

            def flush() -> pa.RecordBatch:
                out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)
                for c in cols:
                    c.clear()
                return out

            for row, doc, held, text in zip(*(batch.column(i) for i in range(4)), strict=True):
                words = split_words(text.as_py())
                at, ids, rare = model.elements.look(words)
                classes = model.label[np.concatenate([ends, ids, ends])]
                head = np.append(at >= 0, True)
                local = float(model.terms[classes[:-1], classes[1:]][head].sum())
                seen = at[at >= 0]
                logs = float(model.head[seen].sum()) + model.end
                row = row.as_py()
                for c, x in zip(cols, (row, doc.as_py(), held.as_py(), len(words) + 1, len(seen) + end_known, logs, local, None, None, None, None), strict=True):
                    c.append(x)
                if rare:
                    found = Counter(zip(rare, classes[:-1][~head].tolist(), classes[1:][~head].tolist(), strict=True))
                    k = len(found)
                    cols[0] += [row] * k
                    for c in cols[1:7]:
                        c += [None] * k
                    for c, x in zip(cols[7:10], zip(*found, strict=True), strict=True):
                        c += x
                    cols[10] += found.values()
                if len(cols[0]) > 200_000:
                    yield flush()
            yield flush()

    flat = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), held_out().alias("held_out"), "text")
    return flat.mapInArrow(of, SCORED)


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and perplexity of every row of ``docs``."""
    model, tail = fit(docs.where(~held_out()))
    parts = common.store(partial_scores(docs, model), "scored")
    spark = docs.sparkSession
    terms = spark.createDataFrame([(h, k, float(model.terms[h, k])) for h in range(CLASSES) for k in range(CLASSES)], "history int, class int, term double")
    rare = parts.where("word is not null").select("row", "word", "history", "guess", "times").join(tail, "word", "left")
    rare = rare.withColumn("class", F.coalesce("class", "guess")).join(F.broadcast(terms), ["history", "class"])  # CLASSES squared rows
    rare = rare.groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.log10(F.col("n") + 1.0) * F.col("times")).otherwise(0.0)).alias("rare_logs"), F.sum(F.col("term") * F.col("times")).alias("rare_local"), F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known")
    )
    whole = parts.where("word is null").join(rare, "row", "left")
    zero = F.lit(0.0)
    logs = F.col("logs") + F.coalesce("rare_logs", zero)
    base = logs - F.col("n_tokens") * F.lit(float(np.log10(model.tokens + model.distinct + 1)))
    full = logs + F.col("local") + F.coalesce("rare_local", zero)
    known = (F.col("known") + F.coalesce("rare_known", F.lit(0))).cast("long")
    out = whole.select("doc_id", "held_out", "n_tokens", known.alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"), base.alias("base_score"), full.alias("score"))
    return out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def op6_classlm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base score and class-model score of every document."""
    return score(common.read_table(spark, sf_dir, "documents").select("doc_id", "text"))
