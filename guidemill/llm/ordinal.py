"""Cumulative-link ordinal regression on hashed text features, shared by the quality and the toxicity operator.

P(grade >= k) = 1 / (1 + exp(theta_k - w.x)): one weight vector for all grades, thresholds in order. Features of a whole text are hashed into
2**BITS cells, so the model has a fixed size. The model is fitted on the driver on a bounded sample of labelled rows, drawn evenly over the grades
by a hash of the id and weighted back to the grades' true shares; every row is then scored where it lies.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guidemill.llm.common import combined, utf8_slices, word_hashes

BITS = 18
GRADES_MOST = 32
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_LETTER = _UPPER.copy()
_LETTER[0x61:0x7B] = True
_LETTER[0x80:] = True
_PLAIN = np.where(_LETTER, np.arange(256), 0x20).astype(np.uint8)
_PLAIN[0x41:0x5B] += 0x20
_SIGN = ~_LETTER
_SIGN[[0x20, *range(0x09, 0x0E), *range(0x30, 0x3A)]] = False


def features(column, words_only: bool):
    """For slices of an Arrow string column: (rows, first position of each row and one more, cells, values), cells in order by row.

    words_only: a 1 for each word of a text and for each of its stems, the first 4, 5 and 6 bytes. Else square roots of the shares of words, of word ends and of repeats, and ten steps
    each of the shares of capitals, signs, repeated and distinct words, of word length and of the number of words."""
    for _, data, offsets in utf8_slices(column):
        rows = len(offsets) - 1
        if words_only:
            data = _letters(data)
        hashes, first, starts = word_hashes(data, offsets)
        count = np.diff(first)
        owner = np.repeat(np.arange(rows), count)
        cell = (hashes >> np.uint64(64 - BITS)).astype(np.int64)
        joined = owner[1:] == owner[:-1] if len(owner) else np.zeros(0, bool)
        key = [owner << BITS | cell]
        if words_only:
            for cells, of in _stems(data, offsets, starts):
                key.append(owner[of] << BITS | cells)
            keys = np.unique(np.concatenate(key))
            values = np.ones(len(keys), np.float32)
        else:
            ends = _word_ends(data, offsets, starts)
            key.append(owner << BITS | ends)
            keys, n = np.unique(np.concatenate(key), return_counts=True)
            values = np.sqrt(n / np.maximum(1, count[keys >> BITS])).astype(np.float32)
            extra, at = _shares(data, offsets, hashes, first, owner, joined)
            keys, order = np.unique(np.concatenate([keys, at << BITS | extra]), return_index=True)
            values = np.concatenate([values, np.ones(len(extra), np.float32)])[order]
        yield rows, np.searchsorted(keys, np.arange(rows + 1) << BITS), keys & ((1 << BITS) - 1), values


def _stems(data, offsets, starts):
    """(cells of the first k bytes, their words) for the words that are longer."""
    if not len(starts):
        return
    stop = np.append(np.flatnonzero(data == 0x20), len(data))
    size = np.minimum(stop[np.searchsorted(stop, starts, "right")], offsets[np.searchsorted(offsets, starts, "right")]) - starts
    mixed = np.zeros(len(starts), np.uint64)
    for k in range(6):
        mixed = combined(mixed * np.uint64(257) + data[np.minimum(starts + k, len(data) - 1)], 1) if k else combined(data[starts].astype(np.uint64), 1)
        if k >= 3:
            of = np.flatnonzero(size > k + 1)
            yield (combined(mixed[of], 1) >> np.uint64(64 - BITS)).astype(np.int64), of


def _letters(data):
    """Only letters part words: other ASCII becomes a space; A-Z and the capitals of Latin-1 become small."""
    out = _PLAIN[data]
    if len(out) > 1:
        after = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
        out[after] += 0x20
    return out


def _word_ends(data, offsets, starts):
    """A cell for the last three bytes of each word, letters as one class each."""
    if not len(starts):
        return np.zeros(0, np.int64)
    kind = np.where(_UPPER[data], 1, np.where(_LETTER[data], 2, data.astype(np.int64) + 3))
    space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    last = np.flatnonzero(~space & np.append(space[1:], True) | np.isin(np.arange(len(data)), offsets[1:] - 1) & ~space)
    back = [np.where(last - k >= starts, kind[np.maximum(last - k, 0)], 0) for k in range(3)]
    mixed = combined(((back[0] * 300 + back[1]) * 300 + back[2]).astype(np.uint64), 1)
    return (mixed >> np.uint64(64 - BITS)).astype(np.int64)


def _shares(data, offsets, hashes, first, owner, joined):
    rows = len(offsets) - 1
    count, size = np.maximum(1, np.diff(first)), np.maximum(1, np.diff(offsets))
    total = lambda mask: np.diff(np.append(0, np.cumsum(mask))[offsets])
    same = np.bincount(owner[1:][joined & (hashes[1:] == hashes[:-1])], minlength=rows) if len(owner) else np.zeros(rows)
    order = np.lexsort((hashes, owner))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    distinct = np.bincount(owner[order][fresh], minlength=rows)
    steps = [
        np.minimum(9, 10 * total(_UPPER[data]) / size),
        np.minimum(9, 40 * total(_SIGN[data]) / size),
        np.minimum(9, 20 * same / count),
        np.minimum(9, 10 * distinct / count),
        np.minimum(9, size / count - 1),
        np.minimum(9, np.log2(count)),
    ]
    cells = [combined(np.array([10 * k + v for v in range(10)], np.uint64) + np.uint64(1 << 40), 1) for k in range(len(steps))]
    out = np.concatenate([(cells[k] >> np.uint64(64 - BITS)).astype(np.int64)[np.maximum(0, x).astype(int)] for k, x in enumerate(steps)])
    return out, np.tile(np.arange(rows), len(steps))


@dataclass
class Model:
    """grades in order; thresholds[k] parts grades[k] from grades[k + 1]."""

    grades: list[int]
    thresholds: np.ndarray
    weights: np.ndarray
    words_only: bool

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= grades[k + 1]) for each threshold."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -60, 60)))


BLOCK = 250_000  # features that the fit looks at together


class Features:
    """The features of rows in one piece: cells and values of row k from first[k] to first[k + 1]. Without values all are 1."""

    def __init__(self, cells: np.ndarray, first: np.ndarray, values: np.ndarray | None):
        self.cells, self.first, self.values = cells, first, values

    @classmethod
    def of(cls, cells: list[np.ndarray], values: list[np.ndarray] | None) -> Features:
        first = np.concatenate([[0], np.cumsum([len(c) for c in cells])]).astype(np.int64)
        return cls(np.concatenate([np.zeros(0, np.int32), *cells]).astype(np.int32, copy=False), first, None if values is None else np.concatenate([np.zeros(0, np.float32), *values]).astype(np.float32, copy=False))

    def blocks(self):
        """(first row, last row + 1, owner of each feature from the first row on, cells, values) for runs of rows of about BLOCK features or one row."""
        at, rows = 0, len(self.first) - 1
        while at < rows:
            to = min(rows, max(at + 1, int(np.searchsorted(self.first, self.first[at] + BLOCK, "right")) - 1))
            a, b = self.first[at], self.first[to]
            owner = np.repeat(np.arange(to - at), np.diff(self.first[at : to + 1]))
            yield at, to, owner, self.cells[a:b], 1.0 if self.values is None else self.values[a:b]
            at = to

    def kept(self, known: np.ndarray) -> Features:
        """Only the cells of `known`, by their places in it."""
        place = np.full(1 << BITS, -1, np.int32)
        place[known] = np.arange(len(known), dtype=np.int32)
        cells = place[self.cells]
        keep = cells >= 0
        first = np.concatenate([[0], np.cumsum(keep)])[self.first]
        return Features(cells[keep], first, None if self.values is None else self.values[keep])


def loss_and_gradient(x: Features, grade: np.ndarray, weight: np.ndarray, w: np.ndarray, cuts: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """The weighted negative log likelihood of the grades (positions), and its gradient by the weights and by the thresholds."""
    k = len(cuts) + 1
    above, below = np.append(-np.inf, cuts), np.append(cuts, np.inf)
    loss, g, gc = 0.0, np.zeros(len(w)), np.zeros(k - 1)
    for a, b, owner, cells, values in x.blocks():
        score = np.bincount(owner, values * w[cells], minlength=b - a)
        y, u = grade[a:b], weight[a:b]
        hi, lo = _sigmoid(below[y] - score), _sigmoid(above[y] - score)  # P(grade <= y), P(grade < y)
        p = np.maximum(hi - lo, 1e-12)
        loss -= float((u * np.log(p)).sum())
        dhi, dlo = hi * (1 - hi), lo * (1 - lo)
        back = u * (dhi - dlo) / p  # d(-log p) / d score
        g += np.bincount(cells, values * back[owner], minlength=len(w))
        gc += np.bincount(y, -u * dhi / p, minlength=k)[: k - 1] + np.bincount(y, u * dlo / p, minlength=k)[1:]
    return loss, g, gc


def fit(x: Features, grade: np.ndarray, weight: np.ndarray, grades: list[int], words_only: bool, l1: float, l2: float, rounds: int, least_docs: int) -> Model:
    """Proximal Adam steps on the weighted likelihood, L1 and L2 on the weights. grade: positions in `grades`."""
    docs = np.zeros(1 << BITS, np.int64)
    for *_, cells, _ in x.blocks():
        docs += np.bincount(cells, minlength=1 << BITS)
    known = np.flatnonzero(docs >= least_docs)
    x = x.kept(known)
    k = len(grades)
    weight = weight / weight.sum()
    share = np.array([weight[grade >= j].sum() for j in range(1, k)])
    cuts = np.log((1 - share) / share)
    w, rate = np.zeros(len(known)), 0.05
    m, v, mc, vc = np.zeros_like(w), np.zeros_like(w), np.zeros(k - 1), np.zeros(k - 1)
    for step in range(1, rounds + 1):
        _, g, gc = loss_and_gradient(x, grade, weight, w, cuts)
        g += l2 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mc, vc = 0.9 * mc + 0.1 * gc, 0.999 * vc + 0.001 * gc * gc
        scale = rate / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)
        w -= scale * m / (1 - 0.9**step)
        w = np.sign(w) * np.maximum(np.abs(w) - l1 * scale, 0)
        cuts = np.maximum.accumulate(cuts - rate * mc / (1 - 0.9**step) / (np.sqrt(vc / (1 - 0.999**step)) + 1e-7))
    out = np.zeros(1 << BITS, np.float32)
    out[known] = w
    return Model(grades, cuts, out, words_only)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _extract(words_only: bool):
    def run(batches):
        for batch in batches:
            at = 0
            for rows, first, cell, value in features(batch.column(2), words_only):
                cells = [cell[first[k] : first[k + 1]].astype("<i4").tobytes() for k in range(rows)]
                values = [None] * rows if words_only else [value[first[k] : first[k + 1]].astype("<f4").tobytes() for k in range(rows)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, rows), batch.column(1).slice(at, rows), pa.array(cells, pa.binary()), pa.array(values, pa.binary())], ["id", "grade", "cells", "sizes"])
                at += rows

    return run


def train(docs: DataFrame, ratings: DataFrame, grade_col: str, sample: int, words_only: bool, l1: float, l2: float, rounds: int = 150, least_docs: int = 3, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model from ratings (id, integer grade) of docs, on at most `sample` rated rows, the same on every run.

    Only the sample's features come to the driver, a few MB: cell numbers, and shares where they aren't all 1. Null grades and ids don't count; an id rated more than once has its lowest grade. With fewer than two grades the model gives the one grade (0 if
    there is none) to all rows. More than GRADES_MOST different grades are an error."""
    rated = ratings.select(F.col(id_col).cast("long").alias("id"), F.col(grade_col).cast("int").alias("grade")).dropna().groupBy("id").agg(F.min("grade").alias("grade"))
    counts = sorted(tuple(x) for x in rated.groupBy("grade").count().limit(GRADES_MOST + 1).collect())
    if len(counts) > GRADES_MOST:
        raise ValueError(f"{grade_col} has more than {GRADES_MOST} grades")
    grades = [g for g, _ in counts]
    if len(grades) > 1:
        each = sample // len(grades)
        picked = None
        for g in grades:  # bounded: `each` ids
            some = rated.where(F.col("grade") == g).orderBy(F.xxhash64("id"), "id").limit(each)
            picked = some if picked is None else picked.union(some)
        texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
        one = texts.join(F.broadcast(picked), "id").groupBy("id", "grade").agg(F.min("text").alias("text"))  # a rated id that documents repeat counts once, with the smallest text
        found = one.select("id", "grade", "text").mapInArrow(_extract(words_only), "id long, grade int, cells binary, sizes binary").toArrow().combine_chunks()
        found = found.take(pc.sort_indices(found.column("id")))
        grades = sorted(set(found.column("grade").to_pylist()))
    if len(grades) < 2:
        return Model(grades or [0], np.zeros(0), np.zeros(1 << BITS, np.float32), words_only)
    grade = np.searchsorted(grades, found.column("grade").to_numpy())
    weight = np.array([dict(counts)[g] for g in grades])[grade] / np.bincount(grade)[grade]
    cells = [np.frombuffer(x.as_buffer(), "<i4") for x in found.column("cells")]
    values = None if words_only else [np.frombuffer(x.as_buffer(), "<f4") for x in found.column("sizes")]
    x = Features.of(cells, values)
    del found, cells, values
    return fit(x, grade, weight, grades, words_only, l1, l2, rounds, least_docs)


def score(docs: DataFrame, model: Model, at_least: int, id_col: str = "doc_id", text_col: str = "text", names: tuple[str, str] = ("expected_grade", "tail_probability")) -> DataFrame:
    """The rows of docs with the expected grade and P(grade >= at_least) of the whole text. Null text counts as empty."""

    def run(batches):
        for batch in batches:
            scores = [np.zeros(0)]
            for rows, first, cell, value in features(batch.column(batch.num_columns - 1), model.words_only):
                total = np.append(0, np.cumsum(model.weights[cell].astype(np.float64) * value))
                scores.append(total[first[1:]] - total[first[:-1]])
            scores = np.concatenate(scores)
            tails = model.tails(scores)
            expected = model.grades[0] + tails @ np.diff(model.grades) if len(model.grades) > 1 else np.full(len(scores), float(model.grades[0]))
            k = int(np.searchsorted(model.grades, at_least))  # the first grade that counts
            tail = np.ones(len(scores)) if k == 0 else np.zeros(len(scores)) if k == len(model.grades) else tails[:, k - 1]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(expected), pa.array(tail)], [*batch.schema.names[:-1], *names])

    kept = [c for c in docs.columns if c not in names]
    whole = "text"
    while whole in docs.columns:
        whole = f"_{whole}"
    schema = docs.select(*kept).schema.add(names[0], "double").add(names[1], "double")
    return docs.select(*kept, F.col(text_col).cast("string").alias(whole)).mapInArrow(run, schema)
