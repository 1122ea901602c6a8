"""Ordinal cumulative-link regression on graded ratings.

Grades are ordered: 0 toxic, 1 low quality, 2 good. One weight vector over hashed text features is
shared by all grades; ordered thresholds turn the score into cumulative chances. From these come the
expected grade and the tail probability that decides. Training uses a bounded sample of rated
documents; scoring is one pass over all documents with the weights, whose size is fixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promoledger.llm.kernels import LOWER, RangeHash, U, mix, slices, tidy, word_ranges

BITS, SAMPLE_DOCS, MIN_DOCS, LEAST_Z, ROUNDS, GRADES, TAIL_GRADE, KEEP, SLICE = 18, 4000, 4, 4.0, 150, 3, 2, 0.5, 1 << 19
_SYMBOLS, _MARKS = np.zeros(256, bool), np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_MARKS[list(b"#*$%&|<>.,;:!?\"'()[]-")] = True
_STEPS = (0.02, 0.05, 0.1, 0.2, 0.4)


@dataclass(frozen=True)
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def chances(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k), k = 1, 2, ..., by row."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - score[:, None], -40, 40)))


def features(data: np.ndarray, off: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(row, hashed feature) pairs, each once per row.

    Features are lower-cased words without punctuation at their ends, words' last two bytes, and steps
    of three shares: words equal to the one before, symbols among the words' bytes, words of symbols alone.
    """
    low, n = LOWER[data], len(off) - 1
    starts, ends, row = word_ranges(low, off)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ranges = RangeHash(low)
    first, last = starts.copy(), ends.copy()
    for _ in range(3):
        last -= (last - 1 > first) & _MARKS[low[last - 1]]
        first += (first + 1 < last) & _MARKS[low[first]]
    shift = U(64 - bits)
    whole = ranges(first, last)
    words = whole >> shift
    tails = (ranges(np.maximum(starts, ends - 2), ends) * U(0x9E3779B97F4A7C15)) >> shift
    total = np.maximum(np.bincount(row, minlength=n), 1)
    again = np.concatenate([[False], (whole[1:] == whole[:-1]) & (row[1:] == row[:-1])])
    bare = (last - first == 1) & _MARKS[low[first]]
    size = np.maximum(np.bincount(row, ends - starts, n), 1)
    symbols = np.concatenate([[0], np.cumsum(_SYMBOLS[low])])
    shares = (np.bincount(row[again], minlength=n) / total, np.bincount(row, symbols[ends] - symbols[starts], n) / size, np.bincount(row[bare], minlength=n) / total)
    found = [(row.astype(U) << U(bits)) | h for h in (words, tails)]
    for k, share in enumerate(shares):
        for j, step in enumerate(_STEPS):
            mark = mix(np.array([1000 + 10 * k + j], U)) >> shift
            found.append((np.flatnonzero(share >= step).astype(U) << U(bits)) | mark)
    pairs = np.unique(np.concatenate(found))
    return (pairs >> U(bits)).astype(np.int64), (pairs & U((1 << bits) - 1)).astype(np.int64)


def telling(rows: np.ndarray, ids: np.ndarray, grades: np.ndarray, size: int, least: float, min_docs: int) -> np.ndarray:
    """Features whose documents' grades differ from all documents' by ``least`` standard errors."""
    held, keep = np.bincount(ids, minlength=size), np.zeros(size, bool)
    for cut in range(1, GRADES):
        above = grades >= cut
        p = above.mean() if len(grades) else 0.0
        z = (np.bincount(ids, above[rows], size) - held * p) / np.sqrt(np.maximum(held * p * (1 - p), 1e-9))
        keep |= (np.abs(z) >= least) & (held >= min_docs)
    return keep


def train_ordinal(
    rows: np.ndarray, ids: np.ndarray, grades: np.ndarray, bits: int = BITS, min_docs: int = MIN_DOCS, rounds: int = ROUNDS, shrink: float = 2e-4
) -> OrdinalModel:
    """Cumulative logit by Adam. Features that do not tell grades apart keep weight 0. Without ratings
    the best grade has a chance of just over one half."""
    size, k = 1 << bits, GRADES - 1
    seen = telling(rows, ids, grades, size, LEAST_Z, min_docs)
    rows, ids = rows[seen[ids]], ids[seen[ids]]
    cut = np.array([np.clip(np.mean(grades > g), 0.01, 0.99) for g in range(k)]) if len(grades) else np.full(k, 0.5 + 2e-3 * k)
    cut = np.minimum.accumulate(cut - 1e-3 * np.arange(k))
    base = -np.log(cut / (1 - cut))
    # Thresholds stay ordered: the first is free, each further one adds a positive step.
    free = np.concatenate([[base[0]], np.log(np.maximum(np.diff(base), 1e-3))])
    theta, m, v = (np.zeros(size + k) for _ in range(3))
    theta[size:] = free
    n = len(grades)
    for step in range(1, rounds + 1 if n else 1):
        w, t = theta[:size], theta[size:]
        steps = np.exp(t[1:])
        th = t[0] + np.concatenate([[0.0], np.cumsum(steps)])
        f = np.bincount(rows, w[ids], n)
        c = 1 / (1 + np.exp(np.clip(f[:, None] - th, -40, 40)))  # P(grade <= j)
        c = np.concatenate([np.zeros((n, 1)), c, np.ones((n, 1))], axis=1)
        at = np.arange(n)
        p = np.maximum(c[at, grades + 1] - c[at, grades], 1e-12)
        slope = c * (1 - c)
        df = (slope[at, grades] - slope[at, grades + 1]) / p  # gradient of log p by the score
        dth = np.zeros((n, k + 2))
        dth[at, grades + 1] += slope[at, grades + 1] / p
        dth[at, grades] -= slope[at, grades] / p
        dth = dth[:, 1:-1].mean(0)
        grad = np.concatenate([np.bincount(ids, df[rows], size) / n - shrink * w, [dth.sum()], steps * np.cumsum(dth[::-1])[::-1][1:]])
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta = theta + 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    t = theta[size:]
    w = np.where(seen, theta[:size], 0).astype(np.float32)
    return OrdinalModel(w, t[0] + np.concatenate([[0.0], np.cumsum(np.exp(t[1:]))]))


def graded(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, grade) from ratings: toxic 0, else low quality 1, else 2. Rows without an id or rating are
    not used; of several rows of an id the worst counts."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    rows = labels.select(F.col(id_col), grade.alias("grade")).filter(F.col(id_col).isNotNull() & F.col("grade").isNotNull())
    return rows.groupBy(id_col).agg(F.min("grade").alias("grade"))


def fit_grades(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> OrdinalModel:
    """Train on at most ``sample_docs`` rated documents, chosen by a hash of the id."""
    chosen = dict(map(tuple, graded(labels, id_col).orderBy(F.xxhash64(id_col)).limit(sample_docs).collect()))
    if not chosen:
        return train_ordinal(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    picked = docs.filter(F.col(id_col).isin(list(chosen))).select(id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, off in slices(batch.column(1), SLICE):
                row, ids = features(data, off)
                cuts = np.searchsorted(row, np.arange(hi - lo + 1))
                flat = [ids[a:b].astype("<i4").tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(flat, pa.binary())], [id_col, "ids"])

    got = sorted((r[0], r[1]) for r in picked.mapInArrow(tidy(run), f"`{id_col}` {kind}, ids binary").collect())
    ids = [np.frombuffer(b, "<i4").astype(np.int64) for _, b in got]
    rows = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
    return train_ordinal(rows, np.concatenate(ids) if ids else np.zeros(0, np.int64), np.array([chosen[d] for d, _ in got], np.int64))


def grade_documents(
    docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text", keep: float = KEEP, columns: list[str] | None = None
) -> DataFrame:
    """Per row the id (or ``columns``), ``expected_grade``, ``tail_probability`` (of the best grade), ``kept``.

    One pass over whole texts without a shuffle. NULL and empty texts score by the thresholds alone.
    Repeated rows score alike. Without any rating every weight is 0 and all rows are kept.
    """
    passed = columns or [id_col]
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in passed)
    bits = len(model.weights).bit_length() - 1
    # A text that is passed on is sent to the task once.
    sent = passed if text_col in passed else [*passed, text_col]
    text_at = sent.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, off in slices(batch.column(text_at), SLICE):
                row, ids = features(data, off, bits)
                tail = model.chances(np.bincount(row, model.weights[ids], hi - lo))
                arrays = [batch.column(k).slice(lo, hi - lo) for k in range(len(passed))]
                arrays += [pa.array(tail.sum(1)), pa.array(tail[:, TAIL_GRADE - 1]), pa.array(tail[:, TAIL_GRADE - 1] >= keep)]
                yield pa.RecordBatch.from_arrays(arrays, [*passed, "expected_grade", "tail_probability", "kept"])

    read = docs.select(*[F.col(f"`{c}`") for c in sent])
    return read.mapInArrow(tidy(run), f"{fields}, expected_grade double, tail_probability double, kept boolean")
