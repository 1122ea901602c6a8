"""Periodic runs of words, found by recursive frequency splitting.

A run of period q holds at least three of every word in it, so a word that occurs fewer than three
times in its segment is in no run there: it splits the segment, the counts of the parts are taken
anew, and so on until nothing splits. What is left is short or repetitive, and is scanned lag by lag:
at lag q only neighbouring blocks that start at multiples of q are compared (a run of three periods
holds two equal ones), so all lags together cost n log n, and equal blocks are extended word by word.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promoledger.llm.kernels import slices

LEAST_WORDS, LEAST_PERIODS = 24, 3
_NAMES = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
_FACTOR, _MODULUS = 1_000_003, (1 << 31) - 1


def segments(ids: np.ndarray, owner: np.ndarray, least_words: int = LEAST_WORDS, least: int = LEAST_PERIODS) -> list[tuple[int, int]]:
    """(start, end) of what stays of each owner's words once words too rare in their segment have split it to stability."""
    at, segment = np.arange(len(ids)), owner
    codes = int(ids.max()) + 1 if len(ids) else 1
    while len(at):
        # A word's count in its segment.
        key = segment * codes + ids[at]
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        count = np.diff(np.append(first, len(ranked)))
        often = np.empty(len(at), bool)
        often[order] = np.repeat(count >= least, count)
        kept, of = at[often], segment[often]
        # Neighbours that were neighbours before stay together; parts too short for a run go.
        edge = np.concatenate([[True], (np.diff(kept) != 1) | (of[1:] != of[:-1])])[: len(kept)]
        number = np.cumsum(edge) - 1
        size = np.bincount(number)
        long_enough = size[number] >= least_words if len(kept) else np.zeros(0, bool)
        kept, number = kept[long_enough], number[long_enough]
        if len(kept) == len(at):
            break
        at, segment = kept, number
    if not len(at):
        return []
    edge = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 1) | (segment[1:] != segment[:-1])]))
    return list(zip(at[edge].tolist(), (at[np.append(edge[1:], len(at)) - 1] + 1).tolist(), strict=True))


def _prefix_sums(ids: np.ndarray) -> tuple[list[int], list[int]]:
    """Rolling hash of every prefix and the powers of its factor."""
    sums, powers, s, p = [0], [1], 0, 1
    for x in ids.tolist():
        s = (s * _FACTOR + x + 1) % _MODULUS
        p = p * _FACTOR % _MODULUS
        sums.append(s)
        powers.append(p)
    return sums, powers


def lag_scan(ids: np.ndarray, least_words: int = LEAST_WORDS, least: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every maximal run with ``length >= max(least_words, least * period)``, by start and period."""
    n = len(ids)
    sums, powers = (np.array(x, np.int64) for x in _prefix_sums(ids))
    runs: list[tuple[int, int, int]] = []
    inside = np.zeros(n, np.int64)  # furthest end of the runs around a word
    for q in range(1, n // least + 1):
        starts = np.arange(0, n - q + 1, q)
        block = (sums[starts + q] - sums[starts] * powers[q] % _MODULUS) % _MODULUS
        hits = starts[:-1][block[1:] == block[:-1]]
        done = 0
        # A square inside a run of a smaller period, or inside the stretch found last, is that run again.
        for start in hits[hits + 2 * q > inside[hits]].tolist():
            if start < done:
                continue
            lo, hi = _stretch(ids, start, q)
            done = hi - q
            if hi - lo >= max(least_words, least * q):
                runs.append((lo, hi - lo, q))
                inside[lo:hi] = np.maximum(inside[lo:hi], hi)
    return sorted(runs, key=lambda r: (r[0], r[2]))


def _stretch(ids: np.ndarray, start: int, q: int) -> tuple[int, int]:
    """The longest stretch around ``start`` in which words q apart agree; empty if those at ``start`` do not."""
    n, hi = len(ids), start
    step = 64
    while hi + q < n:
        differ = np.flatnonzero(ids[hi : hi + step][: n - q - hi] != ids[hi + q : hi + q + step])
        if len(differ):
            hi += int(differ[0])
            break
        hi = min(hi + step, n - q)
        step *= 2
    lo, step = start, 64
    while lo > 0:
        low = max(0, lo - step)
        differ = np.flatnonzero(ids[low:lo] != ids[low + q : lo + q])
        if len(differ):
            lo = low + int(differ[-1]) + 1
            break
        lo = low
        step *= 2
    return lo, hi + q


def planted_order(doc_id: int | None, n: int) -> np.ndarray | None:
    """Word numbers of a document after its planted repetition; None where it has none (a NULL id never has)."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def _longest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """The run with the greatest length / period; ties go to the smallest start, then period."""
    best = runs[0]
    for run in runs[1:]:
        if run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapse_periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", planted: bool = False, with_text: bool = False) -> DataFrame:
    """One row per document: the id, ``n_runs``, the run of the greatest exponent (``start``, ``length``,
    ``period``, ``exponent_milli``; NULL without one), digests of all runs and of the collapsed words, and with
    ``with_text`` the collapsed words themselves. ``planted`` first repeats words as the id's checksum says.

    Words are runs of characters other than space and tab to carriage return. A NULL text has no words, as
    an empty one; a NULL id stays NULL; rows that repeat give a row each; an empty table gives none. Further
    columns are not read. A text is handled whole; no row is shuffled.
    """
    names = _NAMES + ["collapsed"] * with_text
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, " + ", ".join(f"{n} {'long' if k < 5 else 'string'}" for k, n in enumerate(names))

    def handle(ids: pa.Array, texts: list[bytes]) -> pa.RecordBatch:
        code: dict[bytes, int] = {}
        words = [t.split() for t in texts]
        plans = [planted_order(i, len(w)) if planted else None for i, w in zip(ids.to_pylist(), words, strict=True)]
        sizes = np.array([len(w) for w in words], np.int64)
        flat = np.fromiter((code.setdefault(x, len(code)) for w in words for x in w), np.int64, int(sizes.sum()))
        first = np.concatenate([[0], np.cumsum(sizes)])
        for k, plan in enumerate(plans):
            if plan is not None:
                flat[first[k] : first[k + 1]] = flat[first[k] + plan]
        found: list[list[tuple[int, int, int]]] = [[] for _ in words]
        for lo, hi in segments(flat, np.repeat(np.arange(len(words)), sizes)):
            k = int(np.searchsorted(first, lo, "right")) - 1
            local = np.unique(flat[lo:hi], return_inverse=True)[1]
            found[k] += [(lo - int(first[k]) + s, length, q) for s, length, q in lag_scan(local)]
        rows = []
        for w, plan, runs in zip(words, plans, found, strict=True):
            runs.sort(key=lambda r: (r[0], r[2]))
            keep = np.ones(len(w), bool)
            for s, length, q in runs:
                keep[s + q : s + length] = False
            if plan is not None:
                w = [w[i] for i in plan[keep].tolist()]
            elif runs:
                w = [w[i] for i in np.flatnonzero(keep).tolist()]
            text = b" ".join(w)
            s, length, q = _longest(runs) if runs else (None, None, None)
            rows.append((
                len(runs), s, length, q, 1000 * length // q if runs else None,
                hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest(),
                hashlib.sha256(text).hexdigest(), *([text.decode()] if with_text else []),
            ))
        columns = list(zip(*rows, strict=True))
        arrays = [ids, *(pa.array(c, pa.int64()) for c in columns[:5]), *(pa.array(c, pa.string()) for c in columns[5:])]
        return pa.RecordBatch.from_arrays(arrays, [id_col, *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, off in slices(batch.column(1)):
                raw = data.tobytes()
                yield handle(batch.column(0)[lo:hi], [raw[a:b] for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)
