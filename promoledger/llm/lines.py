"""Line labelling with a linear-chain conditional random field.

Each line with a word is content (0) or boilerplate (1). Emissions are linear in line features,
transitions are free; training maximises the likelihood of weak labels: lines of documents rated
good are content unless they repeat an earlier line, lines of documents rated bad are boilerplate.
Decoding is Viterbi. A document is kept if content lines hold a set share of its characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promoledger.llm.kernels import RangeHash, U, combine, mix, repeats, slices, total_per, word_ranges

CONTENT_SHARE, SAMPLE_DOCS, ROUNDS, FEATURES = 0.5, 600, 80, 8
MIN_WORDS, REPEAT_PERCENT = 50, 50
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?:;\"')")] = True
_DIGITS = np.zeros(256, bool)
_DIGITS[48:58] = True


@dataclass(frozen=True)
class ChainModel:
    """Weights of the boilerplate emission, transition scores and start scores."""

    emission: np.ndarray
    transition: np.ndarray
    start: np.ndarray

    def viterbi(self, scores: np.ndarray) -> np.ndarray:
        """Most likely labels of one document from its lines' boilerplate scores."""
        (cc, cb), (bc, bb) = self.transition.tolist()
        content, boiler = self.start[0], self.start[1] + scores[0]
        back = []
        for s in scores[1:].tolist():
            to_c, to_b = content + cc >= boiler + bc, content + cb >= boiler + bb
            back.append((to_c, to_b))
            content, boiler = (content + cc if to_c else boiler + bc), (content + cb if to_b else boiler + bb) + s
        out = np.zeros(len(scores), bool)
        state = bool(boiler > content)
        out[-1] = state
        for k in range(len(back) - 1, -1, -1):
            state = not back[k][1] if state else not back[k][0]
            out[k] = state
        return out


@dataclass
class Measured:
    """Counts per document and features per line with a word, of one slice of a batch."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    line_doc: np.ndarray
    line_chars: np.ndarray
    line_dup: np.ndarray
    features: np.ndarray


def measure(data: np.ndarray, off: np.ndarray) -> Measured:
    n = len(off) - 1
    starts, ends, doc = word_ranges(data, off)
    ranges = RangeHash(data)
    n_words = np.bincount(doc, minlength=n)
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool) if len(starts) and np.all(starts[1:] != ends[:-1]) else _inside(len(data), starts, ends)
    chars = inside & ((data & 0xC0) != 0x80)
    symbols = _SYMBOLS[data]
    # Words of three-word windows found twice or more in their document.
    repeat = np.zeros(len(starts), bool)
    if len(starts) > 2:
        h = ranges(starts, ends)
        window = combine([h[:-2], h[1:-1], h[2:], doc[2:].astype(U)])
        whole = doc[:-2] == doc[2:]
        at = np.flatnonzero(whole)
        order = at[np.argsort(window[at], kind="stable")]
        same = window[order[1:]] == window[order[:-1]]
        twice = np.zeros(len(order), bool)
        twice[1:] |= same
        twice[:-1] |= same
        for k in range(3):
            repeat[order[twice] + k] = True
    n_repeat = np.bincount(doc[repeat], minlength=n)
    # Lines with a word.
    breaks = np.flatnonzero(data == 10)
    line_start = np.union1d(off[:-1][np.diff(off) > 0], breaks + 1)
    line_start = line_start[line_start < len(data)]
    line_end = np.append(line_start[1:], len(data))
    line_end = line_end - (data[line_end - 1] == 10) if len(line_start) else line_end
    sums = {}
    for name, flags in (("chars", chars), ("symbols", symbols), ("digits", _DIGITS[data])):
        total = np.zeros(len(data) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        sums[name] = total[line_end] - total[line_start]
    word_at = np.searchsorted(starts, line_start)
    words = np.searchsorted(starts, line_end) - word_at
    full = words > 0
    line_start, line_end, words = line_start[full], line_end[full], words[full]
    line_chars, line_symbols, digits = sums["chars"][full], sums["symbols"][full], sums["digits"][full]
    line_doc = np.searchsorted(off, line_start, "right") - 1
    dup = repeats(mix(ranges(line_start, line_end) + line_doc.astype(U) * U(0x9E3779B97F4A7C15)))
    last = ends[word_at[full] + words - 1] - 1 if len(words) else np.zeros(0, np.int64)
    size = np.maximum(line_chars, 1)
    features = np.stack(
        [
            np.ones(len(words)),
            np.minimum(np.log1p(words), 5) / 3,
            np.minimum(10 * line_symbols / size, 3),
            dup.astype(float),
            _ENDS[data[last]].astype(float) if len(words) else np.zeros(0),
            np.minimum(5 * digits / size, 3),
            (words < 4).astype(float),
            np.minimum(line_chars / np.maximum(words, 1), 20) / 10,
        ],
        axis=1,
    )
    return Measured(n_words, total_per(chars, off), total_per(symbols, off), np.bincount(line_doc[dup], minlength=n), n_repeat, line_doc, line_chars, dup, features)


def _inside(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """True for the bytes of words; words of neighbouring rows may touch."""
    depth = np.zeros(n + 1, np.int32)
    np.add.at(depth, starts, 1)
    np.add.at(depth, ends, -1)
    return np.cumsum(depth[:-1]) > 0


def train_chain(sequences: list[tuple[np.ndarray, np.ndarray]], rounds: int = ROUNDS, rate: float = 0.15, shrink: float = 0.01) -> ChainModel:
    """Maximum likelihood by Adam; the forward and backward sums run over all sequences at once."""
    sequences = [s for s in sequences if len(s[1])]
    if not sequences:
        return ChainModel(np.zeros(FEATURES), np.zeros((2, 2)), np.zeros(2))
    sequences.sort(key=lambda s: -len(s[1]))
    lengths = np.array([len(s[1]) for s in sequences])
    count, longest = len(sequences), int(lengths[0])
    x = np.concatenate([s[0] for s in sequences])
    gold = np.concatenate([s[1] for s in sequences]).astype(int)
    row = np.repeat(np.arange(count), lengths)
    at = np.concatenate([np.arange(n) for n in lengths])
    active = [int(np.searchsorted(-lengths, -t, "left")) for t in range(longest)]  # sequences longer than t
    gold_steps = np.zeros((2, 2))
    follows = row[1:] == row[:-1]
    np.add.at(gold_steps, (gold[:-1][follows], gold[1:][follows]), 1)
    gold_start = np.bincount(gold[at == 0], minlength=2)
    theta, m, v = np.zeros(x.shape[1] + 6), np.zeros(x.shape[1] + 6), np.zeros(x.shape[1] + 6)
    k = x.shape[1]
    for step in range(1, rounds + 1):
        w, trans, start = theta[:k], theta[k : k + 4].reshape(2, 2), theta[k + 4 :]
        score = np.zeros((longest, count, 2))
        score[at, row, 1] = x @ w
        alpha, beta = np.zeros((longest, count, 2)), np.zeros((longest, count, 2))
        alpha[0] = start + score[0]
        for t in range(1, longest):
            a = active[t]
            alpha[t, :a] = np.logaddexp(alpha[t - 1, :a, :1] + trans[0], alpha[t - 1, :a, 1:] + trans[1]) + score[t, :a]
        pair = np.zeros((2, 2))
        z = np.logaddexp.reduce(alpha[lengths - 1, np.arange(count)], axis=1)
        for t in range(longest - 1, 0, -1):
            a = active[t]
            onward = score[t, :a] + beta[t, :a]
            pair += np.exp(alpha[t - 1, :a, :, None] + trans + onward[:, None, :] - z[:a, None, None]).sum(0)
            beta[t - 1, :a] = np.logaddexp.reduce(trans + onward[:, None, :], axis=2)
        chance = np.exp(alpha[at, row] + beta[at, row] - z[row, None])
        grad = np.concatenate([x.T @ (gold - chance[:, 1]), (gold_steps - pair).ravel(), gold_start - chance[at == 0].sum(0)]) / len(gold) - shrink * theta / k
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return ChainModel(theta[:k], theta[k : k + 4].reshape(2, 2), theta[k + 4 :])


def fit_line_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> ChainModel:
    """Train on at most ``sample_docs`` rated documents, half of each rating, chosen by a hash of the id.

    Rows without an id or rating are not used; without both ratings the model is undecided and keeps all.
    """
    rated = labels.filter(F.col(id_col).isNotNull() & F.col("quality").isNotNull()).groupBy(id_col).agg(F.min("quality").alias("__q"))
    picks = [rated.filter(F.col("__q") == q).orderBy(F.xxhash64(id_col)).limit(sample_docs // 2) for q in (0, 1)]
    chosen = {r[0]: r[1] for p in picks for r in p.collect()}
    if len(set(chosen.values())) < 2:
        return train_chain([])
    texts = docs.filter(F.col(id_col).isin(list(chosen))).select(id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, off in slices(batch.column(1)):
                got = measure(data, off)
                cuts = np.searchsorted(got.line_doc, np.arange(hi - lo + 1))
                flat = [got.features[a:b].astype("<f4").tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(flat, pa.binary())], [id_col, "lines"])

    kind = docs.schema[id_col].dataType.simpleString()
    sequences = []
    for doc, lines in sorted(texts.mapInArrow(run, f"`{id_col}` {kind}, lines binary").collect()):
        x = np.frombuffer(lines, "<f4").reshape(-1, FEATURES).astype(float)
        sequences.append((x, np.ones(len(x)) if chosen[doc] == 0 else x[:, 3]))
    return train_chain(sequences)


def apply_quality_rules(
    docs: DataFrame, model: ChainModel, id_col: str = "doc_id", text_col: str = "text", share: float = CONTENT_SHARE
) -> DataFrame:
    """Per row: the id, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``base_failed``, ``kept``, ``n_lines``, ``n_boilerplate`` and ``content_share``.

    Whole texts are read, one pass, no shuffle. NULL and empty texts have no words and fail the base
    rules; their share is 0. Repeated rows are judged each; further columns of ``docs`` are not read.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, " + ", ".join(f"{c} long" for c in names) + ", base_failed boolean, kept boolean, n_lines long, n_boilerplate long, content_share double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, off in slices(batch.column(1)):
                got, n = measure(data, off), hi - lo
                scores = got.features @ model.emission
                cuts = np.searchsorted(got.line_doc, np.arange(n + 1))
                boiler = np.zeros(len(scores), bool)
                for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    if b > a:
                        boiler[a:b] = model.viterbi(scores[a:b])
                content = np.bincount(got.line_doc, got.line_chars * ~boiler, n) / np.maximum(got.word_chars, 1)
                failed = (got.n_words < MIN_WORDS) | (100 * got.n_repeat_words > REPEAT_PERCENT * got.n_words)
                columns = [got.n_words, got.word_chars, got.n_symbols, got.n_dup_lines, got.n_repeat_words]
                arrays = [batch.column(0).slice(lo, n), *(pa.array(c.astype(np.int64)) for c in columns), pa.array(failed)]
                arrays += [pa.array(~failed & (content >= share)), pa.array(np.diff(cuts).astype(np.int64))]
                arrays += [pa.array(np.bincount(got.line_doc[boiler], minlength=n).astype(np.int64)), pa.array(content)]
                yield pa.RecordBatch.from_arrays(arrays, [id_col, *names, "base_failed", "kept", "n_lines", "n_boilerplate", "content_share"])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)
