"""Removing repeated passages by sliding spans of sentences.

From every sentence the shortest run of at least three sentences and LEAST_WORDS words is hashed over
its lower-cased words, so short sentences are covered by longer runs; so is the run that ends a text
(the whole text if it has three sentences and too few words), and every run of one or two sentences of
25 words or more. A character of a script without spaces counts as a half or a quarter of a word.
Sentences of more than UNCUT_WORDS are cut into units where the hash of two neighbouring words is 0
modulo CUT_EVERY, so that spans re-align inside them: from every unit the shortest run of 25 words is
hashed too. A repeat loses at most the words before its first and after its last such place.

Spans meet globally by hash; the first occurrence (smallest id, then position) stays and the words
under every later one go. Each chunk of texts settles its own repeats and sends one entry per distinct
span to the span's part, so a frequent span costs its part one entry per chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promoledger.llm.kernels import LOWER, SPACE, RangeHash, U, mix, slices, tidy

RUN, LONG_RUN_WORDS, LEAST_WORDS = 3, 25, 6
UNCUT_WORDS, CUT_EVERY, CHUNK_BYTES = 12, 5, 4 << 20
# Bytes of text at once; a word's arrays take many times as much.
SLICE = 1 << 19
PLACE = 1 << 32
WORD = 4  # weight of a word; characters of scripts without spaces weigh 2 or 1
_END = np.zeros(256, bool)
_END[list(b".!?")] = True


def sentence_bounds(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, row) of every sentence of every non-empty row. A sentence ends with its line, with the
    white space after a full stop, question or exclamation mark, or with a full-width one of these;
    the pieces of a text add up to it."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    space = np.isin(data, (9, 10, 11, 12, 13, 32))
    cut = np.zeros(len(data) + 1, bool)
    cut[1:] = data == 10
    cut[2:] |= _END[data[:-1]] & space[1:]
    if len(data) > 2:
        a, b, c = data[:-2], data[1:-1], data[2:]
        cut[3:] |= ((a == 0xE3) & (b == 0x80) & (c == 0x82)) | ((a == 0xEF) & (b == 0xBC) & ((c == 0x81) | (c == 0x9F)))
    cut[off] = True
    starts = np.flatnonzero(cut[:-1])
    return starts, np.searchsorted(off, starts, "right") - 1


def weighed_words(data: np.ndarray, off: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, weight) of every word; characters of scripts without spaces are words of their own."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    after = np.append(data[1:], 0)
    wide = (data >= 0xE3) & (data <= 0xE9) | (data == 0xEF) & (after >= 0xBC) & (after <= 0xBE)
    thai = (data == 0xE0) & (after >= 0xB8) & (after <= 0xBB)
    burmese = (data == 0xE1) & ((after >= 0x80) & (after <= 0x82) | (after == 0x9E))
    single = np.flatnonzero(wide | thai | burmese)
    edge = np.zeros(n + 4, bool)
    edge[off] = edge[start] = edge[n] = True
    edge[single] = edge[single + 3] = True
    space = SPACE[data]
    head, tail = edge[:n].copy(), edge[1 : n + 1].copy()
    head[1:] |= space[:-1]
    tail[:-1] |= space[1:]
    first = np.flatnonzero(head & ~space)
    weight = np.full(n, WORD)
    weight[single] = np.where(wide[single], 2, 1)
    return first, np.flatnonzero(tail & ~space) + 1, weight[first]


class Words:
    """The words of a slice with their sentences and rows; ``spans`` lists the hashed runs."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        low = LOWER[data]
        self.start, self.row = sentence_bounds(data, off)
        self.first, last, weight = weighed_words(low, off, self.start)
        self.owner = np.searchsorted(self.start, self.first, "right") - 1
        self.table = RangeHash(low)
        self.hashes = self.table(self.first, last) if len(self.first) else np.zeros(0, U)
        self.mass = np.concatenate([[0], np.cumsum(weight)])
        self.begin = np.flatnonzero(np.diff(self.owner, prepend=-1))  # first word of every sentence with words
        self.texts = self.row[self.owner]
        self.text_begin = np.searchsorted(self.texts, np.arange(len(off)))

    def ranges(self) -> tuple[np.ndarray, np.ndarray]:
        """(first word, end word) of the spans."""
        begin, mass = self.begin, self.mass
        end = np.append(begin[1:], len(self.first))
        n, text = len(begin), self.texts[begin]
        size, reach = mass[end], mass[begin]
        heads, out = np.arange(n), []
        for k in range(1, RUN):
            to = heads[: max(n - k + 1, 0)] + k - 1
            at = heads[: len(to)]
            take = (text[at] == text[to]) & (size[to] - reach[at] >= LONG_RUN_WORDS * WORD)
            out.append((begin[at[take]], end[to[take]]))
        to = np.maximum(heads + RUN - 1, np.searchsorted(size, reach + LEAST_WORDS * WORD))
        at = heads[to < n]
        at = at[text[at] == text[to[at]]]
        out.append((begin[at], end[to[at]]))
        # The run that ends each text.
        lo = np.flatnonzero(np.diff(text, prepend=-1))
        hi = np.append(lo[1:], n) - 1
        enough = np.searchsorted(reach, size[hi] - LEAST_WORDS * WORD, "right") - 1
        at = np.maximum(np.minimum(enough, hi - RUN + 1), lo)
        take = hi - at + 1 >= RUN
        out.append((begin[at[take]], end[hi[take]]))
        out.append(self.unit_ranges(begin, end))
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))

    def unit_ranges(self, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, end word) of the runs of units that start or end inside a sentence."""
        mass, n = self.mass, len(self.first)
        cut = np.zeros(n, bool)
        cut[1:] = mix(self.hashes[:-1] + mix(self.hashes[1:])) % U(CUT_EVERY) == 0
        cut &= np.repeat(mass[end] - mass[begin] > UNCUT_WORDS * WORD, end - begin)
        whole = np.zeros(n + 1, bool)
        whole[begin] = whole[n] = True
        cut |= whole[:-1]
        head = np.flatnonzero(cut)
        stop = np.append(head[1:], n)
        to = np.searchsorted(mass[stop], mass[head] + LONG_RUN_WORDS * WORD)
        at = np.flatnonzero(to < len(head))
        a, b = head[at], stop[to[at]]
        take = (self.texts[a] == self.texts[b - 1]) & ~(whole[a] & whole[b])
        return a[take], b[take]

    def spans(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, first word in its text, number of words, hash) of the spans."""
        if not len(self.first):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U)
        a, b = self.ranges()
        sums = np.zeros(len(self.hashes) + 1, U)
        np.cumsum(self.hashes * self.table.up[: len(self.hashes)], out=sums[1:])
        h = mix((sums[b] - sums[a]) * self.table.down[a] + mix((b - a).astype(U)))
        row = self.texts[a]
        return row, a - self.text_begin[row], b - a, h

    def without(self, data: np.ndarray, off: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bytes left, offsets, sentences with words, sentences cut) of the rows without words a to b.
        A word goes with the space up to the next one; the first and last go with their sentence's ends."""
        size = len(off) - 1
        steps = np.zeros(len(self.first) + 1, np.int64)
        np.add.at(steps, a, 1)
        np.add.at(steps, b, -1)
        drop = np.cumsum(steps[:-1]) > 0
        head = self.first.copy()
        head[self.begin] = self.start[self.owner[self.begin]]
        tail = np.append(head[1:], len(data))
        last = np.append(self.begin[1:], len(self.first)) - 1
        if len(self.first):
            tail[last] = np.append(self.start[1:], len(data))[self.owner[last]]
        edge = np.zeros(len(data) + 1, np.int64)
        edge[head[drop]] += 1
        edge[tail[drop]] -= 1
        left = np.cumsum(edge[:-1]) == 0
        held = np.concatenate([[0], np.cumsum(left)])
        counts = np.bincount(self.texts[self.begin], minlength=size)
        return data[left], held[off], counts, np.bincount(self.row[np.unique(self.owner[drop])], minlength=size)


def _ranks(ids: pa.Array) -> np.ndarray:
    """Dense ranks; NULL ids come last, so a text with an id is never cut in favour of one without."""
    return pc.rank(ids, "ascending", null_placement="at_end", tiebreaker="dense").to_numpy().astype(np.int64)


def _shared(h: np.ndarray) -> np.ndarray:
    """Whether another entry has the same hash."""
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    out = np.zeros(len(h), bool)
    out[order[1:]] = same
    out[order[:-1]] |= same
    return out


def _later(h: np.ndarray, rank: np.ndarray, tag: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order by hash and occurrence, whether each is another occurrence than its hash's first); entries
    that agree in everything are one occurrence, of which one is marked."""
    order = np.lexsort((place, tag, rank, h))
    columns = [c[order] for c in (h, rank, tag, place)]
    if not len(h):
        return order, np.zeros(0, bool)
    new = np.append(True, columns[0][1:] != columns[0][:-1])
    differs = np.append(True, np.any([c[1:] != c[:-1] for c in columns], axis=0))
    return order, ~new & differs


def repeated_spans(keyed: DataFrame) -> DataFrame:
    """(id, tag, places) of the texts that hold later occurrences; ``keyed``: (id, tag, text).

    ``places`` lists first word (times PLACE) plus number of words, counted from the text's start.
    """

    parts = 2 * int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        rows, tags, ids, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal held
            row, first, n, h = (np.concatenate(c) for c in zip(*rows, strict=True))
            key, tag = pa.concat_arrays(ids), np.concatenate(tags)
            place = first * PLACE + n
            order, later = _later(h, _ranks(key)[row], tag[row], place)
            row, place, h = row[order], place[order], h[order]
            # One entry per span goes to the span's part; what is settled here goes anywhere.
            new = np.append(True, h[1:] != h[:-1]) if len(h) else later
            part = np.where(new, (h % U(parts)).astype(np.int64), parts + task % parts)
            keep = np.flatnonzero(new | later)
            keep = keep[np.argsort(part[keep], kind="stable")]
            cuts = np.append(np.flatnonzero(np.diff(part[keep], prepend=-1)), len(keep))
            lists = [key.take(pa.array(row[keep])), pa.array(tag[row[keep]]), pa.array(place[keep]), pa.array(h[keep].view(np.int64))]
            offsets = pa.array(cuts.astype(np.int32))
            for x in (rows, tags, ids):
                x.clear()
            held = 0
            arrays = [pa.array(part[keep][cuts[:-1]].astype(np.int32)), *(pa.ListArray.from_arrays(offsets, x) for x in lists)]
            return pa.RecordBatch.from_arrays(arrays, ["part", "id", "tag", "place", "span"])

        for batch in batches:
            for lo, hi, data, off in slices(batch.column(2), SLICE):
                row, *found = Words(data, off).spans()
                rows.append((row + sum(map(len, tags)), *found))
                ids.append(batch.column(0).slice(lo, hi - lo))
                tags.append(batch.column(1).slice(lo, hi - lo).to_numpy(zero_copy_only=False))
                held += len(data)
                if held >= CHUNK_BYTES:
                    yield flush()
        if rows:
            yield flush()

    def settle(table: pa.Table) -> pa.Table:
        key, tag, place, span = (table.column(c).combine_chunks() for c in ("id", "tag", "place", "span"))
        key, tag, place, span = (c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in (key, tag, place, span))
        key, tag, place, span = (c.flatten() for c in (key, tag, place, span))
        tags, places = tag.to_numpy(), place.to_numpy()
        take = np.arange(len(tags))
        if table.column("part")[0].as_py() < parts:
            h = span.to_numpy().view(U)
            some = np.flatnonzero(_shared(h))
            order, later = _later(h[some], _ranks(key.take(pa.array(some))), tags[some], places[some])
            take = some[order[later]]
        return pa.table([key.take(pa.array(take)), pa.array(tags[take]), pa.array(places[take])], ["id", "tag", "place"])

    kind = keyed.schema["id"].dataType.simpleString()
    sent = keyed.mapInArrow(tidy(run), f"part int, id array<{kind}>, tag array<long>, place array<long>, span array<long>")
    later = sent.groupBy("part").applyInArrow(settle, f"id {kind}, tag long, place long")
    return later.groupBy("id", "tag").agg(F.collect_set("place").alias("places"))


def remove_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` with shortened texts and two columns: ``n_sentences`` and ``n_removed`` (cut in whole or in part).

    Repeats inside a text count too. Rows that agree in id and text are one occurrence and stay alike.
    NULL texts stay NULL with no sentences, empty texts stay empty. A text may become empty; its row
    stays. Other columns are passed on; ``length_col``, if given, is set to the characters left.
    """
    names = docs.columns
    tag = F.xxhash64(F.col(text_col))
    keyed = docs.select(F.col(id_col).alias("id"), tag.alias("tag"), F.col(text_col).alias("text"))
    later = repeated_spans(keyed.filter(F.length("text") > 0))
    right = later.select(F.col("id").alias("__id"), F.col("tag").alias("__tag"), F.col("places").alias("__places"))
    # Rows travel as one column, so their own columns may have any names.
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    text = F.col("row").getField(text_col)
    same = F.col("row").getField(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__tag"))
    rows = row.join(right, same, "left").select("row", text.alias("text"), "__places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, off in slices(batch.column(1), SLICE):
                size, words = hi - lo, Words(data, off)
                places = batch.column(2).slice(lo, size)
                first = pc.list_flatten(places).to_numpy(zero_copy_only=False).astype(np.int64)
                begin = words.text_begin[pc.list_parent_indices(places).to_numpy(zero_copy_only=False)] + first // PLACE
                left, ends, counts, gone = words.without(data, off, begin, begin + first % PLACE)
                texts = pa.StringArray.from_buffers(size, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(left.tobytes()))
                texts = pc.if_else(batch.column(1).slice(lo, size).is_valid(), texts, None)
                arrays = [batch.column(0).slice(lo, size), texts, pa.array(counts, pa.int64()), pa.array(gone, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, ["row", "text", "n_sentences", "n_removed"])

    kind = rows.schema["row"].dataType.simpleString()
    out = rows.mapInArrow(tidy(run), f"row {kind}, text string, n_sentences long, n_removed long")
    columns = [F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in names]
    if length_col:
        columns = [F.length("text").cast(docs.schema[c].dataType).alias(c) if c == length_col else x for c, x in zip(names, columns, strict=True)]
    extra = [F.col(c) for c in ("n_sentences", "n_removed") if c not in names]
    return out.select(*columns, *extra)
