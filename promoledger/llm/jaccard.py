"""Exact Jaccard self-join of documents on word shingles, as a join in a metric space.

Jaccard distance is a metric, but distances between unrelated texts are all 1, so pivots drawn from
the corpus cannot tell them apart. Documents are therefore first told apart in slices of the shingle
space. Two linked sets of sizes near r differ in at most k(r) shingles. Cut by hash into k + 1 slices
(and a few spare ones), they agree in a whole non-empty slice. A region is a set of documents that
hold the same content in the same slice; documents near a size boundary are replicated to the regions
of both size bands.

Inside a region the join is by pivots. First a few rounds of hubs: members within the threshold of a
region's hub are one component and their pairs need no further look. Regions that still hold several
components are joined recursively: members go to the Voronoi cell of the nearest pivot and, by the
triangle inequality, to every pivot not farther by more than twice the threshold; small cells compare
pairs of different components. Cells use the Hamming distance of parity sketches (whether an odd
number of shingles falls into each bucket, with a bucket per shingle or more), which never exceeds the
number of differing shingles, so nothing is lost, and tells long texts apart as well as short ones. What passes is compared on 16-bit prints of the
shingles, which never share less than the sets, and then exactly on whole sets.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promoledger.llm.graph import components
from promoledger.llm.kernels import LOWER, RangeHash, U, combine, mix, slices, text_buffer, tidy, word_ranges
from promoledger.session import materialize, release_shuffles, short_batches

LEAF, PIVOTS, SPARE, BLOCK_KEYS, SLICE = 32, 8, 4, 1 << 20, 1 << 19
REGION_ROWS, HUB_ROUNDS, BEST_ROUNDS = 4096, 1, 2
# Bits of the smallest and of the largest sketch; words of sketches compared at once.
LEAST_BITS, MOST_BITS, COMPARED = 256, 1 << 16, 1 << 21


@dataclass(frozen=True)
class Threshold:
    """Jaccard similarity of at least ``num`` / ``den``."""

    num: int = 85
    den: int = 100

    def linked(self, shared, a, b):
        """Whether sets of sizes ``a`` and ``b`` link; numbers or arrays."""
        return self.den * shared >= self.num * (a + b - shared)

    def possible(self, differ: np.ndarray, both: np.ndarray) -> np.ndarray:
        """Whether sets of ``both`` shingles in all that differ in ``differ`` or more can be linked."""
        shared = (both - differ) // 2
        return self.den * shared >= self.num * (both - shared)

    def bands(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(largest size, slices) per band, for sizes up to ``size``. Partners of a band's sets lie in
        the band or the next; ``slices`` covers the shingles such a pair may differ in."""
        ends, low = [], 1
        while not ends or ends[-1] < size:
            ends.append(low * self.den // self.num)
            low = ends[-1] + 1
        tops = np.array(ends, np.int64)
        differ = (self.den - self.num) * (tops + tops * self.den // self.num) // (self.den + self.num)
        return tops, differ + 1 + SPARE


def shingle_sets(data: np.ndarray, off: np.ndarray, k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each row's k-word shingles; shorter texts are one shingle."""
    n = len(off) - 1
    low = LOWER[data]
    starts, ends, row = word_ranges(low, off)
    cuts = np.searchsorted(row, np.arange(n + 1))
    h = RangeHash(low)(starts, ends) if len(starts) else np.zeros(0, U)
    grams = combine([h[i : len(h) - k + 1 + i] for i in range(k)]) if len(h) >= k else np.zeros(0, U)
    out = []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(grams[a : b - k + 1]))
        elif b > a:
            out.append(mix(combine([h[i : i + 1] for i in range(a, b)]) + U(b - a)))
        else:
            out.append(np.zeros(0, U))
    return out


def set_class(s: np.ndarray) -> int:
    """Identity of a set; signed, for Spark's bigint."""
    return int(mix(np.array([s.sum(dtype=U) + U(len(s))], U)).view(np.int64)[0])


def slice_keys(s: np.ndarray, tops: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Region keys of a set: its content in each slice of its size band's table and of the band below."""
    band, keys = int(np.searchsorted(tops, len(s))), []
    for table in (band, band - 1):
        if table < 0:
            continue
        m = int(counts[table])
        at = ((s >> U(32)) * U(m)) >> U(32)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        held, content = at[first], np.add.reduceat(s, first)
        if m - len(held) > SPARE:  # too many empty slices to rely on the others: they count as content
            empty = np.setdiff1d(np.arange(m, dtype=U), held)
            held, content = np.concatenate([held, empty]), np.concatenate([content, np.zeros(len(empty), U)])
        keys.append(mix(mix(content + held * U(0x9E3779B97F4A7C15)) + U(table + 1)))
    return np.concatenate(keys)


def _documents(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n_shingles, class) of every row of (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, off in slices(batch.column(1), SLICE):
                sets = shingle_sets(data, off, k)
                sizes = pa.array([len(s) for s in sets], pa.int64())
                classes = pa.array([set_class(s) if len(s) else None for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), sizes, classes], ["doc_id", "n_shingles", "class"])

    return docs.mapInArrow(tidy(run), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_shingles long, class long")


def _regions(docs: DataFrame, k: int, threshold: Threshold, parts: int) -> DataFrame:
    """(region, class) of every region with two classes or more.

    A task packs its (key, class) rows into sorted blocks, one per key range, and sends one class per
    key: classes that meet inside the task are given out at once. So a key has at most one row per
    block in the exchange, however many documents hold it.
    """
    tops, counts = threshold.bands(1 << 26)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        size = 0

        def flush() -> pa.RecordBatch:
            names = np.array(list(held), np.int64)
            keys = np.concatenate(list(held.values()))
            index = np.repeat(np.arange(len(names), dtype=np.uint32), [len(v) for v in held.values()])
            held.clear()
            part = keys % U(parts)
            order = np.lexsort((names[index], keys, part))
            keys, index, part = keys[order], index[order], part[order]
            again = np.concatenate([[False], keys[1:] == keys[:-1]])
            meets = again.copy()
            meets[:-1] |= again[1:]
            local_keys, local = keys[meets].view(np.int64), names[index[meets]]
            keys, index, part = keys[~again], index[~again], part[~again]
            cuts = np.searchsorted(part, np.arange(parts + 1, dtype=U))
            full = np.flatnonzero(np.diff(cuts))
            blobs = []
            for p in full:
                used, short = np.unique(index[cuts[p] : cuts[p + 1]], return_inverse=True)
                head = np.array([len(short), len(used)], "<i8").tobytes()
                blobs.append(head + keys[cuts[p] : cuts[p + 1]].tobytes() + names[used].tobytes() + short.astype("<u4").tobytes())
            if len(local):
                full = np.append(full, -1)
                blobs.append(np.array([len(local), -1], "<i8").tobytes() + local_keys.tobytes() + local.tobytes())
            return pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(blobs, pa.large_binary()).cast(pa.binary())], ["part", "block"])

        for batch in batches:
            for _, _, data, off in slices(batch.column(0), SLICE):
                for s in shingle_sets(data, off, k):
                    if len(s) and (name := set_class(s)) not in held:
                        held[name] = slice_keys(s, tops, counts)
                        size += len(held[name])
                if size >= BLOCK_KEYS:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    def meet(table: pa.Table) -> pa.Table:
        keys, names, out_keys, out_names = [], [], [], []
        for blob in table.column("block").to_pylist():
            n, used = np.frombuffer(blob, "<i8", 2).tolist()
            at = np.frombuffer(blob, U, n, 16)
            if used < 0:
                out_keys.append(at)
                out_names.append(np.frombuffer(blob, "<i8", n, 16 + 8 * n))
                continue
            keys.append(at)
            names.append(np.frombuffer(blob, "<i8", used, 16 + 8 * n)[np.frombuffer(blob, "<u4", n, 16 + 8 * (n + used))])
        if keys:
            at, name = np.concatenate(keys), np.concatenate(names)
            order = np.argsort(at, kind="stable")
            at, name = at[order], name[order]
            # A region lives if its key has two different classes.
            first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            low, high = np.minimum.reduceat(name, first), np.maximum.reduceat(name, first)
            live = np.repeat(low != high, np.diff(np.append(first, len(at))))
            out_keys.append(at[live])
            out_names.append(name[live])
        return pa.table({"region": np.concatenate(out_keys).view(np.int64), "class": np.concatenate(out_names)})

    # Blocks met inside a task (part -1) have a number of their own, so they spread as well.
    sent = docs.select("text").mapInArrow(tidy(blocks), "part int, block binary")
    spread = F.when(F.col("part") >= 0, F.col("part")).otherwise(-1 - F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int"))
    return sent.select(spread.alias("part"), "block").groupBy("part").applyInArrow(meet, "region long, class long")


def _measured(pairs: DataFrame, sets: DataFrame, threshold: Threshold) -> DataFrame:
    """(a, b, shared, size_a, size_b, linked) of the pairs, by intersecting whole sets."""
    left = pairs.join(sets.select(F.col("class").alias("a"), F.col("set").alias("set_a")), "a")
    both = left.join(sets.select(F.col("class").alias("b"), F.col("set").alias("set_b")), "b").select("a", "b", "set_a", "set_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_py(), U), np.frombuffer(y.as_py(), U)
                short, long = (x, y) if len(x) <= len(y) else (y, x)
                at = np.minimum(np.searchsorted(long, short), len(long) - 1)
                shared = int((long[at] == short).sum())
                out.append((shared, len(x), len(y), threshold.linked(shared, len(x), len(y))))
            shared, a, b, linked = zip(*out, strict=True) if out else ((), (), (), ())
            arrays = [batch.column(0), batch.column(1), *(pa.array(c, pa.int64()) for c in (shared, a, b)), pa.array(linked, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, ["a", "b", "shared", "size_a", "size_b", "linked"])

    return both.mapInArrow(tidy(run), "a long, b long, shared long, size_a long, size_b long, linked boolean")


def _sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(class, size, sketch, prints, set) of the wanted classes, from the text of one document each.

    ``wanted`` has (class, doc_id). The sketch is that of ``parity_sketch``; prints are the first 16 bits of
    every shingle's hash, in order.
    """
    right = wanted.select(F.col("doc_id").alias("__d"), "class")
    picked = docs.join(right, F.col("doc_id").eqNullSafe(F.col("__d"))).select("class", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, off in slices(batch.column(1), SLICE):
                found = []
                for c, s in zip(batch.column(0).slice(lo, hi - lo).to_pylist(), shingle_sets(data, off, k), strict=True):
                    if len(s) and set_class(s) == c:
                        prints = (s >> U(48)).astype("<u2")
                        found.append((c, len(s), parity_sketch(s), prints.tobytes(), s.tobytes()))
                if found:
                    columns = zip(*found, strict=True)
                    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
                    arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, ["class", "size", "sketch", "prints", "set"])

    # Rows that share an id and a text give the same set more than once.
    return picked.mapInArrow(tidy(run), "class long, size long, sketch binary, prints binary, set binary")


def _screened(pairs: DataFrame, sets: DataFrame, threshold: Threshold) -> DataFrame:
    """The pairs (a, b) whose sketches allow a link."""
    left = pairs.join(sets.select(F.col("class").alias("a"), F.col("size").alias("n"), F.col("sketch").alias("x")), "a")
    both = left.join(sets.select(F.col("class").alias("b"), F.col("size").alias("m"), F.col("sketch").alias("y")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)
            differ = np.array([int(np.bitwise_count(x ^ y).sum()) for x, y in map(sketch_rows, both)], np.int64)
            fits = threshold.possible(differ, batch.column(2).to_numpy())
            yield batch.select([0, 1]).filter(pa.array(fits))

    return both.select("a", "b", F.col("n") + F.col("m"), "x", "y").mapInArrow(tidy(run), "a long, b long")


def numbered_prints(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(sorted keys of row, print and how often it came before in the row; prints per row)."""
    data, off = text_buffer(column)
    prints, sizes = data[off[0] : off[-1]].view("<u2").astype(np.int64), np.diff(off) // 2
    keys = np.repeat(np.arange(len(sizes)), sizes) << 48 | prints << 32
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[: len(keys)]
    return keys + np.arange(len(keys)) - np.repeat(first, np.diff(np.append(first, len(keys)))), sizes


def _close(pairs: DataFrame, sets: DataFrame, threshold: Threshold) -> DataFrame:
    """The pairs (a, b) whose prints allow a link.

    Sets share no more shingles than prints, so no link is lost; a quarter of the bytes of whole sets moves.
    """
    left = pairs.join(sets.select(F.col("class").alias("a"), F.col("prints").alias("x")), "a")
    both = left.join(sets.select(F.col("class").alias("b"), F.col("prints").alias("y")), "b").select("a", "b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (x, n), (y, m) = (numbered_prints(batch.column(k)) for k in (2, 3))
            # Keys of one side are distinct, so a key found twice is a shared print.
            keys = np.sort(np.concatenate([x, y]), kind="stable")
            shared = np.bincount(keys[1:][keys[1:] == keys[:-1]] >> 48, minlength=len(n))
            yield batch.select([0, 1]).filter(pa.array(threshold.linked(shared, n, m)))

    return both.mapInArrow(tidy(run), "a long, b long")


def parity_sketch(s: np.ndarray) -> bytes:
    """A bit per hash bucket: whether it holds an odd number of shingles. One bucket per shingle or more."""
    bits = min(max(LEAST_BITS, 1 << (len(s) - 1).bit_length()), MOST_BITS)
    odd = np.bincount((s & U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def sketch_rows(sketches: Sequence[bytes]) -> np.ndarray:
    """Sketches as a matrix of words, folded to the width of the smallest; the halves of a sketch add up to that of half the width."""
    width = min(map(len, sketches), default=8)
    out = np.empty((len(sketches), width // 8), U)
    for k, sketch in enumerate(sketches):
        out[k] = np.bitwise_xor.reduce(np.frombuffer(sketch, U).reshape(-1, width // 8), axis=0)
    return out


class RegionJoin:
    """Pairs of one region that may be linked: recursive Voronoi cells over the Hamming distance of sketches."""

    def __init__(self, names: np.ndarray, roots: np.ndarray, sizes: np.ndarray, sketches: np.ndarray, threshold: Threshold):
        self.names, self.roots, self.sizes = names, roots, sizes
        self.sketches, self.threshold = sketches, threshold
        top = 2 * int(sizes.max())
        self.reach = (threshold.den - threshold.num) * top // (threshold.den + threshold.num)
        self.found: list[np.ndarray] = []
        self.close: list[np.ndarray] = []

    def distances(self, rows: np.ndarray, to: np.ndarray) -> np.ndarray:
        out = np.empty((len(rows), len(to)), np.int32)
        step = max(1, COMPARED // (len(to) * self.sketches.shape[1]))
        for i in range(0, len(rows), step):
            out[i : i + step] = np.bitwise_count(self.sketches[rows[i : i + step]][:, None, :] ^ self.sketches[to][None, :, :]).sum(2, dtype=np.int32)
        return out

    def compare(self, rows: np.ndarray, to: np.ndarray) -> None:
        differ, both = self.distances(rows, to), self.sizes[rows][:, None] + self.sizes[to][None, :]
        fits = self.threshold.possible(differ, both) & (self.roots[rows][:, None] != self.roots[to][None, :])
        x, y = np.nonzero(fits)
        if len(x):
            self.found.append(np.stack([rows[x], to[y]]))
            self.close.append(differ[x, y] / both[x, y])

    def join(self, rows: np.ndarray) -> None:
        if len(rows) > LEAF:
            pivots = rows[:: -(-len(rows) // PIVOTS)]
            far = np.concatenate([self.distances(rows[i : i + LEAF], pivots) for i in range(0, len(rows), LEAF)])
            inside = far <= far.min(1)[:, None] + 2 * self.reach
            if inside.sum(0).max() <= 0.8 * len(rows):
                for q in range(len(pivots)):
                    self.join(rows[inside[:, q]])
                return
        # A small cell, or one that pivots do not split: all its pairs, a few rows at a time.
        for i in range(0, len(rows), 8):
            self.compare(rows[i : i + 8], rows[i:])

    def pairs(self, best: bool) -> np.ndarray:
        """(larger, smaller) classes of the pairs; with ``best`` the closest partner of each member only."""
        self.join(np.arange(len(self.names)))
        if not self.found:
            return np.zeros((2, 0), np.int64)
        pairs = np.concatenate(self.found, axis=1)
        if best:
            close = np.concatenate(self.close)
            ends, twice = pairs.reshape(-1), np.tile(np.arange(len(close)), 2)
            order = np.lexsort((twice, close[twice], ends))
            first = np.concatenate([[True], np.diff(ends[order]) != 0])
            pairs = pairs[:, np.unique(twice[order[first]])]
        a, b = self.names[pairs[0]], self.names[pairs[1]]
        return np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)]), axis=1)


def _region_pairs(open_: DataFrame, sets: DataFrame, threshold: Threshold, parts: int, best: bool) -> DataFrame:
    """Distinct pairs (a, b) of open regions that may be linked; ``best`` as in ``RegionJoin.pairs``.

    Regions with the same hub are joined as one, since copies meet in many regions. Unions above
    ``REGION_ROWS`` members are cut into blocks and joined block against block.
    """
    unions = open_.select("hub", "class", "root").distinct()
    counts = unions.groupBy("hub").agg(F.count(F.lit(1)).alias("members"))
    rows = unions.join(counts, "hub").join(sets.select("class", "size", "sketch"), "class")
    rows = rows.withColumn("blocks", F.ceil(F.col("members") / REGION_ROWS))
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("class", F.lit(1)), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    unit = F.xxhash64("hub", F.least("mine", "other"), F.greatest("mine", "other"))
    rows = rows.select(F.pmod(unit, F.lit(parts)).alias("part"), unit.alias("unit"), "class", "root", "size", "sketch")

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("unit")
        unit, names, roots, sizes = (table.column(c).to_numpy() for c in ("unit", "class", "root", "size"))
        cuts = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1], [True]]))
        found = [np.zeros((2, 0), np.int64)]
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            sketches = sketch_rows(table.column("sketch").slice(a, b - a).to_pylist())
            found.append(RegionJoin(names[a:b], roots[a:b], sizes[a:b], sketches, threshold).pairs(best))
        pairs = np.unique(np.concatenate(found, axis=1), axis=1)
        return pa.table({"a": pairs[0], "b": pairs[1]})

    return rows.groupBy("part").applyInArrow(run, "a long, b long").distinct()


def _open_regions(regions: DataFrame, roots: DataFrame | None, step: int) -> DataFrame:
    """(region, class, root, members, order, hub, hub_root) of the regions that hold several components; of
    regions with the same members one is kept. The hub is a region's first member in an order that changes by step."""
    if roots is None:
        named = regions.select("region", "class", F.col("class").alias("root"))
    else:
        named = regions.join(roots, "class", "left").select("region", "class", F.coalesce("root", "class").alias("root"))
    same = F.bit_xor(F.xxhash64("class")).alias("same")
    hub = F.min(F.struct(F.xxhash64("class", F.lit(step)).alias("order"), F.col("class").alias("hub"), F.col("root").alias("hub_root"))).alias("h")
    state = named.groupBy("region").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("members"), same, hub)
    kept = state.filter("lo <> hi").groupBy("same", "members").agg(F.min(F.struct("region", "h")).alias("k"))
    return named.join(kept.select("k.region", "members", "k.h.order", "k.h.hub", "k.h.hub_root"), "region")


def _hub_pairs(open_: DataFrame) -> DataFrame:
    """One pair (a, b) per class: with the first of its regions' hubs."""
    met = open_.filter("root <> hub_root").groupBy("class").agg(F.min(F.struct("order", "hub")).alias("h"))
    return met.select(F.greatest("class", "h.hub").alias("a"), F.least("class", "h.hub").alias("b")).distinct()


def _roots(links: DataFrame) -> DataFrame:
    return components(links).select(F.col("node").alias("class"), "root")


def class_links(docs: DataFrame, k: int, threshold: Threshold) -> tuple[DataFrame, DataFrame]:
    """(document rows, components of the classes), both from written tables."""
    spark = docs.sparkSession
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Rows hold whole texts, later two whole sets.
    with short_batches(spark):
        rows = materialize(_documents(docs, k), "shingle-docs")
        regions = materialize(_regions(docs, k, threshold, parts).distinct(), "regions")
        wanted = rows.join(regions.select("class").distinct(), "class").groupBy("class").agg(F.min("doc_id").alias("doc_id"))
        with _bucketed(_sets(docs, wanted, k)) as sets:
            return rows, _linked_roots(regions, sets, threshold, parts)


@contextmanager
def _bucketed(sets: DataFrame) -> Iterator[DataFrame]:
    """The sets as a table bucketed by class: each round joins its pairs to it without moving the sets."""
    spark, name = sets.sparkSession, f"shingle_sets_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sets.repartition(n, "class").dropDuplicates(["class"]).write.bucketBy(n, "class").saveAsTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def _linked_roots(regions: DataFrame, sets: DataFrame, threshold: Threshold, parts: int) -> DataFrame:
    """(class, root) of all linked classes, from written tables."""
    open_ = materialize(_open_regions(regions, None, 0), "open-regions")
    links, roots, fresh = None, None, True
    for step in range(HUB_ROUNDS + BEST_ROUNDS + 1):
        last = step == HUB_ROUNDS + BEST_ROUNDS
        if step < HUB_ROUNDS:
            pairs = _screened(_hub_pairs(open_), sets, threshold)
        elif last or fresh:
            pairs = _region_pairs(open_, sets, threshold, parts, best=not last)
        else:
            # The same regions once more: only the last round, with all their pairs, can find others.
            continue
        pairs = materialize(pairs, "pairs")
        fits = pairs if pairs.isEmpty() else materialize(_close(pairs, sets, threshold), "close-pairs")
        linked = fits if fits.isEmpty() else materialize(_measured(fits, sets, threshold).filter("linked").select("a", "b"), "linked")
        fresh = step < HUB_ROUNDS or not linked.isEmpty()
        if not linked.isEmpty():
            links = linked if links is None else links.unionByName(linked)
            roots = _roots(links)
            if not last:
                open_ = materialize(_open_regions(open_.select("region", "class"), roots, step + 1), "open-regions")
        release_shuffles(sets.sparkSession)
    return _roots(linked) if roots is None else roots


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, threshold: Threshold = Threshold()
) -> DataFrame:
    """Per row of ``docs``: the id, ``n_shingles``, ``component_id`` (smallest id reachable by links) and
    ``class`` (identity of the set).

    NULL, empty and wordless texts have no shingles and are their own component. Rows with equal sets
    are linked. NULL ids stay NULL and are never a component's id unless it has no other. An empty table
    gives no rows. Whole texts count. Jobs run when called; intermediates are written tables.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows, roots = class_links(base, k, threshold)
    named = rows.join(roots.withColumnRenamed("class", "__c"), F.col("class") == F.col("__c"), "left").drop("__c")
    named = named.withColumn("root", F.coalesce("root", "class"))
    least = named.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    out = named.join(least, "root", "left").withColumn("component_id", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    return out.select(F.col("doc_id").alias(id_col), "n_shingles", "component_id", "class")


def first_of_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The row of ``docs`` with the smallest id of each component; columns unchanged.

    Of repeated rows of that id one stays; rows without words and rows without an id all stay.
    """
    found = jaccard_components(docs, id_col, text_col, **options)
    firsts = found.filter(F.col(id_col).isNotNull() & (F.col("n_shingles") > 0)).groupBy("component_id").agg(F.min(id_col).alias("__id"))
    keep = firsts.select("__id").unionByName(found.filter("n_shingles = 0").select(F.col(id_col).alias("__id"))).distinct()
    # Rows travel as one column, so their own columns may have any names.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    own = F.col("__row").getField(id_col)
    known = rows.filter(own.isNotNull()).join(keep, own == F.col("__id"), "left_semi")
    order = Window.partitionBy(own).orderBy(F.col("__row").getField(text_col).asc_nulls_last())
    known = known.withColumn("__n", F.row_number().over(order)).filter("__n = 1").drop("__n")
    left = known.unionByName(rows.filter(own.isNull()))
    return left.select(*[F.col("__row").getField(c).alias(c) for c in docs.columns])
