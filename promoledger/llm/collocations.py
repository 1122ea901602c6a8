"""Phrase collocations by dynamic itemset counting over cyclic shard scans.

The words of the documents are written once as shards: each row has its distinct words, the most frequent
first, and all its words as numbers of these; 64-bit codes are hashed from the words when a row is read.
Shards are scanned one after the other, round and round. The first cycle counts single words; a longer phrase joins the count as soon as
both phrases it consists of, without its last and without its first word, have reached the threshold in
what was scanned so far, and leaves it after one full cycle. So lengths interleave, and a phrase that
reaches the threshold in all documents is counted in all of them exactly once per shard.

Which phrases have reached the threshold is decided by counters that phrases share by hash. A shared
counter is never behind, so no phrase starts too late; starting one too early costs a count that the
exact sum at the end drops. The counters lie in parts that Spark groups and updates after each scan; a
scan gets one bit per few counters, an array sized from the number of words up to ``FILTER_BITS``.
Beyond that size more phrases are counted than need be, with the same result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promoledger.llm.kernels import LOWER, RangeHash, U, combine, mix, slices, text_buffer, tidy
from promoledger.session import LONG_ROW_PAGES, discard, long_rows, materialize, release_shuffles, retire, scratch_path, scratch_scope

SHARDS, LONGEST, LEAST_COUNT, SUPPORT_PERCENT, TOP, SCALE = 3, 4, 30, 80, 2000, 2_000_000
# Words of a written row, words of phrases counted at once, counters of a part (a power of two), bits of the largest filter; bytes of text at once, phrases of a written row.
ROW_WORDS, HELD_PHRASES, PART_BITS, FILTER_BITS = 1 << 19, 1 << 22, 18, 1 << 29
SLICE, ROW_PHRASES = 1 << 19, 1 << 16
_BLANK = np.zeros(256, bool)
_BLANK[[9, 32]] = True
_CUT = np.zeros(256, bool)
_CUT[list(b".,;:!?\n\x0b\x0c\r")] = True
_WORDS = "struct<word:binary,n:bigint>"


def _words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row, piece) of every word; pieces are numbered over all rows."""
    n = len(data)
    cut = _CUT[data]
    word = ~(_BLANK[data] | cut)
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    starts = np.flatnonzero(word & (edge[:-1] | ~np.concatenate([[False], word[:-1]])))
    ends = np.flatnonzero(word & (edge[1:] | ~np.concatenate([word[1:], [False]]))) + 1
    border = np.cumsum(cut | edge[:-1])
    return starts, ends, np.searchsorted(off, starts, "right") - 1, border[starts]


class _Shelf:
    """Words of one language waiting to be written."""

    def __init__(self):
        self.numbers: dict[int, int] = {}
        self.spelling: list[bytes] = []
        self.words: list[np.ndarray] = []
        self.phrases: list[np.ndarray] = []
        self.n_words = 0

    def add(self, codes: np.ndarray, pieces: np.ndarray, text: bytes, starts: np.ndarray, ends: np.ndarray) -> None:
        self.n_words += len(codes)
        distinct, first, inverse = np.unique(codes, return_index=True, return_inverse=True)
        # Words are numbered from 1 as they come.
        for code, k in zip(distinct.tolist(), first.tolist(), strict=True):
            if code not in self.numbers:
                self.spelling.append(text[starts[k] : ends[k]])
                self.numbers[code] = len(self.spelling)
        numbers = np.array([self.numbers[code] for code in distinct.tolist()], "<u4")[inverse]
        self.words.append(numbers)
        # Single words have no phrase; 0 ends a piece.
        follows = pieces[1:] == pieces[:-1]
        shared = np.zeros(len(codes), bool)
        shared[1:] |= follows
        shared[:-1] |= follows
        numbers, pieces = numbers[shared], pieces[shared]
        breaks = np.flatnonzero(pieces[1:] != pieces[:-1]) + 1
        self.phrases += [np.insert(numbers, breaks, 0), np.zeros(1, "<u4")]

    def row(self, lang: str, shard: int) -> pa.RecordBatch:
        counts = np.bincount(np.concatenate(self.words), minlength=len(self.spelling) + 1)[1:]
        order = np.argsort(-counts, kind="stable")
        words = pa.array([self.spelling[k] for k in order.tolist()], pa.binary())
        words = pa.StructArray.from_arrays([words, pa.array(counts[order])], ["word", "n"])
        words = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)
        phrases = pa.array([_numbered(np.concatenate(self.phrases), order)], pa.binary())
        columns = [pa.array([shard], pa.int32()), pa.array([lang]), phrases, pa.array([self.n_words]), words]
        return pa.RecordBatch.from_arrays(columns, ["shard", "lang", "codes", "n_words", "words"])


def _numbered(phrases: np.ndarray, order: np.ndarray) -> bytes:
    """Words by their places in ``order`` from 1, 0 where a piece ends: all low bytes first, which compresses well."""
    place = np.zeros(len(order) + 1, "<u4")
    place[order + 1] = np.arange(1, len(order) + 1)
    return np.ascontiguousarray(place[phrases].view(np.uint8).reshape(-1, 4).T).tobytes()


def _coded(raw: pa.Scalar, codes: np.ndarray) -> np.ndarray:
    """The codes of a row's words in their order, 0 where a piece ends, from ``_numbered``."""
    numbers = np.ascontiguousarray(np.frombuffer(raw.as_buffer(), np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)
    return np.concatenate([np.zeros(1, U), codes])[numbers]


def _word_codes(words: pa.Array, seeds: int | np.ndarray) -> np.ndarray:
    """64-bit codes of words of the languages with these seeds; 0 is none."""
    data, off = text_buffer(words)
    data = data[off[0] : off[-1]]
    off = off - off[0]
    return np.maximum(combine([np.broadcast_to(np.asarray(seeds, U), len(words)), RangeHash(data)(off[:-1], off[1:])]), U(1))


def write_shards(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", shards: int = SHARDS, path: str | None = None) -> DataFrame:
    """The documents' words as rows (shard, lang, codes, n_words, words), written once, a folder per shard."""
    schema = f"shard int, lang string, codes binary, n_words bigint, words array<{_WORDS}>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shelves: dict[str, _Shelf] = {}
        turn, held = TaskContext.get().partitionId(), 0

        def flush(langs: list[str]) -> Iterator[pa.RecordBatch]:
            nonlocal turn, held
            for lang in langs:
                shelf = shelves.pop(lang)
                held -= shelf.n_words
                yield shelf.row(lang, turn % shards)
                turn += 1

        for batch in batches:
            for lo, hi, data, off in slices(batch.column(0), SLICE):
                data, langs = LOWER[data], batch.column(1)[lo:hi].dictionary_encode()
                starts, ends, row, piece = _words(data, off)
                if not len(starts):
                    continue
                hashes, text = RangeHash(data)(starts, ends), data.tobytes()
                names = langs.dictionary.to_pylist()
                of_row = langs.indices.to_numpy(zero_copy_only=False)
                seeds = np.array([_seed(n) for n in names], U)
                lang = of_row[row]
                codes = np.maximum(combine([seeds[lang], hashes]), U(1))
                order = np.argsort(lang, kind="stable")
                bounds = np.searchsorted(lang[order], np.arange(len(names) + 1))
                for k, name in enumerate(names):
                    at = order[bounds[k] : bounds[k + 1]]
                    if len(at):
                        shelves.setdefault(name, _Shelf()).add(codes[at], piece[at], text, starts[at], ends[at])
                        held += len(at)
                yield from flush([n for n, shelf in shelves.items() if shelf.n_words >= ROW_WORDS])
                if held >= 2 * ROW_WORDS:
                    yield from flush(list(shelves))
        yield from flush(list(shelves))

    path = path or scratch_path(docs.sparkSession, "word-shards")
    rows = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang")).mapInArrow(tidy(run), schema)
    rows.write.partitionBy("shard").options(compression="zstd", **LONG_ROW_PAGES).parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def _seed(lang: str) -> int:
    raw = np.frombuffer(lang.encode(), np.uint8)
    return int(RangeHash(raw)(np.array([0]), np.array([len(raw)]))[0])


class Filter:
    """Which counters have reached the threshold: one bit for ``2**wide`` counters of ``2**bits`` in all."""

    def __init__(self, bits: int, wide: int, raw: bytes):
        self.bits, self.wide, self.raw = bits, wide, raw

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        at = (hashes >> U(64 - self.bits + self.wide)).astype(np.int64)
        return (np.frombuffer(self.raw, np.uint8)[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def _phrase_hash(codes: list[np.ndarray]) -> np.ndarray:
    """Hash of phrases from the codes of their words; it begins with the counter's number."""
    return mix(combine(codes) + U(len(codes) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))


def _counted(columns: list[list[np.ndarray]], hashes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct phrases (a row each) and how often they occur; phrases that share a hash stay apart.

    ``columns`` has the lots of each word, ``hashes`` those of the phrases; both are empty afterwards, so that
    the lots don't lie beside their copies.
    """
    joined = np.concatenate(hashes)
    hashes.clear()
    order = np.argsort(joined, kind="stable")
    del joined
    rows = np.empty((len(order), len(columns)), U)
    for j, lots in enumerate(columns):
        rows[:, j] = np.concatenate(lots)[order]
        lots.clear()
    edge = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)]))
    return rows[edge], np.diff(np.append(edge, len(rows)))


def _packed(phrases: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """Phrases (a row each) by their first word, word after word, so that equal codes lie close for the compression."""
    order = np.argsort(phrases[:, 0], kind="stable")
    return np.ascontiguousarray(phrases[order].T).tobytes(), counts[order].astype("<u4").tobytes()


def _unpacked(phrases: pa.Scalar, counts: pa.Scalar, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Phrases (a row each) and their counts, from ``_packed``."""
    return np.frombuffer(phrases.as_buffer(), U).reshape(k, -1).T, np.frombuffer(counts.as_buffer(), "<u4").astype(np.int64)


def _scan(shard: DataFrame, reached: Filter, before: Filter | None, longest: int) -> DataFrame:
    """Phrases of two words and more to be counted in this scan: (lang, size, phrases, counts) per task and lot.

    ``before`` is the filter of the scan of this shard one cycle ago, which counted what that filter let through.
    """
    sc = shard.sparkSession.sparkContext
    now, then = sc.broadcast(reached), sc.broadcast(before) if before else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # By language and length the lots of each word, at the end those of the hashes.
        held: dict[tuple[str, int], list[list[np.ndarray]]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal size
            for lang, k in list(held):
                *columns, hashes = held.pop((lang, k))
                phrases, counts = _counted(columns, hashes)
                for lo in range(0, len(counts), ROW_PHRASES):
                    blobs = _packed(phrases[lo : lo + ROW_PHRASES], counts[lo : lo + ROW_PHRASES])
                    yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([k], pa.int32()), *(pa.array([x], pa.binary()) for x in blobs)], ["lang", "size", "phrases", "counts"])
            size = 0

        for batch in batches:
            for lang, raw, words in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                codes = _coded(raw, _word_codes(words.values, _seed(lang)))
                # Per start, while the phrase lies in one piece: both of its parts let through now, and one cycle ago.
                whole = codes != 0
                part = _phrase_hash([codes])
                passes = now.value(part) & whole
                passed = then.value(part) & whole if then else np.zeros(len(codes), bool)
                for k in range(2, longest + 1):
                    n = len(codes) - k + 1
                    if n < 1:
                        break
                    whole = whole[:n] & (codes[k - 1 :] != 0)
                    count = np.flatnonzero(whole & passes[:n] & passes[1 : n + 1] & ~(passed[:n] & passed[1 : n + 1]))
                    columns = [codes[j : j + n] for j in range(k)]
                    part = _phrase_hash(columns)
                    if len(count):
                        for lots, c in zip(held.setdefault((lang, k), [[] for _ in range(k + 1)]), [*columns, part], strict=True):
                            lots.append(c[count])
                        size += len(count) * k
                    passes = now.value(part) & whole
                    passed = then.value(part) & whole if then else np.zeros(n, bool)
                if size >= HELD_PHRASES:
                    yield from flush()
        yield from flush()

    return shard.select("lang", "codes", "words.word").mapInArrow(tidy(run), "lang string, size int, phrases binary, counts binary")


def _places(phrases: np.ndarray, counts: np.ndarray, bits: int, least: int) -> pa.RecordBatch:
    """What phrases (a row each) add to their counters: a row per part."""
    part_bits = min(PART_BITS, bits)
    slot = (_phrase_hash([np.ascontiguousarray(c) for c in phrases.T]) >> U(64 - bits)).astype(np.int64)
    order = np.argsort(slot, kind="stable")
    slot, n = slot[order], np.minimum(counts[order], least).astype(np.uint8)
    parts, first = np.unique(slot >> part_bits, return_index=True)
    ends = np.append(first[1:], len(slot))
    places = (slot & ((1 << part_bits) - 1)).astype(np.uint32)
    columns = [[x[a:b].tobytes() for a, b in zip(first, ends, strict=True)] for x in (places, n)]
    return pa.RecordBatch.from_arrays([pa.array(parts), *(pa.array(c, pa.binary()) for c in columns)], ["part", "places", "counts"])


def _raise_counters(counters: DataFrame | None, words: DataFrame | None, phrases: DataFrame | None, bits: int, least: int) -> DataFrame:
    """Counters (part, counts) after adding the words and phrases of a scan; a counter stops at the threshold."""
    part_bits = min(PART_BITS, bits)

    def of_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, found in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                codes = _word_codes(found.values.field("word"), _seed(lang))
                yield _places(codes.reshape(-1, 1), found.values.field("n").to_numpy(zero_copy_only=False), bits, least)

    def of_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, found, counts in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                yield _places(*_unpacked(found, counts, k), bits, least)

    def add(table: pa.Table) -> pa.Table:
        total, places, more = np.zeros(1 << part_bits, np.int64), [], []
        for place, counts in zip(table.column("places"), table.column("counts"), strict=True):
            n = np.frombuffer(counts.as_buffer(), np.uint8)
            if place.is_valid:
                places.append(np.frombuffer(place.as_buffer(), np.uint32))
                more.append(n)
            else:
                total += n
        if places:
            total += np.bincount(np.concatenate(places), np.concatenate(more), len(total)).astype(np.int64)
        return pa.table([table.column("part").slice(0, 1), pa.array([np.minimum(total, least).astype(np.uint8).tobytes()], pa.binary())], ["part", "counts"])

    schema, rows = "part long, places binary, counts binary", []
    if words is not None:
        rows.append(words.select("lang", "words").mapInArrow(tidy(of_words), schema))
    if phrases is not None:
        rows.append(phrases.select("size", "phrases", "counts").mapInArrow(tidy(of_phrases), schema))
    if counters is not None:
        rows.append(counters.select("part", F.lit(None).cast("binary").alias("places"), "counts"))
    return reduce(DataFrame.unionByName, rows).groupBy("part").applyInArrow(add, "part long, counts binary")


def _filter(counters: DataFrame, bits: int, wide: int, least: int) -> Filter:
    """One bit for each ``2**wide`` counters, put together on the driver: at most ``FILTER_BITS`` in all."""
    part_bits = min(PART_BITS, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = [np.packbits((np.frombuffer(c.as_buffer(), np.uint8) >= least).reshape(-1, 1 << wide).any(axis=1)).tobytes() for c in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bit, pa.binary())], ["part", "bit"])

    size = 1 << part_bits - wide - 3
    raw = bytearray(1 << bits - wide - 3)
    for row in counters.select("part", "counts").mapInArrow(tidy(run), "part long, bit binary").toLocalIterator():
        raw[row.part * size : (row.part + 1) * size] = row.bit
    return Filter(bits, wide, bytes(raw))


def _written(rows: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Rows of a scan, written once and compressed well, and their path."""
    path = scratch_path(rows.sparkSession, label)
    rows.write.options(compression="zstd", **LONG_ROW_PAGES).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path), path


def _frequent_words(shards: DataFrame, reached: Filter, least: int) -> DataFrame:
    """Words with ``least`` occurrences or more: lang, code, word, n. All words must be in the filter's counters."""
    known_by = shards.sparkSession.sparkContext.broadcast(reached)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, words in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                word, n = words.values.field("word"), words.values.field("n")
                keep = pa.array(known_by.value(_phrase_hash([_word_codes(word, _seed(lang))])))
                columns = [word.filter(keep), n.filter(keep)]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(columns[0]), pa.string()), *columns], ["lang", "word", "n"])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).dictionary_encode()
            seeds = np.array([_seed(name) for name in names.dictionary.to_pylist()], U)[names.indices.to_numpy(zero_copy_only=False)]
            codes = pa.array(_word_codes(batch.column(1), seeds).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), codes, batch.column(1), batch.column(2)], ["lang", "code", "word", "n"])

    # The code follows from language and word, so it need not move.
    words = shards.select("lang", "words").mapInArrow(tidy(known), "lang string, word binary, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = words.filter(F.col("n") >= least).mapInArrow(tidy(coded), "lang string, code bigint, word binary, n bigint")
    words = materialize(words.withColumn("word", F.col("word").cast("string")), "words")
    if words.groupBy("code").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").head():
        raise ValueError("two frequent words share a 64-bit code")
    return words


def count_phrases(shards: DataFrame, least: int = LEAST_COUNT, longest: int = LONGEST, scanned: Callable[[], None] | None = None) -> tuple[DataFrame, DataFrame]:
    """(words, phrases): all words and phrases with ``least`` occurrences or more.

    Words have ``lang``, ``code``, ``word``, ``n``; phrases ``lang``, ``phrase`` (codes of two words or more), ``n``.
    ``scanned`` is called when nothing reads the shards any more, before the phrases are summed.
    """
    spark = shards.sparkSession
    if not 1 <= least <= 255:
        raise ValueError("the threshold lies between 1 and 255")
    n_words, n_shards = shards.agg(F.coalesce(F.sum("n_words"), F.lit(0)), F.coalesce(F.max("shard"), F.lit(0)) + 1).first()
    bits = max(12, (n_words // 4).bit_length())
    wide = max(2, bits - FILTER_BITS.bit_length() + 1)
    counters, counters_path, counted = None, "", []
    filters = [Filter(bits, wide, bytes(1 << bits - wide - 3))]
    # A scan after this point would count what the last cycle has counted.
    while (step := len(filters) - 1) < n_shards or filters[step].raw != filters[step - n_shards].raw:
        shard = shards.filter(F.col("shard") == step % n_shards)
        new = shard if step < n_shards else None
        short = None
        before = filters[step - n_shards] if step >= n_shards else None
        if any(filters[step].raw):
            counted.append(_written(_scan(shard, filters[step], before, longest), "phrase-counts")[0])
            # Phrases of full length start no others.
            short = counted[-1].filter(F.col("size") < longest)
        if new is not None or short is not None:
            raised, path = _written(_raise_counters(counters, new, short, bits, least), "counters")
            if counters is not None:
                discard(spark, counters_path)
            counters, counters_path = raised, path
        filters.append(_filter(counters, bits, wide, least))
        # What moved in this scan is no longer read.
        release_shuffles(spark)
        if step == n_shards - 1:
            # All words are in the counters now, and few phrases are written yet.
            words = _frequent_words(shards, filters[-1], least)
            release_shuffles(spark)
    if scanned:
        scanned()
    if not counted:
        return words, spark.createDataFrame([], "lang string, phrase array<bigint>, n bigint")
    last = spark.sparkContext.broadcast(filters[-1])

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Phrases whose shared counter has reached the threshold; those of full length all."""
        for batch in batches:
            for lang, k, phrases, counts in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                rows, n = _unpacked(phrases, counts, k)
                if k < longest:
                    keep = last.value(_phrase_hash([np.ascontiguousarray(rows[:, j]) for j in range(k)]))
                    rows, n = rows[keep], n[keep]
                if len(rows):
                    phrase = pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, k), pa.int32()), pa.array(np.ascontiguousarray(rows).reshape(-1).view(np.int64)))
                    yield pa.RecordBatch.from_arrays([pa.array([lang.as_py()] * len(rows), pa.string()), phrase, pa.array(n)], ["lang", "phrase", "n"])

    phrases = reduce(DataFrame.unionByName, counted).mapInArrow(tidy(often), "lang string, phrase array<bigint>, n bigint").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    return words, materialize(phrases.filter(F.col("n") >= least), "phrases")


def _scored(words: DataFrame, phrases: DataFrame) -> DataFrame:
    """Candidates with their lowest-scoring cut: lang, phrase, a, l, r, score. Products are exact decimals."""
    whole = F.lit(SCALE).cast("decimal(38,0)")
    parts = words.select(F.array("code").alias("part"), F.col("n")).unionByName(phrases.select(F.col("phrase").alias("part"), "n"))
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("phrase") - 1)))
    cuts = cuts.withColumn("head", F.slice("phrase", F.lit(1), F.col("k"))).withColumn("tail", F.slice("phrase", F.col("k") + 1, F.size("phrase") - F.col("k")))
    cuts = cuts.join(parts.select(F.col("part").alias("head"), F.col("n").alias("l")), "head").join(parts.select(F.col("part").alias("tail"), F.col("n").alias("r")), "tail")
    cuts = cuts.withColumn("whole", whole).withColumn("score", F.expr("(whole * cast(n as decimal(19,0))) div (cast(l as decimal(19,0)) + r)"))
    best = cuts.groupBy("phrase").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.first("lang").alias("lang"), F.first("n").alias("a"))
    return best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def mine_collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST_COUNT, top: int = TOP, support_percent: int = SUPPORT_PERCENT, shards: int = SHARDS, longest: int = LONGEST
) -> DataFrame:
    """The first ``top`` collocations of each language: lang, rank, phrase, a, l, r, n, score.

    ``n`` counts a language's words, ``a`` the phrase, ``l`` and ``r`` the parts of its lowest-scoring cut. A
    NULL text has no words, as an empty one; a NULL language is ``und``; rows that repeat count each; a
    table without words gives no rows. Equal scores go by ``a``, then by the phrase in byte order. Further
    columns are not read. Intermediates are deleted but for the result.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "collocations")
    with scratch_scope(spark):
        shard_path = scratch_path(spark, "word-shards")

        def scanned() -> None:
            # The shards go before the phrases move.
            retire(spark, shard_path)

        with long_rows(spark):
            table = write_shards(docs, text_col, lang_col, shards, shard_path)
            totals = materialize(table.groupBy("lang").agg(F.sum("n_words").alias("n")), "totals")
            words, phrases = count_phrases(table, least, longest, scanned)
        scored = _scored(words, phrases)
        # The most frequent longer phrase around each.
        longer = phrases.filter(F.size("phrase") > 2).withColumn("k", F.explode(F.sequence(F.lit(2), F.size("phrase") - 1)))
        longer = longer.withColumn("at", F.explode(F.sequence(F.lit(1), F.size("phrase") - F.col("k") + 1)))
        longer = longer.groupBy(F.slice("phrase", F.col("at"), F.col("k")).alias("phrase")).agg(F.max("n").alias("around"))
        kept = scored.join(longer, "phrase", "left").filter("around is null or cast(100 as decimal(38,0)) * around < cast(%d as decimal(38,0)) * a" % support_percent)
        order = [F.desc("score"), F.desc("a")]
        first = kept.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("place") <= top)
        # Words only for these: the rank keeps ties, which the phrase then decides.
        spelt = first.select("lang", "phrase", "a", "l", "r", "score", F.posexplode("phrase").alias("at", "code")).join(words.select("code", "word"), "code")
        spelt = spelt.groupBy("lang", F.col("phrase").alias("codes"), "a", "l", "r", "score").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("spelt"))
        spelt = spelt.withColumn("phrase", F.concat_ws(" ", "spelt.word"))
        ranked = spelt.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, F.asc("phrase")))).filter(F.col("rank") <= top)
        result = ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
        result.write.parquet(path)
    return spark.read.schema(result.schema).parquet(path)
