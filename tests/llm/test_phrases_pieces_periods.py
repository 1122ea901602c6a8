"""Collocations, SentencePiece codes and periodic runs: odd rows, brute force, the library."""

import hashlib
import os
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from promoledger.llm import collocations, periods, pieces, queries
from promoledger.session import long_rows, scratch_path

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SCHEMA = "doc_id bigint, text string, lang string, n_tokens int, phrase string, period string, codes string, shard int, word string, size int"
EXTRA = (1, "p", "q", "c", 3, "w", 4)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, *EXTRA) for i, t, lang in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    texts = ["a b c " * 40, "a b c " * 40, None, "", " \t\n\x0b ", "Ünï çødé 😀 wörds ▁ x", "x" * 5000, "in. " * 60, "nul\x00byte " * 30, "one two three"]
    rows = [(k, t, "en" if k % 2 else None) for k, t in enumerate(texts)] + [(None, "a b c " * 40, None), (1, texts[1], "en")]
    return frame(spark, rows)


def collocated(rows, least, top):
    """What the operator returns, by plain counting."""
    n, counts, out = Counter(), {}, []
    for text, lang in rows:
        lang = "und" if lang is None else lang
        f = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update(tuple(w[i : i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        around = Counter()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    around[p[i : i + k]] = max(around[p[i : i + k]], a)
        rows = []
        for p, a in candidates.items():
            if not around[p] or 100 * around[p] < 80 * a:
                score, _, left, right = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top])]
    return sorted(out)


def test_collocations_against_counting(spark, odd):
    rng = random.Random(4)
    words = ["The", "the", "of", "é", "a", "b", "c", "north", "sea", "x", "\x00"]
    rows = [(k, "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", ". ", "\n", ",", "!?"]) for _ in range(rng.randrange(60))), rng.choice(["en", "de", None])) for k in range(150)]
    rows += [(k, "north sea oil of the north sea", "en") for k in range(40)]
    df = frame(spark, rows).repartition(5)
    got = sorted(tuple(r) for r in collocations.mine_collocations(df, least=6, top=50).collect())
    assert got == collocated([(t, lang) for _, t, lang in rows], 6, 50)
    got = sorted(tuple(r) for r in collocations.mine_collocations(odd, shards=2).collect())
    assert got == collocated([(r.text, r.lang) for r in odd.collect()], 30, 2000) and got


def test_collocations_without_words(spark):
    for rows in ([], [(1, None, None), (2, " . ", "en")], [(1, "word", "en")]):
        assert collocations.mine_collocations(frame(spark, rows)).count() == 0


def test_shared_counters_leave_the_result_exact(spark, monkeypatch):
    # With so few bits nearly every phrase is counted.
    monkeypatch.setattr(collocations, "FILTER_BITS", 1 << 6)
    rng = random.Random(5)
    rows = [(k, " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(40)), "en") for k in range(120)]
    got = sorted(tuple(r) for r in collocations.mine_collocations(frame(spark, rows).repartition(4), least=9, top=500).collect())
    assert got == collocated([(t, lang) for _, t, lang in rows], 9, 500)


@pytest.fixture(scope="module")
def codec():
    return pieces.piece_codec()


def test_piece_codes_equal_the_library(codec):
    rng = random.Random(3)
    units = ["a", "the", "ing", " ", "  ", "▁", "\n", "é", "中", "😀", "\x00", ".", "<s>", "<0x41>", "\t", "́", "ß", "2024", "q" * 60, "==="]
    texts = ["".join(rng.choice(units) for _ in range(rng.randrange(30))) for _ in range(4000)] + ["", " ", "x" * 3000, " ".join(f"w{i}" for i in range(5000))]
    ids, bounds = codec.encode_batch(texts)
    lists = [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert lists == codec.library.encode(texts)
    assert codec.decode_batch(ids, bounds) == codec.library.decode(lists) == [codec.decode(x) for x in lists]
    # One agenda of its own gives what the common one gives.
    for text in texts[:500]:
        marked = ("▁" + text).replace(" ", "▁")
        assert codec.merge(marked) == (codec.encode(text) if text else codec.merge("▁"))


def test_any_ids_decode_as_the_library_does(codec):
    rng = random.Random(6)
    for _ in range(4000):
        ids = [rng.choice([0, 1, 2, rng.randrange(3, 259), rng.randrange(3, 259), rng.randrange(32000), 28705, 259]) for _ in range(rng.randrange(8))]
        assert codec.decode(ids) == codec.library.decode(ids)


def test_full_caches_change_nothing(codec, monkeypatch):
    monkeypatch.setattr(pieces, "CACHED_PARTS", 4)
    fresh = pieces.PieceCodec(pieces.public_tokenizers.path(pieces.MODEL))
    texts = [f"some words {i} and more {i % 7}" for i in range(50)]
    assert [fresh.encode(t) for t in texts] == codec.library.encode(texts) and len(fresh.known) <= 4


def test_only_the_last_counters_stay(spark, monkeypatch):
    dropped, written = [], []
    drop, path = collocations.discard, collocations.scratch_path
    monkeypatch.setattr(collocations, "discard", lambda session, p: (dropped.append(p), drop(session, p)))
    monkeypatch.setattr(collocations, "scratch_path", lambda session, label: (written.append((label, path(session, label))), written[-1][1])[1])
    docs = spark.createDataFrame([(i, "a b c a b", "en") for i in range(40)], "doc_id bigint, text string, lang string")
    collocations.mine_collocations(docs).collect()
    counters = [p for label, p in written if label == "counters"]
    assert len(counters) > 1 and dropped == counters[:-1]


def test_shards_go_before_phrases_are_summed(spark, monkeypatch):
    left, path, write, paths = {}, collocations.scratch_path, collocations.materialize, []
    monkeypatch.setattr(collocations, "scratch_path", lambda session, label: (paths.append((label, path(session, label))), paths[-1][1])[1])
    monkeypatch.setattr(collocations, "materialize", lambda df, label: (left.update({label: [os.path.exists(p) for k, p in paths if k == "word-shards"]}), write(df, label))[1])
    docs = spark.createDataFrame([(i, "a b c a b", "en") for i in range(40)], "doc_id bigint, text string, lang string")
    assert collocations.mine_collocations(docs).count() > 0
    assert left["words"] == [True] and left["phrases"] == [False]


def test_shards_take_less_than_their_codes(spark, tmp_path):
    rng = np.random.default_rng(12)
    names = np.array([f"w{k}" for k in range(4000)])
    texts = [" ".join(names[np.minimum(rng.zipf(1.3, 1000), 4000) - 1]) + "." for _ in range(300)]
    table = collocations.write_shards(frame(spark, [(k, t, "en") for k, t in enumerate(texts)]).coalesce(1), path=f"{tmp_path}/shards")
    written = sum(p.stat().st_size for p in tmp_path.rglob("*.parquet"))
    row = table.first()
    word = pa.array([w.word for w in row.words], pa.binary())
    raw = pa.scalar(bytes(row.codes), pa.binary())
    codes = collocations._coded(raw, collocations._word_codes(word, collocations._seed("en")))
    # What the row stands for, spelt again: every word in its place, 0 after each text.
    spelt = dict(zip(collocations._word_codes(word, collocations._seed("en")).tolist(), word.to_pylist(), strict=True)) | {0: b"."}
    assert [spelt[c] for c in codes.tolist()] == " ".join(texts).replace(".", " .").encode().split()
    assert 10 * written < 7 * len(pa.compress(codes.tobytes(), "zstd", asbytes=True))


def test_frequent_words_are_summed_before_the_second_cycle(spark, monkeypatch):
    seen, path = [], collocations.scratch_path
    monkeypatch.setattr(collocations, "scratch_path", lambda session, label: (seen.append(label), path(session, label))[1])
    write = collocations.materialize
    monkeypatch.setattr(collocations, "materialize", lambda df, label: (seen.append(label), write(df, label))[1])
    docs = spark.createDataFrame([(i, "a b c a b", "en") for i in range(40)], "doc_id bigint, text string, lang string")
    collocations.mine_collocations(docs, shards=1).collect()
    assert seen.index("words") < seen.index("phrase-counts")


def test_phrase_counts_are_packed_small(spark):
    rng = np.random.default_rng(11)
    words = rng.integers(1, 1 << 63, 300).astype(np.uint64)
    rows = np.unique(words[rng.integers(0, 300, (20000, 3))], axis=0)
    # In the order of their hashes, as a scan has them.
    rows = rows[rng.permutation(len(rows))]
    counts = rng.integers(1, 9, len(rows))
    phrases, n = (pa.scalar(x, pa.binary()) for x in collocations._packed(rows, counts))
    back, found = collocations._unpacked(phrases, n, 3)
    assert dict(zip(map(tuple, back.tolist()), found.tolist(), strict=True)) == dict(zip(map(tuple, rows.tolist()), counts.tolist(), strict=True))
    plain = len(pa.compress(rows.tobytes() + counts.tobytes(), "snappy", asbytes=True))
    assert 2 * sum(len(pa.compress(x.as_py(), "zstd", asbytes=True)) for x in (phrases, n)) < plain


def test_known_parts_hold_the_ids_of_new_and_old_parts():
    rng, known, kept = np.random.default_rng(3), pieces.KnownParts(), {}
    for _ in range(6):
        keys = np.setdiff1d(rng.integers(0, 1 << 62, 50).astype(np.uint64), known.keys)
        rows = [rng.integers(0, 1000, int(n)).tolist() for n in rng.integers(0, 5, len(keys))]
        known.add(keys, np.array(sum(rows, []), np.int64), np.array([len(r) for r in rows], np.int64))
        kept |= dict(zip(keys.tolist(), rows, strict=True))
        every = np.sort(np.array(list(kept), np.uint64))
        at, there = known.find(every)
        ids, ends = pieces.ragged(known.ids, known.starts[at], known.sizes[at])
        assert there.all() and not known.find(np.array([1 << 63], np.uint64))[1].any()
        assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)] == [kept[k] for k in every.tolist()]
    known.shorten(10)
    at, there = known.find(every)
    assert 10 <= len(known) < 50 and there.sum() == len(known)
    ids, ends = pieces.ragged(known.ids, known.starts[at[there]], known.sizes[at[there]])
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)] == [kept[k] for k in every[there].tolist()]


def test_short_long_and_unknown_parts_in_one_batch(codec):
    fresh = pieces.PieceCodec(pieces.public_tokenizers.path(pieces.MODEL))
    texts = ["one two", "", "x" * 90 + " one", "\x01\U0001f600 two 漢字" * 3, "q" * 49, "a  b   c ", "z" * 48 + "\u0378"] * 2
    for some in (texts[:4], texts, texts[4:]):
        ids, bounds = fresh.encode_batch(some)
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == codec.library.encode(some)


def test_encode_pieces_odd_rows(spark, odd, codec):
    rows = pieces.encode_pieces(odd).collect()
    assert len(rows) == odd.count() and all(r.matches_library for r in rows)
    by_text = Counter()
    for r in odd.collect():
        ids = codec.library.encode(r.text or "")
        text = codec.library.decode(ids)
        by_text[(r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), text)] += 1
    assert by_text == Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, r.decoded) for r in rows)
    assert pieces.encode_pieces(frame(spark, [])).count() == 0


def runs_of(words):
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(24, 3 * q) and not any(all(words[x] == words[x + d] for x in range(i, i + size - d)) for d in range(1, q)):
                out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(doc_id, text, planted):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    order = periods.planted_order(doc_id, len(words)) if planted else None
    words = words if order is None else [words[i] for i in order.tolist()]
    runs, drop = runs_of(words), set()
    for s, size, q in runs:
        drop.update(range(s + q, s + size))
    best = min(runs, key=lambda r: (-(r[1] * 10**12 // r[2]), r[0], r[2])) if runs else (None, None, None)
    kept = " ".join(w for k, w in enumerate(words) if k not in drop)
    listed = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_periods_against_brute_force(spark, odd):
    rng = random.Random(2)
    rows = []
    for i in range(120):
        words = []
        for _ in range(rng.randrange(5)):
            base = [rng.choice("abcde") if rng.random() < 0.5 else f"w{rng.randrange(40)}" for _ in range(rng.randrange(1, 13))]
            words += base * rng.randrange(1, 7) + base[: rng.randrange(len(base) + 1)]
        rows.append((i, " ".join(words), "en"))
    df = frame(spark, rows).unionByName(odd)
    for planted in (False, True):
        got = Counter(tuple(r) for r in periods.collapse_periodic_runs(df, planted=planted).collect())
        assert got == Counter(collapsed(r.doc_id, r.text, planted) for r in df.collect())
    assert periods.collapse_periodic_runs(frame(spark, [])).count() == 0


def test_planted_order_follows_the_definition():
    import zlib

    hit = next(i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0)
    g, n = zlib.crc32(str(hit).encode()) // 10, 57
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    assert periods.planted_order(hit, n).tolist() == [i if i < a else a + (i - a) % p for i in range(n)]
    assert periods.planted_order(None, 5) is None and periods.planted_order(hit, 0) is None


def test_long_runs_are_found_in_reasonable_time():
    assert periods.lag_scan(np.zeros(100_000, np.int64)) == [(0, 100_000, 1)]
    assert periods.lag_scan(np.tile(np.arange(1000), 50)) == [(0, 50_000, 1000)]


@needs_tables
def test_queries_return_a_row_per_document(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: tuple(r) for r in queries.op13_periods(spark, SF).collect()}
    assert all(got[r.doc_id] == collapsed(r.doc_id, r.text, True) for r in docs.filter(F.col("doc_id") % 9 == 0).filter(F.length("text") < 4000).collect())
    codes = queries.op12_pieces(spark, SF)
    assert len(got) == docs.count() == codes.filter("matches_library").count()
    assert codes.columns[:4] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_long_rows_are_read_and_sent_a_few_at_once(spark, monkeypatch):
    monkeypatch.setattr(collocations, "scratch_path", lambda session, label: path)
    path = scratch_path(spark, "long")
    rows = spark.range(0, 40, 1, 1).select(F.col("id"), F.expr("cast(repeat(cast(id as string), 200000) as binary)").alias("x"))
    table, _ = collocations._written(rows, "long")
    jvm = spark.sparkContext._jvm
    file = jvm.org.apache.hadoop.fs.Path(next(p for p in table.inputFiles() if "part-" in p))
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(file, spark.sparkContext._jsc.hadoopConfiguration()))
    pages = [reader.readOffsetIndex(c).getPageCount() for c in reader.getFooter().getBlocks().get(0).getColumns()]
    reader.close()
    # Before, one page of all 40 rows.
    assert min(pages) >= 10

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    with long_rows(spark):
        n = [r.n for r in table.mapInArrow(sizes, "n bigint").collect()]
    assert sum(n) == 40 and max(n) * 400_000 <= 1 << 23
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before


def test_every_scan_has_short_batches(spark, monkeypatch):
    seen, write = [], collocations._written
    keys = ("spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    monkeypatch.setattr(collocations, "_written", lambda df, label: (seen.append(tuple(int(spark.conf.get(k).rstrip("b")) for k in keys)), write(df, label))[1])
    docs = spark.createDataFrame([(i, "a b c a b", "en") for i in range(40)], "doc_id bigint, text string, lang string")
    assert collocations.mine_collocations(docs).count() > 0
    assert len(seen) > 3 and max(a for a, _ in seen) <= 1 << 22 and max(b for _, b in seen) <= 4


def test_counting_a_lot_does_not_keep_it_beside_its_copies():
    rng = np.random.default_rng(4)
    rows = rng.integers(1, 300, (300_000, 2)).astype(np.uint64)
    lots = np.array_split(rows, 30)
    columns, hashes = [[np.ascontiguousarray(x[:, j]) for x in lots] for j in range(2)], [collocations._phrase_hash([x[:, 0], x[:, 1]]) for x in lots]
    del lots
    tracemalloc.start()
    phrases, counts = collocations._counted(columns, hashes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    want = Counter(map(tuple, rows.tolist()))
    assert dict(zip(map(tuple, phrases.tolist()), counts.tolist(), strict=True)) == want
    # Lots are let go as they are copied: order, rows and one word's lots (before, all lots and the hashes too).
    assert not any(columns) and not hashes and peak < 6.5 * 8 * len(rows)
