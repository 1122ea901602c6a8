"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding keeps an agenda of adjacent symbol pairs ordered by the score of the piece they form, the
leftmost first among equals; the best pair merges, and the pairs it forms with its neighbours join the
agenda. Symbols left over that are no piece fall back to their UTF-8 bytes. No piece spans two characters
that are neighbours in no piece, so a text is cut there, and the ids of recent parts are kept by a 64-bit
hash. The new short parts of a batch keep their agendas in common arrays: a round takes the first entry of each.
Each Arrow batch is compared with the sentencepiece library, ids and decoded texts alike.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promoledger.llm.kernels import RangeHash, U, slices

MODEL, CACHED_PARTS, SPACE_MARK = "piece_bpe_32k.model", 1 << 19, "▁"
SHIFT, LOW, UNKNOWN, MERGED, NEVER, SHORT = 20, (1 << 20) - 1, -1, -2, (1 << 30) - 1, 48
_NAMES = ["n_tokens", "ids_sha256", "decoded_sha256", "matches_library"]
USED, MARK = 1, 2
_codecs: dict[str, PieceCodec] = {}


def ragged(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ranges of ``flat`` in a row, and where each begins and the last one ends."""
    ends = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(sizes, out=ends[1:])
    return flat[np.repeat(starts - ends[:-1], sizes) + np.arange(ends[-1])], ends


class KnownParts:
    """Ids of parts by the parts' hashes, in common arrays."""

    def __init__(self):
        self.keys, self.starts, self.sizes, self.ids = np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def __len__(self) -> int:
        return len(self.keys)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, whether known) of sorted keys."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, self.keys[at] == keys

    def add(self, keys: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Keep new parts: sorted keys, ids in a row, ids per part."""
        at = np.searchsorted(self.keys, keys)
        self.starts = np.insert(self.starts, at, len(self.ids) + np.cumsum(sizes) - sizes)
        self.keys, self.sizes = np.insert(self.keys, at, keys), np.insert(self.sizes, at, sizes)
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])

    def shorten(self, most: int) -> None:
        """Drop all but the ``most`` parts that came last."""
        if most < len(self):
            low = np.sort(self.starts)[len(self) - most] if most else len(self.ids)
            stay = self.starts >= low
            self.keys, self.starts, self.sizes, self.ids = self.keys[stay], self.starts[stay] - low, self.sizes[stay], self.ids[low:].copy()


class PieceCodec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(size)]
        self.piece_ids = {sp.id_to_piece(i): i for i in range(size) if not special[i] and not sp.is_unused(i)}
        # Equal scores share a place; the leftmost pair then comes first.
        places = {s: k for k, s in enumerate(sorted({sp.get_score(i) for i in self.piece_ids.values()}, reverse=True))}
        self.pairs: dict[int, int] = {}  # two pieces -> the place and id of the piece they form
        for piece, i in self.piece_ids.items():
            for k in range(1, len(piece)):
                left, right = self.piece_ids.get(piece[:k]), self.piece_ids.get(piece[k:])
                if left is not None and right is not None:
                    self.pairs[left << SHIFT | right] = places[sp.get_score(i)] << SHIFT | i
        self.pair_keys = np.array(sorted(self.pairs), np.int64)
        self.pair_values = np.array([self.pairs[k] for k in self.pair_keys.tolist()], np.int64)
        self.characters = np.full(0x110000, UNKNOWN, np.int32)
        for p, i in self.piece_ids.items():
            if len(p) == 1:
                self.characters[ord(p)] = i
        self.decimal = [str(i) for i in range(size)]
        self.byte_ids = {int(sp.id_to_piece(i)[1:-1], 16): i for i in range(size) if sp.is_byte(i)}
        # Bytes of every id in a decoded text; controls give none.
        self.surface = [b"" if special[i] else sp.id_to_piece(i).replace(SPACE_MARK, " ").encode() for i in range(size)]
        for value, i in self.byte_ids.items():
            self.surface[i] = bytes([value])
        self.surface[sp.unk_id()] = b" \xe2\x81\x87 "
        self.surface_sizes = np.array([len(x) for x in self.surface], np.int64)
        self.surface_starts = np.cumsum(self.surface_sizes) - self.surface_sizes
        self.surface_bytes = np.frombuffer(b"".join(self.surface), np.uint8)
        self.controls = {i for i in range(size) if sp.is_control(i)}
        self.marked = {i for p, i in self.piece_ids.items() if p[0] == SPACE_MARK}
        self.bytes_of = {i: value for value, i in self.byte_ids.items()}
        self.neighbours = {p[k : k + 2] for p in self.piece_ids for k in range(len(p) - 1)}
        # A mark starts a new part, unless a piece holds one after another character.
        inner = any(pair[1] == SPACE_MARK != pair[0] for pair in self.neighbours)
        self.kinds = np.zeros(0x110000, np.uint8)
        self.kinds[[ord(c) for p in self.piece_ids for c in p]] = USED
        self.kinds[ord(SPACE_MARK)] = USED if inner else MARK
        self.known = KnownParts()
        if len(self.byte_ids) != 256 or sp.encode("a  b ") != self.encode("a  b "):
            raise ValueError(f"{path} is not a merge-type vocabulary with byte fallback and plain white space")

    def merge(self, text: str) -> list[int]:
        """Ids of ``text`` by the agenda; it is taken as it stands."""
        n, pairs, ids = len(text), self.pairs, self.piece_ids
        symbols = [ids.get(c, UNKNOWN) for c in text]
        after, before = [*range(1, n), n], list(range(-1, n - 1))
        # An entry is the formed piece's place in the order of scores, then the left symbol.
        agenda = [(pairs[key] >> SHIFT) * n + k for k in range(n - 1) if (key := symbols[k] << SHIFT | symbols[k + 1]) in pairs]
        heapify(agenda)
        while agenda:
            place, left = divmod(heappop(agenda), n)
            right, symbol = after[left], symbols[left]
            # Either symbol may have merged with another since.
            if right == n or symbol == MERGED or (formed := pairs.get(symbol << SHIFT | symbols[right])) is None or formed >> SHIFT != place:
                continue
            symbols[left] = piece = formed & LOW
            symbols[right] = MERGED
            after[left] = follower = after[right]
            if follower < n:
                before[follower] = left
                if (formed := pairs.get(piece << SHIFT | symbols[follower])) is not None:
                    heappush(agenda, (formed >> SHIFT) * n + left)
            leader = before[left]
            if leader >= 0 and (formed := pairs.get(symbols[leader] << SHIFT | piece)) is not None:
                heappush(agenda, (formed >> SHIFT) * n + leader)
        if min(symbols) > UNKNOWN:
            return symbols
        out: list[int] = []
        for k, symbol in enumerate(symbols):
            if symbol == UNKNOWN:
                out += [self.byte_ids[b] for b in text[k].encode()]
            elif symbol != MERGED:
                out.append(symbol)
        return out

    def encode(self, text: str) -> list[int]:
        """Ids of a text, as the library gives them without begin and end ids."""
        return self.encode_batch([text])[0].tolist()

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, where each text's begin and the last ones end)."""
        marked = "".join(SPACE_MARK + t for t in texts if t).replace(" ", SPACE_MARK)
        points = np.frombuffer(marked.encode("utf-32-le"), np.uint32)
        sizes = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
        if not len(points):
            return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
        # A mark starts a part, unless one is before it; characters of no piece stand apart.
        kind = self.kinds[points]
        starts = np.ones(len(kind), bool)
        starts[1:] = (kind[1:] != kind[:-1]) & ~((kind[1:] == USED) & (kind[:-1] == MARK))
        starts[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
        starts = np.flatnonzero(starts)
        ends = np.append(starts[1:], len(points))
        at = np.zeros(len(points) + 1, np.int64)
        np.cumsum(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF), out=at[1:])
        keys = RangeHash(np.frombuffer(marked.encode(), np.uint8))(at[starts], at[ends])
        keys, first, which = np.unique(keys, return_index=True, return_inverse=True)
        known = self.known
        new = ~known.find(keys)[1]
        if new.any():
            known.add(keys[new], *self._learn(marked, points, starts[first[new]], ends[first[new]]))
        at = known.find(keys)[0][which]
        ids, where = ragged(known.ids, known.starts[at], known.sizes[at])
        bounds = where[np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)]))]
        if len(known) > CACHED_PARTS:
            # The older half goes; frequent parts come back with the next batch.
            known.shorten(CACHED_PARTS // 2)
        return ids, bounds

    def _learn(self, marked: str, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids in a row, ids per part) of parts of ``marked``, whose characters are ``points``.

        Short parts share an agenda, long ones and those with unknown characters have their own."""
        sizes = ends - starts
        own = sizes > SHORT
        symbols, where = ragged(points, starts[~own], sizes[~own])
        symbols = self.characters[symbols]
        if len(symbols):
            own[~own] = np.minimum.reduceat(symbols, where[:-1]) == UNKNOWN
        spelt = np.flatnonzero(~own)
        symbols = self.characters[ragged(points, starts[spelt], sizes[spelt])[0]]
        found, lengths = self.merge_all(symbols, sizes[spelt])
        if len(spelt) == len(sizes):
            return found, lengths
        others, rows = [], np.flatnonzero(own)
        for lo, hi in zip(starts[rows].tolist(), ends[rows].tolist(), strict=True):
            ids, start = [], lo
            for k in range(lo + 1, hi + 1):
                if k == hi or marked[k - 1 : k + 1] not in self.neighbours:
                    ids += self.merge(marked[start:k])
                    start = k
            others.append(ids)
        more = np.array([len(ids) for ids in others], np.int64)
        flat, counts = np.concatenate([found, np.fromiter(chain.from_iterable(others), np.int64, int(more.sum()))]), np.concatenate([lengths, more])
        order = np.argsort(np.concatenate([spelt, rows]))
        return ragged(flat, (np.cumsum(counts) - counts)[order], counts[order])[0], counts[order]

    def merge_all(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids in a row, ids per part) of many parts at once, given as pieces of one character: every round takes
        the first entry of each part's agenda (best score, then leftmost), merges it and looks up the pairs it forms."""
        if not len(sizes):
            return np.zeros(0, np.int64), sizes
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        part, symbols = np.arange(len(sizes)), symbols.astype(np.int64)
        place, piece = self._formed(symbols, np.append(symbols[1:], UNKNOWN))
        place[np.cumsum(sizes) - 1] = NEVER
        while len(part):
            first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            best = np.minimum.reduceat(place << 32 | np.arange(len(place)), first)
            open_, at = best >> 32 < NEVER, best & 0xFFFFFFFF
            if not open_.all():
                done.append((part[~open_], sizes[~open_], symbols[np.repeat(~open_, sizes)]))
            at, last = at[open_], (first + sizes - 1)[open_]
            symbols[at] = piece[at]
            follower = np.minimum(at + 2, len(symbols) - 1)
            formed, into = self._formed(symbols[at], symbols[follower])
            place[at], piece[at] = np.where(at + 2 > last, NEVER, formed), into
            led = at > first[open_]
            before = at[led] - 1
            place[before], piece[before] = self._formed(symbols[before], symbols[at[led]])
            keep = np.repeat(open_, sizes)
            keep[at + 1] = False
            symbols, place, piece = symbols[keep], place[keep], piece[keep]
            part, sizes = part[open_], sizes[open_] - 1
        part, sizes, ids = (np.concatenate(c) for c in zip(*done, strict=True))
        order = np.argsort(part)
        return ragged(ids, (np.cumsum(sizes) - sizes)[order], sizes[order])[0], sizes[order]

    def _formed(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the order of scores, id) of the pieces that pairs form; NEVER where they form none."""
        key = left.astype(np.int64) << SHIFT | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        value = self.pair_values[at]
        return np.where(self.pair_keys[at] == key, value >> SHIFT, NEVER), value & LOW

    def decode_batch(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The texts of ids given as ``encode_batch`` gives them."""
        raw, where = ragged(self.surface_bytes, self.surface_starts[ids], self.surface_sizes[ids])
        whole, where, out = raw.tobytes(), where[bounds].tolist(), []
        plain = not np.isin(ids, list(self.controls)).any()
        for k, (a, b) in enumerate(zip(where[:-1], where[1:], strict=True)):
            try:
                text = whole[a:b].decode() if plain else None
            except UnicodeDecodeError:
                text = None
            if text is None:
                text = self.decode(ids[bounds[k] : bounds[k + 1]].tolist())
            elif b > a and int(ids[bounds[k]]) in self.marked:
                text = text[1:]
            out.append(text)
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ids: a first space mark goes, runs of bytes are read as UTF-8, a bad byte as U+FFFD."""
        raw = b"".join(map(self.surface.__getitem__, ids))
        if any(c in ids for c in self.controls):
            text = self._decode_runs(ids)
        else:
            try:
                text = raw.decode()
            except UnicodeDecodeError:
                text = self._decode_runs(ids)
        first = next((i for i in ids if self.surface[i]), None)
        return text[1:] if first in self.marked else text

    def _decode_runs(self, ids: list[int]) -> str:
        out, run = [], bytearray()
        for i in [*ids, None]:
            if i in self.bytes_of:
                run.append(self.bytes_of[i])
                continue
            while run:
                for size in (1, 2, 3, 4):
                    try:
                        out.append(run[:size].decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    size = 1
                    out.append("\ufffd")
                del run[:size]
            if i is not None:
                out.append(self.surface[i].decode())
        return "".join(out)


def piece_codec(name: str = MODEL) -> PieceCodec:
    """The codec of a vocabulary file, loaded once per worker."""
    if name not in _codecs:
        _codecs[name] = PieceCodec(public_tokenizers.path(name))
    return _codecs[name]


def encode_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL, with_ids: bool = True) -> DataFrame:
    """One row per document: the id, ``n_tokens``, ``ids_sha256`` (of the decimal ids joined by commas),
    ``decoded_sha256`` (of the text that the ids decode to), ``matches_library`` and, if ``with_ids``, the
    ``ids`` and the ``decoded`` text.

    The ids and texts are those of the agenda; ``matches_library`` is true where sentencepiece, run over the
    same batch, gives the same ids and the same text for them. A NULL text has no ids, as an empty one, and
    decodes to the empty text. A NULL id stays NULL; rows that repeat give a row each; an empty table gives
    none. Texts are encoded whole. Further columns are not read; no row is shuffled.
    """
    names = _NAMES + ["ids", "decoded"] * with_ids
    kinds = ["long", "string", "string", "boolean", "array<int>", "string"]
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, " + ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = piece_codec(model)
        for batch in batches:
            for lo, hi, data, off in slices(batch.column(1)):
                raw = data.tobytes()
                texts = [raw[a:b].decode() for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
                every, bounds = codec.encode_batch(texts)
                decoded = codec.decode_batch(every, bounds)
                lists = [every[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                rows = []
                for ids, text, their_ids, their_text in zip(lists, decoded, codec.library.encode(texts, num_threads=1), codec.library.decode(lists, num_threads=1), strict=True):
                    digests = (hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(codec.decimal.__getitem__, ids)), text))
                    rows.append([len(ids), *digests, ids == their_ids and text == their_text, ids, text])
                columns = list(zip(*rows, strict=True))
                types = [pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.list_(pa.int32()), pa.string()]
                arrays = [pa.array(c, t) for c, t in zip(columns[: len(names)], types, strict=False)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], *arrays], [id_col, *names])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)
