"""Packing documents into fixed windows by the sum-of-squares rule.

A document's ids are cut into full windows; what is left goes, as a whole, to the fill level whose
choice makes the sum of squared counts of partly filled windows smallest. The counts are one array
with an entry per level. Each Spark partition packs its own rows in one pass, so the text is neither
shuffled nor gathered; windows still open at the end of a partition are topped up by cutting the
pieces of the emptiest ones, which leaves at most one padded window per partition.
"""

from __future__ import annotations

import base64
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promoledger.llm.kernels import tidy

WINDOW, END_ID, ROWS_OUT = 2048, 1, 4096
_FIELDS = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_encodings: dict[str, tiktoken.Encoding] = {}


def byte_encoding(name: str) -> tiktoken.Encoding:
    """The rank file ``name`` as an encoder, loaded once per worker; added tokens are those of the vocabulary beside it."""
    if name not in _encodings:
        with open(public_tokenizers.path(name), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        vocabulary, added = public_tokenizers.path(name.replace(".tiktoken", ".json")), {}
        if os.path.exists(vocabulary):
            with open(vocabulary, encoding="utf-8") as lines:
                added = {t["content"]: t["id"] for t in json.load(lines)["added_tokens"]}
        _encodings[name] = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)
    return _encodings[name]


class LevelPacker:
    """Open windows by fill level; ``place`` returns a window's pieces once it is full."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.counts = np.zeros(window + 1, np.int64)
        self.levels: dict[int, list[list]] = {}

    def choose(self, size: int) -> int:
        """Level (0: a new window) whose choice gives the smallest sum of squares; ties take the fullest."""
        counts, window = self.counts, self.window
        best, cost = 0, 2 * int(counts[size]) + 1
        levels = np.flatnonzero(counts[1 : window - size + 1]) + 1
        if len(levels):
            reached = levels + size
            change = 2 * (np.where(reached == window, -1, counts[reached]) - counts[levels]) + 2
            k = len(change) - 1 - int(np.argmin(change[::-1]))
            if change[k] <= cost:
                best = int(levels[k])
        return best

    def place(self, piece: tuple) -> list | None:
        size = len(piece[2])
        level = self.choose(size)
        if level:
            pieces = self.levels[level].pop()
            self.counts[level] -= 1
        else:
            pieces = []
        pieces.append(piece)
        if level + size == self.window:
            return pieces
        self.levels.setdefault(level + size, []).append(pieces)
        self.counts[level + size] += 1
        return None

    def close(self) -> Iterator[list]:
        """The windows left: the fullest are topped up with cuts of the emptiest."""
        left = [p for level in sorted(self.levels) for p in self.levels[level]]
        lo, hi = 0, len(left) - 1
        while lo < hi:
            room = self.window - sum(len(p[2]) for p in left[hi])
            while room and lo < hi:
                doc, start, ids, tokens = left[lo].pop()
                left[hi].append((doc, start, ids[:room], tokens))
                if len(ids) > room:
                    left[lo].append((doc, start + room, ids[room:], tokens))
                room -= min(room, len(ids))
                if not left[lo]:
                    lo += 1
            if room:
                break
            yield left[hi]
            hi -= 1
        if lo <= hi:
            yield left[lo]


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    end_id: int = END_ID,
    ranks: str = "byte_bpe_50k.tiktoken",
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: the document id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset`` and, if ``with_ids``, the ``ids`` themselves.

    A NULL or empty text is the end id alone. Rows that repeat are packed each. NULL ids stay NULL. An
    empty table gives no rows. Further columns of ``docs`` are not read. Sequence ids are unique, and
    a task that runs again gives the same ones.
    """
    kind = docs.schema[id_col].dataType
    schema = f"`{id_col}` {kind.simpleString()}, {_FIELDS}" + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, packer = byte_encoding(ranks), LevelPacker(window)
        added = encoding.special_tokens_set
        sequence, rows, id_type = TaskContext.get().partitionId() << 33, [], None

        def emit(pieces: list) -> None:
            nonlocal sequence
            offset = 0
            for doc, start, ids, tokens in pieces:
                rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), tokens, sequence, offset, ids))
                offset += len(ids)
            sequence += 1

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            arrays = [pa.array(columns[0], id_type), *(pa.array(c, pa.int64()) for c in columns[1:7])]
            names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                offsets = np.concatenate([[0], np.cumsum([len(c) for c in columns[7]])]).astype(np.int32)
                arrays.append(pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(columns[7]).view(np.int32))))
                names.append("ids")
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            id_type = batch.column(0).type
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = encoding.encode(text.as_py() or "", allowed_special=added, disallowed_special=())
                ids.append(end_id)
                ids = np.array(ids, "<u4")
                doc, tokens, cut = doc.as_py(), len(ids), len(ids) - len(ids) % window
                for start in range(0, cut, window):
                    emit([(doc, start, ids[start : start + window], tokens)])
                if cut < tokens and (full := packer.place((doc, cut, ids[cut:], tokens))):
                    emit(full)
                if len(rows) >= ROWS_OUT:
                    yield flush()
        for pieces in packer.close():
            emit(pieces)
            if len(rows) >= ROWS_OUT:
                yield flush()
        if rows:
            yield flush()

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(tidy(run), schema)
