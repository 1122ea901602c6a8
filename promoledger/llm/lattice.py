"""Near-duplicate vectors by lattice hashing.

Several tables project a vector at random to eight dimensions and decode the image to the nearest
point of the E8 lattice, by rounding to its two cosets of D8. A vector lives in the cell of that point
and also probes the closest of the 240 neighbouring cells. Vectors that meet in a cell are compared
by exact cosine. Equal vectors are one class with a count, so a common vector costs one row; a pair
that meets again counts in its first table only, so links are counted without a list of all pairs.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promoledger.llm.graph import components
from promoledger.llm.kernels import U, mix
from promoledger.session import materialize

TABLES, PROBES, SCALE, SEED, COSINE, CELL_ROWS = 6, 6, 1.4, 5, 0.98, 4096


def minimal_vectors() -> np.ndarray:
    """The 240 shortest non-zero points of E8."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) / 2 for s in itertools.product((1.0, -1.0), repeat=8) if np.prod(s) > 0]
    return np.array(out)


def decode(x: np.ndarray) -> np.ndarray:
    """Nearest E8 point of each row."""

    def even(y: np.ndarray) -> np.ndarray:
        near = np.rint(y)
        odd = np.flatnonzero(near.sum(1) % 2)
        off = y[odd] - near[odd]
        worst = np.abs(off).argmax(1)
        near[odd, worst] += np.where(off[np.arange(len(odd)), worst] >= 0, 1, -1)
        return near

    a, b = even(x), even(x - 0.5) + 0.5
    closer = ((x - b) ** 2).sum(1) < ((x - a) ** 2).sum(1)
    return np.where(closer[:, None], b, a)


def cells(unit: np.ndarray, salt: np.ndarray, tables: int, probes: int, scale: float, seed: int) -> np.ndarray:
    """Cell keys (row, table, 1 + probes); the first of a table is the home cell. ``salt`` keeps labels apart."""
    n, d = unit.shape
    steps, out = minimal_vectors(), np.zeros((n, tables, 1 + probes), U)

    def key(points: np.ndarray, table: int) -> np.ndarray:
        h = salt + U(table * 7919 + 1)
        for k in range(8):
            h = mix(h * U(0xD1342543DE82EF95) + (2 * points[:, k]).astype(np.int64).view(U))
        return h

    for t in range(tables):
        plane = np.random.default_rng([seed, t, d]).standard_normal((d, 8)) * scale
        x = unit @ plane
        home = decode(x)
        out[:, t, 0] = key(home, t)
        if probes:
            closest = np.argpartition(-((x - home) @ steps.T), probes - 1, axis=1)[:, :probes]
            for p in range(probes):
                out[:, t, 1 + p] = key(home + steps[closest[:, p]], t)
    return out


def vector_classes(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(label, vector, class, weight) of the distinct comparable vectors."""
    v = F.col(vector_col).cast("array<double>")
    fine = v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(v, lambda c: c != 0)
    rows = vectors.filter(F.col(label_col).isNotNull()).select(F.col(label_col).alias("label"), v.alias("vector"), fine.alias("__fine"))
    found = rows.filter(F.coalesce("__fine", F.lit(False))).groupBy("label", "vector").agg(F.count(F.lit(1)).alias("weight"))
    return found.select("label", "vector", F.xxhash64("label", "vector").alias("class"), "weight")


def _placed(classes: DataFrame, kind: str, tables: int, probes: int, scale: float, seed: int) -> DataFrame:
    """(class, weight, vector, cells): the keys of all tables as one binary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, salt = batch.column(0), batch.column(3).to_numpy().view(U)
            sizes = vectors.value_lengths().to_numpy()
            flat = vectors.flatten().to_numpy()
            at = np.concatenate([[0], np.cumsum(sizes)])
            raw, keys = [b""] * len(sizes), [b""] * len(sizes)
            for d in np.unique(sizes):
                for part in np.array_split(np.flatnonzero(sizes == d), -(-int((sizes == d).sum()) // 2000)):
                    x = flat[at[part][:, None] + np.arange(d)]
                    unit = x / np.abs(x).max(1)[:, None]
                    unit /= np.sqrt((unit**2).sum(1))[:, None]
                    got = cells(unit, mix(salt[part] + U(int(d))), tables, probes, scale, seed)
                    for k, i in enumerate(part):
                        raw[i], keys[i] = x[k].astype(kind).tobytes(), got[k].tobytes()
            arrays = [batch.column(1), batch.column(2), pa.array(raw, pa.binary()), pa.array(keys, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["class", "weight", "vector", "cells"])

    rows = classes.select("vector", "class", "weight", F.xxhash64("label").alias("salt"))
    return rows.mapInArrow(run, "class long, weight long, vector binary, cells binary")


def _cell_rows(placed: DataFrame, tables: int, probes: int) -> DataFrame:
    """(cell, table, home, class, weight) of every cell a vector lives in or probes."""
    step = 1 + probes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(batch)
            keys = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.int64)
            row = np.repeat(np.arange(n), tables * step)
            slot = np.tile(np.arange(tables * step), n)
            take = pa.array(row)
            arrays = [pa.array(keys), pa.array((slot // step).astype(np.int32)), pa.array(slot % step == 0)]
            yield pa.RecordBatch.from_arrays([*arrays, batch.column(0).take(take)], ["cell", "table", "home", "class"])

    return placed.select("class", "weight", "cells").mapInArrow(run, "cell long, table int, home boolean, class long")


def class_links(classes: DataFrame, kind: str, cosine: float, tables: int, probes: int, scale: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """(class, n_linked: vectors of other classes linked) and (a, b): links that join all linked classes."""
    spark = classes.sparkSession
    placed = materialize(_placed(classes, kind, tables, probes, scale, seed), "lattice")
    rows = _cell_rows(placed, tables, probes)
    # A cell matters if a vector lives there and another one lives there or probes it.
    live = rows.groupBy("cell").agg(F.count_if("home").alias("homes"), F.count(F.lit(1)).alias("members")).filter("homes > 0 and members > 1")
    met = materialize(rows.join(live.select("cell", "members"), "cell"), "lattice-cells")
    blocks = F.ceil(F.col("members") / CELL_ROWS)
    cut = met.withColumn("blocks", blocks).withColumn("mine", F.pmod(F.xxhash64("class"), F.col("blocks")))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    unit = F.xxhash64("cell", low, high)
    parts = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = cut.select(F.pmod(unit, F.lit(parts)).alias("part"), unit.alias("unit"), "cell", "table", "home", "class", F.col("mine").cast("int").alias("mine"), (low != high).alias("cross"))
    # Each vector goes once to each part it has a cell in.
    need = cut.select("part", "class").distinct().join(placed, "class").select("part", "class", "weight", "vector", "cells")
    need = materialize(need, "lattice-vectors")

    def run(key: tuple, cell_rows: pa.Table, vectors: pa.Table) -> pa.Table:
        names = vectors.column("class").to_numpy()
        weight = vectors.column("weight").to_numpy()
        data = [np.frombuffer(v, kind).astype(float) for v in vectors.column("vector").to_pylist()]
        keys = np.frombuffer(b"".join(vectors.column("cells").to_pylist()), np.int64).reshape(-1, tables, 1 + probes)
        order = np.argsort(names)
        cell_rows = cell_rows.combine_chunks().sort_by("unit")
        units, cell, table, home, mine, cross = (cell_rows.column(c).to_numpy() for c in ("unit", "cell", "table", "home", "mine", "cross"))
        who = order[np.searchsorted(names, cell_rows.column("class").to_numpy(), sorter=order)]
        counts, label = np.zeros(len(names), np.int64), np.arange(len(names))
        links = [np.zeros((2, 0), np.int64)]
        cuts = np.flatnonzero(np.concatenate([[True], units[1:] != units[:-1], [True]])) if len(units) else np.zeros(1, np.int64)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            # A vector may live in a cell and never probe it too; rows are distinct per cell.
            ids, lives, t, c = who[a:b], home[a:b], int(table[a]), cell[a]
            x = np.stack([data[i] for i in ids])
            # By a power of two, which is exact: squares of very small or large components stay in range.
            x = np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])
            norm = np.sqrt((x**2).sum(1))
            for lo in range(0, len(ids), 256):
                hi = min(lo + 256, len(ids))
                near = (x[lo:hi] @ x.T) / (norm[lo:hi, None] * norm[None, :]) >= cosine
                near &= np.arange(lo, hi)[:, None] < np.arange(len(ids))[None, :]
                near &= lives[lo:hi, None] | lives[None, :]
                if cross[a]:
                    near &= mine[a:b][lo:hi, None] != mine[a:b][None, :]
                p, q = np.nonzero(near)
                if not len(p):
                    continue
                p, q = ids[p + lo], ids[q]
                # Met in an earlier table, or in this table in the smaller of two cells: counted there.
                there = (keys[p][:, : t + 1, :1] == keys[q][:, : t + 1]).any(2)
                back = (keys[q][:, : t + 1, :1] == keys[p][:, : t + 1]).any(2)
                new = ~(there[:, :t] | back[:, :t]).any(1)
                twice = there[:, t] & back[:, t] & (keys[p, t, 0] != keys[q, t, 0])
                new &= ~twice | (c == np.minimum(keys[p, t, 0], keys[q, t, 0]))
                p, q = p[new], q[new]
                np.add.at(counts, p, weight[q])
                np.add.at(counts, q, weight[p])
                links.append(np.stack([p, q]))
        pairs = np.concatenate(links, axis=1)
        while pairs.shape[1]:
            low = np.minimum(label[pairs[0]], label[pairs[1]])
            before = label.copy()
            np.minimum.at(label, pairs[0], low)
            np.minimum.at(label, pairs[1], low)
            label = label[label]
            if (label == before).all():
                break
        got = np.flatnonzero(counts)
        return pa.table({"class": names[got], "n_linked": counts[got], "root": names[label[got]]})

    # One row per class and part; the links of a part are given as a star.
    found = cut.groupBy("part").cogroup(need.groupBy("part")).applyInArrow(run, "class long, n_linked long, root long")
    found = materialize(found, "lattice-links")
    return found.groupBy("class").agg(F.sum("n_linked").alias("n_linked")), found.select(F.col("class").alias("a"), F.col("root").alias("b"))


def near_duplicate_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    cosine: float = COSINE,
    tables: int = TABLES,
    probes: int = PROBES,
    scale: float = SCALE,
    seed: int = SEED,
) -> DataFrame:
    """Per row: the id, ``n_links``, ``component_id``, ``kept``.

    Only vectors with the same non-NULL label and dimension are compared. A NULL, zero or non-finite
    vector links with nothing and is its own component. Equal vectors are linked. Repeated ids count as
    a vector each; NULL ids stay and give their component no id. An empty table gives no rows.
    """
    classes = materialize(vector_classes(vectors, id_col, vector_col, label_col), "vector-classes")
    kind = "<f4" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "<f8"
    counts, links = class_links(classes, kind, cosine, tables, probes, scale, seed)
    roots = components(links).select(F.col("node").alias("__node"), "root")
    state = classes.select("class", "weight").join(counts, "class", "left").join(roots, F.col("class") == F.col("__node"), "left")
    state = state.select("class", (F.coalesce("n_linked", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "class").alias("root"))
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).alias("id"), F.when(F.col(label_col).isNotNull(), F.xxhash64(F.col(label_col), v)).alias("class"))
    named = rows.join(state, "class", "left")
    least = named.filter("root is not null").groupBy("root").agg(F.min("id").alias("component_id"))
    out = named.join(least, "root", "left")
    component = F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept")
    )
