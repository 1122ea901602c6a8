import os

import pytest

from promoledger.operators import cascade
from promoledger.sources import folders
from promoledger.sources.literal import literal
from promoledger.sources.schemas import LONG, Col, ForeignKey, Table
from tests.conftest import rows


def table(name, *keys):
    links = tuple(ForeignKey(f"fk_{name}_{c}", (c,), parent, ("id",)) for c, parent in keys)
    return Table(name, (Col("id", LONG, True), *[Col(c, LONG) for c, _ in keys]), ("id",), foreign_keys=links)


# Two ways lead from a to d, c refers to itself and e refers to nobody doomed.
TABLES = {
    "a": table("a"), "b": table("b", ("a_id", "a")), "c": table("c", ("a_id", "a"), ("boss_id", "c")),
    "d": table("d", ("b_id", "b"), ("c_id", "c")), "e": table("e", ("a_id", "a")),
}


@pytest.fixture
def frames(spark):
    return {
        "a": literal(spark, [(1,), (2,)], "id bigint"),
        "b": literal(spark, [(1, 1), (2, 2), (3, None)], "id bigint, a_id bigint"),
        "c": literal(spark, [(1, 1, None), (2, 2, 1), (3, 2, 2), (4, 2, 5), (5, 2, 4)], "id bigint, a_id bigint, boss_id bigint"),
        "d": literal(spark, [(1, 1, 3), (2, 2, 3), (3, 2, 4), (4, None, None), (5, 1, None)], "id bigint, b_id bigint, c_id bigint"),
        "e": literal(spark, [(1, 2)], "id bigint, a_id bigint"),
    }


def test_closure_takes_all_generations_once_and_children_first(spark, frames):
    doomed = cascade.doomed_rows({"a": literal(spark, [(1,), (1,), (9,)], "id bigint")}, frames, TABLES)
    assert {t: [r[0] for r in rows(d)] for t, d in doomed.items()} == {"a": [1], "b": [1], "c": [1, 2, 3], "d": [1, 2, 5]}
    order = list(doomed)
    assert order.index("d") < min(order.index("b"), order.index("c")) and order[-1] == "a"


def test_rows_that_refer_to_each_other(spark, frames):
    doomed = cascade.doomed_rows({"c": literal(spark, [(4,)], "id bigint")}, frames, TABLES)
    assert {t: [r[0] for r in rows(d)] for t, d in doomed.items()} == {"c": [4, 5], "d": [3]}


def test_nothing_doomed(spark, frames):
    assert cascade.doomed_rows({"a": literal(spark, [], "id bigint")}, frames, TABLES) == {}


def files(path):
    return {(f, os.stat(f"{path}/{f}").st_mtime_ns) for f in os.listdir(path)}


def test_stored_delete_stops_and_is_run_again(spark, frames, tmp_path, monkeypatch):
    paths = {t: str(tmp_path / t) for t in TABLES}
    for t, df in frames.items():
        df.write.parquet(paths[t])
    stored = {t: spark.read.parquet(p) for t, p in paths.items()}
    doomed = cascade.doomed_rows({"a": stored["a"].filter("id = 1")}, stored, TABLES)
    untouched = files(paths["e"])
    real, calls = cascade.replace_folder, []

    def failing(df, path):
        calls.append(path)
        if len(calls) == 3:
            raise OSError("lost")
        real(df, path)

    monkeypatch.setattr(cascade, "replace_folder", failing)
    with pytest.raises(OSError):
        cascade.delete_stored(spark, doomed, paths)
    # Half-way: no row that is left refers to a row that is gone.
    now = {t: spark.read.parquet(p) for t, p in paths.items()}
    for name, definition in TABLES.items():
        for fk in definition.foreign_keys:
            assert now[name].filter(f"{fk.columns[0]} is not null").join(now[fk.parent].selectExpr(f"id as {fk.columns[0]}"), fk.columns[0], "left_anti").isEmpty()
    monkeypatch.setattr(cascade, "replace_folder", real)
    cascade.delete_stored(spark, doomed, paths)
    left = {t: [r[0] for r in rows(spark.read.parquet(p), "id")] for t, p in paths.items()}
    assert left == {"a": [2], "b": [2, 3], "c": [4, 5], "d": [3, 4], "e": [1]}
    assert files(paths["e"]) == untouched


def test_a_replacement_cut_short_is_finished(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (1, 2):
        literal(spark, [(n,)], "id bigint").write.parquet(str(tmp_path / ("t" if n == 1 else ".new-t")))
    folders.finish_replacement(spark, path)  # not begun: the old rows stay, the new ones go
    assert rows(spark.read.parquet(path)) == [(1,)] and os.listdir(tmp_path) == ["t"]
    literal(spark, [(2,)], "id bigint").write.parquet(str(tmp_path / ".new-t"))
    os.rename(path, tmp_path / ".old-t")  # between the renames
    folders.finish_replacement(spark, path)
    assert rows(spark.read.parquet(path)) == [(2,)] and os.listdir(tmp_path) == ["t"]
