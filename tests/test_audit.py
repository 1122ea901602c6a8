import pytest
from pyspark.sql import functions as F

from promoledger.operators import audit, dml
from promoledger.plans.reconcile import audited_update, run_audited_update
from promoledger.sources.snapshots import SnapshotStore
from tests.conftest import AS_OF, plan, rows


def program(df, *columns):
    return df.filter("program_id = 1").select(*columns).first()


def test_change_is_recorded_and_restored(seed):
    bad = audited_update(
        seed["promotion_program"], seed["promotion_program_history"], F.col("program_id") == 1,
        {"budget_limit": 999000000, "updated_by": "ROGUE_EMPLOYEE"}, AS_OF, "SYSTEM",
    )
    entry = bad.captured.collect()
    assert len(entry) == 1
    assert (entry[0].history_id, int(entry[0].old_budget_limit), entry[0].changed_by, entry[0].change_type) == (1, 50_000_000, "ROGUE_EMPLOYEE", "UPDATE")
    assert program(bad.table, "budget_limit")[0] == 999_000_000

    back = audit.restore(bad.table, bad.captured, "program_id", ["budget_limit"], "2026-06-16 00:00:00", "ADMIN_ROLLBACK")
    assert tuple(program(back.table, "budget_limit", "updated_by")) == (50_000_000, "ADMIN_ROLLBACK")
    again = audit.capture_changes(bad.table, back.table, "program_id", audit.PROGRAM_COLUMNS, "2026-06-16 00:00:00", "SYSTEM")
    history = bad.captured.unionByName(dml.next_ids(again, bad.captured, "history_id", [F.col("program_id")]).select(bad.captured.columns))
    newest = audit.history_of(history, "program_id", 1).collect()
    assert [r.history_id for r in newest] == [2, 1] and int(newest[0].old_budget_limit) == 999_000_000
    assert back.table.count() == 3


def test_equal_values_leave_no_history(seed):
    done = audited_update(
        seed["promotion_program"], seed["promotion_program_history"], F.col("program_id") <= 2, {"budget_limit": F.col("budget_limit")}, AS_OF, "ME"
    )
    assert done.captured.isEmpty()
    assert rows(done.table.filter("updated_at IS NOT NULL"), "program_id") == [(1,), (2,)]


def test_rule_breaking_rows_stay_as_they_were(seed):
    done = audited_update(
        seed["promotion_program"], seed["promotion_program_history"], F.lit(True), {"budget_limit": F.col("budget_limit") - 60000000}, AS_OF, "ME"
    )
    assert rows(done.violations, "constraint_name", "program_id") == [("chk_budget_limit", 1)]
    assert [int(r[0]) for r in done.table.orderBy("program_id").select("budget_limit").collect()] == [50_000_000, 10_000_000, 40_000_000]
    assert rows(done.captured, "program_id") == [(2,), (3,)]


def test_update_of_repeated_and_null_keys_reads_the_table_once(spark, seed, monkeypatch):
    from promoledger.plans import reconcile

    programs = seed["promotion_program"]
    odd = programs.unionByName(programs.filter("program_id = 1")).unionByName(programs.withColumn("program_id", F.lit(None).cast("bigint")))
    plans, real = [], reconcile.materialize
    monkeypatch.setattr(reconcile, "materialize", lambda df, *a, **k: plans.append(plan(df, "simple")) or real(df, *a, **k))
    done = audited_update(odd, seed["promotion_program_history"], F.col("budget_limit") == 50000000, {"budget_limit": 7}, AS_OF, "ME")
    assert len(plans) == 1 and "Join" not in plans[0] and "Exchange" not in plans[0]
    # The row without a key breaks a rule and stays as it was; both copies of row 1 change.
    assert done.table.count() == 7 and done.table.filter("budget_limit = 7").count() == 2
    assert rows(done.captured, "program_id") == [(1,), (1,)]
    assert {r.program_id for r in done.violations.collect()} == {None}


def test_table_and_history_become_visible_together(spark, seed, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    assert store.pin().commit_id == 0
    store.commit({"promotion_program": seed["promotion_program"], "promotion_program_history": seed["promotion_program_history"]})
    pinned = store.pin()
    run_audited_update(store, F.col("program_id") == 1, {"budget_limit": 45000000}, AS_OF, "ME")
    assert int(program(pinned.read("promotion_program"), "budget_limit")[0]) == 50_000_000
    assert int(program(store.read("promotion_program"), "budget_limit")[0]) == 45_000_000
    assert store.read("promotion_program_history").count() == 1
    with pytest.raises(ValueError, match="chk_budget_limit"):
        run_audited_update(store, F.col("program_id") == 1, {"budget_limit": -1}, AS_OF, "ME")
    assert store.pin().commit_id == 2 and store.pin(1).versions["promotion_program"].parts == (1,)


def test_interrupted_commit_is_invisible(spark, seed, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    store.commit({"partner": seed["partner"]})
    # A writer that died after the data and before the log line.
    seed["partner"].limit(1).write.parquet(f"{store.root}/partner/v=2")
    assert store.read("partner").count() == 5
    store.commit({"partner": seed["partner"].limit(3)})
    assert store.read("partner").count() == 3


def test_appends_write_new_rows_only_and_a_whole_version_ends_them(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    for start in (0, 10, 20):
        store.commit(append={"t": spark.range(start, start + 10)})
    assert store.read("t").count() == 30 and store.pin().versions["t"].parts == (1, 2, 3)
    assert store.pin(2).read("t").count() == 20
    assert spark.read.parquet(f"{store.root}/t/v=3").count() == 10
    store.commit({"t": store.read("t").filter("id < 5")})
    store.commit(append={"t": spark.range(100, 101)})
    assert rows(store.read("t")) == [(0,), (1,), (100,), (2,), (3,), (4,)] and store.pin().versions["t"].parts == (4, 5)
