"""The store: epochs, forks, moves, crashes between any two steps, restarts."""

from __future__ import annotations

import random
import uuid

import pytest
from pyspark.sql import functions as F

from forktide.operators import analytics, oplog
from forktide.operators.contracts import ContractError
from forktide.operators.migration import MigrationHooks, MigrationResult
from forktide.sources import feed
from forktide.sources import tables as tb
from forktide.streaming.registry_log import MissingVersion
from forktide.streaming.runner import drop_repeated, run_feed
from forktide.streaming.store import FinalityError, ForkStore, StoreOptions
from model import random_deliveries, stack_chain

EVENTS = tb.EventTable(
    "test_events", "id bigint, height bigint, hash string, data string, at timestamp",
    key=("height", "id"), timestamp="at",
)
SECOND = tb.EventTable("others", "id bigint, height bigint, hash string")
SCHEMA = (
    "id bigint, height bigint, hash string, data string, at timestamp, seq bigint, "
    "finalized_height bigint, finalized_hash string, base_height bigint, parent string"
)


def batch(spark, deliveries, finalized=None, base=None, rows=2):
    """``rows`` event rows per delivered ``(seq, height, hash)``."""
    out = [
        (h * 10 + i, h, x, f"{x}/{i}", None, s, finalized, None if finalized is None else f"f{finalized}", base, f"p{h}")
        for s, h, x in deliveries
        for i in range(rows)
    ]
    stamp = F.to_timestamp(F.lit("2024-01-15")) + F.make_dt_interval(hours=F.col("height"))
    return spark.createDataFrame(out, SCHEMA).withColumn("at", stamp)


def blocks(low, top, hash="a", seq=0):
    return [(seq + i, h, f"{hash}{h}") for i, h in enumerate(range(low, top + 1))]


def to_events(df):
    return {"test_events": df}


def new_store(spark, database=None, events=(EVENTS,), **options):
    defaults = {"hot_blocks_depth": 5, "auto_migrate": False, "log_operations": False}
    store = ForkStore(
        spark, database or f"t_{uuid.uuid4().hex[:10]}", list(events), options=StoreOptions(**{**defaults, **options})
    )
    store.recovered = store.connect()
    return store


def again(spark, store, **options):
    """A new process: nothing is carried over but the tables."""
    fresh = ForkStore(
        spark, store.database, list(store.events.values()), list(store.snapshots.values()), options=store.options
    )
    fresh.recovered = fresh.connect(**options)
    return fresh


def seen(store, table="test_events", **kw):
    return sorted((r["height"], r["hash"], r["id"]) for r in store.visible(table, **kw).collect())


def expected(chain, rows=2):
    return sorted((h, x, h * 10 + i) for h, x in chain for i in range(rows))


def chain_of(low, top, hash="a"):
    return [(h, f"{hash}{h}") for h in range(low, top + 1)]


class Stop(Exception):
    pass


def stop(*_, **__):
    raise Stop


# ---- epochs and forks ------------------------------------------------------------------------------


def test_random_forks_against_a_stack(spark):
    store = new_store(spark, auto_migrate=True, migration_interval=20, hot_blocks_depth=4)
    feed = random_deliveries(random.Random(5), 90, 0.12, max_depth=5)
    size, tip = 30, 0
    for n, start in enumerate(range(0, len(feed), size)):
        part = feed[start : start + size]
        store.apply_hot(batch(spark, part, finalized=max(tip - 7, -1)), to_events, "s", n)
        chain = stack_chain(feed[: start + size])
        tip = chain[-1][0]
        assert seen(store) == expected(chain)
    assert store._cutoffs["test_events"] > 0
    assert store._state.height == tip


def test_fork_across_batches_and_registry(spark):
    store = new_store(spark, log_operations=True)
    store.apply_hot(batch(spark, blocks(1, 12), finalized=3), to_events, "s", 0)
    store.apply_hot(batch(spark, blocks(11, 13, "b", 20), finalized=2), to_events, "s", 1)
    assert seen(store) == expected(chain_of(1, 10) + chain_of(11, 13, "b"))
    assert store.is_valid_block(12, "b12") and not store.is_valid_block(12, "a12")
    bounds = store.registry_bounds().first()
    assert (bounds["highest"], bounds["lowest"], bounds["n_blocks"], bounds["threshold"]) == (13, 1, 13, 8)
    assert store._state.finalized_height == 3, "finality never steps back"
    ops = {r["op"]: r for r in store.operations().collect()}
    assert ops["fork_executed"]["amount"] == 2 and ops["fork_executed"]["height"] == 10
    counters = oplog.summary(store.operations()).first()
    assert (counters["hot_blocks_processed"], counters["blocks_rolled_back"]) == (15, 2)
    assert (counters["inserts"], counters["status_updates"], counters["connections"]) == (2, 2, 1)
    rows = batch(spark, blocks(1, 13) + blocks(11, 13, "b", 20))
    old_rule = store.valid_filter(rows, 13)
    assert old_rule.filter("hash like 'b%'").count() == 6
    assert old_rule.filter("hash like 'a%'").count() == 20


def test_base_height_rolls_back_further(spark):
    store = new_store(spark)
    store.apply_hot(batch(spark, blocks(1, 10), finalized=0), to_events, "s", 0)
    store.apply_hot(batch(spark, blocks(9, 9, "b", 20), finalized=0, base=6), to_events, "s", 1)
    assert seen(store) == expected(chain_of(1, 6) + [(9, "b9")])


def test_replays_change_nothing(spark):
    store = new_store(spark)
    store.apply_hot(batch(spark, blocks(1, 8)), to_events, "s", 0)
    before, epoch = seen(store), store._state.epoch
    store.apply_hot(batch(spark, blocks(1, 8)), to_events, "s", 0)
    assert store._state.epoch == epoch, "the same batch is recognised"
    store.apply_hot(batch(spark, blocks(6, 8, "a", 50)), to_events, "s", 1)
    assert seen(store) == before, "repeated blocks are no fork"
    store.apply_hot(batch(spark, blocks(7, 10, "a", 60)), to_events, "s", 2)
    assert seen(store) == expected(chain_of(1, 10))


def test_block_adopted_again_shows_its_rows_once(spark):
    store = new_store(spark)
    store.apply_hot(batch(spark, blocks(1, 5)), to_events, "s", 0)
    store.apply_hot(batch(spark, blocks(5, 6, "b", 10)), to_events, "s", 1)
    store.apply_hot(batch(spark, [(20, 5, "a5"), (21, 6, "a6")]), to_events, "s", 2)
    assert seen(store) == expected(chain_of(1, 6))


def test_several_forks_in_one_batch(spark):
    store = new_store(spark)
    part = blocks(1, 6) + blocks(4, 7, "b", 10) + blocks(6, 8, "c", 20)
    store.apply_hot(batch(spark, part), to_events, "s", 0)
    assert seen(store) == expected(chain_of(1, 3) + chain_of(4, 5, "b") + chain_of(6, 8, "c"))


def test_status_row(spark):
    store = new_store(spark)
    store.apply_hot(batch(spark, blocks(1, 6), finalized=4), to_events, "s", 0)
    row = spark.table(store._status_name).first()
    assert (row["height"], row["hash"], row["finalized_height"], row["finalized_hash"]) == (6, "a6", 4, "f4")
    assert row["hot_blocks"] == '[{"height":5,"hash":"a5"},{"height":6,"hash":"a6"}]'
    assert row["parent_hash"] == "p6"
    back = again(spark, store).recovered
    assert (back.height, back.hash, back.top) == (4, "f4", ((5, "a5"), (6, "a6")))


def test_genesis_and_contract(spark):
    assert new_store(spark).recovered.height == -1
    bad = tb.EventTable("bad", "id bigint, height bigint")
    with pytest.raises(ContractError, match="hash"):
        new_store(spark, events=(bad,))


# ---- crashes ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("step", ["_publish_registry", "_save"])
def test_crash_inside_an_epoch(spark, monkeypatch, step):
    store = new_store(spark)
    store.apply_hot(batch(spark, blocks(1, 8)), to_events, "s", 0)
    part = batch(spark, blocks(7, 9, "b", 20))
    with monkeypatch.context() as m:
        m.setattr(store, step, stop)
        with pytest.raises(Stop):
            store.apply_hot(part, to_events, "s", 1)
    assert seen(store) == expected(chain_of(1, 8)), "nothing of the batch is visible"
    back = again(spark, store)
    back.apply_hot(part, to_events, "s", 1)
    assert seen(back) == expected(chain_of(1, 6) + chain_of(7, 9, "b"))
    copies = spark.table(back.hot_name("test_events")).groupBy("hash", "id").count()
    assert copies.agg(F.max("count")).first()[0] == 1, "the replay overwrote its own rows"


@pytest.mark.parametrize("step", ["_commit_cold", "_reclaim"])
def test_crash_inside_a_move(spark, monkeypatch, step):
    store = new_store(spark)
    store.apply_hot(batch(spark, blocks(1, 20), finalized=12), to_events, "s", 0)
    want = expected(chain_of(1, 20))
    with monkeypatch.context() as m:
        m.setattr(store, step, stop)
        with pytest.raises(Stop):
            store.migrate()
    assert seen(store) == want
    back = again(spark, store)
    assert seen(back) == want
    back.apply_hot(batch(spark, blocks(21, 30, "a", 50), finalized=25), to_events, "s", 1)
    assert back.migrate().cutoff_height == 25
    assert seen(back) == expected(chain_of(1, 30))
    assert spark.table(back.cold_name("test_events")).count() == 50


def test_crash_while_catching_up(spark, monkeypatch):
    store = new_store(spark)
    store.apply_final(batch(spark, blocks(0, 9)), to_events, "s", 0)
    part = batch(spark, blocks(10, 19, "a", 20))
    for step in ("_commit_cold", "_save"):
        with monkeypatch.context() as m:
            m.setattr(store, step, stop)
            with pytest.raises(Stop):
                store.apply_final(part, to_events, "s", 1)
        store = again(spark, store)
    store.apply_final(part, to_events, "s", 1)
    assert seen(store) == expected(chain_of(0, 19))
    assert spark.table(store.cold_name("test_events")).count() == 40


# ---- moves -----------------------------------------------------------------------------------------


def test_moves_keep_every_row_visible_once(spark):
    store = new_store(spark)
    store.apply_hot(batch(spark, blocks(1, 10) + blocks(9, 20, "b", 30), finalized=14), to_events, "s", 0)
    want = expected(chain_of(1, 8) + chain_of(9, 20, "b"))
    first = store.migrate()
    assert (first.cutoff_height, first.migrated) == (14, 28)
    assert first.tables[0].rows_in == first.tables[0].rows_out == 28
    assert seen(store) == want
    assert store.migrate().migrated == 0, "the cutoff has not advanced"
    store.apply_hot(batch(spark, blocks(21, 40, "b", 60), finalized=33), to_events, "s", 1)
    assert store.migrate().cutoff_height == 33
    assert seen(store) == expected(chain_of(1, 8) + chain_of(9, 40, "b"))
    assert seen(store, height_to=20) == want
    assert seen(store, height_from=34) == expected(chain_of(34, 40, "b"))
    assert seen(store, height_from=30, height_to=35) == expected(chain_of(30, 35, "b"))
    cold = spark.table(store.cold_name("test_events"))
    assert cold.filter("hash in ('a9', 'a10')").count() == 0, "orphans stay behind"
    assert store.hash_for_height(33) == "b33"
    assert store.hash_for_height(3) == "a3", "found in cold"
    assert store.hash_for_height(99) is None


def test_hashes_of_settled_blocks_need_no_scan_of_rows(spark, monkeypatch):
    store = new_store(spark, hold_to_finality=False)
    store.apply_final(batch(spark, blocks(0, 9)), to_events, "s", 0)
    store.apply_hot(batch(spark, blocks(10, 20, seq=50) + blocks(15, 30, "b", 80)), to_events, "s", 1)
    store.migrate(17)
    with monkeypatch.context() as m:  # a move that stops before its commit
        m.setattr(store, "_commit_cold", stop)
        with pytest.raises(Stop):
            store.migrate(22)
    store = again(spark, store)
    store.apply_hot(batch(spark, blocks(20, 34, "c", 200)), to_events, "s", 2)
    store.migrate(25)
    assert [r["height"] for r in store.registry().orderBy("height").collect()][0] > 10
    with monkeypatch.context() as m:
        m.setattr(store, "_committed_cold", stop)
        m.setattr(store, "_committed_hot", stop)
        found = {h: store.hash_for_height(h) for h in (0, 9, 10, 14, 15, 17, 18, 19, 20, 25, 26, 34)}
    assert found == {h: f"{'a' if h < 15 else 'b' if h < 20 else 'c'}{h}" for h in found}
    assert store.hash_for_height(99) is None


def test_cutoff_without_finality(spark):
    held = new_store(spark)
    held.apply_hot(batch(spark, blocks(1, 20), finalized=2), to_events, "s", 0)
    assert held.migrate().cutoff_height == 2
    plain = new_store(spark, hold_to_finality=False, drop_orphans=False)
    plain.apply_hot(batch(spark, blocks(1, 10) + blocks(10, 20, "b", 30)), to_events, "s", 0)
    assert plain.migrate().cutoff_height == 15
    cold = spark.table(plain.cold_name("test_events"))
    assert cold.filter("height = 10").select("hash").distinct().count() == 1, "newest per key"


def test_fork_below_the_cutoff_is_refused(spark):
    store = new_store(spark)
    store.apply_hot(batch(spark, blocks(1, 20), finalized=10), to_events, "s", 0)
    store.migrate()
    with pytest.raises(FinalityError):
        store.apply_hot(batch(spark, blocks(10, 12, "b", 50)), to_events, "s", 1)
    assert seen(store) == expected(chain_of(1, 20))


def test_trigger_and_hooks(spark):
    calls = []

    def before(context):
        calls.append(context)
        return len(calls) > 1

    store = new_store(
        spark, auto_migrate=True, migration_interval=10,
        hooks=MigrationHooks(before_migration=before, after_migration=calls.append),
    )
    store.apply_hot(batch(spark, blocks(1, 8), finalized=2), to_events, "s", 0)
    assert calls == []
    store.apply_hot(batch(spark, blocks(9, 12, "a", 20), finalized=6), to_events, "s", 1)
    assert len(calls) == 1 and calls[0].blocks_since_last_migration == 12
    assert calls[0].hot_table_rows == 24 and calls[0].finalized_height == 6
    assert store._state.blocks_since == 12, "a cancelled migration keeps the count"
    store.apply_hot(batch(spark, blocks(13, 13, "a", 30), finalized=6), to_events, "s", 2)
    assert isinstance(calls[-1], MigrationResult) and calls[-1].cutoff_height == 6
    assert store._state.blocks_since == 0
    assert seen(store) == expected(chain_of(1, 13))


def test_migration_on_finality_and_custom_body(spark):
    result = MigrationResult(0, 7, 1)
    seen_by = []
    store = new_store(
        spark, auto_migrate=True, migration_on_finality=True,
        hooks=MigrationHooks(custom_migration=lambda s: result, after_migration=seen_by.append),
    )
    store.apply_hot(batch(spark, blocks(1, 8), finalized=-1), to_events, "s", 0)
    assert seen_by == []
    store.apply_hot(batch(spark, blocks(9, 9, "a", 20), finalized=4), to_events, "s", 1)
    assert seen_by == [result]


def test_transform_is_applied_in_flight(spark):
    def transform(rows, context):
        assert (context.table, context.cutoff_height) == ("test_events", 10)
        return rows.filter("id % 10 = 0").withColumn("data", F.lit("seen"))

    store = new_store(spark, hooks=MigrationHooks(transform_rows=transform))
    store.apply_hot(batch(spark, blocks(1, 15), finalized=10), to_events, "s", 0)
    moved = store.migrate().tables[0]
    assert (moved.rows_in, moved.rows_out) == (20, 10)
    assert store.visible("test_events", height_to=10).filter("data = 'seen'").count() == 10
    assert store.visible("test_events").count() == 20


def test_a_transform_may_drop_everything(spark):
    store = new_store(spark, hooks=MigrationHooks(transform_rows=lambda rows, _: rows.filter("1 = 0")))
    store.apply_hot(batch(spark, blocks(1, 15), finalized=10), to_events, "s", 0)
    assert store.migrate().tables[0].rows_out == 0
    assert seen(store) == expected(chain_of(11, 15))


def test_a_failing_table_stays_in_hot(spark, monkeypatch):
    def handler(df):
        return {"test_events": df, "others": df}

    store = new_store(spark, events=(EVENTS, SECOND))
    store.apply_hot(batch(spark, blocks(1, 20), finalized=12), handler, "s", 0)
    real = store._stage_cold

    def broken(t, *a, **k):
        if t.name == "others":
            raise RuntimeError("disk")
        return real(t, *a, **k)

    with monkeypatch.context() as m:
        m.setattr(store, "_stage_cold", broken)
        result = store.migrate()
    assert [m.name for m in result.tables] == ["test_events"] and result.failed[0][0] == "others"
    want = expected(chain_of(1, 20))
    assert seen(store) == want and seen(store, "others") == want
    store = again(spark, store)
    store.apply_hot(batch(spark, blocks(21, 24, "a", 50), finalized=18), handler, "s", 1)
    assert {m.name for m in store.migrate().tables} == {"test_events", "others"}
    want = expected(chain_of(1, 24))
    assert seen(store) == want and seen(store, "others") == want


def test_rows_arriving_between_moves_are_kept(spark):
    store = new_store(spark)
    store.apply_hot(batch(spark, blocks(90, 100), finalized=95), to_events, "s", 0)
    store.migrate()
    store.apply_hot(batch(spark, blocks(101, 102, "a", 20), finalized=96), to_events, "s", 1)
    assert seen(store) == expected(chain_of(90, 102))


def test_compaction_merges_the_moves_of_a_month(spark, monkeypatch):
    store = new_store(spark)
    for n, low in enumerate((0, 10, 20)):
        store.apply_final(batch(spark, blocks(low, low + 9, "a", low)), to_events, "s", n)
    want = expected(chain_of(0, 29))
    with monkeypatch.context() as m:
        m.setattr(store, "_commit_cold", stop)
        with pytest.raises(Stop):
            store.compact_cold("test_events", "202401")
    assert seen(store) == want
    assert store.compact_cold("test_events", "202401") == 29
    assert seen(store) == want
    store.apply_final(batch(spark, blocks(30, 39, "a", 40)), to_events, "s", 3)
    assert seen(store) == expected(chain_of(0, 39))
    assert store.compact_cold("test_events", "202401") == 39
    assert seen(again(spark, store)) == expected(chain_of(0, 39))
    assert store.compact_cold("test_events", "202401") == 39
    moves = tb.partitions_of(spark, store.cold_name("test_events"), processor_id="default")
    assert {p["mig"] for p in moves if int(p["mig"]) < 0} >= {"-39"}


# ---- removals --------------------------------------------------------------------------------------


def two_zones(spark, **options):
    store = new_store(spark, hold_to_finality=False, **options)
    store.apply_final(batch(spark, blocks(0, 9)), to_events, "s", 0)
    for n in range(3):
        store.apply_hot(batch(spark, blocks(10 + 5 * n, 14 + 5 * n, seq=50 + 10 * n)), to_events, "s", n + 1)
    store.migrate(14)
    return store


def without(chain, gone):
    return [r for r in expected(chain) if not gone(r[2])]


def test_removals_are_committed_and_leave_old_readers_alone(spark):
    store = two_zones(spark)
    held = store.visible("test_events")
    assert store.remove("test_events", F.col("id") % 20 == 0) == 13
    want = without(chain_of(0, 24), lambda i: i % 20 == 0)
    assert seen(store) == want == seen(again(spark, store))
    assert store.remove("test_events", F.col("id") % 20 == 0) == 0, "nothing is left to remove"
    second = store.visible("test_events")
    assert store.remove("test_events", F.col("id") == 31) == 1 and store.remove("test_events", F.col("id") == 211) == 1
    assert sorted(r["id"] for r in held.collect()) == [i for *_, i in expected(chain_of(0, 24))]
    assert sorted(r["id"] for r in second.collect()) == [i for *_, i in want]
    want = [r for r in want if r[2] not in (31, 211)]
    assert seen(store) == want
    # What was removed stays removed through forks, moves and compactions.
    store.apply_hot(batch(spark, blocks(23, 30, "b", 200)), to_events, "s", 9)
    want = [r for r in want if r[0] < 23] + expected(chain_of(23, 30, "b"))
    assert seen(store) == want
    assert store.migrate(22).cutoff_height == 22 and seen(store) == want
    store.compact_cold("test_events", "202401")
    assert seen(store) == want
    assert store.migrate(27).cutoff_height == 27 and seen(again(spark, store)) == want
    assert store._state.rewrites == () or min(r[2] for r in store._state.rewrites) > 14
    store.remove("test_events", F.col("height") < 20)
    assert seen(store) == [r for r in want if r[0] >= 20]
    hot = tb.partitions_of(spark, store.hot_name("test_events"), processor_id="default")
    assert all(int(p["epoch"]) > 3 for p in hot), "old epochs and what replaced them are reclaimed"


@pytest.mark.parametrize("step", ["_commit_cold", "_remove_hot", "_save"])
def test_crash_inside_a_removal(spark, monkeypatch, step):
    store = two_zones(spark)
    gone = F.col("id") % 20 == 0
    with monkeypatch.context() as m:
        m.setattr(store, step, stop)
        with pytest.raises(Stop):
            store.remove("test_events", gone)
    cold_done = step != "_commit_cold"
    partly = without(chain_of(0, 24), lambda i: i % 20 == 0 and cold_done and i < 150)
    assert seen(store) == partly, "a zone is changed as a whole or not at all"
    back = again(spark, store)
    assert seen(back) == partly
    back.remove("test_events", gone)
    assert seen(back) == without(chain_of(0, 24), lambda i: i % 20 == 0)
    back.apply_hot(batch(spark, blocks(25, 26, seq=300)), to_events, "s", 9)
    assert seen(back) == without(chain_of(0, 24), lambda i: i % 20 == 0) + expected(chain_of(25, 26))


def test_replaced_months_go_after_a_while(spark):
    store = two_zones(spark, keep_versions_ms=0)
    store.remove("test_events", F.col("id") == 31)
    store.remove("test_events", F.col("id") == 41)
    assert seen(store) == without(chain_of(0, 24), lambda i: i in (31, 41))
    cold = tb.partitions_of(spark, store.cold_name("test_events"), processor_id="default")
    assert len(cold) == 1 and int(cold[0]["mig"]) < 0


def test_removal_keeps_the_newest_row_of_a_key(spark):
    store = new_store(spark)
    store.apply_hot(batch(spark, blocks(1, 3)), to_events, "s", 0)
    store.apply_hot(batch(spark, blocks(2, 4, "b", 10)), to_events, "s", 1)
    store.apply_hot(batch(spark, blocks(2, 3, "a", 20)), to_events, "s", 2)
    store.remove("test_events", F.col("id") == 10)
    assert seen(store) == [r for r in expected(chain_of(1, 3)) if r[2] != 10]


# ---- phases ----------------------------------------------------------------------------------------


def test_catch_up_then_head_then_catch_up_again(spark):
    store = new_store(spark)
    store.apply_final(batch(spark, blocks(0, 19)), to_events, "s", 0)
    assert spark.table(store.hot_name("test_events")).count() == 0
    cold = store.cold_status().first()
    assert (cold["height"], cold["hash"]) == (19, "a19")
    store.apply_hot(batch(spark, blocks(20, 30, "a", 30), finalized=22), to_events, "s", 1)
    store.apply_final(batch(spark, blocks(28, 40, "c", 60)), to_events, "s", 2)
    assert seen(store) == expected(chain_of(0, 27) + chain_of(28, 40, "c"))
    store.apply_hot(batch(spark, blocks(41, 45, "a", 90), finalized=41), to_events, "s", 3)
    assert seen(store) == expected(chain_of(0, 27) + chain_of(28, 40, "c") + chain_of(41, 45))


def test_mixed_batch_is_routed_by_is_head(spark):
    store = new_store(spark)
    part = batch(spark, blocks(0, 19), finalized=9).withColumn("is_head", F.col("height") > 9)
    store.apply(part, to_events, "s", 0)
    assert spark.table(store.cold_name("test_events")).count() == 20
    assert spark.table(store.hot_name("test_events")).count() == 20
    assert seen(store) == expected(chain_of(0, 19))
    epoch = store._state.epoch
    store.apply(part, to_events, "s", 0)
    assert store._state.epoch == epoch


@pytest.mark.parametrize("head_fails", [True, False])
def test_crash_in_a_mixed_batch(spark, monkeypatch, head_fails):
    store = new_store(spark)
    part = batch(spark, blocks(0, 19), finalized=9).withColumn("is_head", F.col("height") > 9)
    with monkeypatch.context() as m:
        m.setattr(store, "apply_hot" if head_fails else "_commit_cold", stop)
        with pytest.raises(Stop):
            store.apply(part, to_events, "s", 0)
    back = again(spark, store)
    back.apply(part, to_events, "s", 0)
    assert seen(back) == expected(chain_of(0, 19))


def test_stale_hot_blocks_are_cleared_and_read_again(spark):
    store = new_store(spark)
    store.apply_final(batch(spark, blocks(0, 9)), to_events, "s", 0)
    store.apply_hot(batch(spark, blocks(10, 20, "a", 30), finalized=12), to_events, "s", 1)
    quick = again(spark, store)
    assert quick.recovered.reason == "quick restart" and len(quick.recovered.top) == 8
    late = again(spark, store, now_ms=10**14)
    assert late.recovered.action == "clear"
    assert (late.recovered.height, late.recovered.hash, late.recovered.top) == (9, "a9", ())
    assert seen(late) == expected(chain_of(0, 9)), "cold is never touched"
    assert late.registry().count() == 0
    late.apply_hot(batch(spark, blocks(10, 22, "b", 60), finalized=15), to_events, "s", 2)
    assert seen(late) == expected(chain_of(0, 9) + chain_of(10, 22, "b"))
    assert late.migrate().cutoff_height == 15
    assert seen(late) == expected(chain_of(0, 9) + chain_of(10, 22, "b"))


def test_two_processors_share_tables(spark):
    one = new_store(spark, processor_id="one")
    two = new_store(spark, one.database, processor_id="two")
    one.apply_hot(batch(spark, blocks(1, 9), finalized=3), to_events, "s", 0)
    two.apply_hot(batch(spark, blocks(5, 20, "z"), finalized=11), to_events, "s", 0)
    assert two.migrate().cutoff_height == 11
    one.clear_hot(-1, "")
    assert seen(one) == []
    assert seen(two) == expected(chain_of(5, 20, "z"))
    assert seen(again(spark, two)) == expected(chain_of(5, 20, "z"))


def test_snapshot_rows_from_a_handler(spark):
    balances = tb.SnapshotTable("balances", "id bigint, height bigint, data string", ("id",), ("height",))
    store = ForkStore(spark, f"t_{uuid.uuid4().hex[:10]}", [EVENTS], [balances], StoreOptions(auto_migrate=False))
    store.connect()

    def handler(df):
        return {"test_events": df, "balances": df.withColumn("id", F.col("id") % 10)}

    store.apply_hot(batch(spark, blocks(1, 5)), handler, "s", 0)
    store.apply_hot(batch(spark, blocks(6, 7, "a", 20)), handler, "s", 1)
    got = sorted(map(tuple, store.snapshot("balances").collect()))
    assert got == [(0, 7, "a7/0"), (1, 7, "a7/1")]


def test_status_eras_are_dropped(spark, monkeypatch):
    from forktide.streaming import store as module

    monkeypatch.setattr(module, "ERA", 2)
    store = new_store(spark)
    for n in range(4):
        store.apply_hot(batch(spark, blocks(n, n, "a", n)), to_events, "s", n)
    eras = {p["era"] for p in tb.partitions_of(spark, store._status_name, id="default")}
    assert eras == {"1", "2"}
    assert again(spark, store)._state.epoch == 4


# ---- streams ---------------------------------------------------------------------------------------


def test_stream_restarts_after_a_failed_batch(spark, tmp_path):
    store = new_store(spark)
    source, checkpoint = str(tmp_path / "feed"), str(tmp_path / "checkpoint")
    schema = batch(spark, []).schema

    def stream():
        return spark.readStream.schema(schema).parquet(source)

    batch(spark, blocks(1, 10), finalized=3).write.mode("append").parquet(source)
    run_feed(store, stream(), to_events, checkpoint, mode="hot")
    batch(spark, blocks(9, 14, "b", 20), finalized=5).write.mode("append").parquet(source)

    def failing(df):
        raise RuntimeError("handler")

    with pytest.raises(Exception, match="handler"):
        run_feed(store, stream(), failing, checkpoint, mode="hot")
    assert seen(store) == expected(chain_of(1, 10))
    back = again(spark, store)
    run_feed(back, stream(), to_events, checkpoint, mode="hot")
    want = expected(chain_of(1, 8) + chain_of(9, 14, "b"))
    assert seen(back) == want
    epoch = back._state.epoch
    run_feed(back, stream(), to_events, checkpoint, mode="hot")
    assert (seen(back), back._state.epoch) == (want, epoch), "no new files, no new epoch"


def test_repeated_rows_are_dropped_within_the_delay(spark, tmp_path):
    source, out = str(tmp_path / "feed"), f"repeated_{uuid.uuid4().hex[:8]}"
    rows = batch(spark, blocks(1, 6)).select("id", "height", "hash", "seq", "at")
    rows.unionByName(rows).write.mode("append").parquet(source)
    stream = drop_repeated(
        spark.readStream.schema(rows.schema).parquet(source), ["id", "hash", "seq"], "at", "1 day"
    )
    query = stream.writeStream.format("memory").queryName(out).trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table(out).count() == 12


def test_transfers_from_logs_to_totals(spark):
    """Nested logs through the decoder into a keyed table with 256-bit values."""
    transfers = tb.EventTable(
        "erc20_transfers",
        "token string, `from` string, `to` string, value string, height bigint, hash string, "
        "block_timestamp timestamp, tx_hash string, log_index bigint",
        key=("token", "height", "log_index"), timestamp="block_timestamp", u256=("value",),
    )
    store = ForkStore(spark, f"t_{uuid.uuid4().hex[:10]}", [transfers], options=StoreOptions(hot_blocks_depth=3))
    store.connect()
    topic = "0x" + "0" * 24 + "Ab" * 20
    amounts = {1: 2**255, 2: 7, 3: 2**200, 4: 9}

    def log_rows(heights, fork, seq):
        return [
            (h, f"{fork}{h}", None, [(f"0x{h % 2}", [feed.TRANSFER_TOPIC, topic, topic], hex(amounts[h]), "0xt", 1)],
             seq + i, 2)
            for i, h in enumerate(heights)
        ]

    rows = spark.createDataFrame(
        log_rows([1, 2, 3, 4], "a", 0) + log_rows([3, 4], "b", 10),
        feed.BLOCK_SCHEMA + ", seq bigint, finalized_height bigint",
    )
    store.apply_hot(rows, lambda df: {"erc20_transfers": feed.decode_transfers(df)}, "s", 0)
    assert store.migrate().cutoff_height == 1
    totals = analytics.top_tokens(store.visible("erc20_transfers"))
    assert [tuple(r) for r in totals.collect()] == [
        ("0x0", 2, "16"), ("0x1", 2, str(2**255 + 2**200)),
    ]


def test_reader_of_an_old_registry_version(spark):
    # Every version is written as a whole, so the first one leaves the manifest.
    store = new_store(spark, keep_versions_ms=0, registry_spans=1)
    store.apply_hot(batch(spark, blocks(1, 5)), to_events, "s", 0)
    held = store.visible("test_events")
    for n in range(1, 4):
        store.apply_hot(batch(spark, blocks(5 + n, 5 + n, seq=10 * n)), to_events, "s", n)
    with pytest.raises(Exception, match="(?i)no such file|does not exist|not_exist|not found"):
        held.collect()
    assert seen(store) == expected(chain_of(1, 8))
    patient = new_store(spark)
    patient.apply_hot(batch(spark, blocks(1, 5)), to_events, "s", 0)
    held = patient.visible("test_events")
    for n in range(1, 6):
        patient.apply_hot(batch(spark, blocks(5 + n, 5 + n, seq=10 * n)), to_events, "s", n)
    assert sorted(r["height"] for r in held.collect()) == sorted([*range(1, 6)] * 2)
    with pytest.raises(MissingVersion, match="not there"):
        patient.registry(99)


def test_dropped_registry_versions_are_errors(spark):
    store = new_store(spark, keep_versions_ms=0, registry_spans=2)
    for n in range(5):
        store.apply_hot(batch(spark, blocks(1 + 3 * n, 3 + 3 * n, seq=10 * n)), to_events, "s", n)
    assert [r["height"] for r in store.registry(5).orderBy("height").collect()] == list(range(1, 16))
    with pytest.raises(MissingVersion, match="gone"):
        store.registry(1)
    kept = new_store(spark, registry_spans=2)
    for n in range(3):
        kept.apply_hot(batch(spark, blocks(1 + 3 * n, 3 + 3 * n, seq=10 * n)), to_events, "s", n)
    kept.clear_hot(-1, "")
    assert kept.registry().count() == 0, "empty, not missing"
    assert [kept.registry(v).count() for v in (1, 2, 3, 4)] == [3, 6, 9, 0]


def test_long_silence_of_finality(spark, monkeypatch):
    import forktide.streaming.store as module

    monkeypatch.setattr(module, "CHAIN_TAIL", 6)
    store = new_store(spark, registry_spans=3)
    for n in range(6):
        store.apply_hot(batch(spark, blocks(1 + 4 * n, 4 + 4 * n, seq=10 * n), finalized=2), to_events, "s", n)
        cell = spark.table(store._status_name).orderBy(F.desc("epoch")).first()["hot_blocks"]
        assert cell.count("height") <= 6
    assert store.hot_chain().count() == 22
    back = again(spark, store)
    assert back.recovered.top == tuple((h, f"a{h}") for h in range(19, 25))
    back.apply_hot(batch(spark, blocks(10, 12, "b", 100)), to_events, "s", 6)  # deeper than the cell
    assert seen(back) == expected(chain_of(1, 9) + chain_of(10, 12, "b"))
    assert [(r["height"], r["hash"]) for r in back.hot_chain().orderBy("height").collect()] == (
        chain_of(3, 9) + chain_of(10, 12, "b")
    )


def test_no_manual_move_while_catching_up(spark):
    store = new_store(spark, hold_to_finality=False)
    store.apply_final(batch(spark, blocks(0, 30)), to_events, "s", 0)
    assert store.migrate(40) == MigrationResult(0, -1, 0)
    assert store.cold_status().first()["height"] == 30
    store.apply_hot(batch(spark, blocks(31, 45, seq=50)), to_events, "s", 1)
    back = again(spark, store)
    assert back.migrate(40).cutoff_height == 40, "the head is remembered"


# ---- tables that move unevenly -----------------------------------------------------------------------


def uneven(spark, **options):
    """Two tables at cutoffs 100 and 50: the second one's later move failed."""
    failing = []

    def transform(rows, context):
        if context.table in failing:
            raise RuntimeError("cannot move")
        return rows

    store = new_store(
        spark, events=(EVENTS, SECOND), hold_to_finality=False,
        hooks=MigrationHooks(transform_rows=transform), **options,
    )
    store.apply_hot(batch(spark, blocks(1, 120)), to_both, "s", 0)
    store.migrate(50)
    failing.append("others")
    result = store.migrate(100)
    failing.clear()
    assert [name for name, _ in result.failed] == ["others"]
    assert store._cutoffs == {"test_events": 100, "others": 50}
    return store


def to_both(df):
    return {"test_events": df, "others": df}


def test_uneven_cutoffs_lose_nothing_after_a_clear(spark):
    store = uneven(spark)
    assert store.cold_status().first()["height"] == 50
    for table in ("test_events", "others"):
        assert seen(store, table) == expected(chain_of(1, 120))
    store.clear_hot(50, "a50")
    store.apply_final(batch(spark, blocks(51, 80, seq=200)), to_both, "s", 1)
    assert store._cutoffs == {"test_events": 100, "others": 80}
    store.apply_final(batch(spark, blocks(81, 120, seq=300)), to_both, "s", 2)
    for table in ("test_events", "others"):
        assert seen(store, table) == expected(chain_of(1, 120))
    assert again(spark, store)._cutoffs == {"test_events": 120, "others": 120}


def test_fork_between_the_cutoffs_is_refused(spark):
    store = uneven(spark)
    with pytest.raises(FinalityError):
        store.apply_hot(batch(spark, blocks(70, 121, "b", 200)), to_both, "s", 1)
    for table in ("test_events", "others"):
        assert seen(store, table) == expected(chain_of(1, 120))


def test_blocks_delivered_again_after_a_clear_serve_the_table_that_lags(spark):
    store = uneven(spark)
    store.clear_hot(50, "a50")
    store.apply_hot(batch(spark, blocks(51, 90, seq=200)), to_both, "s", 1)
    store.apply_hot(batch(spark, blocks(91, 125, seq=300)), to_both, "s", 2)
    for table in ("test_events", "others"):
        assert seen(store, table) == expected(chain_of(1, 125))


def test_a_lagging_table_catches_up_alone(spark):
    store = uneven(spark)
    assert store.migrate(100).failed == ()
    assert store.cold_status().first()["height"] == 100
    assert again(spark, store).recovered.top[-1] == (120, "a120")


def test_fork_below_the_finalized_height(spark):
    store = new_store(spark, log_operations=True)
    store.apply_hot(batch(spark, blocks(1, 60), finalized=40), to_events, "s", 0)
    with pytest.raises(FinalityError):
        store.apply_hot(batch(spark, blocks(20, 61, "b", 100)), to_events, "s", 1)
    # A base below the finalized height does not reach what is final.
    store.apply_hot(batch(spark, blocks(55, 61, "b", 100), base=30), to_events, "s", 1)
    assert seen(store) == expected(chain_of(1, 40) + chain_of(55, 61, "b"))
    store.apply_hot(batch(spark, blocks(62, 62, "b", 200)), to_events, "s", 2)
    ops = [r["op"] for r in store.operations().collect()]
    assert "parent_mismatch" in ops, "the test feed names no real parents"


@pytest.mark.parametrize("processor", ["eth:main", "it's 100% a/b=c"])
def test_special_characters_in_processor_ids(spark, processor):
    store = new_store(spark, processor_id=processor, hold_to_finality=False)
    store.apply_hot(batch(spark, blocks(1, 20)), to_events, "s", 0)
    assert store.migrate().cutoff_height == 15
    store.apply_hot(batch(spark, blocks(21, 40, seq=50)), to_events, "s", 1)
    assert store.migrate().cutoff_height == 35
    assert seen(again(spark, store)) == expected(chain_of(1, 40))
    assert store._hot_partitions()
    store.clear_hot(35, "a35")
    assert not store._hot_partitions()
    assert seen(store) == expected(chain_of(1, 35))


# ---- tables ----------------------------------------------------------------------------------------


def test_tables_are_created_once_with_their_properties(spark):
    database = f"t_{uuid.uuid4().hex[:10]}"
    snapshot = tb.SnapshotTable("test_snapshot", "id bigint, value string", ("id",))
    for _ in range(2):
        tb.create_tables(spark, database, "ethereum", [EVENTS], [snapshot])
    tables = spark.sql(f"SHOW TABLES IN {database}").filter("not isTemporary").collect()
    names = {r["tableName"] for r in tables}
    assert names == {"ethereum_hot_test_events", "ethereum_cold_test_events", "ethereum_test_snapshot"}
    properties = {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES {database}.ethereum_cold_test_events").collect()}
    assert (properties["zone"], properties["key"]) == ("cold", "height,id")


def test_physical_delete_rewrites_only_touched_partitions(spark):
    database = f"t_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {database}")
    name = f"{database}.parts"
    tb.create_partitioned(spark, name, "v bigint, p bigint", ["p"], {"zone": "single"})
    tb.overwrite_partitions(spark.range(40).select(F.col("id").alias("v"), (F.col("id") % 4).alias("p")), name)
    files = {f for f in spark.table(name).inputFiles() if "p=3" in f}
    assert tb.delete_where(spark, name, (F.col("p") == 0) | (F.col("v") == 9)) == 11
    assert sorted(r["v"] for r in spark.table(name).collect()) == [v for v in range(40) if v % 4 and v != 9]
    assert {f for f in spark.table(name).inputFiles() if "p=3" in f} == files
    assert {p["p"] for p in tb.partitions_of(spark, name)} == {"1", "2", "3"}
    spark.sql(f"CREATE TABLE {database}.static (v bigint, p bigint) USING parquet PARTITIONED BY (p)")
    with pytest.raises(ValueError):
        tb.require_dynamic(spark, f"{database}.static")
