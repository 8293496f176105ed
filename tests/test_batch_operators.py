"""Versions, deletes, migration decisions, restart state, operations log and contracts."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from forktide.functions import u256
from forktide.operators import (
    analytics,
    contracts,
    deletes,
    joins,
    lookups,
    migration,
    oplog,
    state,
    versions,
)
from forktide.operators.joins import BROADCAST_ROWS
from forktide.plans import QUERIES
from forktide.sources import feed, rows as row_ops


# ---- versions ------------------------------------------------------------------------------------


def test_latest_by_key(spark):
    df = spark.createDataFrame(
        [(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (2, 5, None)], "k int, v int, x string"
    )
    got = sorted(map(tuple, versions.latest_by_key(df, ["k"], ["v"]).collect()))
    assert got == [(1, 3, "c"), (2, 5, None)]
    assert versions.latest_by_key(df, ["k"], ["v"]).columns == df.columns


def test_latest_by_key_reduces_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    plan = versions.latest_by_key(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max_by") > plan.index("Exchange")


def test_collapse_signs(spark):
    df = spark.createDataFrame(
        [(1, 1, 0, "a"), (2, 1, 0, "b"), (2, -1, 1, "b"), (3, 1, 0, "old"), (3, -1, 1, "old"), (3, 1, 2, "new")],
        "k int, sign int, s int, x string",
    )
    got = sorted((r["k"], r["x"], r["sign"]) for r in versions.collapse_signs(df, ["k"], ["s"]).collect())
    assert got == [(1, "a", 1), (3, "new", 1)]


def test_newest(spark):
    df = spark.createDataFrame([(1, "a"), (3, "c"), (2, "b")], "t int, x string")
    assert versions.newest(df, ["t"]).first()["x"] == "c"
    assert versions.newest(df.limit(0), ["t"]).count() == 0


# ---- deletes -------------------------------------------------------------------------------------


@pytest.fixture
def signed(spark):
    return spark.createDataFrame(
        [(i, 1, 0, "x" if i % 2 else "y") for i in range(10)], "k int, sign int, s int, pool string"
    )


def test_removal_by_predicate_and_reinsert(signed):
    stones = deletes.removal_by_predicate(signed, "pool = :p", ["k"], ["s"], params={"p": "x"})
    assert stones.filter("sign <> -1").count() == 0
    after = signed.unionByName(stones)
    live = versions.collapse_signs(after, ["k"], ["s"])
    assert sorted(r["k"] for r in live.collect()) == [0, 2, 4, 6, 8]
    assert deletes.removal_report("t", F.lit("sign"), stones).first()["removed"] == 5
    back = after.unionByName(signed.filter("k = 1").withColumn("s", F.lit(5)))
    again = versions.collapse_signs(back, ["k"], ["s"])
    assert sorted(r["k"] for r in again.collect()) == [0, 1, 2, 4, 6, 8]


def test_removing_twice_removes_once(signed):
    once = signed.unionByName(deletes.removal_by_predicate(signed, "k < 3", ["k"], ["s"]))
    assert deletes.removal_by_predicate(once, "k < 3", ["k"], ["s"]).count() == 0


def test_removal_by_query(spark, signed):
    stones = deletes.removal_by_query(
        spark, "SELECT * FROM {t} WHERE k >= :low", {"low": 8}, t=signed
    )
    live = versions.collapse_signs(signed.unionByName(stones), ["k"], ["s"])
    assert live.count() == 8


def test_tables_without_sign_lose_rows_by_id(spark):
    df = spark.createDataFrame([(i, 0) for i in range(6)], "k int, s int")
    gone = deletes.removal_by_predicate(df, "k in (1, 2)", ["k"], ["s"])
    left = deletes.without_ids(df, gone, ["k"])
    assert sorted(r["k"] for r in left.collect()) == [0, 3, 4, 5]


# ---- migration -----------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("args", "due"),
    [
        ((True, True, False, 0, 0, 30, 30), True),
        ((True, True, False, 0, 0, 20, 30), False),
        ((True, False, False, 0, 0, 30, 30), False),
        ((True, True, False, 0, 0, 10, 30), False),
        ((False, True, False, 0, 0, 99, 30), False),
        ((True, True, True, 990, 1000, 0, 30), True),
        ((True, True, True, 1000, 1000, 99, 30), False),
    ],
)
def test_trigger(args, due):
    assert migration.should_migrate(*args) is due


@pytest.mark.parametrize(("top", "cut"), [(1000, 950), (24111288, 24111238)])
def test_cutoff(spark, top, cut):
    df = spark.range(1).select(F.lit(top).alias("m"))
    got = df.select(
        migration.cutoff(F.col("m"), 50).alias("a"),
        migration.cutoff(F.col("m"), 50, F.lit(cut - 25)).alias("b"),
    ).first()
    assert tuple(got) == (cut, cut - 25)


def test_split_at_cutoff(spark):
    hot = spark.range(24111200, 24111300).select(F.col("id").alias("height"))
    moved = migration.rows_to_move(hot, -1, 24111249)
    assert moved.count() == 50
    assert hot.filter("height > 24111249").count() == 50
    large = spark.range(5000).select(F.col("id").alias("height"))
    assert migration.rows_to_move(large, -1, 4950).count() == 4951
    assert migration.rows_to_move(hot.limit(0), -1, 1000).count() == 0


def test_cutoff_report_of_empty_tables(spark):
    empty = spark.createDataFrame([], "height bigint")
    got = migration.cutoff_report([empty, empty], 10, None, F.lit(-1)).first()
    assert (got["max_height"], got["should_move"]) == (None, False)
    one = spark.createDataFrame([(100,)], "height bigint")
    assert migration.cutoff_report([empty, one], 10, None, F.lit(-1)).first()["cutoff"] == 90
    assert not migration.cutoff_report([one], 10, None, F.lit(90)).first()["should_move"]


def test_move_drops_orphans_and_old_versions(spark):
    hot = spark.createDataFrame(
        [(1, "a", 1, 1), (1, "b", 1, 0), (1, "a", 1, 2), (2, "a", 2, 3), (3, "a", 3, 4)],
        "height bigint, hash string, id bigint, seq bigint",
    )
    registry = spark.createDataFrame([(h, "a") for h in (1, 2, 3)], "height bigint, hash string")
    moved = migration.rows_to_move(hot, 0, 2, registry, ["id"], ["seq"], max_blocks=2)
    assert sorted((r["id"], r["seq"]) for r in moved.collect()) == [(1, 2), (2, 3)]
    assert migration.rows_to_move(hot, 0, 2).count() == 4


def test_move_totals(spark):
    moves = spark.createDataFrame([(1, "a", 5), (1, "b", 7), (2, "a", 1)], "migration_id int, table_name string, n_rows int")
    got = {(r[0], r[1]): r[2] for r in migration.move_totals(moves).collect()}
    assert got[None, None] == 13
    assert got[1, None] == 12
    assert got[1, "b"] == 7


@pytest.mark.parametrize("max_keys", [None, 2])
def test_blocks_since(spark, max_keys):
    blocks = spark.createDataFrame([("p", i) for i in range(35)] + [("q", 3)], "processor_id string, seq bigint")
    moves = spark.createDataFrame([("p", 24)], "processor_id string, seq bigint")
    got = migration.blocks_since(blocks, moves, ["processor_id"], max_keys=max_keys).collect()
    assert {r[0]: r[1] for r in got} == {"p": 10, "q": 1}


# ---- restart state -------------------------------------------------------------------------------

HOT = json.dumps([{"height": 101, "hash": "h101", "fee": 9}, {"height": 102, "hash": "h102"}])


def status(spark, last_run=1_000_000, hot=HOT, finalized=100, finalized_hash="f100"):
    row = ("p", 102, "h102", "h101", hot, finalized, finalized_hash, last_run)
    return spark.createDataFrame([row], (
        "id string, height bigint, hash string, parent_hash string, hot_blocks string, "
        "finalized_height bigint, finalized_hash string, last_run bigint"
    )).withColumn("timestamp", F.timestamp_millis(F.lit(last_run or 0)))


def test_recovery_starts_at_the_finalized_pair(spark):
    got = state.recover_state(status(spark)).first()
    assert (got["height"], got["hash"], got["finalized_height"]) == (100, "f100", 100)
    assert [tuple(b) for b in got["top"]] == [(101, "h101"), (102, "h102")]


def test_recovery_falls_back_to_the_tip(spark):
    got = state.recover_state(status(spark, finalized=0, finalized_hash="", hot="")).first()
    assert (got["height"], got["hash"], got["top"]) == (102, "h102", [])


def test_genesis(spark):
    known = spark.createDataFrame([("new",)], "id string")
    got = state.recover_state(status(spark), known).first()
    assert (got["height"], got["hash"], got["top"], got["finalized_height"]) == (-1, "", [], None)


@pytest.mark.parametrize(
    ("kw", "now", "threshold", "trust", "action", "reason"),
    [
        ({"hot": "[]"}, 9e9, 600_000, True, "keep", "no hot blocks"),
        ({}, 1_000_001, 600_000, False, "clear", "restart not trusted"),
        ({"last_run": 0}, 1_000_001, 600_000, True, "clear", "no last run"),
        ({}, 1_000_000 + 599_999, 600_000, True, "keep", "quick restart"),
        ({}, 1_000_000 + 600_000, 600_000, True, "clear", "long downtime"),
        ({}, 1_000_000, 0, True, "clear", "long downtime"),
        ({}, 9e15, None, True, "keep", "quick restart"),
    ],
)
def test_stale_decision(spark, kw, now, threshold, trust, action, reason):
    recovered = state.recover_state(status(spark, **kw))
    got = state.stale_decision(recovered, F.lit(int(now)), threshold, trust).first()
    assert (got["action"], got["reason"]) == (action, reason)


def test_rolled_back_state(spark):
    decided = state.stale_decision(state.recover_state(status(spark)), F.lit(10**12))
    as_it_was = state.rolled_back_state(decided).first()
    assert (as_it_was["height"], as_it_was["hash"], as_it_was["top"]) == (100, "f100", [])
    cold = spark.createDataFrame([("p", 90, "c90")], "id string, height bigint, hash string")
    safe = state.rolled_back_state(decided, cold).first()
    assert (safe["height"], safe["hash"], safe["top"]) == (90, "c90", [])


# ---- operations log ------------------------------------------------------------------------------


def log(spark, entries):
    defaults = dict(processor_id="p", ok=True, finalized=None, amount=None, height=None,
                    duration_ms=None, at_ms=0, table_name=None, rows_in=None, rows_out=None)
    names = [c.split()[0] for c in oplog.LOG_SCHEMA.split(", ")]
    rows = [tuple({**defaults, "seq": i, **e}[n] for n in names) for i, e in enumerate(entries)]
    return spark.createDataFrame(rows, oplog.LOG_SCHEMA)


def test_summary(spark):
    got = oplog.summary(log(spark, [
        dict(op="connection", at_ms=5), dict(op="connection", ok=False, at_ms=6),
        dict(op="blocks", amount=10, finalized=True), dict(op="blocks", amount=3, finalized=False),
        dict(op="fork_detected"), dict(op="fork_executed", height=7, amount=2, at_ms=9),
        dict(op="insert", duration_ms=10), dict(op="insert", duration_ms=30),
        dict(op="insert", ok=False, duration_ms=99), dict(op="query", duration_ms=4),
        dict(op="status", at_ms=11),
    ])).first().asDict()
    want = dict(connections=1, connection_errors=1, last_connection_ms=5, blocks_processed=13,
                blocks_finalized=10, hot_blocks_processed=3, forks_detected=1, forks_executed=1,
                last_fork_height=7, last_fork_ms=9, blocks_rolled_back=2, inserts=3,
                insert_errors=1, last_insert_ms=30, avg_insert_ms=20.0, queries=1, query_errors=0,
                last_query_ms=4, avg_query_ms=4.0, status_updates=1, last_status_ms=11)
    assert {k: got[k] for k in want} == want


def test_means_keep_the_last_hundred(spark):
    entries = [dict(op="insert", duration_ms=i) for i in range(250)]
    got = oplog.recent_means(log(spark, entries)).first()["mean_ms"]
    assert got == sum(range(150, 250)) / 100
    rolling = oplog.rolling_means(log(spark, entries)).orderBy("seq").collect()
    assert rolling[-1]["mean_ms"] == got
    assert rolling[0]["mean_ms"] == 0


def test_long_form(spark):
    summary = oplog.summary(log(spark, [dict(op="connection", at_ms=1500)]))
    got = {r["name"]: (r["type"], r["value"]) for r in oplog.long_form(summary, "db_").collect()}
    assert len(got) == 21
    assert got["db_last_connection_timestamp"] == ("gauge", 1.5)
    assert got["db_connections_total"] == ("counter", 1.0)


# ---- contracts, rows, feed -----------------------------------------------------------------------


def test_contract_lists_every_problem():
    tables = {"good": ["id", "height", "hash"], "bad": ["id", "hash"], "worse": ["id"]}
    problems = contracts.schema_problems(tables)
    assert len(problems) == 3
    assert "available: id, hash" in problems[0]
    contracts.require_contract({"x": ["block_number", "hash"]}, height="block_number")
    with pytest.raises(contracts.ContractError, match="bad"):
        contracts.require_contract(tables)


def test_row_report(spark):
    df = spark.createDataFrame(
        [(1, 5, "aa"), (1, 5, "aa"), (2, None, "aa"), (3, -1, "a"), (4, 1, None)],
        "id int, height bigint, hash string",
    )
    got = contracts.row_report("t", df, ["id"], text_lengths={"hash": 2}).first().asDict()
    assert (got["n_rows"], got["null_height"], got["negative_height"]) == (5, 1, 1)
    assert (got["wrong_length"], got["duplicate_rows"]) == (2, 1)


def test_hash_lookup_order(spark):
    def known(*items):
        return spark.createDataFrame(list(items), "height bigint, hash string")

    got = lookups.hash_by_height(
        known((5, "chain")), known((5, "reg"), (4, "reg4")), known((4, "cold"), (3, "z"), (3, "c")),
        known((3, "hot"), (2, "h"), (1, "")),
    ).collect()
    assert {r["height"]: (r["hash"], r["place"]) for r in got} == {
        5: ("chain", "hot_chain"), 4: ("reg4", "registry"), 3: ("c", "cold"), 2: ("h", "hot"),
    }
    empty = spark.createDataFrame([], "height bigint")
    assert lookups.latest_height([empty, empty]).first()[0] == -1


def test_routing(spark):
    df = spark.createDataFrame([("Token", True), ("Token", False)], "entity string, head boolean")
    got = [r["target"] for r in row_ops.route(df, "entity", F.col("head"), "base").collect()]
    assert got == ["base_hot_tokens", "base_cold_tokens"]


def test_normalise(spark):
    df = spark.createDataFrame(
        [("0xab", "7", ["x"], 3)], "code string, big string, tags array<string>, n bigint"
    ).withColumn("wide", F.lit("123456789012345678901234567890").cast("decimal(38,0)"))
    got = row_ops.normalise_rows(df, hex_fields=["code"], u256_fields=["big"]).first()
    assert (got["code"], got["big"], got["tags"], got["n"]) == ("ab", "7".zfill(78), ["x"], 3)
    assert got["wide"] == "123456789012345678901234567890"


def test_decode_transfers(spark):
    address = "0x" + "Ab" * 20
    topic = "0x" + "0" * 24 + "Cd" * 20
    data = "0x" + format(2**255 + 12345, "064x")
    good = (address, [feed.TRANSFER_TOPIC, topic, topic], data, "0xtx", 4)
    other = (address, ["0x00", topic, topic], data, "0xtx", 5)
    bare = (address, [], data, "0xtx", 6)
    df = spark.createDataFrame([(9, "h", None, [good, other, bare])], feed.BLOCK_SCHEMA)
    got = feed.decode_transfers(df).collect()
    assert len(got) == 1
    r = got[0]
    assert (r["token"], r["from"], r["to"]) == (address.lower(), "0x" + "cd" * 20, "0x" + "cd" * 20)
    assert r["value"] == str(2**255 + 12345).zfill(78)
    assert (r["height"], r["log_index"], r["tx_hash"]) == (9, 4, "0xtx")


def test_top_tokens_breaks_ties_and_since_prunes(spark):
    df = spark.createDataFrame([("b", "1"), ("a", "2"), ("c", "3"), ("c", "4")], "token string, value string")
    top = analytics.top_tokens(df.withColumn("value", u256.pad(F.col("value"))), 2).collect()
    assert [tuple(r) for r in top] == [("c", 2, "7"), ("a", 1, "2")]


def test_json_lines_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, None)], "id bigint, s string")
    feed.write_json_lines(df, str(tmp_path / "j"))
    back = feed.read_json_lines(spark, str(tmp_path / "j"), "id bigint, s string")
    assert sorted(map(tuple, back.collect())) == [(1, "x"), (2, None)]


def test_a_move_over_many_blocks_merges_with_the_registry(spark):
    """Beyond BROADCAST_ROWS blocks the registry is neither broadcast nor repeated per salt."""
    hot = spark.range(1_000).selectExpr("id", "id div 10 as height", "concat('h', id div 10) as hash", "id as seq")
    registry = spark.range(0, 100, 2).selectExpr("id as height", "concat('h', id) as hash")
    moved = migration.rows_to_move(
        hot, -1, 89, registry, ["height", "id"], ["seq"], max_blocks=BROADCAST_ROWS + 1, salt_by=["height", "id"]
    )
    assert moved.count() == 450
    plan = moved._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan and "Generate" not in plan


def test_tables_flushed_with_many_blocks_repeat_no_registry(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 5)
    counted = QUERIES["flushed_tables"](spark, sf_dir)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_type").count()
    assert sorted(map(tuple, counted.collect())) == sorted(map(tuple, events.collect()))
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Generate" not in plan
