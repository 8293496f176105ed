from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from forktide.operators import chain, joins, visible
from model import random_deliveries, stack_chain

P = "p"


def blocks(spark, pairs, start=0):
    rows = [(P, h, x, start + i) for i, (h, x) in enumerate(pairs)]
    return spark.createDataFrame(rows, "processor_id string, height bigint, hash string, seq bigint")


def pairs(df):
    return sorted((r["height"], r["hash"]) for r in df.collect())


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("width", [16, 1 << 16])
def test_canonical_chain_equals_a_stack(spark, seed, width):
    rng = random.Random(seed)
    feeds = {p: random_deliveries(rng, n, 0.05) for p, n in (("a", 1500), ("b", 40))}
    rows = [(p, h, x, s) for p, feed in feeds.items() for s, h, x in feed]
    df = spark.createDataFrame(
        rows, "processor_id string, height bigint, hash string, seq bigint"
    ).repartition(6)
    got = chain.canonical_chain(df, width=width)
    for p, feed in feeds.items():
        assert pairs(got.filter(F.col("processor_id") == p)) == stack_chain(feed)


def test_canonical_chain_of_few_heights(spark):
    feed = random_deliveries(random.Random(9), 300, 0.2)
    df = blocks(spark, [(h, x) for _, h, x in feed])
    assert pairs(chain.canonical_chain(df)) == stack_chain(feed)


def test_fork_replaces_the_upper_part(spark):
    old = [(95 + i, f"0x{c}") for i, c in enumerate("abcdef")]
    new = [(98, "0xNEW1"), (99, "0xNEW2"), (100, "0xNEW3")]
    got = pairs(chain.canonical_chain(blocks(spark, old + new)))
    assert len(got) == 6
    assert got[2] == (97, "0xc")
    after = chain.after_fork(blocks(spark, old), F.lit(98), blocks(spark, new, 6))
    assert pairs(after) == got


def test_fork_cut_keeps_lower_blocks(spark):
    registry = blocks(spark, [(h, f"h{h}") for h in range(97, 101)])
    assert pairs(chain.after_fork(registry, F.lit(99), registry.limit(0))) == [
        (97, "h97"),
        (98, "h98"),
    ]


def test_registry_swap(spark):
    registry = blocks(spark, [(1, "a"), (2, "b"), (3, "c"), (4, "d")])
    new = blocks(spark, [(3, "NEW1"), (4, "NEW2")], 4)
    assert [x for _, x in pairs(chain.after_fork(registry, F.lit(3), new))] == [
        "a", "b", "NEW1", "NEW2",
    ]


@pytest.mark.parametrize(("first", "fork"), [(99, True), (101, False), (100, True)])
def test_fork_detection(first, fork):
    assert chain.fork_detected(100, first) is fork


def test_fork_detection_needs_both_sides():
    assert not chain.fork_detected(None, 5)
    assert not chain.fork_detected(5, None)


def test_mark_forks(spark):
    marked = chain.mark_forks(blocks(spark, [(1, "a"), (2, "b"), (2, "c"), (3, "d")]))
    got = {r["seq"]: (r["tip"], r["is_fork"]) for r in marked.collect()}
    assert got == {0: (None, False), 1: (1, False), 2: (2, True), 3: (2, False)}


def test_common_ancestor_by_hash_and_by_base(spark):
    old = blocks(spark, [(10, "x10"), (11, "x11"), (12, "x12")])

    def step(pairs_, base):
        return blocks(spark, pairs_).withColumn("step", F.lit(1)).withColumn("fin", F.lit(5)).withColumn(
            "base", F.lit(base).cast("bigint")
        )

    overlapping = step([(10, "x10"), (11, "y11")], 9)
    got = chain.common_ancestor(overlapping, old, ["step"], F.col("fin")).first()
    assert got["ancestor"] == 10
    only_new = step([(11, "y11"), (12, "y12")], 10)
    by_hash = chain.common_ancestor(only_new, old, ["step"], F.col("fin")).first()
    assert by_hash["ancestor"] == 5
    by_base = chain.common_ancestor(only_new, old, ["step"], F.col("fin"), F.col("base")).first()
    assert by_base["ancestor"] == 10
    no_base = step([(11, "y11"), (12, "y12")], None)
    below = chain.common_ancestor(no_base, old, ["step"], F.col("fin"), F.col("base")).first()
    assert below["ancestor"] == 10


@pytest.mark.parametrize(("n", "depth", "low", "top"), [(20, 10, 10, 19), (100, 50, 50, 99)])
def test_depth_limit(spark, n, depth, low, top):
    tail = chain.chain_tail(blocks(spark, [(h, f"h{h}") for h in range(n)]), depth)
    heights = [h for h, _ in pairs(tail)]
    assert (len(heights), heights[0], heights[-1]) == (depth, low, top)


def test_registering_overwrites_a_height_and_pruning_keeps_depth_plus_one(spark):
    registry = blocks(spark, [(h, f"h{h}") for h in range(0, 31)])
    again = blocks(spark, [(30, "new"), (31, "h31")], 100)
    both = chain.register(registry, again)
    assert pairs(both)[-2:] == [(30, "new"), (31, "h31")]
    pruned = pairs(chain.prune_below(both, F.lit(31 - 10)))
    assert (len(pruned), pruned[0][0]) == (11, 21)


def test_bounds_of_an_empty_registry(spark):
    known = spark.createDataFrame([(P,), ("none",)], "processor_id string")
    got = {r[0]: tuple(r)[1:] for r in chain.bounds(blocks(spark, [(3, "a"), (7, "b")]), known).collect()}
    assert got == {P: (7, 3, 2), "none": (-1, -1, 0)}


def test_finality_never_steps_back(spark):
    hot = blocks(spark, [(h, f"h{h}") for h in range(5, 10)])
    assert len(pairs(chain.advance_finality(hot, F.lit(7), F.lit(6)))) == 2
    assert len(pairs(chain.advance_finality(hot, F.lit(4), F.lit(8)))) == 1


def test_unregistered(spark):
    registry = blocks(spark, [(1, "a"), (2, "b")])
    new = blocks(spark, [(2, "b"), (2, "c"), (3, "d")])
    assert pairs(chain.unregistered(new, registry)) == [(2, "c"), (3, "d")]


# ---- visibility ----------------------------------------------------------------------------------


def rows(spark, items):
    return spark.createDataFrame(items, "height bigint, hash string, id bigint")


def test_registry_filter(spark):
    data = rows(spark, [(1, "a", 1), (2, "ORPHAN", 2), (2, "b", 3), (3, "c", 4)])
    registry = blocks(spark, [(1, "a"), (2, "b"), (3, "c")])
    got = visible.valid_rows(data, registry, F.lit(0), max_blocks=3)
    assert sorted(r["id"] for r in got.collect()) == [1, 3, 4]
    orphans = visible.orphan_rows(data, registry, max_blocks=3)
    assert [r["id"] for r in orphans.collect()] == [2]


def test_empty_registry_shows_old_rows_only(spark):
    data = rows(spark, [(1, "a", 1), (9, "z", 2)])
    got = visible.valid_rows(data, blocks(spark, []), F.lit(5))
    assert [r["id"] for r in got.collect()] == [1]


def test_old_orphans_pass_the_threshold(spark):
    data = rows(spark, [(1, "x", 1), (1, "a", 2), (9, "b", 3), (9, "y", 4)])
    got = visible.valid_rows(data, blocks(spark, [(1, "a"), (9, "b")]), F.lit(5))
    assert sorted(r["id"] for r in got.collect()) == [1, 2, 3]


@pytest.mark.parametrize("how", ["broadcast", "salted", "shuffled"])
def test_join_strategies_agree(spark, how):
    """One block holds a third of all rows."""
    items = [(5, "a", i) for i in range(300)] + [(h, "ab"[h % 2], h) for h in range(600)]
    data = rows(spark, items)
    registry = blocks(spark, [(h, "a") for h in range(0, 600, 3)])
    extra = {
        "broadcast": {"max_blocks": 200},
        "salted": {"salt_by": ["id"]},
        "shuffled": {},
    }[how]
    good = {(h, "a") for h in range(0, 600, 3)}
    valid = visible.registered_rows(data, registry, **extra)
    orphans = visible.orphan_rows(data, registry, **extra)
    assert sorted(map(tuple, valid.collect())) == sorted(i for i in items if i[:2] in good)
    assert sorted(map(tuple, orphans.collect())) == sorted(i for i in items if i[:2] not in good)
    plan = valid._jdf.queryExecution().toString()
    assert ("BroadcastHashJoin" in plan.split("== Physical Plan ==")[1]) or how != "broadcast"


@pytest.mark.parametrize("adaptive", ["true", "false"])
@pytest.mark.parametrize("salt_by", [["id"], []])
def test_a_side_of_unknown_size_is_never_broadcast(spark, adaptive, salt_by):
    """Files of a few KB hold more rows than a driver can; repeated per salt they are 32 times as many."""
    data = rows(spark, [(5, "a", i) for i in range(300)] + [(7, "b", 300)])
    registry = blocks(spark, [(h, "a") for h in range(600)])
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        for how in ("left_semi", "left_anti", "left", "inner"):
            joined = joins.keyed_join(data, registry, ["height", "hash"], how, salt_by=salt_by)
            assert joined.count() == {"left_semi": 300, "left_anti": 1, "left": 301, "inner": 300}[how]
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Broadcast" not in plan
            # The keyed side is repeated only where nothing else spreads a hot key.
            assert ("Generate" in plan) == (bool(salt_by) and adaptive == "false")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_zone_union_reads_each_row_once(spark):
    data = rows(spark, [(h, "a", h) for h in range(100)])
    cold, hot = data.filter("height <= 60"), data.filter("height > 30")
    assert visible.zone_union(cold, hot, 50).count() == 100
    assert visible.zone_union(cold, hot, F.lit(50)).count() == 100


def test_zone_union_leaves_a_zone_out(spark):
    data = rows(spark, [(h, "a", h) for h in range(100)])
    cold, hot = data.filter("height <= 50"), data.filter("height > 50")

    def unions(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("Union")

    below = visible.zone_union(cold, hot, 50, height_to=40)
    above = visible.zone_union(cold, hot, 50, height_from=51)
    across = visible.zone_union(cold, hot, 50, 40, 60)
    assert (below.count(), above.count(), across.count()) == (41, 49, 21)
    assert (unions(below), unions(above), unions(across)) == (0, 0, 1)


def test_zone_order_and_partition_check(spark):
    data = rows(spark, [(24111200 + i, "a", i) for i in range(100)])
    cut = 24111299 - 50
    moved, stayed = data.filter(F.col("height") <= cut), data.filter(F.col("height") > cut)
    assert moved.count() == stayed.count() == 50
    assert stayed.agg(F.min("height")).first()[0] > moved.agg(F.max("height")).first()[0]
    got = visible.partition_check(data, moved, stayed, ["id"]).first()
    assert tuple(got) == (100, 50, 50, 0, 0, 0)
    lossy = visible.partition_check(data, moved.limit(49), stayed, ["id"]).first()
    assert (lossy["lost"], lossy["extra"]) == (1, 0)
    twice = visible.partition_check(data, data, stayed, ["id"]).first()
    assert (twice["extra"], twice["in_both"]) == (50, 50)
