"""The registry log against a dictionary of blocks."""

from __future__ import annotations

import random
import uuid

import pytest
from pyspark.sql import functions as F

from forktide.streaming import registry_log
from forktide.streaming.registry_log import MissingVersion, RegistryLog, Span


@pytest.fixture
def make_log(spark):
    def make(most=4, processor="p", database=None):
        database = database or f"r_{uuid.uuid4().hex[:10]}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        log = RegistryLog(spark, f"{database}.valid_blocks", processor, most)
        log.create()
        return log

    return make


def as_blocks(spark, chain):
    rows = spark.createDataFrame(chain, "height bigint, hash string")
    return rows.withColumn("timestamp", F.timestamp_seconds(F.lit(0)))


def found(log, spans, from_=None):
    return {r["height"]: r["hash"] for r in log.read(spans, from_).collect()}


def test_spans_are_cut():
    spans = (Span(1, 0, 4), Span(2, 5, 9), Span(3, 12, 12))
    assert registry_log.cut(spans, below=5) == (Span(1, 0, 4),)
    assert registry_log.cut(spans, below=7) == (Span(1, 0, 4), Span(2, 5, 6))
    assert registry_log.cut(spans, from_=9) == (Span(2, 9, 9), Span(3, 12, 12))
    assert registry_log.cut(spans, 0) == registry_log.cut(spans, from_=13) == ()
    assert registry_log.from_text(registry_log.to_text(spans)) == spans
    assert registry_log.from_text(None) == () and registry_log.tip(()) is None and registry_log.tip(spans) == 12


@pytest.mark.parametrize("most", [1, 4])
def test_random_changes_against_a_dictionary(spark, make_log, most):
    log, r = make_log(most), random.Random(most)
    spans, chain, floor = (), {}, 0
    for version in range(1, 25):
        tip = max(chain, default=0)
        fork = max(floor + 1, tip + 1 - r.choice([0, 0, 0, 2, 9]))
        new = {h: f"{version}:{h}" for h in range(fork, fork + r.randint(1, 5)) if h == fork or r.random() < 0.8}
        floor = max(floor, fork - r.choice([4, 30]))
        chain = {h: x for h, x in chain.items() if floor <= h < fork} | new
        spans, hash = log.publish(version, spans, as_blocks(spark, sorted(new.items())), below=fork, from_=floor)
        assert found(log, spans) == chain
        assert hash == chain[max(chain)] and registry_log.tip(spans) == max(chain)
        assert len(spans) <= most
        assert found(log, spans, fork) == new
        log.drop_outdated(spans, 0)
        assert set(log.versions()) == {s.version for s in spans}


def test_a_version_published_again_is_replaced(spark, make_log):
    log = make_log()
    first, _ = log.publish(1, (), as_blocks(spark, [(1, "a"), (2, "b")]))
    log.publish(2, first, as_blocks(spark, [(2, "x"), (3, "y"), (4, "z")]), below=2)
    again, _ = log.publish(2, first, as_blocks(spark, [(3, "c")]), below=3)
    assert found(log, again) == {1: "a", 2: "b", 3: "c"}
    assert found(log, first) == {1: "a", 2: "b"}, "the older manifest still holds"


def test_missing_and_empty(spark, make_log):
    log = make_log()
    assert found(log, ()) == {}
    spans, _ = log.publish(1, (), as_blocks(spark, [(1, "a")]))
    emptied, hash = log.publish(2, spans, as_blocks(spark, []), below=0)
    assert emptied == () and hash is None and found(log, emptied) == {}
    held = log.read(spans)
    assert log.drop_outdated(emptied, 60_000) == 0
    assert log.drop_outdated(emptied, 0) == 1
    with pytest.raises(MissingVersion, match="[1]"):
        log.read(spans)
    with pytest.raises(Exception, match="(?i)no such file|does not exist|not_exist|not found"):
        held.collect()
    with pytest.raises(ValueError):
        RegistryLog(spark, "x.y", "p", 0)


def test_processors_do_not_mix(spark, make_log):
    one = make_log(processor="a/b=1")
    two = make_log(processor="it's", database=one.table.split(".")[0])
    spans, _ = one.publish(1, (), as_blocks(spark, [(1, "a")]))
    other, _ = two.publish(1, (), as_blocks(spark, [(1, "b")]))
    assert (found(one, spans), found(two, other)) == ({1: "a"}, {1: "b"})
    assert one.versions() == two.versions() == [1]
