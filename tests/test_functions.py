from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from forktide.functions import blocks, clock, names, text, u256


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("entity", "zone", "table"),
    [
        ("Token", "hot", "ethereum_hot_tokens"),
        ("V3Swap", "cold", "ethereum_cold_v3_swaps"),
        ("V2Burn", "hot", "ethereum_hot_v2_burns"),
        ("HTMLParser", "hot", "ethereum_hot_html_parsers"),
        ("Erc20Transfer", "cold", "ethereum_cold_erc20_transfers"),
    ],
)
def test_entity_table(spark, entity, zone, table):
    assert one(spark, names.entity_table(F.lit(entity), "ethereum", F.lit(zone))) == table


def test_zone_names():
    assert names.zone_table("ethereum", "hot", "test_events") == "ethereum_hot_test_events"
    assert names.zone_table("ethereum", "cold", "test_events") == "ethereum_cold_test_events"
    assert names.snapshot_table("ethereum", "test_snapshot") == "ethereum_test_snapshot"
    with pytest.raises(ValueError):
        names.zone_table("ethereum", "warm", "x")


def test_network_substitution():
    template = "${network}_hot_${network}_events"
    assert names.substitute_network(template, "base") == "base_hot_base_events"


def test_text(spark):
    assert one(spark, text.strip_hex(F.lit("0xabc"))) == "abc"
    assert one(spark, text.strip_hex(F.lit("abc"))) == "abc"
    assert one(spark, text.strip_hex(F.lit("0x"))) == ""
    assert one(spark, text.address(F.lit("0xAbC"))) == "0xabc"
    assert one(spark, text.to_long(F.lit("42"))) == 42
    assert one(spark, text.to_long(F.lit("x"))) is None
    assert one(spark, text.first_nonempty(F.lit(""), F.lit("b"))) == "b"
    assert one(spark, text.first_nonzero(F.lit(0), F.lit(7))) == 7
    assert one(spark, text.first_nonzero(F.lit(0), F.lit(0))) == 0


def test_clock(spark):
    ts = F.lit(datetime(2023, 5, 1, 12, 0, 0, 123456))
    assert one(spark, clock.millis_text(ts)) == "2023-05-01 12:00:00.123"
    assert one(spark, clock.to_millis(ts)) == datetime(2023, 5, 1, 12, 0, 0, 123000)
    assert one(spark, clock.year_month(ts)) == "202305"
    assert one(spark, clock.whole_minutes(F.lit(119_999))) == 1
    assert one(spark, clock.now_ms()) > 1_600_000_000_000


def test_block_lists(spark):
    refs = F.array(
        F.struct(F.lit(5).cast("bigint").alias("height"), F.lit("a").alias("hash"), F.lit(1).alias("fee"))
    )
    assert one(spark, blocks.blocks_json(refs)) == '[{"height":5,"hash":"a"}]'
    parsed = one(spark, blocks.parse_blocks(F.lit('[{"height":5,"hash":"a"}]')))
    assert [(b["height"], b["hash"]) for b in parsed] == [(5, "a")]
    assert one(spark, blocks.parse_blocks(F.lit(""))) == []
    assert one(spark, blocks.parse_blocks(F.lit(None).cast("string"))) == []
    assert one(spark, blocks.threshold(F.lit(1000), 50)) == 950
    assert one(spark, blocks.threshold(F.lit(24111288), 50)) == 24111238


def test_u256_round_trips_and_sums(spark):
    """Values on both sides of the 2^120 bound of the short path."""
    rng = random.Random(7)
    values = [rng.randrange(2 ** rng.randrange(1, 257)) for _ in range(500)]
    values += [0, 1, 2**64 - 1, 2**64, 2**120 - 1, 2**120, 2**180 - 1, 2**240, 10**36 - 1, 10**36, 10**52, 2**256 - 1] + [2**256 - 1] * 50
    rows = spark.createDataFrame([(hex(v), str(v)) for v in values], "h string, d string")
    both = (
        u256.with_u256(rows, "a", F.col("h"))
        .withColumn("b", u256.pad(F.col("d")))
        .withColumn("plain", u256.unpad(F.col("a")))
    )
    assert both.filter("a <> b or plain <> d or length(a) <> 78").count() == 0
    total = both.agg(u256.sum_u256(F.col("a")).alias("t")).withColumn(
        "fits", u256.fits_u256(F.col("t"))
    ).first()
    assert total["t"] == str(sum(values))
    assert total["fits"] is False
    assert both.filter("d = '0'").agg(u256.sum_u256(F.col("a")).alias("t")).first()["t"] == "0"
    ordered = [r["d"] for r in both.orderBy("a").collect()]
    assert ordered == [str(v) for v in sorted(values)]


def test_u256_sum_of_no_rows_is_null(spark):
    empty = spark.createDataFrame([], "v string")
    assert empty.agg(u256.sum_u256(F.col("v")).alias("t")).first()["t"] is None


@pytest.mark.parametrize("bad", ["1" * 79, str(2**256), "-1", "1.5", "x", ""])
def test_padding_refuses_what_is_no_unsigned_256_bit_integer(spark, bad):
    df = spark.createDataFrame([(bad,)], "v string")
    with pytest.raises(Exception, match="256-bit"):
        df.select(u256.pad(F.col("v"))).collect()


@pytest.mark.parametrize("bad", ["0x" + "f" * 65, "0xzz", "0x" + "0" * 128])
def test_hex_refuses_what_is_no_unsigned_256_bit_integer(spark, bad):
    df = spark.createDataFrame([(bad,)], "h string")
    with pytest.raises(Exception, match="256-bit"):
        u256.with_u256(df, "v", F.col("h")).collect()


def test_largest_value_and_null_pass(spark):
    df = spark.createDataFrame([(str(2**256 - 1), "0x" + "f" * 64), (None, None)], "v string, h string")
    rows = u256.with_u256(df, "w", F.col("h")).select(u256.pad(F.col("v")).alias("v"), "w").collect()
    assert [tuple(r) for r in rows] == [(str(2**256 - 1),) * 2, (None, None)]


def test_scratch_is_released(spark):
    import os

    from forktide.sources import scratch

    folder, database = scratch.fresh(spark, "released")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}/tables'")
    spark.range(3).write.saveAsTable(f"{database}.t")
    spark.range(3).write.parquet(f"{folder}/rows")
    assert scratch.release(spark) >= 1
    assert not os.path.exists(folder.removeprefix("file:"))
    assert not spark.catalog.databaseExists(database)
    assert scratch.release(spark) == 0
