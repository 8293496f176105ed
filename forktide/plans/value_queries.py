"""Names, normalised rows, decoded logs, 256-bit sums and reader analytics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forktide.functions import clock, names, text, u256
from forktide.operators import analytics, contracts
from forktide.plans import derived as d
from forktide.plans.derived import FEED_SQL, feed_sql
from forktide.plans.registry import query
from forktide.sources import feed
from forktide.sources import rows as row_ops

_ENTITY_SQL = """
p_type || 'ParserV' || CAST(p_size AS VARCHAR) || 'Swap' || upper(substr(p_name, 1, 1))
|| replace(substr(p_name, 2), ' ', '')"""


@query(
    "table_names",
    f"""
SELECT p_partkey, entity, 'ethereum_' || CASE WHEN p_partkey % 2 = 0 THEN 'hot' ELSE 'cold' END
       || '_' || lower(regexp_replace(regexp_replace(regexp_replace(entity,
       '([a-z])([A-Z])', '\\1_\\2', 'g'), '([0-9])([A-Z])', '\\1_\\2', 'g'),
       '([A-Z]+)([A-Z][a-z])', '\\1_\\2', 'g')) || 's' AS table_name
FROM (SELECT p_partkey, {_ENTITY_SQL.strip()} AS entity FROM part)""",
)
def table_names(spark: SparkSession, sf: str) -> DataFrame:
    """Class names such as ``ECONOMYParserV11SwapRedwidget`` made from the part table."""
    entity = F.concat(
        F.col("p_type"),
        F.lit("ParserV"),
        F.col("p_size").cast("string"),
        F.lit("Swap"),
        F.upper(F.substring("p_name", 1, 1)),
        F.replace(F.substring("p_name", 2, 1000), F.lit(" "), F.lit("")),
    )
    part = d.table(spark, sf, "part").select("p_partkey", entity.alias("entity"))
    zone = F.when(F.col("p_partkey") % 2 == 0, "hot").otherwise("cold")
    return part.withColumn("table_name", names.entity_table(F.col("entity"), d.NETWORK, zone))


@query(
    "normalised_rows",
    """
SELECT event_id,
       lpad(CAST(CAST(event_id AS HUGEINT) * 100000000000000000000 AS VARCHAR), 78, '0') AS amount,
       CAST(CAST(event_id AS HUGEINT) * 10000000000 + 7 AS VARCHAR) AS wide,
       CASE WHEN event_id % 10 = 0 THEN '' ELSE format('{:x}', event_id) END AS code,
       strftime(ts, '%Y-%m-%d %H:%M:%S.') || lpad(CAST(CAST(floor(
         (epoch_us(ts) % 1000000) / 1000) AS BIGINT) AS VARCHAR), 3, '0') AS ts_text,
       event_type || '|' || CAST(user_id AS VARCHAR) AS tags
FROM events""",
)
def normalised_rows(spark: SparkSession, sf: str) -> DataFrame:
    ident = F.col("event_id")
    raw = d.table(spark, sf, "events").select(
        "event_id",
        (ident.cast("decimal(17,0)") * F.lit("100000000000000000000").cast("decimal(21,0)"))
        .cast("decimal(38,0)")
        .alias("amount"),
        (ident.cast("decimal(27,0)") * F.lit(10_000_000_000) + 7)
        .cast("decimal(38,0)")
        .alias("wide"),
        F.when(ident % 10 == 0, "0x")
        .otherwise(F.concat(F.lit("0x"), F.lower(F.hex(ident))))
        .alias("code"),
        F.col("ts"),
        F.array("event_type", F.col("user_id").cast("string")).alias("tags"),
    )
    rows = row_ops.normalise_rows(raw, hex_fields=["code"], u256_fields=["amount"])
    return rows.select(
        "event_id",
        "amount",
        "wide",
        "code",
        clock.millis_text(F.col("ts")).alias("ts_text"),
        F.concat_ws("|", "tags").alias("tags"),
    )


def _word(c: Column, width: int) -> Column:
    return u256.zero_filled(F.hex(c), width)


def log_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Feed rows whose logs array holds one Transfer and one other log per order line."""
    height = F.call_function("div", F.col("l_orderkey"), F.lit(4))
    order = _word(F.col("l_orderkey"), 64)
    parts = d.table(spark, sf, "lineitem").select(
        height.alias("height"),
        F.col("l_shipdate").alias("ts"),
        F.concat(F.lit("0x"), _word(F.col("l_partkey"), 40)).alias("address"),
        F.concat(F.lit("0x"), _word(F.col("l_suppkey"), 64)).alias("sender"),
        F.concat(F.lit("0x"), order).alias("receiver"),
        F.concat(
            F.lit("0x"),
            F.lower(_word(F.col("l_suppkey"), 48)),
            F.lower(_word(d.cents("l_extendedprice"), 16)),
        ).alias("data"),
        F.col("l_linenumber").cast("bigint").alias("logIndex"),
    )

    def log(signature: str) -> Column:
        return F.struct(
            "address",
            F.array(F.lit(signature), "sender", "receiver").alias("topics"),
            "data",
            F.lower("receiver").alias("transactionHash"),
            "logIndex",
        )

    other = "0x" + "8c" * 32
    return parts.select(
        "height",
        d.block_hash(F.col("height")).alias("hash"),
        "ts",
        F.array(log(feed.TRANSFER_TOPIC), log(other)).alias("logs"),
    )


_VALUE_SQL = (
    "CAST(l_suppkey AS HUGEINT) * 18446744073709551616 "
    "+ CAST(round(l_extendedprice * 100) AS BIGINT)"
)


@query(
    "decoded_transfers",
    f"""
SELECT '0x' || format('{{:040x}}', l_partkey) AS token,
       '0x' || format('{{:040x}}', l_suppkey) AS sender,
       '0x' || format('{{:040x}}', l_orderkey) AS receiver,
       lpad(CAST({_VALUE_SQL} AS VARCHAR), 78, '0') AS value, l_orderkey // 4 AS height,
       strftime(l_shipdate, '%Y%m') AS ym, '0x' || format('{{:064x}}', l_orderkey) AS tx_hash,
       CAST(l_linenumber AS BIGINT) AS log_index
FROM lineitem""",
)
def decoded_transfers(spark: SparkSession, sf: str) -> DataFrame:
    t = feed.decode_transfers(log_blocks(spark, sf))
    return t.select(
        "token",
        F.col("from").alias("sender"),
        F.col("to").alias("receiver"),
        "value",
        "height",
        clock.year_month(F.col("block_timestamp")).alias("ym"),
        "tx_hash",
        "log_index",
    )


def transfers(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as transfers: token is the part key, value needs more than 64 bits."""
    wide = F.col("l_suppkey").cast("decimal(18,0)") * F.lit("18446744073709551616").cast(
        "decimal(20,0)"
    ) + d.cents("l_extendedprice").cast("decimal(18,0)")
    return d.table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("token"),
        u256.pad(wide.cast("decimal(38,0)")).alias("value"),
        F.col("l_orderkey").alias("height"),
        F.col("l_shipdate").alias("block_timestamp"),
        F.col("l_linenumber").alias("log_index"),
    )


@query(
    "u256_sum",
    f"""
SELECT l_partkey AS token, count(*) AS n, CAST(sum({_VALUE_SQL}) AS VARCHAR) AS total
FROM lineitem GROUP BY l_partkey""",
)
def u256_sum(spark: SparkSession, sf: str) -> DataFrame:
    return (
        transfers(spark, sf)
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"), u256.sum_u256(F.col("value")).alias("total"))
    )


@query(
    "top_tokens",
    f"""
SELECT l_partkey AS token, count(*) AS transfer_count, CAST(sum({_VALUE_SQL}) AS VARCHAR)
       AS total_value
FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01'
GROUP BY l_partkey ORDER BY transfer_count DESC, token LIMIT 10""",
)
def top_tokens(spark: SparkSession, sf: str) -> DataFrame:
    recent = analytics.since(transfers(spark, sf), "block_timestamp", "1997-01-01")
    return analytics.top_tokens(recent, 10)


@query(
    "top_values",
    f"""
SELECT l_partkey AS token, l_orderkey AS height, CAST(l_linenumber AS BIGINT) AS log_index,
       CAST({_VALUE_SQL} AS VARCHAR) AS value
FROM lineitem ORDER BY {_VALUE_SQL} DESC, height, token, log_index LIMIT 100""",
)
def top_values(spark: SparkSession, sf: str) -> DataFrame:
    """Padded text sorts like the number it stands for."""
    top = analytics.top_rows(
        transfers(spark, sf), F.col("value"), ["height", "token", "log_index"], 100
    )
    return top.select(
        "token", "height", F.col("log_index").cast("bigint").alias("log_index"),
        u256.unpad(F.col("value")).alias("value"),
    )


@query(
    "top_heights",
    "SELECT event_id, event_id // 10 AS height FROM events ORDER BY height DESC, event_id LIMIT 100",
)
def top_heights(spark: SparkSession, sf: str) -> DataFrame:
    rows = d.events(spark, sf).select("event_id", "height")
    return analytics.top_rows(rows, F.col("height"), ["event_id"], 100)


@query(
    "month_range",
    """
SELECT strftime(ts, '%Y%m') AS ym, event_type, count(*) AS n,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
FROM events WHERE ts >= TIMESTAMP '2024-01-05' GROUP BY ALL""",
)
def month_range(spark: SparkSession, sf: str) -> DataFrame:
    recent = analytics.since(d.events(spark, sf), "ts", "2024-01-05")
    return recent.groupBy(clock.year_month(F.col("ts")).alias("ym"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents")
    )


_BAD_SQL = """
bad AS (SELECT event_id,
  CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 103 = 0 THEN -height ELSE height END
    AS height,
  CASE WHEN event_id % 107 = 0 THEN substr(hash, 1, 20) ELSE hash END AS hash FROM rows_)"""


@query(
    "contract_check",
    f"""
WITH {FEED_SQL.strip()}, {_BAD_SQL.strip()}
SELECT 'events' AS table_name, 1 AS has_height, 1 AS has_hash, count(*) AS n_rows,
       count(*) FILTER (WHERE height IS NULL) AS null_height,
       count(*) FILTER (WHERE height < 0) AS negative_height,
       count(*) FILTER (WHERE length(hash) <> 32) AS wrong_length,
       count(*) - count(DISTINCT event_id) AS duplicate_rows FROM bad
UNION ALL
SELECT 'orders', 0, 0, count(*), -1, -1, 0, count(*) - count(DISTINCT o_custkey) FROM orders""",
)
def contract_check(spark: SparkSession, sf: str) -> DataFrame:
    """An event table with bad rows, and a table that breaks the contract by its schema."""
    ident, height = F.col("event_id"), F.col("height")
    bad = d.fork_rows(spark, sf).select(
        "event_id",
        F.when(ident % 101 == 0, F.lit(None))
        .when(ident % 103 == 0, -height)
        .otherwise(height)
        .alias("height"),
        F.when(ident % 107 == 0, F.substring("hash", 1, 20)).otherwise(F.col("hash")).alias("hash"),
    )
    orders = d.table(spark, sf, "orders").select("o_custkey")
    report = contracts.row_report(
        "events", bad, ["event_id"], text_lengths={"hash": 32}
    ).unionByName(contracts.row_report("orders", orders, ["o_custkey"], text_lengths={"hash": 32}))
    return report.select(
        "table_name",
        F.col("has_height").cast("int").alias("has_height"),
        F.col("has_hash").cast("int").alias("has_hash"),
        "n_rows",
        *[F.coalesce(c, F.lit(-1)).alias(c) for c in ("null_height", "negative_height")],
        "wrong_length",
        "duplicate_rows",
    )


@query(
    "numbers_from_text",
    """
SELECT event_type, CAST(sum(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS total,
       count(*) - count(TRY_CAST(json_extract_string(props, '$.k') || CASE WHEN event_id % 3 = 0 THEN 'x' ELSE '' END
                        AS BIGINT)) AS refused
FROM events GROUP BY event_type""",
)
def numbers_from_text(spark: SparkSession, sf: str) -> DataFrame:
    """Numeric text as numbers; other text is NULL."""
    k = F.get_json_object("props", "$.k")
    spoilt = F.concat(k, F.when(F.col("event_id") % 3 == 0, "x").otherwise(""))
    return (
        d.table(spark, sf, "events")
        .select("event_type", text.to_long(k).alias("k"), text.to_long(spoilt).alias("s"))
        .groupBy("event_type")
        .agg(F.sum("k").alias("total"), (F.count(F.lit(1)) - F.count("s")).alias("refused"))
    )
