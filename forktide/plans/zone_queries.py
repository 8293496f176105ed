"""Zones, versions, deletes and migration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forktide.functions import blocks
from forktide.operators import (
    chain,
    deletes,
    joins,
    lookups,
    migration,
    versions,
    visible,
)
from forktide.plans import derived as d
from forktide.plans.chain_queries import by_type
from forktide.plans.derived import DEPTH, feed_sql
from forktide.plans.registry import query
from forktide.sources import rows as row_ops


@query(
    "latest_by_key",
    feed_sql("""
SELECT event_id, hash, fork, cents FROM (SELECT *, row_number() OVER (PARTITION BY event_id
ORDER BY seq DESC) AS rn FROM rows_) WHERE rn = 1"""),
)
def latest_by_key(spark: SparkSession, sf: str) -> DataFrame:
    rows = d.fork_rows(spark, sf).select("event_id", "seq", "hash", "fork", "cents")
    return versions.latest_by_key(rows, ["event_id"], ["seq"]).drop("seq")


@query(
    "latest_by_version",
    """
SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE)::VARCHAR AS o_orderdate,
       CAST(round(o_totalprice * 100) AS BIGINT) AS cents
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC,
      o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
)
def latest_by_version(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshot read: the newest order stands for its customer."""
    orders = d.table(spark, sf, "orders").select(
        "o_custkey", "o_orderdate", "o_orderkey", d.cents("o_totalprice").alias("cents")
    )
    newest = versions.latest_by_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return newest.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


@query(
    "newest_row",
    feed_sql("SELECT event_id, height, hash FROM rows_ ORDER BY seq DESC, event_id DESC LIMIT 1"),
)
def newest_row(spark: SparkSession, sf: str) -> DataFrame:
    rows = d.fork_rows(spark, sf).select("event_id", "height", "hash", "seq")
    return versions.newest(rows, ["seq", "event_id"]).drop("seq")


def signed_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Every order inserted, status P cancelled, and every fifth of those inserted again."""
    orders = d.table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", d.cents("o_totalprice").alias("cents")
    )
    history = (
        F.when(
            (F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 5 == 0),
            F.array(F.lit(1), F.lit(-1), F.lit(1)),
        )
        .when(F.col("o_orderstatus") == "P", F.array(F.lit(1), F.lit(-1)))
        .otherwise(F.array(F.lit(1)))
    )
    written = orders.select("*", F.posexplode(history).alias("seq", "sign"))
    return written.withColumn("cents", F.col("cents") + F.col("seq"))


_SIGNED_SQL = """
WITH s AS (
  SELECT o_orderkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, 0 AS seq,
         1 AS sign FROM orders
  UNION ALL SELECT o_orderkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) + 1, 1, -1
         FROM orders WHERE o_orderstatus = 'P'
  UNION ALL SELECT o_orderkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) + 2, 2, 1
         FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 5 = 0),
live AS (SELECT o_orderkey, any_value(o_orderstatus) AS o_orderstatus,
                arg_max(cents, seq) FILTER (WHERE sign > 0) AS cents
         FROM s GROUP BY o_orderkey HAVING sum(sign) > 0)
"""


@query("collapsed_rows", _SIGNED_SQL + "SELECT o_orderkey, cents FROM live")
def collapsed_rows(spark: SparkSession, sf: str) -> DataFrame:
    live = versions.collapse_signs(signed_orders(spark, sf), ["o_orderkey"], ["seq"])
    return live.select("o_orderkey", "cents")


REMOVAL = "o_orderstatus = :status AND cents < :below"
REMOVAL_PARAMS = {"status": "F", "below": 10_000_000}
_REMOVED_SQL = "o_orderstatus = 'F' AND cents < 10000000"


def _with_tombstones(spark: SparkSession, sf: str) -> DataFrame:
    signed = signed_orders(spark, sf)
    stones = deletes.removal_by_predicate(
        signed, REMOVAL, ["o_orderkey"], ["seq"], params=REMOVAL_PARAMS
    )
    return signed.unionByName(stones)


@query(
    "tombstoned",
    _SIGNED_SQL + f"SELECT o_orderkey, cents FROM live WHERE NOT ({_REMOVED_SQL})",
)
def tombstoned(spark: SparkSession, sf: str) -> DataFrame:
    """Removal by predicate: tombstones are appended and the table is read again."""
    live = versions.collapse_signs(_with_tombstones(spark, sf), ["o_orderkey"], ["seq"])
    return live.select("o_orderkey", "cents")


@query(
    "removal_report",
    _SIGNED_SQL + f"""
SELECT 'orders' AS table_name, 'sign' AS kind, count(*) AS removed FROM live
WHERE {_REMOVED_SQL}""",
)
def removal_report(spark: SparkSession, sf: str) -> DataFrame:
    stones = deletes.removal_by_predicate(
        signed_orders(spark, sf), REMOVAL, ["o_orderkey"], ["seq"], params=REMOVAL_PARAMS
    )
    return deletes.removal_report("orders", F.lit("sign"), stones)


@query(
    "tombstoned_by_query",
    _SIGNED_SQL + "SELECT o_orderkey, cents FROM live WHERE NOT (cents >= 30000000)",
)
def tombstoned_by_query(spark: SparkSession, sf: str) -> DataFrame:
    signed = signed_orders(spark, sf)
    live = versions.collapse_signs(signed, ["o_orderkey"], ["seq"])
    stones = deletes.removal_by_query(
        spark, "SELECT * FROM {live} WHERE cents >= :least", {"least": 30_000_000}, live=live
    )
    after = versions.collapse_signs(signed.unionByName(stones), ["o_orderkey"], ["seq"])
    return after.select("o_orderkey", "cents")


@query(
    "removed_by_id",
    """
SELECT o_orderkey, o_orderstatus FROM orders o WHERE NOT EXISTS
(SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')""",
)
def removed_by_id(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with a returned line are removed by id; the id list grows with the data."""
    orders = d.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    ids = (
        d.table(spark, sf, "lineitem")
        .filter("l_returnflag = 'R'")
        .select(F.col("l_orderkey").alias("o_orderkey"))
    )
    return deletes.without_ids(orders, ids, ["o_orderkey"])


@query(
    "cutoff",
    feed_sql(f"""
, o AS (SELECT max(o_orderkey // 20) AS h FROM orders), m AS (SELECT greatest(t.h, o.h) AS top
  FROM tip t, o)
SELECT top AS max_height, least(top - {DEPTH}, (SELECT h FROM tip) - 75) AS cutoff,
       CASE WHEN top > 0 AND least(top - {DEPTH}, (SELECT h FROM tip) - 75) > 10
            THEN 1 ELSE 0 END AS should_move FROM m"""),
)
def cutoff(spark: SparkSession, sf: str) -> DataFrame:
    """Two hot tables with different tips; the move is held back to finality."""
    order_heights = d.table(spark, sf, "orders").select(
        F.call_function("div", F.col("o_orderkey"), F.lit(20)).alias("height")
    )
    finalized = d.tip(spark, sf) - 75
    report = migration.cutoff_report(
        [d.events(spark, sf), order_heights], DEPTH, finalized, F.lit(10)
    )
    return report.withColumn("should_move", F.col("should_move").cast("int"))


@query(
    "migrated_rows",
    feed_sql(f"""
SELECT event_id, height, hash, cents FROM rows_ JOIN canon USING (height, hash)
WHERE height <= (SELECT h FROM tip) - {DEPTH}"""),
)
def migrated_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The whole history in one move: orphans stay behind, newest row per key."""
    cut = blocks.threshold(d.tip(spark, sf), DEPTH)
    registry = chain.canonical_chain(d.deliveries(spark, sf))
    moved = migration.rows_to_move(
        d.fork_rows(spark, sf).select("event_id", "height", "hash", "cents", "seq"),
        -1,
        cut,
        registry,
        keys=["event_id"],
        order=["seq"],
        salt_by=["event_id"],
    )
    return moved.select("event_id", "height", "hash", "cents")


@query(
    "migrated_rows_as_coded",
    feed_sql(f"""
SELECT event_type, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents FROM rows_
WHERE height <= (SELECT h FROM tip) - {DEPTH} GROUP BY event_type"""),
)
def migrated_rows_as_coded(spark: SparkSession, sf: str) -> DataFrame:
    """A plain copy, orphans included."""
    cut = blocks.threshold(d.tip(spark, sf), DEPTH)
    return by_type(migration.rows_to_move(d.fork_rows(spark, sf), -1, cut))


@query(
    "stay_hot",
    feed_sql(f"""
SELECT event_id, height, hash FROM rows_ WHERE height > (SELECT h FROM tip) - {DEPTH}"""),
)
def stay_hot(spark: SparkSession, sf: str) -> DataFrame:
    cut = blocks.threshold(d.tip(spark, sf), DEPTH)
    return d.fork_rows(spark, sf).filter(F.col("height") > cut).select("event_id", "height", "hash")


@query(
    "migration_totals",
    feed_sql("""
SELECT coalesce(migration_id, -1) AS migration_id, coalesce(table_name, 'all') AS table_name,
       count(*) AS n_rows
FROM (SELECT height // 30 AS migration_id, event_type AS table_name FROM rows_)
GROUP BY ROLLUP (migration_id, table_name)"""),
)
def migration_totals(spark: SparkSession, sf: str) -> DataFrame:
    """A move every 30 blocks, one table per event type."""
    moves = (
        d.fork_rows(spark, sf)
        .groupBy(
            F.call_function("div", F.col("height"), F.lit(30)).alias("migration_id"),
            F.col("event_type").alias("table_name"),
        )
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return migration.move_totals(moves).select(
        F.coalesce("migration_id", F.lit(-1)).alias("migration_id"),
        F.coalesce("table_name", F.lit("all")).alias("table_name"),
        "n_rows",
    )


@query(
    "zone_union",
    feed_sql("SELECT event_type, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents FROM rows_ "
             "GROUP BY event_type"),
)
def zone_union(spark: SparkSession, sf: str) -> DataFrame:
    """During a move: cold holds rows above the cutoff, hot still has rows below it."""
    cut = blocks.threshold(d.tip(spark, sf), DEPTH)
    rows = d.fork_rows(spark, sf)
    cold = rows.filter(F.col("height") <= cut + 20)
    hot = rows.filter(F.col("height") > cut - 30)
    return by_type(visible.zone_union(cold, hot, cut))


@query(
    "zone_pruned",
    feed_sql(f"""
SELECT event_id, height, hash FROM rows_
WHERE height BETWEEN (SELECT h FROM tip) - {DEPTH} - 30 AND (SELECT h FROM tip) - {DEPTH} - 5"""),
)
def zone_pruned(spark: SparkSession, sf: str) -> DataFrame:
    """A range below the cutoff: the hot zone is left out of the plan."""
    cut = d.events(spark, sf).agg(F.max("height")).first()[0] - DEPTH
    rows = d.fork_rows(spark, sf)
    part = visible.zone_union(
        rows.filter(F.col("height") <= cut), rows.filter(F.col("height") > cut), cut, cut - 30, cut - 5
    )
    return part.select("event_id", "height", "hash")


@query(
    "migration_no_loss",
    feed_sql(f"""
SELECT count(*) AS rows_before,
       count(*) FILTER (WHERE height <= (SELECT h FROM tip) - {DEPTH}) AS rows_moved,
       count(*) FILTER (WHERE height > (SELECT h FROM tip) - {DEPTH}) AS rows_stayed,
       CAST(0 AS BIGINT) AS lost, CAST(0 AS BIGINT) AS extra, CAST(0 AS BIGINT) AS in_both
FROM rows_"""),
)
def migration_no_loss(spark: SparkSession, sf: str) -> DataFrame:
    cut = blocks.threshold(d.tip(spark, sf), DEPTH)
    rows = d.fork_rows(spark, sf)
    moved = migration.rows_to_move(rows, -1, cut)
    stayed = rows.filter(F.col("height") > cut)
    return visible.partition_check(rows, moved, stayed, ["event_id", "height", "hash"])


@query(
    "hash_for_height",
    feed_sql(f"""
, places AS (
  SELECT height, hash, 0 AS rank FROM canon WHERE height > (SELECT h FROM tip) - 20
  UNION ALL SELECT height, hash, 1 FROM registry
  UNION ALL SELECT height, hash, 2 FROM rows_ WHERE height <= (SELECT h FROM tip) - {DEPTH} - 10
  UNION ALL SELECT height, hash, 3 FROM rows_ WHERE height > (SELECT h FROM tip) - {DEPTH} - 15)
SELECT height, hash, ['hot_chain', 'registry', 'cold', 'hot'][rank + 1] AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY height ORDER BY rank, hash) AS rn FROM places)
WHERE rn = 1"""),
)
def hash_for_height(spark: SparkSession, sf: str) -> DataFrame:
    top = d.tip(spark, sf)
    rows = d.fork_rows(spark, sf)
    return lookups.hash_by_height(
        d.canonical_blocks(spark, sf, top - 19),
        d.canonical_blocks(spark, sf, top - DEPTH),
        rows.filter(F.col("height") <= top - DEPTH - 10),
        rows.filter(F.col("height") > top - DEPTH - 15),
    )


@query(
    "cold_max_height",
    feed_sql(f"""
SELECT greatest((SELECT max(height) FROM rows_ WHERE height <= (SELECT h FROM tip) - {DEPTH}),
                (SELECT max(o_orderkey // 20) FROM orders)) AS max_height"""),
)
def cold_max_height(spark: SparkSession, sf: str) -> DataFrame:
    cut = blocks.threshold(d.tip(spark, sf), DEPTH)
    cold_events = d.events(spark, sf).filter(F.col("height") <= cut)
    cold_orders = d.table(spark, sf, "orders").select(
        F.call_function("div", F.col("o_orderkey"), F.lit(20)).alias("height")
    )
    return lookups.latest_height([cold_events, cold_orders])


@query(
    "route_zone",
    feed_sql("""
SELECT 'ethereum_' || CASE WHEN height > (SELECT h FROM tip) - 100 THEN 'hot' ELSE 'cold' END || '_'
       || event_type || 's' AS target, count(*) AS n FROM rows_ GROUP BY target"""),
)
def route_zone(spark: SparkSession, sf: str) -> DataFrame:
    """The last 100 heights arrive at the head of the feed."""
    rows = d.fork_rows(spark, sf).withColumn("entity", F.initcap("event_type"))
    head = F.col("height") > d.tip(spark, sf) - 100
    routed = row_ops.route(rows, "entity", head, d.NETWORK)
    return routed.groupBy("target").agg(F.count(F.lit(1)).alias("n"))


_LINES_SQL = """
WITH l AS (SELECT l_orderkey // 10 AS height, l_partkey, l_quantity FROM lineitem),
t AS (SELECT max(height) AS h FROM l)
"""


@query(
    "enriched_migration",
    _LINES_SQL + f"""
SELECT p_brand, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)
       * CAST(round(p_retailprice * 100) AS BIGINT)) AS BIGINT) AS worth
FROM l JOIN part ON p_partkey = l_partkey WHERE height <= (SELECT h FROM t) - {DEPTH}
GROUP BY p_brand""",
)
def enriched_migration(spark: SparkSession, sf: str) -> DataFrame:
    """The row transform of a move looks up a price; the parts are merged with the lines if there are many."""
    lines = d.table(spark, sf, "lineitem").select(
        F.call_function("div", F.col("l_orderkey"), F.lit(10)).alias("height"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
    )
    prices = d.table(spark, sf, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_brand", d.cents("p_retailprice").alias("price")
    )
    bound = joins.checked_bound(prices)

    def with_price(rows: DataFrame) -> DataFrame:
        return joins.keyed_join(
            rows, prices, ["l_partkey"], "inner", bound, salt_by=["l_orderkey", "l_linenumber"]
        )

    cut = lines.agg(F.max("height")).scalar() - DEPTH
    moved = migration.rows_to_move(lines, -1, cut, transform=with_price)
    return moved.groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("l_quantity").cast("bigint") * F.col("price")).alias("worth"),
    )
