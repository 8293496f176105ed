"""Restart state, migration triggers and operations metrics, for many processors at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forktide.functions import blocks
from forktide.operators import migration, oplog, state
from forktide.plans import derived as d
from forktide.plans.registry import query


def epoch_ms(ts: str) -> Column:
    return F.unix_millis(F.col(ts).cast("timestamp"))


def status_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every event is a status written by the processor of its user."""
    height, ident = F.col("height"), F.col("event_id")
    one = F.struct(height.alias("height"), d.block_hash(height).alias("hash"))
    two = F.struct((height - 1).alias("height"), d.block_hash(height - 1).alias("hash"))
    return d.events(spark, sf).select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("id"),
        "height",
        d.block_hash(height).alias("hash"),
        d.block_hash(height - 1).alias("parent_hash"),
        F.when(ident % 3 == 0, blocks.blocks_json(F.array(two, one)))
        .when(ident % 3 == 1, "")
        .otherwise("[]")
        .alias("hot_blocks"),
        F.when(ident % 4 == 0, 0).otherwise(height - 5).alias("finalized_height"),
        F.when(ident % 4 == 0, "").otherwise(d.block_hash(height - 5)).alias("finalized_hash"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.when(ident % 7 == 0, 0).otherwise(epoch_ms("ts")).alias("last_run"),
    )


def known_processors(spark: SparkSession, sf: str) -> DataFrame:
    return d.table(spark, sf, "customer").select(
        F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("id")
    )


STATUS_SQL = """
e AS (SELECT *, event_id // 10 AS height FROM events),
st AS (SELECT 'u' || CAST(user_id AS VARCHAR) AS id, height, event_id, ts,
  md5('a:' || CAST(height AS VARCHAR)) AS hash,
  CASE WHEN event_id % 3 = 0 THEN '[{"height":' || CAST(height - 1 AS VARCHAR) || ',"hash":"'
    || md5('a:' || CAST(height - 1 AS VARCHAR)) || '"},{"height":' || CAST(height AS VARCHAR)
    || ',"hash":"' || md5('a:' || CAST(height AS VARCHAR)) || '"}]' ELSE '[]' END AS hot_blocks,
  CASE WHEN event_id % 3 = 0 THEN 2 ELSE 0 END AS n_top,
  CASE WHEN event_id % 4 = 0 THEN 0 ELSE height - 5 END AS fh,
  CASE WHEN event_id % 4 = 0 THEN '' ELSE md5('a:' || CAST(height - 5 AS VARCHAR)) END AS fhash,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE epoch_us(ts) // 1000 END AS last_run FROM e),
newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC,
  height DESC) AS rn FROM st) WHERE rn = 1),
rec AS (SELECT 'u' || CAST(c_custkey AS VARCHAR) AS id,
  CASE WHEN n.id IS NULL THEN -1 WHEN fh <> 0 THEN fh ELSE height END AS height,
  CASE WHEN n.id IS NULL THEN '' WHEN fhash <> '' THEN fhash ELSE hash END AS hash,
  coalesce(n_top, 0) AS n_top, coalesce(hot_blocks, '[]') AS hot_blocks, last_run
  FROM customer LEFT JOIN newest n ON n.id = 'u' || CAST(c_custkey AS VARCHAR)),
now_ AS (SELECT epoch_us(max(ts)) // 1000 + 1000 AS ms FROM events),
decided AS (SELECT rec.*, ms - last_run AS downtime,
  CASE WHEN n_top = 0 THEN 'no hot blocks' WHEN last_run IS NULL THEN 'no last run'
       WHEN ms - last_run < 86400000 THEN 'quick restart' ELSE 'long downtime' END AS reason
  FROM rec, now_)
"""
DAY_MS = 86_400_000


@query(
    "recover_state",
    f"WITH {STATUS_SQL.strip()} SELECT id, height, hash, CAST(n_top AS BIGINT) AS n_top, "
    "hot_blocks, CASE WHEN height = -1 THEN -1 ELSE height END AS finalized_height FROM rec",
)
def recover_state(spark: SparkSession, sf: str) -> DataFrame:
    """Customers stand for the known processors; those without events start at genesis."""
    recovered = state.recover_state(status_rows(spark, sf), known_processors(spark, sf))
    return recovered.select(
        "id",
        "height",
        "hash",
        F.size("top").cast("bigint").alias("n_top"),
        blocks.blocks_json(F.col("top")).alias("hot_blocks"),
        F.coalesce("finalized_height", F.lit(-1)).alias("finalized_height"),
    )


def _decided(spark: SparkSession, sf: str) -> DataFrame:
    now = d.events(spark, sf).agg(F.max("ts").alias("ts")).select(epoch_ms("ts") + 1000).scalar()
    recovered = state.recover_state(status_rows(spark, sf), known_processors(spark, sf))
    return state.stale_decision(recovered, now, DAY_MS)


@query(
    "stale_decision",
    f"""WITH {STATUS_SQL.strip()}
SELECT id, reason, CASE WHEN reason IN ('no hot blocks', 'quick restart') THEN 'keep'
       ELSE 'clear' END AS action, coalesce(CAST(floor(downtime / 60000) AS BIGINT), -1)
       AS downtime_min FROM decided""",
)
def stale_decision(spark: SparkSession, sf: str) -> DataFrame:
    return _decided(spark, sf).select(
        "id", "reason", "action", F.coalesce("downtime_min", F.lit(-1)).alias("downtime_min")
    )


@query(
    "rolled_back_state",
    f"""WITH {STATUS_SQL.strip()}, c AS (SELECT id, max(height) - 60 AS height FROM st GROUP BY id),
j AS (SELECT decided.*, reason NOT IN ('no hot blocks', 'quick restart') AS cleared,
      coalesce(c.height, -1) AS ch FROM decided LEFT JOIN c USING (id))
SELECT id, CASE WHEN cleared THEN ch ELSE height END AS height,
       CASE WHEN cleared THEN CASE WHEN ch = -1 THEN '' ELSE md5('a:' || CAST(ch AS VARCHAR)) END
            ELSE hash END AS hash,
       CAST(CASE WHEN cleared THEN 0 ELSE n_top END AS BIGINT) AS n_top FROM j""",
)
def rolled_back_state(spark: SparkSession, sf: str) -> DataFrame:
    """Cleared processors resume at the height cold holds, 60 below their tip here."""
    cold = (
        status_rows(spark, sf)
        .groupBy("id")
        .agg((F.max("height") - 60).alias("height"))
        .withColumn("hash", d.block_hash(F.col("height")))
    )
    resumed = state.rolled_back_state(_decided(spark, sf), cold)
    # A cold height of -1 is genesis in the oracle; its hash is the empty string.
    return resumed.select(
        "id",
        "height",
        F.when(F.col("height") == -1, "").otherwise(F.col("hash")).alias("hash"),
        F.size("top").cast("bigint").alias("n_top"),
    )


_MIG_SQL = """
WITH e AS (SELECT *, event_id // 10 AS height, 'p' || CAST(user_id % 16 AS VARCHAR) AS pid,
                  user_id % 16 AS p FROM events),
m AS (SELECT pid, max(event_id) AS last FROM e WHERE event_id % 97 = 0 GROUP BY pid),
b AS (SELECT e.pid, any_value(p) AS p, max(height) AS h,
             count(*) FILTER (WHERE last IS NULL OR event_id > last) AS blocks_since
      FROM e LEFT JOIN m USING (pid) GROUP BY e.pid)
"""


def _processor_events(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("user_id") % 16
    return d.events(spark, sf).select(
        F.concat(F.lit("p"), p.cast("string")).alias("processor_id"),
        p.alias("p"),
        F.col("event_id").alias("seq"),
        "height",
    )


def _blocks_since(spark: SparkSession, sf: str) -> DataFrame:
    e = _processor_events(spark, sf)
    # user_id % 16 has 16 values at any scale.
    return migration.blocks_since(e, e.filter("seq % 97 = 0"), ["processor_id"], max_keys=16)


@query(
    "blocks_since_migration",
    _MIG_SQL + "SELECT pid AS processor_id, blocks_since FROM b",
)
def blocks_since_migration(spark: SparkSession, sf: str) -> DataFrame:
    return _blocks_since(spark, sf)


@query(
    "trigger_decision",
    _MIG_SQL + """
SELECT pid AS processor_id, blocks_since, CASE WHEN p % 4 <> 0 AND
  (CASE WHEN p % 2 = 1 THEN p % 3 > 0 ELSE blocks_since >= 30 END) THEN 1 ELSE 0 END AS migrate
FROM b""",
)
def trigger_decision(spark: SparkSession, sf: str) -> DataFrame:
    """Odd processors migrate when finality moved, even ones by block count; every fourth is behind."""
    heads = _processor_events(spark, sf).groupBy("processor_id", "p").agg(
        F.max("height").alias("h")
    )
    due = migration.trigger_column(
        F.col("p") % 4 != 0,
        F.col("p") % 2 == 1,
        F.col("h") - d.DEPTH - F.col("p") % 3,
        F.col("h") - d.DEPTH,
        F.col("blocks_since"),
        30,
    )
    joined = heads.join(_blocks_since(spark, sf), "processor_id")
    return joined.select("processor_id", "blocks_since", due.cast("int").alias("migrate"))


def operations(spark: SparkSession, sf: str) -> DataFrame:
    """Events read as an operations log of four processors."""
    ident, kind = F.col("event_id"), F.col("event_type")
    even = ident % 2 == 0
    op = (
        F.when(kind == "click", "insert")
        .when(kind == "view", "query")
        .when(kind == "purchase", "blocks")
        .when(kind == "error", F.when(even, "fork_detected").otherwise("fork_executed"))
        .otherwise(F.when(even, "connection").otherwise("status"))
    )
    return d.events(spark, sf).select(
        F.concat(F.lit("p"), (F.col("user_id") % 4).cast("string")).alias("processor_id"),
        ident.alias("seq"),
        op.alias("op"),
        (ident % 11 != 0).alias("ok"),
        (ident % 3 == 0).alias("finalized"),
        (ident % 5 + 1).alias("amount"),
        "height",
        F.col("cents").alias("duration_ms"),
        epoch_ms("ts").alias("at_ms"),
    )


OPS_SQL = """
o AS (SELECT 'p' || CAST(user_id % 4 AS VARCHAR) AS processor_id, event_id AS seq,
  CASE event_type WHEN 'click' THEN 'insert' WHEN 'view' THEN 'query' WHEN 'purchase' THEN 'blocks'
    WHEN 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'fork_detected' ELSE 'fork_executed' END
    ELSE CASE WHEN event_id % 2 = 0 THEN 'connection' ELSE 'status' END END AS op,
  event_id % 11 <> 0 AS ok, event_id % 3 = 0 AS fin, event_id % 5 + 1 AS amount,
  event_id // 10 AS height, CAST(round(value * 100) AS BIGINT) AS ms, epoch_us(ts) // 1000 AS at_ms
  FROM events),
c AS (SELECT processor_id,
  count(*) FILTER (WHERE op = 'connection' AND ok) AS connections,
  count(*) FILTER (WHERE op = 'connection' AND NOT ok) AS connection_errors,
  coalesce(arg_max(at_ms, seq) FILTER (WHERE op = 'connection' AND ok), 0) AS last_connection_ms,
  coalesce(sum(amount) FILTER (WHERE op = 'blocks'), 0)::BIGINT AS blocks_processed,
  coalesce(sum(amount) FILTER (WHERE op = 'blocks' AND fin), 0)::BIGINT AS blocks_finalized,
  coalesce(sum(amount) FILTER (WHERE op = 'blocks' AND NOT fin), 0)::BIGINT AS hot_blocks_processed,
  count(*) FILTER (WHERE op = 'fork_detected') AS forks_detected,
  count(*) FILTER (WHERE op = 'fork_executed') AS forks_executed,
  coalesce(arg_max(height, seq) FILTER (WHERE op = 'fork_executed'), 0) AS last_fork_height,
  coalesce(arg_max(at_ms, seq) FILTER (WHERE op = 'fork_executed'), 0) AS last_fork_ms,
  coalesce(sum(amount) FILTER (WHERE op = 'fork_executed'), 0)::BIGINT AS blocks_rolled_back,
  count(*) FILTER (WHERE op = 'insert') AS inserts,
  count(*) FILTER (WHERE op = 'insert' AND NOT ok) AS insert_errors,
  coalesce(arg_max(ms, seq) FILTER (WHERE op = 'insert' AND ok), 0) AS last_insert_ms,
  count(*) FILTER (WHERE op = 'query') AS queries,
  count(*) FILTER (WHERE op = 'query' AND NOT ok) AS query_errors,
  coalesce(arg_max(ms, seq) FILTER (WHERE op = 'query' AND ok), 0) AS last_query_ms,
  count(*) FILTER (WHERE op = 'status') AS status_updates,
  coalesce(arg_max(at_ms, seq) FILTER (WHERE op = 'status'), 0) AS last_status_ms
  FROM o GROUP BY processor_id),
recent AS (SELECT processor_id, op, sum(ms)::BIGINT / count(*) AS mean_ms FROM (
  SELECT *, row_number() OVER (PARTITION BY processor_id, op ORDER BY seq DESC) AS rn
  FROM o WHERE ok AND op IN ('insert', 'query')) WHERE rn <= 100 GROUP BY processor_id, op),
k AS (SELECT c.*, coalesce(i.mean_ms, 0.0) AS avg_insert_ms, coalesce(q.mean_ms, 0.0) AS avg_query_ms
  FROM c LEFT JOIN recent i ON i.processor_id = c.processor_id AND i.op = 'insert'
  LEFT JOIN recent q ON q.processor_id = c.processor_id AND q.op = 'query')
"""


@query("ops_summary", f"WITH {OPS_SQL.strip()} SELECT * FROM k")
def ops_summary(spark: SparkSession, sf: str) -> DataFrame:
    return oplog.summary(operations(spark, sf))


@query(
    "rolling_mean_100",
    f"""WITH {OPS_SQL.strip()}
SELECT processor_id, op, seq, window_sum, window_n, window_sum / window_n AS mean_ms FROM (
  SELECT processor_id, op, seq, CAST(sum(ms) OVER w AS BIGINT) AS window_sum,
         count(*) OVER w AS window_n FROM o WHERE ok
  WINDOW w AS (PARTITION BY processor_id, op ORDER BY seq ROWS BETWEEN 99 PRECEDING
               AND CURRENT ROW))""",
)
def rolling_mean_100(spark: SparkSession, sf: str) -> DataFrame:
    return oplog.rolling_means(operations(spark, sf)).select(
        "processor_id", "op", "seq", "window_sum", "window_n", "mean_ms"
    )


@query(
    "rolling_mean_sparse",
    f"""WITH {OPS_SQL.strip()}, t AS (
SELECT processor_id, op, seq * 1000003 + seq * seq % 1000 AS seq, ms FROM o WHERE ok)
SELECT processor_id, op, seq, CAST(sum(ms) OVER w AS BIGINT) AS window_sum, count(*) OVER w AS window_n FROM t
WINDOW w AS (PARTITION BY processor_id, op ORDER BY seq ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)""",
)
def rolling_mean_sparse(spark: SparkSession, sf: str) -> DataFrame:
    """The same over a log numbered by microseconds, in ranges of few rows."""
    seq = F.col("seq") * 1_000_003 + F.col("seq") * F.col("seq") % 1_000
    log = operations(spark, sf).withColumn("seq", seq.cast("bigint"))
    return oplog.rolling_means(log, width=256).select("processor_id", "op", "seq", "window_sum", "window_n")


def _long_sql() -> str:
    parts = [
        f"SELECT processor_id, '{name}' AS name, '{kind}' AS type, "
        f"CAST({column} AS DOUBLE) / {divisor}.0 AS value FROM k"
        for name, kind, column, divisor, _ in oplog.METRICS
    ]
    return f"WITH {OPS_SQL.strip()}\n" + "\nUNION ALL ".join(parts)


@query("metrics_long", _long_sql())
def metrics_long(spark: SparkSession, sf: str) -> DataFrame:
    summaries = oplog.summary(operations(spark, sf))
    return oplog.long_form(summaries).select("processor_id", "name", "type", "value")
