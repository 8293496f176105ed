"""A feed with forks, derived from the ``events`` table, and the same in SQL.

Ten events make a block. Heights 11 and 12 of every 13 are delivered twice: first on a losing fork
(hash ``md5('b:' || height)``), then canonically (``md5('a:' || height)``). ``seq`` numbers the
deliveries: b11, b12, a11, a12, a13, ...
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forktide.operators import chain

DEPTH = 50
PERIOD = 13
FORK_FROM = 11
NETWORK = "ethereum"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("bigint")


def block_hash(height: Column, fork: Column | None = None) -> Column:
    side = F.lit("a:") if fork is None else F.when(fork == 0, "a:").otherwise("b:")
    return F.md5(F.concat(side, height.cast("string")))


def height_of(event_id: str = "event_id") -> Column:
    return F.call_function("div", F.col(event_id), F.lit(10))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their block height; unused columns are pruned from the scan."""
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "ts", cents("value").alias("cents"),
        height_of().alias("height"),
    )


def fork_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every delivered row, losing forks included, from a single scan."""
    place = F.col("height") % PERIOD
    twice = F.when(place >= FORK_FROM, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    late = F.when((place >= FORK_FROM) & (F.col("fork") == 0), 2).otherwise(0)
    return (
        events(spark, sf_dir)
        .withColumn("fork", F.explode(twice))
        .withColumn("hash", block_hash(F.col("height"), F.col("fork")))
        .withColumn("seq", (F.col("height") - place) * 2 + place + late)
        .withColumn("processor_id", F.lit("default"))
    )


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per delivered block."""
    return (
        fork_rows(spark, sf_dir)
        .groupBy("processor_id", "height", "fork")
        .agg(F.max("seq").alias("seq"))
        .withColumn("hash", block_hash(F.col("height"), F.col("fork")))
    )


def tip(spark: SparkSession, sf_dir: str) -> Column:
    """Highest height, as a scalar subquery."""
    return events(spark, sf_dir).agg(F.max("height")).scalar()


def canonical_blocks(spark: SparkSession, sf_dir: str, lowest: Column | None = None) -> DataFrame:
    """Blocks that survive the feed, found by the chain operator; from ``lowest`` on."""
    survivors = chain.canonical_chain(deliveries(spark, sf_dir)).select("processor_id", "height", "hash")
    return survivors if lowest is None else survivors.filter(F.col("height") >= lowest)


FEED_SQL = f"""
e AS (SELECT event_id, user_id, event_type, ts, CAST(round(value * 100) AS BIGINT) AS cents,
             CAST(event_id // 10 AS BIGINT) AS height FROM events),
rows_ AS (
  SELECT *, md5('a:' || CAST(height AS VARCHAR)) AS hash, 0 AS fork,
         (height - height % {PERIOD}) * 2 + height % {PERIOD}
         + CASE WHEN height % {PERIOD} >= {FORK_FROM} THEN 2 ELSE 0 END AS seq FROM e
  UNION ALL
  SELECT *, md5('b:' || CAST(height AS VARCHAR)) AS hash, 1 AS fork,
         (height - height % {PERIOD}) * 2 + height % {PERIOD} AS seq
  FROM e WHERE height % {PERIOD} >= {FORK_FROM}),
tip AS (SELECT max(height) AS h FROM e),
blocks_ AS (SELECT DISTINCT height, hash, fork, seq FROM rows_),
ordered AS (SELECT *, min(height) OVER (ORDER BY seq ROWS BETWEEN 1 FOLLOWING
            AND UNBOUNDED FOLLOWING) AS later_min FROM blocks_),
canon AS (SELECT height, hash, fork, seq FROM ordered
          WHERE later_min IS NULL OR height < later_min),
registry AS (SELECT height, hash FROM canon WHERE height >= (SELECT h FROM tip) - {DEPTH})
"""


def feed_sql(body: str) -> str:
    return f"WITH {FEED_SQL.strip()}\n{body.strip()}"
