"""Fork queries: what is visible, which block is canonical, what the registry holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forktide.functions import blocks
from forktide.operators import chain, joins, ranges, visible
from forktide.plans import derived as d
from forktide.plans.derived import DEPTH, feed_sql
from forktide.plans.registry import query


def by_type(rows: DataFrame) -> DataFrame:
    return rows.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents")
    )


@query(
    "visible_by_type",
    feed_sql(f"""
SELECT event_type, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents FROM rows_ r
WHERE r.height <= (SELECT h FROM tip) - {DEPTH}
   OR EXISTS (SELECT 1 FROM registry g WHERE g.height = r.height AND g.hash = r.hash)
GROUP BY event_type"""),
)
def visible_by_type(spark: SparkSession, sf: str) -> DataFrame:
    cut = blocks.threshold(d.tip(spark, sf), DEPTH)
    registry = d.canonical_blocks(spark, sf, cut)
    rows = visible.valid_rows(d.fork_rows(spark, sf), registry, cut, max_blocks=DEPTH)
    return by_type(rows)


@query(
    "visible_by_type_clean",
    feed_sql("""
SELECT event_type, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents
FROM rows_ JOIN canon USING (height, hash) GROUP BY event_type"""),
)
def visible_by_type_clean(spark: SparkSession, sf: str) -> DataFrame:
    """No orphans at any height. Rows are pre-aggregated by block before they meet the chain."""
    rows = d.fork_rows(spark, sf)
    per_block = rows.groupBy("height", "hash", "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents")
    )
    valid = visible.registered_rows(per_block, chain.canonical_chain(d.deliveries(spark, sf)))
    return valid.groupBy("event_type").agg(F.sum("n").alias("n"), F.sum("cents").alias("cents"))


@query(
    "hot_orphans",
    feed_sql(f"""
SELECT event_id, height, hash FROM rows_ r WHERE height > (SELECT h FROM tip) - {DEPTH}
AND NOT EXISTS (SELECT 1 FROM registry g WHERE g.height = r.height AND g.hash = r.hash)"""),
)
def hot_orphans(spark: SparkSession, sf: str) -> DataFrame:
    cut = blocks.threshold(d.tip(spark, sf), DEPTH)
    hot = d.fork_rows(spark, sf).filter(F.col("height") > cut)
    registry = d.canonical_blocks(spark, sf, cut)
    orphans = visible.orphan_rows(hot, registry, max_blocks=DEPTH + 1)
    return orphans.select("event_id", "height", "hash")


@query("canonical_chain", feed_sql("SELECT height, hash, seq FROM canon"))
def canonical_chain(spark: SparkSession, sf: str) -> DataFrame:
    return chain.canonical_chain(d.deliveries(spark, sf)).select("height", "hash", "seq")


@query(
    "orphaned_blocks",
    feed_sql("""
SELECT height, hash, seq FROM blocks_ b
WHERE NOT EXISTS (SELECT 1 FROM canon c WHERE c.height = b.height AND c.hash = b.hash)"""),
)
def orphaned_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Anti-join over all heights, where the registry has no bound and is not broadcast."""
    delivered = d.deliveries(spark, sf)
    canonical = chain.canonical_chain(delivered)
    return visible.orphan_rows(delivered, canonical, salt_by=["seq"]).select(
        "height", "hash", "seq"
    )


@query(
    "fork_steps",
    feed_sql("""
SELECT seq, height, hash, coalesce(t, -1) AS tip,
       CASE WHEN height <= t THEN 1 ELSE 0 END AS is_fork
FROM (SELECT *, lag(height) OVER (ORDER BY seq) AS t FROM blocks_)"""),
)
def fork_steps(spark: SparkSession, sf: str) -> DataFrame:
    marked = chain.mark_forks(d.deliveries(spark, sf))
    return marked.select(
        "seq",
        "height",
        "hash",
        F.coalesce("tip", F.lit(-1)).alias("tip"),
        F.col("is_fork").cast("int").alias("is_fork"),
    )


def _replacing_blocks(spark: SparkSession, sf: str, first_place: int) -> DataFrame:
    """Canonical blocks re-delivered by the step of each period, with that step's heads."""
    period = F.call_function("div", F.col("height"), F.lit(d.PERIOD))
    top = period * d.PERIOD + (d.PERIOD - 1)
    return (
        d.canonical_blocks(spark, sf)
        .filter(F.col("height") % d.PERIOD >= first_place)
        .withColumn("step", period)
        .withColumn("finalized", F.greatest(top - DEPTH, F.lit(-1)))
        .withColumn("base", top - 2)
    )


def _chain_before(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks on the chain when each period's losing fork is still in place."""
    place = F.col("height") % d.PERIOD
    on_chain = (place < d.FORK_FROM) | (F.col("fork") == 1)
    return (
        d.deliveries(spark, sf)
        .filter(on_chain)
        .withColumn("step", F.call_function("div", F.col("height"), F.lit(d.PERIOD)))
    )


_STEP_SQL = f"""
, steps AS (SELECT height, hash, height // {d.PERIOD} AS step,
                   greatest((height // {d.PERIOD}) * {d.PERIOD} + {d.PERIOD - 1 - DEPTH}, -1) AS fin
            FROM canon),
before AS (SELECT height, hash, height // {d.PERIOD} AS step FROM blocks_
           WHERE height % {d.PERIOD} < {d.FORK_FROM} OR fork = 1)
"""


@query(
    "common_ancestor",
    feed_sql(f"{_STEP_SQL}" f"""
SELECT s.step, greatest(max(CASE WHEN b.hash IS NOT NULL THEN s.height END), max(s.fin)) AS ancestor
FROM steps s LEFT JOIN before b ON b.hash = s.hash
WHERE s.height % {d.PERIOD} >= {d.FORK_FROM - 1} GROUP BY s.step"""),
)
def common_ancestor(spark: SparkSession, sf: str) -> DataFrame:
    """The step re-delivers one block below the fork, which is found by hash."""
    new = _replacing_blocks(spark, sf, d.FORK_FROM - 1)
    return chain.common_ancestor(new, _chain_before(spark, sf), ["step"], F.col("finalized"))


@query(
    "common_ancestor_base",
    feed_sql(f"{_STEP_SQL}" f"""
SELECT step, greatest(step * {d.PERIOD} + {d.FORK_FROM - 1}, max(fin)) AS ancestor FROM steps
WHERE height % {d.PERIOD} >= {d.FORK_FROM} GROUP BY step"""),
)
def common_ancestor_base(spark: SparkSession, sf: str) -> DataFrame:
    """The step re-delivers only the new blocks: its base block tells where the fork begins."""
    new = _replacing_blocks(spark, sf, d.FORK_FROM)
    before = _chain_before(spark, sf)
    return chain.common_ancestor(new, before, ["step"], F.col("finalized"), F.col("base"))


@query(
    "rolled_back_blocks",
    feed_sql(f"{_STEP_SQL}" f"""
, found AS (SELECT step, greatest(step * {d.PERIOD} + {d.FORK_FROM - 1}, max(fin)) AS ancestor
            FROM steps WHERE height % {d.PERIOD} >= {d.FORK_FROM} GROUP BY step)
SELECT step, CAST(count(*) FILTER (WHERE b.height > ancestor) AS BIGINT) AS rolled_back_blocks
FROM before b JOIN found USING (step) GROUP BY step"""),
)
def rolled_back_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return chain.rolled_back(
        _chain_before(spark, sf), common_ancestor_base(spark, sf), ["step"]
    )


@query(
    "registry_after_fork",
    feed_sql(f"""
, last AS (SELECT ((h - 12) // {d.PERIOD}) * {d.PERIOD} + 12 AS t FROM tip)
SELECT height, md5('a:' || CAST(height AS VARCHAR)) AS hash FROM (SELECT DISTINCT height FROM e)
WHERE height BETWEEN (SELECT t FROM last) - {DEPTH} AND (SELECT t FROM last)"""),
)
def registry_after_fork(spark: SparkSession, sf: str) -> DataFrame:
    """State after the last complete fork: its two blocks replaced, the rest kept, then pruned."""
    top = F.call_function("div", d.tip(spark, sf) - 12, F.lit(d.PERIOD)) * d.PERIOD + 12
    span = d.deliveries(spark, sf).filter(
        (F.col("height") >= top - DEPTH) & (F.col("height") <= top)
    )
    lost = (F.col("height") > top - 2) & (F.col("fork") == 1)
    before = span.filter(lost | ((F.col("height") <= top - 2) & (F.col("fork") == 0)))
    new = span.filter((F.col("height") > top - 2) & (F.col("fork") == 0))
    columns = ["processor_id", "height", "hash"]
    after = chain.after_fork(before.select(*columns), top - 1, new)
    return chain.prune_below(after, blocks.threshold(top, DEPTH)).select("height", "hash")


@query(
    "registered_blocks",
    feed_sql("""
SELECT height, hash FROM (SELECT *, row_number() OVER (PARTITION BY height ORDER BY seq DESC) AS rn
FROM blocks_) WHERE rn = 1"""),
)
def registered_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Losing blocks are registered first and overwritten at their height."""
    delivered = d.deliveries(spark, sf)
    lost, won = delivered.filter("fork = 1"), delivered.filter("fork = 0")
    columns = ["processor_id", "height", "hash", "seq"]
    return chain.register(lost.select(*columns), won).select("height", "hash")


@query("registry_pruned", feed_sql("SELECT height, hash FROM registry"))
def registry_pruned(spark: SparkSession, sf: str) -> DataFrame:
    lowest = blocks.threshold(d.tip(spark, sf), DEPTH)
    whole = chain.canonical_chain(d.deliveries(spark, sf))
    return chain.prune_below(whole, lowest).select("height", "hash").orderBy("height")


@query(
    "registry_bounds",
    feed_sql(f"""
, p AS (SELECT DISTINCT 'p' || CAST(user_id % 4 AS VARCHAR) AS processor_id FROM e),
r AS (SELECT DISTINCT 'p' || CAST(user_id % 4 AS VARCHAR) AS processor_id, height FROM e
      WHERE user_id % 4 < 3)
SELECT processor_id, coalesce(max(height), -1) AS highest, coalesce(min(height), -1) AS lowest,
       count(height) AS n_blocks, coalesce(max(height), -1) - {DEPTH} AS threshold
FROM p LEFT JOIN r USING (processor_id) GROUP BY processor_id"""),
)
def registry_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Processor p3 has no registered block."""
    e = with_processor(d.events(spark, sf), 4)
    registry = e.filter(F.col("user_id") % 4 < 3).select("processor_id", "height").distinct()
    found = chain.bounds(registry, e.select("processor_id").distinct())
    return found.withColumn("threshold", blocks.threshold(F.col("highest"), DEPTH))


def with_processor(rows: DataFrame, n: int) -> DataFrame:
    return rows.withColumn(
        "processor_id", F.concat(F.lit("p"), (F.col("user_id") % n).cast("string"))
    )


@query(
    "unregistered_blocks",
    feed_sql(f"""
SELECT height, hash FROM blocks_ b WHERE height >= (SELECT h FROM tip) - {DEPTH}
AND NOT EXISTS (SELECT 1 FROM registry g WHERE g.height = b.height AND g.hash = b.hash)"""),
)
def unregistered_blocks(spark: SparkSession, sf: str) -> DataFrame:
    cut = blocks.threshold(d.tip(spark, sf), DEPTH)
    recent = d.deliveries(spark, sf).filter(F.col("height") >= cut)
    return chain.unregistered(recent, d.canonical_blocks(spark, sf, cut)).select("height", "hash")


@query(
    "finality_advance",
    feed_sql(f"""
, f AS (SELECT DISTINCT height, height - {DEPTH} - (height * 7) % 5 AS announced FROM e)
SELECT height, announced, max(announced) OVER (ORDER BY height) AS finalized FROM f"""),
)
def finality_advance(spark: SparkSession, sf: str) -> DataFrame:
    """Announced heads may step back; the finalized height never does."""
    steps = d.canonical_blocks(spark, sf).withColumn(
        "announced", F.col("height") - DEPTH - (F.col("height") * 7) % 5
    )
    seen = ranges.running_max_before(steps, ["processor_id"], "height", "announced", "before")
    return seen.select(
        "height", "announced", F.greatest("before", "announced").alias("finalized")
    )


@query(
    "hot_chain_tail",
    feed_sql(f"""
, c AS (SELECT DISTINCT 'p' || CAST(user_id % 4 AS VARCHAR) AS processor_id, height FROM e)
SELECT processor_id, height, md5('a:' || CAST(height AS VARCHAR)) AS hash
FROM (SELECT *, row_number() OVER (PARTITION BY processor_id ORDER BY height DESC) AS rn FROM c)
WHERE rn <= {DEPTH}"""),
)
def hot_chain_tail(spark: SparkSession, sf: str) -> DataFrame:
    chains = (
        with_processor(d.events(spark, sf), 4).groupBy("processor_id", "height").agg(
            F.count(F.lit(1)).alias("n")
        )
    )
    tail = chain.chain_tail(chains, DEPTH)
    return tail.select("processor_id", "height", d.block_hash(F.col("height")).alias("hash"))


@query(
    "multi_processor",
    feed_sql(f"""
, m AS (SELECT *, 'p' || CAST(user_id % 2 AS VARCHAR) AS processor_id FROM rows_),
t AS (SELECT processor_id, max(height) - {DEPTH} AS cut FROM m GROUP BY 1),
g AS (SELECT DISTINCT m.processor_id, m.height, m.hash FROM m JOIN t USING (processor_id)
      JOIN canon c ON c.height = m.height AND c.hash = m.hash WHERE m.height > t.cut)
SELECT m.processor_id, event_type, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents
FROM m JOIN t USING (processor_id)
LEFT JOIN g ON g.processor_id = m.processor_id AND g.height = m.height AND g.hash = m.hash
WHERE m.height <= t.cut OR g.hash IS NOT NULL
GROUP BY m.processor_id, event_type"""),
)
def multi_processor(spark: SparkSession, sf: str) -> DataFrame:
    """Two processors in one table, each with its own tip and registry."""
    rows = with_processor(d.fork_rows(spark, sf), 2)
    cuts = (
        with_processor(d.events(spark, sf), 2)
        .groupBy("processor_id")
        .agg((F.max("height") - DEPTH).alias("cut"))
    )
    # user_id % 2 has two values at any scale: two cuts, and at most DEPTH blocks for each.
    own = ["processor_id"]
    cut_rows = joins.keyed_join(rows, cuts, own, "inner", max_rows=2)
    chains = with_processor(d.events(spark, sf), 2).groupBy("processor_id", "height").agg(
        F.count(F.lit(1)).alias("n")
    )
    registry = joins.keyed_join(
        chains.withColumn("hash", d.block_hash(F.col("height"))), cuts, own, "inner", max_rows=2
    )
    seen = visible.valid_rows(cut_rows, registry, F.col("cut"), max_blocks=2 * DEPTH, keys=own)
    return seen.groupBy("processor_id", "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents")
    )


@query(
    "hot_blocks_json",
    feed_sql("""
SELECT period, '[' || string_agg('{"height":' || CAST(height AS VARCHAR) || ',"hash":"' || hash
  || '"}', ',' ORDER BY height) || ']' AS hot_blocks, count(*) AS n_blocks
FROM (SELECT *, height // 13 AS period FROM canon) GROUP BY period"""),
)
def hot_blocks_json(spark: SparkSession, sf: str) -> DataFrame:
    """Block lists of 13 heights each as JSON text and back."""
    period = F.call_function("div", F.col("height"), F.lit(d.PERIOD))
    lists = (
        chain.canonical_chain(d.deliveries(spark, sf))
        .groupBy(period.alias("period"))
        .agg(F.array_sort(F.collect_list(F.struct("height", "hash", "seq"))).alias("refs"))
        .withColumn("hot_blocks", blocks.blocks_json(F.col("refs")))
    )
    return lists.select(
        "period",
        "hot_blocks",
        F.size(blocks.parse_blocks(F.col("hot_blocks"))).cast("bigint").alias("n_blocks"),
    )
