"""Queries that go through stored tables: streams, moves, upserts, physical deletes, JSON lines."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forktide.functions import clock
from forktide.operators import migration
from forktide.plans import derived as d
from forktide.plans.chain_queries import by_type
from forktide.plans.derived import feed_sql
from forktide.plans.registry import ORACLES, query
from forktide.sources import feed as feeds
from forktide.sources import rows as row_ops
from forktide.sources import scratch
from forktide.sources import tables as tb
from forktide.streaming.runner import run_feed
from forktide.streaming.store import FinalityError, ForkStore, StoreOptions

EVENTS = tb.EventTable(
    "events",
    "event_id bigint, user_id bigint, event_type string, cents bigint, ts timestamp, "
    "height bigint, hash string",
    key=("height", "event_id"),
    timestamp="ts",
)
FEED_SCHEMA = EVENTS.schema + (
    ", seq bigint, parent string, finalized_height bigint, is_head boolean"
)
# The first tenth of the heights comes as final blocks, the rest at the head with all its forks.
FINAL_PART = 10
FINALITY = 20


def feed(spark: SparkSession, sf: str, forks: bool = True) -> DataFrame:
    """The derived feed as a source delivers it: final blocks first, then most blocks with forks.

    Without ``forks``, the blocks that survive only.
    """
    tip = d.tip(spark, sf)
    head_from = F.call_function("div", tip, F.lit(FINAL_PART * d.PERIOD)) * d.PERIOD
    rows = d.fork_rows(spark, sf)
    return rows.select(
        *[F.col(c) for c in EVENTS.columns if c != "ts"],
        F.col("ts").cast("timestamp").alias("ts"),
        "seq",
        d.block_hash(F.col("height") - 1).alias("parent"),
        F.greatest(F.col("height") - FINALITY, head_from).alias("finalized_height"),
        (F.col("height") > head_from).alias("is_head"),
        "fork",
    ).filter((F.col("is_head") & F.lit(forks)) | (F.col("fork") == 0)).drop("fork")


def open_store(
    spark: SparkSession, purpose: str, tables: Sequence[tb.EventTable] = (EVENTS,),
    place: tuple[str, str] | None = None, **options,
) -> ForkStore:
    """A connected store in a new folder and database, or in the given ones."""
    folder, database = place or scratch.fresh(spark, purpose)
    store = ForkStore(
        spark,
        database,
        list(tables),
        options=StoreOptions(**{"hot_blocks_depth": 10, **options}),
        location=f"{folder}/tables",
    )
    store.connect()
    return store


def as_events(batch: DataFrame) -> dict[str, DataFrame]:
    return {"events": batch}


CLEAN_SQL = feed_sql("""
SELECT event_type, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents
FROM rows_ JOIN canon USING (height, hash) GROUP BY event_type""")


@query("streamed_visible", CLEAN_SQL)
def streamed_visible(spark: SparkSession, sf: str) -> DataFrame:
    """Catch-up, then the head of the feed with forks and moves, as a restarted file stream.

    Files arrive in order of the feed, one piece after the other; every piece resumes the stream
    from its checkpoint.
    """
    store = open_store(spark, "streamed")
    base = store.location.rsplit("/", 1)[0]
    rows = feed(spark, sf)
    columns = [c.split()[0] for c in FEED_SCHEMA.split(", ")]
    top, low = rows.filter("is_head").agg(F.max("seq"), F.min("seq")).first()
    # The first cut ends the catch-up; others fall between a losing and a winning fork.
    cuts = [-1, low - 1, low + (top - low) // 3, low + 2 * (top - low) // 3, top]
    for after, upto in zip(cuts, cuts[1:]):
        piece = rows.filter((F.col("seq") > after) & (F.col("seq") <= upto)).select(*columns)
        piece.write.mode("append").parquet(f"{base}/feed")
        stream = feeds.stream_feed(spark, f"{base}/feed", FEED_SCHEMA, files_per_batch=100_000)
        run_feed(store, stream, as_events, f"{base}/checkpoint")
    return by_type(store.visible("events"))


PIECES = 7


def apply_in_pieces(store: ForkStore, rows: DataFrame, pieces: int = PIECES) -> None:
    """The final part, then the head in epochs that hold an equal share of the deliveries each."""
    top, low = rows.filter("is_head").agg(F.max("seq"), F.min("seq")).first()
    store.apply_final(rows.filter(~F.col("is_head")), as_events, "feed", 0)
    for n in range(pieces):
        after, upto = low + (top + 1 - low) * n // pieces, low + (top + 1 - low) * (n + 1) // pieces
        part = rows.filter(F.col("is_head") & (F.col("seq") >= after) & (F.col("seq") < upto))
        store.apply_hot(part, as_events, "feed", n + 1)


@query(
    "registry_replayed",
    feed_sql(f"""
, head AS (SELECT h // {FINAL_PART * d.PERIOD} * {d.PERIOD} AS f, h FROM tip)
SELECT height, hash, height > h - {FINALITY} AS unfinalized FROM canon, head WHERE height >= f"""),
)
def registry_replayed(spark: SparkSession, sf: str) -> DataFrame:
    """Registry and hot chain after several epochs with forks, replayed from changes and two bases."""
    store = open_store(spark, "replayed", auto_migrate=False, registry_spans=3)
    apply_in_pieces(store, feed(spark, sf))
    hot = store.hot_chain().select("height", F.lit(True).alias("unfinalized"))
    found = store.registry().join(hot, "height", "left")
    return found.select("height", "hash", F.coalesce("unfinalized", F.lit(False)).alias("unfinalized"))


@query(
    "move_while_catching_up",
    feed_sql(f"""
, head AS (SELECT h // {FINAL_PART * d.PERIOD} * {d.PERIOD} AS f FROM tip)
SELECT 0 AS moved, -1 AS cutoff, count(*) AS cold
FROM rows_ JOIN canon USING (height, hash), head WHERE height <= f"""),
)
def move_while_catching_up(spark: SparkSession, sf: str) -> DataFrame:
    """A manual move moves nothing as long as the feed is not at its head; rows are in cold already."""
    store = open_store(spark, "catching", hold_to_finality=False)
    store.apply(feed(spark, sf).filter(~F.col("is_head")), as_events, "feed", 0)
    result = store.migrate()
    cold = store.visible("events").agg(F.count(F.lit(1)).alias("cold"))
    return cold.select(F.lit(result.migrated).alias("moved"), F.lit(result.cutoff_height).alias("cutoff"), "cold")


@query(
    "moved_with_hooks",
    feed_sql(f"""
, head AS (SELECT h // {FINAL_PART * d.PERIOD} * {d.PERIOD} AS f, h FROM tip)
SELECT event_type, count(*) AS n,
       CAST(sum(CASE WHEN height > f AND height <= h - {FINALITY} THEN cents * 2 ELSE cents END)
            AS BIGINT) AS cents
FROM rows_ JOIN canon USING (height, hash), head
WHERE NOT (event_type = 'error' AND height > f AND height <= h - {FINALITY})
GROUP BY event_type"""),
)
def moved_with_hooks(spark: SparkSession, sf: str) -> DataFrame:
    """A move whose transform drops one event type and doubles amounts; catch-up rows pass by it."""

    def transform(rows: DataFrame, context: migration.TransformContext) -> DataFrame:
        return rows.filter("event_type <> 'error'").withColumn("cents", F.col("cents") * 2)

    store = open_store(
        spark,
        "hooks",
        auto_migrate=False,
        hooks=migration.MigrationHooks(transform_rows=transform),
    )
    store.apply(feed(spark, sf), as_events, "feed", 0)
    store.migrate()
    return by_type(store.visible("events"))


@query(
    "zone_sizes",
    feed_sql(f"""
SELECT CASE WHEN height <= h - {FINALITY} THEN 'cold' ELSE 'hot' END AS zone, count(*) AS n,
       min(height) AS low, max(height) AS top
FROM rows_ JOIN canon USING (height, hash), tip GROUP BY zone"""),
)
def zone_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per zone after a move, read zone by zone through the height range."""
    store = open_store(spark, "zones", auto_migrate=False)
    store.apply(feed(spark, sf), as_events, "feed", 0)
    cut = store.migrate().cutoff_height
    parts = [
        store.visible("events", height_to=cut).withColumn("zone", F.lit("cold")),
        store.visible("events", height_from=cut + 1).withColumn("zone", F.lit("hot")),
    ]
    both = parts[0].unionByName(parts[1])
    return both.groupBy("zone").agg(
        F.count(F.lit(1)).alias("n"), F.min("height").alias("low"), F.max("height").alias("top")
    )


OTHERS = replace(EVENTS, name="others")
BOTH_SQL = feed_sql("""
SELECT name, event_type, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents
FROM rows_ JOIN canon USING (height, hash), (VALUES ('events'), ('others')) AS t(name)
GROUP BY name, event_type""")


def as_both(batch: DataFrame) -> dict[str, DataFrame]:
    return {"events": batch, "others": batch}


def uneven_store(spark: SparkSession, sf: str, purpose: str) -> ForkStore:
    """Two tables after the whole feed; the second one's last move failed, so it lags behind."""
    failing = []

    def transform(rows: DataFrame, context: migration.TransformContext) -> DataFrame:
        if context.table in failing:
            raise RuntimeError("planned failure")
        return rows

    store = open_store(
        spark, purpose, tables=(EVENTS, OTHERS), auto_migrate=False, hold_to_finality=False,
        hooks=migration.MigrationHooks(transform_rows=transform),
    )
    store.apply(feed(spark, sf), as_both, "feed", 0)
    tip = store.head_height
    store.migrate(tip // 2)
    failing.append("others")
    store.migrate(tip - FINALITY)
    failing.clear()
    return store


def by_table(store: ForkStore) -> DataFrame:
    parts = [by_type(store.visible(n)).select(F.lit(n).alias("name"), "*") for n in ("events", "others")]
    return parts[0].unionByName(parts[1])


@query("uneven_move_visible", BOTH_SQL)
def uneven_move_visible(spark: SparkSession, sf: str) -> DataFrame:
    """One table fails to move, hot is cleared, and the feed comes again from what cold holds of all."""
    store = uneven_store(spark, sf, "uneven")
    cold = store.cold_status().first()
    store.clear_hot(cold["height"], cold["hash"])
    again = feed(spark, sf, forks=False).filter(F.col("height") > cold["height"])
    half = cold["height"] + (cold["height"] // 2)
    store.apply_final(again.filter(F.col("height") <= half), as_both, "again", 0)
    store.apply_final(again.filter(F.col("height") > half), as_both, "again", 1)
    return by_table(store)


@query("fork_between_cutoffs", BOTH_SQL)
def fork_between_cutoffs(spark: SparkSession, sf: str) -> DataFrame:
    """A fork below what one table holds in cold is refused and changes neither table."""
    store = uneven_store(spark, sf, "between")
    low = store.cold_status().first()["height"] + 1
    late = feed(spark, sf, forks=False).filter(F.col("height") >= low)
    late = late.withColumn("hash", F.md5(F.concat(F.lit("late:"), F.col("height").cast("string"))))
    late = late.withColumn("seq", F.col("seq") + F.lit(1 << 40)).drop("finalized_height", "is_head", "parent")
    try:
        store.apply_hot(late, as_both, "late", 0)
    except FinalityError:
        return by_table(store)
    raise AssertionError("the fork was accepted")


@query("live_fork_floor", CLEAN_SQL)
def live_fork_floor(spark: SparkSession, sf: str) -> DataFrame:
    """A fork below the finalized height is refused though nothing was moved yet."""
    store = open_store(spark, "floor", auto_migrate=False)
    store.apply(feed(spark, sf), as_events, "feed", 0)
    low = store.head_height - 2 * FINALITY
    late = feed(spark, sf, forks=False).filter(F.col("height") >= low)
    late = late.withColumn("hash", F.md5(F.concat(F.lit("late:"), F.col("height").cast("string"))))
    late = late.withColumn("seq", F.col("seq") + F.lit(1 << 40)).drop("finalized_height", "is_head", "parent")
    try:
        store.apply_hot(late, as_events, "late", 0)
    except FinalityError:
        return by_type(store.visible("events"))
    raise AssertionError("the fork was accepted")


@query(
    "stored_processors",
    feed_sql("""
SELECT CASE WHEN height % 2 = 0 THEN 'eth:main' ELSE 'it''s 50%' END AS processor, event_type,
       count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents
FROM rows_ JOIN canon USING (height, hash) GROUP BY ALL"""),
)
def stored_processors(spark: SparkSession, sf: str) -> DataFrame:
    """Two processors in one set of tables, one of which is cleared and caught up again."""
    folder, database = scratch.fresh(spark, "processors")
    out = None
    for parity, name in enumerate(("eth:main", "it's 50%")):
        own = feed(spark, sf).filter(F.col("height") % 2 == parity)
        store = open_store(spark, "processors", place=(folder, database), processor_id=name, auto_migrate=False)
        store.apply(own, as_events, "feed", 0)
        store.migrate()
        if parity:
            cold = store.cold_status().first()
            store.clear_hot(cold["height"], cold["hash"])
            rest = feed(spark, sf, forks=False).filter((F.col("height") % 2 == parity) & (F.col("height") > cold["height"]))
            store.apply_final(rest, as_events, "again", 0)
        part = by_type(store.visible("events")).select(F.lit(name).alias("processor"), "*")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "hooked_moves",
    feed_sql(f"""
, head AS (SELECT h // {FINAL_PART * d.PERIOD} * {d.PERIOD} AS f, h, h - {2 * FINALITY} AS cutoff FROM tip)
SELECT cutoff, 2 AS asked, count(*) AS cold, CAST(sum(CASE WHEN height > f THEN 1 ELSE 0 END) AS BIGINT) AS moved
FROM rows_ JOIN canon USING (height, hash), head WHERE height <= cutoff GROUP BY cutoff"""),
)
def hooked_moves(spark: SparkSession, sf: str) -> DataFrame:
    """The before-hook cancels the first move, a custom move replaces the second, the after-hook sees it."""
    asked, results = [], []

    def before(context: migration.MigrationContext) -> bool:
        asked.append(context)
        return len(asked) > 1

    store = open_store(
        spark,
        "hooked",
        auto_migrate=False,
        hooks=migration.MigrationHooks(
            before_migration=before,
            custom_migration=lambda s: s.migrate(s.head_height - 2 * FINALITY),
            after_migration=results.append,
        ),
    )
    store.apply(feed(spark, sf), as_events, "feed", 0)
    if store.perform_migration() is not None:
        raise AssertionError("the first move was not cancelled")
    store.perform_migration()
    cutoff = results[0].cutoff_height
    cold = store.visible("events", height_to=cutoff).agg(F.count(F.lit(1)).alias("cold"))
    return cold.select(
        F.lit(cutoff).cast("bigint").alias("cutoff"),
        F.lit(len(asked)).alias("asked"),
        "cold",
        F.lit(results[0].migrated).cast("bigint").alias("moved"),
    )


@query("compacted_cold", CLEAN_SQL)
def compacted_cold(spark: SparkSession, sf: str) -> DataFrame:
    """Several moves, every month of cold merged into one part, then another move."""
    store = open_store(spark, "compacted", auto_migrate=False, hold_to_finality=False)
    store.apply(feed(spark, sf), as_events, "feed", 0)
    tip = store.head_height
    store.migrate(tip // 3)
    store.migrate(tip // 2)
    months = {p[tb.MONTH] for p in tb.partitions_of(spark, store.cold_name("events"))}
    for month in sorted(months):
        store.compact_cold("events", month)
    store.migrate(tip - FINALITY)
    return by_type(store.visible("events"))


REMOVED_SQL = "event_type = 'error' AND user_id % 2 = 0"


@query(
    "removed_from_zones",
    feed_sql(f"""
SELECT event_type, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents
FROM rows_ JOIN canon USING (height, hash) WHERE NOT ({REMOVED_SQL}) GROUP BY event_type"""),
)
def removed_from_zones(spark: SparkSession, sf: str) -> DataFrame:
    """Rows removed from hot and cold are gone for readers, also after the next move."""
    store = open_store(spark, "removed", auto_migrate=False, hold_to_finality=False)
    store.apply(feed(spark, sf), as_events, "feed", 0)
    store.migrate(store.head_height // 2)
    store.remove("events", F.expr(REMOVED_SQL))
    store.migrate()
    return by_type(store.visible("events"))


@query(
    "removed_under_reader",
    feed_sql(f"""
SELECT opened, event_type, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents
FROM rows_ JOIN canon USING (height, hash), (VALUES ('before'), ('after')) AS t(opened)
WHERE opened = 'before' OR NOT ({REMOVED_SQL}) GROUP BY opened, event_type"""),
)
def removed_under_reader(spark: SparkSession, sf: str) -> DataFrame:
    """A reader opened before a removal sees all rows as they were, one opened after it the rest."""
    store = open_store(spark, "reader", auto_migrate=False, hold_to_finality=False)
    store.apply(feed(spark, sf), as_events, "feed", 0)
    store.migrate(store.head_height // 2)
    before = store.visible("events")
    store.remove("events", F.expr(REMOVED_SQL))
    parts = [
        by_type(rows).select(F.lit(opened).alias("opened"), "*")
        for opened, rows in (("before", before), ("after", store.visible("events")))
    ]
    return parts[0].unionByName(parts[1])


@query(
    "flushed_tables",
    "SELECT event_type AS entity, count(*) AS n FROM events GROUP BY event_type",
)
def flushed_tables(spark: SparkSession, sf: str) -> DataFrame:
    """One mixed batch, written to a table per entity."""
    entities = [r[0] for r in d.table(spark, sf, "events").select("event_type").distinct().collect()]
    targets = [replace(EVENTS, name=f"{e}s") for e in sorted(entities)]
    folder, database = scratch.fresh(spark, "flushed")
    store = ForkStore(spark, database, targets, location=f"{folder}/tables")
    store.connect()

    def handler(batch: DataFrame) -> dict[str, DataFrame]:
        parts = row_ops.split_by_entity(
            batch.withColumn("entity", F.col("event_type")), "entity", sorted(entities)
        )
        return {f"{e}s": rows for e, rows in parts.items()}

    store.apply_final(feed(spark, sf).filter(~F.col("is_head")), handler, "feed", 0)
    store.apply_hot(feed(spark, sf).filter("is_head"), handler, "feed", 1)
    counted = None
    for t in targets:
        part = store.visible(t.name).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
        counted = part if counted is None else counted.unionByName(part)
    return counted.withColumnRenamed("event_type", "entity")


ORDERS = tb.SnapshotTable(
    "latest_orders",
    "o_custkey bigint, o_orderdate timestamp, o_orderkey bigint, cents bigint",
    key=("o_custkey",),
    version=("o_orderdate", "o_orderkey"),
)


@query("snapshot_upserts", ORACLES["latest_by_version"])
def snapshot_upserts(spark: SparkSession, sf: str) -> DataFrame:
    """Two rounds of upserts with a compaction in between."""
    folder, database = scratch.fresh(spark, "snapshot")
    tb.create_tables(spark, database, d.NETWORK, snapshots=[ORDERS], location=f"{folder}/tables")
    orders = d.table(spark, sf, "orders").select(
        "o_custkey",
        F.col("o_orderdate").cast("timestamp").alias("o_orderdate"),
        "o_orderkey",
        d.cents("o_totalprice").alias("cents"),
    )
    for turn in (0, 1):
        part = orders.filter(F.col("o_orderkey") % 2 == turn)
        tb.upsert_snapshot(part, database, d.NETWORK, ORDERS, F.lit(turn))
        if turn == 0:
            tb.compact_snapshot(spark, database, d.NETWORK, ORDERS)
    newest = tb.read_snapshot(spark, database, d.NETWORK, ORDERS)
    return newest.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


@query(
    "deleted_where",
    """
SELECT l_returnflag, strftime(l_shipdate, '%Y') AS year, count(*) AS n FROM lineitem
WHERE NOT (l_returnflag = 'R' AND l_shipdate >= TIMESTAMP '1997-07-01')
  AND NOT (strftime(l_shipdate, '%Y') = '1995') GROUP BY ALL""",
)
def deleted_where(spark: SparkSession, sf: str) -> DataFrame:
    """Physical delete: partitions that lose every row are dropped, others rewritten."""
    folder, database = scratch.fresh(spark, "deletes")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{folder}/tables'")
    name = f"{database}.lines"
    tb.create_partitioned(
        spark,
        name,
        "l_orderkey bigint, l_returnflag string, l_shipdate timestamp, year string",
        ["year"],
        {"zone": "single"},
    )
    lines = d.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_returnflag",
        F.col("l_shipdate").cast("timestamp").alias("l_shipdate"),
        F.date_format("l_shipdate", "yyyy").alias("year"),
    )
    tb.overwrite_partitions(lines.hint("rebalance", "year"), name)
    late = (F.col("l_returnflag") == "R") & (
        F.col("l_shipdate") >= F.lit("1997-07-01").cast("timestamp")
    )
    tb.delete_where(spark, name, late | (F.col("year") == "1995"))
    return spark.table(name).groupBy("l_returnflag", "year").agg(F.count(F.lit(1)).alias("n"))


@query(
    "json_lines",
    """
SELECT event_type, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents,
       strftime(max(date_trunc('second', ts)), '%Y-%m-%d %H:%M:%S') AS last_ts
FROM events GROUP BY event_type""",
)
def json_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Events written as JSON lines and read back with a declared schema."""
    folder, _ = scratch.fresh(spark, "json")
    rows = d.events(spark, sf).select(
        "event_id", "event_type", "cents", clock.to_millis(F.col("ts").cast("timestamp")).alias("ts")
    )
    feeds.write_json_lines(rows, folder)
    back = feeds.read_json_lines(
        spark, folder, "event_id bigint, event_type string, cents bigint, ts timestamp"
    )
    return back.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("cents").alias("cents"),
        F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss").alias("last_ts"),
    )
