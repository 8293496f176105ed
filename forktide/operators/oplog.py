"""Operations metrics as data: counters, rolling means and the long form.

The log has one row per recorded operation, appended by the jobs that did the work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forktide.operators import ranges

LOG_SCHEMA = (
    "processor_id string, seq bigint, op string, ok boolean, finalized boolean, amount bigint, "
    "height bigint, duration_ms bigint, at_ms bigint, table_name string, rows_in bigint, "
    "rows_out bigint"
)
SAMPLES = 100

# Metric name, kind, summary column, divisor, help.
METRICS = (
    ("connections_total", "counter", "connections", 1, "connections made"),
    ("connection_errors_total", "counter", "connection_errors", 1, "connections that failed"),
    ("last_connection_timestamp", "gauge", "last_connection_ms", 1000, "time of last connection, s"),
    ("blocks_processed_total", "counter", "blocks_processed", 1, "blocks written"),
    ("blocks_finalized_total", "counter", "blocks_finalized", 1, "final blocks written"),
    ("hot_blocks_processed_total", "counter", "hot_blocks_processed", 1, "hot blocks written"),
    ("reorgs_detected_total", "counter", "forks_detected", 1, "forks seen"),
    ("reorgs_executed_total", "counter", "forks_executed", 1, "forks applied"),
    ("last_reorg_height", "gauge", "last_fork_height", 1, "height of last fork"),
    ("last_reorg_timestamp", "gauge", "last_fork_ms", 1000, "time of last fork, s"),
    ("blocks_rolled_back_total", "counter", "blocks_rolled_back", 1, "blocks taken back by forks"),
    ("inserts_total", "counter", "inserts", 1, "insert operations"),
    ("insert_errors_total", "counter", "insert_errors", 1, "inserts that failed"),
    ("last_insert_duration_ms", "gauge", "last_insert_ms", 1, "duration of last insert"),
    ("avg_insert_duration_ms", "gauge", "avg_insert_ms", 1, "mean of the last 100 inserts"),
    ("queries_total", "counter", "queries", 1, "query operations"),
    ("query_errors_total", "counter", "query_errors", 1, "queries that failed"),
    ("last_query_duration_ms", "gauge", "last_query_ms", 1, "duration of last query"),
    ("avg_query_duration_ms", "gauge", "avg_query_ms", 1, "mean of the last 100 queries"),
    ("status_updates_total", "counter", "status_updates", 1, "status rows written"),
    ("last_status_update_timestamp", "gauge", "last_status_ms", 1000, "time of last status row, s"),
)


def recent_means(
    log: DataFrame, keys: Sequence[str] = ("processor_id", "op"), samples: int = SAMPLES
) -> DataFrame:
    """Mean duration of the last successful operations per key (K2).

    The row limit per key is applied before the shuffle, so a busy key sends ``samples`` rows per
    map task at most.
    """
    w = Window.partitionBy(*keys).orderBy(F.col("seq").desc())
    return (
        log.filter("ok")
        .withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") <= samples)
        .groupBy(*keys)
        .agg((F.sum("duration_ms") / F.count(F.lit(1))).alias("mean_ms"))
    )


def rolling_means(
    log: DataFrame,
    keys: Sequence[str] = ("processor_id", "op"),
    samples: int = SAMPLES,
    width: int = ranges.WIDTH,
) -> DataFrame:
    """The mean as it stood after each successful operation (W4); the log counts in microseconds."""
    done = log.filter("ok")
    summed = ranges.trailing_sums(
        done, keys, "seq", "duration_ms", samples, "window_sum", "window_n", width, sparse=True
    )
    return summed.withColumn("mean_ms", F.col("window_sum") / F.col("window_n"))


def summary(log: DataFrame) -> DataFrame:
    """One row of counters per processor (K1), from a single aggregation pass plus the means."""

    def is_op(op: str) -> Column:
        return F.col("op") == op

    def n(condition: Column, name: str) -> Column:
        return F.count_if(condition).alias(name)

    def total(condition: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("amount"))), F.lit(0)).alias(name)

    def last(value: str, condition: Column, name: str) -> Column:
        newest = F.max_by(value, F.when(condition, F.col("seq")))
        return F.coalesce(newest, F.lit(0)).alias(name)

    ok, final = F.col("ok"), F.col("finalized")
    counters = log.groupBy("processor_id").agg(
        n(is_op("connection") & ok, "connections"),
        n(is_op("connection") & ~ok, "connection_errors"),
        last("at_ms", is_op("connection") & ok, "last_connection_ms"),
        total(is_op("blocks"), "blocks_processed"),
        total(is_op("blocks") & final, "blocks_finalized"),
        total(is_op("blocks") & ~final, "hot_blocks_processed"),
        n(is_op("fork_detected"), "forks_detected"),
        n(is_op("fork_executed"), "forks_executed"),
        last("height", is_op("fork_executed"), "last_fork_height"),
        last("at_ms", is_op("fork_executed"), "last_fork_ms"),
        total(is_op("fork_executed"), "blocks_rolled_back"),
        n(is_op("insert"), "inserts"),
        n(is_op("insert") & ~ok, "insert_errors"),
        last("duration_ms", is_op("insert") & ok, "last_insert_ms"),
        n(is_op("query"), "queries"),
        n(is_op("query") & ~ok, "query_errors"),
        last("duration_ms", is_op("query") & ok, "last_query_ms"),
        n(is_op("status"), "status_updates"),
        last("at_ms", is_op("status"), "last_status_ms"),
    )
    means = (
        recent_means(log.filter(F.col("op").isin("insert", "query")))
        .groupBy("processor_id")
        .agg(
            F.max(F.when(is_op("insert"), F.col("mean_ms"))).alias("_insert"),
            F.max(F.when(is_op("query"), F.col("mean_ms"))).alias("_query"),
        )
    )
    zero = F.lit(0.0)
    return (
        counters.join(means, "processor_id", "left")
        .withColumn("avg_insert_ms", F.coalesce("_insert", zero))
        .withColumn("avg_query_ms", F.coalesce("_query", zero))
        .drop("_insert", "_query")
    )


def long_form(summaries: DataFrame, prefix: str = "") -> DataFrame:
    """``(processor_id, name, type, help, value)``; times are given in seconds (K3)."""
    entries = [
        F.struct(
            F.lit(prefix + name).alias("name"),
            F.lit(kind).alias("type"),
            F.lit(help_text).alias("help"),
            (F.col(column).cast("double") / F.lit(float(divisor))).alias("value"),
        )
        for name, kind, column, divisor, help_text in METRICS
    ]
    return summaries.select("processor_id", F.inline(F.array(*entries)))
