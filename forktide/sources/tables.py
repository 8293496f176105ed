"""Table declarations and their creation in the catalog (T1, T12, section 1.3 properties)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forktide.functions import clock, names
from forktide.operators import contracts
from forktide.operators.versions import latest_by_key

PROCESSOR, INGEST_SEQ = "processor_id", "ingest_seq"
EPOCH, TOP = "epoch", "top_height"
MONTH, MOVE = "ym", "mig"
GENERATION = "gen"
NO_MONTH = "none"


@dataclass(frozen=True)
class EventTable:
    """An event table in two zones. ``schema`` is a DDL string and has height and hash columns.

    ``key``: newest written row per key wins. ``timestamp``: column whose month partitions cold.
    """

    name: str
    schema: str
    key: tuple[str, ...] = ()
    timestamp: str | None = None
    height: str = "height"
    hash: str = "hash"
    sort: tuple[str, ...] = ()
    u256: tuple[str, ...] = ()
    hex_fields: tuple[str, ...] = ()

    @property
    def fields(self) -> T.StructType:
        return T.StructType.fromDDL(self.schema)

    @property
    def columns(self) -> list[str]:
        return self.fields.names

    def zone(self, network: str, zone: str) -> str:
        return names.zone_table(network, zone, self.name)

    def month(self) -> Column:
        """Month partition of a row; tables without a timestamp have one fixed value."""
        if self.timestamp is None:
            return F.lit(NO_MONTH)
        return F.coalesce(clock.year_month(F.col(self.timestamp)), F.lit(NO_MONTH))

    def write_order(self) -> list[str]:
        """Row order inside files, for row-group skipping."""
        return list(self.sort or self.key or (self.height,))


@dataclass(frozen=True)
class SnapshotTable:
    """One zone; the row with the largest version per key wins."""

    name: str
    schema: str
    key: tuple[str, ...]
    version: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return T.StructType.fromDDL(self.schema).names

    def table(self, network: str) -> str:
        return names.snapshot_table(network, self.name)


def _columns_sql(schema: str, extra: Sequence[tuple[str, str]]) -> str:
    cols = [(f.name, f.dataType.simpleString()) for f in T.StructType.fromDDL(schema).fields]
    return ", ".join(f"`{name}` {kind}" for name, kind in [*cols, *extra])


def _properties_sql(properties: dict[str, str]) -> str:
    return ", ".join(f"'{k}'='{v}'" for k, v in properties.items())


def create_partitioned(
    spark: SparkSession,
    name: str,
    columns: str,
    partitions: Sequence[str],
    properties: dict[str, str],
) -> None:
    """The table option makes every overwrite replace only the partitions it writes."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"OPTIONS ({_properties_sql({'partitionOverwriteMode': 'dynamic'})}) "
        f"PARTITIONED BY ({', '.join(partitions)}) TBLPROPERTIES ({_properties_sql(properties)})"
    )


def create_event_table(spark: SparkSession, database: str, network: str, t: EventTable) -> None:
    """Create both zones; a table that exists is left alone.

    Hot is partitioned by (processor, epoch, highest height of the epoch): replaying an epoch
    overwrites exactly its own rows, and settled epochs are found in the catalog and dropped whole.
    Cold is by (processor, month, move), where move is the cutoff of the move that wrote it.
    """
    contracts.require_contract({t.name: t.columns}, t.height, t.hash)
    hot, cold = t.zone(network, "hot"), t.zone(network, "cold")
    shared = {"key": ",".join(t.key), "height": t.height, "hash": t.hash}
    data = [(INGEST_SEQ, "bigint"), (PROCESSOR, "string")]
    create_partitioned(
        spark,
        f"{database}.{hot}",
        _columns_sql(t.schema, [*data, (EPOCH, "bigint"), (TOP, "bigint")]),
        [PROCESSOR, EPOCH, TOP],
        {"zone": "hot", **shared},
    )
    create_partitioned(
        spark,
        f"{database}.{cold}",
        _columns_sql(t.schema, [*data, (MONTH, "string"), (MOVE, "bigint")]),
        [PROCESSOR, MONTH, MOVE],
        {"zone": "cold", **shared},
    )


def create_snapshot_table(
    spark: SparkSession, database: str, network: str, t: SnapshotTable
) -> None:
    """One table, partitioned by generation so that compaction can replace older ones."""
    create_partitioned(
        spark,
        f"{database}.{t.table(network)}",
        _columns_sql(t.schema, [(INGEST_SEQ, "bigint"), (GENERATION, "bigint")]),
        [GENERATION],
        {"zone": "single", "key": ",".join(t.key), "version": ",".join(t.version)},
    )


def create_tables(
    spark: SparkSession,
    database: str,
    network: str,
    events: Sequence[EventTable] = (),
    snapshots: Sequence[SnapshotTable] = (),
    location: str | None = None,
) -> None:
    """Create the table set (T1); with ``location`` the database is put into that folder."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")
    for e in events:
        create_event_table(spark, database, network, e)
    for s in snapshots:
        create_snapshot_table(spark, database, network, s)


def _quoted(value: object) -> str:
    """A value as an SQL text literal."""
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spec(values: Mapping[str, object]) -> str:
    return "PARTITION (" + ", ".join(f"{k}={_quoted(v)}" for k, v in values.items()) + ")"


def partitions_of(spark: SparkSession, table: str, **fixed: object) -> list[dict[str, str]]:
    """Partition values in the catalog, without reading data; the listing writes special characters
    of values as % and two hex digits."""
    rows = spark.sql(f"SHOW PARTITIONS {table}" + (f" {_spec(fixed)}" if fixed else ""))
    parts = [dict(part.split("=", 1) for part in r[0].split("/")) for r in rows.collect()]
    return [{k: unquote(v) for k, v in p.items()} for p in parts]


def drop_partitions(spark: SparkSession, table: str, specs: Sequence[dict[str, object]]) -> None:
    """Drop whole partitions, by equality, in one statement; each must be there."""
    if specs:
        spark.sql(f"ALTER TABLE {table} DROP " + ", ".join(map(_spec, specs)))


def overwrite_partitions(df: DataFrame, table: str) -> None:
    """Write the partitions ``df`` has rows for, replacing their content; columns go by name.

    Needs the option set by ``create_partitioned``: see ``require_dynamic``.
    """
    df.select(*df.sparkSession.table(table).columns).write.mode("overwrite").insertInto(table)


def require_dynamic(spark: SparkSession, table: str) -> None:
    """Fail for a table whose overwrites would replace all of its partitions."""
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Storage Properties'")
    row = details.first()
    if row is None or "partitionOverwriteMode=dynamic" not in row["data_type"]:
        raise ValueError(f"{table} would be overwritten as a whole; create it with create_tables")


def append_rows(df: DataFrame, table: str) -> None:
    """Append, columns by name (T5)."""
    df.select(*df.sparkSession.table(table).columns).write.mode("append").insertInto(table)


def delete_where(spark: SparkSession, table: str, condition: Column) -> int:
    """Physically delete rows of a partitioned table (D-4); returns how many.

    Only partitions holding a matching row are touched: those without a survivor are dropped, the
    others rewritten. The list of partitions is driver state; rows never are.
    """
    rows = spark.table(table)
    by = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if not by:
        raise ValueError(f"{table} has no partitions to rewrite")
    doomed = F.coalesce(condition, F.lit(False))
    touched = (
        rows.groupBy(*by)
        .agg(F.count_if(doomed).alias("gone"), F.count_if(~doomed).alias("left_over"))
        .filter("gone > 0")
        .collect()
    )
    rewrite = [r for r in touched if r["left_over"]]
    if rewrite:
        chosen = F.lit(False)
        for r in rewrite:
            part = F.lit(True)
            for c in by:
                part = part & (F.col(c) == F.lit(r[c]))
            chosen = chosen | part
        require_dynamic(spark, table)
        overwrite_partitions(rows.filter(chosen & ~doomed), table)
    drop_partitions(spark, table, [{c: r[c] for c in by} for r in touched if not r["left_over"]])
    spark.catalog.refreshTable(table)
    return sum(r["gone"] for r in touched)


def _generation(spark: SparkSession, table: str) -> int:
    return max((int(p[GENERATION]) for p in partitions_of(spark, table)), default=0)


def upsert_snapshot(
    df: DataFrame, database: str, network: str, t: SnapshotTable, order: Column
) -> None:
    """Append new versions (T12); ``order`` breaks ties between equal versions."""
    spark = df.sparkSession
    name = f"{database}.{t.table(network)}"
    rows = df.select(*t.columns, order.cast("bigint").alias(INGEST_SEQ))
    append_rows(rows.withColumn(GENERATION, F.lit(_generation(spark, name))), name)


def _newest_versions(spark: SparkSession, name: str, t: SnapshotTable) -> DataFrame:
    rows = spark.table(name).drop(GENERATION)
    return latest_by_key(rows, t.key, [*t.version, INGEST_SEQ])


def read_snapshot(spark: SparkSession, database: str, network: str, t: SnapshotTable) -> DataFrame:
    """Newest version per key."""
    return _newest_versions(spark, f"{database}.{t.table(network)}", t).select(*t.columns)


def compact_snapshot(spark: SparkSession, database: str, network: str, t: SnapshotTable) -> None:
    """Rewrite the newest versions as a new generation, then drop the older ones.

    Stopping in between leaves both, which reads the same.
    """
    name = f"{database}.{t.table(network)}"
    old = partitions_of(spark, name)
    generation = _generation(spark, name) + 1
    overwrite_partitions(
        _newest_versions(spark, name, t).withColumn(GENERATION, F.lit(generation)), name
    )
    drop_partitions(spark, name, old)
