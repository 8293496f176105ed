"""A fork-aware store: two-zone event tables, registry, status and moves, kept in catalog tables.

Every epoch (one batch of the feed) does, in this order: rows, registry version, status row. The
status row is the commit point: readers use the epoch and registry version it names, so a crash
before it leaves nothing visible and replaying the batch overwrites the same partitions. A move
writes cold first and then appends one cold-status row, which is its commit point. One writer per
processor; any number of readers.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from forktide.functions import blocks, clock
from forktide.operators import chain, contracts, lookups, migration, oplog, state, visible
from forktide.operators.joins import keyed_join
from forktide.operators.versions import latest_by_key
from forktide.sources import tables as tb
from forktide.sources.rows import normalise_rows
from forktide.sources.tables import EPOCH, INGEST_SEQ, MONTH, MOVE, PROCESSOR, TOP
from forktide.streaming import registry_log
from forktide.streaming.registry_log import MissingVersion, RegistryLog, Span

Handler = Callable[[DataFrame], Mapping[str, DataFrame]]

ERA = 256
# Between the numbers of a partition's versions; beyond any height.
TURN = 1 << 40
REGISTRY = "valid_blocks"
BLOCKS = "cold_blocks"
OPS_LOG = "ops_log"
MOVED, COMPACTED = "move", "compact"
# Blocks of the hot chain that the status row repeats; all of them are in the registry.
CHAIN_TAIL = 256
LOG_COLUMNS = oplog.LOG_SCHEMA.replace("processor_id string, ", "") + ", processor_id string"


class FinalityError(RuntimeError):
    """A fork reaches into history that was already moved to cold."""


@dataclass(frozen=True)
class StoreOptions:
    """``stale_threshold_ms=None`` never clears on downtime; a depth of 0 means the default."""

    processor_id: str = "default"
    network: str = "ethereum"
    state_table: str = "processor_status"
    hot_blocks_depth: int = 10
    support_hot_blocks: bool = True
    auto_migrate: bool = True
    migration_interval: int = 30
    migration_on_finality: bool = False
    hooks: migration.MigrationHooks = field(default_factory=migration.MigrationHooks)
    stale_threshold_ms: int | None = 600_000
    trust_quick_restart: bool = True
    # Both True: cold holds canonical, finalized rows only. False is the plain copy at max - depth.
    drop_orphans: bool = True
    hold_to_finality: bool = True
    log_operations: bool = True
    parallel_writes: int = 4
    # Registry versions and months of cold stay this long after they were replaced, for readers that
    # began before.
    keep_versions_ms: int = 3_600_000
    # Changes of the registry that are read together before it is written as a whole again.
    registry_spans: int = 32
    persist_catch_up: bool = False

    @property
    def depth(self) -> int:
        return self.hot_blocks_depth or 10


@dataclass(frozen=True)
class Recovered:
    """What ``connect`` returns: where to resume, and the hot blocks on top of it, the newest
    ``CHAIN_TAIL`` if there are more; ``ForkStore.hot_chain`` has all."""

    height: int
    hash: str
    top: tuple[tuple[int, str], ...]
    finalized_height: int | None
    action: str = "keep"
    reason: str = ""


@dataclass(frozen=True)
class _State:
    epoch: int = 0
    height: int = -1
    hash: str = ""
    finalized_height: int = -1
    finalized_hash: str = ""
    registry_version: int = 0
    spans: tuple[Span, ...] = ()
    at_head: bool = False
    # Hot partitions that were written anew: table, epoch, top height, number of the one that counts.
    rewrites: tuple[tuple[str, int, int, int], ...] = ()
    blocks_since: int = 0
    progress: tuple[tuple[str, int], ...] = ()

    def done(self, source: str, batch_id: int) -> bool:
        return dict(self.progress).get(source, -1) >= batch_id

    def after(self, source: str, batch_id: int) -> tuple[tuple[str, int], ...]:
        return tuple(sorted({**dict(self.progress), source: batch_id}.items()))


class ForkStore:
    def __init__(
        self,
        spark: SparkSession,
        database: str,
        events: Sequence[tb.EventTable],
        snapshots: Sequence[tb.SnapshotTable] = (),
        options: StoreOptions | None = None,
        location: str | None = None,
    ) -> None:
        self.spark = spark
        self.database = database
        self.events = {t.name: t for t in events}
        self.snapshots = {t.name: t for t in snapshots}
        self.options = options or StoreOptions()
        self.location = location
        self._state = _State()
        self._cutoffs: dict[str, int] = {}
        # What a process that stopped may have left behind: rows of an epoch in hot, of a move in cold.
        self._unfinished_epoch = True
        self._unfinished_moves = set(self.events)
        self._replaced: dict[tuple[str, str, str], float] = {}
        self._ops: list[tuple] = []
        self._log_of_blocks = RegistryLog(spark, self._name(REGISTRY), self.processor, self.options.registry_spans)

    # ---- names -------------------------------------------------------------------------------

    @property
    def processor(self) -> str:
        return self.options.processor_id

    @property
    def head_height(self) -> int:
        """Height of the last block applied; -1 before the first."""
        return self._state.height

    def _name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def hot_name(self, table: str) -> str:
        return self._name(self.events[table].zone(self.options.network, "hot"))

    def cold_name(self, table: str) -> str:
        return self._name(self.events[table].zone(self.options.network, "cold"))

    @property
    def _status_name(self) -> str:
        return self._name(self.options.state_table)

    @property
    def _cold_status_name(self) -> str:
        return self._name(f"{self.options.state_table}_cold")

    # ---- creation and recovery -----------------------------------------------------------------

    def create(self) -> None:
        """Create whatever does not exist yet (T1 and the state tables)."""
        tb.create_tables(
            self.spark,
            self.database,
            self.options.network,
            list(self.events.values()),
            list(self.snapshots.values()),
            self.location,
        )
        self._log_of_blocks.create()
        status = (
            "height bigint, hash string, parent_hash string, hot_blocks string, "
            "finalized_height bigint, finalized_hash string, timestamp timestamp, "
            "last_run bigint, epoch bigint, registry_version bigint, registry_spans string, "
            "hot_rewrites string, at_head boolean, blocks_since bigint, progress string"
        )
        cold = (
            "height bigint, hash string, timestamp timestamp, tables array<string>, kind string, "
            "month string, part bigint, epoch bigint"
        )
        for name, columns, by in (
            (self._name(BLOCKS), "height bigint, hash string", f"{PROCESSOR} string, {MOVE} bigint"),
            (self._status_name, status, "id string, era bigint"),
            (self._cold_status_name, cold, "id string"),
            (self._name(OPS_LOG), LOG_COLUMNS.rsplit(", ", 1)[0], "processor_id string"),
        ):
            tb.create_partitioned(
                self.spark,
                name,
                f"{columns}, {by}",
                [c.split()[0] for c in by.split(", ")],
                {"zone": "state"},
            )

    def connect(self, now_ms: int | None = None) -> Recovered:
        """Create tables, check contracts, recover the last state, and clear stale hot blocks."""
        self.create()
        if self.options.auto_migrate and self.options.support_hot_blocks:
            self.check_contracts()
        self._load()
        now = F.lit(now_ms).cast("bigint") if now_ms is not None else clock.now_ms()
        known = self.spark.range(0, 1, 1, 1).select(F.lit(self.processor).alias("id"))
        recovered = state.recover_state(self._status_rows(), known)
        decided = state.stale_decision(
            recovered, now, self.options.stale_threshold_ms, self.options.trust_quick_restart
        )
        row = state.rolled_back_state(decided, self.cold_status()).first()
        if row["action"] == "clear":
            self.clear_hot(row["height"], row["hash"])
        self._log("connection", ok=True)
        self._flush_log()
        return Recovered(
            row["height"],
            row["hash"],
            tuple((b["height"], b["hash"]) for b in row["top"]),
            row["finalized_height"],
            row["action"],
            row["reason"],
        )

    def check_contracts(self) -> None:
        """Existing hot tables must have their height and hash columns."""
        problems = []
        for t in self.events.values():
            columns = {self.hot_name(t.name): self.spark.table(self.hot_name(t.name)).columns}
            problems += contracts.schema_problems(columns, t.height, t.hash)
        if problems:
            raise contracts.ContractError("\n  ".join(["event tables break their contract:", *problems]))

    def _status_rows(self) -> DataFrame:
        """Status rows of the newest eras; older eras are dropped once a new one has a row."""
        self.spark.catalog.refreshTable(self._status_name)
        eras = [int(p["era"]) for p in tb.partitions_of(self.spark, self._status_name, id=self.processor)]
        newest = max(eras, default=0)
        return self.spark.table(self._status_name).filter(
            (F.col("id") == self.processor) & (F.col("era") >= newest - 1)
        )

    def _read_state(self, registry_version: int | None = None) -> _State:
        """The committed state, or that of the last epoch that had a registry version."""
        rows = self._status_rows()
        if registry_version is not None:
            rows = rows.filter(F.col("registry_version") == registry_version)
        row = rows.agg(
            F.max_by(
                F.struct(
                    "epoch", "height", "hash", "finalized_height", "finalized_hash",
                    "registry_version", "registry_spans", "hot_rewrites", "at_head", "blocks_since", "progress",
                ),
                "epoch",
            ).alias("s")
        ).first()["s"]
        if row is None:
            if registry_version:
                raise MissingVersion(f"registry version {registry_version} of {self.processor} is not there")
            return _State()
        values = row.asDict()
        values["spans"] = registry_log.from_text(values.pop("registry_spans"))
        values["rewrites"] = tuple(tuple(r) for r in json.loads(values.pop("hot_rewrites")))
        values["progress"] = tuple(sorted(json.loads(values["progress"]).items()))
        return _State(**values)

    def _commits(self) -> DataFrame:
        self.spark.catalog.refreshTable(self._cold_status_name)
        return self.spark.table(self._cold_status_name).filter(F.col("id") == self.processor)

    def cold_status(self) -> DataFrame:
        """Height up to which every table is in cold (R12): id, height, hash.

        That is the lowest of the tables' newest commits; a table may lag behind after a failed move.
        Tables without any commit, such as new ones, do not count.
        """
        moves = self._commits().filter(F.col("kind") == MOVED)
        each = moves.select("id", "height", "hash", "epoch", "timestamp", F.explode("tables").alias("t"))
        if self.events:
            each = each.filter(F.col("t").isin(list(self.events)))
        newest = latest_by_key(each, ["id", "t"], ["height", "epoch", "timestamp"])
        return newest.groupBy("id").agg(
            F.min("height").alias("height"), F.min_by("hash", F.struct("height", "t")).alias("hash")
        )

    def _read_commits(self) -> tuple[dict[str, int], dict[tuple[str, str], tuple[int, int]]]:
        """Committed cutoff per table (-1 before the first move), and months written anew: the height
        they reach and the number of the partition that holds them."""
        found = (
            self._commits()
            .select("kind", "month", "height", "part", F.explode("tables").alias("t"))
            .groupBy("kind", "month", "t")
            .agg(F.max(F.struct("height", "part")).alias("last"))
            .select("kind", "month", "t", "last.height", "last.part")
            .collect()
        )
        moved = {r["t"]: r["height"] for r in found if r["kind"] == MOVED}
        compacted = {(r["t"], r["month"]): (r["height"], r["part"]) for r in found if r["kind"] == COMPACTED}
        return {t: moved.get(t, -1) for t in self.events}, compacted

    def _load(self) -> None:
        self._state = self._read_state()
        self._cutoffs, _ = self._read_commits()
        named = {span.version for span in self._state.spans}
        self._log_of_blocks.outdate([v for v in self._log_of_blocks.versions() if v not in named])

    def _lowest_cutoff(self) -> int:
        return min(self._cutoffs.values(), default=-1)

    def _highest_cutoff(self) -> int:
        return max(self._cutoffs.values(), default=-1)

    # ---- registry ------------------------------------------------------------------------------

    def registry(self, version: int | None = None) -> DataFrame:
        """Registered blocks ``(processor_id, height, hash, timestamp)`` of the committed version, or of an
        older one (R8); ``MissingVersion`` if it was dropped or never committed."""
        return self._log_of_blocks.read(self._read_state(version).spans)

    def hot_chain(self) -> DataFrame:
        """Registered blocks above the finalized height, however many there are."""
        s = self._read_state()
        return self._log_of_blocks.read(s.spans, s.finalized_height + 1)

    def _publish_registry(
        self, s: _State, version: int, rows: DataFrame, below: int | None = None, from_: int | None = None
    ) -> tuple[tuple[Span, ...], str | None]:
        """Write the blocks of an epoch; returns the manifest to commit and the hash of the tip written."""
        return self._log_of_blocks.publish(version, s.spans, rows, below, from_)

    def registry_bounds(self) -> DataFrame:
        """Highest, lowest and number of registered heights, and the finality threshold."""
        known = self.spark.range(0, 1, 1, 1).select(F.lit(self.processor).alias(PROCESSOR))
        found = chain.bounds(self.registry(), known)
        return found.withColumn(
            "threshold", blocks.threshold(F.col("highest"), self.options.depth)
        )

    def is_valid_block(self, height: int, hash: str) -> bool:
        hit = self.registry().filter((F.col("height") == height) & (F.col("hash") == hash))
        return not hit.isEmpty()

    def valid_filter(self, rows: DataFrame, current_height: int, height: str = "height",
                     hash: str = "hash") -> DataFrame:
        """Rows at or below ``current_height - depth``, and registered ones above (P3 as it is)."""
        cut = current_height - self.options.depth
        s = self._read_state()
        above = self._log_of_blocks.read(s.spans, cut + 1).drop(PROCESSOR)
        return visible.valid_rows(
            rows, above, F.lit(cut), max_blocks=max(s.height - cut, 0), height=height, hash=hash
        )

    # ---- reading -------------------------------------------------------------------------------

    def visible(
        self, table: str, height_from: int | None = None, height_to: int | None = None
    ) -> DataFrame:
        """The table as of the last commit, every valid row once.

        Cold up to the committed cutoff, hot above it where the block is registered. With a height
        range a zone that cannot contribute is not scanned. The commit is looked up when this is
        called: call it anew for each query instead of keeping the DataFrame over later moves.
        """
        t = self.events[table]
        s = self._read_state()
        cutoffs, compacted = self._read_commits()
        cutoff = cutoffs[table]
        hot = self._committed_hot(t, s, cutoff).filter(F.col(t.height) > cutoff)
        blocks_above = self._log_of_blocks.read(s.spans, cutoff + 1)
        hot = visible.registered_rows(
            hot,
            blocks_above.drop(PROCESSOR),
            max_blocks=max(s.height - cutoff, 0),
            height=t.height,
            hash=t.hash,
            salt_by=t.key,
        )
        if t.key:
            hot = latest_by_key(hot, t.key, [EPOCH, INGEST_SEQ])
        cold = self._committed_cold(t, cutoff, compacted)
        if height_from is not None:
            # A move holds heights up to its number, so older moves are pruned as partitions.
            cold = cold.filter((F.col(MOVE) < 0) | (F.col(MOVE) >= height_from))
        return visible.zone_union(
            cold.select(*t.columns),
            hot.select(*t.columns),
            cutoff,
            height_from,
            height_to,
            t.height,
        )

    def _committed_hot(self, t: tb.EventTable, s: _State, above: int = -1) -> DataFrame:
        """Hot partitions that are committed and reach above a height: a static partition filter.

        A partition written anew has a negative number and counts once the status row names it,
        instead of the one it replaces.
        """
        name = self.hot_name(t.name)
        self.spark.catalog.refreshTable(name)
        chosen = F.col(TOP) > above
        for table, epoch, top, part in s.rewrites:
            if table == t.name and top > above:
                own = F.col(EPOCH) == epoch
                chosen = (chosen & ~(own & (F.col(TOP) == top))) | (own & (F.col(TOP) == -part))
        return self.spark.table(name).filter((F.col(PROCESSOR) == self.processor) & (F.col(EPOCH) <= s.epoch) & chosen)

    def _committed_cold(
        self, t: tb.EventTable, cutoff: int, compacted: Mapping[tuple[str, str], tuple[int, int]]
    ) -> DataFrame:
        """Cold partitions that are committed: a static partition filter.

        A move drops uncommitted leftovers above the last cutoff before it writes, so every
        partition up to the committed cutoff is committed. Compacted moves have a negative number.
        """
        name = self.cold_name(t.name)
        self.spark.catalog.refreshTable(name)
        month, move = F.col(MONTH), F.col(MOVE)
        done = {m: last for (table, m), last in compacted.items() if table == t.name}
        chosen = (move >= 0) & (move <= cutoff)
        if done:
            chosen = chosen & ~month.isin(list(done))
        for m, (upto, part) in done.items():
            newer = (move == -part) | ((move > upto) & (move <= cutoff))
            chosen = chosen | ((month == m) & newer)
        return self.spark.table(name).filter((F.col(PROCESSOR) == self.processor) & chosen)

    def snapshot(self, table: str) -> DataFrame:
        return tb.read_snapshot(
            self.spark, self.database, self.options.network, self.snapshots[table]
        )

    def operations(self) -> DataFrame:
        self.spark.catalog.refreshTable(self._name(OPS_LOG))
        return self.spark.table(self._name(OPS_LOG))

    # ---- one batch of the feed -------------------------------------------------------------------

    def apply(self, batch: DataFrame, handler: Handler, source: str, batch_id: int) -> None:
        """Route a batch by its ``is_head`` column (T7): final rows first, then rows at the head."""
        if self._state.done(source, batch_id):
            return
        if "is_head" not in batch.columns:
            self.apply_hot(batch, handler, source, batch_id)
            return
        n = batch.agg(
            F.count_if("is_head").alias("hot"), F.count_if(~F.col("is_head")).alias("final")
        ).first()
        if n["final"]:
            # Until the head part is done as well, the batch counts as not applied.
            marker = batch_id if not n["hot"] else batch_id - 1
            self._apply_final(batch.filter(~F.col("is_head")), handler, source, marker)
        if n["hot"]:
            self.apply_hot(batch.filter("is_head"), handler, source, batch_id)

    def close(self) -> None:
        """Write out operations not yet logged, such as those of a last migration."""
        self._flush_log()

    def apply_final(
        self, batch: DataFrame, handler: Handler, source: str, batch_id: int
    ) -> None:
        """Finalized blocks while catching up (R1): straight to cold, status and cold status.

        ``batch`` has height, hash and seq, and is not expected to contain forks. Rows at or below a
        table's cutoff are already there and skipped, so a replay changes nothing. Each table reads
        what it needs of the batch; set ``persist_catch_up`` for sources that are costly to re-read.
        """
        if not self._state.done(source, batch_id):
            self._apply_final(batch, handler, source, batch_id)

    def _apply_final(
        self, batch: DataFrame, handler: Handler, source: str, batch_id: int
    ) -> None:
        self._use_adaptive(batch)
        if self.options.persist_catch_up:
            batch = batch.persist()
        try:
            head = self._heads(self._delivered(batch).withColumn("_known", F.lit(None)))
            if head["n_blocks"] == 0:
                return
            top, top_hash = head["top"], head["top_hash"]
            if self._state.height > self._lowest_cutoff() and self._hot_partitions():
                self._drain(head["low"] - 1)
            s = self._state
            epoch = s.epoch + 1
            self._drop_epoch(epoch)

            def to_cold(t: tb.EventTable, rows: DataFrame) -> None:
                fresh = rows.filter(F.col(t.height) > self._cutoffs[t.name])
                if t.key:
                    fresh = latest_by_key(fresh, t.key, [INGEST_SEQ])
                self._stage_cold(t, fresh, top)

            def to_registry() -> tuple[tuple[Span, ...], str | None]:
                tip = self.spark.range(0, 1, 1, 1).select(
                    F.lit(top).cast("bigint").alias("height"),
                    F.lit(top_hash).alias("hash"),
                    F.current_timestamp().alias("timestamp"),
                )
                below = F.col("height") > self._lowest_cutoff()
                self._index_blocks(batch.filter(below).groupBy("height").agg(F.min("hash").alias("hash")), top)
                return self._publish_registry(s, epoch, tip, from_=top + 1)

            advances = top > self._lowest_cutoff()
            published = self._write_all(
                handler(batch), epoch, to_cold, to_registry if advances else None
            )
            spans = published[0] if published else s.spans
            tip = registry_log.tip(spans)
            if advances:
                behind = [n for n in self.events if self._cutoffs[n] < top]
                self._commit_cold(top, top_hash, behind, epoch)
            final = top >= s.finalized_height
            self._log("blocks", ok=True, finalized=True, amount=head["n_blocks"], height=top)
            self._save(
                replace(
                    s,
                    epoch=epoch,
                    # Hot blocks above the batch stay the tip.
                    height=tip if advances else s.height,
                    hash=top_hash if advances and tip == top else s.hash,
                    finalized_height=top if final else s.finalized_height,
                    finalized_hash=top_hash if final else s.finalized_hash,
                    registry_version=epoch if advances else s.registry_version,
                    spans=spans,
                    at_head=False,
                    progress=s.after(source, batch_id),
                ),
                head["parent"],
            )
            self._log_of_blocks.drop_outdated(self._state.spans, self.options.keep_versions_ms)
        finally:
            if self.options.persist_catch_up:
                batch.unpersist()

    def apply_hot(self, batch: DataFrame, handler: Handler, source: str, batch_id: int) -> None:
        """Blocks at the head of the feed (R2, R3): the handler runs once for the whole batch.

        ``batch`` has one or more rows per delivered block with height, hash, seq (delivery number)
        and optionally parent, finalized_height, finalized_hash and base_height. Deliveries that
        repeat registered blocks at the start of the batch change nothing.
        """
        if self._state.done(source, batch_id):
            return
        self._use_adaptive(batch)
        batch = batch.persist()
        try:
            s = self._state
            registry = self._log_of_blocks.read(s.spans)
            lowest = self._lowest_cutoff()
            delivered = self._delivered(batch)
            known = registry.select("height", "hash", F.lit(True).alias("_known"))
            span = s.height - lowest + 1
            head = self._heads(
                keyed_join(delivered, known, ["height", "hash"], "left", max_rows=span)
            )
            finalized, finalized_hash = s.finalized_height, s.finalized_hash
            if head["finalized"] is not None and head["finalized"] > finalized:
                finalized, finalized_hash = head["finalized"], head["finalized_hash"] or ""
            ahead = replace(
                s,
                epoch=s.epoch + 1,
                finalized_height=finalized,
                finalized_hash=finalized_hash,
                at_head=True,
                progress=s.after(source, batch_id),
            )
            if head["n_blocks"] == 0:
                self._drop_epoch(ahead.epoch)
                self._save(ahead, None)
                return
            fork_height = head["low"]
            if head["base"] is not None:
                # A step may name a base below the finalized height; what is final stays.
                fork_height = min(fork_height, max(head["base"], s.finalized_height) + 1)
            # A table that moved further holds known blocks up to its own cutoff in cold; blocks that
            # come again after a clear replace none and are only new for the tables that lag.
            fixed = self._highest_cutoff() if s.height >= fork_height else lowest
            if fork_height <= fixed:
                raise FinalityError(f"fork at {fork_height} reaches below the committed cutoff {fixed}")
            if fork_height <= s.finalized_height and s.height >= fork_height:
                raise FinalityError(
                    f"fork at {fork_height} reaches below the finalized height {s.finalized_height}"
                )
            tip = s.height if s.height > lowest else None
            if chain.fork_detected(tip, fork_height):
                lost = self._log_of_blocks.read(s.spans, fork_height).count()
                self._log("fork_detected", ok=True, height=fork_height)
                self._log("fork_executed", ok=True, height=fork_height - 1, amount=lost)
            elif tip is not None and fork_height > tip + 1:
                self._log("gap", ok=True, height=fork_height, amount=fork_height - tip - 1)
            elif tip is not None and head["low_parent"] not in (None, s.hash):
                self._log("parent_mismatch", ok=False, height=fork_height)
            new = F.col("height") >= head["low"]
            winners = chain.canonical_chain(
                delivered.filter(new).withColumn(PROCESSOR, F.lit(self.processor))
            ).withColumn("timestamp", F.current_timestamp())

            def to_hot(t: tb.EventTable, rows: DataFrame) -> None:
                placed = rows.withColumn(TOP, F.lit(head["top"]).cast("bigint"))
                tb.overwrite_partitions(
                    placed.sortWithinPartitions(PROCESSOR, EPOCH, TOP, *t.write_order()),
                    self.hot_name(t.name),
                )

            self._drop_epoch(ahead.epoch)
            self._unfinished_epoch = True
            published = self._write_all(
                handler(batch.filter(new)),
                ahead.epoch,
                to_hot,
                lambda: self._publish_registry(s, ahead.epoch, winners, below=fork_height, from_=lowest),
            )
            self._log(
                "blocks", ok=True, finalized=False, amount=head["n_blocks"], height=head["top"]
            )
            self._save(
                replace(
                    ahead,
                    height=registry_log.tip(published[0]),
                    hash=published[1],
                    registry_version=ahead.epoch,
                    spans=published[0],
                    blocks_since=s.blocks_since + head["n_blocks"],
                ),
                head["parent"],
            )
            self._log_of_blocks.drop_outdated(self._state.spans, self.options.keep_versions_ms)
            if migration.should_migrate(
                self.options.auto_migrate,
                True,
                self.options.migration_on_finality,
                s.finalized_height,
                finalized,
                self._state.blocks_since,
                self.options.migration_interval,
            ):
                self.perform_migration()
        finally:
            batch.unpersist()

    @staticmethod
    def _delivered(batch: DataFrame) -> DataFrame:
        """One row per delivered block of a batch, with what the feed says about its step."""

        def optional(name: str, kind: str) -> Column:
            c = F.col(name) if name in batch.columns else F.lit(None)
            return c.cast(kind)

        announced = optional("finalized_height", "bigint")
        return batch.groupBy("seq", "height", "hash").agg(
            F.max(optional("parent", "string")).alias("parent"),
            F.min(optional("base_height", "bigint")).alias("base"),
            F.max(announced).alias("finalized"),
            F.max_by(optional("finalized_hash", "string"), announced).alias("finalized_hash"),
        )

    @staticmethod
    def _heads(delivered: DataFrame) -> dict:
        """The few scalars an epoch needs, from one aggregate; ``_known`` marks registered blocks.

        Finality counts from every delivery, also from one that repeats a known block.
        """
        new = F.col("_known").isNull()
        row = delivered.agg(
            F.count_if(new).alias("n_blocks"),
            F.min(F.when(new, F.col("height"))).alias("low"),
            F.max("height").alias("top"),
            F.max_by("hash", "height").alias("top_hash"),
            F.max_by("parent", "seq").alias("parent"),
            F.min_by("parent", F.when(new, F.struct("height", "seq"))).alias("low_parent"),
            F.min(F.when(new, F.col("base"))).alias("base"),
            F.max("finalized").alias("finalized"),
            F.max_by("finalized_hash", "finalized").alias("finalized_hash"),
        ).first()
        return row.asDict()

    def _write_all(
        self,
        outputs: Mapping[str, DataFrame],
        epoch: int,
        write: Callable[[tb.EventTable, DataFrame], None],
        publish: Callable[[], tuple[tuple[Span, ...], str | None]] | None = None,
    ) -> tuple[tuple[Span, ...], str | None] | None:
        """Write the tables of one batch, several at a time (T6); any failure fails the epoch.

        The registry change is published alongside, and what that returns is returned.
        """

        def one(name: str, rows: DataFrame) -> tuple[str, int]:
            started = time.time()
            if name in self.snapshots:
                self._write_snapshot(name, rows, epoch)
            else:
                t = self.events[name]
                write(t, self._prepared(t, rows, epoch))
            return name, _ms(started)

        with ThreadPoolExecutor(max_workers=self.options.parallel_writes) as pool:
            change = pool.submit(publish) if publish is not None else None
            done = [pool.submit(one, name, rows) for name, rows in outputs.items()]
            for future in done:
                name, took = future.result()
                self._log("insert", ok=True, duration_ms=took, table=name)
            return change.result() if change is not None else None

    @staticmethod
    def _use_adaptive(batch: DataFrame) -> None:
        """Streams switch adaptive execution off for their session; batch writes want it on."""
        if batch.sparkSession.conf.get("spark.sql.adaptive.enabled") != "true":
            batch.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")

    def _prepared(self, t: tb.EventTable, rows: DataFrame, epoch: int) -> DataFrame:
        """Normalised rows with their write order and processor."""
        seq = F.col("seq") if "seq" in rows.columns else F.lit(epoch)
        kept = rows.select(*t.columns, seq.cast("bigint").alias(INGEST_SEQ))
        return (
            normalise_rows(kept, t.hex_fields, t.u256)
            .withColumn(PROCESSOR, F.lit(self.processor))
            .withColumn(EPOCH, F.lit(epoch).cast("bigint"))
        )

    def _write_snapshot(self, name: str, rows: DataFrame, epoch: int) -> None:
        order = F.col("seq") if "seq" in rows.columns else F.lit(epoch)
        t = self.snapshots[name]
        kept = rows.select(*t.columns, order.alias("seq"))
        tb.upsert_snapshot(kept, self.database, self.options.network, t, F.col("seq"))

    def _stage_cold(
        self, t: tb.EventTable, rows: DataFrame, move: int, many_files: bool = False
    ) -> None:
        """Write one move's cold partitions; leftovers of moves that never committed go first.

        Rows of a keyed table come out of its aggregate in well-sized partitions. Others are written
        as they were read, rebalanced only where that would leave ``many_files`` small ones.
        """
        name = self.cold_name(t.name)
        if t.name in self._unfinished_moves:
            leftovers = [
                p
                for p in tb.partitions_of(self.spark, name, processor_id=self.processor)
                if int(p[MOVE]) > self._cutoffs[t.name]
            ]
            tb.drop_partitions(self.spark, name, leftovers)
        self._unfinished_moves.add(t.name)
        placed = rows.withColumn(MONTH, t.month()).withColumn(MOVE, F.lit(move).cast("bigint"))
        if many_files and not t.key:
            placed = placed.hint("rebalance", MONTH)
        tb.overwrite_partitions(
            placed.sortWithinPartitions(PROCESSOR, MONTH, MOVE, *t.write_order()), name
        )

    def _commit_cold(
        self, height: int, hash: str, names: Sequence[str], epoch: int, month: str | None = None,
        part: int | None = None,
    ) -> None:
        """Append a cold-status row (R12): the commit point of a move, or of a month's compaction."""
        row = {
            "height": F.lit(height).cast("bigint"),
            "hash": F.lit(hash),
            "timestamp": F.current_timestamp(),
            "tables": F.array(*[F.lit(n) for n in names]),
            "kind": F.lit(MOVED if month is None else COMPACTED),
            "month": F.lit(month).cast("string"),
            "part": F.lit(part).cast("bigint"),
            "epoch": F.lit(epoch).cast("bigint"),
            "id": F.lit(self.processor),
        }
        self._append_row(row, self._cold_status_name)
        if month is None:
            self._cutoffs.update({n: max(height, self._cutoffs.get(n, -1)) for n in names})
            self._unfinished_moves.difference_update(names)

    def _save(self, new: _State, parent: str | None) -> None:
        """Append the status row (R11): the commit point of the epoch.

        The cell ``hot_blocks`` has the newest ``CHAIN_TAIL`` unfinalized blocks of the registry, so no
        row grows while finality is silent. The operations logged so far go out at the same time;
        they are not part of the commit.
        """
        now = int(time.time() * 1000)
        era = new.epoch // ERA
        # What lies below every cutoff is read from cold.
        new = replace(new, rewrites=tuple(r for r in new.rewrites if r[2] > self._lowest_cutoff()))
        from_ = max(new.finalized_height, new.height - CHAIN_TAIL) + 1
        tail = F.array_sort(F.collect_list(F.struct("height", "hash")))
        hot_chain = self._log_of_blocks.read(new.spans, from_).agg(blocks.blocks_json(tail).alias("hot_blocks"))
        row = hot_chain.select(
            F.lit(new.height).cast("bigint").alias("height"),
            F.lit(new.hash).alias("hash"),
            F.lit(parent or "").alias("parent_hash"),
            "hot_blocks",
            F.lit(new.finalized_height).cast("bigint").alias("finalized_height"),
            F.lit(new.finalized_hash).alias("finalized_hash"),
            F.timestamp_millis(F.lit(now)).alias("timestamp"),
            F.lit(now).cast("bigint").alias("last_run"),
            F.lit(new.epoch).cast("bigint").alias("epoch"),
            F.lit(new.registry_version).cast("bigint").alias("registry_version"),
            F.lit(registry_log.to_text(new.spans)).alias("registry_spans"),
            F.lit(json.dumps(new.rewrites)).alias("hot_rewrites"),
            F.lit(new.at_head).alias("at_head"),
            F.lit(new.blocks_since).cast("bigint").alias("blocks_since"),
            F.lit(json.dumps(dict(new.progress))).alias("progress"),
            F.lit(self.processor).alias("id"),
            F.lit(era).cast("bigint").alias("era"),
        )
        self._log("status", ok=True, height=new.height)
        with ThreadPoolExecutor(max_workers=2) as pool:
            saved = pool.submit(tb.append_rows, row, self._status_name)
            logged = pool.submit(self._flush_log)
            saved.result()
            logged.result()
        if new.epoch % ERA == 0:
            old = [
                p
                for p in tb.partitions_of(self.spark, self._status_name, id=self.processor)
                if int(p["era"]) < era - 1
            ]
            tb.drop_partitions(self.spark, self._status_name, old)
        self._state = new
        self._unfinished_epoch = False

    def _append_row(self, row: Mapping[str, Column], table: str) -> None:
        tb.append_rows(self.spark.range(0, 1, 1, 1).select(*[c.alias(n) for n, c in row.items()]), table)

    def _hot_partitions(self) -> list[tuple[str, dict[str, str]]]:
        return [
            (name, p)
            for name in map(self.hot_name, self.events)
            for p in tb.partitions_of(self.spark, name, processor_id=self.processor)
        ]

    def _drop_epoch(self, epoch: int) -> None:
        """Rows of an epoch that was started before but never committed."""
        if not self._unfinished_epoch:
            return
        for name in map(self.hot_name, self.events):
            stale = [
                p
                for p in tb.partitions_of(self.spark, name, processor_id=self.processor)
                if int(p[EPOCH]) >= epoch
            ]
            tb.drop_partitions(self.spark, name, stale)

    # ---- migration -----------------------------------------------------------------------------

    def perform_migration(self) -> migration.MigrationResult | None:
        """One triggered migration with its hooks (M2); None when the before-hook cancels it."""
        hooks = self.options.hooks
        if hooks.before_migration is not None:
            context = migration.MigrationContext(
                self._state.height,
                self._state.finalized_height,
                self.hot_rows(),
                self._state.blocks_since,
                True,
            )
            if not hooks.before_migration(context):
                return None
        run = hooks.custom_migration or ForkStore.migrate
        result = run(self)
        if hooks.after_migration is not None:
            hooks.after_migration(result)
        if not result.failed:  # else the next batch tries again
            self._state = replace(self._state, blocks_since=0)
        return result

    def hot_rows(self) -> int:
        """Rows in the first hot table, settled ones not yet reclaimed included."""
        for t in self.events.values():
            return self._committed_hot(t, self._state).count()
        return 0

    def migrate(self, cutoff: int | None = None) -> migration.MigrationResult:
        """Move settled rows of every table from hot to cold (M3 - M7); nothing while catching up, when
        rows go to cold by themselves.

        Per table: stage cold partitions, then one commit row for all tables that were staged, then
        reclaim hot. A failing table keeps its own cutoff and its rows stay visible in hot.
        """
        if not self._state.at_head:
            return migration.MigrationResult(0, -1, 0)
        return self._migrate(cutoff)

    def _migrate(self, cutoff: int | None) -> migration.MigrationResult:
        started = time.time()
        s = self._state
        if cutoff is None:
            cutoff = s.height - self.options.depth
            if self.options.hold_to_finality:
                cutoff = min(cutoff, s.finalized_height)
        if not self.events or s.height <= 0:
            return migration.MigrationResult(0, -1, _ms(started))
        if cutoff <= self._lowest_cutoff():
            return migration.MigrationResult(0, cutoff, _ms(started))
        registry = self._log_of_blocks.read(s.spans, self._lowest_cutoff() + 1)
        moves, failed = [], []
        for t in self.events.values():
            if self._cutoffs[t.name] >= cutoff:
                continue
            try:
                moves.append(self._move_table(t, registry, cutoff))
            except Exception as error:  # noqa: BLE001 - one table must not stop the others
                failed.append((t.name, str(error)))
                self._log("migrate", ok=False, table=t.name, height=cutoff)
        if moves:
            previous = self._lowest_cutoff()
            known = self.hash_for_height(cutoff)
            if known is None:  # no block at this height was delivered or kept
                self._log("unknown_hash", ok=False, height=cutoff)
            self._index_blocks(registry.filter(F.col("height") <= cutoff), cutoff)
            self._commit_cold(cutoff, known or "", [m.name for m in moves], s.epoch)
            self._reclaim(previous)
        for m in moves:
            self._log("migrate", ok=True, table=m.name, height=cutoff, rows_in=m.rows_in, rows_out=m.rows_out)
        return migration.MigrationResult(
            sum(m.rows_in for m in moves), cutoff, _ms(started), tuple(moves), tuple(failed)
        )

    def _move_table(self, t: tb.EventTable, registry: DataFrame, cutoff: int) -> migration.TableMove:
        last = self._cutoffs[t.name]
        hot = self._committed_hot(t, self._state, last)
        moving = migration.rows_to_move(
            hot,
            last,
            cutoff,
            registry.drop(PROCESSOR) if self.options.drop_orphans else None,
            t.key,
            [EPOCH, INGEST_SEQ],
            max_blocks=cutoff - last,
            height=t.height,
            hash=t.hash,
            salt_by=t.key,
        )
        seen, written = Observation(), Observation()
        rows = moving.observe(seen, F.count(F.lit(1)).alias("n"))
        if self.options.hooks.transform_rows is not None:
            context = migration.TransformContext(
                self.spark, t.name, self.hot_name(t.name), self.cold_name(t.name), cutoff,
                self.options.network,
            )
            kept = self.options.hooks.transform_rows(rows, context)
            for column, value in ((INGEST_SEQ, F.lit(0)), (PROCESSOR, F.lit(self.processor))):
                if column not in kept.columns:
                    kept = kept.withColumn(column, value)
            rows = kept.observe(written, F.count(F.lit(1)).alias("n"))
            self._stage_cold(t, rows, cutoff, many_files=True)
            n_in, n_out = _observed(seen), _observed(written)
            return migration.TableMove(
                t.name, moving.count() if n_in is None else n_in["n"], n_out["n"] if n_out else 0
            )
        self._stage_cold(t, rows, cutoff, many_files=True)
        counted = _observed(seen)
        n = counted["n"] if counted else 0
        return migration.TableMove(t.name, n, n)

    def _reclaim(self, settled: int) -> None:
        """Drop hot epochs that lie at or below the cutoff before the one just committed.

        Readers that started before the commit still find the epochs of the newest move.
        """
        for name in map(self.hot_name, self.events):
            gone = [
                p
                for p in tb.partitions_of(self.spark, name, processor_id=self.processor)
                if _real_top(int(p[TOP])) <= settled
            ]
            tb.drop_partitions(self.spark, name, gone)

    def _drain(self, upto: int) -> None:
        """Falling back to catching up: hot rows below the final batch go to cold first."""
        if upto > self._lowest_cutoff():
            result = self._migrate(upto)
            if result.failed:
                raise RuntimeError(f"hot rows could not be moved: {result.failed}")

    def _index_blocks(self, rows: DataFrame, move: int) -> None:
        """Keep the blocks that a move settles, one partition per move, before they leave the registry."""
        placed = rows.select("height", "hash", F.lit(self.processor).alias(PROCESSOR), F.lit(move).cast("bigint").alias(MOVE))
        tb.overwrite_partitions(placed.sortWithinPartitions(PROCESSOR, MOVE, "height"), self._name(BLOCKS))

    def _indexed_hash(self, height: int) -> str | None:
        """Hash of a settled block: in the partition of the first committed move that reached its height."""
        first = self._commits().filter((F.col("kind") == MOVED) & (F.col("height") >= height)).agg(F.min("height")).first()[0]
        if first is None:
            return None
        self.spark.catalog.refreshTable(self._name(BLOCKS))
        own = (F.col(PROCESSOR) == self.processor) & (F.col(MOVE) == first) & (F.col("height") == height)
        return self.spark.table(self._name(BLOCKS)).filter(own).agg(F.min("hash")).first()[0]

    def hash_for_height(self, height: int) -> str | None:
        """Hash of the block at a height (J4): from the registry or the index of settled blocks; only a
        height that neither knows is looked for in the rows of cold and hot."""
        at = self._log_of_blocks.read(registry_log.cut(self._state.spans, height + 1, height)).filter(F.col("height") == height)
        known = at.agg(F.min("hash")).first()[0]
        if known is None and height <= self._highest_cutoff():
            known = self._indexed_hash(height)
        if known is not None or not self.events:
            return known
        t = next(iter(self.events.values()))

        def stored(rows: DataFrame) -> DataFrame:
            return rows.filter(F.col(t.height) == height).select(
                F.col(t.height).alias("height"), F.col(t.hash).alias("hash")
            )

        found = lookups.hash_by_height(
            at.limit(0),
            at,
            stored(self._committed_cold(t, self._cutoffs[t.name], self._read_commits()[1])),
            stored(self._committed_hot(t, self._state)),
        ).first()
        return None if found is None else found["hash"]

    def compact_cold(self, table: str, month: str) -> int | None:
        """Merge the committed moves of one month into one; returns the height it reaches.

        The merged partition has a negative number, which readers ignore until the commit row naming it
        is there; the merged parts are dropped by a compaction ``keep_versions_ms`` later.
        """
        done = self._read_commits()[1].get((table, month))
        return self._rewrite_month(table, month) or (done[0] if done else None)

    def _rewrite_month(self, table: str, month: str, keep: Column | None = None) -> int | None:
        """One new partition for a month of cold, of the rows under ``keep``; None if nothing is new."""
        t = self.events[table]
        cutoff = self._cutoffs[table]
        name = self.cold_name(table)
        parts = [
            p
            for p in tb.partitions_of(self.spark, name, processor_id=self.processor)
            if p[MONTH] == month
        ]
        compacted = self._read_commits()[1]
        done, part = compacted.get((table, month), (0, 0))
        moves = [int(p[MOVE]) for p in parts]
        fresh = [m for m in moves if done < m <= cutoff]
        if cutoff <= 0 or not (fresh or (keep is not None and part)):
            return None
        upto = max(fresh, default=done)
        live = [m for m in moves if m == -part or m in fresh]
        self._drop_replaced(table, [p for p in parts if int(p[MOVE]) not in live and int(p[MOVE]) <= cutoff])
        # A number of its own: the height it reaches, and how often it was written since.
        new = upto if fresh else part + TURN
        rows = self._committed_cold(t, cutoff, compacted).filter(F.col(MONTH) == month)
        if keep is not None:
            rows = rows.filter(keep)
        merged = rows.withColumn(MOVE, F.lit(-new).cast("bigint"))
        tb.overwrite_partitions(
            merged.hint("rebalance", MONTH).sortWithinPartitions(*t.write_order()), name
        )
        self._commit_cold(upto, "", [table], self._state.epoch, month, new)
        self._drop_replaced(table, [p for p in parts if int(p[MOVE]) in live])
        return upto

    def _drop_replaced(self, table: str, parts: Sequence[dict[str, str]]) -> None:
        """Drop cold partitions that were replaced ``keep_versions_ms`` ago, as far as this process knows."""
        now, old = time.monotonic(), []
        for p in parts:
            since = self._replaced.setdefault((table, p[MONTH], p[MOVE]), now)
            if (now - since) * 1000 >= self.options.keep_versions_ms:
                old.append(p)
                del self._replaced[table, p[MONTH], p[MOVE]]
        tb.drop_partitions(self.spark, self.cold_name(table), old)

    # ---- clearing ------------------------------------------------------------------------------

    def clear_hot(self, height: int, hash: str) -> None:
        """Drop this processor's hot rows and publish an empty registry (R16, T14); cold stays."""
        dropped = 0
        for table in self.events:
            name = self.hot_name(table)
            parts = tb.partitions_of(self.spark, name, processor_id=self.processor)
            tb.drop_partitions(self.spark, name, parts)
            dropped += len(parts)
        self._log_of_blocks.outdate([span.version for span in self._state.spans])
        new = replace(
            self._state,
            epoch=self._state.epoch + 1,
            height=height,
            hash=hash,
            finalized_height=height,
            finalized_hash=hash,
            registry_version=self._state.epoch + 1,
            spans=(),
            rewrites=(),
            at_head=False,
            blocks_since=0,
        )
        self._log("clear_hot", ok=True, amount=dropped, height=height)
        self._save(new, None)
        self._log_of_blocks.drop_outdated((), self.options.keep_versions_ms)

    # ---- removal -------------------------------------------------------------------------------

    def remove(self, table: str, condition: Column) -> int:
        """Remove this processor's matching rows from both zones, or from a snapshot (D-1, D-2).

        Partitions with a match are written anew, without the rows, beside the old ones. Months of cold
        are committed one by one by their commit rows, all of hot by one status row. Replaced partitions
        stay for readers that began before: of cold for ``keep_versions_ms``, after which the next
        rewrite of the month drops them, of hot until their epoch is reclaimed. When stopped in between, calling it again finishes the work. Returns how
        many committed rows went, orphans included.
        """
        if table in self.snapshots:
            name = self._name(self.snapshots[table].table(self.options.network))
            n = tb.delete_where(self.spark, name, condition)
        else:
            doomed = F.coalesce(condition, F.lit(False))
            n = self._remove_cold(self.events[table], doomed) + self._remove_hot(self.events[table], doomed)
        self._log("remove", ok=True, table=table, amount=n)
        self._flush_log()
        return n

    def _remove_cold(self, t: tb.EventTable, doomed: Column) -> int:
        rows = self._committed_cold(t, self._cutoffs[t.name], self._read_commits()[1])
        # One row per month with a match.
        touched = rows.filter(doomed).groupBy(MONTH).agg(F.count(F.lit(1)).alias("n")).collect()
        for r in touched:
            self._rewrite_month(t.name, r[MONTH], ~doomed)
        return sum(r["n"] for r in touched)

    def _remove_hot(self, t: tb.EventTable, doomed: Column) -> int:
        s = self._state
        rows = self._committed_hot(t, s, self._cutoffs[t.name])
        # One row per unsettled epoch with a match.
        touched = rows.filter(doomed).groupBy(EPOCH, TOP).agg(F.count(F.lit(1)).alias("n")).collect()
        if not touched:
            return 0
        schema = f"{EPOCH} bigint, {TOP} bigint"
        own = self.spark.createDataFrame([(r[EPOCH], r[TOP]) for r in touched], schema)
        kept = rows.join(F.broadcast(own), [EPOCH, TOP], "left_semi").filter(~doomed)
        again = F.when(F.col(TOP) < 0, F.col(TOP) - TURN).otherwise(-F.col(TOP) - 1)
        self._drop_epoch(s.epoch + 1)
        tb.overwrite_partitions(
            kept.withColumn(TOP, again).sortWithinPartitions(PROCESSOR, EPOCH, TOP, *t.write_order()),
            self.hot_name(t.name),
        )
        new = {(r[EPOCH], _real_top(r[TOP])): -(r[TOP] - TURN if r[TOP] < 0 else -r[TOP] - 1) for r in touched}
        old = [r for r in s.rewrites if r[0] != t.name or (r[1], r[2]) not in new]
        rewrites = (*old, *((t.name, epoch, top, part) for (epoch, top), part in sorted(new.items())))
        self._save(replace(s, epoch=s.epoch + 1, rewrites=rewrites), None)
        return sum(r["n"] for r in touched)

    # ---- operations log --------------------------------------------------------------------------

    def _log(
        self, op: str, ok: bool, finalized: bool | None = None, amount: int | None = None,
        height: int | None = None, duration_ms: int | None = None, table: str | None = None,
        rows_in: int | None = None, rows_out: int | None = None,
    ) -> None:
        if not self.options.log_operations:
            return
        at = time.time_ns() // 1000
        seq = max(at, self._ops[-1][0] + 1) if self._ops else at
        self._ops.append(
            (seq, op, ok, finalized, amount, height, duration_ms, at // 1000, table, rows_in,
             rows_out, self.processor)
        )

    def _flush_log(self) -> None:
        """One append for everything logged since the last one."""
        ops, self._ops = self._ops, []
        if not ops:
            return
        fields = [f.split() for f in LOG_COLUMNS.split(", ")]
        entries = [
            F.struct(*[F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(op, fields)])
            for op in ops
        ]
        rows = self.spark.range(0, 1, 1, 1).select(F.inline(F.array(*entries)))
        tb.append_rows(rows, self._name(OPS_LOG))


def _observed(metrics: Observation) -> dict | None:
    """Observed values, or None where Spark proved that part of a plan empty and removed it."""
    try:
        return metrics.get
    except Py4JJavaError:
        return None


def _real_top(number: int) -> int:
    """The top height of a hot partition, whether written once or anew."""
    return number if number >= 0 else -number % TURN - 1


def _ms(started: float) -> int:
    return int((time.time() - started) * 1000)
