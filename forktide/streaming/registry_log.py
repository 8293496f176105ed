"""The valid-block registry as a log of changes with a manifest.

An epoch writes only the blocks it registers, as one small partition. Which of them are still valid is
said by a manifest: ranges of heights, each with the partition that holds its blocks. A fork cuts
ranges off at its height, pruning cuts them off from below, and a range that is empty leaves the
manifest. So replaying the log is a scan of the named partitions with one height range each; nothing
older is read, and an epoch costs the size of its change. Beyond ``most`` ranges the whole registry is
written as one new partition, the base of what follows.

The manifest is a value of bounded size and belongs to the status row that commits an epoch. A
registry without blocks has an empty manifest; a partition that is named and gone is an error.
"""

from __future__ import annotations

import json
import time
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from forktide.operators.chain import PROCESSOR
from forktide.sources import tables as tb

VERSION, SINCE = "version", "since"
# The files say which version they belong to, as they are read by their names.
SCHEMA = f"height bigint, hash string, timestamp timestamp, {SINCE} bigint"


class MissingVersion(LookupError):
    """A registry version was asked for that was dropped or never committed."""


@dataclass(frozen=True)
class Span:
    """Blocks of one version that are valid: those from ``low`` to ``top``."""

    version: int
    low: int
    top: int


def to_text(spans: Sequence[Span]) -> str:
    return json.dumps([[s.version, s.low, s.top] for s in spans])


def from_text(text: str | None) -> tuple[Span, ...]:
    return tuple(Span(*s) for s in json.loads(text or "[]"))


def cut(spans: Sequence[Span], below: int | None = None, from_: int | None = None) -> tuple[Span, ...]:
    """Spans restricted to heights under ``below`` and from ``from_`` on."""
    kept = []
    for s in spans:
        low = s.low if from_ is None else max(s.low, from_)
        top = s.top if below is None else min(s.top, below - 1)
        if low <= top:
            kept.append(Span(s.version, low, top))
    return tuple(kept)


def tip(spans: Sequence[Span]) -> int | None:
    return max((s.top for s in spans), default=None)


class RegistryLog:
    """Partitions ``(processor, version)`` of the registry table of one processor."""

    def __init__(self, spark: SparkSession, table: str, processor: str, most: int = 32) -> None:
        if most < 1:
            raise ValueError("a manifest has room for one span at least")
        self.spark = spark
        self.table = table
        self.processor = processor
        self.most = most
        self._outdated: dict[int, float] = {}

    def create(self) -> None:
        tb.create_partitioned(
            self.spark, self.table, f"{SCHEMA}, {PROCESSOR} string, {VERSION} bigint", [PROCESSOR, VERSION],
            {"zone": "state"},
        )

    def read(self, spans: Sequence[Span], from_: int | None = None) -> DataFrame:
        """Blocks ``(processor_id, height, hash, timestamp)`` of a manifest, from a height on.

        The files are named here: a partition dropped later is an error when they are read, and one
        that is gone already is an error now.
        """
        spans = cut(spans, from_=from_)
        self.spark.catalog.refreshTable(self.table)
        rows = self.spark.table(self.table).filter(F.col(PROCESSOR) == self.processor)
        if not spans:
            return rows.select(PROCESSOR, "height", "hash", "timestamp").limit(0)
        files = [unquote(f) for f in rows.filter(F.col(VERSION).isin([s.version for s in spans])).inputFiles()]
        there = {int(f.rsplit("/", 2)[1].split("=", 1)[1]) for f in files}
        gone = [s.version for s in spans if s.version not in there]
        if gone:
            raise MissingVersion(f"registry versions {gone} of {self.processor} are gone")
        valid = F.lit(False)
        for s in spans:
            valid = valid | ((F.col(SINCE) == s.version) & F.col("height").between(s.low, s.top))
        found = self.spark.read.schema(SCHEMA).parquet(*files).filter(valid)
        return found.select(F.lit(self.processor).alias(PROCESSOR), "height", "hash", "timestamp")

    def publish(
        self, version: int, spans: Sequence[Span], blocks: DataFrame, below: int | None = None,
        from_: int | None = None,
    ) -> tuple[tuple[Span, ...], str | None]:
        """Write the blocks of one change; returns the manifest that holds once it is committed, and the
        hash of the highest block written.

        Of what was valid, heights from ``below`` on and under ``from_`` are replaced or dropped; the
        new blocks, one per height, must not lie within the rest. Publishing a version again replaces it.
        """
        kept = cut(spans, below, from_)
        rows = blocks.select("height", "hash", "timestamp")
        whole = len(kept) >= self.most
        if whole:
            rows = self.read(kept).drop(PROCESSOR).unionByName(rows)
        bounds = Observation()
        placed = (
            rows.coalesce(1)
            .observe(
                bounds, F.min("height").alias("low"), F.max("height").alias("top"), F.max_by("hash", "height").alias("hash")
            )
            .withColumn(SINCE, F.lit(version).cast("bigint"))
            .withColumn(PROCESSOR, F.lit(self.processor))
            .withColumn(VERSION, F.lit(version).cast("bigint"))
        )
        tb.overwrite_partitions(placed, self.table)
        found = bounds.get
        own = () if found["low"] is None else (Span(version, found["low"], found["top"]),)
        after = own if whole else (*kept, *own)
        self.outdate({s.version for s in spans} - {s.version for s in after})
        self._outdated.pop(version, None)
        return after, found["hash"]

    def versions(self) -> list[int]:
        """Versions that have a partition."""
        return [int(p[VERSION]) for p in tb.partitions_of(self.spark, self.table, processor_id=self.processor)]

    def outdate(self, versions: Sequence[int] | set[int]) -> None:
        """From now on these versions are only there for readers that began before."""
        now = time.monotonic()
        for v in versions:
            self._outdated.setdefault(v, now)

    def drop_outdated(self, spans: Sequence[Span], keep_ms: int) -> int:
        """Drop versions outdated for ``keep_ms`` that the committed manifest does not name."""
        now, named = time.monotonic(), {s.version for s in spans}
        old = [v for v, since in self._outdated.items() if v not in named and (now - since) * 1000 >= keep_ms]
        there = set(self.versions()) if old else set()
        drop = [{PROCESSOR: self.processor, VERSION: v} for v in old if v in there]
        tb.drop_partitions(self.spark, self.table, drop)
        for v in old:
            del self._outdated[v]
        return len(drop)
