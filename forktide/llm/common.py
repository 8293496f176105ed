"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forktide.sources import scratch

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register ``fn(spark, sf_dir)`` under ``name``."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def crc_mod(key: str, n: int) -> Column:
    """crc32 of a key written as text, modulo ``n`` (NULL keys give NULL)."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % n


def stored(spark: SparkSession, df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors.

    ``scratch.release`` removes the folders once their results are no longer needed.
    """
    path, _ = scratch.fresh(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_sample(labels: DataFrame, docs: DataFrame, key: str, by: str, per_value: int, max_chars: int) -> DataFrame:
    """About ``per_value`` rows of each value of ``by`` with their whole texts, the same at every run.

    A bounded training sample: keys are chosen by a hash, texts of more than ``max_chars`` characters
    are left out, so at most some ``values * per_value * max_chars`` characters come. Only the chosen
    keys (a bounded number) are joined with ``docs`` (key and text); no text is shuffled.
    """
    fit = labels.filter(F.col(by).isNotNull() & F.col(key).isNotNull()).select(key, by).distinct()
    sizes = fit.groupBy(by).agg(F.count(F.lit(1)).alias("_n"))
    rate = F.lit(float(per_value)) / F.col("_n")
    draw = F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1 << 20)) / float(1 << 20)
    chosen = fit.join(F.broadcast(sizes), by).filter(draw < rate).drop("_n")
    text = next(c for c in docs.columns if c != key)
    return docs.filter(F.length(text) <= max_chars).join(F.broadcast(chosen), key)


def texts_of(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Arrow batches with their texts, NULL as the empty text."""
    for batch in batches:
        yield batch, [t or "" for t in batch.column(column).to_pylist()]


@lru_cache(maxsize=1)
def _trimmer():
    library = ctypes.CDLL(None)
    return library.malloc_trim if hasattr(library, "malloc_trim") else None


def give_back() -> None:
    """Return freed memory to the system: Python workers are reused, and what they keep adds up."""
    pa.default_memory_pool().release_unused()
    if _trimmer() is not None:
        _trimmer()(0)


def free_names(*frames: DataFrame, n: int) -> list[str]:
    """Column names that none of the frames has, however case is treated."""
    taken = {c.lower() for f in frames for c in f.columns}
    names = (f"_own{i}" for i in range(len(taken) + n))
    return [c for c in names if c not in taken][:n]
