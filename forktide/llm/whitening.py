"""Whitening of vectors: the leading principal directions of the distinct rows, scaled to unit variance.

Vectors are put on a lattice of 1 / 256 (``x = floor(256 * c)``), and every distinct lattice vector counts
once. Sums are exact integers. Blocks of centred rows are reduced by QR inside the tasks, keeping
one triangle per task, and the triangles are combined in a tree of small groups, so no task sees more than
``FAN`` of them. The last triangle R has R'R = n * covariance; its bidiagonal form, dqds and twisted
factorisations give variances and directions (see ``bidiagonal``). Only the triangle, the sums and the
directions reach the driver: their size is that of one dimension squared, whatever the number of rows.

Defined results: a vector that is NULL or holds a NULL, NaN or infinite entry is dropped, and so is one of
another length than most distinct vectors have (of equally frequent lengths the longest counts). Empty
vectors have no components and give no rows. Rows with equal vectors, repeated rows and NULL keys each give
their own rows. A direction without variance has ``explained`` 0 and ``whitened`` NULL; with no variance
at all (as with one distinct vector) ``explained`` and ``identity_error`` are NULL too. A ``deviation``
beyond a bigint is NULL. Of equal variances any orthonormal directions are taken, the same for all rows.
An empty table gives no rows. Only the key and the vector are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forktide.llm.bidiagonal import EPS, right_singular
from forktide.llm.common import stored

FAN = 16
COMPONENTS = 4
LARGEST = (1 << 63) - 1
RESULT = (
    "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)


@dataclass(frozen=True)
class Whitening:
    """What was learned: ``n`` distinct vectors, their exact sums, and per component the direction as a
    column, the variance and its share (NaN without any variance)."""

    n: int
    sums: tuple[int, ...]
    directions: np.ndarray
    variances: np.ndarray
    shares: np.ndarray
    identity_error: float | None

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def scaled(self) -> np.ndarray:
        """Directions over the root of their variance; NaN where there is none."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.variances > 0, self.directions / np.sqrt(self.variances), np.nan)


def on_lattice(vector: Column) -> Column:
    """The lattice vector, NULL where the vector or an entry is NULL, NaN or infinite."""
    values = vector.cast("array<double>")
    good = F.forall(values, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    return F.when(good, F.transform(values, lambda c: F.floor(c * 256).cast("bigint")))


def lattice(rows: DataFrame, vector: str) -> DataFrame:
    return rows.withColumn("x", on_lattice(F.col(vector))).filter(F.size("x") > 0)


def matrix(batch: pa.RecordBatch, name: str = "x") -> np.ndarray:
    """A column of equally long vectors as rows."""
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)


def learn(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct lattice vectors of ``rows``; None if there are none."""
    spark = rows.sparkSession
    fit = stored(spark, lattice(rows.select(vector), vector).select("x").distinct(), "lattice")
    # One row per length.
    lengths = fit.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.agg(F.max(F.struct("n", "d")).alias("m")).first()["m"]
    if most is None:
        return None
    n, d = most["n"], most["d"]
    fit = fit.filter(F.size("x") == d)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * d
        for batch in batches:
            x = matrix(batch)
            if len(x):
                top = max(abs(int(x.min())), abs(int(x.max())))
                exact = x if top * len(x) <= LARGEST else x.astype(object)
                total = [t + int(s) for t, s in zip(total, exact.sum(axis=0))]
        # Two halves, as a sum may be longer than a bigint.
        high = pa.array([t >> 32 for t in total], pa.int64())
        low = pa.array([t & 0xFFFFFFFF for t in total], pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), high, low], names=["place", "high", "low"])

    halves = fit.mapInArrow(add, "place int, high bigint, low bigint").groupBy("place")
    # d rows.
    found = halves.agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    sums = [0] * d
    for r in found:
        sums[r["place"]] = (r["high"] << 32) + r["low"]
    mean = np.array([s / n for s in sums])

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        triangle = np.zeros((0, d))
        for batch in batches:
            if len(batch):
                triangle = np.linalg.qr(np.concatenate([triangle, matrix(batch) - mean]), mode="r")
        if len(triangle):
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([triangle.tobytes()], pa.binary())],
                names=["part", "triangle"],
            )

    def combine(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        parts = parts.sort_values("part")
        triangle = np.zeros((0, d))
        for data in parts["triangle"]:
            triangle = np.linalg.qr(np.concatenate([triangle, np.frombuffer(data).reshape(-1, d)]), mode="r")
        return pd.DataFrame({"part": [key[0]], "triangle": [triangle.tobytes()]})

    kind = "part bigint, triangle binary"
    triangles = stored(spark, fit.mapInArrow(reduce, kind), "triangles")
    parts = triangles.count()
    while parts > 1:
        groups = triangles.withColumn("part", F.call_function("div", F.col("part"), F.lit(FAN))).withColumn("g", F.col("part"))
        triangles = stored(spark, groups.groupBy("g").applyInPandas(combine, kind), "triangles")
        parts = triangles.count()
    r = np.frombuffer(triangles.first()["triangle"]).reshape(-1, d)
    r = np.concatenate([r, np.zeros((d - len(r), d))])  # fewer rows than dimensions

    values, directions = right_singular(r, min(components, d))
    trace = float((r * r).sum()) / n
    # What is left by rounding is no variance.
    variances = np.where(values > (d * EPS) ** 2 * values.max(initial=0.0), values / n, 0.0)
    shares = variances / trace if trace > 0 else np.full(len(variances), np.nan)
    found = Whitening(n, tuple(sums), directions, variances, shares, None)
    return Whitening(n, tuple(sums), directions, variances, shares, _identity_error(fit, found))


def _identity_error(fit: DataFrame, found: Whitening) -> float | None:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    live = [k for k, v in enumerate(found.variances) if v > 0]
    if not live:
        return None
    mean, scaled, m = found.mean, found.scaled[:, live], len(live)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((m + 1, m))
        for batch in batches:
            w = (matrix(batch) - mean) @ scaled
            total += np.concatenate([w.T @ w, w.sum(axis=0)[None, :]])
        values = pa.array(total.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), values], names=["place", "v"])

    # m * (m + 1) rows.
    rows = fit.mapInArrow(products, "place int, v double").groupBy("place").agg(F.sum("v").alias("v")).collect()
    total = np.zeros((m + 1) * m)
    for r in rows:
        total[r["place"]] = r["v"]
    total = total.reshape(m + 1, m) / found.n
    covariance = total[:m] - np.outer(total[m], total[m])
    return float(np.abs(covariance - np.eye(m)).max())


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Exact sums over dimensions of (n * x - sums) ** 2, None beyond a bigint."""
    if not len(x):
        return []
    top = n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, sums))
    if top <= LARGEST:
        away = n * x - np.array(sums, np.int64)
        if max(abs(int(away.min())), abs(int(away.max()))) ** 2 * x.shape[1] <= LARGEST:
            return (away * away).sum(axis=1).tolist()
    away = n * x.astype(object) - np.array(sums, object)
    return [v if v <= LARGEST else None for v in (away * away).sum(axis=1).tolist()]


def whiten(rows: DataFrame, found: Whitening | None, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Per row and component: key, ``component`` from 1, ``n``, ``deviation``, ``whitened``, ``explained`` and
    ``identity_error``."""
    kind = rows.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, {RESULT}"
    if found is None:
        return rows.sparkSession.createDataFrame([], schema)
    n, sums, d = found.n, found.sums, len(found.sums)
    mean, scaled, m = found.mean, found.scaled, len(found.variances)
    shares = [None if np.isnan(s) else float(s) for s in found.shares]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch) if len(batch) else np.zeros((0, d), np.int64)
            at = np.repeat(np.arange(len(x)), m)
            # Not a matrix product of the library: its rounding depends on a row's place in the batch.
            whitened = np.einsum("ij,jk->ik", x - mean, scaled).ravel()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("k").take(pa.array(at)),
                    pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(at), n, np.int64)),
                    pa.array(deviations(x, n, sums), pa.int64()).take(pa.array(at)),
                    pa.array(whitened, from_pandas=True),
                    pa.array(shares * len(x), pa.float64()),
                    pa.array([found.identity_error] * len(at), pa.float64()),
                ],
                names=[key, *(c.split()[0] for c in RESULT.split(", "))],
            )

    own = lattice(rows.select(F.col(key).alias("k"), F.col(vector).alias("v")), "v")
    return own.filter(F.size("x") == d).select("k", "x").mapInArrow(run, schema)
