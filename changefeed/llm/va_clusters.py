"""Centroid clustering over a vector-approximation file.

Each component of a vector is put in one of ``2**BITS`` cells of its dimension; the cells of a vector, a byte each, are its approximation. For a
set of centroids two lookup tables (dimension, cell, centroid) hold the least and
the largest squared distance a component in that cell can have. Their sums over the
dimensions give an interval per centroid; only the centroids whose interval begins
at or below the least upper end can be nearest, and only where several remain is the
full vector fetched and compared, exactly, with those alone.

Approximations and vectors are written once, side by side, as Parquet. Each round
is one scan without a shuffle of rows: a task adds up the vectors of its clusters and
only (cluster, component, sum) is exchanged, so the driver sees k times d numbers
whatever the table. The new centroids follow from the sums (every vector is added
to one once; distances, of which there are k per vector, are what the cells save).

Numbers are whole: floor(``SCALE`` * x) for each component x, squared distances, sums
and the floored means, so results do not depend on the order of rows.

Cases: vectors that are null, of another length, or hold a null, NaN or infinity take
no part; equal rows are counted as often as they occur; ties go to the smaller centroid
number; of vectors with one id, the smaller vector starts earlier; a null id starts
last; with fewer vectors than centroids there are fewer centroids; an empty table
gives no rows; a component beyond ``LARGEST`` in size is an error, for the sums of
such would not be exact.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from changefeed.session import gone_at_exit, shared_dir

DIMENSIONS, CENTROIDS, ROUNDS, SCALE = 64, 40, 5, 256
BITS, REACH = 7, 3.0
LARGEST = 2**27

# Rows looked at together.
_PART = 2048


def kept_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, v): the vectors that take part, in double precision."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v")).filter(
        F.col("v").isNotNull() & (F.size("v") == dimensions) & finite
    )


def _whole(column: pa.Array, dimensions: int, scale: int) -> np.ndarray:
    x = np.floor(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions) * float(scale))
    if len(x) and np.abs(x).max() > LARGEST:
        raise ValueError(f"a component is beyond {LARGEST}")
    return x.astype("<i4")


def _scaled(v, scale: int):
    return F.transform(v, lambda x: F.floor(x * F.lit(float(scale))))


def borders(kept: DataFrame, dimensions: int, scale: int, bits: int = BITS) -> np.ndarray:
    """Cell borders of each dimension: steps within ``REACH`` deviations of its mean, then the least and largest value.

    Row j has 2**bits + 1 ascending numbers; cell i holds the whole numbers from number i up to the next one's
    predecessor. All vectors are looked at; where the borders lie changes how much is fetched, never a result.
    """

    def run(batches):
        found = None
        for batch in batches:
            x = _whole(batch.column(1), dimensions, scale).astype(np.float64)
            if len(x):
                part = np.stack([np.full(dimensions, len(x)), x.sum(0), (x * x).sum(0), -x.min(0), x.max(0)])
                found = part if found is None else np.concatenate([found[:3] + part[:3], np.maximum(found[3:], part[3:])])
        if found is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(dimensions, dtype=np.int32)), *map(pa.array, found)], names=["j", "n", "s", "q", "low", "high"]
            )

    sums = kept.mapInArrow(run, "j int, n double, s double, q double, low double, high double").groupBy("j").agg(
        *[F.sum(c).alias(c) for c in "nsq"], *[F.max(c).alias(c) for c in ("low", "high")]
    )
    cuts = np.empty((dimensions, 2**bits + 1), np.int64)
    for r in sums.collect():  # one row for each dimension
        mean = r["s"] / r["n"]
        reach = REACH * max(1.0, r["q"] / r["n"] - mean * mean) ** 0.5
        inner = np.linspace(mean - reach, mean + reach, 2**bits - 1)
        cuts[r["j"]] = np.clip(np.concatenate(([-r["low"]], inner, [r["high"] + 1])), -r["low"], r["high"] + 1).astype(np.int64)
    return cuts


def write_cells(kept: DataFrame, path: str, cuts: np.ndarray, scale: int) -> None:
    """Store (key, cells, whole): the approximation and the full vector as little-endian 32-bit numbers."""
    schema = StructType([kept.schema["key"], StructField("cells", BinaryType()), StructField("whole", BinaryType())])
    dimensions = len(cuts)

    def run(batches):
        for batch in batches:
            whole = _whole(batch.column(1), dimensions, scale)
            cells = np.empty(whole.shape, np.uint8)
            for j in range(dimensions):
                cells[:, j] = np.searchsorted(cuts[j, 1:-1], whole[:, j], "right")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array([r.tobytes() for r in rows], pa.binary()) for rows in (cells, whole)]],
                names=["key", "cells", "whole"],
            )

    kept.mapInArrow(run, schema).write.parquet(path)


class Intervals:
    """Lookup tables of the distance intervals of one set of centroids."""

    def __init__(self, centroids: np.ndarray, cuts: np.ndarray):
        self.centroids = centroids
        low = cuts[:, :-1, None]
        high = np.maximum(low, cuts[:, 1:, None] - 1)
        at = centroids.T[:, None, :]
        least = np.maximum(np.maximum(low - at, at - high), 0) ** 2
        most = np.maximum(np.abs(at - low), np.abs(at - high)) ** 2
        self.tables = np.concatenate([least, most], axis=2)

    def nearest(self, cells: np.ndarray, fetch) -> tuple[np.ndarray, int]:
        """(cluster of each row, rows fetched); ``fetch`` gives the full vectors of some rows."""
        k = len(self.centroids)
        ends = np.zeros((len(cells), 2 * k), np.int64)
        for j, table in enumerate(self.tables):
            ends += table[cells[:, j]]
        near = ends[:, :k] <= ends[:, k:].min(axis=1)[:, None]
        cluster = near.argmax(axis=1)
        several = np.flatnonzero(near.sum(axis=1) > 1)
        if len(several):
            full, best = fetch(several), np.full(len(several), np.iinfo(np.int64).max)
            for c in range(k):
                rows = np.flatnonzero(near[several, c])
                move = full[rows] - self.centroids[c]
                distance = np.einsum("ij,ij->i", move, move)
                closer = distance < best[rows]
                best[rows[closer]], cluster[several[rows[closer]]] = distance[closer], c
        return cluster, len(several)


def _numbers(column: pa.Array, kind: str, rows: np.ndarray, width: int) -> np.ndarray:
    """The chosen rows of a column of equally long binaries."""
    if isinstance(rows, np.ndarray):
        column = column.take(pa.array(rows))
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _assigned(batches, tables: Intervals, width: int):
    """(batch, clusters, exact vectors of given rows) part by part."""
    for whole in batches:
        for at in range(0, whole.num_rows, _PART):
            batch = whole.slice(at, _PART)
            cells = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, width)
            clusters, _ = tables.nearest(cells, lambda rows, b=batch: _numbers(b.column(2), "<i4", rows, width).astype(np.int64))
            yield batch, clusters


def _sums(stored: DataFrame, tables: Intervals, width: int) -> DataFrame:
    """(cluster, j, total): sums of components of each cluster; j = -1 counts its vectors."""
    k = len(tables.centroids)

    def run(batches):
        total, count = np.zeros((k, width), np.int64), np.zeros(k, np.int64)
        for batch, clusters in _assigned(batches, tables, width):
            whole = _numbers(batch.column(2), "<i4", None, width).astype(np.int64)
            order = np.argsort(clusters, kind="stable")
            first = np.flatnonzero(np.concatenate(([True], np.diff(clusters[order]) > 0)))
            total[clusters[order][first]] += np.add.reduceat(whole[order], first, axis=0)
            count += np.bincount(clusters, minlength=k)
        used = np.flatnonzero(count)
        columns = np.repeat(used, width + 1), np.tile(np.arange(-1, width), len(used))
        values = np.column_stack([count[used], total[used]]).ravel()
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(values, pa.int64())],
            names=["cluster", "j", "total"],
        )

    return stored.mapInArrow(run, "cluster int, j int, total bigint").groupBy("cluster", "j").agg(F.sum("total").alias("total"))


def cluster(
    vectors: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE,
    seed: str = "2", bits: int = BITS, key: str = "vec_id", vector: str = "embedding",
) -> tuple[DataFrame, np.ndarray]:
    """((key, cluster, distance), centroids): Lloyd's rounds from the vectors with the smallest hashes of ``seed:key``."""
    spark = vectors.sparkSession
    kept = kept_vectors(vectors, dimensions, key, vector)
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")), 256)
    start = (
        kept.select(named.alias("name"), _scaled("v", scale).alias("v"))
        .orderBy(F.col("name").asc_nulls_last(), "v").limit(centroids).collect()
    )
    schema = StructType([StructField(key, kept.schema["key"].dataType), StructField("cluster", IntegerType()), StructField("distance", LongType())])
    if not start:
        return spark.createDataFrame([], schema), np.empty((0, dimensions), np.int64)
    middles = np.array([r["v"] for r in start], np.int64)
    cuts = borders(kept, dimensions, scale, bits)
    path = f"{shared_dir(spark)}/cells-{uuid.uuid4().hex}"
    write_cells(kept, path, cuts, scale)
    gone_at_exit(spark, path)
    stored = spark.read.parquet(path)
    for _ in range(rounds):
        # k times (d + 1) numbers
        for c, j, total in sorted(map(tuple, _sums(stored, Intervals(middles, cuts), dimensions).collect())):
            if j < 0:
                count = total
            else:
                middles[c, j] = total // count
    final = Intervals(middles, cuts)

    def run(batches):
        for batch, clusters in _assigned(batches, final, dimensions):
            move = _numbers(batch.column(2), "<i4", None, dimensions) - final.centroids[clusters]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(clusters, pa.int32()), pa.array(np.einsum("ij,ij->i", move, move), pa.int64())],
                names=[key, "cluster", "distance"],
            )

    return stored.mapInArrow(run, schema), middles


def with_inertia(assigned: DataFrame, middles: np.ndarray) -> DataFrame:
    """Add cluster_inertia, inertia (exact sums of distances) and centroid_sha256."""
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia"))
    # one row for each centroid
    per = {r["cluster"]: int(r["inertia"]) for r in sums.collect()}
    named = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in middles]
    rows = [(c, per.get(c, 0), sum(per.values()), named[c]) for c in range(len(middles))]
    facts = assigned.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster")
