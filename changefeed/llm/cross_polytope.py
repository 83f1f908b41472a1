"""Approximate nearest neighbours by cross-polytope hashing.

A unit vector is turned by fast pseudo-rotations (three times: random signs, then a
Hadamard transform) and assigned to the nearest signed axis. ``AXES`` of them
joined make a code, and ``TABLES`` independent codes as many tables. A query probes
in each table the ``PROBES`` codes it is nearest to, in order of the inner product with
their axes. All rows in a probed bucket are compared with the query, exactly, in
double precision, and the nearest of all tables' buckets stay.

Copies are searched once: equal vectors are one *point* with its smallest ids (one
more than asked for; no other copy can be in a list). Buckets meet in tasks by
(length, table, code): the points of a bucket arrive first, then the queries that
probe it. A bucket with more than ``BLOCK`` points is dealt out to blocks of about
that size, to each of which its queries are sent, so none is held whole however
full it is. A block returns its nearest points for each query, never a pair list.

A query whose buckets hold too few points looks into all buckets of a table, that is
at every point; so a list is short only if there are too few rows.

Cases: vectors that are null, empty or zero, or hold a null, NaN or infinity take no
part, nor do rows without an id; equal rows count once, rows with one id and different
vectors are different rows that never answer each other; only vectors of one length are compared with each other;
ties go to the smaller id; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changefeed.llm.common import bounded_broadcast, in_parts
from changefeed.session import settle

TABLES, AXES, PROBES = 4, 1, 24
BLOCK = 16_384
QUERIES_EVERY, NEAREST = 100, 10
SEED = 11
# More than any table has codes: every bucket is probed.
EVERY_CODE = 1 << 30
# Queries compared together, and copies of a query's list where many queries share a vector.
_TOGETHER, _SALTS = 128, 8


def _hadamard(x: np.ndarray) -> np.ndarray:
    """The normalised Hadamard transform of each row; the width is a power of two."""
    n, step = x.shape[1], 1
    while step < n:
        pairs = x.reshape(len(x), -1, 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), n)
        step *= 2
    return x / np.sqrt(n)


def rotated(x: np.ndarray, number: int) -> np.ndarray:
    """Rows of unit length, padded to a power of two, after pseudo-rotation ``number``."""
    width = 1 << max(0, x.shape[1] - 1).bit_length()
    y = np.zeros((len(x), width))
    largest = np.abs(x).max(axis=1, keepdims=True)
    y[:, : x.shape[1]] = x / largest  # no square overflows or vanishes
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    draw = np.random.default_rng((SEED, number, width))
    for _ in range(3):
        y = _hadamard(y * draw.choice([-1.0, 1.0], width))
    return y


def _nearness(x: np.ndarray, number: int) -> np.ndarray:
    """The inner product with each signed axis: columns 2 i for axis i, 2 i + 1 for its opposite."""
    y = rotated(x, number)
    return np.stack([y, -y], axis=2).reshape(len(y), -1)


def codes(x: np.ndarray, table: int, axes: int = AXES) -> np.ndarray:
    """The code of each row in a table."""
    out = np.zeros(len(x), np.int64)
    for number in range(table * axes, (table + 1) * axes):
        near = _nearness(x, number)
        out = out * near.shape[1] + near.argmax(axis=1)
    return out


def probes(x: np.ndarray, table: int, most: int = PROBES, axes: int = AXES) -> np.ndarray:
    """The codes each row is nearest to, best first, at most ``most``."""
    found, score = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1))
    for number in range(table * axes, (table + 1) * axes):
        near = _nearness(x, number)
        total = (score[:, :, None] + near[:, None, :]).reshape(len(x), -1)
        names = (found[:, :, None] * near.shape[1] + np.arange(near.shape[1])).reshape(len(x), -1)
        best = np.argsort(-total, axis=1, kind="stable")[:, :most]
        found, score = np.take_along_axis(names, best, 1), np.take_along_axis(total, best, 1)
    return found


def _usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, v): different rows that take part."""
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.select(F.col(key).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
        .filter(F.col("vec_id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
        .distinct()
    )


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def _by_length(batch: pa.RecordBatch):
    """(length, rows of that length) of a batch with ``v`` as its second column."""
    sizes = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
    for n in np.unique(sizes):
        yield int(n), batch.take(pa.array(np.flatnonzero(sizes == n)))


def _index(points: DataFrame, tables: int, axes: int, most: int | None = None) -> DataFrame:
    """(n, t, code, point, v, ids): an entry for each table, or with ``most`` for each of so many probes of it."""

    def run(batches):
        for whole in batches:
            for n, batch in _by_length(whole):
                x = _matrix(batch.column(1))
                for t in range(tables):
                    found = codes(x, t, axes)[:, None] if most is None else probes(x, t, most, axes)
                    for at in range(0, len(x), 256):
                        part = found[at : at + 256]
                        rows = batch.take(pa.array(np.repeat(np.arange(at, at + len(part)), part.shape[1])))
                        size = rows.num_rows
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(size, n, np.int32)), pa.array(np.full(size, t, np.int32)),
                                pa.array(part.ravel()), *rows.columns,
                            ],
                            names=["n", "t", "code", "point", "v", "ids"],
                        )

    return points.select("point", "v", "ids").mapInArrow(
        run, "n int, t int, code bigint, point bigint, v array<double>, ids array<bigint>"
    )


def exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The Euclidean distance of one vector to each row."""
    move = x - q
    largest = np.abs(move).max(initial=0.0)
    if largest == 0:
        return np.zeros(len(x))
    if 1e-140 < largest < 1e140:
        return np.sqrt(np.einsum("ij,ij->i", move, move))
    move = move / largest
    return largest * np.sqrt(np.einsum("ij,ij->i", move, move))


def _nearest(q: np.ndarray, x: np.ndarray, first_ids: np.ndarray, most: int):
    """Per query: (rows of ``x``, distances), the ``most`` nearest by exact distance, ties to the smaller id."""
    scale = max(np.abs(q).max(), np.abs(x).max())
    qs, xs = q / scale, x / scale
    rough = (qs * qs).sum(1)[:, None] + (xs * xs).sum(1)[None] - 2 * qs @ xs.T
    margin = 1e-12 * x.shape[1]  # far above what rounding can move
    for i in range(len(q)):
        if len(x) > most:
            last = np.partition(rough[i], most - 1)[most - 1]
            rows = np.flatnonzero(rough[i] <= last + margin)
        else:
            rows = np.arange(len(x))
        distance = exact(q[i], x[rows])
        order = np.lexsort((first_ids[rows], distance))[:most]
        yield rows[order], distance[order]


def _blocks(most: int):
    """Compare the queries of each block with its points; rows come as (n, t, code, block, asks, point, v, ids), sorted."""

    def run(batches):
        def rows():
            now, x, first_ids, ids = None, [], [], []
            for batch in batches:
                place = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)])
                edges = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]).any(axis=1), [True])))
                for a, b in zip(edges[:-1], edges[1:]):
                    key, asks = tuple(place[a, :4]), place[a, 4]
                    if key != now:
                        now, x, first_ids, ids = key, [], [], []
                    part = batch.slice(a, b - a)
                    v = _matrix(part.column(6))
                    if not asks:
                        lists = part.column(7)
                        x.append(v)
                        ids.extend(lists)
                        first_ids.extend(own[0].as_py() for own in lists)
                        continue
                    if not x:
                        continue
                    if len(x) > 1:
                        x = [np.concatenate(x)]
                    names = np.array(first_ids, np.int64)
                    for at in range(0, len(v), _TOGETHER):
                        found = _nearest(v[at : at + _TOGETHER], x[0], names, most)
                        for point, (near, distance) in zip(part.column(5).slice(at, _TOGETHER), found):
                            yield point.as_py(), distance.tolist(), [ids[j].as_py() for j in near]

        yield from in_parts(
            rows(), ["point", "distance", "ids"], [pa.int64(), pa.list_(pa.float64()), pa.list_(pa.list_(pa.int64()))], 2000
        )

    return run


def _search(points: DataFrame, queries: DataFrame, most: int, tables: int, axes: int, asked: int) -> DataFrame:
    """(point, distance, vec_id): the nearest ids of each query point found in the buckets it probes."""
    entries = _index(points, tables, axes)
    bucket = ["n", "t", "code"]
    probed = _index(queries, tables, axes, asked)
    sizes = entries.groupBy(*bucket).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    sizes = bounded_broadcast(settle(sizes), 64)
    zero = F.lit(0)
    held = entries.join(sizes, bucket).select(
        *bucket, F.pmod(F.xxhash64("point"), "blocks").cast("int").alias("block"), zero.alias("asks"), "point", "v", "ids"
    )
    sent = probed.join(sizes, bucket).select(
        *bucket, F.explode(F.sequence(zero, F.col("blocks") - 1)).alias("block"), F.lit(1).alias("asks"), "point", "v", "ids"
    )
    place = [*bucket, "block"]
    found = (
        held.unionByName(sent).repartition(*place).sortWithinPartitions(*place, "asks")
        .mapInArrow(_blocks(most), "point bigint, distance array<double>, ids array<array<bigint>>")
    )
    single = found.select("point", F.explode(F.arrays_zip("distance", "ids")).alias("f")).select(
        "point", F.col("f.distance").alias("distance"), F.explode("f.ids").alias("vec_id")
    )
    rank = F.row_number().over(Window.partitionBy("point").orderBy("distance", "vec_id"))
    # different vectors with one id may both be near; the same vector from several tables is one
    return single.distinct().withColumn("rank", rank).filter(F.col("rank") <= most).drop("rank")


def nearest_neighbours(
    vectors: DataFrame, every: int = QUERIES_EVERY, most: int = NEAREST, tables: int = TABLES, axes: int = AXES,
    asked: int = PROBES, key: str = "vec_id", vector: str = "embedding", is_query: Column | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``most`` nearest found for each query among all other rows.

    Queries are the rows for which ``is_query`` (on vec_id) holds: those with an id
    divisible by ``every`` unless given. Codes of ``axes`` rotations make (2 d)**axes
    buckets of each table, of which a query probes ``asked``: with one, buckets hold
    hundreds of rows at 10**5 rows; from about 10**8 rows two are due, and more probes.
    """
    rows = settle(_usable(vectors, key, vector))
    asks = F.col("vec_id") % every == 0 if is_query is None else is_query
    copies = Window.partitionBy("v").orderBy("vec_id")
    points = settle(
        rows.withColumn("rank", F.row_number().over(copies)).filter(F.col("rank") <= most + 1)
        .groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
        .withColumn("point", F.monotonically_increasing_id())
    )
    asking = rows.filter(asks)
    queries = settle(points.join(asking.select("v").distinct(), "v", "left_semi"))
    found = settle(_search(points, queries, most + 1, tables, axes, asked))
    full = found.groupBy("point").agg(F.count("*").alias("c")).filter(F.col("c") > most).select("point")
    short = settle(queries.join(full, "point", "left_anti"))
    more = _search(points, short, most + 1, 1, 1, EVERY_CODE)
    nearest = found.join(short.select("point"), "point", "left_anti").unionByName(more)
    lists = nearest.groupBy("point").agg(F.array_sort(F.collect_list(F.struct("distance", "vec_id"))).alias("near"))
    # many queries may share one vector: its list goes out in copies, they are dealt out among them
    salts = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)))
    answers = lists.join(queries.select("point", "v"), "point").select("v", "near", salts.alias("salt"))
    own = F.col("query_id")
    return (
        asking.select(F.col("vec_id").alias("query_id"), "v", F.pmod(F.xxhash64("vec_id"), F.lit(_SALTS)).cast("int").alias("salt"))
        .join(answers, ["v", "salt"])
        .select("query_id", F.posexplode(F.slice(F.filter("near", lambda x: x.vec_id != own), 1, most)).alias("at", "x"))
        .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.distance").alias("score"))
    )
