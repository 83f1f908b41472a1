"""The row at a rank of a table's order, found without sorting or numbering the table.

Rows are compared with a few pivots, counted between them, and only the interval that
holds the rank is looked at again. A round reads the order columns twice, with the
interval as a filter on the first column that can reach the scan; what meets on the
driver is one row of pivots and one of counts, of fixed size. Pivots are a sample of
the interval's rows, so a row with many copies becomes a pivot early and is then settled
by its count. Some six rounds find a rank among 10**12 rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Pivots of a round: a grid, so that a row is compared with 2 * SIDE of them.
SIDE = 12

KINDS = (T.IntegralType, T.FloatType, T.DoubleType, T.DecimalType, T.StringType, T.BooleanType, T.DateType, T.BinaryType,
         T.TimestampType, T.TimestampNTZType)


@dataclass
class Place:
    """A row of the order: its values, the rows before it and the copies of it."""

    values: tuple
    before: int
    copies: int


def selectable(df: DataFrame, order: list[str]) -> bool:
    """Whether the order columns are of kinds that can be compared with pivots."""
    return bool(order) and all(isinstance(df.schema[c].dataType, KINDS) for c in order)


def key_of(order: list[str]) -> Column:
    return F.struct(*[F.col(f"`{c}`").alias(c) for c in order])


def _carried(df: DataFrame, order: list[str], key: Column) -> Column:
    """A key as the driver holds it: times as numbers or texts, free of any time zone."""

    def shown(name):
        kind = df.schema[name].dataType
        if isinstance(kind, T.TimestampType):
            return F.unix_micros(key[name]).alias(name)
        return key[name].cast("string").alias(name) if isinstance(kind, T.TimestampNTZType) else key[name].alias(name)

    return F.struct(*[shown(c) for c in order])


def _constant(value, kind: T.DataType) -> Column:
    if value is not None and isinstance(kind, T.TimestampType):
        return F.timestamp_micros(F.lit(value))
    return F.lit(value).cast(kind)


def literal(df: DataFrame, order: list[str], values: tuple) -> Column:
    """A row's carried values as a constant, comparable with ``key_of``."""
    return F.struct(*[_constant(v, df.schema[c].dataType).alias(c) for c, v in zip(order, values)])


def between(df: DataFrame, order: list[str], low: tuple | None, high: tuple | None) -> DataFrame:
    """The rows after ``low`` and before ``high``; null comes first in an order."""
    first = F.col(f"`{order[0]}`")
    kind = df.schema[order[0]].dataType
    if low is not None:
        if low[0] is not None:
            df = df.filter(first >= _constant(low[0], kind))
        df = df.filter(key_of(order) > literal(df, order, low))
    if high is not None:
        if high[0] is not None:
            df = df.filter(first.isNull() | (first <= _constant(high[0], kind)))
        df = df.filter(key_of(order) < literal(df, order, high))
    return df


def place_at(df: DataFrame, order: list[str], rank: int, after: Place | None = None) -> Place | None:
    """The row with ``rank`` rows before it in the order (from 0); none past the end.

    ``after`` is a place known to come before it.
    """
    rows = df.select(*[F.col(f"`{c}`") for c in order])
    low, high = after.values if after else None, None
    before = after.before + after.copies if after else 0
    while True:
        inside = between(rows, order, low, high).select(key_of(order).alias("k"))
        sample = inside.orderBy(F.xxhash64("k", F.monotonically_increasing_id())).limit(SIDE * SIDE)
        ordered = sample.agg(F.array_sort(F.collect_set("k")).alias("k"))
        pivots = [tuple(k) for k in ordered.select(F.transform("k", lambda k: _carried(rows, order, k)).alias("k")).first().k]
        if not pivots:
            return None
        constants = [literal(rows, order, p) for p in pivots]
        lines = F.array(*[F.array(*constants[at : at + SIDE]) for at in range(0, len(pivots), SIDE)])
        # the last line that does not start after the row, then the pivots of that line up to the row
        line = F.size(F.filter(lines, lambda some: F.get(some, F.lit(0)) <= F.col("k")))
        some = F.get(lines, F.greatest(line - 1, F.lit(0)))
        upto = F.greatest(line - 1, F.lit(0)) * SIDE + F.size(F.filter(some, lambda p: p <= F.col("k")))
        last = F.get(F.get(lines, line - 1), F.pmod(F.col("at") - 1, F.lit(SIDE)))
        counts = (
            inside.withColumn("at", upto).select("at", F.coalesce(last == F.col("k"), F.lit(False)).alias("hit"))
            .groupBy("at", "hit").count().collect()
        )
        found = {(r["at"], r["hit"]): r["count"] for r in counts}
        # in order: rows before the first pivot, its copies, rows up to the second, ...
        steps = [(None, found.get((0, False), 0))]
        for at in range(1, len(pivots) + 1):
            steps += [(at - 1, found.get((at, True), 0)), (None, found.get((at, False), 0))]
        for number, (pivot, count) in enumerate(steps):
            if before + count > rank:
                break
            before += count
        else:
            return None
        if pivot is not None:
            return Place(pivots[pivot], before, count)
        gap = number // 2
        low = pivots[gap - 1] if gap else low
        high = pivots[gap] if gap < len(pivots) else high


def rows_at(df: DataFrame, offset: int, n: int) -> DataFrame:
    """``n`` rows after skipping ``offset`` in the order of all columns, without sorting the table.

    Rows equal in all columns are counted, so a run of copies may be cut anywhere.
    """
    order = df.columns
    start = place_at(df, order, offset) if n > 0 else None
    if start is None:
        return df.limit(0)
    left = start.before + start.copies - offset

    def copies(place: Place, count: int) -> DataFrame:
        values = literal(df, order, place.values)
        return df.sparkSession.range(count).select(*[values[c].alias(c) for c in order])

    if n <= left:
        return copies(start, n)
    end = place_at(df, order, offset + n - 1, after=start)
    chosen = copies(start, left).unionByName(between(df, order, start.values, end.values if end else None))
    if end is not None:
        chosen = chosen.unionByName(copies(end, offset + n - end.before))
    return chosen
