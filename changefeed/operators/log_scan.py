"""State carried along a log by a parallel prefix scan.

A captured log lies in files in its own order. What a row inherits from all rows
before it (how many boundaries, the layout announced last) then needs no shuffle:

* one pass over narrow columns finds the *runs*, stretches of one source whose
  positions strictly ascend inside a task's input, and sums each up: first and last
  position, and for each key the number of its marks and the value of the last one;
* summaries combine in order of position (counts add, a later value replaces an
  earlier one, an associative step), which gives what every run begins with;
* a second pass carries the state on inside each run while the rows stream by,
  whole, where they lie.

Small files share a task, in any order, so a run may reach over files that other tasks
hold. Where runs overlap, they are scanned once more and cut where others begin.

A run is known again in the second pass by its first position, so nothing depends on
how Spark numbers its tasks; a run that is not known again fails the query. A log
whose files overlap, which is in no order at all, or which comes out of a shuffle, is
no case for this: then ``carry_along`` returns None and the caller takes its shuffled path. The summaries
are measured and bounded before they are collected.

Cases: rows without a source, a key or a position inherit nothing (count 0, null);
equal positions are no order; an empty log gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from changefeed.session import settle

# Runs one task may report, and summary rows of the whole log: more means disorder.
RUNS_PER_TASK = 2_048
SUMMARY_ROWS = 200_000

ORDER = ["_o0", "_o1", "_o2"]


def _codes(columns: list[pa.Array]) -> tuple[np.ndarray, list[tuple]]:
    """A number for each row's key (-1 if any part is null) and the keys by number."""
    whole = np.zeros(len(columns[0]), np.int64)
    missing = np.zeros(len(whole), bool)
    for column in columns:
        encoded = column.dictionary_encode()
        missing |= encoded.indices.is_null().to_numpy(zero_copy_only=False)
        whole = whole * max(1, len(encoded.dictionary)) + encoded.indices.fill_null(0).to_numpy()
    rows = np.flatnonzero(~missing)
    _, first, found = np.unique(whole[rows], return_index=True, return_inverse=True)
    codes = np.full(len(whole), -1, np.int64)
    codes[rows] = found.reshape(-1)
    return codes, [tuple(c[int(i)].as_py() for c in columns) for i in rows[first]]


class _Batch:
    """The scanned columns of a batch: source, three order numbers, key parts, mark, value."""

    def __init__(self, batch: pa.RecordBatch, n_on: int):
        part = batch.columns[-(6 + n_on) :]
        self.sources, source_keys = _codes(part[:1])
        self.source_names = [k[0] for k in source_keys]
        self.order = np.column_stack([c.fill_null(0).to_numpy(zero_copy_only=False) for c in part[1:4]]).astype(np.int64)
        placed = part[1].is_valid().to_numpy(zero_copy_only=False)
        self.codes, self.keys = _codes(part[4 : 4 + n_on])
        self.sources = np.where(placed, self.sources, -1)
        self.mark = part[4 + n_on].fill_null(False).to_numpy(zero_copy_only=False).astype(bool) & (self.codes >= 0)
        self.value = part[5 + n_on]

    def segments(self, last: dict, cuts: dict[str, list]) -> Iterator[tuple[str, np.ndarray, bool]]:
        """(source, rows, begins a run) of strictly ascending rows between two ``cuts``; ``last`` holds each source's last position."""
        for code, source in enumerate(self.source_names):
            rows = np.flatnonzero(self.sources == code)
            if not len(rows):
                continue
            order = self.order[rows]
            step = order[1:] - order[:-1]
            up = np.where(step[:, 0] != 0, step[:, 0] > 0, np.where(step[:, 1] != 0, step[:, 1] > 0, step[:, 2] > 0))
            places, here = cuts.get(source, []), tuple(order[0].tolist())
            edges = [0, *(np.flatnonzero(~up) + 1).tolist(), len(rows)]
            for a, b in zip(edges[:-1], edges[1:]):
                low, high = (tuple(order[i].tolist()) for i in (a, b - 1))
                inner = places[bisect_right(places, low) : bisect_right(places, high)]
                cut = sorted({a, *(bisect_left(order, c, a, b, key=lambda o: tuple(o.tolist())) for c in inner), b})
                for x, y in zip(cut[:-1], cut[1:]):
                    before = last.get(source)
                    begins = (
                        x > 0 or before is None or here <= before
                        or bisect_right(places, before) != bisect_right(places, here)
                    )
                    yield source, rows[x:y], begins
            last[source] = tuple(order[-1].tolist())


def _summaries(on: list[pa.DataType], value: pa.DataType, cuts: dict[str, list]):
    """Rows (source, f0, f1, f2, l0, l1, l2, key parts, n, v): one without a key for each run, one for each key with marks."""
    n_on = len(on)

    def run(batches):
        last: dict = {}
        runs: dict[str, dict] = {}
        rows: list[tuple] = []
        found = 0

        def close(source):
            r = runs.pop(source)
            place = (source, *r["first"], *r["last"])
            rows.append((*place, *[None] * n_on, None, None))
            rows.extend((*place, *key, n, v) for key, (n, v) in r["state"].items())

        for raw in batches:
            if found > RUNS_PER_TASK:
                continue
            batch = _Batch(raw, n_on)
            for source, at, begins in batch.segments(last, cuts):
                if begins:
                    if source in runs:
                        close(source)
                    found += 1
                    runs[source] = {"first": batch.order[at[0]].tolist(), "state": {}}
                runs[source]["last"] = batch.order[at[-1]].tolist()
                state = runs[source]["state"]
                marked = at[batch.mark[at]]
                if len(marked):
                    codes = batch.codes[marked]
                    numbers, back = np.unique(codes[::-1], return_index=True)
                    counts = np.bincount(codes, minlength=len(batch.keys))
                    for code, i in zip(numbers.tolist(), back.tolist()):
                        key = batch.keys[code]
                        before = state.get(key, (0, None))[0]
                        state[key] = (before + int(counts[code]), batch.value[int(marked[len(marked) - 1 - i])].as_py())
        for source in list(runs):
            close(source)
        disordered = found > RUNS_PER_TASK
        names = [*"sabcdef", *[f"k{i}" for i in range(n_on)], "n", "v"]
        columns = list(zip(*rows)) if rows else [()] * len(names)
        types = [pa.string(), *[pa.int64()] * 6, *on, pa.int64(), value]
        yield pa.RecordBatch.from_arrays(
            [*[pa.array(c, t) for c, t in zip(columns, types)], pa.array([disordered] * len(rows), pa.bool_())],
            names=[*names, "disordered"],
        )

    return run


class _Carried:
    """What each run begins with, from the collected summaries."""

    def __init__(self, rows: list[tuple], n_on: int):
        self.runs: dict[tuple, int] = {}
        self.marks: dict[tuple, tuple[list, list]] = {}
        self.ordered = True
        starts = sorted(r[:7] for r in rows if r[7 + n_on] is None)
        previous = None
        for number, r in enumerate(starts):
            if previous is not None and previous[0] == r[0] and not previous[4:7] < r[1:4]:
                self.ordered = False
            self.runs[r[:4]] = number
            previous = r
        state: dict[tuple, int] = {}
        for r in sorted((r for r in rows if r[7 + n_on] is not None), key=lambda r: r[:4]):
            key = (r[0], *r[7 : 7 + n_on])
            state[key] = state.get(key, 0) + r[7 + n_on]
            numbers, held = self.marks.setdefault(key, ([], []))
            numbers.append(self.runs[r[:4]])
            held.append((state[key], r[8 + n_on]))

    def before(self, run: int, key: tuple) -> tuple:
        """(count, value) that a run inherits for a key."""
        numbers, held = self.marks.get(key, ((), ()))
        at = bisect_left(numbers, run)
        return held[at - 1] if at else (0, None)


def _applied(shared, n_on: int, n_wide: int, value: pa.DataType, names: list[str], inclusive: bool):
    def run(batches):
        carried, cuts = shared.value
        last: dict = {}
        now: dict[str, tuple[int, dict]] = {}
        for raw in batches:
            batch = _Batch(raw, n_on)
            size = raw.num_rows
            count = np.zeros(size, np.int64)
            # where a row's value is taken from: a mark of this batch, or a value inherited
            own, kept, inherited = np.full(size, -1, np.int64), np.full(size, -1, np.int64), []
            for source, at, begins in batch.segments(last, cuts):
                if begins:
                    first = (source, *batch.order[at[0]].tolist())
                    if first not in carried.runs:
                        raise RuntimeError("input splits changed between two scans")
                    now[source] = (carried.runs[first], {})
                number, state = now[source]
                at = at[batch.codes[at] >= 0]
                if not len(at):
                    continue
                by_key = at[np.argsort(batch.codes[at], kind="stable")]
                codes, mark = batch.codes[by_key], batch.mark[by_key]
                edges = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
                group = np.cumsum(np.concatenate(([False], codes[1:] != codes[:-1])))
                total = np.cumsum(mark)
                seen = total - (0 if inclusive else mark)
                ground = (total - mark)[edges]
                newest = np.maximum.accumulate(np.where(mark, np.arange(len(codes)), -1))
                if not inclusive:
                    newest = np.concatenate(([-1], newest[:-1]))
                newest = np.where(newest >= edges[group], newest, -1)
                begin = []
                for code, start, end in zip(codes[edges].tolist(), edges.tolist(), [*edges[1:].tolist(), len(codes)]):
                    key = batch.keys[code]
                    if key not in state:
                        state[key] = carried.before(number, (source, *key))
                    begin.append(state[key])
                    added = int(total[end - 1] - (total[start] - mark[start]))
                    if added:
                        final = int(by_key[start:end][mark[start:end]][-1])
                        state[key] = (state[key][0] + added, batch.value[final].as_py())
                count[by_key] = np.array([b[0] for b in begin], np.int64)[group] + seen - ground[group]
                own[by_key] = np.where(newest >= 0, by_key[newest], -1)
                kept[by_key] = np.where(newest >= 0, -1, group + len(inherited))
                inherited.extend(b[1] for b in begin)
            choices = pa.concat_arrays([batch.value, pa.array(inherited, value)])
            take = np.where(own >= 0, own, np.where(kept >= 0, size + kept, -1))
            values = choices.take(pa.array(take, mask=take < 0))
            yield pa.RecordBatch.from_arrays([*raw.columns[:n_wide], pa.array(count), values], names=names)

    return run


def _in_place(df: DataFrame) -> bool:
    """Do rows come from their files without a shuffle, so that two scans cut them alike?"""
    todo = [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.inputPlan())
        elif "Exchange" in name and name != "BroadcastExchange":
            return False
        elif name != "BroadcastExchange":
            children = node.children()
            todo.extend(children.apply(i) for i in range(children.size()))
    return True


def carry_along(
    df: DataFrame, order: list[Column], on: list[str], mark: Column, value: Column, inclusive: bool = True
) -> DataFrame | None:
    """``df`` with ``_count`` and ``_value``: marks of the row's key so far, and the value of the last one.

    ``order`` are up to three BIGINT columns that place a row in the log of its
    ``source``; ``on`` the key of a mark, STRING or BIGINT columns, source among them or
    not. With ``inclusive`` a mark counts for its own row. None if the input is not in
    log order, has too many runs to sum up, or comes out of a shuffle.
    """
    if df.isStreaming or not _in_place(df):
        return None
    order = [*order, *[F.lit(0).cast("bigint")] * (3 - len(order))]
    keys = [f"_k{i}" for i in range(len(on))]
    scan = [
        F.col("source").cast("string").alias("_src"), *[c.cast("bigint").alias(n) for c, n in zip(order, ORDER)],
        *[F.col(c).alias(n) for c, n in zip(on, keys)], mark.alias("_mark"), value.alias("_val"),
    ]
    narrow = df.select(*scan)
    kinds = [f.dataType for f in narrow.schema]
    held = {True: pa.int64(), False: pa.string()}
    on_types = [held[isinstance(t, LongType)] for t in kinds[4:-2]]
    value_type = held[isinstance(kinds[-1], LongType)]
    schema = ", ".join([
        "s string", *[f"{c} bigint" for c in "abcdef"],
        *[f"k{i} {t.simpleString()}" for i, t in enumerate(kinds[4:-2])], "n bigint", f"v {kinds[-1].simpleString()}", "disordered boolean",
    ])
    cuts: dict[str, list] = {}
    for again in (False, True):
        found = settle(narrow.mapInArrow(_summaries(on_types, value_type, cuts), schema))
        if found.filter("disordered").limit(1).count() or found.limit(SUMMARY_ROWS + 1).count() > SUMMARY_ROWS:
            return None
        carried = _Carried([tuple(r)[:-1] for r in found.collect()], len(on))
        if carried.ordered:
            break
        if again:
            return None
        for source, *first in sorted(carried.runs):
            cuts.setdefault(source, []).append(tuple(first))
    out = StructType([*df.schema.fields, StructField("_count", LongType()), StructField("_value", kinds[-1])])
    shared = df.sparkSession.sparkContext.broadcast((carried, cuts))
    run = _applied(shared, len(on), len(df.columns), value_type, [*df.columns, "_count", "_value"], inclusive)
    return df.select("*", *scan).mapInArrow(run, out)
