"""Exact substring dedup with externally sorted suffixes.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts somewhere
else, in another text or the same one.

How equal strings meet although they start anywhere: of all ``GRAM``-byte pieces
inside a window of ``LENGTH`` bytes the one with the least hash is its anchor, and
equal windows have equal anchors. Neighbouring windows mostly share theirs, so a
text falls into *runs* of windows with one anchor. Anchors that occur once cannot
belong to a repeated string. Of each run only anchor, place and a 128-bit BLAKE2
digest of its text are shuffled, once, by the anchor; texts with equal digests are
equal, and all their windows repeat. Of equal texts that meet in a map task already
one goes to its anchor; the others are decided and dealt out. Where an anchor has
texts without a copy beside others, one text for each digest goes to the shard of
the anchor and is decided by sorting suffixes (see ``induced_sort``), in shards of
whole anchors of ``SHARD_BYTES`` or one anchor if that is larger; queues there go to
disk. Two neighbouring suffixes that share ``LENGTH`` bytes are repeated windows.

Runs worth a look are listed by text. Texts are shuffled once, to their lists, and
these files are read twice: for the texts of runs to sort, and to be cut. This is
so for any size of the lists, so what is shuffled grows with the input.

Cases: null and shorter texts lose nothing (null counts as empty); rows that are
equal in id and text are different documents that repeat each other; matches
never cross texts.
"""

from __future__ import annotations

import hashlib
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changefeed.llm.common import in_parts
from changefeed.llm.induced_sort import CAP, repeated_starts

LENGTH, GRAM = CAP, 64
SHARD_BYTES = 4 * 1024 * 1024

# Windows looked at together; longer texts are taken piece by piece.
_PIECE = 1 << 22
_PLACE = np.uint64((1 << 24) - 1)
# Deals out rows that are decided.
_SPREAD = 0x5851F42D4C957F2D
# Odd multipliers of a rolling hash and its last mixing step.
_FACTOR, _MIX = 0x9E3779B97F4A7C15, np.uint64(0xFF51AFD7ED558CCD)


def runs(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchors, starts, counts): the runs of windows of a text; a start is a byte offset."""
    parts = []
    data = np.frombuffer(raw, np.uint8)
    for begin in range(0, max(0, len(data) - LENGTH + 1), _PIECE):
        anchors, starts, counts = _runs(data[begin : begin + _PIECE + LENGTH - 1])
        parts.append((anchors, starts + begin, counts))
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(map(np.concatenate, zip(*parts)))


def _runs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    h = data.astype(np.uint64) + np.uint64(1)
    step = 1
    while step < GRAM:
        h = h[:-step] * np.uint64(pow(_FACTOR, step, 1 << 64)) + h[step:]
        step *= 2
    h ^= h >> np.uint64(33)
    h *= _MIX
    h ^= h >> np.uint64(29)
    least = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
    width, reach = LENGTH - GRAM + 1, 1
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if width > reach:
        least = np.minimum(least[: -(width - reach)], least[width - reach :])
    starts = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    counts = np.diff(np.append(starts, len(least)))
    return h[(least[starts] & _PLACE).astype(np.int64)].view(np.int64), starts, counts


def _copies(k: np.ndarray, digests: list[bytes]) -> np.ndarray:
    """For the first of equal runs how many there are, for the others 0."""
    halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    order = np.lexsort((halves[:, 0], halves[:, 1], k))
    sorted_k, halves = k[order], halves[order]
    first = np.append(True, (sorted_k[1:] != sorted_k[:-1]) | (halves[1:] != halves[:-1]).any(axis=1))[: len(k)]
    begins = np.flatnonzero(first)
    out = np.zeros(len(k), np.int64)
    out[order[begins]] = np.diff(np.append(begins, len(k)))
    return out


def _all_runs(docs: DataFrame) -> DataFrame:
    """(key, mark, k, start, n, b, copies): a row for each run; b is the digest of its text.

    A run that is equal to one of ``copies`` runs beside it has 0 copies, no digest, and any number as k.
    """
    schema = docs.select(
        "key", "mark", *[F.lit(0).cast("bigint").alias(c) for c in ("k", "start", "n")],
        F.lit(None).cast("binary").alias("b"), F.lit(0).cast("bigint").alias("copies"),
    ).schema

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found, digests = [], []
                for raw in part.column(2):
                    raw = raw.as_py() or b""
                    found.append(runs(raw))
                    view = memoryview(raw)
                    digests.extend(
                        blake2b(view[s : s + n + LENGTH - 1], digest_size=16).digest()
                        for s, n in zip(found[-1][1].tolist(), found[-1][2].tolist())
                    )
                owner = pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found]))
                k, start, n = (np.concatenate([f[i] for f in found]) for i in range(3))
                copies = _copies(k, digests)
                decided = copies == 0
                k = np.where(decided, np.arange(len(k)) * _SPREAD, k)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(owner), part.column(1).take(owner), pa.array(k), pa.array(start), pa.array(n),
                        pa.array(digests, pa.binary(), mask=decided), pa.array(copies),
                    ],
                    names=["key", "mark", "k", "start", "n", "b", "copies"],
                )

    return docs.mapInArrow(run, schema)


def _listed(docs: DataFrame) -> DataFrame:
    """(own, mark, runs): of each text the runs that repeat, and those to be sorted, which have a k."""
    in_order = Window.partitionBy("k", "b").orderBy("start")
    equal, anchor = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing), Window.partitionBy("k")
    real = F.col("copies") > 0
    # anchors whose texts all have copies are decided: each window of theirs repeats
    sorts = real & (F.col("_least") == 1) & (F.col("_first") == 1)
    return (
        _all_runs(docs).repartition("k")
        .withColumn("_equal", F.sum("copies").over(equal))
        .withColumn("_first", F.row_number().over(in_order))
        # summed over texts, so that one sort does for all
        .withColumn("_all", F.sum(F.when(F.col("_first") == 1, F.col("_equal"))).over(anchor))
        .withColumn("_least", F.min(F.when(real, F.col("_equal"))).over(anchor))
        .filter("copies = 0 or _all > 1")
        .select(
            F.xxhash64("key").alias("own"), "mark", "start", "n", F.when(sorts, F.col("k")).alias("k"),
            (~real | (F.col("_equal") > 1)).alias("repeats"),
        )
        .filter("repeats or k is not null")
        .repartition("own", "mark")
        .groupBy("own", "mark").agg(F.collect_list(F.struct("start", "n", "k", "repeats")).alias("runs"))  # of one text
    )


def _run_texts(with_lists: DataFrame) -> DataFrame:
    """(k, own, mark, start, single, body) of the runs to sort, from (own, mark, key, raw, runs)."""

    def run(batches):
        def rows(batch):
            own, mark, raws, listed = (batch.column(i) for i in (0, 1, 3, 4))
            begins, flat = listed.offsets.to_numpy(), listed.values
            start, n, k, repeats = (flat.field(i) for i in range(4))
            for i in range(batch.num_rows):
                low, size = int(begins[i]), int(begins[i + 1] - begins[i])
                raw = None
                columns = (c.slice(low, size).to_pylist() for c in (start, n, k, repeats))
                for s, width, anchor, copied in zip(*columns):
                    if anchor is not None:
                        raw = raw or raws[i].as_py()
                        yield anchor, own[i].as_py(), mark[i].as_py(), s, not copied, raw[s : s + width + LENGTH - 1]

        names = ["k", "own", "mark", "start", "single", "body"]
        types = [pa.int64()] * 4 + [pa.bool_(), pa.binary()]
        for batch in batches:
            yield from in_parts(rows(batch), names, types)

    return with_lists.mapInArrow(run, "k bigint, own bigint, mark bigint, start bigint, single boolean, body binary")


def _spans(flags: np.ndarray, at: int) -> list[dict]:
    """Byte ranges of windows that repeat; ``at`` is the place of the first."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))) + at
    return [{"s": int(s), "e": int(e) + LENGTH - 1} for s, e in zip(edges[::2], edges[1::2])]


_SPAN = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))


def _sorted_shards(batches):
    """Repeated windows of each text without a copy, anchors arriving one after the other."""

    def shard(group):
        text = np.concatenate([np.append(np.frombuffer(row[-1], np.uint8).astype(np.int16) + 1, np.int16(0)) for row in group])
        found = repeated_starts(text, LENGTH)
        at = 0
        for _, own, mark, start, single, body in group:
            spans = _spans(found[at : at + len(body) - LENGTH + 1], start) if single else None
            at += len(body) + 1
            if spans:
                yield own, mark, spans

    def rows():
        group, size = [], 0
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if size >= SHARD_BYTES and row[0] != group[-1][0]:
                    yield from shard(group)
                    group, size = [], 0
                group.append(row)
                size += len(row[-1])
        if group:
            yield from shard(group)

    yield from in_parts(rows(), ["own", "mark", "spans"], [pa.int64(), pa.int64(), _SPAN])


def _sorted(with_lists: DataFrame) -> DataFrame:
    """(own, mark, spans): what sorting finds in each text, from (own, mark, key, raw, runs)."""
    return (
        _run_texts(with_lists).repartition("k").sortWithinPartitions("k")
        .mapInArrow(_sorted_shards, "own bigint, mark bigint, spans array<struct<s: bigint, e: bigint>>")
        .groupBy("own", "mark").agg(F.flatten(F.collect_list("spans")).alias("spans"))  # of one text
    )


def _cut(raw: bytes, spans: list[dict]) -> tuple[bytes, int]:
    """What is left of a text, and how many ranges were cut out."""
    kept, last, number = [], 0, 0
    for x in sorted(spans, key=lambda x: x["s"]):
        if number == 0 or x["s"] > last:
            kept.append(raw[last : x["s"]])
            number += 1
        last = max(last, x["e"])
    return b"".join([*kept, raw[last:]]), number


def remove_repeated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept, kept_sha256); kept holds the remaining bytes."""
    named = docs.select(
        F.col(key).alias("key"), F.xxhash64(text).alias("mark"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("raw")
    )
    # a text is told by the hash of its key and its own; both joins take the same files of both sides
    texts = named.select(F.xxhash64("key").alias("own"), "mark", "key", "raw")
    listed = _listed(named).hint("merge")
    same = ["own", "mark"]
    copied = F.expr(f"transform(filter(runs, x -> x.repeats), x -> named_struct('s', x.start, 'e', x.start + x.n + {LENGTH - 1}))")
    joined = (
        texts.join(listed, same, "left").join(_sorted(texts.join(listed, same)), same, "left")
        .select("key", "raw", copied.alias("copied"), "spans")
    )
    schema = joined.select(
        "key", *[F.lit(0).cast("bigint").alias(c) for c in ("n_bytes", "n_removed", "n_spans")],
        F.lit(b"").cast("binary").alias("kept"), F.lit("").cast("string").alias("kept_sha256"),
    ).schema

    def run(batches):
        for batch in batches:
            rows = []
            for raw, copies, cuts in zip(*(batch.column(i) for i in (1, 2, 3))):
                raw = raw.as_py()
                kept, number = _cut(raw, (copies.as_py() or []) + (cuts.as_py() or []))
                rows.append((len(raw), len(raw) - len(kept), number, kept, hashlib.sha256(kept).hexdigest()))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
            columns = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types)]],
                names=["key", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"],
            )

    return joined.mapInArrow(run, schema).withColumnRenamed("key", key)
