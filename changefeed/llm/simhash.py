"""SimHash near-duplicates found by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits. Two
fingerprints at most three bits apart fall in one of two cases:

* some segment is equal. Of the other two, one holds at most one of the errors.
  Key: the equal segment and the Golay index of that other one (35 bits).
* each segment holds exactly one error. Key: the Golay indices of the first two
  segments and the three parities, which all differ (27 bits).

A stored key holds a word's own index, a probing key one of its neighbouring
indices (see ``golay``), so words one bit apart always meet. Met pairs are then
verified bit by bit.

Copies share a fingerprint, and only different fingerprints are compared. A key
with many stored fingerprints (near copies by the thousand, or a biased corpus)
is not expanded into pairs: its members are compared with four pivots each,
components are formed, and then only members outside the leading component of
a key are compared on, under finer keys: any three of six blocks equal, which
three errors cannot all touch. Pairs inside one component are never made.

Cases: a null text or one without words has fingerprint zero, linked like any
other; a null id never becomes a component id unless its component has no other.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefeed.llm import golay
from changefeed.llm.common import bounded_broadcast, utf8
from changefeed.llm.components import components
from changefeed.session import settle

SEED, DISTANCE = 42, 3

# Stored fingerprints of one key that are still compared pair by pair.
PLAIN_MEMBERS = 128
PIVOTS = 4

_CHUNK = 1 << 16


def fingerprint(text: bytes | None, width: int = 3) -> int:
    """Bits set in over half of the XXH64 values of all word shingles, repeats included."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    width = min(width, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    total, count = np.zeros(64, np.int64), len(words) - width + 1
    for at in range(0, count, _CHUNK):
        to = min(count, at + _CHUNK)
        hashes = np.fromiter(
            (digest(joined[s:e], SEED) for s, e in zip(starts[at:to].tolist(), ends[at + width - 1 : to + width - 1].tolist())),
            np.dtype(">u8"), to - at,
        )
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * total > count)
    return int(bits.view(">u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """(key, fp): the fingerprint of each row as a signed BIGINT."""
    named = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = named.select("key", F.lit(0).cast("bigint").alias("fp")).schema

    def run(batches):
        for batch in batches:
            found = np.array([fingerprint(raw, width) for raw in utf8(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["key", "fp"])

    return named.mapInArrow(run, schema).withColumnRenamed("key", key)


def _segments(fps: np.ndarray) -> list[np.ndarray]:
    return [(fps >> 41).astype(np.uint32), (fps >> 18 & 0x7FFFFF).astype(np.uint32), (fps & 0x3FFFF).astype(np.uint32)]


_WIDTHS = (23, 23, 18)
_ORDERED = [(j, k) for j in range(3) for k in range(3) if j != k]


def _parities(parts: list[np.ndarray]) -> np.ndarray:
    odd = [np.bitwise_count(p).astype(np.int64) & 1 for p in parts]
    return odd[0] << 2 | odd[1] << 1 | odd[2]


def stored_keys(fps: np.ndarray) -> np.ndarray:
    parts = _segments(fps)
    own = [golay.index(p).astype(np.int64) for p in parts]
    keys = [tag << 35 | parts[j].astype(np.int64) << 12 | own[k] for tag, (j, k) in enumerate(_ORDERED)]
    keys.append(6 << 35 | (own[0] << 12 | own[1]) << 3 | _parities(parts))
    return np.stack(keys, axis=1)


def probing_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each fingerprint a row of keys and a mask of those that count."""
    parts = _segments(fps)
    near, used = [], []
    for part, bits in zip(parts, _WIDTHS):
        found, first = golay.indices(part, bits)
        order = np.argsort(~first, axis=1, kind="stable")[:, :6]
        near.append(np.take_along_axis(found, order, axis=1).astype(np.int64))
        used.append(np.take_along_axis(first, order, axis=1))
    keys = [tag << 35 | parts[j].astype(np.int64)[:, None] << 12 | near[k] for tag, (j, k) in enumerate(_ORDERED)]
    masks = [used[k] for _, k in _ORDERED]
    pairs = (near[0][:, :, None] << 12 | near[1][:, None, :]).reshape(len(fps), -1)
    keys.append(6 << 35 | pairs << 3 | (_parities(parts) ^ 7)[:, None])
    masks.append((used[0][:, :, None] & used[1][:, None, :]).reshape(len(fps), -1))
    return np.concatenate(keys, axis=1), np.concatenate(masks, axis=1)


def _keyed(fps: DataFrame, probing: bool) -> DataFrame:
    """(k, fp): the keys of each fingerprint."""

    def run(batches):
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(values), 4096):
                part = values[at : at + 4096]
                if probing:
                    keys, mask = probing_keys(part.view(np.uint64))
                    owner = np.repeat(part, mask.sum(axis=1))
                    keys = keys[mask]
                else:
                    keys = stored_keys(part.view(np.uint64))
                    owner, keys = np.repeat(part, keys.shape[1]), keys.ravel()
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(owner)], names=["k", "fp"])

    return fps.select("fp").mapInArrow(run, "k bigint, fp bigint")


def _close(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= DISTANCE


# Bits from the top of each of six blocks.
_BLOCKS = ((53, 11), (42, 11), (31, 11), (20, 11), (10, 10), (0, 10))


def _finer_keys(fps: DataFrame) -> DataFrame:
    """A row for each choice of three blocks, with their bits."""
    block = [
        F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << bits) - 1)) for low, bits in _BLOCKS
    ]
    keys = [
        F.struct(F.lit(tag).alias("tag"), F.xxhash64(*[block[i] for i in chosen]).alias("bits"))
        for tag, chosen in enumerate(combinations(range(6), 3))
    ]
    return fps.withColumn("f", F.explode(F.array(*keys)))


def link_fingerprints(fps: DataFrame) -> DataFrame:
    """(fp, component): components of different fingerprints at most three bits apart.

    Fingerprints without a link are left out. ``fps`` has one row for each.
    """
    stored, probing = _keyed(fps, False), _keyed(fps, True)
    crowded = settle(stored.groupBy("k").count().filter(F.col("count") > PLAIN_MEMBERS).select("k"))
    any_crowded = crowded.limit(1).count() > 0
    plain_stored, plain_probing = stored, probing
    if any_crowded:
        hot = bounded_broadcast(crowded, 24)
        plain_stored = stored.join(hot, "k", "left_anti")
        plain_probing = probing.join(hot, "k", "left_anti")
    edges = (
        plain_stored.select("k", F.col("fp").alias("u"))
        .join(plain_probing.select("k", F.col("fp").alias("v")), "k")
        .filter((F.col("u") < F.col("v")) & _close("u", "v"))
        .select("u", "v")
        .distinct()
    )
    if not any_crowded:
        return components(edges).toDF("fp", "component")

    members = settle(stored.unionByName(probing).join(hot, "k", "left_semi").distinct())
    pivots = members.groupBy("k").agg(
        F.array_distinct(
            F.array(*[F.min_by("fp", F.xxhash64("fp", F.lit(i))) for i in range(PIVOTS)])
        ).alias("pivots")
    )
    to_pivots = (
        members.join(pivots, "k")
        .select("fp", F.filter("pivots", lambda p: F.bit_count(p.bitwiseXOR(F.col("fp"))) <= DISTANCE).alias("p"))
        .filter(F.size("p") > 0)
        .distinct()
        .select(F.col("fp").alias("u"), F.explode("p").alias("v"))
        .filter("u <> v")
    )
    known = settle(edges.unionByName(to_pivots))
    labels = components(known)
    finer = _finer_keys(
        members.select("fp").distinct()
        .join(labels.withColumnRenamed("node", "fp"), "fp", "left")
        .select("fp", F.coalesce("component", "fp").alias("label"))
    )
    by_label = finer.groupBy("f", "label").count()
    mixed = by_label.groupBy("f").agg(
        F.count("*").alias("labels"), F.max_by("label", F.struct("count", "label")).alias("leading")
    ).filter("labels > 1")
    rows = settle(finer.join(mixed.select("f", "leading"), "f"))
    outside = rows.filter("label <> leading").select("f", F.col("fp").alias("u"), F.col("label").alias("lu"))
    across = (
        rows.select("f", F.col("fp").alias("v"), F.col("label").alias("lv"))
        .join(outside, "f")
        .filter((F.col("lu") != F.col("lv")) & _close("u", "v"))
        .select("u", "v")
        .distinct()
    )
    return components(known.unionByName(across)).toDF("fp", "component")


def _labelled(docs: DataFrame, key: str, text: str, width: int) -> tuple[DataFrame, DataFrame]:
    """((key, fp) of every row, (fp, label) of every fingerprint)."""
    found = settle(fingerprints(docs, key, text, width))
    classes = settle(found.select("fp").distinct())
    linked = link_fingerprints(classes)
    return found, classes.join(linked, "fp", "left").select("fp", F.coalesce("component", "fp").alias("label"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """(key, fp, component_id): the smallest key reachable over links, for every row."""
    found, labelled = _labelled(docs, key, text, width)
    classes = found.groupBy("fp").agg(F.min(key).alias("first"))
    labelled = settle(classes.join(labelled, "fp"))
    smallest = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    resolved = settle(labelled.select("fp", "label").join(smallest, "label").select("fp", "component_id"))
    # a fingerprint may own a third of all rows: the lookup goes to the rows where it fits
    return found.join(bounded_broadcast(resolved, 40), "fp").select(key, "fp", "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """The rows of ``docs``, all columns: of each component the row with the smallest key.

    Rows are told apart by key and text, so rows of one key stay if their texts are in
    different components. Of equal rows one stays. Rows without a key all stay.
    """
    marked = docs.select(F.struct(F.col(key).alias("key"), F.xxhash64(text).alias("mark")).alias("place"), F.col(text).alias("text"))
    found, labelled = _labelled(marked.filter("place.key is not null"), "place", "text", width)
    classes = found.groupBy("fp").agg(F.min("place").alias("first")).join(labelled, "fp")
    return keep_first(docs, classes.groupBy("label").agg(F.min("first").alias("first")).select("first.key", "first.mark"), key, text)


def keep_first(docs: DataFrame, chosen: DataFrame, key: str, text: str) -> DataFrame:
    """The rows of ``docs`` chosen by (key, mark), mark being the hash of the text; one of equal ones, and those without a key."""
    chosen = settle(chosen)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(key).alias("key"), F.xxhash64(text).alias("mark"))
    kept = rows.join(bounded_broadcast(chosen, 48), ["key", "mark"], "left_semi")
    copies = settle(kept.groupBy("key", "mark").count().filter("count > 1").select("key", "mark"))
    if copies.limit(1).count():
        copies = bounded_broadcast(copies, 48)
        kept = kept.join(copies, ["key", "mark"], "left_anti").unionByName(
            kept.join(copies, ["key", "mark"], "left_semi").dropDuplicates(["key", "mark"])
        )
    return kept.unionByName(rows.filter("key is null")).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
