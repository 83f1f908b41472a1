"""Benchmark decontamination by a broadcast set of normalised word n-grams.

Words are runs of digits, letters a-z (after lower-casing A-Z) and characters
beyond ASCII. A window is ``n`` consecutive words of a benchmark item; an item
of fewer words, but not none, is one window. Texts are turned into word numbers
of the benchmark's own vocabulary, so only stretches made of its words are
looked at, and a window found there is compared number by number, which is word
by word: a hit is exact, not a hash match.

Cases: a null or empty text has no words, no hits and is kept; items whose id or
text is null, or that have no words, are left out; repeated items count once by
id; repeated documents are judged each for itself; with no items nothing is hit.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefeed.llm.common import utf8
from changefeed.session import settle

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

# Items go out in blocks of about this many bytes of text; each block is one pass.
BLOCK_BYTES = 8 * 1024 * 1024


class Windows:
    """The windows of one block of items, ready to be looked up."""

    def __init__(self, items: list[tuple[int, str]], n: int):
        self.vocabulary: dict[bytes, int] = {}
        self.owners: dict[bytes, list[int]] = {}
        lengths = set()
        number = self.vocabulary.setdefault
        for item, text in items:
            ids = np.array(
                [number(w, len(self.vocabulary) + 1) for w in WORD.findall(text.encode().lower())], np.int32
            )
            width = min(n, len(ids))
            for start in range(len(ids) - width + 1 if width else 0):
                owners = self.owners.setdefault(ids[start : start + width].tobytes(), [])
                if item not in owners:
                    owners.append(item)
            if width:
                lengths.add(width)
        self.lengths = sorted(lengths)

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Word ranges covered by windows, merged and in order, and the items found."""
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        if not words or not self.lengths:
            return spans, items
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int32, len(words))
        known = np.concatenate(([0], ids > 0, [0])).astype(np.int8)
        edges = np.flatnonzero(np.diff(known))
        for start, end in zip(edges[::2], edges[1::2]):
            if end - start < self.lengths[0]:
                continue
            for width in self.lengths:
                for at in range(start, end - width + 1):
                    owners = self.owners.get(ids[at : at + width].tobytes())
                    if owners:
                        items.update(owners)
                        spans.append((int(at), int(at + width)))
        return merged(spans), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def item_blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> list[list[tuple[int, str]]]:
    """The items in blocks of bounded size, fetched one block at a time."""
    good = benchmark.select(F.col(item).alias("item"), F.col(text).alias("text")).dropna()
    size = good.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // block_bytes + 1
    for k in range(blocks):
        mine = good.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k)
        yield [(r["item"], r["text"]) for r in mine.collect()]


FOUND = "struct<n_words: bigint, spans: array<struct<s: int, e: int>>, items: array<bigint>>"
_FOUND = pa.struct(
    [
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))),
        ("items", pa.list_(pa.int64())),
    ]
)


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text", n: int = 13, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(key, text, n_words, spans, items): word ranges hit and the items they come from.

    One pass over the documents for each block of items; the usual benchmark is
    one block. Between passes the rows are settled, so that no task holds more
    than one block.
    """
    spark = docs.sparkSession
    out = docs.select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.lit(None).cast(FOUND).alias("found")
    )
    schema = out.schema
    for k, items in enumerate(item_blocks(benchmark, item, item_text, block_bytes)):
        shared = spark.sparkContext.broadcast(items)

        def scan(batches, shared=shared):
            windows = Windows(shared.value, n)
            for batch in batches:
                rows = []
                for raw, before in zip(utf8(batch.column(1)), batch.column(2)):
                    before = before.as_py()
                    words = WORD.findall(raw.lower()) if raw else []
                    spans, owners = windows.scan(words)
                    if before:
                        spans = merged(spans + [(x["s"], x["e"]) for x in before["spans"]])
                        owners |= set(before["items"])
                    rows.append(
                        {"n_words": len(words), "spans": [{"s": s, "e": e} for s, e in spans], "items": sorted(owners)}
                    )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(rows, _FOUND)], names=["key", "text", "found"]
                )

        out = (settle(out) if k else out).mapInArrow(scan, schema)
    return out.select(F.col("key").alias(key), F.col("text").alias(text), "found.*")


def judge(found: DataFrame) -> DataFrame:
    """Add n_hit (words hit) and contaminated (at least a twentieth of the words hit)."""
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, x: total + x["e"] - x["s"])
    return found.withColumn("n_hit", hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.lit(20) * F.col("n_hit") >= F.col("n_words"))
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", n: int = 13, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, without contaminated documents.

    Documents with fewer hits than the rule asks for stay as they are. A benchmark of
    one block is one pass in which rows go through once and whole.
    """
    names = docs.columns
    blocks = item_blocks(benchmark, "item_id", "text", block_bytes)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        shared, place = docs.sparkSession.sparkContext.broadcast(first), names.index(text)

        def clean(batches):
            windows = Windows(shared.value, n)
            for whole in batches:
                for at in range(0, whole.num_rows, 512):
                    batch = whole.slice(at, 512)
                    yield batch.filter(pa.array([not _contaminated(raw, windows) for raw in utf8(batch.column(place))], pa.bool_()))

        return docs.mapInArrow(clean, docs.schema)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(text).alias("body"))
    judged = judge(find_contamination(whole, benchmark, key="row", text="body", n=n, block_bytes=block_bytes))
    return judged.filter(~F.col("contaminated")).select(*[F.col("row").getField(c).alias(c) for c in names])


def _contaminated(raw: bytes | None, windows: Windows) -> bool:
    words = WORD.findall(raw.lower()) if raw else []
    hit = sum(e - s for s, e in windows.scan(words)[0])
    return hit > 0 and 20 * hit >= len(words)


def remove_spans(found: DataFrame) -> DataFrame:
    """The texts with the words of every hit cut out, and the blanks before them."""

    def cut(batches):
        for batch in batches:
            texts = []
            for raw, spans in zip(utf8(batch.column("text")), batch.column("spans")):
                spans = spans.as_py()
                if raw and spans:
                    at = [m.span() for m in WORD.finditer(raw.lower())]
                    kept, last = [], 0
                    for x in spans:
                        kept.append(raw[last : at[x["s"]][0]].rstrip(b" "))
                        last = at[x["e"] - 1][1]
                    raw = b"".join([*kept, raw[last:]])
                texts.append(raw)
            index = batch.schema.get_field_index("text")
            yield batch.set_column(index, "text", pa.array(texts, pa.binary()).cast(pa.string()))

    return found.mapInArrow(cut, found.schema)
