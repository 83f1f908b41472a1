r"""Line dedup over content-defined chunks of lines.

A text is split at ``\n``. Each line has a hash; a rolling hash over ``WINDOW``
line hashes, modulo ``MODULUS``, ends a chunk where it is 0 modulo ``DIVISOR``, so boundaries depend
on nearby lines alone and move along with inserted or removed lines. Of equal
chunks of at least ``MIN_LINES`` lines anywhere in the table, the first one (by
document id, then position) stays and all others are removed. Hashes only choose
what is compared: chunks count as equal when their texts are.

Work: hashes of chunks are counted with partial sums before the shuffle; only
texts whose hash repeats are grouped by text; a chunk with millions of copies is
one row per task by then.

A chunk's boundaries depend on its lines, so the head and tail of a repeated run
that lie in chunks with other lines stay in ``remove_repeated`` (its rule is fixed
by the SQL of op2). ``dedup_lines``, the pipeline's stage, has no chunks: windows of
``MIN_LINES`` neighbouring lines that hold a word begin at every line, and all but
the first of equal ones (equal 128-bit BLAKE2 digests) go, which together are the
whole repeated runs. Blank lines between removed lines go along.

Cases: a null text has no lines and stays null; an empty text is one empty line;
rows that agree in id and text count as one document and get the same result; a
null id comes before all others.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefeed.llm.common import BROADCAST_BYTES, bounded_broadcast, utf8
from changefeed.session import settle

WINDOW, DIVISOR, MIN_LINES = 2, 3, 2
# Multiplier and modulus of the rolling hash, both prime and no multiples of the divisor.
FACTOR, MODULUS = 31, 1_000_003


def with_chunks(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text, lines, chunks): each chunk is (idx, n, body)."""
    df = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    df = df.withColumn("lines", F.explode(F.expr(
        r"array(case when text is null then cast(array() as array<string>) else split(text, '\n', -1) end)"
    )))
    df = df.withColumn("h", F.explode(F.expr(
        "array(transform(lines, l -> cast(conv(substring(md5(l), 1, 8), 16, 10) as bigint)))"
    )))
    rolling = " + ".join(f"{FACTOR ** d} * h[k - {d}]" for d in range(WINDOW))
    df = df.withColumn("ends", F.explode(F.expr(
        f"""array(case when size(lines) = 0 then cast(array() as array<int>) else
            filter(sequence(0, size(lines) - 1),
                   k -> k = size(lines) - 1 or (k >= {WINDOW - 1} and ({rolling}) % {MODULUS} % {DIVISOR} = 0)) end)"""
    ))).drop("h")
    df = df.withColumn("chunks", F.explode(F.expr(
        r"""array(transform(ends, (e, i) -> named_struct(
            'idx', i, 'n', e - if(i = 0, -1, ends[i - 1]),
            'body', array_join(slice(lines, if(i = 0, 1, ends[i - 1] + 2), e - if(i = 0, -1, ends[i - 1])), '\n'))))"""
    )))
    return df.drop("ends")


def repeated_chunks(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, mark, gone): indices of the chunks to remove; mark is the hash of the text."""
    chunks = (
        with_chunks(docs, key, text)
        .select("key", F.xxhash64("text").alias("mark"), F.explode("chunks").alias("c"))
        .filter(f"c.n >= {MIN_LINES}")
        .select("key", "mark", F.col("c.idx").alias("idx"), F.col("c.body").alias("body"), F.xxhash64("c.body").alias("h"))
    )
    hashes = settle(chunks.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h"))
    place = F.struct("key", "mark", "idx")
    likely = settle(chunks.join(bounded_broadcast(hashes, 24), "h", "left_semi"))
    # texts are compared here: the group is the chunk itself, one row per task and text after partial sums
    first = (
        likely.groupBy("body").agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .filter("not (first <=> last)").select("body", "first", F.xxhash64("body").alias("h"))
    )
    first = settle(first)
    small = first.agg(F.sum(F.octet_length("body") + 64)).first()[0] or 0
    if small <= 16 * 1024 * 1024:
        first = F.broadcast(first)
    return (
        likely.join(first, ["h", "body"])
        .filter(~place.eqNullSafe(F.col("first")))
        .groupBy("key", "mark")
        .agg(F.collect_set("idx").alias("gone"))  # at most the chunks of one document
    )


def remove_repeated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, n_lines, n_chunks, removed, removed_lines): texts without repeated chunks."""
    gone = settle(repeated_chunks(docs, key, text).select(F.col("key").alias("_k"), F.col("mark").alias("_m"), "gone"))
    rows = with_chunks(docs, key, text).withColumn("mark", F.xxhash64("text"))
    same = (F.col("key").eqNullSafe(F.col("_k"))) & (F.col("mark") == F.col("_m"))
    joined = rows.join(bounded_broadcast(gone, 128), same, "left")
    none = F.expr("cast(array() as array<int>)")
    judged = joined.withColumn("gone", F.coalesce("gone", none)).select(
        F.col("key").alias(key),
        F.expr(
            r"""case when size(gone) = 0 then text else
                array_join(transform(filter(chunks, c -> not array_contains(gone, c.idx)), c -> c.body), '\n') end"""
        ).alias(text),
        F.size("lines").cast("bigint").alias("n_lines"),
        F.size("chunks").cast("bigint").alias("n_chunks"),
        F.size("gone").cast("bigint").alias("removed"),
        F.expr("cast(aggregate(filter(chunks, c -> array_contains(gone, c.idx)), 0, (a, c) -> a + c.n) as bigint)").alias("removed_lines"),
    )
    return judged


def _pairs(docs: DataFrame, key: str, text: str, places: bool) -> DataFrame:
    """A row for each ``MIN_LINES`` neighbouring lines that hold a word: (h), or (key, mark, at, h, digest)."""
    named = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
    empty = named.select("key", "mark", F.lit(0).alias("at"), F.lit(0).cast("bigint").alias("h"), F.lit(b"").alias("digest"))
    schema = empty.schema if places else empty.select("h").schema

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                owner, at, digests = [], [], []
                for row, raw in enumerate(utf8(part.column(2))):
                    for start, digest in line_windows(raw):
                        owner.append(row)
                        at.append(start)
                        digests.append(digest)
                h = pa.array(np.frombuffer(b"".join(digests), "<i8")[::2])
                if not places:
                    yield pa.RecordBatch.from_arrays([h], names=["h"])
                    continue
                owner = pa.array(owner, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(owner), part.column(1).take(owner), pa.array(at, pa.int32()), h, pa.array(digests, pa.binary())],
                    names=["key", "mark", "at", "h", "digest"],
                )

    return named.mapInArrow(run, schema)


def line_windows(raw: bytes | None):
    """(first line, 128-bit digest) of each ``MIN_LINES`` neighbouring lines that hold a word."""
    lines = raw.split(b"\n") if raw else []
    for at in range(len(lines) - MIN_LINES + 1):
        body = b"\n".join(lines[at : at + MIN_LINES])
        if not body.isspace():
            yield at, blake2b(body, digest_size=16).digest()


def without_lines(text: str, starts: list[int]) -> str:
    """``text`` without the lines of the windows at ``starts`` and the blank lines between removed ones."""
    lines = text.split("\n")
    gone = np.zeros(len(lines), bool)
    for d in range(MIN_LINES):
        gone[np.asarray(starts) + d] = True
    kept, blank = [], []
    after_gone = False
    for line, out in zip(lines, gone.tolist()):
        if out:
            if not after_gone:
                kept += blank
            blank, after_gone = [], True
        elif not line.strip():
            blank.append(line)
        else:
            kept += [*blank, line]
            blank, after_gone = [], False
    return "\n".join(kept + blank)


def repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, mark, gone): where the windows of lines start that stand earlier in the table too."""
    hashes = settle(_pairs(docs, key, text, False).groupBy("h").count().filter("count > 1").select("h"))
    likely = settle(_pairs(docs, key, text, True).join(bounded_broadcast(hashes, 24), "h", "left_semi").drop("h"))
    place = F.struct("key", "mark", "at")
    first = settle(
        likely.groupBy("digest").agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .filter("not (first <=> last)").select("digest", "first")
    )
    return (
        likely.join(bounded_broadcast(first, 96), "digest")
        .filter(~place.eqNullSafe(F.col("first")))
        .groupBy("key", "mark")
        .agg(F.collect_set("at").alias("gone"))  # at most the lines of one document
    )


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, without repeated runs of lines; ``n_chars`` follows if there is one.

    Every run of at least ``MIN_LINES`` lines that stands earlier in the table goes
    as a whole, wherever it begins and ends.
    """
    gone = settle(repeated_lines(docs, key, text).select(F.col("key").alias("_k"), F.col("mark").alias("_m"), "gone"))
    if (gone.agg(F.sum(4 * F.size("gone") + 64)).first()[0] or 0) <= BROADCAST_BYTES:
        gone = F.broadcast(gone)

    @F.arrow_udf("string")
    def shorten(texts: pa.Array, starts: pa.Array) -> pa.Array:
        return pa.array(
            [None if g is None else without_lines(t, g) for t, g in zip(texts.to_pylist(), starts.to_pylist())], pa.string()
        )

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(key).alias("id"), F.xxhash64(text).alias("mark"))
    same = (F.col("id").eqNullSafe(F.col("_k"))) & (F.col("mark") == F.col("_m"))
    joined = rows.join(gone, same, "left").select("row", "gone")
    body = F.col("row").getField(text)
    joined = joined.withColumn("short", shorten(F.when(F.col("gone").isNotNull(), body), F.col("gone")))
    out = []
    for c in docs.columns:
        value = F.col("row").getField(c)
        if c == text:
            value = F.when(F.col("gone").isNull(), value).otherwise(F.col("short"))
        elif c == "n_chars":
            value = F.when(F.col("gone").isNull(), value).otherwise(F.length("short")).cast(docs.schema[c].dataType)
        out.append(value.alias(c))
    return joined.select(*out)
