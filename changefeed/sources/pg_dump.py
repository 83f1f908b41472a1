"""Plain-text Postgres dumps: COPY blocks to INSERT events.

Which block a line belongs to is decided by lines far above it, often in another
input split. Only the lines that open or may close a block are looked at first;
every other line then finds its block by position, without being shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changefeed.functions.json_text import json_quote
from changefeed.functions.values import json_key, json_object
from changefeed.operators.envelope import EVENT_COLUMNS, make_event
from changefeed.operators.filters import filter_tables
from changefeed.operators.ordered import asof_join, is_small, lookup_join, running_number
from changefeed.session import settle
from changefeed.sources.snapshot import IDENTIFIER, position_halves

# The block header, the closing line and the null mark.
COPY_HEADER = r"^COPY\s+(\S+)\.(\S+)\s+\(([^)]+)\)\s+FROM\s+stdin;"
COPY_END = "\\."
COPY_NULL = "\\N"

# COPY text escapes other than the backslash itself.
COPY_ESCAPES = [
    ("\\b", "\b"), ("\\f", "\f"), ("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t"),
    ("\\v", "\v"),
]


def read_lines(spark: SparkSession, path: str, pieces: bool = False) -> DataFrame:
    """Lines with their number in the whole dump: value, file, line (from 0).

    With ``pieces`` the files of a folder are pieces of one dump, cut between lines and in
    the order of their names, and ``file`` is the folder.

    Files follow each other by name. A first scan counts the lines of each split; a
    line's number is what splits before it hold and its place in its own, so it is the
    same however the files are cut, and no line is shuffled to be numbered. Both
    scans must cut the files alike; a line outside its split's count fails the query.
    """
    cut = (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.when(F.col("value").endswith("\r"), F.expr("left(value, length(value) - 1)"))
            .otherwise(F.col("value"))
            .alias("value"),
            F.col("_metadata.file_path").alias("_path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("_id"),
        )
    )
    # one row for each split
    splits = settle(cut.groupBy("_path", "block").agg(F.min("_id").alias("_first"), F.count("*").alias("_n")))
    before = Window.orderBy("_path", "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    place = F.col("_id") - F.col("_first")
    moved = F.raise_error(F.lit("input splits changed between two scans")).cast("bigint")
    line = F.when(place.between(0, F.col("_n") - 1), F.col("_start") + place).otherwise(moved)
    file = F.regexp_replace("_path", "/[^/]*$", "") if pieces else F.col("_path")
    return lookup_join(cut, starts, ["_path", "block"], "left").select("value", file.alias("file"), line.alias("line"))


def copy_blocks(lines: DataFrame) -> DataFrame:
    """Where each COPY block opens and closes (``open`` false), with its header.

    Inside a block everything up to the closing line is data, even text that
    looks like a header, so of the headers between two closing lines only the
    first one opens a block.
    """
    is_header = F.col("value").rlike(COPY_HEADER)
    marks = settle(
        lines.filter(is_header | (F.col("value") == COPY_END)).withColumn(
            "_ends", F.col("value") == COPY_END
        )
    )
    order = ["line"]
    ends = marks.filter("_ends")
    if is_small(marks):
        by_file = Window.partitionBy("file").orderBy(*order)
        known = marks.withColumn(
            "_epoch",
            F.sum(F.col("_ends").cast("int")).over(
                by_file.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            ),
        )
    else:
        counted = running_number(
            ends.select("file", *order), ["file"], order, "_epoch"
        )
        known = asof_join(marks, counted, ["file"], order, ["_epoch"], broadcast=False)
        known = known.withColumn("_epoch", F.coalesce("_epoch", F.lit(0)))
    opened = (
        known.filter(~F.col("_ends"))
        .groupBy("file", "_epoch")
        .agg(F.min(F.struct(*order, "value")).alias("_at"))
        .select("file", "_at.*", F.lit(True).alias("open"))
    )
    closed = ends.select("file", *order, "value", F.lit(False).alias("open"))
    header = [F.regexp_extract("value", COPY_HEADER, i) for i in (1, 2, 3)]
    names = F.transform(F.split(header[2], ","), lambda c: F.trim(c))
    return opened.unionByName(closed).select(
        "file",
        *order,
        "open",
        header[0].alias("schema"),
        header[1].alias("table"),
        F.when(F.col("open"), names).alias("names"),
    )


def _unescape(text: Column) -> Column:
    # Cut at escaped backslashes first, so what follows one is not an escape.
    def part(piece: Column) -> Column:
        for old, new in COPY_ESCAPES:
            piece = F.replace(piece, F.lit(old), F.lit(new))
        return piece

    whole = F.array_join(F.transform(F.split(text, r"\\\\"), part), "\\")
    return F.when(text.contains("\\"), whole).otherwise(text)


def _copy_row(value: Column, names: Column, raw: bool) -> Column:
    fields = F.split(value, "\t")

    def member(name: Column, i: Column) -> Column:
        field = F.get(fields, i)
        text = field if raw else _unescape(field)
        shown = F.when(field.isNull() | (field == COPY_NULL), "null").otherwise(json_quote(text))
        return F.concat(json_key(name), shown)

    return json_object(F.transform(names, member))


def _dump_rows(spark: SparkSession, path: str, pieces: bool) -> DataFrame:
    lines = read_lines(spark, path, pieces)
    blocks = copy_blocks(lines)
    blocks = blocks.withColumn("mark", F.col("line"))
    placed = asof_join(lines, blocks, ["file"], ["line"], ["open", "schema", "table", "names", "mark"])
    # header and closing lines find themselves
    inside = F.col("open") & ~F.col("mark").eqNullSafe(F.col("line"))
    return placed.filter(inside).drop("mark")


def _good_names() -> Column:
    return F.col("schema").rlike(IDENTIFIER) & F.col("table").rlike(IDENTIFIER)


def read_pg_dump(
    spark: SparkSession,
    path: str,
    start_lsn: str = "",
    tables: Iterable[str] | None = None,
    source: str = "",
    raw: bool = False,
    timestamp: Column | None = None,
    pieces: bool = False,
) -> DataFrame:
    """One INSERT event per data line of every COPY block.

    Values are quoted texts with COPY escapes decoded, or as written with
    ``raw``; short lines end in nulls, surplus values are dropped. ``seq`` is the line's
    number in the whole dump, the same for any size of splits. ``pieces`` as for ``read_lines``.
    """
    rows = filter_tables(_dump_rows(spark, path, pieces).filter(_good_names()), tables)
    data = _copy_row(F.col("value"), F.col("names"), raw)
    event = make_event(
        "INSERT", F.col("schema"), F.col("table"), data, start_lsn, timestamp
    )
    hi, lo = position_halves(F.lit(start_lsn))
    return rows.select(
        F.lit(source).alias("source"),
        *[value.alias(name) for name, value in event.items()],
        hi.alias("pos_hi"),
        lo.alias("pos_lo"),
        F.col("line").alias("seq"),
        F.lit(0).alias("idx"),
    ).select(*EVENT_COLUMNS)


def pg_dump_rejects(spark: SparkSession, path: str, pieces: bool = False) -> DataFrame:
    """Data lines of blocks whose schema or table is no plain identifier."""
    return (
        _dump_rows(spark, path, pieces)
        .filter(~_good_names())
        .select(
            "file", "line", "schema", "table", "value",
            F.lit("invalid identifier").alias("reject_reason"),
        )
    )
