"""Table snapshots: reading tables in parallel, chunk numbers and row events."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changefeed.functions.json_text import is_valid_json, json_quote
from changefeed.functions.positions import binlog_file_number, lsn_high, lsn_low, parse_lsn
from changefeed.functions.values import json_key, json_object, quoted_or_null
from changefeed.operators.envelope import EVENT_COLUMNS, make_event
from changefeed.operators.ordered import number_rows, running_number
from changefeed.operators.rank_select import rows_at, selectable

# Fixed value: rows per snapshot chunk unless the caller says otherwise.
CHUNK_ROWS = 10_000

IDENTIFIER = r"^[a-zA-Z_][a-zA-Z0-9_]*$"


def check_identifier(name: str) -> str:
    if not re.fullmatch(IDENTIFIER[1:-1], name or ""):
        raise ValueError(f"invalid identifier: {name!r}")
    return name


def jdbc_tables(spark: SparkSession, url: str, schema: str, properties=None) -> list[str]:
    """Base tables of a schema, by name."""
    check_identifier(schema)
    query = (
        "(SELECT table_name FROM information_schema.tables WHERE table_schema = "
        f"'{schema}' AND table_type = 'BASE TABLE') t"
    )
    names = spark.read.jdbc(url, query, properties=properties or {})
    return [row[0] for row in names.toDF("name").orderBy("name").collect()]


def jdbc_read_options(
    schema: str,
    table: str,
    pk: list[str] | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 64,
    hash_function: str = "MOD(ABS(HASHTEXT(CAST({row} AS TEXT))), {n})",
) -> dict:
    """Arguments that make a JDBC read split into ``partitions`` queries.

    An integer key with bounds is cut into ranges. Otherwise every partition
    takes one hash bucket of the row, named by ``hash_function``.
    """
    name = f'"{check_identifier(schema)}"."{check_identifier(table)}"'
    for column in pk or []:
        check_identifier(column)
    if pk and bounds is not None:
        return {
            "table": name,
            "column": f'"{pk[0]}"',
            "lowerBound": bounds[0],
            "upperBound": bounds[1] + 1,
            "numPartitions": partitions,
        }
    row = f'"{table}"' if not pk else "CONCAT_WS(',', " + ", ".join(f'"{c}"' for c in pk) + ")"
    bucket = hash_function.format(row=row, n=partitions)
    return {"table": name, "predicates": [f"{bucket} = {i}" for i in range(partitions)]}


def snapshot_jdbc(
    spark: SparkSession,
    url: str,
    schema: str,
    table: str,
    pk: list[str] | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 64,
    properties: dict | None = None,
) -> DataFrame:
    """A table read over JDBC in parallel; columns and types are the table's."""
    options = jdbc_read_options(schema, table, pk, bounds, partitions)
    return spark.read.jdbc(url, properties=properties or {}, **options)


def keyset_chunks(df: DataFrame, pk: list[str], n: int = CHUNK_ROWS) -> DataFrame:
    """Add ``chunk_id``: rows in key order, ``n`` per chunk.

    All key columns order the rows, so no chunk edge can fall between rows that
    only share the first one.
    """
    kind = df.schema[pk[0]].dataType
    if len(pk) == 1 and isinstance(kind, (T.LongType, T.IntegerType, T.ShortType)):
        # a unique integer key: its own value cuts the table into even segments
        wide = df.withColumn("_key", F.col(pk[0]).cast("bigint"))
        numbered = running_number(wide, [], ["_key"], "_row").drop("_key")
    else:
        numbered = number_rows(df, pk, "_row")
    return _chunk(numbered, n)


def offset_chunks(df: DataFrame, n: int = CHUNK_ROWS) -> DataFrame:
    """Chunks of a table without a key, ordered on its first column.

    Ties are settled by the other columns, so the chunks are repeatable.
    """
    return _chunk(number_rows(df, df.columns, "_row"), n)


def numbered_rows(df: DataFrame, name: str = "row_no") -> DataFrame:
    """Number the rows of a table without a key, in the order of all its columns."""
    return number_rows(df, df.columns, name)


def _chunk(numbered: DataFrame, n: int) -> DataFrame:
    chunk = F.call_function("div", F.col("_row") - 1, F.lit(n))
    return numbered.withColumn("chunk_id", chunk).drop("_row")


def next_chunk(
    df: DataFrame, pk: list[str], after: list | None = None, n: int = CHUNK_ROWS
) -> DataFrame:
    """The ``n`` rows that follow a key, in key order."""
    rows = df
    if after is not None:
        last = F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(pk, after)])
        # the first column alone can reach the scan
        rows = rows.filter(F.col(pk[0]) >= F.lit(after[0])).filter(F.struct(*pk) > last)
    return rows.orderBy(*pk).limit(n)


def chunk_at(df: DataFrame, offset: int, n: int = CHUNK_ROWS) -> DataFrame:
    """``n`` rows after skipping ``offset``, ordered on the first column, then the others.

    The edges are found by rank selection, so nothing is sorted but the ``n`` rows. A
    table with columns of nested types is sorted.
    """
    if not selectable(df, df.columns):
        return df.orderBy(*df.columns).offset(offset).limit(n)
    return rows_at(df, offset, n).orderBy(*df.columns)


def _typed(field: T.StructField) -> Column:
    """A value as a live event would show it."""
    value = F.col(f"`{field.name}`")
    text = value.cast("string")
    if isinstance(field.dataType, (T.IntegralType, T.FractionalType)):
        shown = text
    elif isinstance(field.dataType, T.BooleanType):
        shown = F.when(value, "true").otherwise("false")
    elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
        shown = F.to_json(value, {"ignoreNullFields": "false"})
    elif field.metadata.get("json"):
        shown = F.when(is_valid_json(text), text).otherwise(json_quote(text))
    else:
        shown = json_quote(text)
    return F.when(value.isNull(), "null").otherwise(shown)


def row_image(df: DataFrame, typed: bool = False) -> Column:
    """The current row as object text, every value quoted unless ``typed``."""
    members = [
        F.concat(
            json_key(F.lit(field.name)),
            _typed(field) if typed else quoted_or_null(F.col(f"`{field.name}`")),
        )
        for field in df.schema
    ]
    return json_object(F.array(*members))


def rows_to_events(
    df: DataFrame,
    schema: str,
    table: str,
    source: str = "",
    typed: bool = False,
    timestamp: Column | None = None,
    lsn: str = "",
    keep: list[str] | None = None,
    number: str | None = None,
) -> DataFrame:
    """One INSERT event per row; ``keep`` columns stay beside the event.

    ``lsn`` is the log position the snapshot was taken at, if known. ``number`` names
    a column that becomes ``seq`` and tells equal rows apart (see ``numbered_rows``).
    """
    kept = keep or []
    image = df.drop(*kept, *([number] if number else []))
    event = make_event("INSERT", schema, table, row_image(image, typed), lsn, timestamp)
    hi, lo = position_halves(F.lit(lsn))
    return df.select(
        F.lit(source).alias("source"),
        *[value.alias(name) for name, value in event.items()],
        hi.alias("pos_hi"),
        lo.alias("pos_lo"),
        (F.col(number) if number else F.lit(0)).cast("bigint").alias("seq"),
        F.lit(0).alias("idx"),
        *kept,
    ).select(*EVENT_COLUMNS, *kept)


def position_halves(lsn: Column) -> tuple[Column, Column]:
    """Ordering halves of a position text of either kind; null when unknown."""
    at = parse_lsn(lsn)
    file_pos = r"^(.*):([0-9]+)$"
    hi = F.coalesce(lsn_high(at), binlog_file_number(F.regexp_extract(lsn, file_pos, 1)))
    lo = F.coalesce(lsn_low(at), F.regexp_extract(lsn, file_pos, 2).try_cast("bigint"))
    return hi, lo
