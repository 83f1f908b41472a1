"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A lookup is broadcast below this size; each has another way beyond it.
BROADCAST_BYTES = 32 * 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Send rows with whole texts to Python a few at a time: a batch is held by the JVM and the worker at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")


def ascii_lower(text):
    """Lower-case A-Z alone, as a column."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def utf8(column: pa.Array) -> Iterator[bytes | None]:
    """The UTF-8 bytes of each text of an Arrow column, one at a time."""
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        column = column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary())
    for value in column:
        yield value.as_py()


def in_parts(rows: Iterable[tuple], names: list[str], types: list[pa.DataType], size: int = 20_000):
    """Record batches of at most ``size`` rows from an iterator of tuples."""
    held: list[tuple] = []
    schema = pa.schema(list(zip(names, types)))

    def batch():
        columns = list(zip(*held)) if held else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], schema=schema)

    for row in rows:
        held.append(row)
        if len(held) == size:
            yield batch()
            held = []
    if held:
        yield batch()


def bounded_broadcast(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df`` marked for broadcast if its rows, of ``row_bytes`` each, fit the bound; else as it is."""
    most = BROADCAST_BYTES // row_bytes
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
