"""Decoding captured logs micro-batch by micro-batch.

What a later batch needs from earlier ones is kept in small tables, one folder
per batch. A batch reads only what earlier batches stored, so running it again
gives the same events.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefeed.functions.positions import combined_position
from changefeed.operators.transactions import assign_transactions
from changefeed.sources.binlog import binlog_rejects, current_files, decode_binlog, stamp_binlog_file
from changefeed.sources.wal import RELATION_SCHEMA, changed_layouts, decode_messages, read_relations
from changefeed.streaming.publish import load_state, store_state, with_rejects

# Events alone, events and rejected messages, or both in one table with a ``reject_reason``.
Prepare = Callable[[DataFrame, int], DataFrame | tuple[DataFrame, DataFrame]]

FILE_SCHEMA = "source string, file string"
TX_SCHEMA = "source string, tx_no bigint, tx_timestamp bigint"


def _newest_layouts(rows: DataFrame) -> DataFrame:
    """The layout of each relation announced last."""
    newest = F.max_by(F.struct("timestamp", "namespace", "name", "columns"), F.struct("lsn_pos", "seq"))
    at = F.max(F.struct("lsn_pos", "seq"))
    return rows.groupBy("source", "rel_id").agg(newest.alias("_v"), at.alias("_at")).select(
        "source", "_at.lsn_pos", "_at.seq", "_v.timestamp", "rel_id", "_v.namespace", "_v.name", "_v.columns"
    )


def _last_of(*columns: str) -> Callable[[DataFrame], DataFrame]:
    """Each source's values from the latest batch."""

    def newest(rows: DataFrame) -> DataFrame:
        last = F.max_by(F.struct(*columns), "batch_id")
        return rows.groupBy("source").agg(last.alias("_v")).select("source", "_v.*")

    return newest


def wal_decoder(
    catalogue: str, tables: Iterable[str] | None = None, capture_ddl: bool = False
) -> Prepare:
    """``prepare`` for captured Postgres messages; layouts live in ``catalogue``.

    New layouts are stored before the rows are decoded, so a layout and its rows
    may arrive in one batch. Repeated announcements are not stored: the catalogue
    grows with schema changes only. Messages that yield no event have a ``reject_reason``.
    """

    def prepare(batch: DataFrame, batch_id: int) -> DataFrame:
        spark = batch.sparkSession
        earlier = load_state(spark, catalogue, RELATION_SCHEMA, before=batch_id).drop("batch_id")
        new = changed_layouts(read_relations(batch, with_cut=True), earlier)
        store_state(new, catalogue, batch_id, RELATION_SCHEMA, _newest_layouts)
        # all changes of this batch, not only the last ones
        known = earlier.unionByName(spark.read.schema(RELATION_SCHEMA).parquet(f"{catalogue}/batch_id={batch_id}"))
        return decode_messages(batch, known, tables, capture_ddl)

    return prepare


def binlog_decoder(state: str) -> Prepare:
    """``prepare`` for captured binlog events; current files live in ``state``. Gives events and rejects."""

    def prepare(batch: DataFrame, batch_id: int) -> tuple[DataFrame, DataFrame]:
        spark = batch.sparkSession
        earlier = load_state(spark, state, FILE_SCHEMA, before=batch_id)
        initial = earlier.groupBy("source").agg(F.max_by("file", "batch_id").alias("file"))
        stamped = stamp_binlog_file(batch, initial)
        rotated = current_files(
            stamped.withColumn(
                "file",
                F.when(F.col("action") == "rotate", F.col("next_file")).otherwise(F.col("file")),
            )
        )
        store_state(rotated, state, batch_id, FILE_SCHEMA, _last_of("file"))
        return decode_binlog(stamped), binlog_rejects(stamped)

    return prepare


def framed(state: str, inner: Prepare | None = None, boundary: str = "BEGIN") -> Prepare:
    """Wrap a ``prepare`` so that transaction numbers go on across batches."""

    def prepare(batch: DataFrame, batch_id: int) -> DataFrame | tuple[DataFrame, DataFrame]:
        spark = batch.sparkSession
        events, rejects = with_rejects(inner(batch, batch_id) if inner else batch)
        earlier = load_state(spark, state, TX_SCHEMA, before=batch_id)
        initial = (
            earlier.groupBy("source")
            .agg(F.max_by(F.struct("tx_no", "tx_timestamp"), "batch_id").alias("_t"))
            .select("source", "_t.*")
        )
        rows = assign_transactions(events, boundary, initial)
        if boundary == "BEGIN":
            opened = F.col("tx_no")
        else:
            # a commit itself still belongs to the transaction it ends
            opened = F.col("tx_no") + (F.col("type") == boundary).cast("int")
        at = F.struct(combined_position(F.col("pos_hi"), F.col("pos_lo")), "seq", "idx")
        latest = (
            rows.filter(F.col("pos_hi").isNotNull())
            .groupBy("source")
            .agg(F.max_by(F.struct(opened.alias("tx_no"), "tx_timestamp"), at).alias("_t"))
            .select("source", "_t.*")
        )
        store_state(latest, state, batch_id, TX_SCHEMA, _last_of("tx_no", "tx_timestamp"))
        return rows if rejects is None else (rows, rejects)

    return prepare
