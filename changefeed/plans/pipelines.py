"""The three end-to-end pipelines, composed from the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefeed.functions.positions import combined_position
from changefeed.functions.subjects import DEFAULT_PREFIX
from changefeed.operators.bootstrap import bootstrap
from changefeed.operators.ddl import intercept_ddl
from changefeed.operators.filters import listed_tables, publishable
from changefeed.operators.routing import add_subject
from changefeed.operators.validation import accepted
from changefeed.sources.binlog import decode_binlog, stamp_binlog_file
from changefeed.sources.wal import decode_wal


def deliverable(events: DataFrame, prefix: str = DEFAULT_PREFIX) -> DataFrame:
    """The common tail: valid, publishable events with their subject."""
    return add_subject(publishable(accepted(events)), prefix)


def live_postgres(
    wal: DataFrame,
    relations: DataFrame | None = None,
    tables: Iterable[str] | None = None,
    capture_ddl: bool = False,
    prefix: str = DEFAULT_PREFIX,
) -> DataFrame:
    """Captured Postgres messages to deliverable events."""
    return deliverable(decode_wal(wal, relations, tables, capture_ddl), prefix)


def live_mysql(
    binlog: DataFrame,
    tables: Iterable[str] | None = None,
    prefix: str = DEFAULT_PREFIX,
    initial: DataFrame | None = None,
) -> DataFrame:
    """Captured binlog events to deliverable events.

    ``tables`` are exact ``schema.table`` names; DDL always passes.
    """
    listed = list(tables or ())
    if listed:
        # before the file is stamped: what is dropped here is never shuffled
        is_row = F.col("action").isin("insert", "update", "delete")
        binlog = binlog.filter(~is_row | listed_tables(listed, qualified=True))
    stamped = stamp_binlog_file(binlog, initial)
    return deliverable(decode_binlog(stamped), prefix)


def start_feed(
    snapshot: DataFrame | None,
    live: DataFrame,
    key: list[str] | None = None,
    tables: Iterable[str] | None = None,
    capture_ddl: bool = False,
    prefix: str = DEFAULT_PREFIX,
) -> DataFrame:
    """Snapshot or dump rows followed by live events, ready to deliver."""
    events = bootstrap(snapshot, live, key)
    if capture_ddl:
        events = intercept_ddl(events)
    kept = events
    if tables:
        is_ddl = F.col("type") == "DDL"
        kept = events.filter(is_ddl | listed_tables(tables))
    return deliverable(kept, prefix)


def subject_counts(events: DataFrame, prefix: str = DEFAULT_PREFIX) -> DataFrame:
    """Delivered events, newest time and furthest position per subject and type."""
    return (
        deliverable(events, prefix)
        .groupBy("subject", "type")
        .agg(
            F.count("*").alias("events"),
            F.max("timestamp").alias("last_timestamp"),
            F.max(combined_position(F.col("pos_hi"), F.col("pos_lo"))).alias("last_pos"),
        )
    )
