"""Acknowledged positions, resuming from them, and checking what arrived."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefeed.operators.ordered import lookup_join

EVENT_KEY = ["source", "pos_hi", "pos_lo", "seq", "idx"]


def _identified(df: DataFrame) -> DataFrame:
    """Add ``_content``: what tells rows without a log position (snapshots, dumps) apart."""
    content = F.struct(*[F.col(f"`{c}`").cast("string").alias(c) for c in ("schema", "table", "data") if c in df.columns])
    return df.withColumn("_content", F.when(F.col("pos_hi").isNull(), F.to_json(content)))


def acked_positions(df: DataFrame) -> DataFrame:
    """Furthest delivered position of each source; empty positions are ignored."""
    at = F.struct("pos_hi", "pos_lo", "lsn")
    return (
        df.filter((F.col("lsn") != "") & F.col("pos_hi").isNotNull())
        .groupBy("source")
        .agg(F.max(at).alias("_at"))
        .select(
            "source",
            F.col("_at.lsn").alias("lsn"),
            F.col("_at.pos_hi").alias("pos_hi"),
            F.col("_at.pos_lo").alias("pos_lo"),
        )
    )


def resume_from(
    df: DataFrame,
    acked: DataFrame,
    default: str = "latest",
    current: DataFrame | None = None,
) -> DataFrame:
    """Events not yet acknowledged.

    A source without an acknowledged position starts after its position in
    ``current`` (``source, pos_hi, pos_lo``, the log's end when the job starts); in
    neither table, it has nothing to replay. With ``default="earliest"`` it starts with
    everything.
    """
    if default not in ("earliest", "latest"):
        raise ValueError(f"unknown start: {default!r}")
    starts = acked.select("source", F.struct("pos_hi", "pos_lo").alias("_after"))
    if default == "latest" and current is not None:
        fallback = current.select("source", F.struct("pos_hi", "pos_lo").alias("_now"))
        starts = starts.join(fallback, "source", "full").select(
            "source", F.coalesce("_after", "_now").alias("_after")
        )
    rows = lookup_join(df, starts, ["source"], "left")
    here = F.struct("pos_hi", "pos_lo")
    fresh = F.col("_after").isNull() if default == "earliest" else F.lit(False)
    # without a position nothing can have been acknowledged
    unplaced = F.col("pos_hi").isNull()
    return rows.filter(fresh | unplaced | (here > F.col("_after"))).select(*df.columns)


def delivery_audit(expected: DataFrame, delivered: DataFrame) -> DataFrame:
    """Per source: events expected, copies delivered, distinct and missing.

    Copies are counted per event before anything is compared, so an event
    delivered very often costs one row. Events without a position that are equal in
    all (rows of a table without a key) are told apart by number: of three expected
    and two delivered one is missing.
    """
    key = [*EVENT_KEY, "_content"]
    want = _identified(expected).select(*key, F.lit(1).alias("_want"), F.lit(0).alias("_copies"))
    got = _identified(delivered).select(*key, F.lit(0).alias("_want"), F.lit(1).alias("_copies"))
    # grouping, unlike a join, brings null positions together
    both = want.unionByName(got).groupBy(*key).agg(
        F.when(F.col("pos_hi").isNull(), F.sum("_want")).otherwise(F.max("_want")).alias("_want"), F.sum("_copies").alias("_copies")
    )
    wanted, copies = F.col("_want"), F.col("_copies")
    once = F.greatest(wanted, F.lit(1))
    return both.groupBy("source").agg(
        F.sum(wanted).alias("expected"),
        F.sum(copies).alias("delivered"),
        F.sum(F.least(copies, once)).alias("distinct_delivered"),
        F.sum(F.greatest(copies - once, F.lit(0))).alias("duplicates"),
        F.sum(F.greatest(wanted - copies, F.lit(0))).alias("missing"),
        F.count_if(wanted == 0).alias("unexpected"),
    )


def drop_redelivered(df: DataFrame) -> DataFrame:
    """One copy of each event; on a stream, set a watermark first.

    Equal rows of a snapshot without a key are one event here unless the snapshot
    numbered them (``rows_to_events(..., number=)``); lines of dumps have numbers.
    """
    rows, key = _identified(df), [*EVENT_KEY, "_content"]
    kept = rows.dropDuplicatesWithinWatermark(key) if df.isStreaming else rows.dropDuplicates(key)
    return kept.drop("_content")
