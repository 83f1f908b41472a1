"""Heartbeats for quiet stretches of a captured feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changefeed.operators.envelope import make_event

# Fixed value: how long a source may be silent.
IDLE_MS = 30_000


def heartbeats(df: DataFrame, idle_ms: int = IDLE_MS) -> DataFrame:
    """One HEARTBEAT per full idle period between two messages of a source.

    A gap that long always crosses a boundary of the idle grid, so each grid
    cell is first reduced to its first and last message, on the map side. The
    window then runs over one row per cell: its size depends on the time
    covered, not on the number of messages.
    """
    cell = F.call_function("div", F.col("timestamp"), F.lit(idle_ms))
    cells = df.groupBy("source", cell.alias("_cell")).agg(
        F.min("timestamp").alias("_first"),
        F.max(F.struct("timestamp", "pos_hi", "pos_lo", "seq", "lsn")).alias("_last"),
    )
    by_time = Window.partitionBy("source").orderBy("_cell")
    gaps = cells.select(
        "source",
        F.col("_first").alias("_until"),
        F.lag("_last").over(by_time).alias("_prev"),
    ).filter(F.col("_until") - F.col("_prev.timestamp") >= idle_ms)
    beats = gaps.select(
        "source",
        "_prev",
        F.posexplode(
            F.sequence(
                F.col("_prev.timestamp") + F.lit(idle_ms), F.col("_until"), F.lit(idle_ms)
            )
        ).alias("_n", "_at"),
    )
    event = make_event("HEARTBEAT", lsn=F.col("_prev.lsn"), timestamp=F.col("_at"))
    return beats.select(
        "source",
        *[value.alias(name) for name, value in event.items()],
        F.col("_prev.pos_hi").alias("pos_hi"),
        F.col("_prev.pos_lo").alias("pos_lo"),
        F.col("_prev.seq").alias("seq"),
        (F.col("_n") + 1).alias("idx"),
    )
