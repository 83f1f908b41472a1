"""Heartbeats of a running stream: a timer per source."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from changefeed.operators.heartbeats import IDLE_MS

BEAT_SCHEMA = (
    "source string, type string, schema string, `table` string, data string, "
    "rawMessage string, lsn string, timestamp bigint, sourceTimestamp bigint, "
    "pos_hi bigint, pos_lo bigint, seq bigint, idx int"
)
_NEWEST = "source string, pos_hi bigint, pos_lo bigint, seq bigint, lsn string"
_AT = ["pos_hi", "pos_lo", "seq"]


def _newest_per_source(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    # One row per source and input batch: the stateful step never sees all rows.
    for frame in frames:
        ordered = frame.sort_values(_AT, kind="stable")
        yield ordered.drop_duplicates("source", keep="last")


def heartbeat_stream(df: DataFrame, idle_ms: int = IDLE_MS) -> DataFrame:
    """HEARTBEAT events for sources that stay silent, by processing time.

    Each message resets its source's timer; a timer that runs out emits an event
    at the newest known position and starts again.
    """

    def on_source(
        key: tuple, frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        newest = state.get if state.exists else None
        if state.hasTimedOut:
            hi, lo, seq, lsn, beats = newest
            state.update((hi, lo, seq, lsn, beats + 1))
            state.setTimeoutDuration(idle_ms)
            now = state.getCurrentProcessingTimeMs()
            yield pd.DataFrame(
                [(key[0], "HEARTBEAT", "", "", "", "HEARTBEAT", lsn, now, 0,
                  hi, lo, seq, beats + 1)],
                columns=["source", "type", "schema", "table", "data", "rawMessage", "lsn",
                         "timestamp", "sourceTimestamp", "pos_hi", "pos_lo", "seq", "idx"],
            )
            return
        for frame in frames:
            for row in frame.itertuples(index=False):
                at = (int(row.pos_hi), int(row.pos_lo), int(row.seq))
                if newest is None or at >= tuple(newest[:3]):
                    newest = (*at, row.lsn, 0)
        if newest is not None:
            state.update(tuple(newest))
        state.setTimeoutDuration(idle_ms)
        return

    narrow = df.filter("pos_hi is not null and pos_lo is not null").select(
        "source", "pos_hi", "pos_lo", "seq", "lsn"
    )
    return (
        narrow.mapInPandas(_newest_per_source, _NEWEST)
        .groupBy("source")
        .applyInPandasWithState(
            on_source,
            BEAT_SCHEMA,
            "pos_hi bigint, pos_lo bigint, seq bigint, lsn string, beats int",
            "append",
            GroupStateTimeout.ProcessingTimeTimeout,
        )
    )
