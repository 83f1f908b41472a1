"""Event counts, in batch and attached to a running query."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from changefeed.operators.envelope import EVENT_TYPES
from changefeed.operators.filters import publishable
from changefeed.operators.validation import rejected


def event_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("type").agg(F.count("*").alias("events"))


def published_counts(df: DataFrame) -> DataFrame:
    return event_counts(publishable(df))


def reject_count(df: DataFrame) -> DataFrame:
    """How many events were kept out of delivery."""
    return rejected(df).agg(F.count("*").alias("failed"))


def observe_events(df: DataFrame, name: str | Observation = "events") -> DataFrame:
    """Count events by type while the query runs; read them from its progress."""
    counts = [
        F.count_if(F.col("type") == kind).alias(kind.lower()) for kind in EVENT_TYPES
    ]
    return df.observe(name, F.count("*").alias("total"), *counts)
