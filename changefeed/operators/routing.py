"""Delivery routes: everything, one table, or one tenant's prefix."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefeed.functions.subjects import DEFAULT_PREFIX, subject
from changefeed.operators.filters import table_events
from changefeed.operators.ordered import lookup_join


def route_all(df: DataFrame, subscriber: str) -> DataFrame:
    """A global subscriber gets every accepted event."""
    return df.withColumn("subscriber", F.lit(subscriber))


def route(df: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """One copy of each table event per subscriber of its table.

    ``subscriptions`` has ``subscriber`` and ``table``; with a ``schema`` column
    too, both must match.
    """
    on = ["table"] + (["schema"] if "schema" in subscriptions.columns else [])
    wanted = subscriptions.select("subscriber", *on)
    named = table_events(df).filter(F.col("table") != "")
    return lookup_join(named, wanted, on).select(*df.columns, "subscriber")


def add_subject(df: DataFrame, prefix: str = DEFAULT_PREFIX) -> DataFrame:
    return df.withColumn("subject", subject(F.col("schema"), F.col("table"), prefix))


def route_tenants(
    df: DataFrame,
    prefixes: DataFrame | Mapping[str, str],
    default: str = DEFAULT_PREFIX,
) -> DataFrame:
    """Subjects under each source's own prefix on one shared stream.

    ``prefixes`` maps ``source`` to ``prefix``, as a dict or as a table.
    """
    if isinstance(prefixes, Mapping):
        prefix = F.lit(default)
        for source, tenant in prefixes.items():
            prefix = F.when(F.col("source") == source, F.lit(tenant)).otherwise(prefix)
        named = df.withColumn("_prefix", prefix)
    else:
        table = prefixes.select("source", F.col("prefix").alias("_prefix"))
        named = lookup_join(df, table, ["source"], "left")
    lead = F.coalesce(F.col("_prefix"), F.lit(default))
    return named.withColumn(
        "subject", subject(F.col("schema"), F.col("table"), lead)
    ).drop("_prefix")
