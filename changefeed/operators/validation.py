"""The payload gate: table events must carry valid JSON or none."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefeed.functions.json_text import is_valid_json
from changefeed.operators.envelope import TABLE_EVENT_TYPES
from changefeed.session import compute_once

INVALID_DATA = "invalid JSON data"


def _passes():
    data = F.coalesce(F.col("data"), F.lit(""))
    exempt = ~F.col("type").isin(TABLE_EVENT_TYPES) | (data == "")
    # the parser runs only where neither exemption applies
    return F.when(exempt, True).otherwise(is_valid_json(data))


def accepted(df: DataFrame) -> DataFrame:
    return compute_once(df, "data", F.col("data")).filter(_passes())


def rejected(df: DataFrame) -> DataFrame:
    """The quarantine side, with ``reject_reason``."""
    bad = compute_once(df, "data", F.col("data")).filter(~_passes())
    return bad.withColumn("reject_reason", F.lit(INVALID_DATA))


def validate(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected); together they are all rows."""
    return accepted(df), rejected(df)
