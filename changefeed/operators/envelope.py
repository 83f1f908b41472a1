"""The change-event envelope: columns, construction, JSON out and JSON in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changefeed.functions.json_text import is_valid_json
from changefeed.functions.subjects import DEFAULT_PREFIX, subject
from changefeed.session import compute_once

# The event types.
EVENT_TYPES = [
    "BEGIN", "COMMIT", "INSERT", "UPDATE", "DELETE", "DDL", "TRUNCATE", "HEARTBEAT",
]
TABLE_EVENT_TYPES = ["INSERT", "UPDATE", "DELETE", "TRUNCATE"]
PUBLISHED_TYPES = ["INSERT", "UPDATE", "DELETE", "DDL", "TRUNCATE"]

# Columns that are published, in order, and the columns that only order a feed.
ENVELOPE = [
    "type", "schema", "table", "data", "rawMessage", "lsn", "timestamp",
    "sourceTimestamp",
]
FEED_ORDER = ["source", "pos_hi", "pos_lo", "seq", "idx"]
EVENT_COLUMNS = ["source", *ENVELOPE, "pos_hi", "pos_lo", "seq", "idx"]

_ENVELOPE_SCHEMA = (
    "type string, schema string, `table` string, data string, rawMessage string, "
    "lsn string, timestamp bigint, sourceTimestamp bigint, _corrupt string"
)


def _text(value: Column | str | None) -> Column:
    if value is None:
        return F.lit("")
    column = F.lit(value) if isinstance(value, str) else value
    return F.coalesce(column.cast("string"), F.lit(""))


def make_event(
    type: Column | str,
    schema: Column | str | None = None,
    table: Column | str | None = None,
    data: Column | str | None = None,
    lsn: Column | str | None = None,
    timestamp: Column | None = None,
    source_timestamp: Column | None = None,
    raw_message: Column | str | None = None,
) -> dict[str, Column]:
    """Envelope columns of an event, created now unless ``timestamp`` is given."""
    kind = F.lit(type) if isinstance(type, str) else type
    now = F.unix_millis(F.current_timestamp())
    return {
        "type": kind,
        "schema": _text(schema),
        "table": _text(table),
        "data": _text(data),
        "rawMessage": kind if raw_message is None else _text(raw_message),
        "lsn": _text(lsn),
        "timestamp": now if timestamp is None else F.coalesce(timestamp, now),
        "sourceTimestamp": F.lit(0).cast("bigint")
        if source_timestamp is None
        else F.coalesce(source_timestamp, F.lit(0)).cast("bigint"),
    }


def to_envelope_json() -> Column:
    """The published JSON text of the event in the current row.

    Empty optional texts are left out; schema and both times are always there.
    """
    optional = {"table", "data", "rawMessage", "lsn"}
    times = {"timestamp", "sourceTimestamp"}
    fields = []
    for name in ENVELOPE:
        value = F.col(name)
        if name in optional:
            value = F.nullif(value, F.lit(""))
        elif name in times:
            value = F.coalesce(value, F.lit(0))
        else:
            value = F.coalesce(value, F.lit(""))
        fields.append(value.alias(name))
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "true"})


def to_messages(df: DataFrame, prefix: Column | str = DEFAULT_PREFIX, keep: list[str] | None = None) -> DataFrame:
    """Events as ``key`` (subject), ``value`` (envelope JSON) and ``headers``.

    This is the row shape message-bus sinks of Spark expect; ``keep`` columns stay beside it.
    """
    address = subject(F.col("schema"), F.col("table"), prefix)
    headers = F.array(
        F.struct(F.lit("type").alias("key"), F.encode("type", "UTF-8").alias("value")),
        F.struct(F.lit("lsn").alias("key"), F.encode("lsn", "UTF-8").alias("value")),
    )
    return df.select(
        address.alias("key"), to_envelope_json().alias("value"), headers.alias("headers"), *(keep or [])
    )


def read_envelope(df: DataFrame, value: str = "value") -> DataFrame:
    """Decode envelope JSON beside the other columns; adds ``envelope_error``.

    A text that is no JSON, or whose type is not one of the known eight, keeps
    its row with the reason and null fields.
    """
    kept = [name for name in df.columns if name not in ENVELOPE]
    parsed = F.from_json(
        F.col(value),
        _ENVELOPE_SCHEMA,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"},
    )
    rows = compute_once(df, value, F.col(value))
    rows = compute_once(rows, "_env", parsed)
    env = F.col("_env")
    broken = (
        env["_corrupt"].isNotNull() | ~is_valid_json(F.col(value)) | env.isNull()
    )
    error = F.when(broken, F.lit("not an event envelope")).when(
        ~F.coalesce(env["type"].isin(EVENT_TYPES), F.lit(False)),
        F.concat(F.lit("unknown event type: "), F.coalesce(env["type"], F.lit(""))),
    )
    rows = compute_once(rows, "envelope_error", error)
    good = F.col("envelope_error").isNull()
    times = {"timestamp", "sourceTimestamp"}
    fields = [
        F.when(
            good,
            F.coalesce(env[name], F.lit(0) if name in times else F.lit("")),
        ).alias(name)
        for name in ENVELOPE
    ]
    return rows.select(*kept, *fields, "envelope_error")


def parse_envelope(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(events, rejected) from envelope JSON texts."""
    rows = read_envelope(df, value)
    good = rows.filter(F.col("envelope_error").isNull()).drop("envelope_error")
    bad = rows.filter(F.col("envelope_error").isNotNull()).drop(*ENVELOPE)
    return good, bad


def event_time(df: DataFrame) -> DataFrame:
    """Add ``event_time`` for callers who want watermarks or time windows."""
    return df.withColumn("event_time", F.timestamp_millis("timestamp"))
