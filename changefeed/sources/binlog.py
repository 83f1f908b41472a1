"""Captured MySQL row-binlog events to change events.

Input: ``binlog(source, file, log_pos BIGINT, seq BIGINT, action, schema, table,
columns ARRAY<STRUCT<name, type>>, rows ARRAY<ARRAY<STRING>>, next_file, query)``
with an optional ``captured_at BIGINT`` (epoch ms). ``action`` is insert, update,
delete, ddl, xid or rotate; ``seq`` is the capture order of the source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changefeed.functions.payload import build_update
from changefeed.functions.positions import binlog_file_number, format_binlog_pos
from changefeed.functions.values import (
    json_key,
    json_object,
    mysql_kind,
    render_mysql_kind,
)
from changefeed.operators.envelope import EVENT_COLUMNS, make_event
from changefeed.operators.ordered import LOWEST, asof_join


ROW_ACTIONS = ["insert", "update", "delete"]


def stamp_binlog_file(
    binlog: DataFrame, initial: DataFrame | None = None, broadcast: bool = True
) -> DataFrame:
    """Set ``file`` to the newest ROTATE target at or before each event.

    A file the capture already recorded is kept. ``initial`` (``source, file``)
    is the file current before these events, from an earlier batch.
    """
    turns = binlog.filter(F.col("action") == "rotate").select(
        "source", "seq", F.col("next_file").alias("_file")
    )
    if initial is not None:
        turns = turns.unionByName(
            initial.select(
                "source", F.lit(LOWEST).alias("seq"), F.col("file").alias("_file")
            )
        )
    stamped = asof_join(binlog, turns, ["source"], ["seq"], ["_file"], broadcast)
    return stamped.withColumn(
        "file", F.coalesce(F.nullif(F.col("file"), F.lit("")), F.col("_file"))
    ).drop("_file")


def current_files(stamped: DataFrame) -> DataFrame:
    """Newest file per source, the ``initial`` of the next batch."""
    return (
        stamped.filter(F.col("file").isNotNull())
        .groupBy("source")
        .agg(F.max_by("file", "seq").alias("file"))
    )


def _row(columns: Column, row: Column) -> Column:
    # a row shorter than its columns ends in nulls
    return json_object(
        F.transform(
            columns,
            lambda c, i: F.concat(c["key"], render_mysql_kind(F.get(row, i), c["kind"])),
        )
    )


def decode_binlog(binlog: DataFrame) -> DataFrame:
    """Change events of captured binlog events whose ``file`` is known.

    One event per inserted or deleted row; update rows come in pairs of old and
    new, an odd row at the end yields no event (see ``binlog_rejects``).
    """
    if "captured_at" not in binlog.columns:
        binlog = binlog.withColumn("captured_at", F.unix_millis(F.current_timestamp()))
    action = F.col("action")
    size = F.coalesce(F.size("rows"), F.lit(0))
    nothing = F.lit(None).cast("array<string>")
    pairs = F.when(
        size >= 2,
        F.transform(
            F.sequence(F.lit(0), F.floor(size / 2).cast("int") - 1),
            lambda i: F.struct(
                F.get("rows", i * 2).alias("old"), F.get("rows", i * 2 + 1).alias("new")
            ),
        ),
    )
    singles = F.when(
        size >= 1,
        F.transform("rows", lambda r: F.struct(nothing.alias("old"), r.alias("new"))),
    )
    marker = F.array(F.struct(nothing.alias("old"), nothing.alias("new")))
    images = (
        F.when(action.isin("insert", "delete"), singles)
        .when(action == "update", pairs)
        .when(action.isin("ddl", "xid"), marker)
    )
    columns = F.transform(
        "columns",
        lambda c: F.struct(json_key(c["name"]).alias("key"), mysql_kind(c["type"]).alias("kind")),
    )
    rows = binlog.withColumn("_columns", columns).select(
        *[name for name in binlog.columns if name not in ("rows", "columns")],
        "_columns",
        F.posexplode(images).alias("idx", "_image"),
    )
    old = _row(F.col("_columns"), F.col("_image.old"))
    new = _row(F.col("_columns"), F.col("_image.new"))
    data = (
        F.when(action.isin("insert", "delete"), new)
        .when(action == "update", build_update(old, new))
        .when(action == "ddl", F.col("query"))
    )
    type_name = (
        F.when(action == "insert", "INSERT")
        .when(action == "update", "UPDATE")
        .when(action == "delete", "DELETE")
        .when(action == "ddl", "DDL")
        .otherwise("COMMIT")
    )
    is_row = action.isin("insert", "update", "delete")
    event = make_event(
        type_name,
        F.when(action != "xid", F.col("schema")),
        F.when(is_row, F.col("table")),
        data,
        F.when(is_row, format_binlog_pos(F.col("file"), F.col("log_pos"))),
        F.col("captured_at"),
    )
    return rows.select(
        "source",
        *[value.alias(name) for name, value in event.items()],
        binlog_file_number(F.col("file")).alias("pos_hi"),
        F.col("log_pos").cast("bigint").alias("pos_lo"),
        F.col("seq").cast("bigint").alias("seq"),
        "idx",
    ).select(*EVENT_COLUMNS)


def binlog_rejects(binlog: DataFrame) -> DataFrame:
    """What the events of ``decode_binlog`` do not hold, with the reason.

    An event of an unknown action, a row event without rows, the odd row at the end of
    an update, and a row with more values than columns, whose event holds the named
    ones only. ``payload`` is the row as a JSON array of its values.
    """
    action = F.col("action")
    size = F.coalesce(F.size("rows"), F.lit(0))
    is_update = action == "update"

    def judged(row, i):
        reason = F.when(is_update & (size % 2 == 1) & (i == size - 1), "old row without new row").when(
            F.size(row) > F.coalesce(F.size("columns"), F.lit(0)), "more values than columns"
        )
        return F.struct(
            F.when(is_update, F.floor(i / 2).cast("int")).otherwise(i).alias("idx"),
            F.to_json(row, {"ignoreNullFields": "false"}).alias("payload"), reason.alias("reject_reason"),
        )

    def whole(reason):
        return F.array(
            F.struct(F.lit(0).alias("idx"), F.lit(None).cast("string").alias("payload"), F.lit(reason).alias("reject_reason"))
        )

    known = F.coalesce(action.isin(*ROW_ACTIONS, "ddl", "xid", "rotate"), F.lit(False))
    bad = (
        F.when(~known, whole("unknown action"))
        .when(action.isin(ROW_ACTIONS) & (size == 0), whole("no rows"))
        .when(action.isin(ROW_ACTIONS), F.filter(F.transform("rows", judged), lambda r: r["reject_reason"].isNotNull()))
    )
    at = F.coalesce(format_binlog_pos(F.col("file"), F.col("log_pos")), F.lit(""))
    return binlog.withColumn("_bad", F.explode(bad)).select(
        "source", F.upper("action").alias("type"), "schema", "table", at.alias("lsn"),
        binlog_file_number(F.col("file")).alias("pos_hi"), F.col("log_pos").cast("bigint").alias("pos_lo"),
        F.col("seq").cast("bigint").alias("seq"), "_bad.idx", "_bad.payload", "_bad.reject_reason",
    )
