"""Schema changes as events and as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the table an event trigger writes schema changes to.
DDL_LOG_TABLE = "_cdc_ddl_log"

DDL_LOG_SCHEMA = (
    "id string, command_tag string, object_type string, schema_name string, "
    "object_identity string, query string"
)


def is_ddl_row(type: Column, table: Column) -> Column:
    return (type == "INSERT") & (table == DDL_LOG_TABLE)


def intercept_ddl(df: DataFrame) -> DataFrame:
    """Turn inserts into the DDL log table into DDL events without a table.

    Run it before a table filter, or the filter drops them.
    """
    hit = is_ddl_row(F.col("type"), F.col("table"))
    return df.withColumns(
        {
            "type": F.when(hit, "DDL").otherwise(F.col("type")),
            "table": F.when(hit, "").otherwise(F.col("table")),
            "rawMessage": F.when(hit, "DDL").otherwise(F.col("rawMessage")),
        }
    )


def ddl_log(df: DataFrame) -> DataFrame:
    """DDL events as typed log rows; a drop has no query.

    Events whose data is plain SQL text keep it in ``query``.
    """
    events = df.filter(F.col("type") == "DDL")
    row = F.from_json("data", DDL_LOG_SCHEMA)
    plain = ~F.ltrim(F.col("data")).startswith("{")
    named = [
        row[name].alias(name)
        for name in ("command_tag", "object_type", "schema_name", "object_identity")
    ]
    return events.select(
        *[name for name in ("source", "schema", "lsn", "timestamp", "pos_hi", "pos_lo",
                            "seq", "idx") if name in df.columns],
        *named,
        F.when(plain, F.col("data")).otherwise(row["query"]).alias("query"),
    )
