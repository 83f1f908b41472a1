"""Row events of all layout versions, shown in the newest layout of their table.

A column of the newest layout takes the value of the row's column of its name. If the
row's layout had no such name but another name, gone since, at the same position, the
column was renamed and takes that value. Otherwise it was added later and is null;
columns that the newest layout lacks are left out. A value whose column changed between
number and text is shown as the newest type; a text that is no number stays quoted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changefeed.functions.json_text import json_quote
from changefeed.functions.payload import build_update
from changefeed.functions.values import JSON, NUMBER, TEXT, json_key, json_object, pg_kind
from changefeed.operators.envelope import EVENT_COLUMNS
from changefeed.operators.ordered import lookup_join

_TABLE = ["source", "schema", "table"]
_NUMERIC = r"^-?[0-9]+(\.[0-9]+)?([eE][-+]?[0-9]+)?$"


def newest_columns(history: DataFrame) -> DataFrame:
    """(source, schema, table, _columns, _now, _kinds, _unique): names and kinds of the newest layout (see ``latest_schema``)."""
    shown = F.transform("columns", lambda c: F.struct(c["name"].alias("name"), pg_kind(c["typeOid"]).alias("kind")))
    newest = history.groupBy(*_TABLE).agg(F.max_by("columns", F.struct("lsn_pos", "seq")).alias("columns"))
    names = F.col("_columns.name")
    return newest.select(*_TABLE, shown.alias("_columns")).select(
        "*", names.alias("_now"), F.col("_columns.kind").alias("_kinds"), (F.size(F.array_distinct(names)) == F.size(names)).alias("_unique")
    )


def _retyped(value: Column, kind: Column) -> Column:
    inner = F.substr(value, F.lit(2), F.length(value) - 2)
    quoted = value.startswith('"')
    bare = ~quoted & (value != "null")
    return (
        F.when((kind == NUMBER) & quoted & inner.rlike(_NUMERIC), inner)
        .when((kind == TEXT) & bare, json_quote(value))
        .when((kind != JSON) & (kind != NUMBER) & bare & value.rlike(_NUMERIC), json_quote(value))
        .otherwise(value)
    )


def in_newest_layout(images: DataFrame, history: DataFrame) -> DataFrame:
    """Rows of ``decode_images`` with ``data`` and ``unchanged_cols`` in the newest layout.

    ``history`` holds the announced layouts (see ``schema_history``). Rows of a table
    without one stay as they are.
    """
    rows = lookup_join(images, newest_columns(history), _TABLE, "left")
    # most rows are in the newest layout already: nothing of them is worked out again
    same = F.lit(False)
    if "kinds" in images.columns:
        whole = F.size("members") == F.size("names")
        old_whole = F.col("old_members").isNull() | (F.size("old_members") == F.size("names"))
        same = F.coalesce(
            F.col("_unique") & F.col("names").eqNullSafe(F.col("_now")) & F.col("kinds").eqNullSafe(F.col("_kinds")) & whole & old_whole,
            F.lit(False),
        )
    # where each newest column lies in the row's own layout
    place = F.transform(
        "_now",
        lambda name, j: F.when(F.array_position("names", name) > 0, F.array_position("names", name).cast("int") - 1)
        .when(~F.array_contains(F.col("_now"), F.get("names", j)), j),
    )
    rows = rows.withColumn("_same", same | F.col("_columns").isNull()).withColumn("_place", F.when(~F.col("_same"), place))

    def image(members: str) -> Column:
        # values first: retyping looks at one several times
        values = F.transform(
            "_place",
            lambda at: F.substr(F.get(members, at), F.length(json_key(F.get("names", at))) + 1),
        )

        def shown(value, j):
            column = F.get("_columns", j)
            return F.concat(json_key(column["name"]), F.coalesce(_retyped(value, column["kind"]), F.lit("null")))

        return json_object(F.transform(values, shown))

    new = image("members")
    old = F.when(F.col("old_members").isNotNull(), image("old_members"))
    data = F.when(F.col("type") == "UPDATE", build_update(old, new)).otherwise(new)
    held = F.filter(
        F.col("_now"),
        lambda name, j: F.coalesce(F.array_contains("unchanged_cols", F.get("names", F.get("_place", j))), F.lit(False)),
    )
    return rows.withColumns({
        "data": F.when(F.col("_same"), F.col("data")).otherwise(data),
        "unchanged_cols": F.when(F.col("_same"), F.col("unchanged_cols")).otherwise(held),
    }).select(*EVENT_COLUMNS, "old_kind", "unchanged_cols")
