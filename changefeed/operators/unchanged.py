"""Values that an update did not send, filled in from earlier messages.

A stored value too large to be sent again with every update is marked "unchanged".
The last value of the same row and column, from any earlier image of the log, takes its
place. Only narrow cells (row key, column, position, value text) of columns that ever
were left out are moved, by the as-of join that cuts a hot key into segments.

Cases: a value never seen in this log stays "unchanged" and in ``unchanged_cols``; a
row whose key columns were not all sent, or of a table without a listed key, stays as
it is; an update that changes the key looks under its old key, and what it finds counts
from then on under the new one; images after a DELETE start anew, for an INSERT sends
every column; events without a position stay.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changefeed.functions.payload import build_update
from changefeed.functions.positions import combined_position
from changefeed.functions.values import json_key, json_object
from changefeed.operators.envelope import EVENT_COLUMNS
from changefeed.operators.ordered import asof_join, is_small
from changefeed.session import settle

_PLACE = ["_pos", "seq", "idx"]
_CELL = ["source", "schema", "table", "_key", "_name"]


def _key_text(members: Column, key: Column) -> Column:
    """The members of the key columns as one text; null unless all were sent."""
    found = F.filter(
        members,
        lambda m: F.exists(key, lambda k: m.startswith(json_key(k))) & ~m.endswith(':"unchanged"'),
    )
    return F.when((F.size(key) > 0) & (F.size(found) == F.size(key)), F.array_join(F.array_sort(found), ","))


def fill_unchanged(images: DataFrame, key: Mapping[str, list[str]]) -> DataFrame:
    """Events of ``decode_images`` with the values their updates left out.

    ``key`` lists the key columns of each table. The result has the event columns,
    ``old_kind`` and the ``unchanged_cols`` that are left.
    """
    keys = F.array().cast("array<string>")
    for table, columns in key.items():
        keys = F.when(F.col("table") == table, F.array(*[F.lit(c) for c in columns])).otherwise(keys)
    rows = images.withColumns({
        "_pos": combined_position(F.col("pos_hi"), F.col("pos_lo")),
        "_new": _key_text(F.col("members"), keys),
        "_old": _key_text(F.col("old_members"), keys),
    })
    cells = F.transform(F.col("names"), lambda n, i: F.struct(n.alias("name"), F.get("members", i).alias("member")))
    listed = rows.filter("type in ('INSERT', 'UPDATE') and _pos is not null and _new is not null").select(
        "source", "schema", "table", *_PLACE, "_new", F.coalesce("_old", "_new").alias("_before"), "unchanged_cols",
        F.explode(cells).alias("_c"),
    )
    # an array that names columns, not values
    left_out = F.array_contains("unchanged_cols", F.col("_c.name"))
    narrow = listed.select(
        "source", "schema", "table", *_PLACE, "_new", "_before", F.col("_c.name").alias("_name"),
        F.col("_c.member").alias("_member"), left_out.alias("_out"),
    )
    asked = settle(narrow.filter("_out").drop("_member", "_out"))
    columns = asked.select("source", "schema", "table", "_name").distinct()
    columns = F.broadcast(columns) if is_small(columns) else columns
    given = settle(
        narrow.filter("not _out and _member is not null").join(columns, ["source", "schema", "table", "_name"], "left_semi")
        .select("source", "schema", "table", F.col("_new").alias("_key"), "_name", *_PLACE, "_member")
    )
    open_ = asked.withColumn("_key", F.col("_before"))
    found = None
    while True:
        filled = settle(
            asof_join(open_, given, _CELL, _PLACE, ["_member"], broadcast=False, inclusive=False)
        )
        known = filled.filter("_member is not null")
        found = known if found is None else found.unionByName(known)
        # a value found under an old key lives on under the new one, which later rows may ask for
        moved = known.filter("_new <> _before").select(
            "source", "schema", "table", F.col("_new").alias("_key"), "_name", *_PLACE, "_member"
        )
        if moved.isEmpty():
            break
        given = moved
        open_ = filled.filter("_member is null").drop("_member")
    values = found.groupBy("source", *_PLACE).agg(
        F.map_from_entries(F.collect_list(F.struct("_name", "_member"))).alias("_found")  # of one row
    )
    wanting = (F.size("unchanged_cols") > 0) & F.col("_pos").isNotNull()
    joined = rows.filter(wanting).join(values, ["source", *_PLACE], "left")
    whole = rows.filter(~F.coalesce(wanting, F.lit(False))).withColumn("_found", F.lit(None).cast("map<string,string>"))
    both = joined.select(whole.columns).unionByName(whole)
    members = F.transform(
        F.col("members"), lambda m, i: F.coalesce(F.try_element_at("_found", F.get("names", i)), m)
    )
    image = json_object(members)
    old = F.when(F.col("old_members").isNotNull(), json_object(F.col("old_members")))
    changed = F.col("_found").isNotNull()
    data = F.when(changed & (F.col("type") == "UPDATE"), build_update(old, image)).when(changed, image).otherwise(F.col("data"))
    still = F.filter("unchanged_cols", lambda c: F.coalesce(~F.map_contains_key("_found", c), F.lit(True)))
    return both.withColumns({"data": data, "unchanged_cols": still}).select(*EVENT_COLUMNS, "old_kind", "unchanged_cols")
