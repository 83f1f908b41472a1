"""Starting a feed from a snapshot and merging feeds."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefeed.functions.payload import payload_field
from changefeed.operators.envelope import EVENT_COLUMNS

SNAPSHOT_MODES = ("none", "chunked", "backup_file")


def snapshot_mode(mode: str | None, chunked=None, backup_file=None) -> DataFrame | None:
    """Pick the snapshot for a mode; the other two are thunks never called."""
    chosen = mode or "none"
    if chosen not in SNAPSHOT_MODES:
        raise ValueError(f"unknown snapshot mode: {mode!r}")
    if chosen == "none":
        return None
    thunk = chunked if chosen == "chunked" else backup_file
    if thunk is None:
        raise ValueError(f"snapshot mode {chosen!r} needs a source")
    return thunk()


def row_key(key: list[str] | Mapping[str, list[str]]):
    """Key values of the row an event is about, as one text array; null without a whole key.

    The newest image counts: ``new`` of an update, else the row itself. A map names
    the columns for each table, by ``schema.table`` or by the bare name.
    """
    def pick(name: str):
        new = payload_field(F.col("data"), f"$.new['{name}']")
        old = payload_field(F.col("data"), f"$.old['{name}']")
        flat = payload_field(F.col("data"), f"$['{name}']")
        return F.when(F.col("type") == "UPDATE", F.coalesce(new, old)).otherwise(flat)

    def whole(names: list[str]):
        picked = F.array(*[pick(name) for name in names])
        return F.when(~F.exists(picked, lambda value: value.isNull()), picked)

    if not isinstance(key, Mapping):
        return whole(key)
    found = F.lit(None).cast("array<string>")
    for table in sorted(key, key=lambda name: "." in name):
        if key[table]:
            named = F.concat_ws(".", "schema", "table") if "." in table else F.col("table")
            found = F.when(named == table, whole(key[table])).otherwise(found)
    return found


def _partial(live: DataFrame):
    """Whether an image lacks a stored value that was not sent."""
    marked = F.col("data").contains(':"unchanged"')
    if "unchanged_cols" in live.columns:
        marked = F.coalesce(F.size("unchanged_cols") > 0, marked)
    return (F.col("type") != "DELETE") & F.coalesce(marked, F.lit(False))


def bootstrap(
    snapshot: DataFrame | None,
    live: DataFrame,
    key: list[str] | Mapping[str, list[str]] | None = None,
) -> DataFrame:
    """Snapshot rows followed by live events.

    The log position is taken before the snapshot, so a row may be in both. With
    ``key``, for all tables or as a map from table to columns, the live event wins
    and the snapshot row is left out. Snapshot rows stay where their table has no
    key, a key value is missing or null, or the live images are all partial: the
    snapshot then holds the only copy of a value.
    """
    partial = _partial(live)
    changed = live.filter(F.col("type").isin("INSERT", "UPDATE", "DELETE") & ~partial)
    live = live.select(*EVENT_COLUMNS).withColumn("from_snapshot", F.lit(False))
    if snapshot is None:
        return live
    base = snapshot.select(*EVENT_COLUMNS).withColumn("from_snapshot", F.lit(True))
    if key:
        on = ["source", "schema", "table", "_key"]
        changed = (
            changed.withColumn("_key", row_key(key)).filter("_key is not null").select(*on).distinct()
        )
        base = base.withColumn("_key", row_key(key)).join(changed, on, "left_anti")
        base = base.drop("_key")
    return base.unionByName(live)


def merge_feeds(feeds: Mapping[str, DataFrame]) -> DataFrame:
    """Several databases in one feed, each named by ``source``."""
    named = [feed.withColumn("source", F.lit(name)) for name, feed in feeds.items()]
    return reduce(lambda a, b: a.unionByName(b), named)
