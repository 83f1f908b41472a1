"""Captured Postgres logical-replication messages to change events.

Input: ``wal(source STRING, lsn BIGINT, seq BIGINT, payload BINARY)`` with an
optional ``captured_at BIGINT`` (epoch ms). ``lsn`` is the position after the
message. The message layouts are those of the public protocol documentation.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changefeed.functions.json_text import bare_quote, json_quote
from changefeed.functions.payload import build_update
from changefeed.functions.positions import (
    format_lsn,
    lsn_high,
    lsn_low,
    pg_micros_to_epoch_ms,
)
from changefeed.functions.values import (
    json_key,
    json_object,
    pg_kind,
    positional_key,
    render_pg_cell,
)
from changefeed.operators.ddl import DDL_LOG_TABLE
from changefeed.operators.envelope import EVENT_COLUMNS, make_event
from changefeed.operators.log_scan import carry_along
from changefeed.operators.ordered import asof_join, is_small
from changefeed.session import settle
from changefeed.sources.tuples import row_tuples

# Message type bytes.
BEGIN, COMMIT, RELATION, INSERT, UPDATE, DELETE, TRUNCATE = "B", "C", "R", "I", "U", "D", "T"
ROW_MESSAGES = [INSERT, UPDATE, DELETE]
KNOWN_MESSAGES = [BEGIN, COMMIT, INSERT, UPDATE, DELETE, TRUNCATE]

UNKNOWN_RELATION = "unknown relation"
CUT_SHORT = "truncated message"

REJECT_COLUMNS = [
    "source", "type", "rel_id", "lsn", "pos_hi", "pos_lo", "seq", "idx", "payload", "reject_reason",
]

RELATION_SCHEMA = (
    "source string, lsn_pos bigint, seq bigint, timestamp bigint, rel_id bigint, "
    "namespace string, name string, "
    "columns array<struct<name: string, typeName: string, typeOid: bigint>>"
)


def _byte(payload: Column, at) -> Column:
    return F.substring(payload, at, 1).cast("string")


def _unsigned(payload: Column, at, width: int) -> Column:
    digits = F.hex(F.substring(payload, at, width))
    return F.conv(digits, 16, 10).try_cast("bigint")


def message_type(payload: Column) -> Column:
    return _byte(payload, 1)


def _with_capture_time(wal: DataFrame) -> DataFrame:
    if "captured_at" in wal.columns:
        return wal
    return wal.withColumn("captured_at", F.unix_millis(F.current_timestamp()))


# --- relations -------------------------------------------------------------


def _relation_fields(body: bytes) -> tuple[int, str, str, list[dict]]:
    """Fields of one RELATION message body (after the type byte)."""
    (rel_id,) = struct.unpack_from(">I", body)
    namespace, name, tail = body[4:].split(b"\0", 2)
    (count,) = struct.unpack_from(">H", tail, 1)
    columns, rest = [], tail[3:]
    for _ in range(count):
        label, rest = rest[1:].split(b"\0", 1)
        oid, _ = struct.unpack_from(">Ii", rest)
        columns.append(
            {"name": label.decode("utf-8", "replace"), "typeName": None, "typeOid": oid}
        )
        rest = rest[8:]
    return rel_id, namespace.decode("utf-8", "replace"), name.decode("utf-8", "replace"), columns


def _layout_or_nothing(payload: bytes) -> tuple:
    """Fields of a RELATION message; of one cut short at most its id."""
    try:
        return _relation_fields(payload[1:])
    except (struct.error, ValueError):
        rel_id = struct.unpack_from(">I", payload, 1)[0] if len(payload) >= 5 else None
        return rel_id, None, None, None


_LAYOUT = [
    ("rel_id", pa.int64()),
    ("namespace", pa.string()),
    ("name", pa.string()),
    ("columns", pa.list_(pa.struct([("name", pa.string()), ("typeName", pa.string()), ("typeOid", pa.int64())]))),
]


def _decode_relations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the last column, a RELATION payload, by its fields."""
    for batch in batches:
        found = [_layout_or_nothing(p.as_py()) for p in batch.columns[-1]]
        columns = zip(*found) if found else [()] * len(_LAYOUT)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], *[pa.array(c, kind) for c, (_, kind) in zip(columns, _LAYOUT)]],
            names=[*batch.schema.names[:-1], *[name for name, _ in _LAYOUT]],
        )


def _announced(wal: DataFrame) -> DataFrame:
    return _with_capture_time(wal).filter(message_type(F.col("payload")) == RELATION)


def read_relations(wal: DataFrame, with_cut: bool = False) -> DataFrame:
    """Every RELATION message as one row with its column layout.

    ``with_cut`` also keeps messages that end too early, with nulls for their layout:
    rows after one have no known layout until the next announcement.
    """
    found = _announced(wal).select(
        "source",
        F.col("lsn").alias("lsn_pos"),
        F.col("seq").cast("bigint").alias("seq"),
        F.col("captured_at").alias("timestamp"),
        "payload",
    ).mapInArrow(_decode_relations, RELATION_SCHEMA)
    return found if with_cut else found.filter(F.col("name").isNotNull())


def _cut_relations(wal: DataFrame) -> DataFrame:
    """RELATION messages that end too early, as rejected messages."""
    lsn = F.col("lsn")
    return (
        _announced(wal).select("source", lsn, F.col("seq").cast("bigint").alias("seq"), "payload", F.col("payload").alias("_p"))
        .mapInArrow(_decode_relations, "source string, lsn bigint, seq bigint, payload binary, " + RELATION_SCHEMA.split("timestamp bigint, ")[1])
        .filter(F.col("name").isNull())
        .select(
            "source", F.lit("RELATION").alias("type"), "rel_id", format_lsn(lsn).alias("lsn"),
            lsn_high(lsn).alias("pos_hi"), lsn_low(lsn).alias("pos_lo"), "seq", F.lit(0).alias("idx"),
            "payload", F.lit(CUT_SHORT).alias("reject_reason"),
        )
    )


def changed_layouts(relations: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """Announcements that differ from the one before them.

    Databases announce a layout again and again; a kept catalogue needs only the
    changes. ``earlier`` is what the catalogue holds already.
    """
    rows = relations.withColumn("_print", F.to_json(F.struct("namespace", "name", "columns")))
    before = relations if earlier is None else relations.unionByName(earlier)
    before = before.select(
        "source", "rel_id", "lsn_pos", "seq",
        F.to_json(F.struct("namespace", "name", "columns")).alias("_prev"),
    )
    marked = asof_join(
        rows, before, ["source", "rel_id"], ["lsn_pos", "seq"], ["_prev"], inclusive=False
    )
    return marked.filter(~F.col("_print").eqNullSafe(F.col("_prev"))).drop("_print", "_prev")


def _layout_columns() -> list[Column]:
    """All that depends on columns only, worked out once for each layout."""
    return [
        "namespace",
        F.col("name").alias("rel_name"),
        F.transform("columns", lambda c: json_key(c["name"])).alias("keys"),
        F.transform("columns", lambda c: c["name"]).alias("names"),
        F.transform("columns", lambda c: pg_kind(c["typeOid"])).alias("kinds"),
    ]


_LAYOUT_NAMES = ["namespace", "rel_name", "keys", "names", "kinds"]


def attach_relations(
    messages: DataFrame, relations: DataFrame, broadcast: bool = True
) -> DataFrame:
    """Give each message the newest layout of its relation at its position."""
    layouts = relations.select("source", F.col("lsn_pos").alias("lsn"), "seq", "rel_id", *_layout_columns())
    return asof_join(messages, layouts, ["source", "rel_id"], ["lsn", "seq"], _LAYOUT_NAMES, broadcast=broadcast)


def _without_repeats(relations: DataFrame) -> DataFrame | None:
    """The announcements that change a layout, if all of them are few; else None."""
    relations = settle(relations)
    if not is_small(relations):
        return None
    layout = F.struct("namespace", "name", "columns")
    earlier = Window.partitionBy("source", "rel_id").orderBy("lsn_pos", "seq")
    marked = relations.withColumn("_first", F.row_number().over(earlier) == 1).withColumn(
        "_same", layout.eqNullSafe(F.lag(layout).over(earlier))
    )
    return marked.filter(F.col("_first") | ~F.col("_same")).drop("_first", "_same")


def _interned(wal: DataFrame) -> DataFrame | None:
    """Messages with their layouts where the log lies in order, without moving a payload.

    Announcements are carried along the log as numbers, one for each different layout;
    the layouts themselves, of which there are few, are joined last. None if the log is
    in no order, or has too many layouts.
    """
    payload = F.col("payload")
    number = F.xxhash64(payload)
    known = _announced(wal).select(number.alias("_layout"), "payload").dropDuplicates(["payload"])
    known = settle(known.mapInArrow(_decode_relations, f"_layout bigint, {RELATION_SCHEMA.split('timestamp bigint, ')[1]}"))
    once = known.agg(F.count("*") == F.count_distinct("_layout")).first()[0]
    if not (once and is_small(known)):
        return None
    messages = _messages(wal, [*KNOWN_MESSAGES, RELATION])
    announces = F.col("kind") == RELATION
    carried = carry_along(
        messages, [F.col("lsn"), F.col("seq"), F.col("idx")], ["rel_id"], announces, F.when(announces, number)
    )
    if carried is None:
        return None
    layouts = known.select("_layout", *_layout_columns())
    return (
        carried.filter(~announces).join(F.broadcast(layouts), F.col("_value") == F.col("_layout"), "left")
        .select(*messages.columns, *_LAYOUT_NAMES)
    )


def _with_layouts(wal: DataFrame, relations: DataFrame | None, broadcast: bool) -> DataFrame:
    """Messages and their layouts: from a kept catalogue, or from the same log.

    Few layout changes are broadcast. Else they are carried along a log that lies in
    order; only one in no order is shuffled.
    """
    if relations is not None:
        return attach_relations(_messages(wal), relations, broadcast)
    changes = _without_repeats(read_relations(wal, with_cut=True)) if broadcast else None
    if changes is not None:
        return attach_relations(_messages(wal), changes)
    found = _interned(wal)
    if found is None:
        found = attach_relations(_messages(wal), read_relations(wal, with_cut=True), broadcast=False)
    return found


# --- tuples ----------------------------------------------------------------


def _members(cells: Column, keys: Column, kinds: Column, plain: Column) -> Column:
    """The cells of a tuple as ``"name":value`` texts."""

    def members(quote: Callable[[Column], Column]) -> Column:
        return F.transform(
            cells,
            lambda cell, i: F.concat(
                F.coalesce(F.get(keys, i), positional_key(i)),
                render_pg_cell(
                    cell["m"],
                    cell["t"].cast("string"),
                    F.coalesce(F.get(kinds, i), F.lit("text")),
                    quote,
                ),
            ),
        )

    # whether anything needs escaping is known per row: most rows need nothing
    return F.when(cells.isNotNull(), F.when(plain, members(bare_quote)).otherwise(members(json_quote)))


# --- messages --------------------------------------------------------------


def _messages(wal: DataFrame, kinds: list[str] = KNOWN_MESSAGES) -> DataFrame:
    """Messages of some kinds; TRUNCATE becomes one row per named relation."""
    payload = F.col("payload")
    kind = message_type(payload)
    named = F.sequence(F.lit(0).cast("bigint"), _unsigned(payload, 2, 4) - 1)
    room = F.call_function("div", F.octet_length(payload) - 6, F.lit(4))
    truncated = F.when(
        F.coalesce(_unsigned(payload, 2, 4).between(1, room), F.lit(False)),
        F.transform(named, lambda i: _unsigned(payload, i * 4 + 7, 4)),
    )
    relations = (
        F.when(kind.isin([*ROW_MESSAGES, RELATION]), F.array(_unsigned(payload, 2, 4)))
        .when((kind == TRUNCATE) & (_unsigned(payload, 2, 4) != 0), truncated)
        .when(kind == TRUNCATE, F.array().cast("array<bigint>"))
        .otherwise(F.array(F.lit(None).cast("bigint")))
    )
    # a TRUNCATE too short for its own count keeps one row, to be rejected
    relations = F.coalesce(relations, F.array(F.lit(None).cast("bigint")))
    return (
        _with_capture_time(wal)
        .filter(kind.isin(kinds))
        .select(
            "source",
            "lsn",
            F.col("seq").cast("bigint").alias("seq"),
            "captured_at",
            kind.alias("kind"),
            "payload",
            F.posexplode(relations).alias("idx", "rel_id"),
        )
    )


def _decoded(
    wal: DataFrame,
    relations: DataFrame | None,
    tables: Iterable[str] | None,
    capture_ddl: bool,
    broadcast: bool,
) -> DataFrame:
    rows = _with_layouts(wal, relations, broadcast)
    kind, payload = F.col("kind"), F.col("payload")
    about_table = kind.isin([*ROW_MESSAGES, TRUNCATE])
    is_ddl = F.lit(False)
    if capture_ddl:
        is_ddl = F.coalesce(
            (kind == INSERT) & (F.col("rel_name") == DDL_LOG_TABLE), F.lit(False)
        )
    wanted = sorted(set(tables or ()))
    if wanted:
        # before any tuple is walked; unknown relations stay, to be reported
        rows = rows.filter(
            ~about_table | is_ddl | F.col("rel_name").isNull()
            | F.col("rel_name").isin(wanted)
        )

    known = F.col("rel_name").isNotNull()
    after_id = _byte(payload, 6)
    has_old = (kind == UPDATE) & after_id.isin("K", "O")
    rows = rows.withColumn("_tuples", row_tuples(payload))
    one, two = F.col("_tuples.one"), F.col("_tuples.two")
    cut = F.col("_tuples.cut") | (about_table & F.col("rel_id").isNull())
    rows = rows.withColumn(
        "reject_reason",
        F.when(about_table & ~known & F.col("rel_id").isNotNull(), UNKNOWN_RELATION).when(
            cut, CUT_SHORT
        ),
    )
    keys, kinds = F.col("keys"), F.col("kinds")
    plain = F.col("_tuples.plain")
    # the images and their members are worked out from the cells once
    rows = rows.withColumns({"_one": _members(one, keys, kinds, plain), "_two": _members(two, keys, kinds, plain)})
    members_one, members_two = F.col("_one"), F.col("_two")
    image_one, image_two = json_object(members_one), json_object(members_two)
    old_image = F.when(has_old, image_one)
    new_image = F.when(has_old, image_two).otherwise(image_one)
    data = (
        F.when(kind.isin(INSERT, DELETE), F.coalesce(image_one, F.lit("{}")))
        .when(kind == UPDATE, build_update(old_image, new_image))
        .when(
            kind == TRUNCATE,
            F.concat(
                F.lit('{"options":'), _unsigned(payload, 6, 1).cast("string"), F.lit("}")
            ),
        )
    )
    newest = F.when(has_old, two).otherwise(one)
    names = F.col("names")
    unchanged = F.filter(
        F.transform(
            newest,
            lambda cell, i: F.when(
                cell["m"] == "u",
                F.coalesce(F.get(names, i), F.concat(F.lit("col_"), i.cast("string"))),
            ),
        ),
        lambda name: name.isNotNull(),
    )
    type_name = (
        F.when(is_ddl, "DDL")
        .when(kind == BEGIN, "BEGIN")
        .when(kind == COMMIT, "COMMIT")
        .when(kind == INSERT, "INSERT")
        .when(kind == UPDATE, "UPDATE")
        .when(kind == DELETE, "DELETE")
        .otherwise("TRUNCATE")
    )
    began = F.when(
        (kind == BEGIN) & (F.octet_length(payload) >= 21),
        pg_micros_to_epoch_ms(_unsigned(payload, 10, 8)),
    )
    event = make_event(
        type_name,
        F.col("namespace"),
        F.when(is_ddl, "").otherwise(F.col("rel_name")),
        data,
        format_lsn(F.col("lsn")),
        F.col("captured_at"),
        began,
    )
    return rows.select(
        "source",
        *[value.alias(name) for name, value in event.items()],
        lsn_high(F.col("lsn")).alias("pos_hi"),
        lsn_low(F.col("lsn")).alias("pos_lo"),
        "seq",
        "idx",
        F.when(kind.isin(UPDATE, DELETE) & after_id.isin("K", "O"), after_id).alias("old_kind"),
        F.when(kind.isin(ROW_MESSAGES), unchanged).alias("unchanged_cols"),
        F.when(kind.isin(ROW_MESSAGES), names).alias("names"),
        F.when(kind.isin(ROW_MESSAGES), kinds).alias("kinds"),
        F.when(has_old, members_one).alias("old_members"),
        F.when(kind.isin(ROW_MESSAGES), F.when(has_old, members_two).otherwise(members_one)).alias("members"),
        "rel_id",
        "payload",
        "reject_reason",
    )


def decode_messages(
    wal: DataFrame,
    relations: DataFrame | None = None,
    tables: Iterable[str] | None = None,
    capture_ddl: bool = False,
    broadcast: bool = True,
) -> DataFrame:
    """Events and rejected messages in one table, told apart by ``reject_reason``.

    Every message of a known kind is one or the other, also a RELATION message that
    ends too early (type RELATION).
    """
    rows = _decoded(wal, relations, tables, capture_ddl, broadcast)
    decoded = rows.select(
        *EVENT_COLUMNS, "old_kind", "unchanged_cols",
        *[F.when(F.col("reject_reason").isNotNull(), F.col(c)).alias(c) for c in ("rel_id", "payload")], "reject_reason",
    )
    return decoded.unionByName(_cut_relations(wal), allowMissingColumns=True)


def decode_wal(
    wal: DataFrame,
    relations: DataFrame | None = None,
    tables: Iterable[str] | None = None,
    capture_ddl: bool = False,
    broadcast: bool = True,
) -> DataFrame:
    """Change events of a captured message table.

    ``relations`` is a kept catalogue of layouts; without it the layouts are read
    from the same messages. ``tables`` are bare names, tested before any tuple is
    decoded. ``old_kind`` tells key-only (K) from full (O) old images, and
    ``unchanged_cols`` names columns whose stored value was not sent.
    """
    rows = _decoded(wal, relations, tables, capture_ddl, broadcast)
    return rows.filter(F.col("reject_reason").isNull()).select(
        *EVENT_COLUMNS, "old_kind", "unchanged_cols"
    )


def wal_rejects(
    wal: DataFrame,
    relations: DataFrame | None = None,
    tables: Iterable[str] | None = None,
    broadcast: bool = True,
    capture_ddl: bool = False,
) -> DataFrame:
    """Messages that yield no event, with the reason and the raw payload."""
    rows = _decoded(wal, relations, tables, capture_ddl, broadcast)
    rejects = rows.filter(F.col("reject_reason").isNotNull()).select(*REJECT_COLUMNS)
    return rejects.unionByName(_cut_relations(wal))


def decode_images(
    wal: DataFrame,
    relations: DataFrame | None = None,
    tables: Iterable[str] | None = None,
    broadcast: bool = True,
) -> DataFrame:
    """Row events with their images in parts: ``names``, ``kinds``, ``members`` and ``old_members``.

    A member is the ``"name":value`` text of one cell; ``members`` is the newest image.
    """
    rows = _decoded(wal, relations, tables, False, broadcast)
    return rows.filter(F.col("reject_reason").isNull() & F.col("type").isin("INSERT", "UPDATE", "DELETE")).select(
        *EVENT_COLUMNS, "old_kind", "unchanged_cols", "names", "kinds", "members", "old_members"
    )
