"""Message decoding against hand-built messages."""

from __future__ import annotations

import struct

import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from changefeed import fixtures
from changefeed.operators.newest_layout import in_newest_layout
from changefeed.operators.schema_history import schema_history
from changefeed.plans import live_postgres
from changefeed.sources import changed_layouts, decode_images, decode_wal, read_relations, wal_rejects
from changefeed.sources.tuples import cut_tuples

WAL = "source string, lsn bigint, seq bigint, payload binary, captured_at bigint"


def tup(*cells):
    out = struct.pack(">H", len(cells))
    for cell in cells:
        if cell is None:
            out += b"n"
        elif isinstance(cell, bytes):
            out += cell
        else:
            raw = cell.encode()
            out += b"t" + struct.pack(">I", len(raw)) + raw
    return out


def rel(rel_id, name, columns, namespace="public"):
    out = b"R" + struct.pack(">I", rel_id) + namespace.encode() + b"\0" + name.encode() + b"\0d"
    out += struct.pack(">H", len(columns))
    for label, oid in columns:
        out += b"\0" + label.encode() + b"\0" + struct.pack(">Ii", oid, -1)
    return out


def ins(rel_id, *cells):
    return b"I" + struct.pack(">I", rel_id) + b"N" + tup(*cells)


def upd(rel_id, new, old=None, mark=b"O"):
    middle = mark + tup(*old) if old is not None else b""
    return b"U" + struct.pack(">I", rel_id) + middle + b"N" + tup(*new)


def dele(rel_id, *cells, mark=b"K"):
    return b"D" + struct.pack(">I", rel_id) + mark + tup(*cells)


def trunc(options, *ids):
    return b"T" + struct.pack(">IB", len(ids), options) + b"".join(struct.pack(">I", i) for i in ids)


def wal_of(spark, messages, source="pg"):
    rows = [(source, (i + 1) * 100, i, bytearray(m), 5) for i, m in enumerate(messages)]
    return spark.createDataFrame(rows, WAL)


def decoded(spark, messages, **options):
    rows = decode_wal(wal_of(spark, messages), **options).orderBy("lsn", "pos_lo", "idx").collect()
    return sorted(rows, key=lambda r: (r.pos_hi, r.pos_lo, r.idx))


USERS = rel(1, "users", [("id", 23), ("name", 25), ("active", 16)])
NUMBERS = rel(6, "numbers", [("int2_val", 21), ("int4_val", 23), ("int8_val", 20), ("float4_val", 700),
                             ("float8_val", 701), ("numeric_val", 1700), ("oid_val", 26)])


@pytest.mark.parametrize("broadcast", [True, False])
def test_golden_messages(spark, broadcast):
    begin = b"B" + struct.pack(">QQI", 0, 1_000_000, 1)
    messages = [
        USERS, rel(2, "orders", [("id", 23), ("email", 25)]),
        rel(3, "docs", [("id", 23), ("content", 25)]), NUMBERS,
        rel(7, "j", [("id", 23), ("payload", 3802), ("config", 114)]),
        begin, ins(1, "42", "Alice", "t"), ins(2, "1", None), ins(3, "1", b"u"),
        upd(1, ["1", "Bob", "f"], ["1", "Alice", "t"]), upd(1, ["1", "Bob", "t"]),
        dele(1, "1", "Alice", None), dele(1, "1", None, None, mark=b"O"),
        ins(6, "32767", "2147483647", "9223372036854775807", "3.14", "2.718281828", "99999.99", "12345"),
        ins(3, "1", "line1\nline2\ttab\\backslash\"quote"),
        ins(7, "42", '{"foo": "bar", "count": 3}', "[1, 2, 3]"), ins(7, "1", "not valid json", None),
        trunc(1, 1, 2), ins(1, "1", b"x", "t", "extra"), b"C", b"", b"Z",
        b"D" + struct.pack(">I", 1), ins(1, *[]), upd(3, ["2", b"u"], ["2", None], b"K"),
    ]
    rows = decoded(spark, messages, broadcast=broadcast)
    assert [(r.type, r.table, r.data) for r in rows] == [
        ("BEGIN", "", ""),
        ("INSERT", "users", '{"id":42, "name":"Alice", "active":true}'),
        ("INSERT", "orders", '{"id":1, "email":null}'),
        ("INSERT", "docs", '{"id":1, "content":"unchanged"}'),
        ("UPDATE", "users", '{"old":{"id":1, "name":"Alice", "active":true}, "new":{"id":1, "name":"Bob", "active":false}}'),
        ("UPDATE", "users", '{"new":{"id":1, "name":"Bob", "active":true}}'),
        ("DELETE", "users", '{"id":1, "name":"Alice", "active":null}'),
        ("DELETE", "users", '{"id":1, "name":null, "active":null}'),
        ("INSERT", "numbers", '{"int2_val":32767, "int4_val":2147483647, "int8_val":9223372036854775807, '
         '"float4_val":3.14, "float8_val":2.718281828, "numeric_val":99999.99, "oid_val":12345}'),
        ("INSERT", "docs", '{"id":1, "content":"line1\\nline2\\ttab\\\\backslash\\"quote"}'),
        ("INSERT", "j", '{"id":42, "payload":{"foo": "bar", "count": 3}, "config":[1, 2, 3]}'),
        ("INSERT", "j", '{"id":1, "payload":"not valid json", "config":null}'),
        ("TRUNCATE", "users", '{"options":1}'), ("TRUNCATE", "orders", '{"options":1}'),
        ("INSERT", "users", '{"id":1, "name":"unknown", "active":true, "col_3":"extra"}'),
        ("COMMIT", "", ""), ("DELETE", "users", "{}"), ("INSERT", "users", "{}"),
        ("UPDATE", "docs", '{"old":{"id":2, "content":null}, "new":{"id":2, "content":"unchanged"}}'),
    ]
    assert rows[0].sourceTimestamp == 946684801000 and rows[0].schema == ""
    assert rows[1].lsn == "0/2BC" and rows[1].timestamp == 5 and rows[1].schema == "public"
    assert [r.old_kind for r in rows[4:8]] == ["O", None, "K", "O"]
    assert rows[3].unchanged_cols == ["content"] and rows[1].unchanged_cols == []
    assert [r.idx for r in rows[12:14]] == [0, 1]


def test_table_filter_and_ddl_capture(spark):
    log = rel(9, "_cdc_ddl_log", [("id", 23), ("command_tag", 25)])
    messages = [USERS, rel(2, "orders", [("id", 23)]), log, ins(1, "1", "A", "t"), ins(2, "7"),
                ins(9, "1", "ALTER TABLE"), trunc(0, 1, 2), b"C"]
    kept = decoded(spark, messages, tables=["orders"])
    assert [(r.type, r.table) for r in kept] == [("INSERT", "orders"), ("TRUNCATE", "orders"), ("COMMIT", "")]
    kept = decoded(spark, messages, tables=["orders"], capture_ddl=True)
    assert [(r.type, r.table, r.data) for r in kept[:2]] == [
        ("INSERT", "orders", '{"id":7}'), ("DDL", "", '{"id":1, "command_tag":"ALTER TABLE"}')]
    plain = decoded(spark, messages)
    assert ("INSERT", "_cdc_ddl_log") in [(r.type, r.table) for r in plain]


@pytest.mark.parametrize("broadcast", [True, False])
def test_rejects(spark, broadcast):
    good = ins(1, "42", "Alice", "t")
    messages = [ins(1, "0", "early", "t"), USERS, good, good[:-1], good[:9], good[:7], good[:5],
                ins(8, "1"), trunc(0, 1, 55), trunc(0, 1, 2)[:8], upd(1, ["1", "a", "t"], ["1", "b", "t"])[:-3], b"D", b"U"]
    bad = wal_rejects(wal_of(spark, messages), broadcast=broadcast)
    got = sorted((r.pos_lo, r.idx, r.reject_reason) for r in bad.collect())
    cut, unknown = "truncated message", "unknown relation"
    assert got == [
        (100, 0, unknown), (400, 0, cut), (500, 0, cut), (600, 0, cut), (700, 0, cut),
        (800, 0, unknown), (900, 1, unknown), (1000, 0, cut), (1100, 0, cut),
        (1200, 0, cut), (1300, 0, cut),
    ]
    events = decode_wal(wal_of(spark, messages), broadcast=broadcast)
    assert sorted((r.type, r.pos_lo) for r in events.collect()) == [("INSERT", 300), ("TRUNCATE", 900)]


def test_layout_changes_and_sources_do_not_mix(spark):
    first, second = rel(1, "t", [("a", 23)]), rel(1, "t", [("b", 25), ("c", 23)])
    one = wal_of(spark, [first, ins(1, "1"), second, ins(1, "x", "2"), first, ins(1, "3")], "s1")
    two = wal_of(spark, [ins(1, "9"), second, ins(1, "y", None)], "s2")
    rows = decode_wal(one.unionByName(two)).collect()
    got = sorted((r.source, r.pos_lo, r.data) for r in rows)
    assert got == [("s1", 200, '{"a":1}'), ("s1", 400, '{"b":"x", "c":2}'), ("s1", 600, '{"a":3}'),
                   ("s2", 300, '{"b":"y", "c":null}')]
    history = schema_history(read_relations(one), dedupe=True).orderBy("lsn_pos").collect()
    assert [[c.name for c in r.columns] for r in history] == [["a"], ["b", "c"], ["a"]]


def test_only_changed_layouts_are_kept(spark):
    first, second = rel(1, "t", [("a", 23)]), rel(1, "t", [("b", 25)])
    relations = read_relations(wal_of(spark, [first, first, second, second, first]))
    new = changed_layouts(relations)
    assert sorted(r.lsn_pos for r in new.collect()) == [100, 300, 500]
    later = read_relations(wal_of(spark, [first, first, second]))
    shifted = later.selectExpr("* except (lsn_pos)", "lsn_pos + 1000 as lsn_pos").select(later.columns)
    assert [r.lsn_pos for r in changed_layouts(shifted, new).collect()] == [1300]


def test_nan_is_quarantined(spark):
    wal = wal_of(spark, [rel(1, "t", [("v", 701)]), ins(1, "NaN"), ins(1, "1.5")])
    assert [r.data for r in live_postgres(wal).collect()] == ['{"v":1.5}']


def test_cut_tuples_on_slices_and_wide_rows():
    wide = ins(1, *[str(i) for i in range(300)])
    whole = pa.array([b"x", ins(1, "a", "b"), wide, None, b"I\0\0\0\1N\xff\xff"], pa.binary())
    for part in (whole, whole.slice(1), whole.slice(2, 2)):
        rows = cut_tuples(part).to_pylist()
        assert len(rows) == len(part)
        texts = [[c["t"] for c in r["one"]] if r["one"] is not None else None for r in rows]
        if len(part) == 5:
            assert texts[0] is None and texts[1] == [b"a", b"b"]
            assert texts[2] == [str(i).encode() for i in range(300)]
            assert texts[3] is None and rows[4]["cut"] and texts[4] is None


def test_rows_in_the_newest_layout(spark):
    """Renamed at its place, retyped both ways, moved, dropped and added columns; tables without a layout stay."""
    first = rel(1, "t", [("id", 23), ("name", 25), ("price", 25), ("gone", 25), ("big", 25)])
    second = rel(1, "t", [("id", 25), ("title", 25), ("price", 1700), ("big", 25), ("note", 25)])
    wal = wal_of(spark, [
        first, ins(1, "1", "a", "2.50", "x", 'q"b'), ins(1, "2", None, "n/a", "x", "null"),
        upd(1, ["3", b"u", "7", "y", b"u"], old=["3", "o", "6", "y", "B"]), dele(1, "4", None, None, None, None),
        second, ins(1, "x5", "t", "8", "B", "n"),
    ])
    history = schema_history(read_relations(wal))
    rows = in_newest_layout(decode_images(wal), history).orderBy("pos_lo").collect()
    assert [r.data for r in rows] == [
        '{"id":"1", "title":"a", "price":2.50, "big":"q\\"b", "note":null}',
        '{"id":"2", "title":null, "price":"n/a", "big":"null", "note":null}',
        '{"old":{"id":"3", "title":"o", "price":6, "big":"B", "note":null}, '
        '"new":{"id":"3", "title":"unchanged", "price":7, "big":"unchanged", "note":null}}',
        '{"id":"4", "title":null, "price":null, "big":null, "note":null}',
        '{"id":"x5", "title":"t", "price":8, "big":"B", "note":"n"}',
    ]
    assert [r.unchanged_cols for r in rows][2] == ["title", "big"]
    plain = in_newest_layout(decode_images(wal), history.limit(0)).orderBy("pos_lo").collect()
    assert [r.data for r in plain] == [r.data for r in decode_images(wal).orderBy("pos_lo").collect()]


def test_rows_of_the_newest_layout_keep_their_image(spark):
    """Whole rows in the newest layout are passed on, odd ones are worked out; both ways give the same."""
    layout = rel(1, "t", [("id", 23), ("name", 25), ("ok", 16)])
    wal = wal_of(spark, [
        rel(1, "t", [("id", 25), ("name", 25), ("ok", 16)]), ins(1, "7", "old", "t"),
        layout, ins(1, "1", 'q"b', "t"), ins(1, "2", None), ins(1, "3", "c", "f", "more"),
        upd(1, ["4", b"u", "t"], old=["4", "o", "f"]), dele(1, "5", None, None),
    ])
    history = schema_history(read_relations(wal))
    images = decode_images(wal)
    assert "kinds" in images.columns
    passed = in_newest_layout(images, history)
    # a mark in the image shows which rows were not worked out again
    marked = in_newest_layout(images.withColumn("data", F.concat(F.lit("#"), "data")), history)
    worked = in_newest_layout(images.drop("kinds"), history)
    at = [(r.data, r.unchanged_cols) for r in passed.orderBy("pos_lo").collect()]
    assert at == [(r.data, r.unchanged_cols) for r in worked.orderBy("pos_lo").collect()]
    assert [r.data[0] == "#" for r in marked.orderBy("pos_lo").collect()] == [False, True, False, False, True, True]


def test_captured_logs_are_sized_by_their_messages(spark, monkeypatch):
    """No file of a log grows with the input, whatever the number of cores."""
    monkeypatch.setattr(fixtures, "FILE_MESSAGES", 100)
    rows = spark.range(10_000).selectExpr("id * 7 % 10000 as lsn", "0 as seq")
    sizes = fixtures._in_log_order(rows, "lsn", "seq").groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 80 and max(r["count"] for r in sizes) < 400
