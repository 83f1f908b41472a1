"""Operators over small hand-made feeds."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from changefeed.operators import (
    acked_positions,
    assign_transactions,
    bootstrap,
    ddl_log,
    delivery_audit,
    drop_redelivered,
    filter_tables,
    heartbeats,
    intercept_ddl,
    latest_schema,
    load_history,
    make_event,
    merge_feeds,
    observe_events,
    parse_envelope,
    resume_from,
    route,
    route_tenants,
    schema_history,
    snapshot_mode,
    table_history,
    to_envelope_json,
    to_messages,
    validate,
    with_source_timestamp,
)
from changefeed.operators import ordered
from changefeed.operators.schema_history import append_history
from changefeed.sources.wal import RELATION_SCHEMA

EVENTS = (
    "source string, type string, schema string, `table` string, data string, rawMessage string, "
    "lsn string, timestamp bigint, sourceTimestamp bigint, pos_hi bigint, pos_lo bigint, "
    "seq bigint, idx int"
)


def event(pos, type="INSERT", table="users", data='{"id":1}', source="s", ts=0, source_ts=0, schema="public"):
    lsn = f"0/{pos:X}" if pos is not None else ""
    return (source, type, schema, table, data, type, lsn, ts, source_ts,
            0 if pos is not None else None, pos, 0, 0)


def feed(spark, *rows):
    return spark.createDataFrame(list(rows), EVENTS)


def test_envelope_json(spark):
    rows = feed(spark, event(4660, data='{"id":1, "name":"Alice"}', ts=7), event(1, "COMMIT", "", "", schema=""))
    texts = [r[0] for r in rows.orderBy(F.desc("pos_lo")).select(to_envelope_json()).collect()]
    assert texts[0] == (
        '{"type":"INSERT","schema":"public","table":"users","data":"{\\"id\\":1, \\"name\\":\\"Alice\\"}",'
        '"rawMessage":"INSERT","lsn":"0/1234","timestamp":7,"sourceTimestamp":0}')
    assert json.loads(texts[1]) == {"type": "COMMIT", "schema": "", "rawMessage": "COMMIT", "lsn": "0/1",
                                    "timestamp": 0, "sourceTimestamp": 0}


@pytest.mark.parametrize("kind", ["BEGIN", "COMMIT", "INSERT", "UPDATE", "DELETE", "DDL", "TRUNCATE", "HEARTBEAT"])
def test_types_round_trip(spark, kind):
    good, bad = parse_envelope(to_messages(feed(spark, event(1, kind))))
    assert [r.type for r in good.collect()] == [kind] and bad.count() == 0


def test_envelope_rejects(spark):
    texts = ['{"type":"NOPE"}', "{", "[1]", '{"type":"INSERT","schema":"s"} x', '{"type":"DDL"}', "{}", '{"type":5}']
    good, bad = parse_envelope(spark.createDataFrame([(t,) for t in texts], "value string"))
    rows = good.collect()
    assert [(r.type, r.schema, r.lsn, r.timestamp) for r in rows] == [("DDL", "", "", 0)]
    assert sorted(r.value for r in bad.collect()) == sorted(t for t in texts if t != '{"type":"DDL"}')


def test_make_event_defaults(spark):
    row = spark.range(1).select(*[v.alias(k) for k, v in make_event("DDL", "s", None, "x").items()]).first()
    assert (row.table, row.lsn, row.rawMessage, row.sourceTimestamp) == ("", "", "DDL", 0)
    assert row.timestamp > 1_600_000_000_000


def test_gate(spark):
    rows = feed(spark, event(1, data="not json"), event(2, "DDL", "", "ALTER TABLE x"), event(3, data=""),
                event(4), event(5, "TRUNCATE", data="{"), event(6, "COMMIT", "", "oops"))
    good, bad = validate(rows)
    assert sorted(r.pos_lo for r in good.collect()) == [2, 3, 4, 6]
    assert sorted((r.pos_lo, r.reject_reason) for r in bad.collect()) == [
        (1, "invalid JSON data"), (5, "invalid JSON data")]


def test_routes(spark):
    rows = feed(spark, event(1), event(2, table="orders"), event(3, "BEGIN", ""), event(4, "DDL", ""),
                event(5, schema="other"))
    subs = spark.createDataFrame([("x", "users"), ("y", "users"), ("y", "orders")], "subscriber string, table string")
    got = sorted((r.subscriber, r.pos_lo) for r in route(rows, subs).collect())
    assert got == [("x", 1), ("x", 5), ("y", 1), ("y", 2), ("y", 5)]
    narrow = subs.withColumn("schema", F.lit("public"))
    assert sorted((r.subscriber, r.pos_lo) for r in route(rows, narrow).collect()) == [("x", 1), ("y", 1), ("y", 2)]
    tenants = route_tenants(rows, {"s": "cdc.tenant-a"})
    assert {r.subject for r in tenants.collect()} == {
        "cdc.tenant-a.public.users", "cdc.tenant-a.public.orders", "cdc.tenant-a.public._ddl",
        "cdc.tenant-a.other.users"}


def test_filters_take_names_literally(spark):
    rows = feed(spark, event(1, table="a.b"), event(2, table="axb"), event(3, table="b", schema="public.a"))
    kept = filter_tables(rows, ["public.a.b"], qualified=True).collect()
    assert [r.pos_lo for r in kept] == [1]
    assert filter_tables(rows, []).count() == 3


def test_ddl(spark):
    log = json.dumps({"id": 1, "command_tag": "DROP", "object_type": "table", "schema_name": "public",
                      "object_identity": "public.t"})
    rows = feed(spark, event(1, table="_cdc_ddl_log", data=log), event(2, "UPDATE", "_cdc_ddl_log"),
                event(3, "DDL", "", "ALTER TABLE t ADD x INT"), event(4))
    caught = intercept_ddl(rows)
    assert sorted((r.pos_lo, r.type, r.table) for r in caught.collect()) == [
        (1, "DDL", ""), (2, "UPDATE", "_cdc_ddl_log"), (3, "DDL", ""), (4, "INSERT", "users")]
    got = sorted((r.pos_lo, r.command_tag, r.query) for r in ddl_log(caught).collect())
    assert got == [(1, "DROP", None), (3, None, "ALTER TABLE t ADD x INT")]


def relation(pos, name, *columns, source="s"):
    return (source, pos, 0, 9, 1, "public", name, [(c, None, 25) for c in columns])


def test_schema_history(spark, tmp_path):
    rels = spark.createDataFrame(
        [relation(1, "t", "a"), relation(2, "t", "a"), relation(3, "t", "a", "b"), relation(4, "u", "z"),
         relation(5, "t", "a"), relation(None, "w", "q")], RELATION_SCHEMA)
    history = schema_history(rels)
    assert [r.position for r in table_history(history, "public", "t").collect()] == ["0/1", "0/2", "0/3", "0/5"]
    deduped = schema_history(rels, dedupe=True)
    assert [r.position for r in table_history(deduped, "public", "t").collect()] == ["0/1", "0/3", "0/5"]
    newest = {r.table: (r.position, [c.name for c in r.columns]) for r in latest_schema(history).collect()}
    assert newest == {"t": ("0/5", ["a"]), "u": ("0/4", ["z"]), "w": ("unknown", ["q"])}
    assert table_history(history, "public", "missing").count() == 0
    path = str(tmp_path / "h")
    assert load_history(spark, path).count() == 0
    append_history(history, path)
    append_history(schema_history(spark.createDataFrame([relation(9, "t", "new")], RELATION_SCHEMA)), path)
    again = load_history(spark, path)
    assert again.count() == 7
    assert [r.position for r in latest_schema(again).filter("table = 't'").collect()] == ["0/9"]
    (tmp_path / "h" / "bad.json").write_text("{broken\n")
    with pytest.raises(Exception):
        load_history(spark, path).collect()


def test_transactions(spark, monkeypatch):
    monkeypatch.setattr(ordered, "SEGMENT_BITS", 2)
    monkeypatch.setattr(ordered, "BLOCK_BITS", 2)
    rows, want, n, ts = [], {}, 0, None
    for pos in range(1, 200):
        kind = "BEGIN" if pos % 7 == 3 else "COMMIT" if pos % 7 == 6 else "INSERT"
        if kind == "BEGIN":
            n, ts = n + 1, (pos if pos % 2 else None)
        rows.append(event(pos * 5, kind, source_ts=ts or 0 if kind == "BEGIN" else 0))
        want[pos * 5] = (n, ts)
    rows += [event(4, "INSERT", source="other"), event(None, source="s")]
    got = assign_transactions(feed(spark, *rows)).collect()
    assert {r.pos_lo: (r.tx_no, r.tx_timestamp) for r in got if r.source == "s" and r.pos_lo} == want
    assert [(r.tx_no, r.tx_timestamp) for r in got if r.source == "other" or r.pos_lo is None] == [(0, None)] * 2
    timed = with_source_timestamp(assign_transactions(feed(spark, event(1, "BEGIN", source_ts=8), event(2))))
    assert sorted(r.sourceTimestamp for r in timed.collect()) == [8, 8]


def test_transactions_go_on_from_a_state(spark):
    state = spark.createDataFrame([("s", 5, 77)], "source string, tx_no bigint, tx_timestamp bigint")
    rows = feed(spark, event(1), event(2, "BEGIN", source_ts=9), event(3), event(1, source="new"))
    got = {(r.source, r.pos_lo): (r.tx_no, r.tx_timestamp) for r in
           assign_transactions(rows, initial=state).collect()}
    assert got == {("s", 1): (5, 77), ("s", 2): (6, 9), ("s", 3): (6, 9), ("new", 1): (0, None)}


def test_heartbeats(spark):
    times = [0, 29_999, 59_999, 60_000, 125_000, 125_001, 155_001]
    rows = [event(i + 1, ts=1_000_000 + t) for i, t in enumerate(times)] + [event(1, ts=5, source="lone")]
    got = sorted((r.timestamp - 1_000_000, r.lsn, r.idx) for r in heartbeats(feed(spark, *rows)).collect())
    assert got == [(59_999, "0/2", 1), (90_000, "0/4", 1), (120_000, "0/4", 2), (155_001, "0/6", 1)]


def test_resume_and_audit(spark):
    rows = feed(spark, *[event(p) for p in range(1, 11)], *[event(p, source="new") for p in (1, 2)])
    done = acked_positions(rows.filter("source = 's' and pos_lo <= 6").unionByName(feed(spark, event(None))))
    assert [(r.source, r.lsn, r.pos_lo) for r in done.collect()] == [("s", "0/6", 6)]
    rest = resume_from(rows, done, "earliest")
    assert sorted((r.source, r.pos_lo) for r in rest.collect()) == [
        ("new", 1), ("new", 2), ("s", 7), ("s", 8), ("s", 9), ("s", 10)]
    assert {r.source for r in resume_from(rows, done, "latest").collect()} == {"s"}
    now = spark.createDataFrame([("new", 0, 1)], "source string, pos_hi bigint, pos_lo bigint")
    late = resume_from(rows, done, "latest", now).filter("source = 'new'").collect()
    assert [r.pos_lo for r in late] == [2]
    with pytest.raises(ValueError):
        resume_from(rows, done, "whenever")
    copies = rows.filter("pos_lo <> 3").unionByName(rows.filter("pos_lo = 4")).unionByName(rows.filter("pos_lo = 4"))
    audit = {r.source: r for r in delivery_audit(rows, copies).collect()}
    assert (audit["s"].expected, audit["s"].delivered, audit["s"].distinct_delivered) == (10, 11, 9)
    assert (audit["s"].duplicates, audit["s"].missing, audit["s"].unexpected) == (2, 1, 0)
    assert drop_redelivered(copies).count() == 11


def test_positions_order_by_number(spark):
    rows = feed(spark, event(0x9), event(0x10), event(0xA))
    assert acked_positions(rows).first().lsn == "0/10"


def test_bootstrap_and_merge(spark):
    base = feed(spark, *[event(None, data=json.dumps({"id": str(i)})) for i in range(5)])
    live = feed(spark, event(1, "UPDATE", data='{"old":{"id":1}, "new":{"id":2}}'), event(2, "DELETE", data='{"id":4}'),
                event(3, "BEGIN", "", ""), event(4, "INSERT", "other", data='{"id":0}'))
    assert bootstrap(base, live).count() == 9
    merged = bootstrap(base, live, ["id"]).filter("from_snapshot").collect()
    assert sorted(json.loads(r.data)["id"] for r in merged) == ["0", "1", "3"]
    assert bootstrap(None, live, ["id"]).count() == 4
    assert snapshot_mode("none") is None and snapshot_mode("chunked", lambda: base) is base
    for bad in ("weird", "backup_file"):
        with pytest.raises(ValueError):
            snapshot_mode(bad, lambda: base)
    both = merge_feeds({"a": base, "b": live})
    assert {r.source: r["count"] for r in both.groupBy("source").count().collect()} == {"a": 5, "b": 4}


def test_bootstrap_keys_per_table(spark):
    base = feed(spark, *[event(None, data=json.dumps({"id": str(i), "doc": "d"})) for i in range(3)],
                *[event(None, table="orders", data=json.dumps({"no": str(i)})) for i in range(4)],
                event(None, data='{"id":null}'), event(None, table="plain", data='{"x":"1"}'))
    live = feed(spark, event(1, data='{"id":0, "doc":"new"}'), event(2, data='{"id":null}'),
                event(3, "UPDATE", data='{"old":{"id":1, "doc":null}, "new":{"id":1, "doc":"unchanged"}}'),
                event(4, "DELETE", "orders", data='{"no":2}'), event(5, table="plain", data='{"x":1}'))

    def left(key):
        return sorted(r.data for r in bootstrap(base, live, key).filter("from_snapshot").collect())

    users = ['{"id": "1", "doc": "d"}', '{"id": "2", "doc": "d"}', '{"id":null}', '{"x":"1"}']
    assert left(["id"]) == sorted(users + [f'{{"no": "{i}"}}' for i in range(4)])
    want = sorted(users + [f'{{"no": "{i}"}}' for i in (0, 1, 3)])
    assert left({"users": ["id"], "public.orders": ["no"]}) == want


def test_observed_counts(spark):
    from pyspark.sql import Observation

    seen = Observation("events")
    rows = feed(spark, event(1), event(2, "DDL", ""), event(3))
    observed = observe_events(rows, seen)
    observed.collect()
    assert (seen.get["total"], seen.get["insert"], seen.get["ddl"]) == (3, 2, 1)


def test_rows_without_a_position(spark):
    from changefeed.operators.delivery import delivery_audit, drop_redelivered, resume_from

    rows = [("a", None, None, 0, 0, None, "s", "t", str(i)) for i in range(20)]
    schema = "source string, pos_hi bigint, pos_lo bigint, seq bigint, idx int, lsn string, schema string, table string, data string"
    events = spark.createDataFrame(rows, schema)
    acked = spark.createDataFrame([("a", 1, 1)], "source string, pos_hi bigint, pos_lo bigint")
    assert drop_redelivered(events.unionByName(events)).count() == 20
    assert resume_from(events, acked, "earliest").count() == 20
    audit = delivery_audit(events, events).first()
    assert (audit.expected, audit.delivered, audit.missing, audit.unexpected) == (20, 20, 0, 0)


def test_qualified_names_with_dots(spark):
    from changefeed.operators.filters import filter_tables

    rows = spark.createDataFrame([("shop.eu", "click"), ("shop", "eu.click"), ("shop", "eu")], "schema string, table string")
    assert filter_tables(rows, ["shop.eu.click"], qualified=True).collect() == [("shop", "eu.click")]
    assert filter_tables(rows, [("shop.eu", "click")], qualified=True).collect() == [("shop.eu", "click")]


def test_binary_introducer(spark):
    from pyspark.sql import functions as F

    from changefeed.sources.mysql_dump import VALUE

    row = spark.createDataFrame([("(1,_binary 'abc',NULL,'x')",)], "t string").select(
        F.regexp_extract_all("t", F.lit(VALUE), F.lit(0)).alias("v")
    ).first()
    assert row.v == ["1", "_binary 'abc'", "NULL", "'x'"]
