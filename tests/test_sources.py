"""Binlog events, dumps and snapshots."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from changefeed import fixtures
from changefeed.operators.validation import accepted
from changefeed.plans import live_mysql
from changefeed.operators import rank_select
from changefeed.sources import (
    binlog_rejects,
    chunk_at,
    decode_binlog,
    dump_position,
    keyset_chunks,
    next_chunk,
    offset_chunks,
    pg_dump_rejects,
    read_mysql_dump,
    read_pg_dump,
    rows_to_events,
    stamp_binlog_file,
)
from changefeed.sources.pg_dump import read_lines

BINLOG = (
    "source string, file string, log_pos bigint, seq bigint, action string, schema string, "
    "`table` string, columns array<struct<name:string,type:string>>, rows array<array<string>>, "
    "next_file string, query string, captured_at bigint"
)
COLUMNS = [("id", "int"), ("name", "varchar(10)"), ("email", "text")]


def binlog_rows(spark):
    def row(seq, action, rows=None, next_file=None, query=None, table="users"):
        return ("m", None, seq * 10, seq, action, "shop", table, COLUMNS if rows is not None else None,
                rows, next_file, query, 5)

    return spark.createDataFrame(
        [
            row(1, "insert", [["1", "early", None]]),
            row(2, "rotate", next_file="mysql-bin.000099"),
            row(3, "insert", [["1", "Alice", None], ["2", "B\"ob"]]),
            row(4, "update", [["1", "a", "x"], ["1", "b", "x"], ["9", "odd", None]]),
            row(5, "update", [["1", "odd", None]]),
            row(6, "delete", [["1", "b", "x"]]),
            row(7, "ddl", query="ALTER TABLE users ADD x INT"),
            row(8, "xid"),
            row(9, "rotate", next_file="mysql-bin.000100"),
            row(10, "insert", [["5", "C", None]], table="us.ers"),
        ],
        BINLOG,
    )


@pytest.mark.parametrize("broadcast", [True, False])
def test_binlog(spark, broadcast):
    stamped = stamp_binlog_file(binlog_rows(spark), broadcast=broadcast)
    rows = sorted(decode_binlog(stamped).collect(), key=lambda r: (r.seq, r.idx))
    assert [(r.type, r.table, r.data, r.lsn) for r in rows] == [
        ("INSERT", "users", '{"id":1, "name":"early", "email":null}', ""),
        ("INSERT", "users", '{"id":1, "name":"Alice", "email":null}', "mysql-bin.000099:30"),
        ("INSERT", "users", '{"id":2, "name":"B\\"ob", "email":null}', "mysql-bin.000099:30"),
        ("UPDATE", "users", '{"old":{"id":1, "name":"a", "email":"x"}, "new":{"id":1, "name":"b", "email":"x"}}', "mysql-bin.000099:40"),
        ("DELETE", "users", '{"id":1, "name":"b", "email":"x"}', "mysql-bin.000099:60"),
        ("DDL", "", "ALTER TABLE users ADD x INT", ""), ("COMMIT", "", "", ""),
        ("INSERT", "us.ers", '{"id":5, "name":"C", "email":null}', "mysql-bin.000100:100"),
    ]
    assert [r.idx for r in rows[1:3]] == [0, 1] and rows[-1].pos_hi == 100


def test_binlog_rejects(spark):
    extra = spark.createDataFrame(
        [
            ("m", None, 110, 11, "insert", "shop", "users", COLUMNS, [["7", "x", None, "more"], ["8", "y", None]], None, None, 5),
            ("m", None, 120, 12, "insert", "shop", "users", COLUMNS, [], None, None, 5),
            ("m", None, 130, 13, "truncate", "shop", "users", None, None, None, None, 5),
            ("m", None, 140, 14, None, None, None, None, None, None, None, 5),
        ],
        BINLOG,
    )
    stamped = stamp_binlog_file(binlog_rows(spark).unionByName(extra))
    rows = sorted(binlog_rejects(stamped).collect(), key=lambda r: r.seq)
    assert [(r.seq, r.idx, r.payload, r.reject_reason) for r in rows] == [
        (4, 1, '["9","odd",null]', "old row without new row"), (5, 0, '["1","odd",null]', "old row without new row"),
        (11, 0, '["7","x",null,"more"]', "more values than columns"), (12, 0, None, "no rows"),
        (13, 0, None, "unknown action"), (14, 0, None, "unknown action"),
    ]
    assert rows[0].lsn == "mysql-bin.000099:40" and rows[0].pos_hi == 99
    assert binlog_rejects(stamped.limit(0)).count() == 0


def test_binlog_pipeline_filters_exact_names(spark):
    kept = live_mysql(binlog_rows(spark), ["shop.us.ers"]).collect()
    assert sorted((r.type, r.subject) for r in kept) == [
        ("DDL", "cdc.shop._ddl"), ("INSERT", "cdc.shop.us_ers")]


PG_DUMP = r"""-- a dump
COPY public.users (id, name, email) FROM stdin;
1	Alice	alice@example.com
2	Bob	\N
3	Char\tlie\\n	charlie@test.com
\.

COPY public.orders (id, user_id,  total) FROM stdin;
10	1	99.99
20	2
30	3	1	surplus
\.
\.
some text
"""


def test_pg_dump_golden(spark, tmp_path):
    (tmp_path / "d.sql").write_text(PG_DUMP)
    rows = read_pg_dump(spark, str(tmp_path), "0/10").orderBy("seq").collect()
    assert [(r.table, r.data) for r in rows] == [
        ("users", '{"id":"1", "name":"Alice", "email":"alice@example.com"}'),
        ("users", '{"id":"2", "name":"Bob", "email":null}'),
        ("users", '{"id":"3", "name":"Char\\tlie\\\\n", "email":"charlie@test.com"}'),
        ("orders", '{"id":"10", "user_id":"1", "total":"99.99"}'),
        ("orders", '{"id":"20", "user_id":"2", "total":null}'),
        ("orders", '{"id":"30", "user_id":"3", "total":"1"}'),
    ]
    assert {(r.lsn, r.schema, r.pos_lo) for r in rows} == {("0/10", "public", 16)}
    only = read_pg_dump(spark, str(tmp_path), tables=["orders"], raw=True)
    assert {r.table for r in only.collect()} == {"orders"}
    raw = read_pg_dump(spark, str(tmp_path), raw=True).filter("data like '%Char%'").first().data
    assert raw == '{"id":"3", "name":"Char\\\\tlie\\\\\\\\n", "email":"charlie@test.com"}'


def test_pg_dump_headers_inside_data_and_bad_names(spark, tmp_path):
    text = (
        "COPY public.a (x) FROM stdin;\r\nCOPY public.b (y) FROM stdin;\r\n1\r\n\\.\r\n"
        "COPY public.a-b (x) FROM stdin;\n7\n\\.\nCOPY public.open (x) FROM stdin;\n8\n9"
    )
    (tmp_path / "d.sql").write_bytes(text.encode())
    rows = read_pg_dump(spark, str(tmp_path)).orderBy("seq").collect()
    assert [(r.table, r.data) for r in rows] == [
        ("a", '{"x":"COPY public.b (y) FROM stdin;"}'), ("a", '{"x":"1"}'),
        ("open", '{"x":"8"}'), ("open", '{"x":"9"}')]
    assert [r.value for r in pg_dump_rejects(spark, str(tmp_path)).collect()] == ["7"]


@pytest.mark.parametrize("small", [True, False])
def test_pg_dump_over_many_splits(spark, tmp_path, small, monkeypatch):
    """Blocks reach over split borders, with and without the broadcast lookup."""
    if not small:
        monkeypatch.setattr("changefeed.operators.ordered.BROADCAST_ROWS", 3)
    lines, want = [], []
    for block in range(30):
        lines.append(f"COPY public.t{block} (k, v) FROM stdin;")
        for k in range(block * 7 % 50):
            lines.append(f"{k}\tCOPY public.no (x) FROM stdin;")
            want.append((f"t{block}", k))
        lines += ["\\.", ""]
    for name in ("a.sql", "b.sql"):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        rows = read_pg_dump(spark, str(tmp_path)).select(
            "table", F.get_json_object("data", "$.k").cast("int").alias("k")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r.table, r.k) for r in rows) == sorted(want * 2)


def test_dumps_in_pieces(spark, tmp_path, monkeypatch):
    """A folder is one dump: blocks reach over its files, and lines are numbered along them; large inputs are written so."""
    lines = PG_DUMP.split("\n")
    marks = [f"-- CHANGE MASTER TO MASTER_LOG_FILE='mysql-bin.000002', MASTER_LOG_POS={k};" for k in range(len(lines))]
    for folder in ("d0", "d1"):
        (tmp_path / folder).mkdir()
        for i, at in enumerate(range(0, len(lines), 2)):
            both = [x for pair in zip(lines[at : at + 2], marks[at : at + 2]) for x in pair] if folder == "d1" else lines[at : at + 2]
            (tmp_path / folder / f"part-{i:05}.sql").write_text("\n".join(both) + "\n")
    (tmp_path / "whole.sql").write_text("\n".join(lines) + "\n")
    want = read_pg_dump(spark, str(tmp_path / "whole.sql")).select("table", "data", "seq").collect()
    got = read_pg_dump(spark, str(tmp_path / "d0"), pieces=True).select("table", "data", "seq").collect()
    assert sorted(got) == sorted(want)
    found = dump_position(spark, str(tmp_path / "d1"), pieces=True).collect()
    assert [(r.log_pos, r.file[-2:]) for r in found] == [(len(lines) - 1, "d1")]

    monkeypatch.setattr(fixtures, "PIECE_BYTES", 2000)
    rows = spark.range(500).selectExpr("id % 8 as part", "1 as rank", "id as place", "concat(id, repeat('x', 50)) as value")
    wide = rows.selectExpr("part", "2 as rank", "place", "concat(place, repeat('y', 200)) as value")
    fixtures._dump_lines([rows, wide], str(tmp_path / "out"))
    assert max(f.stat().st_size for f in (tmp_path / "out").rglob("*.txt")) < 8000
    kept = read_lines(spark, str(tmp_path / "out"), pieces=True).orderBy("line").collect()
    want = [r.value for r in rows.unionByName(wide).orderBy("part", "rank", "place").collect()]
    assert [r.value for r in kept] == want and [r.line for r in kept] == list(range(1000))
    assert len({r.file for r in kept}) == 8


MYSQL_DUMP = r"""-- CHANGE MASTER TO MASTER_LOG_FILE='mysql-bin.000002', MASTER_LOG_POS=4;
-- CHANGE MASTER TO MASTER_LOG_FILE='mysql-bin.000003', MASTER_LOG_POS=154;
INSERT INTO `users` VALUES (1,'Alice','alice@test.com'),(2,'Bob',NULL);
INSERT INTO `orders` VALUES (10,1,99.99),(20,2,-49.50);
INSERT INTO `docs` VALUES (1,'it''s a \"test\"','line1\nline2'),(0xFF,'a),(b','\\n NULL'),(3,'NULL','');
CREATE TABLE x (y int);
"""


def test_mysql_dump_golden(spark, tmp_path):
    (tmp_path / "d.sql").write_text(MYSQL_DUMP)
    events = read_mysql_dump(spark, str(tmp_path), "shop", columns={"users": ["id", "name"]})
    rows = events.orderBy("seq", "idx").collect()
    assert [(r.table, r.data) for r in rows] == [
        ("users", '{"id":"1", "name":"Alice", "col_2":"alice@test.com"}'),
        ("users", '{"id":"2", "name":"Bob", "col_2":null}'),
        ("orders", '{"col_0":"10", "col_1":"1", "col_2":"99.99"}'),
        ("orders", '{"col_0":"20", "col_1":"2", "col_2":"-49.50"}'),
        ("docs", '{"col_0":"1", "col_1":"it\'s a \\"test\\"", "col_2":"line1\\nline2"}'),
        ("docs", '{"col_0":"0xFF", "col_1":"a),(b", "col_2":"\\\\n NULL"}'),
        ("docs", '{"col_0":"3", "col_1":"NULL", "col_2":""}'),
    ]
    assert {(r.schema, r.lsn) for r in rows} == {("shop", "")}
    at = dump_position(spark, str(tmp_path)).collect()
    assert [(r.log_file, r.log_pos, r.pos_hi) for r in at] == [("mysql-bin.000003", 154, 3)]


def test_dump_without_events_or_position(spark, tmp_path):
    (tmp_path / "d.sql").write_text("-- nothing\n")
    assert read_pg_dump(spark, str(tmp_path)).count() == 0
    assert read_mysql_dump(spark, str(tmp_path), "s").count() == 0
    assert dump_position(spark, str(tmp_path)).count() == 0


def test_snapshot_events(spark):
    df = spark.createDataFrame([(42, 'al"ice', None, True)], 'id int, `na"me` string, gone string, ok boolean')
    assert rows_to_events(df, "public", "users").first().data == (
        '{"id":"42", "na\\"me":"al\\"ice", "gone":null, "ok":"true"}')
    assert rows_to_events(df, "public", "users", typed=True).first().data == (
        '{"id":42, "na\\"me":"al\\"ice", "gone":null, "ok":true}')
    event = rows_to_events(df, "public", "users", lsn="mysql-bin.000004:77").first()
    assert (event.type, event.pos_hi, event.pos_lo) == ("INSERT", 4, 77)
    assert accepted(rows_to_events(spark.range(5).select(), "public", "none")).first().data == "{}"


def test_chunks_match_row_numbers(spark):
    keys = spark.range(1000).select((F.col("id") * 7919 * F.when(F.col("id") % 2 == 0, -1).otherwise(1)).alias("k"))
    got = {r.k: r.chunk_id for r in keyset_chunks(keys, ["k"], 30).collect()}
    assert got == {k: i // 30 for i, k in enumerate(sorted(got))}
    # a third of all rows identical, the first key column nearly constant
    rows = [("a", 1)] * 300 + [("a", i) for i in range(300)] + [("b", i) for i in range(300)]
    df = spark.createDataFrame(rows, "x string, y int").repartition(5)
    for chunks in (keyset_chunks(df, ["x", "y"], 50), offset_chunks(df, 50)):
        got = sorted((r.x, r.y, r.chunk_id) for r in chunks.collect())
        assert got == [(x, y, i // 50) for i, (x, y) in enumerate(sorted(rows))]


def test_next_chunk_walks_a_composite_key(spark):
    rows = [(i // 10, i % 10) for i in range(100)]
    df = spark.createDataFrame(rows, "a int, b int")
    seen, after = [], None
    while True:
        part = [tuple(r) for r in next_chunk(df, ["a", "b"], after, 17).collect()]
        seen += part
        if len(part) < 17:
            break
        after = list(part[-1])
    assert seen == rows


def test_chunk_at_finds_its_edges_by_rank(spark, monkeypatch):
    """Any offset, also inside runs of equal rows, with nulls, NaN and clashing names; few pivots make many rounds."""
    monkeypatch.setattr(rank_select, "SIDE", 3)
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None, "é"]), rng.choice([1.5, None, float("nan"), -2.0]), rng.randrange(6)) for _ in range(150)]
    rows += [("b", 1.5, 2)] * 120
    df = spark.createDataFrame(rows, "at string, hit double, k int").repartition(3).persist()
    whole = [str(r) for r in df.orderBy("at", "hit", "k").collect()]
    for offset, n in ((0, 1), (0, 270), (7, 40), (100, 5), (130, 100), (269, 1), (260, 50), (270, 3), (5, 0)):
        assert [str(r) for r in chunk_at(df, offset, n).collect()] == whole[offset : offset + n]
    assert chunk_at(df.limit(0), 0, 5).count() == 0
    times = spark.range(60).selectExpr("timestamp_micros((id div 3) * 1800000001) as t", "cast(date'2024-01-01' + cast(id as int) as timestamp_ntz) as u")
    assert chunk_at(times, 31, 20).collect() == times.orderBy("t", "u").collect()[31:51]
    one = spark.createDataFrame([("x",)] * 40, "name string")
    assert chunk_at(one, 10, 20).count() == 20 and chunk_at(one, 35, 20).count() == 5
    df.unpersist()
