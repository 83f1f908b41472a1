"""Column functions against fixed expected values."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from changefeed.functions import (
    format_binlog_pos,
    format_lsn,
    is_valid_json,
    json_escape,
    parse_binlog_pos,
    parse_lsn,
    render_mysql_value,
    render_pg_value,
    render_row,
    subject,
    subject_matches,
)
from changefeed.functions.payload import build_update
from changefeed.sources.snapshot import check_identifier, jdbc_read_options


def column(spark, values, build, schema="v string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r[0] for r in rows.orderBy("i").select(build(F.col("v"))).collect()]


def escaped(text):
    """The rule: quote and backslash, five short names, other controls and DEL by number, the rest as it is."""
    short = dict(zip("\"\\\n\r\t\b\f", '"\\nrtbf'))
    return "".join(
        "\\" + short[c] if c in short else f"\\u{ord(c):04x}" if ord(c) < 32 or ord(c) == 127 else c for c in text
    )


def test_escape(spark):
    one = [chr(code) for code in [*range(0x21), *range(0x7E, 0xA2), 0x2028, 0x1F40C]]
    texts = ["", "plain words", "\\u000B", *[f"{c}{c}-{c}" for c in one], *[f'"{c}\\' for c in one], "".join(one)]
    assert column(spark, texts, json_escape) == [escaped(t) for t in texts]


def test_escape_every_byte(spark):
    texts = [f"<{chr(code)}>" for code in range(0x100)]
    for text, shown in zip(texts, column(spark, texts, json_escape)):
        assert json.loads(f'"{shown}"') == text


def test_escape_replaces_invalid_utf8(spark):
    bad = spark.createDataFrame([(b"a\xffb",)], "v binary")
    assert bad.select(json_escape(F.col("v").cast("string"))).first()[0] == "a�b"


JSON_CASES = [
    ('{"a":1}', True), ('{"a":1} x', False), ("1,2", False), ("1],[2", False),
    ('{"a":1}{"b":2}', False), ("not json", False), ("{'a':1}", False), ('"a\tb"', False),
    ('{"a":1,"a":2}', True), (' {"a":[1, null, true]} ', True), ("[1,]", False), ("01", False),
    ("NaN", False), ("-0.5e+3", True), ('"\\ud83d"', True), ('"\\x"', False), ("", False),
    ("[" * 600 + "]" * 600, True), ("1" * 1200, True), ("0" * 1200, False),
    ('"' + "x" * 1200 + "\\q" + '"', False), (None, False),
]


def test_json_gate(spark):
    got = column(spark, [a for a, _ in JSON_CASES], is_valid_json)
    assert got == [b for _, b in JSON_CASES]


def test_json_gate_judges_long_texts_whole(spark):
    long = F.repeat(F.lit('abcdefgh\\"'), 2_200_000)
    good = F.concat(F.lit('{"a":"'), long, F.lit('"}'))
    row = spark.range(1).select(
        is_valid_json(good).alias("good"), is_valid_json(F.concat(good, F.lit("}"))).alias("bad")
    )
    assert tuple(row.first()) == (True, False)


def test_lsn(spark):
    values = [0, 1, 0x1A2B3C4D, (5 << 32) + 255, 2**62]
    shown = column(spark, values, format_lsn, "v bigint")
    assert shown == ["0/0", "0/1", "0/1A2B3C4D", "5/FF", "40000000/0"]
    assert column(spark, shown, parse_lsn) == values
    assert column(spark, ["", "x/1", "1", "1/123456789"], parse_lsn) == [None] * 4


def test_binlog_position(spark):
    at = spark.createDataFrame([("mysql-bin.000007", 4242), ("", 5), (None, 5)], "f string, p long")
    shown = [r[0] for r in at.select(format_binlog_pos(F.col("f"), F.col("p"))).collect()]
    assert shown == ["mysql-bin.000007:4242", "", ""]
    texts = ["mysql-bin.000042:1234", "", "bad-lsn", "mysql-bin.000001:not-a-number", "a:b:7",
             "f:4294967296", "f:4294967295"]
    parsed = column(spark, texts, parse_binlog_pos)
    assert [(p.file, p.position, p.error is None) for p in parsed] == [
        ("mysql-bin.000042", 1234, True), (None, None, True), (None, None, False),
        (None, None, False), ("a:b", 7, True), (None, None, False), ("f", 4294967295, True),
    ]


SUBJECTS = [
    ("cdc", "public", "users", "cdc.public.users"),
    ("cdc.tenant-a", "public", "users", "cdc.tenant-a.public.users"),
    ("cdc", "", "users", "cdc.default.users"), ("cdc", "public", "", "cdc.public._ddl"),
    ("cdc", "", "", "cdc.default._ddl"), ("cdc", "a.b", "users", "cdc.a_b.users"),
    ("cdc", "public", "us*rs", "cdc.public.us_rs"), ("cdc", "public", "us>rs", "cdc.public.us_rs"),
    ("cdc", "my schema", "my table", "cdc.my_schema.my_table"),
]


def test_subject(spark):
    rows = spark.createDataFrame(SUBJECTS, "p string, s string, t string, want string")
    shown = rows.select(subject(F.col("s"), F.col("t"), F.col("p")).alias("got"), "want")
    assert all(r.got == r.want for r in shown.collect())


def test_subject_patterns(spark):
    addresses = ["cdc.a.t", "cdc.a", "cdc.a.", "cdc.ab.t", "xcdc.a.t", "cdc.a.t.u", "cdcXaXt"]
    for pattern, want in {
        "cdc.a.t": ["cdc.a.t"], "cdc.a.>": ["cdc.a.t", "cdc.a.t.u"],
        "cdc.*.t": ["cdc.a.t", "cdc.ab.t"], "cdc.*": ["cdc.a"],
        "cdc.*.>": ["cdc.a.t", "cdc.ab.t", "cdc.a.t.u"], ">": addresses,
    }.items():
        hits = column(spark, addresses, lambda c, p=pattern: subject_matches(c, p))
        assert [a for a, hit in zip(addresses, hits) if hit] == want, pattern


def test_pg_values(spark):
    cases = [
        ("32767", 21, "t", "32767"), ("99999.990", 1700, "t", "99999.990"), ("t", 16, "t", "true"),
        ("f", 16, "t", "false"), ("yes", 16, "t", "false"), ('{"foo": "bar"}', 3802, "t", '{"foo": "bar"}'),
        ("not valid json", 114, "t", '"not valid json"'), ("a\tb", 25, "t", '"a\\tb"'),
        (None, 23, "n", "null"), (None, 25, "u", '"unchanged"'), (None, 25, "x", '"unknown"'),
        ("NaN", 701, "t", "NaN"),
    ]
    rows = spark.createDataFrame(cases, "v string, oid int, m string, want string")
    got = rows.select(render_pg_value(F.col("v"), F.col("oid"), F.col("m")).alias("got"), "want")
    assert [r.got for r in got.collect()] == [c[3] for c in cases]


def test_mysql_values(spark):
    cases = [
        ("42", "bigint(20) unsigned", "42"), ("1", "tinyint(1)", "true"), ("0", "boolean", "false"),
        ("7", "tinyint(4)", "7"), ("1.50", "decimal(10,2)", "1.50"),
        ('hello "world"', "varchar(20)", '"hello \\"world\\""'), ("a\nb\tc", "text", '"a\\nb\\tc"'),
        ("bin", "blob", '"bin"'), ("2026-04-20 12:34:56.789", "datetime(3)", '"2026-04-20T12:34:56.789Z"'),
        ("2026-04-20 12:34:56", "timestamp", '"2026-04-20T12:34:56.000Z"'),
        ("2026-04-20", "date", '"2026-04-20"'), ("12:00:01", "time", '"12:00:01"'),
        ('{"foo":"bar"}', "json", '{"foo":"bar"}'), ("not-json{", "json", '"not-json{"'),
        ("[1,2,3]", "JSON", "[1,2,3]"), (None, "int", "null"), ("0000-00-00 00:00:00", "datetime", '"0000-00-00 00:00:00"'),
    ]
    rows = spark.createDataFrame(cases, "v string, t string, want string")
    got = [r[0] for r in rows.select(render_mysql_value(F.col("v"), F.col("t"))).collect()]
    assert got == [c[2] for c in cases]
    raw = spark.createDataFrame([(b"\xff\x00",)], "v binary").select(
        render_mysql_value(F.col("v").cast("string"), F.lit("varbinary(9)"))
    )
    assert raw.first()[0] == '"/wA="'


def test_row_and_update_images(spark):
    row = spark.range(1).select(
        render_row(F.array(F.lit("id")), F.array(F.lit("1"), F.lit("null"))).alias("row"),
        build_update(F.lit('{"a":1}'), F.lit('{"a":2}')).alias("both"),
        build_update(F.lit(None).cast("string"), F.lit('{"a":2}')).alias("new"),
        build_update(F.lit(None).cast("string"), F.lit(None).cast("string")).alias("none"),
    ).first()
    assert tuple(row) == (
        '{"id":1, "col_1":null}', '{"old":{"a":1}, "new":{"a":2}}', '{"new":{"a":2}}', "{}"
    )


@pytest.mark.parametrize("name", ["users", "my_table", "_leading", "TableName", "t1", "a"])
def test_good_identifier(name):
    assert check_identifier(name) == name


@pytest.mark.parametrize(
    "name", ["", "1users", "user-name", "user.name", "user name", "users;DROP TABLE x", "users$", "привет"]
)
def test_bad_identifier(name):
    with pytest.raises(ValueError):
        check_identifier(name)


def test_jdbc_splits():
    ranged = jdbc_read_options("public", "users", ["id"], (1, 100), 4)
    assert ranged["column"] == '"id"' and ranged["numPartitions"] == 4
    assert (ranged["lowerBound"], ranged["upperBound"]) == (1, 101)
    hashed = jdbc_read_options("public", "users", None, None, 3)
    assert len(hashed["predicates"]) == 3 and len(set(hashed["predicates"])) == 3
    with pytest.raises(ValueError):
        jdbc_read_options("public", "users; drop table x")


@pytest.mark.parametrize("opening, core, closing", [("[", "1", "]"), ('{"a":', "[]", "}"), ('[{"k\\n": ', '"x["', "}]")])
def test_deep_json_is_judged_whole(spark, opening, core, closing):
    cases = []
    for depth in (300, 900, 1500):
        cases += [(opening * depth + core + closing * depth, True), (opening * depth + core + closing * (depth - 1), False)]
        cases += [(opening * depth + bad + closing * depth, False) for bad in ("1[]", "-[]", "{[]:1}", "[1,]")]
    rows = spark.createDataFrame(cases, "t string, want boolean").select("want", is_valid_json(F.col("t")).alias("got"))
    assert all(r.got == r.want for r in rows.collect())


def test_very_deep_json(spark):
    cases = [("[" * d + "]" * d, d <= 10_000) for d in (9000, 10_001)]
    rows = spark.createDataFrame(cases, "t string, want boolean").select("want", is_valid_json(F.col("t")).alias("got"))
    assert all(r.got == r.want for r in rows.collect())
