"""State carried along logs, damaged messages, log files, dump lines, filling and committed delivery."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from changefeed.operators import assign_transactions, delivery_audit
from changefeed.operators.log_scan import carry_along
from changefeed.operators.subscriptions import subscribe
from changefeed.operators.unchanged import fill_unchanged
from changefeed.sources import (
    decode_images, decode_wal, mysql_dump_rejects, numbered_rows, read_log, read_mysql_dump, read_pg_dump, rows_to_events,
    stream_log, wal_rejects,
)
from changefeed.streaming import publish, publish_stream, read_published, wal_decoder
from changefeed.streaming.publish import load_state, store_state
from tests.test_operators import EVENTS, event, feed
from tests.test_streaming import land, stream
from tests.test_wal import USERS, WAL, ins, rel, trunc, upd, wal_of

MARKS = "source string, pos bigint, k bigint, mark boolean, v string, pad string"


def _brute(rows, inclusive):
    state, out = {}, []
    for source, pos, k, mark, v, pad in sorted((r for r in rows if None not in r[:3]), key=lambda r: (r[0], r[1])):
        before = state.get((source, k), (0, None))
        if mark:
            state[source, k] = (before[0] + 1, v)
        out.append((source, pos, *(state.get((source, k), (0, None)) if inclusive else before)))
    out += [(r[0], r[1], 0, None) for r in rows if None in r[:3]]
    return sorted(out, key=str)


@pytest.mark.parametrize("inclusive", [True, False])
def test_carry_along_files(spark, tmp_path, inclusive):
    """Files that share tasks in any order, several sources and keys, null keys, small batches."""
    draw = random.Random(1)
    rows = [(f"s{draw.randrange(3)}", pos, draw.randrange(4), draw.random() < 0.1, f"v{pos}" if pos % 7 else None, "x" * draw.randrange(300))
            for pos in range(4000)]
    rows += [(None, 4001, 1, True, "n", ""), ("s1", None, 1, True, "n", ""), ("s1", 4003, None, True, "n", "")]
    for i in range(8):
        part = spark.createDataFrame(rows[i * 500 : (i + 1) * 500 + (3 if i == 7 else 0)], MARKS)
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    try:
        got = carry_along(log, [F.col("pos")], ["k"], F.col("mark"), F.col("v"), inclusive)
        assert [f.name for f in got.schema] == [*log.columns, "_count", "_value"]
        found = sorted(((r["source"], r["pos"], r["_count"], r["_value"]) for r in got.collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == _brute(rows, inclusive)
    # no payload in an exchange
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    # equal positions, or rows out of a shuffle, are no log order
    twice = log.unionByName(log)
    assert carry_along(twice, [F.col("pos")], ["k"], F.col("mark"), F.col("v")) is None
    assert carry_along(log.repartition(4), [F.col("pos")], ["k"], F.col("mark"), F.col("v")) is None


@pytest.mark.parametrize("boundary", ["BEGIN", "COMMIT"])
def test_framing_in_place_equals_shuffled(spark, tmp_path, boundary):
    kinds = ["INSERT", "BEGIN", "INSERT", "COMMIT", "BEGIN", "INSERT", "INSERT", "COMMIT", "INSERT"] * 3
    rows = feed(spark, *[event(i + 1, kind, source_ts=(i if kind == "BEGIN" else 0), source="st"[i % 2]) for i, kind in enumerate(kinds)])
    rows.coalesce(1).sortWithinPartitions("pos_lo").write.parquet(str(tmp_path / "feed"))
    log = spark.read.parquet(str(tmp_path / "feed"))
    initial = spark.createDataFrame([("s", 10, 77)], "source string, tx_no bigint, tx_timestamp bigint")
    for begun in (None, initial):
        took = [sorted((r.source, r.pos_lo, r.tx_no, str(r.tx_timestamp)) for r in assign_transactions(df, boundary, begun).collect())
                for df in (log, log.repartition(3))]
        assert took[0] == took[1]


def test_nothing_cut_is_lost(spark, tmp_path):
    """A cut RELATION is rejected and so are its rows; a cut DDL row too; in batch and stream."""
    log = rel(9, "_cdc_ddl_log", [("id", 23), ("command_tag", 25)])
    first, second = rel(1, "t", [("a", 23)]), rel(1, "t", [("a", 23), ("b", 25)])
    messages = [first, log, ins(1, "1"), second[:-1], ins(1, "1", "2"), ins(9, "5", "ALTER")[:-2], b"R\0", second, ins(1, "3", "4")]
    wal = wal_of(spark, messages)
    want = [(400, "RELATION", "truncated message"), (500, "INSERT", "unknown relation"), (600, "DDL", "truncated message"),
            (700, "RELATION", "truncated message")]
    for broadcast in (True, False):
        bad = wal_rejects(wal, capture_ddl=True, tables=["t"], broadcast=broadcast).collect()
        assert sorted((r.pos_lo, r.type, r.reject_reason) for r in bad) == want
        events = decode_wal(wal, capture_ddl=True, tables=["t"], broadcast=broadcast).collect()
        assert sorted((r.pos_lo, r.data) for r in events) == [(300, '{"a":1}'), (900, '{"a":3, "b":"4"}')]
    land(wal, str(tmp_path / "in"), 4, "lsn")
    publish_stream(
        stream(spark, str(tmp_path / "in"), WAL), str(tmp_path / "out"), str(tmp_path / "cp"),
        prepare=wal_decoder(str(tmp_path / "layouts"), tables=["t"], capture_ddl=True), quarantine=str(tmp_path / "bad"),
    ).awaitTermination(180)
    bad = spark.read.parquet(str(tmp_path / "bad")).filter("payload is not null").collect()
    assert sorted((r.pos_lo, r.type, r.reject_reason) for r in bad) == want
    assert read_published(spark, str(tmp_path / "out")).count() == 2


def test_log_files_batch_and_stream(spark, tmp_path):
    wal = wal_of(spark, [USERS, *[ins(1, str(i), "a", "t") for i in range(40)], b"C", trunc(0, 1)])
    path = str(tmp_path / "log")
    rows = wal.orderBy("lsn").collect()
    for i in range(0, 43, 11):
        spark.createDataFrame(rows[i : i + 11], WAL).coalesce(1).write.mode("append").parquet(str(tmp_path / f"p{i:02}"))
    import shutil
    (tmp_path / "log").mkdir()
    for i in range(0, 43, 11):
        shutil.copy(next((tmp_path / f"p{i:02}").glob("part-*.parquet")), tmp_path / "log" / f"log-{i:04}.parquet")
    assert read_log(spark, path).count() == 43
    # two readings of one log in one query keep their own bounds
    both = read_log(spark, path, kinds=["R"]).unionByName(read_log(spark, path, kinds=["I"], after=1000, up_to=3000))
    assert sorted((r["kind"], r["count"]) for r in both.groupBy("kind").count().collect()) == [("I", 20), ("R", 1)]
    assert sorted(map(str, decode_wal(read_log(spark, path)).drop("timestamp").collect())) == sorted(
        map(str, decode_wal(wal).drop("timestamp").collect()))
    assert read_log(spark, str(tmp_path / "none")).count() == 0 and read_log(spark, path, sources=["other"]).count() == 0
    seen: list[tuple] = []

    def run(name, **options):
        query = stream_log(spark, path, **options).writeStream.foreachBatch(
            lambda df, i: seen.extend((name, r.lsn) for r in df.select("lsn").collect())
        ).option("checkpointLocation", str(tmp_path / f"cp-{name}")).trigger(availableNow=True).start()
        query.awaitTermination(60)

    for _ in range(4):  # each start admits one group, and goes on where the last one ended
        run("some", starting="earliest", groups_per_batch=1, progress=str(tmp_path / "progress.json"))
    assert sorted(x for n, x in seen if n == "some") == sorted(r.lsn for r in rows)
    run("new")  # starts at the end of the log
    assert not [x for n, x in seen if n == "new"]
    shutil.copy(tmp_path / "log" / "log-0000.parquet", tmp_path / "log" / "log-9999.parquet")
    run("new")
    assert len([x for n, x in seen if n == "new"]) == 11
    with pytest.raises(Exception, match="progress"):
        run("bad", groups_per_batch=1)


def test_dump_lines_for_any_split(spark, tmp_path):
    """Events of one dump are equal in all columns however the files are cut."""
    for name, start in (("b.sql", 500), ("a.sql", 0)):
        lines = ["-- dump", "COPY public.t (k, v) FROM stdin;", *[f"{start + i}\tvalue {i % 9}" for i in range(400)], "\\.", "",
                 "INSERT INTO `m` VALUES (1,'a'),(2,'b');"]
        (tmp_path / name).write_text("\r\n".join(lines) + "\n")

    def all_rows():
        pg = read_pg_dump(spark, str(tmp_path), timestamp=F.lit(1).cast("bigint"))
        my = read_mysql_dump(spark, str(tmp_path), "db", timestamp=F.lit(1).cast("bigint"))
        return sorted(map(str, pg.collect())), sorted(map(str, my.collect())), [r.seq for r in pg.orderBy("seq").collect()]

    whole = all_rows()
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert all_rows() == whole
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert whole[2] == [*range(2, 402), *range(407, 807)] and len(whole[1]) == 4


def test_mysql_dump_rejects(spark, tmp_path):
    (tmp_path / "d.sql").write_text("\n".join([
        "INSERT INTO `t` VALUES (1,'a'),(2),(3,'d','more');", "INSERT INTO `t` (`k`) VALUES (4);",
        "INSERT INTO `t` VALUES (5,'e'),(6,'f", "INSERT INTO `t` VALUES (7,'g' 'h');", "INSERT INTO `u` VALUES (8),();", "-- no"]) + "\n")
    columns = {"t": ["k", "v"]}
    good = read_mysql_dump(spark, str(tmp_path), "db", columns=columns)
    assert sorted((r.seq, r.idx, r.data) for r in good.collect()) == [
        (0, 0, '{"k":"1", "v":"a"}'), (0, 2, '{"k":"3", "v":"d", "col_2":"more"}'), (2, 0, '{"k":"5", "v":"e"}'), (4, 0, '{"col_0":"8"}'), (4, 1, "{}")]
    bad = mysql_dump_rejects(spark, str(tmp_path), columns=columns)
    assert sorted((r.line, r.reject_reason) for r in bad.collect()) == [
        (0, "too few values"), (1, "no plain insert"), (2, "unread text in statement"), (3, "unread text in tuple")]


def test_fill_unchanged(spark, monkeypatch):
    """Values come from the newest image that had them, past a hot key's segments and through a changed key."""
    from changefeed.operators import ordered

    monkeypatch.setattr(ordered, "SEGMENT_BITS", 3)
    left = b"u"
    docs = rel(3, "docs", [("id", 23), ("body", 25), ("n", 23)])
    messages = [docs, upd(3, ["1", left, "0"]), ins(3, "1", "first \"text\"", "1")]
    messages += [upd(3, ["1", left, str(i)]) for i in range(2, 9)]
    messages += [upd(3, ["1", "second", "9"]), upd(3, ["1", left, left]), ins(3, "2", "other", "5"), upd(3, ["2", left, "6"]),
                 upd(3, ["7", left, "10"], ["1", None, None], b"K"), upd(3, ["7", left, "11"]), upd(3, ["8", left, "12"], ["8", left, "1"])]
    rows = fill_unchanged(decode_images(wal_of(spark, messages)), {"docs": ["id"]}).orderBy("pos_lo").collect()
    got = [(r.data, r.unchanged_cols) for r in rows]
    assert got[0] == ('{"new":{"id":1, "body":"unchanged", "n":0}}', ["body"])
    assert got[2:9] == [('{"new":{"id":1, "body":"first \\"text\\"", "n":%d}}' % i, []) for i in range(2, 9)]
    assert got[10][0] == '{"new":{"id":1, "body":"second", "n":9}}' and got[12][0] == '{"new":{"id":2, "body":"other", "n":6}}'
    assert got[13][0] == '{"old":{"id":1, "body":null, "n":null}, "new":{"id":7, "body":"second", "n":10}}'
    assert got[14] == ('{"new":{"id":7, "body":"second", "n":11}}', [])
    assert got[15][1] == ["body"]
    assert [r.data for r in fill_unchanged(decode_images(wal_of(spark, messages[:2])), {}).collect()] == [got[0][0]]


def test_subscriptions_equal_single_patterns(spark):
    from changefeed.operators import match_subject

    subjects = ["cdc.a.b", "cdc.a", "cdc", "", "cdc.a.b.c", "cdc..b", "cdc.a.", "x.a.b", "cdc.b.b", None]
    rows = spark.createDataFrame([(s, i) for i, s in enumerate(subjects * 2)], "subject string, id int")
    patterns = ["cdc.a.b", "cdc.*.b", "*.a.b", "cdc.>", "cdc.*.>", ">", "*", "*.*", "*.*.*", "cdc.a.>", "cdc..b", "cdc.a.", "none"]
    listed = spark.createDataFrame([(f"s{i}", p) for i, p in enumerate(patterns)] + [("n", None), ("s0", "cdc.a.b")], "subscriber string, pattern string")
    got = sorted((r.pattern, r.id, r.subscriber) for r in subscribe(rows, listed).collect())
    want = sorted((p, r.id, f"s{i}") for i, p in enumerate(patterns) for r in match_subject(rows, p).collect())
    assert got == want


def test_batch_is_seen_when_committed(spark, tmp_path, monkeypatch):
    """A delivery that dies between writing and committing shows nothing, and leaves no copies when it runs again."""
    import sys
    module = sys.modules["changefeed.streaming.publish"]
    target = str(tmp_path / "out")
    rows = feed(spark, event(1), event(2, "DDL", "", "x"), event(3, data="bad"))
    assert publish(rows, target, batch="one").collect()[0].lsn == "0/2"
    more = feed(spark, event(5), event(6))

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(module, "_commit", dies)
        with pytest.raises(RuntimeError):
            publish(more, target, batch="two")
    assert spark.read.parquet(target).count() == 4 and read_published(spark, target).count() == 2
    publish(more, target, batch="two")
    publish(more, target, batch="two")
    assert read_published(spark, target).count() == 4


def test_state_reads_few_folders(spark, tmp_path, monkeypatch):
    import sys
    module = sys.modules["changefeed.streaming.publish"]
    monkeypatch.setattr(module, "STATE_EVERY", 4)
    path, schema = str(tmp_path / "state"), "source string, n bigint"

    def newest(rows):
        return rows.groupBy("source").agg(F.max_by("n", "batch_id").alias("n"))

    for i in range(10):
        store_state(spark.createDataFrame([(f"s{i % 3}", i)], schema).coalesce(1), path, i, schema, newest)
    state = load_state(spark, path, schema, before=10)
    assert len({f.rsplit("/", 2)[1] for f in state.inputFiles()}) <= 1 + 4
    assert sorted((r.source, r.n) for r in newest(state).collect()) == [("s0", 9), ("s1", 7), ("s2", 8)]
    earlier = load_state(spark, path, schema, before=6)
    assert sorted((r.source, r.n) for r in newest(earlier).collect()) == [("s0", 3), ("s1", 4), ("s2", 5)]
    assert load_state(spark, str(tmp_path / "no"), schema).count() == 0


def test_equal_rows_without_a_key(spark):
    table = spark.createDataFrame([("x", 1)] * 3 + [("y", 2)], "a string, b int")
    plain = rows_to_events(table, "public", "t", source="s")
    lost = rows_to_events(table.limit(2), "public", "t", source="s")
    found = delivery_audit(plain, lost.unionByName(lost)).first()
    assert (found.expected, found.delivered, found.distinct_delivered, found.missing, found.duplicates) == (4, 4, 3, 1, 1)
    numbered = rows_to_events(numbered_rows(table), "public", "t", source="s", number="row_no")
    from changefeed.operators import drop_redelivered

    assert drop_redelivered(numbered.unionByName(numbered)).count() == 4
    assert sorted(r.seq for r in numbered.collect()) == [1, 2, 3, 4] and EVENTS
