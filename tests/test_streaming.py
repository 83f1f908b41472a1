"""Streaming delivery: same events as batch, across batches and restarts."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from changefeed.operators import accepted, add_subject, assign_transactions, publishable, validate
from changefeed.operators.envelope import parse_envelope
from changefeed.sources import decode_binlog, decode_wal, stamp_binlog_file
from changefeed.streaming import (
    binlog_decoder,
    framed,
    heartbeat_stream,
    load_acked,
    publish,
    publish_stream,
    read_published,
    wal_decoder,
)
from tests.test_operators import EVENTS, event, feed
from tests.test_sources import BINLOG, binlog_rows
from changefeed.sources.wal import wal_rejects
from tests.test_wal import USERS, WAL, ins, rel, upd, wal_of


def land(df, folder, parts, order):
    """Write rows as ordered files that a file stream picks up one by one."""
    rows = df.orderBy(order).collect()
    size = -(-len(rows) // parts)
    for i in range(parts):
        part = df.sparkSession.createDataFrame(rows[i * size:(i + 1) * size], df.schema)
        part.coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.05)


def stream(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def messages(spark, target):
    return sorted(r.value for r in read_published(spark, target).collect())


def expected(events):
    from changefeed.operators import to_messages

    return sorted(r.value for r in to_messages(publishable(accepted(events))).collect())


def wal_messages():
    return [USERS, ins(1, "1", "a", "t"), rel(2, "t", [("v", 701)]), ins(2, "NaN"), ins(2, "1"),
            upd(1, ["1", "b", "t"]), rel(2, "t", [("w", 25)]), ins(2, "x"), ins(1, "2", "c", "f")]


def test_wal_stream_equals_batch(spark, tmp_path):
    wal = wal_of(spark, wal_messages())
    land(wal, str(tmp_path / "in"), 4, "lsn")
    seen = []
    query = publish_stream(
        stream(spark, str(tmp_path / "in"), WAL), str(tmp_path / "out"), str(tmp_path / "cp"),
        prepare=wal_decoder(str(tmp_path / "layouts")), acked=str(tmp_path / "acked"),
        quarantine=str(tmp_path / "bad"), on_batch=lambda df, i: seen.append((i, df.count())),
    )
    query.awaitTermination(120)
    assert messages(spark, str(tmp_path / "out")) == expected(decode_wal(wal))
    assert [i for i, _ in seen] == [0, 1, 2, 3] and sum(n for _, n in seen) == 5
    assert [r.lsn for r in load_acked(spark, str(tmp_path / "acked")).collect()] == ["0/384"]
    bad = spark.read.parquet(str(tmp_path / "bad")).collect()
    assert [r.data for r in bad] == ['{"v":NaN}']


def test_failed_batch_runs_again_without_loss_or_copies(spark, tmp_path):
    wal = wal_of(spark, wal_messages())
    land(wal, str(tmp_path / "in"), 4, "lsn")

    def start(on_batch):
        return publish_stream(
            stream(spark, str(tmp_path / "in"), WAL), str(tmp_path / "out"), str(tmp_path / "cp"),
            prepare=wal_decoder(str(tmp_path / "layouts")), acked=str(tmp_path / "acked"), on_batch=on_batch,
        )

    def fail(_, batch_id):
        if batch_id == 2:
            raise RuntimeError("sink lost")

    with pytest.raises(Exception):
        start(fail).awaitTermination(120)
    start(None).awaitTermination(120)
    assert messages(spark, str(tmp_path / "out")) == expected(decode_wal(wal))


def test_binlog_stream_equals_batch(spark, tmp_path):
    binlog = binlog_rows(spark)
    land(binlog, str(tmp_path / "in"), 5, "seq")
    publish_stream(
        stream(spark, str(tmp_path / "in"), BINLOG), str(tmp_path / "out"), str(tmp_path / "cp"),
        prepare=binlog_decoder(str(tmp_path / "files")), quarantine=str(tmp_path / "bad"),
    ).awaitTermination(180)
    assert messages(spark, str(tmp_path / "out")) == expected(decode_binlog(stamp_binlog_file(binlog)))
    bad = spark.read.parquet(str(tmp_path / "bad")).filter("payload is not null").collect()
    assert sorted((r.seq, r.reject_reason) for r in bad) == [(4, "old row without new row"), (5, "old row without new row")]


@pytest.mark.parametrize("boundary", ["BEGIN", "COMMIT"])
def test_transactions_across_batches(spark, tmp_path, boundary):
    kinds = ["INSERT", "BEGIN", "INSERT", "COMMIT", "BEGIN", "INSERT", "INSERT", "COMMIT", "INSERT"]
    rows = feed(spark, *[event(i + 1, kind, source_ts=(i if kind == "BEGIN" else 0)) for i, kind in enumerate(kinds)])
    land(rows, str(tmp_path / "in"), 4, "pos_lo")
    got = {}
    prepare = framed(str(tmp_path / "tx"), boundary=boundary)

    def take(batch, batch_id):
        for row in prepare(batch, batch_id).collect():
            got[row.pos_lo] = (row.tx_no, row.tx_timestamp)

    query = stream(spark, str(tmp_path / "in"), EVENTS).writeStream.foreachBatch(take).trigger(availableNow=True)
    query.option("checkpointLocation", str(tmp_path / "cp")).start().awaitTermination(180)
    whole = {r.pos_lo: (r.tx_no, r.tx_timestamp) for r in assign_transactions(rows, boundary).collect()}
    assert got == whole


def test_narrow_operators_stream_like_batch(spark, tmp_path):
    rows = feed(spark, event(1), event(2, data="x"), event(3, "DDL", "", "y"), event(4, "BEGIN", "", ""))
    land(rows, str(tmp_path / "in"), 2, "pos_lo")
    live = stream(spark, str(tmp_path / "in"), EVENTS)
    good, _ = validate(live)
    out = add_subject(publishable(good)).select("pos_lo", "subject")
    query = out.writeStream.format("memory").queryName("narrow").trigger(availableNow=True).start()
    query.awaitTermination(60)
    got = sorted(tuple(r) for r in spark.table("narrow").collect())
    assert got == [(1, "cdc.public.users"), (3, "cdc.public._ddl")]


def test_batch_publish_needs_its_target(spark, tmp_path):
    rows = feed(spark, event(1), event(2, "DDL", "", "x"), event(3, "COMMIT", "", ""), event(4, data="bad"))
    target = str(tmp_path / "sink")
    with pytest.raises(RuntimeError):
        publish(rows, target, require_existing=True)
    (tmp_path / "sink").mkdir()
    acked = publish(rows, target, require_existing=True)
    assert [r.lsn for r in acked.collect()] == ["0/2"]
    stored = read_published(spark, target)
    assert sorted(r.subject for r in stored.collect()) == ["cdc.public._ddl", "cdc.public.users"]
    events, bad = parse_envelope(stored)
    assert sorted(r.lsn for r in events.collect()) == ["0/1", "0/2"] and bad.count() == 0


def test_heartbeat_timer(spark, tmp_path):
    rows = feed(spark, event(1), event(2), event(7, source="t"), event(5, source="t"))
    land(rows, str(tmp_path / "in"), 1, "pos_lo")
    beats = heartbeat_stream(spark.readStream.schema(EVENTS).parquet(str(tmp_path / "in")), idle_ms=1500)
    query = (
        beats.writeStream.format("memory").queryName("beats").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(processingTime="500 milliseconds").start()
    )
    try:
        deadline = time.time() + 90
        while time.time() < deadline:
            got = spark.table("beats").collect()
            if min(sum(r.source == s for r in got) for s in "st") >= 2:
                break
            time.sleep(0.5)
    finally:
        query.stop()
    assert {(r.source, r.type, r.lsn) for r in got} == {("s", "HEARTBEAT", "0/2"), ("t", "HEARTBEAT", "0/7")}
    assert {r.idx for r in got if r.source == "s"} >= {1, 2}


def test_undecoded_messages_reach_the_quarantine(spark, tmp_path):
    wal = wal_of(spark, wal_messages())
    lost = wal.filter("substring(payload, 1, 1) <> X'52'")  # without relation messages nothing is known
    land(lost, str(tmp_path / "in"), 1, "lsn")
    publish_stream(
        stream(spark, str(tmp_path / "in"), WAL), str(tmp_path / "out"), str(tmp_path / "cp"),
        prepare=wal_decoder(str(tmp_path / "layouts")), quarantine=str(tmp_path / "bad"),
    ).awaitTermination(120)
    bad = spark.read.parquet(str(tmp_path / "bad"))
    want = sorted((r.lsn, r.reject_reason) for r in wal_rejects(lost).collect())
    assert want and sorted((r.lsn, r.reject_reason) for r in bad.filter("payload is not null").collect()) == want
