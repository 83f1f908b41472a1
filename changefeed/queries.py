"""Registered queries: each runs operators over whole benchmark tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changefeed import fixtures
from changefeed.functions.json_text import json_escape
from changefeed.functions.payload import before_after, payload_as, payload_field
from changefeed.functions.positions import (
    binlog_file_number,
    combined_position,
    format_binlog_pos,
    message_end_lsn,
    parse_binlog_pos,
    parse_lsn,
    pg_micros_to_epoch_ms,
)
from changefeed.operators import (
    accepted,
    acked_positions,
    add_subject,
    assign_transactions,
    bootstrap,
    ddl_log,
    delivery_audit,
    event_counts,
    filter_tables,
    heartbeats,
    intercept_ddl,
    latest_schema,
    match_subject,
    merge_feeds,
    parse_envelope,
    publishable,
    published_counts,
    reject_count,
    rejected,
    resume_from,
    route,
    route_all,
    route_tenants,
    schema_history,
    table_events,
    table_history,
    to_messages,
    with_source_timestamp,
)
from changefeed.operators.envelope import ENVELOPE
from changefeed.plans import live_mysql, live_postgres, start_feed, subject_counts
from changefeed.session import configure, gone_at_exit, shared_dir
from changefeed.sources import (
    binlog_rejects as rejected_rows,
    chunk_at,
    decode_binlog,
    decode_images,
    decode_wal,
    dump_position,
    keyset_chunks,
    next_chunk,
    offset_chunks,
    read_log,
    read_mysql_dump,
    read_pg_dump,
    read_relations,
    rows_to_events,
    stamp_binlog_file,
    wal_rejects,
)

from changefeed.operators.newest_layout import in_newest_layout
from changefeed.operators.subscriptions import subscribe
from changefeed.operators.unchanged import fill_unchanged
from changefeed.streaming import publish, read_published

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

SHORT_EVENT = ["source", "type", "schema", "table", "data", "lsn"]


def query(run: Query) -> Query:
    def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(configure(spark), sf_dir)

    REGISTRY[run.__name__] = configured
    return run


def _feed(spark, sf):
    return fixtures.feed(spark, sf)


def _money(name: str):
    return F.col(name).cast("decimal(12,2)")


# --- envelope, gate, filters ---------------------------------------------------


@query
def flagship_subject_counts(spark, sf):
    return subject_counts(_feed(spark, sf))


@query
def envelope_roundtrip(spark, sf):
    events, _ = parse_envelope(to_messages(_feed(spark, sf)))
    return events.select("key", *ENVELOPE)


def _damaged(spark, sf):
    """Envelopes, some with an unknown type or cut off in the middle."""
    messages = to_messages(_feed(spark, sf))
    value = F.col("value")
    return messages.select(
        "key",
        F.when(value.contains('"type":"DDL"'), F.replace(value, F.lit("DDL"), F.lit("ddl")))
        .when(value.contains('"type":"TRUNCATE"'), F.substring(value, F.lit(1), F.length(value) - 1))
        .otherwise(value)
        .alias("value"),
    )


@query
def envelope_rejects(spark, sf):
    _, bad = parse_envelope(_damaged(spark, sf))
    return bad.groupBy("key", "envelope_error").agg(F.count("*").alias("events"))


@query
def json_gate(spark, sf):
    return accepted(_feed(spark, sf)).select("lsn", "type", "table", "data")


@query
def json_rejects(spark, sf):
    return rejected(_feed(spark, sf)).select("lsn", "type", "table", "data", "reject_reason")


@query
def publishable_events(spark, sf):
    return publishable(_feed(spark, sf)).select("lsn", "type")


@query
def table_event_rows(spark, sf):
    return table_events(_feed(spark, sf)).select("lsn", "type", "table")


@query
def filter_bare(spark, sf):
    return filter_tables(_feed(spark, sf), ["click", "purchase"]).select("lsn", "schema", "table")


@query
def filter_qualified(spark, sf):
    listed = ["public.click", "my schema.error"]
    return filter_tables(_feed(spark, sf), listed, qualified=True).select("lsn", "schema", "table")


# --- subjects and routes -------------------------------------------------------


@query
def subject_build(spark, sf):
    return add_subject(_feed(spark, sf)).select("lsn", "subject")


@query
def subject_match(spark, sf):
    rows = add_subject(_feed(spark, sf))
    parts = [
        match_subject(rows, pattern).select(F.lit(pattern).alias("pattern"), "lsn", "subject")
        for pattern in ("cdc.public.click", "cdc.shop_eu.>", "cdc.*.error", "cdc.*.>")
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


@query
def tenant_routes(spark, sf):
    prefixes = spark.createDataFrame(
        [("db0", "cdc.tenant-a"), ("db1", "cdc.tenant-b")], "source string, prefix string"
    )
    return route_tenants(_feed(spark, sf), prefixes).select("lsn", "source", "subject")


@query
def route_tables(spark, sf):
    subscriptions = spark.createDataFrame(
        [("alice", "click"), ("bob", "click"), ("bob", "error"), ("carol", "missing")],
        "subscriber string, table string",
    )
    return route(accepted(_feed(spark, sf)), subscriptions).select("subscriber", "lsn", "table")


@query
def route_everything(spark, sf):
    return route_all(accepted(_feed(spark, sf)), "audit").select("subscriber", "lsn", "type")


@query
def subject_index(spark, sf):
    """All patterns that one star or a tail makes of every subject, matched at once."""
    rows = add_subject(_feed(spark, sf))
    tokens = F.split("subject", r"\.")
    starred = F.transform(
        F.sequence(F.lit(0), F.size(tokens) - 1),
        lambda k: F.array_join(F.transform(tokens, lambda t, i: F.when(i == k, "*").otherwise(t)), "."),
    )
    tails = F.transform(
        F.sequence(F.lit(0), F.size(tokens) - 1),
        lambda k: F.array_join(F.concat(F.slice(tokens, F.lit(1), k), F.array(F.lit(">"))), "."),
    )
    patterns = rows.select(F.explode(F.concat(starred, tails, F.array("subject"))).alias("pattern")).distinct()
    subscriptions = patterns.select(F.concat(F.lit("reads "), "pattern").alias("subscriber"), "pattern")
    return subscribe(rows, subscriptions).groupBy("pattern", "subscriber").agg(
        F.count("*").alias("events"), F.min("lsn").alias("first_lsn"), F.sum("seq").alias("seqs")
    )


# --- positions -----------------------------------------------------------------


@query
def lsn_format(spark, sf):
    return _feed(spark, sf).select(F.col("seq").alias("event_id"), "lsn")


@query
def lsn_parse(spark, sf):
    at = combined_position(F.col("pos_hi"), F.col("pos_lo"))
    return _feed(spark, sf).select("lsn", parse_lsn(F.col("lsn")).alias("pos"), at.alias("expected"))


@query
def lsn_message_end(spark, sf):
    payload = F.encode("data", "UTF-8")
    start = combined_position(F.col("pos_hi"), F.col("pos_lo"))
    return _feed(spark, sf).select("lsn", message_end_lsn(start, payload).alias("end_pos"))


@query
def binlog_pos(spark, sf):
    rows = fixtures.table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "no position")
        .when(F.col("o_orderstatus") == "F", F.concat(F.lit("mysql-bin.000001:x"), _money("o_totalprice")))
        .otherwise(
            format_binlog_pos(
                F.concat(F.lit("mysql:bin."), F.lpad(F.col("o_custkey").cast("string"), 6, "0")),
                F.col("o_orderkey") * 31,
            )
        )
        .alias("lsn"),
    )
    parsed = rows.withColumn("p", parse_binlog_pos(F.col("lsn")))
    return parsed.select(
        "o_orderkey", "lsn", "p.file", "p.position",
        binlog_file_number(F.col("p.file")).alias("file_number"), "p.error",
    )


@query
def pg_time(spark, sf):
    micros = F.unix_micros(F.col("ts").cast("timestamp")) - F.lit(946684800000000)
    return fixtures.table(spark, sf, "events").select(
        "event_id", pg_micros_to_epoch_ms(micros).alias("source_ms")
    )


# --- payloads ------------------------------------------------------------------


@query
def escape_texts(spark, sf):
    return fixtures.table(spark, sf, "documents").select(
        "doc_id", json_escape(F.col("text")).alias("escaped")
    )


@query
def escape_pages(spark, sf):
    return fixtures.table(spark, sf, "pages").select(
        "page_id", json_escape(F.col("html")).alias("escaped")
    )


@query
def update_images(spark, sf):
    rows = before_after(
        publishable(accepted(_feed(spark, sf))), "id bigint, value decimal(12,2)"
    )
    return rows.filter("type in ('INSERT', 'UPDATE', 'DELETE')").select(
        "lsn", "type",
        F.col("before.id").alias("before_id"), F.col("before.value").alias("before_value"),
        F.col("after.id").alias("after_id"), F.col("after.value").alias("after_value"),
    )


@query
def payload_fields(spark, sf):
    rows = table_events(accepted(_feed(spark, sf))).filter("type in ('INSERT', 'DELETE')")
    decoded = rows.withColumn(
        "row", payload_as(F.col("data"), "id bigint, value decimal(12,2), props string")
    )
    return decoded.select(
        "lsn", F.col("row.id").alias("id"), F.col("row.value").alias("value"),
        payload_field(F.col("data"), "$.props.k").cast("int").alias("k"),
    )


# --- snapshots -----------------------------------------------------------------


@query
def snapshot_orders(spark, sf):
    orders = fixtures.table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
        _money("o_totalprice").alias("o_totalprice"), "o_orderpriority",
    )
    chunks = keyset_chunks(orders, ["o_orderkey"], 1000)
    events = rows_to_events(chunks, "public", "orders", keep=["chunk_id"])
    return events.select("schema", "table", "data", "chunk_id")


@query
def snapshot_composite_key(spark, sf):
    items = fixtures.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"
    )
    chunks = keyset_chunks(items, ["l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], 1000)
    return chunks.groupBy("chunk_id").agg(
        F.count("*").alias("n"),
        F.min("l_returnflag").alias("first_flag"),
        F.sum("l_orderkey").alias("key_sum"),
    )


@query
def snapshot_offset(spark, sf):
    customers = fixtures.table(spark, sf, "customer").select("c_mktsegment", "c_custkey", "c_nationkey")
    return offset_chunks(customers, 100)


@query
def snapshot_typed(spark, sf):
    customers = fixtures.table(spark, sf, "customer").select(
        "c_custkey", "c_name", _money("c_acctbal").alias("c_acctbal"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"),
        (F.col("c_nationkey") > 12).alias("far"),
    )
    return rows_to_events(customers, "public", "customer", typed=True).select("table", "data")


@query
def chunk_limit(spark, sf):
    orders = fixtures.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return next_chunk(orders, ["o_orderkey"], [499], 100)


@query
def chunk_offset(spark, sf):
    return chunk_at(fixtures.table(spark, sf, "orders"), 500, 100)


@query
def chunk_ties(spark, sf):
    """A chunk of a table without a key, whose edges fall into runs of equal rows."""
    return chunk_at(fixtures.table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_shipdate"), 777, 1000)


# --- captured Postgres messages ------------------------------------------------


@query
def wal_decode(spark, sf):
    events = decode_wal(fixtures.captured_wal(spark, sf))
    return events.select(*SHORT_EVENT, "old_kind")


@query
def wal_filtered(spark, sf):
    wal = fixtures.captured_wal(spark, sf)
    return live_postgres(wal, tables=["customer", "nation"]).select("subject", "type", "data")


@query
def wal_truncate(spark, sf):
    events = decode_wal(fixtures.event_wal(spark, sf))
    return events.filter("type = 'TRUNCATE'").select("lsn", "table", "data", "idx")


@query
def wal_markers(spark, sf):
    events = decode_wal(fixtures.event_wal(spark, sf))
    return events.filter("type in ('BEGIN', 'COMMIT')").select(
        "lsn", "type", "schema", "table", "data", "sourceTimestamp"
    )


@query
def wal_versions(spark, sf):
    """Rows take the layout announced last before them."""
    events = decode_wal(fixtures.event_wal(spark, sf))
    return events.filter("type in ('INSERT', 'UPDATE', 'DELETE') and table <> '_cdc_ddl_log'").select(
        "lsn", "type", "table", "data"
    )


@query
def wal_unknown_relations(spark, sf):
    return wal_rejects(fixtures.event_wal(spark, sf)).select(
        "lsn", "type", "rel_id", "idx", "reject_reason"
    )


@query
def wal_merged_layouts(spark, sf):
    """The same decode without a broadcast of versions: layouts carried along the log."""
    events = decode_wal(fixtures.event_wal(spark, sf), broadcast=False)
    return events.select("lsn", "type", "table", "data", "idx")


@query
def wal_damaged(spark, sf):
    """Cut announcements and DDL rows come out as rejects, and so do rows whose layout is lost."""
    return wal_rejects(fixtures.damaged_wal(spark, sf), capture_ddl=True).select(
        "lsn", "type", "rel_id", "idx", "reject_reason"
    )


@query
def log_source(spark, sf):
    """Markers past a position, read from the log's files by their own data source."""
    log = read_log(spark, fixtures.event_wal_path(spark, sf), kinds=["B", "C"], after=2_000_000_000)
    return decode_wal(log).select("lsn", "type", "schema", "table", "data", "sourceTimestamp")


@query
def filled_images(spark, sf):
    """Values that updates left out, taken from the last message that had them."""
    images = decode_images(fixtures.notes_wal(spark, sf))
    filled = fill_unchanged(images, {"notes": ["id"]})
    return filled.select("lsn", "table", "data", F.array_join("unchanged_cols", ",").alias("unchanged"))


def _newest(wal):
    return in_newest_layout(decode_images(wal), schema_history(read_relations(wal)))


@query
def rows_newest_layout(spark, sf):
    """Rows of every version with the columns of the newest one."""
    events = _newest(fixtures.event_wal(spark, sf)).filter("table <> '_cdc_ddl_log'")
    return events.select("lsn", "type", "table", "data")


@query
def rows_renamed_column(spark, sf):
    """A column renamed on the way has its newest name in all rows."""
    return _newest(fixtures.captured_wal(spark, sf)).select("source", "type", "schema", "table", "data", "lsn", "old_kind")


# --- captured binlog events ----------------------------------------------------


@query
def binlog_decode(spark, sf):
    events = decode_binlog(stamp_binlog_file(fixtures.captured_binlog(spark, sf)))
    return events.select("source", "type", "schema", "table", "data", "lsn", "seq", "idx")


@query
def binlog_rejects(spark, sf):
    """The stray third rows of updates."""
    stamped = stamp_binlog_file(fixtures.captured_binlog(spark, sf))
    return rejected_rows(stamped).select("source", "type", "schema", "table", "lsn", "seq", "idx", "payload", "reject_reason")


@query
def binlog_file(spark, sf):
    stamped = stamp_binlog_file(fixtures.captured_binlog(spark, sf), broadcast=False)
    return stamped.select("source", "seq", "action", "file")


@query
def binlog_filtered(spark, sf):
    events = live_mysql(fixtures.captured_binlog(spark, sf), ["shop.orders"])
    return events.groupBy("subject", "type").agg(F.count("*").alias("events"))


# --- dumps ---------------------------------------------------------------------


@query
def pg_dump_scan(spark, sf):
    events = read_pg_dump(spark, fixtures.pg_dump_path(spark, sf), start_lsn="0/1A2B3C4D", pieces=True)
    return events.select("schema", "table", "data", "lsn")


@query
def mysql_dump_scan(spark, sf):
    path = fixtures.mysql_dump_path(spark, sf)
    events = read_mysql_dump(spark, path, "shop", columns=fixtures.MYSQL_COLUMNS, pieces=True)
    return events.select("schema", "table", "data")


@query
def dump_positions(spark, sf):
    found = dump_position(spark, fixtures.mysql_dump_path(spark, sf), pieces=True)
    return found.select("log_file", "log_pos", "pos_hi")


@query
def dump_lines(spark, sf):
    """Every dumped row with the number of its line in the whole dump."""
    events = read_pg_dump(spark, fixtures.pg_dump_path(spark, sf), pieces=True)
    key = F.regexp_extract("data", r'^\{"[a-z_]+":"([0-9]+)"', 1).cast("bigint")
    return events.select("table", key.alias("key"), "seq", "idx")


# --- DDL and schema history ----------------------------------------------------


@query
def ddl_intercept(spark, sf):
    """Every tenth user's inserts stand for rows of the DDL log table."""
    rows = _feed(spark, sf).withColumn(
        "table",
        F.when((F.col("type") == "INSERT") & (F.col("schema") == "public"), "_cdc_ddl_log")
        .otherwise(F.col("table")),
    )
    kept = filter_tables(intercept_ddl(rows), ["click", ""])
    return kept.select("lsn", "type", "schema", "table", "rawMessage")


@query
def ddl_rows(spark, sf):
    events = decode_wal(fixtures.event_wal(spark, sf), tables=["click"], capture_ddl=True)
    return ddl_log(events).drop("timestamp")


@query
def ddl_plain(spark, sf):
    events = decode_binlog(stamp_binlog_file(fixtures.captured_binlog(spark, sf)))
    return ddl_log(events).select("source", "schema", "query", "seq")


def _history(spark, sf):
    return schema_history(read_relations(fixtures.event_wal(spark, sf)))


def _versions(rows):
    return rows.select(
        "schema", "table", "position",
        F.array_join(F.transform("columns", lambda c: c["name"]), ",").alias("names"),
        F.array_join(F.transform("columns", lambda c: c["typeOid"].cast("string")), ",").alias("oids"),
    )


@query
def schema_versions(spark, sf):
    return _versions(_history(spark, sf))


@query
def schema_changes(spark, sf):
    relations = read_relations(fixtures.event_wal(spark, sf))
    return _versions(schema_history(relations, dedupe=True))


@query
def schema_latest(spark, sf):
    return _versions(latest_schema(_history(spark, sf)))


@query
def schema_of_table(spark, sf):
    return _versions(table_history(_history(spark, sf), "public", "click"))


# --- order-dependent operators -------------------------------------------------


@query
def tx_assign(spark, sf):
    framed = with_source_timestamp(assign_transactions(_feed(spark, sf)))
    return framed.select("source", "lsn", "type", "tx_no", "tx_timestamp", "sourceTimestamp")


@query
def tx_assign_commits(spark, sf):
    events = decode_binlog(stamp_binlog_file(fixtures.captured_binlog(spark, sf)))
    # the log order of this feed is its capture order
    ordered = events.withColumns({"pos_hi": F.lit(0).cast("bigint"), "pos_lo": F.col("seq")})
    framed = assign_transactions(ordered, boundary="COMMIT")
    return framed.groupBy("source", "tx_no").agg(
        F.count("*").alias("events"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq")
    )


@query
def heartbeat_gaps(spark, sf):
    return heartbeats(_feed(spark, sf)).select("source", "type", "lsn", "timestamp", "idx")


# --- metrics and delivery ------------------------------------------------------


@query
def events_by_type(spark, sf):
    return event_counts(_feed(spark, sf))


@query
def published_by_type(spark, sf):
    return published_counts(accepted(_feed(spark, sf)))


@query
def failed_total(spark, sf):
    return reject_count(_feed(spark, sf))


@query
def acked(spark, sf):
    return acked_positions(publishable(accepted(_feed(spark, sf))))


def _delivered_before(spark, sf):
    """What an earlier run delivered: two databases, up to mid-January."""
    return _feed(spark, sf).filter("timestamp < 1705276800000 and source <> 'db2'")


@query
def resume_after(spark, sf):
    rest = resume_from(_feed(spark, sf), acked_positions(_delivered_before(spark, sf)), "earliest")
    return rest.select("source", "lsn")


@query
def resume_latest(spark, sf):
    done = _delivered_before(spark, sf)
    # db2 is new: it starts at the log position of 20 January
    current = acked_positions(_feed(spark, sf).filter("timestamp < 1705708800000"))
    rest = resume_from(_feed(spark, sf), acked_positions(done), "latest", current)
    return rest.select("source", "lsn")


@query
def delivery_check(spark, sf):
    events = _feed(spark, sf)
    again = events.filter("type = 'INSERT'")
    arrived = events.filter("type <> 'DELETE'").unionByName(again)
    return delivery_audit(events, arrived)


@query
def bootstrap_union(spark, sf):
    customers = fixtures.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), _money("c_acctbal").alias("value")
    )
    base = rows_to_events(customers, "public", "click", source="db0")
    live = table_events(accepted(_feed(spark, sf)))
    merged = bootstrap(base, live, key=["id"])
    return merged.select("source", "schema", "table", "type", "data", "lsn", "from_snapshot")


@query
def bootstrap_delivered(spark, sf):
    customers = fixtures.table(spark, sf, "customer").select("c_custkey", "c_name")
    base = rows_to_events(customers, "public", "customer", source="db0")
    events = start_feed(base, _feed(spark, sf), tables=["customer", "click"])
    return events.groupBy("subject", "type").agg(F.count("*").alias("events"))


@query
def merge_two_databases(spark, sf):
    pg = publishable(accepted(_feed(spark, sf)))
    my = decode_binlog(stamp_binlog_file(fixtures.captured_binlog(spark, sf)))
    both = merge_feeds({"postgres": pg, "mysql": publishable(accepted(my))})
    return both.groupBy("source", "schema", "table", "type").agg(F.count("*").alias("events"))


@query
def publish_roundtrip(spark, sf):
    """Two batches published, the first one twice, and what readers see of them."""
    target = f"{shared_dir(spark)}/published-{uuid.uuid4().hex}"
    early = F.col("seq") % 3 == 0
    for batch, rows in (("a", early), ("a", early), ("b", ~early)):
        publish(_feed(spark, sf).filter(rows), target, batch=batch)
    gone_at_exit(spark, target)
    events, _ = parse_envelope(read_published(spark, target))
    return events.select("subject", "type", "schema", "table", "data", "lsn", "timestamp")


@query
def audit_snapshot(spark, sf):
    """Equal rows of a table without a key, some lost and some delivered twice."""
    rows = fixtures.table(spark, sf, "customer").select("c_nationkey", "c_mktsegment")
    events = rows_to_events(rows, "public", "customer", source="db0")
    nation = F.get_json_object("data", "$.c_nationkey").cast("int")
    arrived = events.filter(nation != 3).unionByName(events.filter(nation == 5))
    return delivery_audit(events, arrived)


@query
def resume_snapshot(spark, sf):
    """Snapshot rows have no position: none of them counts as delivered."""
    nations = rows_to_events(fixtures.table(spark, sf, "nation"), "public", "nation", source="db0")
    whole = _feed(spark, sf).unionByName(nations)
    rest = resume_from(whole, acked_positions(_delivered_before(spark, sf)))
    return rest.select("source", "schema", "table", "lsn", "data")
