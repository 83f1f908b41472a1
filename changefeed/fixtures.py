"""Change-feed inputs derived from the benchmark tables.

Nothing here is part of the toolkit: these functions turn the given tables into
the inputs it reads (an event feed, captured messages, dump files), as Spark
jobs over the whole tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changefeed.functions.positions import format_lsn, lsn_high, lsn_low
from changefeed.operators.envelope import EVENT_COLUMNS
from changefeed.session import gone_at_exit, settle, shared_dir

_written: dict[tuple, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(
    spark: SparkSession, kind: str, sf_dir: str, write: Callable[[str], None]
) -> str:
    """Path of a derived input, written once per session into shared storage."""
    key = (spark.sparkContext.applicationId, kind, sf_dir)
    if key not in _written:
        path = f"{shared_dir(spark)}/changefeed-{kind}-{uuid.uuid4().hex}"
        write(path)
        gone_at_exit(spark, path)
        _written[key] = path
    return _written[key]


# --- event feed --------------------------------------------------------------

EVENT_TYPE_SQL = """
    case when event_id % 97 = 0 then 'DDL' when event_id % 89 = 0 then 'BEGIN'
         when event_id % 83 = 0 then 'COMMIT' when event_id % 79 = 0 then 'TRUNCATE'
         when event_id % 73 = 0 then 'HEARTBEAT'
         when event_type in ('signup', 'purchase') then 'INSERT'
         when event_type = 'error' then 'DELETE' else 'UPDATE' end"""


def _json_row(value: str) -> str:
    return (
        "concat('{\"id\":', cast(user_id as string), ', \"value\":', "
        f"cast(cast({value} as decimal(12,2)) as string), ', \"props\":', props, '}}')"
    )


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One change event per row of ``events``, some with broken data."""
    value = "cast(value as decimal(12,2))"
    rows = table(spark, sf_dir, "events").selectExpr(
        "*",
        f"{EVENT_TYPE_SQL} as type",
        "event_id * 1000003 + 16777216 as pos",
        """case user_id % 4 when 0 then 'public' when 1 then 'shop.eu'
                when 2 then 'my schema' else '' end as schema""",
        "concat('db', cast(user_id % 3 as string)) as source",
        "unix_millis(cast(ts as timestamp)) as timestamp",
    )
    rows = rows.withColumns(
        {
            "table": F.expr(
                "case when type in ('INSERT','UPDATE','DELETE','TRUNCATE') "
                "then event_type else '' end"
            ),
            "data": F.expr(
                f"""case when event_id % 50 = 7 then 'not json'
                    when type in ('BEGIN','COMMIT','HEARTBEAT') then ''
                    when type = 'DDL' then 'ALTER TABLE x'
                    when type = 'TRUNCATE' then '{{"options":0}}'
                    when type = 'UPDATE' then concat('{{"old":', {_json_row(value)},
                        ', "new":', {_json_row(value + ' + 1')}, '}}')
                    else {_json_row(value + ' + 1')} end"""
            ),
            "rawMessage": F.col("type"),
            "lsn": format_lsn(F.col("pos")),
            "sourceTimestamp": F.expr(
                "case when type = 'BEGIN' then timestamp - 1000 else 0L end"
            ),
            "pos_hi": lsn_high(F.col("pos")),
            "pos_lo": lsn_low(F.col("pos")),
            "seq": F.col("event_id"),
            "idx": F.lit(0),
        }
    )
    return rows.select(*EVENT_COLUMNS)


# --- captured Postgres messages ----------------------------------------------


def be(value: Column, width: int) -> Column:
    """Big-endian bytes of a number."""
    return F.unhex(F.lpad(F.hex(value), 2 * width, "0"))


def byte(mark: str) -> Column:
    return F.encode(F.lit(mark), "UTF-8")


def cstr(text: Column) -> Column:
    return F.concat(F.encode(text, "UTF-8"), F.unhex(F.lit("00")))


def cell(text: Column) -> Column:
    content = F.concat(
        byte("t"), be(F.octet_length(text), 4), F.encode(text, "UTF-8")
    )
    return F.coalesce(content, byte("n"))


def tuple_bytes(cells: list[Column]) -> Column:
    return F.concat(be(F.lit(len(cells)), 2), *cells)


def insert_bytes(rel_id: Column, cells: list[Column]) -> Column:
    return F.concat(byte("I"), be(rel_id, 4), byte("N"), tuple_bytes(cells))


def update_bytes(rel_id: Column, old: list[Column], new: list[Column], kind="O") -> Column:
    return F.concat(
        byte("U"), be(rel_id, 4), byte(kind), tuple_bytes(old), byte("N"), tuple_bytes(new)
    )


def delete_bytes(rel_id: Column, cells: list[Column], kind="K") -> Column:
    return F.concat(byte("D"), be(rel_id, 4), byte(kind), tuple_bytes(cells))


def truncate_bytes(rel_ids: list[Column], options: int) -> Column:
    return F.concat(
        byte("T"), be(F.lit(len(rel_ids)), 4), be(F.lit(options), 1),
        *[be(i, 4) for i in rel_ids],
    )


def relation_bytes(
    rel_id: Column, namespace: Column, name: Column, columns: list[tuple[Column, int]]
) -> Column:
    parts = [
        F.concat(be(F.lit(0), 1), cstr(label), be(F.lit(oid), 4), F.unhex(F.lit("FFFFFFFF")))
        for label, oid in columns
    ]
    return F.concat(
        byte("R"), be(rel_id, 4), cstr(namespace), cstr(name), byte("d"),
        be(F.lit(len(columns)), 2), *parts,
    )


def begin_bytes(lsn: Column, micros: Column, xid: Column) -> Column:
    return F.concat(byte("B"), be(lsn, 8), be(micros, 8), be(xid, 4))


def _money(name: str) -> Column:
    return F.col(name).cast("decimal(12,2)").cast("string")


def _text(name: str) -> Column:
    return F.col(name).cast("string")


# relation id, column name, type OID, value: the captured tables
ROW_TABLES = {
    "region": (1, [("r_regionkey", 23, _text), ("r_name", 25, _text)]),
    "nation": (
        2,
        [("n_nationkey", 23, _text), ("n_name", 25, _text), ("n_regionkey", 23, _text)],
    ),
    "customer": (
        3,
        [
            ("c_custkey", 20, _text), ("c_name", 25, _text), ("c_nationkey", 23, _text),
            ("c_acctbal", 1700, _money), ("c_mktsegment", 25, _text),
        ],
    ),
    "orders": (
        4,
        [
            ("o_orderkey", 20, _text), ("o_custkey", 20, _text),
            ("o_orderstatus", 1042, _text), ("o_totalprice", 1700, _money),
            ("o_orderpriority", 25, _text),
        ],
    ),
    "lineitem": (
        5,
        [
            ("l_orderkey", 20, _text), ("l_partkey", 20, _text), ("l_suppkey", 20, _text),
            ("l_linenumber", 23, _text), ("l_quantity", 1700, _money),
            ("l_extendedprice", 1700, _money), ("l_discount", 1700, _money),
            ("l_tax", 1700, _money), ("l_returnflag", 1042, _text),
            ("l_linestatus", 1042, _text),
        ],
    ),
}

# where the customer layout is announced again, with one column renamed
RENAMED_AT = 100
_FIRST_ROW_LSN = 1 << 32


def _captured(df: DataFrame, lsn: Column, payload: Column) -> DataFrame:
    return df.select(
        F.lit("pg").alias("source"),
        lsn.cast("bigint").alias("lsn"),
        F.lit(0).cast("bigint").alias("seq"),
        F.lit(1_700_000_000_000).cast("bigint").alias("captured_at"),
        payload.alias("payload"),
    )


def _announcements(spark: SparkSession) -> DataFrame:
    one = spark.range(1)
    found = []
    for name, (rel_id, columns) in ROW_TABLES.items():
        layout = [(F.lit(label), oid) for label, oid, _ in columns]
        payload = relation_bytes(F.lit(rel_id), F.lit("public"), F.lit(name), layout)
        found.append(_captured(one, F.lit(1000 + rel_id), payload))
    rel_id, columns = ROW_TABLES["customer"]
    renamed = [
        (F.lit("c_balance" if label == "c_acctbal" else label), oid)
        for label, oid, _ in columns
    ]
    payload = relation_bytes(F.lit(rel_id), F.lit("public"), F.lit("customer"), renamed)
    found.append(_captured(one, F.lit(_FIRST_ROW_LSN + RENAMED_AT * 16), payload))
    return _union(found)


def _union(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


# Messages of one file, few enough to be sorted in memory.
FILE_MESSAGES = 250_000


def _in_log_order(df: DataFrame, *order: str) -> DataFrame:
    # the given tables are one row group each; captured logs are many files, one after the other
    files = max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // FILE_MESSAGES))
    return df.repartitionByRange(files, *order).sortWithinPartitions(*order)


def _row_messages(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rel_id, columns = ROW_TABLES[name]
    df = table(spark, sf_dir, name)
    cells = [cell(value(label)) for label, _, value in columns]
    key = F.col(columns[0][0]).cast("bigint")
    relation = F.lit(rel_id)
    payload = insert_bytes(relation, cells)
    if name == "orders":
        # F orders changed their status, P orders were deleted by key
        old = list(cells)
        old[2] = cell(F.lit("O"))
        key_only = [cells[0]] + [byte("n")] * (len(cells) - 1)
        payload = (
            F.when(F.col("o_orderstatus") == "F", update_bytes(relation, old, cells))
            .when(F.col("o_orderstatus") == "P", delete_bytes(relation, key_only))
            .otherwise(payload)
        )
    return _captured(df, F.lit(_FIRST_ROW_LSN) + key * 16 + rel_id, payload)


def captured_wal(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> DataFrame:
    """Row messages of whole tables behind their relation messages."""
    chosen = names or list(ROW_TABLES)

    def write(path: str) -> None:
        rows = [_row_messages(spark, sf_dir, name) for name in chosen]
        _in_log_order(_union([_announcements(spark), *rows]), "lsn", "seq").write.parquet(path)

    path = stored(spark, "wal-" + "-".join(chosen), sf_dir, write)
    return spark.read.parquet(path)


EVENT_RELATIONS = ["click", "error", "purchase", "signup", "view"]
_DDL_RELATION = 99


def event_wal_path(spark: SparkSession, sf_dir: str) -> str:
    """A mixed message stream, one or two messages per row of ``events``.

    Markers, row changes, truncates of two relations and DDL log rows follow the
    event types of ``feed``. Every twentieth event also announces its relation
    again; the layout gains a column every 2000 events.
    """

    def write(path: str) -> None:
        rows = table(spark, sf_dir, "events").selectExpr("*", f"{EVENT_TYPE_SQL} as type")
        rel = F.lit(0)
        for i, name in enumerate(EVENT_RELATIONS):
            rel = F.when(F.col("event_type") == name, F.lit(10 + i)).otherwise(rel)
        rows = rows.withColumn("rel", rel)
        lsn = F.col("event_id") * 1000003 + 16777216
        amount = cell(_money("value"))
        values = [cell(_text("user_id")), amount, cell(F.col("props"))]
        micros = F.unix_micros(F.col("ts").cast("timestamp")) - F.lit(946684800000000)
        payload = (
            F.when(F.col("type") == "BEGIN", begin_bytes(lsn, micros, F.lit(7)))
            .when(F.col("type") == "COMMIT", byte("C"))
            .when(
                F.col("type") == "TRUNCATE",
                truncate_bytes([F.col("rel"), F.lit(10), F.lit(77)], 1),
            )
            .when(F.col("type") == "HEARTBEAT", byte("Z"))
            .when(
                F.col("type") == "DDL",
                insert_bytes(
                    F.lit(_DDL_RELATION),
                    [
                        cell(_text("event_id")), cell(F.lit("ALTER TABLE")),
                        cell(F.lit("table")), cell(F.lit("public")),
                        cell(F.concat(F.lit("public."), F.col("event_type"))),
                        F.when(F.col("user_id") % 2 == 0, byte("n")).otherwise(
                            cell(F.concat(F.lit("ALTER TABLE "), F.col("event_type")))
                        ),
                    ],
                ),
            )
            .when(F.col("type") == "INSERT", insert_bytes(F.col("rel"), values))
            .when(F.col("type") == "DELETE", delete_bytes(F.col("rel"), values, "O"))
            .otherwise(
                F.concat(byte("U"), be(F.col("rel"), 4), byte("N"), tuple_bytes(values))
            )
        )
        changes = _captured(rows, lsn, payload)
        # a layout announced between two events
        version = F.call_function("div", F.col("event_id"), F.lit(2000))
        extra = F.concat(F.lit("v"), version.cast("string"))
        layout = [(F.lit("id"), 20), (F.lit("value"), 1700), (F.lit("props"), 3802), (extra, 25)]
        again = _captured(
            rows.filter("event_id % 20 = 0"),
            lsn + 1,
            relation_bytes(F.col("rel"), F.lit("public"), F.col("event_type"), layout),
        )
        ddl_layout = [
            (F.lit(name), 23 if name == "id" else 25)
            for name in ("id", "command_tag", "object_type", "schema_name",
                         "object_identity", "query")
        ]
        one = spark.range(1)
        first = [
            _captured(
                one, F.lit(1),
                relation_bytes(F.lit(_DDL_RELATION), F.lit("public"),
                               F.lit("_cdc_ddl_log"), ddl_layout),
            )
        ]
        _in_log_order(_union([changes, again, *first]), "lsn", "seq").write.parquet(path)

    return stored(spark, "event-wal", sf_dir, write)


def event_wal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages of ``event_wal_path``."""
    return spark.read.parquet(event_wal_path(spark, sf_dir))


def damaged_wal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_wal`` with every seventh announcement and every other DDL row cut short."""
    payload, event_id = F.col("payload"), F.call_function("div", F.col("lsn") - 16777216, F.lit(1000003))
    kind = F.substring(payload, 1, 1).cast("string")
    is_ddl = (kind == "I") & (F.hex(F.substring(payload, 2, 4)) == F.lpad(F.hex(F.lit(_DDL_RELATION)), 8, "0"))
    cut = ((kind == "R") & (F.col("lsn") > 1) & (event_id % 140 == 0)) | (is_ddl & (event_id % 2 == 0))
    return event_wal(spark, sf_dir).withColumn(
        "payload", F.when(cut, F.substring(payload, F.lit(1), F.octet_length(payload) - 3)).otherwise(payload)
    )


_NOTES_RELATION = 50


def notes_wal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates of one row per user of ``events``, most of which leave values out.

    ``props`` is sent with every third event, ``value`` not with every fifth.
    """

    def write(path: str) -> None:
        rows = table(spark, sf_dir, "events")
        left_out = byte("u")
        cells = [
            cell(_text("user_id")),
            F.when(F.col("event_id") % 5 == 0, left_out).otherwise(cell(_money("value"))),
            F.when(F.col("event_id") % 3 == 0, cell(F.col("props"))).otherwise(left_out),
        ]
        payload = F.concat(byte("U"), be(F.lit(_NOTES_RELATION), 4), byte("N"), tuple_bytes(cells))
        layout = [(F.lit("id"), 20), (F.lit("value"), 1700), (F.lit("props"), 3802)]
        first = _captured(
            spark.range(1), F.lit(1), relation_bytes(F.lit(_NOTES_RELATION), F.lit("public"), F.lit("notes"), layout)
        )
        changes = _captured(rows, F.col("event_id") * 1000003 + 16777216, payload)
        _in_log_order(first.unionByName(changes), "lsn", "seq").write.parquet(path)

    return spark.read.parquet(stored(spark, "notes-wal", sf_dir, write))


# --- captured binlog events --------------------------------------------------


def captured_binlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One binlog event per row of ``orders``, with rotations and commits.

    Finished orders are updates (old row, new row, and for low priority a stray
    third row), pending ones deletes, the others inserts of two rows.
    """

    def write(path: str) -> None:
        orders = table(spark, sf_dir, "orders")
        names = [
            ("o_orderkey", "bigint"), ("o_orderstatus", "char(1)"),
            ("o_totalprice", "decimal(12,2)"), ("o_open", "tinyint(1)"),
            ("o_orderdate", "datetime"), ("o_note", "json"),
        ]
        columns = F.array(
            *[F.struct(F.lit(n).alias("name"), F.lit(t).alias("type")) for n, t in names]
        )
        date = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
        note = F.concat(F.lit('{"p":"'), F.col("o_orderpriority"), F.lit('"}'))

        def image(status: Column) -> Column:
            is_open = F.when(status == "O", "1").otherwise("0")
            return F.array(
                _text("o_orderkey"), status, _money("o_totalprice"), is_open, date, note
            )

        status = F.col("o_orderstatus")
        short = F.array(_text("o_orderkey"), F.lit(None).cast("string"))
        low = F.col("o_orderpriority") == "5-LOW"
        rows = (
            F.when(status == "F", F.when(
                low, F.array(image(F.lit("O")), image(status), image(status))
            ).otherwise(F.array(image(F.lit("O")), image(status))))
            .when(status == "P", F.array(short))
            .otherwise(F.array(image(status), image(F.lit("N"))))
        )
        action = (
            F.when(status == "F", "update").when(status == "P", "delete").otherwise("insert")
        )
        key = F.col("o_orderkey")
        source = F.concat(F.lit("my"), (F.col("o_custkey") % 2).cast("string"))
        position = F.pmod(key * 97, F.lit(1 << 30)) + 4

        def event(df, seq, action, rows=None, next_file=None, query=None):
            return df.select(
                source.alias("source"),
                F.lit(None).cast("string").alias("file"),
                position.alias("log_pos"),
                seq.alias("seq"),
                action.alias("action"),
                F.lit("shop").alias("schema"),
                F.lit("orders").alias("table"),
                (F.lit(None).cast(columns_type) if rows is None else columns).alias("columns"),
                (F.lit(None).cast("array<array<string>>") if rows is None else rows).alias("rows"),
                (F.lit(None).cast("string") if next_file is None else next_file).alias("next_file"),
                (F.lit(None).cast("string") if query is None else query).alias("query"),
                F.lit(1_700_000_000_000).cast("bigint").alias("captured_at"),
            )

        columns_type = "array<struct<name:string,type:string>>"
        number = F.lpad((F.call_function("div", key, F.lit(1000)) + 1).cast("string"), 6, "0")
        turn = F.concat(F.lit("mysql-bin."), number)
        whole = _union(
            [
                event(orders, key * 4 + 1, action, rows),
                event(orders.filter("o_orderkey % 1000 = 0"), key * 4, F.lit("rotate"),
                      next_file=turn),
                event(orders.filter("o_orderkey % 10 = 9"), key * 4 + 2, F.lit("xid")),
                event(orders.filter("o_orderkey % 500 = 7"), key * 4 + 3, F.lit("ddl"),
                      query=F.lit("ALTER TABLE orders ADD x INT")),
            ]
        )
        _in_log_order(whole, "seq").write.parquet(path)

    path = stored(spark, "binlog", sf_dir, write)
    return spark.read.parquet(path)


# --- dump files --------------------------------------------------------------

DUMP_FILES = 8
PIECE_BYTES = 32 * 1024 * 1024


def _dump_lines(tables: list[DataFrame], path: str) -> None:
    """A folder for every dump; its files are pieces of it, in order and of about ``PIECE_BYTES``.

    ``tables`` follow each other in a dump; each is cut by its own size, as rows of one are much wider than another's.
    """
    cut = []
    for lines in tables:
        size = lines.agg(F.sum(F.octet_length("value"))).first()[0] or 0
        files = max(DUMP_FILES, -(-size // PIECE_BYTES))
        cut.append(lines.repartitionByRange(files, "part", "rank", "place"))
    # the parts of a union follow each other, and so do the names of the files they write
    ordered = _union(cut).sortWithinPartitions("part", "rank", "place").select("part", "value")
    ordered.write.partitionBy("part").text(path)


def _copy_text(value: Column) -> Column:
    text = F.replace(value, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit("\t"), F.lit("\\t"))
    text = F.replace(text, F.lit("\n"), F.lit("\\n"))
    text = F.replace(text, F.lit("\r"), F.lit("\\r"))
    return F.coalesce(text, F.lit("\\N"))


# table, key column, and value texts by column name
PG_DUMPED = {
    "customer": ("c_custkey", {
        "c_custkey": _text, "c_name": _text, "c_acctbal": _money,
        "c_mktsegment": lambda n: F.nullif(F.col(n), F.lit("BUILDING")),
    }),
    "orders": ("o_orderkey", {
        "o_orderkey": _text, "o_custkey": _text, "o_orderstatus": _text,
        "o_totalprice": _money, "o_orderpriority": _text,
    }),
    "documents": ("doc_id", {"doc_id": _text, "lang": _text, "text": _text}),
}


def pg_dump_path(spark: SparkSession, sf_dir: str) -> str:
    """Dump files with one COPY block per table, over whole tables and texts."""

    def write(path: str) -> None:
        parts = []
        heads = spark.range(DUMP_FILES).withColumnRenamed("id", "part")
        for rank, (name, (key, columns)) in enumerate(PG_DUMPED.items()):
            line = F.concat_ws("\t", *[_copy_text(value(c)) for c, value in columns.items()])
            rows = table(spark, sf_dir, name).select(
                F.pmod(F.col(key), F.lit(DUMP_FILES)).alias("part"),
                F.lit(rank).alias("rank"),
                F.col(key).cast("bigint").alias("place"),
                line.alias("value"),
            )
            head = f"COPY public.{name} ({', '.join(columns)}) FROM stdin;"
            marks = [
                heads.select(
                    "part", F.lit(rank).alias("rank"),
                    F.lit(place).cast("bigint").alias("place"), F.lit(value).alias("value"),
                )
                for place, value in ((-1, head), (2**62, "\\."), (2**62 + 1, ""))
            ]
            parts.append(_union([*marks, rows]))
        _dump_lines(parts, path)

    return stored(spark, "pg-dump", sf_dir, write)


def _sql_text(value: Column) -> Column:
    text = F.replace(value, F.lit("\\"), F.lit("\\\\"))
    for raw, mark in (("'", "\\'"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(raw), F.lit(mark))
    return F.coalesce(F.concat(F.lit("'"), text, F.lit("'")), F.lit("NULL"))


MYSQL_COLUMNS = {
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"],
}


def mysql_dump_path(spark: SparkSession, sf_dir: str) -> str:
    """Dump files with one INSERT statement per line, up to a few tuples each."""

    def write(path: str) -> None:
        orders = table(spark, sf_dir, "orders")
        documents = table(spark, sf_dir, "documents")
        order_tuple = F.concat(
            F.lit("("), _text("o_orderkey"), F.lit(","), _text("o_custkey"), F.lit(","),
            _sql_text(F.nullif(F.col("o_orderstatus"), F.lit("P"))), F.lit(","),
            _money("o_totalprice"), F.lit(")"),
        )
        # neighbouring keys share a statement
        batch = F.call_function("div", F.col("o_orderkey"), F.lit(16))
        statements = settle(
            orders.groupBy(batch.alias("place"))
            .agg(F.array_join(F.array_sort(F.collect_list(
                F.struct("o_orderkey", order_tuple.alias("t")))).getField("t"), ",").alias("t"))
            .select(
                F.pmod("place", F.lit(DUMP_FILES)).alias("part"), F.lit(1).alias("rank"),
                (F.col("place") * 2).alias("place"),
                F.concat(F.lit("INSERT INTO `orders` VALUES "), F.col("t"), F.lit(";")).alias("value"),
            )
        )
        texts = documents.select(
            F.pmod("doc_id", F.lit(DUMP_FILES)).alias("part"),
            F.lit(2).alias("rank"),
            F.col("doc_id").cast("bigint").alias("place"),
            F.concat(
                F.lit("INSERT INTO `documents` VALUES ("), _text("doc_id"), F.lit(","),
                _sql_text(F.col("text")), F.lit(");"),
            ).alias("value"),
        )
        # the log position moves on with every statement; a dump may note it often
        marks = statements.select(
            "part", "rank", (F.col("place") + 1).alias("place"),
            F.concat(
                F.lit("-- CHANGE MASTER TO MASTER_LOG_FILE='mysql-bin.000003', MASTER_LOG_POS="),
                (F.col("place") * 8 + 154).cast("string"), F.lit(";"),
            ).alias("value"),
        )
        _dump_lines([marks.unionByName(statements), texts], path)

    return stored(spark, "mysql-dump", sf_dir, write)
