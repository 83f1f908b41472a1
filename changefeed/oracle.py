"""The same answers as SQL over the given tables, one text per query."""

from __future__ import annotations

# JSON's short escapes, written out here so that the check stands alone.
_ESCAPES = [(chr(92), chr(92) * 2), (chr(34), chr(92) + chr(34)), (chr(10), chr(92) + "n"), (chr(13), chr(92) + "r"),
            (chr(9), chr(92) + "t"), (chr(8), chr(92) + "b"), (chr(12), chr(92) + "f")]


_ROW = (
    "('{{\"id\":' || user_id || ', \"value\":' || cast({value} as decimal(12,2)) || "
    "', \"props\":' || props || '}}')"
)
_OLD = _ROW.format(value="cast(value as decimal(12,2))")
_NEW = _ROW.format(value="cast(value as decimal(12,2)) + 1")

_TYPE = """case when event_id % 97 = 0 then 'DDL' when event_id % 89 = 0 then 'BEGIN'
    when event_id % 83 = 0 then 'COMMIT' when event_id % 79 = 0 then 'TRUNCATE'
    when event_id % 73 = 0 then 'HEARTBEAT'
    when event_type in ('signup', 'purchase') then 'INSERT'
    when event_type = 'error' then 'DELETE' else 'UPDATE' end"""

FEED = f"""
typed as (select *, {_TYPE} as type, event_id * 1000003 + 16777216 as pos,
    epoch_us(ts) // 1000 as "timestamp", 'db' || (user_id % 3) as source,
    case user_id % 4 when 0 then 'public' when 1 then 'shop.eu' when 2 then 'my schema'
        else '' end as "schema" from events),
feed as (select *, event_id as seq,
    case when type in ('INSERT','UPDATE','DELETE','TRUNCATE') then event_type else '' end as "table",
    case when event_id % 50 = 7 then 'not json'
        when type in ('BEGIN','COMMIT','HEARTBEAT') then ''
        when type = 'DDL' then 'ALTER TABLE x' when type = 'TRUNCATE' then '{{"options":0}}'
        when type = 'UPDATE' then '{{"old":' || {_OLD} || ', "new":' || {_NEW} || '}}'
        else {_NEW} end as data,
    printf('%X/%X', pos >> 32, pos & 4294967295) as lsn,
    case when type = 'BEGIN' then "timestamp" - 1000 else 0 end as "sourceTimestamp"
    from typed),
gated as (select *, type not in ('INSERT','UPDATE','DELETE','TRUNCATE') or data = ''
    or json_valid(data) as good from feed),
good as (select * from gated where good),
pub as (select * from good where type in ('INSERT','UPDATE','DELETE','DDL','TRUNCATE')),
named as (select *, 'cdc.' || translate(case when "schema" = '' then 'default' else "schema" end,
    '.*> ', '____') || '.' || translate(case when "table" = '' then '_ddl' else "table" end,
    '.*> ', '____') as subject from feed)
"""


def _with(body: str, *ctes: str) -> str:
    return "with " + ", ".join([FEED, *ctes]) + body


def _escaped(column: str) -> str:
    """Replace chain in the order of the escape tables."""
    text = column
    short = {raw for raw, _ in _ESCAPES}
    others = [chr(code) for code in (*range(1, 0x20), 0x7F) if chr(code) not in short]
    pairs = _ESCAPES + [(c, f"\\u{ord(c):04x}") for c in others]
    for raw, mark in pairs:
        shown = f"chr({ord(raw)})"
        text = f"replace({text}, {shown}, '{mark}')"
    return text


def _quoted(column: str) -> str:
    return f"('\"' || {_escaped(column)} || '\"')"


def _object(members: list[tuple[str, str]]) -> str:
    parts = [f"'\"{name}\":' || coalesce({value}, 'null')" for name, value in members]
    return "'{' || " + " || ', ' || ".join(parts) + " || '}'"


def _text(value: str) -> str:
    return f"('\"' || cast({value} as varchar) || '\"')"


def _num(value: str) -> str:
    return f"cast({value} as varchar)"


def _money(value: str) -> str:
    return f"cast(cast({value} as decimal(12,2)) as varchar)"


_CUSTOMER = [
    ("c_custkey", _num("c_custkey")), ("c_name", _text("c_name")),
    ("c_nationkey", _num("c_nationkey")), ("c_acctbal", _money("c_acctbal")),
    ("c_mktsegment", _text("c_mktsegment")),
]
_RENAMED = [("c_balance" if n == "c_acctbal" else n, v) for n, v in _CUSTOMER]
_REGION = [("r_regionkey", _num("r_regionkey")), ("r_name", _text("r_name"))]
_NATION = [
    ("n_nationkey", _num("n_nationkey")), ("n_name", _text("n_name")),
    ("n_regionkey", _num("n_regionkey")),
]
_ORDER = [
    ("o_orderkey", _num("o_orderkey")), ("o_custkey", _num("o_custkey")),
    ("o_orderstatus", _text("o_orderstatus")), ("o_totalprice", _money("o_totalprice")),
    ("o_orderpriority", _text("o_orderpriority")),
]
_ORDER_OLD = [(n, "'\"O\"'" if n == "o_orderstatus" else v) for n, v in _ORDER]
_ORDER_KEY = [(n, v if n == "o_orderkey" else "'null'") for n, v in _ORDER]
_ITEM = [
    (n, _num(n)) for n in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
] + [(n, _money(n)) for n in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")] + [
    (n, _text(n)) for n in ("l_returnflag", "l_linestatus")
]


def _pos_text(position: str) -> str:
    return f"printf('%X/%X', ({position}) >> 32, ({position}) & 4294967295)"


def _wal_part(table: str, rel_id: int, key: str, type_sql: str, data: str, kind: str) -> str:
    at = f"4294967296 + cast({key} as bigint) * 16 + {rel_id}"
    return f"""select 'pg' as source, {type_sql} as type, 'public' as "schema", '{table}' as "table",
        {data} as data, {_pos_text(at)} as lsn, {kind} as old_kind from {table}"""


_CUSTOMER_WAL = _wal_part(
    "customer", 3, "c_custkey", "'INSERT'",
    f"case when c_custkey < 100 then {_object(_CUSTOMER)} else {_object(_RENAMED)} end", "null",
)
_NATION_WAL = _wal_part("nation", 2, "n_nationkey", "'INSERT'", _object(_NATION), "null")

_WAL = " union all ".join(
    [
        _wal_part("region", 1, "r_regionkey", "'INSERT'", _object(_REGION), "null"),
        _NATION_WAL,
        _CUSTOMER_WAL,
        _wal_part(
            "orders", 4, "o_orderkey",
            "case o_orderstatus when 'F' then 'UPDATE' when 'P' then 'DELETE' else 'INSERT' end",
            f"""case o_orderstatus when 'F' then '{{"old":' || {_object(_ORDER_OLD)} || ', "new":'
                || {_object(_ORDER)} || '}}' when 'P' then {_object(_ORDER_KEY)}
                else {_object(_ORDER)} end""",
            "case o_orderstatus when 'F' then 'O' when 'P' then 'K' end",
        ),
        _wal_part("lineitem", 5, "l_orderkey", "'INSERT'", _object(_ITEM), "null"),
    ]
)

# The announcement used for an event is the newest one of its type before it.
_EVENT_WAL = f"""
marks as (select event_id, event_type, event_id // 2000 as version, pos from typed
    where event_id % 20 = 0),
known as (select t.*, (select max(m.event_id) from marks m where m.event_type = t.event_type
    and m.event_id < t.event_id) as announced from typed t),
versions as (select * exclude (announced), announced, announced // 2000 as version from known)
"""
_EVENT_ROW = (
    "'{\"id\":' || user_id || ', \"value\":' || cast(cast(value as decimal(12,2)) as varchar)"
    " || ', \"props\":' || props || '}'"
)


def _event_data() -> str:
    return f"""case type when 'UPDATE' then '{{"new":' || {_EVENT_ROW} || '}}'
        else {_EVENT_ROW} end"""


_FIRST_CLICK = """(select min(event_id) from typed where event_type = 'click'
    and event_id % 20 = 0)"""

_TRUNCATES = """
hits as (select event_id, pos, event_type as "table", 0 as idx from versions
        where type = 'TRUNCATE' and announced is not null
    union all select event_id, pos, 'click', 1 from versions
        where type = 'TRUNCATE' and event_id > first_click)"""
_WITH_CLICK = f"versions2 as (select *, {_FIRST_CLICK} as first_click from versions)"

_STAMPED = """
ord as (select o.*, 'my' || (o_custkey % 2) as source,
    case o_orderstatus when 'F' then 'update' when 'P' then 'delete' else 'insert' end as action
    from orders o),
log as (select source, o_orderkey * 4 + 1 as seq, action, o_orderkey, null as next_file from ord
    union all select source, o_orderkey * 4, 'rotate', o_orderkey,
        'mysql-bin.' || lpad(cast(o_orderkey // 1000 + 1 as varchar), 6, '0')
        from ord where o_orderkey % 1000 = 0
    union all select source, o_orderkey * 4 + 2, 'xid', o_orderkey, null from ord
        where o_orderkey % 10 = 9
    union all select source, o_orderkey * 4 + 3, 'ddl', o_orderkey, null from ord
        where o_orderkey % 500 = 7),
stamped as (select *, last_value(next_file ignore nulls) over (partition by source order by seq
    rows between unbounded preceding and current row) as file from log)
"""


def _binlog_row(status: str) -> str:
    return _object(
        [
            ("o_orderkey", _num("o_orderkey")), ("o_orderstatus", _text(status)),
            ("o_totalprice", _money("o_totalprice")),
            ("o_open", f"case when {status} = 'O' then 'true' else 'false' end"),
            ("o_orderdate", "('\"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '.000Z\"')"),
            ("o_note", "('{\"p\":\"' || o_orderpriority || '\"}')"),
        ]
    )


_BINLOG_EVENTS = f"""
images as (select o_orderkey, 0 as idx, case o_orderstatus
        when 'F' then '{{"old":' || {_binlog_row("'O'")} || ', "new":' || {_binlog_row("o_orderstatus")} || '}}'
        when 'P' then {_object([("o_orderkey", _num("o_orderkey"))] + [(n, "'null'") for n in
                               ("o_orderstatus", "o_totalprice", "o_open", "o_orderdate", "o_note")])}
        else {_binlog_row("o_orderstatus")} end as data from ord
    union all select o_orderkey, 1, {_binlog_row("'N'")} from ord
        where o_orderstatus not in ('F', 'P')),
binlog as (select s.source, upper(s.action) as type, 'shop' as "schema", 'orders' as "table", i.data,
        coalesce(s.file || ':' || ((s.o_orderkey * 97) % 1073741824 + 4), '') as lsn, s.seq, i.idx
        from stamped s join images i on i.o_orderkey = s.o_orderkey
        where s.action in ('insert', 'update', 'delete')
    union all select source, case action when 'ddl' then 'DDL' else 'COMMIT' end,
        case action when 'ddl' then 'shop' else '' end, '',
        case action when 'ddl' then 'ALTER TABLE orders ADD x INT' else '' end, '', seq, 0
        from stamped where action in ('ddl', 'xid'))
"""

_HISTORY = """
hist as (select 'public' as "schema", event_type as "table", event_id, pos + 1 as place,
        'id,value,props,v' || (event_id // 2000) as names, '20,1700,3802,25' as oids
        from typed where event_id % 20 = 0
    union all select 'public', '_cdc_ddl_log', -1, 1,
        'id,command_tag,object_type,schema_name,object_identity,query', '23,25,25,25,25,25')"""
_HISTORY_COLS = f'"schema", "table", {_pos_text("place")} as position, names, oids'


def _chunk(order: str, n: int) -> str:
    return f"(row_number() over (order by {order}) - 1) // {n} as chunk_id"


def _acked(rows: str) -> str:
    return f"""select source, max_by(lsn, pos) as lsn, max(pos) >> 32 as pos_hi,
        max(pos) & 4294967295 as pos_lo from {rows} group by source"""


_BEFORE = "(select * from feed where \"timestamp\" < 1705276800000 and source <> 'db2')"

_NEWEST_ROW = _EVENT_ROW[: -len("'}'")] + "', \"v' || newest || '\":null}'"

ORACLE: dict[str, str] = {
    "flagship_subject_counts": _with("""
        select n.subject, n.type, count(*) as events, max(n."timestamp") as last_timestamp,
            max(n.pos) as last_pos from named n join pub p on p.event_id = n.event_id
        group by n.subject, n.type"""),
    "envelope_roundtrip": _with("""
        select subject as key, type, "schema", "table", data, type as "rawMessage", lsn,
            "timestamp", "sourceTimestamp" from named"""),
    "envelope_rejects": _with("""
        select subject as key, case type when 'DDL' then 'unknown event type: ddl'
            else 'not an event envelope' end as envelope_error, count(*) as events
        from named where type in ('DDL', 'TRUNCATE') group by 1, 2"""),
    "json_gate": _with('select lsn, type, "table", data from good'),
    "json_rejects": _with("""
        select lsn, type, "table", data, 'invalid JSON data' as reject_reason
        from gated where not good"""),
    "publishable_events": _with("""
        select lsn, type from feed where type in ('INSERT','UPDATE','DELETE','DDL','TRUNCATE')"""),
    "table_event_rows": _with("""
        select lsn, type, "table" from feed
        where type in ('INSERT','UPDATE','DELETE','TRUNCATE')"""),
    "filter_bare": _with("""
        select lsn, "schema", "table" from feed where "table" in ('click', 'purchase')"""),
    "filter_qualified": _with("""
        select lsn, "schema", "table" from feed where ("schema" = 'public' and "table" = 'click')
            or ("schema" = 'my schema' and "table" = 'error')"""),
    "subject_build": _with("select lsn, subject from named"),
    "subject_match": _with("""
        select 'cdc.public.click' as pattern, lsn, subject from named
            where subject = 'cdc.public.click'
        union all select 'cdc.shop_eu.>', lsn, subject from named
            where starts_with(subject, 'cdc.shop_eu.')
        union all select 'cdc.*.error', lsn, subject from named
            where split_part(subject, '.', 3) = 'error'
        union all select 'cdc.*.>', lsn, subject from named"""),
    "tenant_routes": _with("""
        select lsn, source, case source when 'db0' then 'cdc.tenant-a' when 'db1' then 'cdc.tenant-b'
            else 'cdc' end || substr(subject, 4) as subject from named"""),
    "route_tables": _with("""
        select s.subscriber, g.lsn, g."table" from good g join (values ('alice', 'click'),
            ('bob', 'click'), ('bob', 'error'), ('carol', 'missing')) s(subscriber, tab)
        on s.tab = g."table" where g.type in ('INSERT','UPDATE','DELETE','TRUNCATE')"""),
    "route_everything": _with("select 'audit' as subscriber, lsn, type from good"),
    "lsn_format": _with("select event_id, lsn from feed"),
    "lsn_parse": _with("select lsn, pos, pos as expected from feed"),
    "lsn_message_end": _with("select lsn, pos + strlen(data) as end_pos from feed"),
    "binlog_pos": """
        with t as (select o_orderkey, o_orderstatus s, 'mysql:bin.' || lpad(cast(o_custkey as varchar), 6, '0')
                as f, o_orderkey * 31 as p, 'mysql-bin.000001:x' ||
                cast(cast(o_totalprice as decimal(12,2)) as varchar) as bad from orders)
        select o_orderkey, case s when 'P' then 'no position' when 'F' then bad
                else f || ':' || p end as lsn,
            case when s not in ('P', 'F') then f end as file,
            case when s not in ('P', 'F') then p end as position,
            case when s not in ('P', 'F') then cast(split_part(f, '.', 2) as bigint) end as file_number,
            case s when 'P' then 'no colon in position: no position'
                when 'F' then 'bad position number: ' || bad end as error from t""",
    "pg_time": "select event_id, epoch_us(ts) // 1000 as source_ms from events",
    "escape_texts": f"select doc_id, {_escaped('text')} as escaped from documents",
    "escape_pages": f"select page_id, {_escaped('html')} as escaped from pages",
    "update_images": _with("""
        select lsn, type, case when type <> 'INSERT' then cast(user_id as bigint) end as before_id,
            case type when 'UPDATE' then cast(value as decimal(12,2))
                when 'DELETE' then cast(cast(value as decimal(12,2)) + 1 as decimal(12,2)) end
                as before_value,
            case when type <> 'DELETE' then cast(user_id as bigint) end as after_id,
            case when type <> 'DELETE' then cast(cast(value as decimal(12,2)) + 1 as decimal(12,2)) end
                as after_value
        from pub where type in ('INSERT', 'UPDATE', 'DELETE')"""),
    "payload_fields": _with("""
        select lsn, cast(user_id as bigint) as id,
            cast(cast(value as decimal(12,2)) + 1 as decimal(12,2)) as value,
            cast(json_extract_string(data, '$.props.k') as integer) as k
        from good where type in ('INSERT', 'DELETE')"""),
    "snapshot_orders": f"""
        select 'public' as "schema", 'orders' as "table", {_object([
            ("o_orderkey", _text("o_orderkey")), ("o_custkey", _text("o_custkey")),
            ("o_orderstatus", _text("nullif(o_orderstatus, 'P')")),
            ("o_totalprice", _text("cast(o_totalprice as decimal(12,2))")),
            ("o_orderpriority", _text("o_orderpriority"))])} as data,
            {_chunk("o_orderkey", 1000)} from orders""",
    "snapshot_composite_key": f"""
        with t as (select *, {_chunk("l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey", 1000)}
            from lineitem)
        select chunk_id, count(*) as n, min(l_returnflag) as first_flag,
            cast(sum(l_orderkey) as bigint) as key_sum from t group by chunk_id""",
    "snapshot_offset": f"""
        select c_mktsegment, c_custkey, c_nationkey,
            {_chunk("c_mktsegment, c_custkey, c_nationkey", 100)} from customer""",
    "snapshot_typed": f"""
        select 'customer' as "table", {_object([
            ("c_custkey", _num("c_custkey")), ("c_name", _text("c_name")),
            ("c_acctbal", _money("c_acctbal")),
            ("c_mktsegment", _text("nullif(c_mktsegment, 'BUILDING')")),
            ("far", "case when c_nationkey > 12 then 'true' else 'false' end")])} as data
        from customer""",
    "chunk_limit": """
        select o_orderkey, o_custkey from orders where o_orderkey > 499
        order by o_orderkey limit 100""",
    "chunk_offset": """
        select * from orders order by o_orderkey limit 100 offset 500""",
    "chunk_ties": """
        select l_returnflag, l_linestatus, l_shipdate from lineitem order by 1, 2, 3 limit 1000 offset 777""",
    "wal_decode": _WAL,
    "wal_filtered": f"""
        with w as ({_CUSTOMER_WAL} union all {_NATION_WAL})
        select 'cdc.public.' || "table" as subject, type, data from w""",
    "wal_truncate": _with(
        f"select {_pos_text('pos')} as lsn, \"table\", '{{\"options\":1}}' as data, idx from hits",
        _EVENT_WAL, _WITH_CLICK, _TRUNCATES.replace("from versions", "from versions2"),
    ),
    "wal_markers": _with("""
        select lsn, type, '' as "schema", '' as "table", '' as data,
            case type when 'BEGIN' then "timestamp" else 0 end as "sourceTimestamp"
        from feed where type in ('BEGIN', 'COMMIT')"""),
    "wal_versions": _with(
        f"""select {_pos_text('pos')} as lsn, type, event_type as "table", {_event_data()} as data
        from versions where type in ('INSERT','UPDATE','DELETE') and announced is not null""",
        _EVENT_WAL,
    ),
    "rows_newest_layout": _with(
        f"""select {_pos_text('pos')} as lsn, type, event_type as "table",
            case type when 'UPDATE' then '{{"new":' || {_NEWEST_ROW} || '}}' else {_NEWEST_ROW} end as data
        from versions join (select event_type, max(version) as newest from marks group by event_type) using (event_type)
        where type in ('INSERT','UPDATE','DELETE') and announced is not null""",
        _EVENT_WAL,
    ),
    "rows_renamed_column": _WAL.replace("c_acctbal\":", "c_balance\":"),
    "wal_unknown_relations": _with(
        f"""select {_pos_text('pos')} as lsn, type, cast(rel_id as bigint) as rel_id, idx, 'unknown relation' as reject_reason
        from (select pos, type, list_position(['click','error','purchase','signup','view'],
                event_type) + 9 as rel_id, 0 as idx from versions
              where type in ('INSERT','UPDATE','DELETE','TRUNCATE') and announced is null
            union all select pos, type, 77, 2 from versions where type = 'TRUNCATE'
            union all select pos, type, 10, 1 from versions2 where type = 'TRUNCATE'
                and not coalesce(event_id > first_click, false))""",
        _EVENT_WAL, _WITH_CLICK,
    ),
    "wal_merged_layouts": _with(
        f"""select {_pos_text('pos')} as lsn, type, "table", data, idx
        from (select pos, type, event_type as "table", {_event_data()} as data, 0 as idx from versions
                where type in ('INSERT','UPDATE','DELETE') and announced is not null
            union all select pos, 'TRUNCATE', "table", '{{"options":1}}', idx from hits
            union all select pos, type, '', '', 0 from typed where type in ('BEGIN', 'COMMIT')
            union all select pos, 'INSERT', '_cdc_ddl_log', '{{"id":' || event_id ||
                ', "command_tag":"ALTER TABLE", "object_type":"table", "schema_name":"public", '
                || '"object_identity":"public.' || event_type || '", "query":' ||
                case when user_id % 2 = 0 then 'null' else '"ALTER TABLE ' || event_type || '"' end
                || '}}', 0 from typed where type = 'DDL')""",
        _EVENT_WAL, _WITH_CLICK, _TRUNCATES.replace("from versions", "from versions2"),
    ),
    "binlog_decode": f"""with {_STAMPED}, {_BINLOG_EVENTS}
        select source, type, "schema", "table", data, lsn, seq, idx from binlog""",
    "binlog_rejects": f"""with {_STAMPED}
        select source, 'UPDATE' as type, 'shop' as "schema", 'orders' as "table",
            coalesce(file || ':' || ((o_orderkey * 97) % 1073741824 + 4), '') as lsn, seq, 1 as idx,
            '["' || o_orderkey || '","' || o_orderstatus || '","' || cast(o_totalprice as decimal(12,2)) || '","0","'
                || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '","{{\\"p\\":\\"' || o_orderpriority || '\\"}}"]' as payload,
            'old row without new row' as reject_reason
        from stamped join orders using (o_orderkey)
        where action = 'update' and o_orderpriority = '5-LOW'""",
    "binlog_file": f"with {_STAMPED} select source, seq, action, file from stamped",
    "binlog_filtered": f"""with {_STAMPED}, {_BINLOG_EVENTS}
        select case type when 'DDL' then 'cdc.shop._ddl' else 'cdc.shop.orders' end as subject, type,
            count(*) as events from binlog where type <> 'COMMIT' group by 1, 2""",
    "pg_dump_scan": f"""
        select 'public' as "schema", 'customer' as "table", {_object([
            ("c_custkey", _text("c_custkey")), ("c_name", _text("c_name")),
            ("c_acctbal", _text("cast(c_acctbal as decimal(12,2))")),
            ("c_mktsegment", _text("nullif(c_mktsegment, 'BUILDING')"))])} as data,
            '0/1A2B3C4D' as lsn from customer
        union all select 'public', 'orders', {_object([
            ("o_orderkey", _text("o_orderkey")), ("o_custkey", _text("o_custkey")),
            ("o_orderstatus", _text("o_orderstatus")),
            ("o_totalprice", _text("cast(o_totalprice as decimal(12,2))")),
            ("o_orderpriority", _text("o_orderpriority"))])}, '0/1A2B3C4D' from orders
        union all select 'public', 'documents', {_object([
            ("doc_id", _text("doc_id")), ("lang", _text("lang")), ("text", _quoted("text"))])},
            '0/1A2B3C4D' from documents""",
    "mysql_dump_scan": f"""
        select 'shop' as "schema", 'orders' as "table", {_object([
            ("o_orderkey", _text("o_orderkey")), ("o_custkey", _text("o_custkey")),
            ("o_orderstatus", _text("nullif(o_orderstatus, 'P')")),
            ("o_totalprice", _text("cast(o_totalprice as decimal(12,2))"))])} as data from orders
        union all select 'shop', 'documents', {_object([
            ("col_0", _text("doc_id")), ("col_1", _quoted("text"))])} from documents""",
    "dump_positions": """
        select 'mysql-bin.000003' as log_file, max(b) * 16 + 154 as log_pos, cast(3 as bigint) as pos_hi
        from (select o_orderkey // 16 as b from orders) group by b % 8""",
    "ddl_intercept": _with("""
        , t as (select lsn, type, "schema", case when type = 'INSERT' and "schema" = 'public'
                then '_cdc_ddl_log' else "table" end as tab from feed),
        u as (select lsn, case when tab = '_cdc_ddl_log' then 'DDL' else type end as type, "schema",
                case when tab = '_cdc_ddl_log' then '' else tab end as tab from t)
        select lsn, type, "schema", tab as "table", type as "rawMessage" from u
        where tab in ('click', '')"""),
    "ddl_rows": _with("""
        select 'pg' as source, 'public' as "schema", lsn, pos >> 32 as pos_hi,
            pos & 4294967295 as pos_lo, cast(0 as bigint) as seq, 0 as idx, 'ALTER TABLE' as command_tag,
            'table' as object_type, 'public' as schema_name, 'public.' || event_type as object_identity,
            case when user_id % 2 = 1 then 'ALTER TABLE ' || event_type end as query
        from feed where type = 'DDL'"""),
    "ddl_plain": f"""with {_STAMPED}
        select source, 'shop' as "schema", 'ALTER TABLE orders ADD x INT' as query, seq
        from stamped where action = 'ddl'""",
    "schema_versions": _with(f"select {_HISTORY_COLS} from hist", _HISTORY),
    "schema_changes": _with(
        f"""select {_HISTORY_COLS} from (select *, lag(names) over (partition by "table" order by place)
            as prev from hist) where prev is null or prev <> names""", _HISTORY),
    "schema_latest": _with(
        f"""select {_HISTORY_COLS} from (select *, row_number() over (partition by "table"
            order by place desc) as rn from hist) where rn = 1""", _HISTORY),
    "schema_of_table": _with(
        f"""select {_HISTORY_COLS} from hist where "table" = 'click' """, _HISTORY),
    "tx_assign": _with("""
        , runs as (select source, lsn, type, "sourceTimestamp" as ts, sum(case when type = 'BEGIN' then 1 else 0 end)
            over (partition by source order by pos rows unbounded preceding) as n,
            last_value(case when type = 'BEGIN' then "sourceTimestamp" end ignore nulls) over
            (partition by source order by pos rows between unbounded preceding and current row) as t
            from feed)
        select source, lsn, type, cast(n as bigint) as tx_no, t as tx_timestamp,
            coalesce(nullif(ts, 0), t, 0) as "sourceTimestamp" from runs"""),
    "tx_assign_commits": f"""with {_STAMPED}, {_BINLOG_EVENTS}, runs as (select *,
            coalesce(sum(case when type = 'COMMIT' then 1 else 0 end) over (partition by source
            order by seq, idx rows between unbounded preceding and 1 preceding), 0) as n from binlog)
        select source, cast(n as bigint) as tx_no, count(*) as events, min(seq) as first_seq,
            max(seq) as last_seq from runs group by source, n""",
    "heartbeat_gaps": _with("""
        , gaps as (select source, lsn, "timestamp" as t, lead("timestamp") over (partition by source
            order by pos) as until from feed)
        select source, 'HEARTBEAT' as type, lsn, unnest(generate_series(t + 30000, until, 30000))
            as "timestamp", cast(unnest(generate_series(1, (until - t) // 30000)) as integer) as idx
        from gaps where until - t >= 30000"""),
    "events_by_type": _with("select type, count(*) as events from feed group by type"),
    "published_by_type": _with("select type, count(*) as events from pub group by type"),
    "failed_total": _with("select count(*) as failed from gated where not good"),
    "acked": _with(_acked("pub")),
    "resume_after": _with(f"""
        select f.source, f.lsn from feed f left join (select source, max(pos) as p from {_BEFORE}
            group by source) a on a.source = f.source where a.p is null or f.pos > a.p"""),
    "resume_latest": _with(f"""
        select f.source, f.lsn from feed f left join (select source, max(pos) as p from {_BEFORE}
            group by source) a on a.source = f.source
        left join (select source, max(pos) as p from feed where "timestamp" < 1705708800000
            group by source) c on c.source = f.source
        where f.pos > coalesce(a.p, c.p)"""),
    "delivery_check": _with("""
        select source, count(*) as expected,
            cast(sum(case type when 'DELETE' then 0 when 'INSERT' then 2 else 1 end) as bigint) as delivered,
            count(*) filter (type <> 'DELETE') as distinct_delivered,
            count(*) filter (type = 'INSERT') as duplicates,
            count(*) filter (type = 'DELETE') as missing, cast(0 as bigint) as unexpected
        from feed group by source"""),
    "bootstrap_union": _with(f"""
        , live as (select * from good where type in ('INSERT','UPDATE','DELETE','TRUNCATE'))
        select source, "schema", "table", type, data, lsn, false as from_snapshot from live
        union all select 'db0', 'public', 'click', 'INSERT', {_object([
            ("id", _text("c_custkey")), ("value", _text("cast(c_acctbal as decimal(12,2))"))])}, '', true
        from customer where not exists (select 1 from live where live.user_id = c_custkey
            and live.source = 'db0' and live."schema" = 'public' and live."table" = 'click'
            and live.type <> 'TRUNCATE')"""),
    "bootstrap_delivered": _with("""
        select subject, type, count(*) as events from (
            select n.subject, n.type from named n join pub p on p.event_id = n.event_id
                where n.type = 'DDL' or n."table" in ('customer', 'click')
            union all select 'cdc.public.customer', 'INSERT' from customer)
        group by subject, type"""),
    "merge_two_databases": f"""with {FEED}, {_STAMPED}, {_BINLOG_EVENTS}
        select source, "schema", "table", type, count(*) as events from (
            select 'postgres' as source, "schema", "table", type from pub
            union all select 'mysql', "schema", "table", type from binlog where type <> 'COMMIT')
        group by source, "schema", "table", type""",
    "wal_damaged": _with(
        f"""select {_pos_text('pos')} as lsn, type, cast(rel_id as bigint) as rel_id, idx, reject_reason from (
            select pos + 1 as pos, 'RELATION' as type, list_position(['click','error','purchase','signup','view'], event_type) + 9
                as rel_id, 0 as idx, 'truncated message' as reject_reason from marks where event_id % 140 = 0
            union all select pos, 'DDL', 99, 0, 'truncated message' from typed where type = 'DDL' and event_id % 2 = 0
            union all select pos, type, list_position(['click','error','purchase','signup','view'], event_type) + 9, 0,
                'unknown relation' from versions where type in ('INSERT','UPDATE','DELETE','TRUNCATE')
                and (announced is null or announced % 140 = 0)
            union all select pos, type, 77, 2, 'unknown relation' from versions where type = 'TRUNCATE'
            union all select pos, type, 10, 1, 'unknown relation' from versions v where type = 'TRUNCATE' and coalesce(
                (select max(m.event_id) from marks m where m.event_type = 'click' and m.event_id < v.event_id), 0) % 140 = 0)""",
        _EVENT_WAL,
    ),
    "log_source": _with("""
        select lsn, type, '' as "schema", '' as "table", '' as data,
            case type when 'BEGIN' then "timestamp" else 0 end as "sourceTimestamp"
        from feed where type in ('BEGIN', 'COMMIT') and pos > 2000000000"""),
    "filled_images": f"""
        with sent as (select event_id, event_id * 1000003 + 16777216 as pos, user_id,
                case when event_id % 5 <> 0 then cast(cast(value as decimal(12,2)) as varchar) end as v,
                case when event_id % 3 = 0 then props end as p from events),
        known as (select *, last_value(v ignore nulls) over w as value, last_value(p ignore nulls) over w as props
            from sent window w as (partition by user_id order by event_id rows between unbounded preceding and current row))
        select {_pos_text('pos')} as lsn, 'notes' as "table",
            '{{"new":{{"id":' || user_id || ', "value":' || coalesce(value, '"unchanged"') || ', "props":' ||
            coalesce(props, '"unchanged"') || '}}}}' as data,
            concat_ws(',', case when value is null then 'value' end, case when props is null then 'props' end) as unchanged
        from known""",
    "dump_lines": """
        with dumped as (
            select 0 as rank, 'customer' as "table", c_custkey as key from customer
            union all select 1, 'orders', o_orderkey from orders
            union all select 2, 'documents', doc_id from documents),
        lines as (
            select key % 8 as part, rank, "table", key, key as place from dumped
            union all select part, rank, null, null, place from range(8) p(part), range(3) r(rank),
                (values (-1), (4611686018427387904), (4611686018427387905)) m(place)),
        numbered as (select *, row_number() over (order by part, rank, place) - 1 as seq from lines)
        select "table", key, seq, 0 as idx from numbered where "table" is not null""",
    "subject_index": _with(r"""
        select pattern, 'reads ' || pattern as subscriber, count(*) as events, min(lsn) as first_lsn,
            cast(sum(event_id) as bigint) as seqs
        from (select distinct pattern from (
                select distinct subject, unnest([
                    '*.' || split_part(subject, '.', 2) || '.' || split_part(subject, '.', 3),
                    split_part(subject, '.', 1) || '.*.' || split_part(subject, '.', 3),
                    split_part(subject, '.', 1) || '.' || split_part(subject, '.', 2) || '.*',
                    '>', split_part(subject, '.', 1) || '.>',
                    split_part(subject, '.', 1) || '.' || split_part(subject, '.', 2) || '.>', subject]) as pattern from named))
            join named on regexp_full_match(subject,
                replace(replace(replace(pattern, '.', '\.'), '*', '[^.]+'), '>', '.+'))
        group by pattern"""),
    "publish_roundtrip": _with("""
        select n.subject, n.type, n."schema", n."table", n.data, n.lsn, n."timestamp"
        from named n join pub p on p.event_id = n.event_id"""),
    "audit_snapshot": """
        select 'db0' as source, count(*) as expected,
            count(*) filter (where c_nationkey <> 3) + count(*) filter (where c_nationkey = 5) as delivered,
            count(*) filter (where c_nationkey <> 3) as distinct_delivered,
            count(*) filter (where c_nationkey = 5) as duplicates,
            count(*) filter (where c_nationkey = 3) as missing, cast(0 as bigint) as unexpected
        from customer""",
    "resume_snapshot": _with(f"""
        select source, "schema", "table", lsn, data from feed f where source <> 'db2' and pos > (
            select max(pos) from pub p where p.source = f.source and p."timestamp" < 1705276800000 and p.source <> 'db2')
        union all select 'db0', 'public', 'nation', '', {_object([
            ("n_nationkey", _text("n_nationkey")), ("n_name", _text("n_name")), ("n_regionkey", _text("n_regionkey"))])} from nation"""),
}
