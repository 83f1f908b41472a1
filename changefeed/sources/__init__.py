"""Readers: captured logs, dumps and table snapshots."""

from changefeed.sources.binlog import binlog_rejects, current_files, decode_binlog, stamp_binlog_file
from changefeed.sources.log_files import read_log, stream_log
from changefeed.sources.mysql_dump import dump_position, mysql_dump_rejects, read_mysql_dump
from changefeed.sources.pg_dump import pg_dump_rejects, read_pg_dump
from changefeed.sources.snapshot import (
    chunk_at,
    keyset_chunks,
    next_chunk,
    numbered_rows,
    offset_chunks,
    rows_to_events,
    snapshot_jdbc,
)
from changefeed.sources.wal import (
    attach_relations,
    changed_layouts,
    decode_images,
    decode_messages,
    decode_wal,
    read_relations,
    wal_rejects,
)

__all__ = [
    "attach_relations",
    "binlog_rejects",
    "changed_layouts",
    "chunk_at",
    "current_files",
    "decode_binlog",
    "decode_images",
    "decode_messages",
    "decode_wal",
    "dump_position",
    "keyset_chunks",
    "mysql_dump_rejects",
    "next_chunk",
    "numbered_rows",
    "offset_chunks",
    "pg_dump_rejects",
    "read_log",
    "read_mysql_dump",
    "read_pg_dump",
    "read_relations",
    "rows_to_events",
    "snapshot_jdbc",
    "stamp_binlog_file",
    "stream_log",
    "wal_rejects",
]
