"""Structured Streaming: decoding, delivery, stored positions and heartbeats."""

from changefeed.streaming.decode import binlog_decoder, framed, wal_decoder
from changefeed.streaming.heartbeats import heartbeat_stream
from changefeed.streaming.publish import (
    committed_batches,
    load_acked,
    publish,
    publish_stream,
    read_published,
    require_target,
)

__all__ = [
    "binlog_decoder",
    "committed_batches",
    "framed",
    "heartbeat_stream",
    "load_acked",
    "publish",
    "publish_stream",
    "read_published",
    "require_target",
    "wal_decoder",
]
