"""Column expressions: JSON text, positions, subjects, values and payloads."""

from changefeed.functions.json_text import is_valid_json, json_escape, json_quote
from changefeed.functions.payload import (
    before_after,
    build_update,
    payload_as,
    payload_field,
)
from changefeed.functions.positions import (
    binlog_file_number,
    combined_position,
    format_binlog_pos,
    format_lsn,
    message_end_lsn,
    parse_binlog_pos,
    parse_lsn,
    pg_micros_to_epoch_ms,
)
from changefeed.functions.subjects import sanitize_token, subject, subject_matches
from changefeed.functions.values import (
    render_mysql_value,
    render_pg_value,
    render_row,
)

__all__ = [
    "before_after",
    "binlog_file_number",
    "build_update",
    "combined_position",
    "format_binlog_pos",
    "format_lsn",
    "is_valid_json",
    "json_escape",
    "json_quote",
    "message_end_lsn",
    "parse_binlog_pos",
    "parse_lsn",
    "payload_as",
    "payload_field",
    "pg_micros_to_epoch_ms",
    "render_mysql_value",
    "render_pg_value",
    "render_row",
    "sanitize_token",
    "subject",
    "subject_matches",
]
