"""DataFrame to DataFrame operators over change events."""

from changefeed.operators.bootstrap import bootstrap, merge_feeds, snapshot_mode
from changefeed.operators.ddl import ddl_log, intercept_ddl
from changefeed.operators.delivery import (
    acked_positions,
    delivery_audit,
    drop_redelivered,
    resume_from,
)
from changefeed.operators.envelope import (
    event_time,
    make_event,
    parse_envelope,
    to_envelope_json,
    to_messages,
)
from changefeed.operators.filters import (
    filter_tables,
    match_subject,
    publishable,
    table_events,
)
from changefeed.operators.heartbeats import heartbeats
from changefeed.operators.metrics import (
    event_counts,
    observe_events,
    published_counts,
    reject_count,
)
from changefeed.operators.routing import add_subject, route, route_all, route_tenants
from changefeed.operators.schema_history import (
    collapse_repeats,
    latest_schema,
    load_history,
    schema_history,
    table_history,
)
from changefeed.operators.transactions import assign_transactions, with_source_timestamp
from changefeed.operators.validation import accepted, rejected, validate

__all__ = [
    "accepted",
    "acked_positions",
    "add_subject",
    "assign_transactions",
    "bootstrap",
    "collapse_repeats",
    "ddl_log",
    "delivery_audit",
    "drop_redelivered",
    "event_counts",
    "event_time",
    "filter_tables",
    "heartbeats",
    "intercept_ddl",
    "latest_schema",
    "load_history",
    "make_event",
    "match_subject",
    "merge_feeds",
    "observe_events",
    "parse_envelope",
    "publishable",
    "published_counts",
    "reject_count",
    "rejected",
    "resume_from",
    "route",
    "route_all",
    "route_tenants",
    "schema_history",
    "snapshot_mode",
    "table_events",
    "table_history",
    "to_envelope_json",
    "to_messages",
    "validate",
    "with_source_timestamp",
]
