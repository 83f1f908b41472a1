"""End-to-end pipelines."""

from changefeed.plans.pipelines import (
    deliverable,
    live_mysql,
    live_postgres,
    start_feed,
    subject_counts,
)

__all__ = ["deliverable", "live_mysql", "live_postgres", "start_feed", "subject_counts"]
