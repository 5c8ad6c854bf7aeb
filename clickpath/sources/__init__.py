"""Batch sources: driver tables, fixture adapters, ad-log lines."""

from clickpath.sources.adapters import (ad_clicks_from_events, load_ad_clicks, load_visits,
                                        visits_from_events)
from clickpath.sources.adlog import format_ad_log, parse_ad_log, publish_kafka, publish_lines, reject_ad_log
from clickpath.sources.tables import (broadcast_if_small, ensure_parallelism, plan_size_bytes,
                                      read_table, read_visit_actions, rows_to_frame, stored)

__all__ = [
    "ad_clicks_from_events", "broadcast_if_small", "ensure_parallelism", "format_ad_log",
    "load_ad_clicks", "load_visits", "parse_ad_log", "plan_size_bytes", "publish_kafka",
    "publish_lines", "read_table", "read_visit_actions", "reject_ad_log",
    "rows_to_frame", "stored", "visits_from_events",
]
