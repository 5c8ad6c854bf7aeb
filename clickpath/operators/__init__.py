"""DataFrame -> DataFrame operators; each serves batch and ``foreachBatch`` alike."""

from clickpath.operators import sketch
from clickpath.operators.ads import (ad_user_daily, area_ad_daily, area_city_ad_daily, area_rollup,
                                     area_top_ads, area_top_ads_json, blacklist, click_trend,
                                     clicks_kept, exclude, trend_windows)
from clickpath.operators.categories import (category_events, category_metric_counts,
                                            category_metrics, category_session_clicks,
                                            category_top10, category_top10_sessions,
                                            clicks_in_categories)
from clickpath.operators.filters import (action_kind, click_rows, date_range, has_click)
from clickpath.operators.pageflow import (adjacent_pairs, flow_pairs, page_avg_dwell,
                                          page_dwell_dropped, page_dwell_rows,
                                          page_flow_conversion, page_transition_counts, page_view_counts, parse_flow)
from clickpath.operators.sessions import session_steps, session_successors
from clickpath.operators.topk import top_k_per_group
from clickpath.operators.words import word_count

__all__ = [
    "action_kind", "ad_user_daily", "adjacent_pairs", "area_ad_daily", "area_city_ad_daily",
    "area_rollup", "area_top_ads", "area_top_ads_json", "blacklist", "category_events",
    "category_metric_counts", "category_metrics", "category_session_clicks", "category_top10",
    "category_top10_sessions", "click_rows", "click_trend", "clicks_in_categories",
    "clicks_kept", "date_range", "exclude", "flow_pairs", "has_click",
    "page_avg_dwell", "page_dwell_dropped", "page_dwell_rows", "page_flow_conversion", "page_transition_counts",
    "page_view_counts", "parse_flow", "session_steps", "session_successors", "sketch", "top_k_per_group", "trend_windows",
    "word_count",
]
