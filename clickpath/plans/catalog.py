"""The query catalog: one ``(spark, sf_dir) -> DataFrame`` per operator or report.

Every query reads the driver's tables (through the fixture adapters) in full;
parameters are in ``params.PARAMS`` and are the same ones the SQL oracle uses.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpath import operators as O
from clickpath.functions import (DATE_FMT, TIME_FMT, concat_key, floor_10s_text, floor_seconds, format_date, format_time,
                                 is_not_empty, java_split, json_field, parse_time_lenient_ms, parse_time_ms,
                                 substring0)
from clickpath.plans.params import PARAMS
from clickpath.sources import (ensure_parallelism, format_ad_log, load_ad_clicks, load_visits,
                               parse_ad_log, read_table)
from clickpath.sources.tables import BROADCAST_MAX_BYTES, broadcast_if_small, plan_size_bytes, rows_to_frame, stored

Query = Callable[[SparkSession, str], DataFrame]


def _visits(spark, d):
    return load_visits(spark, d)


def _clicks(spark, d):
    return load_ad_clicks(spark, d)


def _lines(spark, d):
    clicks = _clicks(spark, d)
    return clicks.select("event_id", "ts_ms", format_ad_log(clicks).alias("value"))


# ---------------------------------------------------------------- scans, filters
def visit_scan(spark, d):
    return _visits(spark, d)


def visit_preview(spark, d):
    return _visits(spark, d).orderBy("event_id").limit(100)


def visit_date_range(spark, d):
    lo, hi = PARAMS["date_range"]
    return O.date_range(load_visits(spark, d, lo, hi), lo, hi).select("event_id", "date")


def str_is_not_empty(spark, d):
    docs = ensure_parallelism(read_table(spark, d, "documents").select("text"))
    lines = docs.select(F.explode(F.split(F.col("text"), "\n")).alias("line"))
    return lines.groupBy(is_not_empty(F.col("line")).alias("not_empty")).agg(
        F.count(F.lit(1)).alias("n"))


def click_rows(spark, d):
    return O.click_rows(_visits(spark, d)).select("event_id", "session_id", "click_category_id")


def action_kind_counts(spark, d):
    return (_visits(spark, d).groupBy(F.coalesce(O.action_kind(), F.lit("none")).alias("kind"))
            .agg(F.count(F.lit(1)).alias("n")))


# ---------------------------------------------------------------- categories
def category_metric_counts(spark, d):
    return O.category_metric_counts(_visits(spark, d))


def category_metrics(spark, d):
    return O.category_metrics(_visits(spark, d))


def category_top10(spark, d):
    return O.category_top10(_visits(spark, d))


def category_session_clicks(spark, d):
    return O.category_session_clicks(_visits(spark, d))


def clicks_in_top10(spark, d):
    v = _visits(spark, d)
    return O.clicks_in_categories(v, O.category_top10(v)).select(
        "event_id", "category_id", "session_id")


def category_top10_sessions(spark, d):
    return O.category_top10_sessions(_visits(spark, d))


# ---------------------------------------------------------------- page flow
def page_view_counts(spark, d):
    return O.page_view_counts(_visits(spark, d), PARAMS["flow"])


def page_transition_counts(spark, d):
    return O.page_transition_counts(_visits(spark, d))


def page_flow_conversion(spark, d):
    return O.page_flow_conversion(_visits(spark, d), PARAMS["flow"])


def page_flow_conversion_dated(spark, d):
    lo, hi = PARAMS["flow_date_range"]
    return O.page_flow_conversion(O.date_range(load_visits(spark, d, lo, hi), lo, hi), PARAMS["flow"])


def page_flow_conversion_split(spark, d):
    """R3 with the exact hot-slice split switched on (same result as R3)."""
    return O.page_flow_conversion(_visits(spark, d), PARAMS["flow"],
                                  hot_rows=PARAMS["split_hot_rows"])


def page_dwell_rows(spark, d):
    return O.page_dwell_rows(_visits(spark, d))


def page_avg_dwell(spark, d):
    return O.page_avg_dwell(_visits(spark, d))


def _bad_times(visits):
    """Visits whose times are damaged by a pure expression: a part don't parse, a part are null."""
    damaged = (F.when(F.col("event_id") % 5 == 0, F.concat(F.substring("action_time", 1, 18), F.lit("x")))
               .when(F.col("event_id") % 7 == 0, F.lit(None)).otherwise(F.col("action_time")))
    return visits.withColumn("action_time", damaged)


def page_transitions_bad_times(spark, d):
    return O.page_transition_counts(_bad_times(_visits(spark, d)))


def page_transitions_bad_times_split(spark, d):
    """The same with every session split (same result)."""
    return O.page_transition_counts(_bad_times(_visits(spark, d)), hot_rows=PARAMS["split_hot_rows"])


def page_dwell_dropped(spark, d):
    return O.page_dwell_dropped(_bad_times(_visits(spark, d)))


def flow_pairs(spark, d):
    v = _visits(spark, d).where(F.col("order_category_ids").isNotNull())
    pairs = v.select("event_id", F.posexplode(
        O.adjacent_pairs(java_split(F.col("order_category_ids"), ","))).alias("pos", "p"))
    return pairs.select("event_id", F.col("pos").cast("bigint").alias("pos"),
                        F.col("p.first").alias("first"), F.col("p.second").alias("second"))


# ---------------------------------------------------------------- scalar functions
def fn_split_explode(spark, d):
    v = _visits(spark, d).where(F.col("order_category_ids").isNotNull())
    return v.select("event_id", F.posexplode(java_split(F.col("order_category_ids"), ","))
                    .alias("pos", "category_id")).withColumn("pos", F.col("pos").cast("bigint"))


def str_blank_lines(spark, d):
    """F2 over lines that hold both outcomes: each text gets blank lines behind it."""
    docs = ensure_parallelism(read_table(spark, d, "documents").select("text"))
    lines = docs.select(F.explode(F.split(F.concat("text", F.lit("\n \t\n")), "\n")).alias("line"))
    return lines.groupBy(is_not_empty(F.col("line")).alias("not_empty")).agg(F.count(F.lit(1)).alias("n"))


def fn_split_empty_ids(spark, d):
    """X5 over id lists with empty ids inside and at the end."""
    v = _visits(spark, d).where(F.col("order_category_ids").isNotNull())
    ids = F.when(F.col("event_id") % 3 == 0, F.lit(",,")).otherwise(
        F.concat(F.lit(",,"), F.col("order_category_ids"), F.lit(",,7,,")))
    return v.select("event_id", F.posexplode(java_split(ids, ",")).alias("pos", "category_id")).withColumn(
        "pos", F.col("pos").cast("bigint"))


def fn_format_date(spark, d):
    return read_table(spark, d, "events").select("event_id", format_date(F.col("ts").cast("timestamp")).alias("day"))


def fn_format_time(spark, d):
    return _clicks(spark, d).select("event_id",
                                    format_time(F.col("ts_ms"), TIME_FMT).alias("time_str"),
                                    format_time(F.col("ts_ms"), DATE_FMT).alias("date_str"))


def fn_parse_time(spark, d):
    return _visits(spark, d).select("event_id",
                                    parse_time_ms(F.col("action_time")).alias("action_ms"))


def fn_parse_lenient(spark, d):
    """X3 with a lenient calendar, over times whose fields are moved out of their ranges; a part is no time at all."""
    t = F.col("action_time")
    part = lambda at, n, add: (F.substring(t, at, n).cast("int") + add).cast("string")
    moved = F.concat(F.substring(t, 1, 5), part(6, 2, 11), F.lit("-"), part(9, 2, 40), F.lit(" "),
                     part(12, 2, 30), F.lit(":"), part(15, 2, 70), F.lit(": "), part(18, 2, 100), F.lit(" and more"))
    times = F.when(F.col("event_id") % 5 == 0, F.lit("no time")).when(F.col("event_id") % 5 == 1, t).otherwise(moved)
    return _visits(spark, d).select("event_id", parse_time_lenient_ms(times).alias("action_ms"))


def fn_floor_10s(spark, d):
    return _clicks(spark, d).select(
        "event_id", floor_10s_text(format_time(F.col("ts_ms"))).alias("bucket_time"),
        floor_seconds(F.col("ts_ms"), 10).alias("bucket_s"))


def fn_substring(spark, d):
    return _visits(spark, d).select("event_id",
                                    substring0(F.col("action_time"), 0, 10).alias("day"),
                                    substring0(F.col("action_time"), 11, 13).alias("hour"))


def fn_json_field(spark, d):
    return read_table(spark, d, "events").select(
        "event_id", json_field(F.col("props"), "k").alias("k"),
        json_field(F.col("props"), "missing").alias("missing"))


# ---------------------------------------------------------------- ad log lines
def ad_log_format(spark, d):
    return _lines(spark, d).select("event_id", F.col("value").alias("line"))


def ad_log_parse(spark, d):
    return parse_ad_log(_lines(spark, d).select("value"))


# ---------------------------------------------------------------- ad reports
def area_city_ad_daily(spark, d):
    return O.area_city_ad_daily(_clicks(spark, d))


def area_ad_daily(spark, d):
    return O.area_ad_daily(O.area_city_ad_daily(_clicks(spark, d)))


def area_top3_ads(spark, d):
    return O.area_top_ads(area_ad_daily(spark, d), 3)


def area_top3_ads_json(spark, d):
    return O.area_top_ads_json(area_top3_ads(spark, d))


def ad_user_daily(spark, d):
    return O.ad_user_daily(_clicks(spark, d))


def ad_blacklist(spark, d):
    return O.blacklist(_clicks(spark, d), PARAMS["threshold"])


def ad_blacklist_default(spark, d):
    """R4 at the default threshold: 45 % of all clicks are given to one user and ad."""
    heavy = F.col("event_id") % 100 < 45
    clicks = _clicks(spark, d).withColumns({"user_id": F.when(heavy, F.lit(0)).otherwise(F.col("user_id")).cast("bigint"),
                                            "ad_id": F.when(heavy, F.lit(1)).otherwise(F.col("ad_id")).cast("bigint")})
    return O.blacklist(clicks)


def ad_clicks_kept(spark, d):
    """J2 with the list stored once: broadcast if it is small, else behind a sketch of it."""
    clicks = _clicks(spark, d)
    listed = stored(O.blacklist(clicks, PARAMS["threshold"]), "blacklist")
    small = plan_size_bytes(listed) <= BROADCAST_MAX_BYTES
    words = None if small else O.sketch.words_for(listed.count())
    return O.clicks_kept(clicks, broadcast_if_small(listed), sketch_words=words).select("event_id", "user_id", "batch")


def ad_clicks_kept_sketch(spark, d):
    """The same, always behind the sketch: only the clicks it does not rule out meet the list."""
    clicks = _clicks(spark, d)
    listed = stored(O.blacklist(clicks, PARAMS["threshold"]), "blacklist")
    return O.clicks_kept(clicks, listed, sketch_words=O.sketch.words_for(listed.count())).select(
        "event_id", "user_id", "batch")


def ad_key_counts(spark, d):
    """counts under the reference's joined key, ``date_area_city_ad``."""
    key = concat_key("_", F.col("date"), F.col("area"), F.col("city"), F.col("ad_id"))
    return _clicks(spark, d).groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n"))


def page_views_by_step(spark, d):
    """The target flow as local rows, joined to the views of each of its pages."""
    steps = rows_to_frame(spark, list(enumerate(PARAMS["flow"])), "step bigint, page_id bigint")
    views = O.page_view_counts(_visits(spark, d), PARAMS["flow"])
    return views.join(F.broadcast(steps), "page_id").select("step", "page_id", "views")


def area_rollup(spark, d):
    return O.area_rollup(_clicks(spark, d))


def ad_trend_10s(spark, d):
    return O.click_trend(_clicks(spark, d))


def word_count(spark, d):
    return O.word_count(ensure_parallelism(read_table(spark, d, "documents").select("text")))


BATCH_QUERIES: dict[str, Query] = {
    "visit_scan": visit_scan,
    "visit_preview": visit_preview,
    "visit_date_range": visit_date_range,
    "str_is_not_empty": str_is_not_empty,
    "click_rows": click_rows,
    "action_kind_counts": action_kind_counts,
    "category_metric_counts": category_metric_counts,
    "category_metrics": category_metrics,
    "category_top10": category_top10,
    "category_session_clicks": category_session_clicks,
    "clicks_in_top10": clicks_in_top10,
    "category_top10_sessions": category_top10_sessions,
    "page_view_counts": page_view_counts,
    "page_transition_counts": page_transition_counts,
    "page_flow_conversion": page_flow_conversion,
    "page_flow_conversion_dated": page_flow_conversion_dated,
    "page_flow_conversion_split": page_flow_conversion_split,
    "page_transitions_bad_times": page_transitions_bad_times,
    "page_transitions_bad_times_split": page_transitions_bad_times_split,
    "page_dwell_dropped": page_dwell_dropped,
    "str_blank_lines": str_blank_lines,
    "fn_split_empty_ids": fn_split_empty_ids,
    "fn_format_date": fn_format_date,
    "ad_blacklist_default": ad_blacklist_default,
    "page_dwell_rows": page_dwell_rows,
    "page_avg_dwell": page_avg_dwell,
    "flow_pairs": flow_pairs,
    "fn_split_explode": fn_split_explode,
    "fn_format_time": fn_format_time,
    "fn_parse_time": fn_parse_time,
    "fn_floor_10s": fn_floor_10s,
    "fn_substring": fn_substring,
    "fn_json_field": fn_json_field,
    "ad_log_format": ad_log_format,
    "ad_log_parse": ad_log_parse,
    "area_city_ad_daily": area_city_ad_daily,
    "area_ad_daily": area_ad_daily,
    "area_top3_ads": area_top3_ads,
    "area_top3_ads_json": area_top3_ads_json,
    "ad_user_daily": ad_user_daily,
    "ad_blacklist": ad_blacklist,
    "ad_clicks_kept": ad_clicks_kept,
    "ad_clicks_kept_sketch": ad_clicks_kept_sketch,
    "area_rollup": area_rollup,
    "ad_key_counts": ad_key_counts,
    "page_views_by_step": page_views_by_step,
    "fn_parse_lenient": fn_parse_lenient,
    "ad_trend_10s": ad_trend_10s,
    "word_count": word_count,
}


def queries() -> dict[str, Query]:
    from clickpath.plans.roundtrips import ROUNDTRIP_QUERIES
    from clickpath.streaming.catalog import STREAM_QUERIES
    return {**BATCH_QUERIES, **ROUNDTRIP_QUERIES, **STREAM_QUERIES}
