"""Streaming catalog queries: replay the tables through each streaming job.

Ad-log lines are staged one file span (``PARAMS["stream_file_ms"]`` of event
time) per micro-batch, in time order, so the oracle can name each batch; the
number of spans is bounded by the time range, not the row count. Documents go
as text lines, one micro-batch per language.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from clickpath.functions import floor_div
from clickpath.plans.catalog import _lines
from clickpath.plans.params import PARAMS
from clickpath.session import new_work_dir
from clickpath.sources import read_table
from clickpath.streaming import jobs as J
from clickpath.streaming.replay import replay_by, run_by


def _spans(spark, d):
    """The ad-log lines with the number of their file span."""
    lines = _lines(spark, d)
    return lines.select("event_id", "value", floor_div(F.col("ts_ms"), PARAMS["stream_file_ms"]).alias("_span"))


def _run_ads(spark, d, make_job, name):
    work = new_work_dir(spark, name)
    return replay_by(spark, _spans(spark, d), "_span", make_job(spark, f"{work}/job"), work)


def stream_area_city_ad_daily(spark, d):
    return _run_ads(spark, d, J.AreaCityAdDailyJob, "stream-acd")


def stream_ad_user_daily(spark, d):
    return _run_ads(spark, d, J.AdUserDailyJob, "stream-aud")


def stream_area_top3_ads(spark, d):
    return _run_ads(spark, d, J.AreaTopAdsJob, "stream-top3")


def stream_ad_trend_10s(spark, d):
    return _run_ads(spark, d, J.ClickTrendJob, "stream-trend")


def stream_ad_blacklist(spark, d):
    return _run_ads(spark, d, lambda s, o: J.BlacklistJob(s, o, PARAMS["threshold"]),
                    "stream-blacklist")


def _run_behind_list(spark, d, job_class, name):
    """A job that asks in each batch who had been listed before it, over the same batches."""
    work = new_work_dir(spark, f"{name}-list")
    listing = J.BlacklistJob(spark, f"{work}/job", PARAMS["threshold"])
    run_by(spark, _spans(spark, d), "_span", listing, work)
    return _run_ads(spark, d, lambda s, o: job_class(s, o, exclude_users=listing.listed_before), name)


def stream_area_top3_listed(spark, d):
    """Top ads of each area without the clicks of users listed before."""
    return _run_behind_list(spark, d, J.AreaTopAdsJob, "stream-top3-listed")


def stream_trend_listed(spark, d):
    """The click trend without the clicks of users listed before."""
    return _run_behind_list(spark, d, J.ClickTrendJob, "stream-trend-listed")


def _damaged(spark, d):
    """The lines with every seventh cut short, so that it does not parse."""
    bad = F.substring("value", 1, 15)
    return _spans(spark, d).withColumn("value", F.when(F.col("event_id") % 7 == 0, bad).otherwise(F.col("value")))


def stream_rejects(spark, d):
    """Lines that each ad-log job keeps because its parser cannot use them."""
    out = None
    for name, make in (("r5", J.AreaCityAdDailyJob), ("r6", J.AreaTopAdsJob), ("r7", J.ClickTrendJob), ("a11", J.AdUserDailyJob)):
        work = new_work_dir(spark, f"stream-rejects-{name}")
        job = make(spark, f"{work}/job")
        run_by(spark, _damaged(spark, d), "_span", job, work)
        kept = job.rejects.read().groupBy("value").agg(F.count(F.lit(1)).alias("n")).withColumn("job", F.lit(name)).select("job", "value", "n")
        out = kept if out is None else out.union(kept)
    return out


def stream_trend_latest(spark, d):
    """The last minute of the click trend, in order."""
    work = new_work_dir(spark, "stream-latest")
    job = J.ClickTrendJob(spark, f"{work}/job")
    run_by(spark, _spans(spark, d), "_span", job, work)
    return job.latest()


def stream_trend_arrival(spark, d):
    """The trend by time of arrival: staged batches arrive ``arrival_step_s`` seconds apart."""
    return _run_ads(spark, d, lambda s, o: J.ArrivalTrendJob(s, o, arrival=lambda b: b * PARAMS["arrival_step_s"]),
                    "stream-arrival")


def stream_word_count(spark, d):
    work = new_work_dir(spark, "stream-words")
    docs = read_table(spark, d, "documents")
    lines = docs.select("lang", F.explode(F.split(F.col("text"), "\n")).alias("value"))
    return replay_by(spark, lines, "lang", J.WordCountJob(spark, f"{work}/job"), work)


STREAM_QUERIES = {
    "stream_area_city_ad_daily": stream_area_city_ad_daily,
    "stream_ad_user_daily": stream_ad_user_daily,
    "stream_area_top3_ads": stream_area_top3_ads,
    "stream_ad_trend_10s": stream_ad_trend_10s,
    "stream_ad_blacklist": stream_ad_blacklist,
    "stream_area_top3_listed": stream_area_top3_listed,
    "stream_trend_listed": stream_trend_listed,
    "stream_rejects": stream_rejects,
    "stream_trend_latest": stream_trend_latest,
    "stream_trend_arrival": stream_trend_arrival,
    "stream_word_count": stream_word_count,
}
