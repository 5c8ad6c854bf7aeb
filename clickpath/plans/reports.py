"""The reports as complete jobs (R1-R9): read, filter by the optional date bounds,
compute, and write to the chosen sink.

Each job takes its parameters as arguments (the reference read them from config
bundles: database, startDate/endDate, targetPageFlow, JDBC and broker
settings) and returns the result DataFrame (batch) or the StreamingQuery
(stream), so callers can also chain or inspect them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from clickpath import operators as O
from clickpath import schema as S
from clickpath.sinks import overwrite_table, write_jdbc
from clickpath.sources import read_visit_actions
from clickpath.streaming import jobs as J


def _visits(spark: SparkSession, source: str | DataFrame, start: str | None,
            end: str | None) -> DataFrame:
    visits = source if isinstance(source, DataFrame) else read_visit_actions(spark, source)
    return O.date_range(visits, start, end)


def _sink(df: DataFrame, table: str | None, jdbc: dict | None) -> DataFrame:
    """Write ``df`` to a catalog table (replaced) and/or a JDBC table (appended).

    ``jdbc``: ``{"url": ..., "table": ..., "properties": {...}}``.
    """
    if table:
        overwrite_table(df, table)
    if jdbc:
        write_jdbc(df, jdbc["url"], jdbc["table"], jdbc.get("properties"))
    return df


def category_top10_job(spark: SparkSession, visits: str | DataFrame, start: str | None = None,
                       end: str | None = None, task_id: str | None = None, k: int = 10,
                       table: str | None = None, jdbc: dict | None = None) -> DataFrame:
    """Top-k categories by click, order and pay count, one task id per run.
    Rows have the reference's result-table schema (``schema.CATEGORY_TOP10``)."""
    result = O.category_top10(_visits(spark, visits, start, end), k,
                              task_id or str(uuid.uuid4()))
    return _sink(S.conform(result, S.CATEGORY_TOP10), table, jdbc)


def category_top10_sessions_job(spark: SparkSession, visits: str | DataFrame,
                                start: str | None = None, end: str | None = None,
                                task_id: str | None = None, k_categories: int = 10,
                                k_sessions: int = 10, table: str | None = None,
                                jdbc: dict | None = None) -> DataFrame:
    """R2: top sessions of each top category, in the reference's result-table
    schema (``schema.CATEGORY_TOP10_SESSION``; the rank is not stored)."""
    result = O.category_top10_sessions(_visits(spark, visits, start, end), k_categories,
                                       k_sessions, task_id or str(uuid.uuid4()))
    return _sink(S.conform(result, S.CATEGORY_TOP10_SESSION), table, jdbc)


def page_flow_job(spark: SparkSession, visits: str | DataFrame,
                  flow: str | Sequence[int] = O.pageflow.DEFAULT_FLOW, start: str | None = None,
                  end: str | None = None, table: str | None = None,
                  hot_rows: int | None = None) -> DataFrame:
    """Single-hop conversion along ``flow`` (e.g. ``"1,2,3,4,5,6,7"``).
    ``hot_rows`` splits any (session, hour) with more actions (one extra pass)."""
    result = O.page_flow_conversion(_visits(spark, visits, start, end), flow, hot_rows=hot_rows)
    return _sink(result, table, None)


def page_dwell_job(spark: SparkSession, visits: str | DataFrame, start: str | None = None,
                   end: str | None = None, table: str | None = None,
                   hot_rows: int | None = None) -> DataFrame:
    """Average dwell time per page (truncating integer milliseconds)."""
    result = O.page_avg_dwell(_visits(spark, visits, start, end), hot_rows=hot_rows)
    return _sink(result, table, None)


STREAM_JOBS = {
    "blacklist": J.BlacklistJob,            # R4 / R4'
    "area_city_ad_daily": J.AreaCityAdDailyJob,  # R5
    "area_top3_ads": J.AreaTopAdsJob,       # R6
    "ad_trend": J.ClickTrendJob,            # R7, by time of the click
    "ad_trend_arrival": J.ArrivalTrendJob,  # R7, by time of arrival
    "ad_user_daily": J.AdUserDailyJob,      # A11 running counts
    "word_count": J.WordCountJob,           # R9
}


def start_stream_job(spark: SparkSession, name: str, lines: DataFrame, out_dir: str,
                     trigger: dict | None = None, **options) -> tuple[StreamingQuery, object]:
    """Start one of the streaming reports on a streaming DataFrame of lines
    (``streaming.sources.kafka_lines`` or ``file_lines``); returns the query and
    the job, whose ``result()`` reads the sink at any time."""
    job = STREAM_JOBS[name](spark, out_dir, **options)
    return job.start(lines, trigger, name=f"clickpath-{name}"), job
