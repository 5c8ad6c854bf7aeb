"""Derive the reference's input shapes from the driver's tables.

Pure column expressions, so Spark and the SQL oracle see the same rows:

* ``events`` -> ``visits``: one visit action per event (schema ``VISIT_ACTION`` plus
  ``event_id`` as the ordering tie key).
* ``events`` x ``nation`` x ``region`` -> ``ad_clicks``: one ad click per event.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from clickpath.functions import DATE_FMT, TIME_FMT
from clickpath.sources.tables import broadcast_if_small, read_table

# Fixed values of the fixture mapping (FIXTURES.md sections 3 and 4).
N_PAGES = 10          # page_id = k % 10 + 1
N_CATEGORIES = 20     # category = k % 20 + 1
N_PRODUCTS = 100      # product = k + 1, (k + j) % 100 + 1
N_KEYWORDS = 6        # keyword = "kw" + k % 6
N_CITIES = 26         # city_id = user_id % 26 + 1
N_NATIONS = 25        # nation = user_id % 25
N_ADS = 6             # ad_id = k % 6 + 1
BATCH_MS = 5000       # batch = ts_ms div 5000 (5 s micro-batch)

_DAY = re.compile(r"[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|1[0-9]|2[0-8])")  # days that every month has


# Both mappings are written as SQL expressions: one projection is one JVM call,
# where the equivalent Column-by-Column build costs hundreds of round trips per
# query (about 0.3 s at plan time).
_K = "try_cast(get_json_object(props, '$.k') AS BIGINT)"


def _ids(*parts: str) -> str:
    return "concat_ws(',', " + ", ".join(parts) + ")"


def _cat(off: int) -> str:
    return f"(k + {off}) % {N_CATEGORIES} + 1"


def _prod(off: int) -> str:
    return f"(k + {off}) % {N_PRODUCTS} + 1"


VISIT_EXPRS = [
    "event_id",
    f"date_format(ts, '{DATE_FMT}') AS date",
    "user_id",
    f"concat(CAST(user_id AS STRING), '-', date_format(ts, '{DATE_FMT}')) AS session_id",
    f"k % {N_PAGES} + 1 AS page_id",
    f"date_format(ts, '{TIME_FMT}') AS action_time",
    f"CASE WHEN event_type = 'view' THEN concat('kw', CAST(k % {N_KEYWORDS} AS STRING)) END"
    " AS search_keyword",
    f"CASE WHEN event_type = 'click' THEN k % {N_CATEGORIES} + 1 ELSE -1L END AS click_category_id",
    "CASE WHEN event_type = 'click' THEN k + 1 ELSE -1L END AS click_product_id",
    f"CASE WHEN event_type = 'signup' THEN {_ids(_cat(0), _cat(7), _cat(13))} END"
    " AS order_category_ids",
    f"CASE WHEN event_type = 'signup' THEN {_ids('k + 1', _prod(7))} END AS order_product_ids",
    f"CASE WHEN event_type = 'purchase' THEN {_ids(_cat(0), _cat(3))} END AS pay_category_ids",
    f"CASE WHEN event_type = 'purchase' THEN {_ids('k + 1', _prod(3))} END AS pay_product_ids",
    f"user_id % {N_CITIES} + 1 AS city_id",
]


def visits_from_events(events: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """``events`` -> visit actions (FIXTURES.md section 3).

    ``start`` and ``end`` (``yyyy-MM-dd``, inclusive) bound the days on ``ts`` itself, so
    that the range reaches the scan; a bound that isn't such a date is not used.
    """
    kind = dict(events.dtypes)["ts"]
    for bound, test in ((start, "ts >= CAST('{0}' AS {1})"), (end, "ts < CAST(date_add(DATE'{0}', 1) AS {1})")):
        if bound is not None and _DAY.fullmatch(bound):
            events = events.where(test.format(bound, kind))
    return (events.selectExpr("event_id", "user_id", "event_type",
                              "CAST(ts AS TIMESTAMP) AS ts", f"{_K} AS k")
            .selectExpr(*VISIT_EXPRS))


def ad_clicks_from_events(events: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """``events`` -> ad clicks with area/city from ``region``/``nation`` (FIXTURES.md section 4).

    ``nation`` and ``region`` are fixed-size dimension tables (25 and 5 rows), so
    their join is broadcast after a planned-size check. Left to itself the
    planner may estimate the dimension join (a product of sizes) above a small
    ``events`` file and broadcast the fact side instead.
    """
    clicks = events.selectExpr(
        "event_id", "user_id", "unix_millis(CAST(ts AS TIMESTAMP)) AS ts_ms", f"{_K} AS k",
        f"user_id % {N_NATIONS} AS nation_key")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "CAST(n_nationkey AS BIGINT) AS nation_key", "n_name AS city", "r_name AS area")
    return clicks.join(broadcast_if_small(geo), "nation_key").selectExpr(
        "event_id", "user_id", "ts_ms",
        f"date_format(timestamp_millis(ts_ms), '{DATE_FMT}') AS date",
        "area", "city",
        f"k % {N_ADS} + 1 AS ad_id",
        f"CAST((ts_ms - pmod(ts_ms, {BATCH_MS})) / {BATCH_MS} AS BIGINT) AS batch",
    )


def load_visits(spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None) -> DataFrame:
    return visits_from_events(read_table(spark, sf_dir, "events"), start, end)


def load_ad_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad_clicks_from_events(read_table(spark, sf_dir, "events"),
                                 read_table(spark, sf_dir, "nation"),
                                 read_table(spark, sf_dir, "region"))
