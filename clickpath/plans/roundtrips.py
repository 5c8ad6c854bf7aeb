"""Sink round trips: write a report through a sink (with a replayed batch), read it back.

Each must equal the report it stores, which the SQL oracle checks. Scratch data
goes under the session's shared checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from clickpath import operators as O
from clickpath.functions import floor_div
from clickpath.plans.catalog import _clicks, _lines, _visits
from clickpath.plans.params import PARAMS
from clickpath.session import new_work_dir
from clickpath.sinks import IncrementLog, ReplaceLog, SetLog, overwrite_table, publish, read_published, write_bucketed
from clickpath.sources import parse_ad_log, publish_lines


def table_overwrite_roundtrip(spark, d):
    """Save the visits as a table twice (the second replaces the first), read it."""
    work = new_work_dir(spark, "table")
    name = f"clickpath_visits_{uuid.uuid4().hex[:8]}"
    visits = _visits(spark, d)
    overwrite_table(visits, name, path=f"{work}/{name}", partition_by=["date"])
    overwrite_table(visits, name, path=f"{work}/{name}", partition_by=["date"])
    return spark.table(name).select(*visits.columns)


def table_atomic_replace(spark, d):
    """A reader opened before a replacement sees the rows of before, one opened after it the new ones."""
    path = new_work_dir(spark, "published") + "/visits"
    visits = _visits(spark, d)
    publish(visits.where("page_id <= 5"), path, partition_by=["date"])
    before = read_published(spark, path)
    publish(visits, path, partition_by=["date"])
    after = read_published(spark, path)
    by_day = [df.groupBy(F.col("date").cast("string").alias("date")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("reader"), "date", "n")
              for name, df in (("before", before), ("after", after))]
    return by_day[0].union(by_day[1])


def page_flow_bucketed(spark, d):
    """R3 over visits stored in buckets of sessions: no shuffle of visit rows."""
    name = f"clickpath_bucketed_{uuid.uuid4().hex[:8]}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    write_bucketed(_visits(spark, d), name, "session_id", ["action_time"], buckets, path=f"{new_work_dir(spark, 'bucketed')}/{name}")
    return O.page_flow_conversion(spark.table(name), PARAMS["flow"])


def ad_log_publish_roundtrip(spark, d):
    """S7 + S4 + S5: publish log lines as text files, read them back, parse."""
    work = new_work_dir(spark, "publish")
    publish_lines(_lines(spark, d), f"{work}/lines")
    return parse_ad_log(spark.read.text(f"{work}/lines"))


def sink_set_add(spark, d):
    """Add the blacklisted users in two batches, replay the first; read members."""
    work = new_work_dir(spark, "setlog")
    log = SetLog(spark, f"{work}/listed", "user_id bigint")
    listed = O.blacklist(_clicks(spark, d), PARAMS["threshold"])
    log.write(listed, 0)
    log.write(listed, 1)      # adding members again changes nothing
    log.write(listed, 0)      # replay of batch 0
    return log.members()


def sink_hash_increment(spark, d):
    """Per-batch count deltas (one batch per staged file span), all batches
    written in one job, then written again as a replay; read sums."""
    work = new_work_dir(spark, "inclog")
    keys = ["date", "area", "city", "ad_id"]
    log = IncrementLog(spark, f"{work}/acd",
                       "date string, area string, city string, ad_id bigint, n bigint", keys, "n")
    clicks = _clicks(spark, d).withColumn(
        "file_batch", floor_div(F.col("ts_ms"), PARAMS["stream_file_ms"]))
    deltas = clicks.groupBy("file_batch", *keys).agg(F.count(F.lit(1)).alias("n"))
    log.write_many(deltas, "file_batch")
    log.write_many(deltas, "file_batch")   # replay of every batch
    return log.totals()


def sink_hash_set(spark, d):
    """Write an older value (top-2) as batch 0, the top-3 as batch 1, then
    replay batch 0; the latest batch per key must win."""
    work = new_work_dir(spark, "replog")
    log = ReplaceLog(spark, f"{work}/top3", "date string, area string, top3 string",
                     ["date", "area"])
    area_ad = O.area_ad_daily(O.area_city_ad_daily(_clicks(spark, d)))
    older = O.area_top_ads_json(O.area_top_ads(area_ad, 2))
    current = O.area_top_ads_json(O.area_top_ads(area_ad, 3))
    log.write(older, 0)
    log.write(current, 1)
    log.write(older, 0)
    return log.latest()


ROUNDTRIP_QUERIES = {
    "table_overwrite_roundtrip": table_overwrite_roundtrip,
    "table_atomic_replace": table_atomic_replace,
    "page_flow_bucketed": page_flow_bucketed,
    "ad_log_publish_roundtrip": ad_log_publish_roundtrip,
    "sink_set_add": sink_set_add,
    "sink_hash_increment": sink_hash_increment,
    "sink_hash_set": sink_hash_set,
}
