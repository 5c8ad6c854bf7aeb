from pyspark.sql import functions as F

from clickpath import operators as O
from clickpath.session import new_work_dir
from clickpath.sources import format_ad_log
from clickpath.streaming import jobs as J
from clickpath.streaming.replay import replay

from conftest import rows
from test_ads import simulate_blacklist

SCHEMA = "ts_ms bigint, area string, city string, user_id bigint, ad_id bigint, batch bigint"


def _parts(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    lines = df.select("batch", format_ad_log(df).alias("value"))
    return df, [lines.where(f"batch = {b}") for b in sorted({d[5] for d in data})]


def test_stream_blacklist_equals_batch_loop(spark):
    day = 1704067200000
    data = []
    for b, (user, ad, n) in enumerate([(1, 1, 2), (1, 1, 1), (2, 1, 5), (1, 1, 4), (3, 2, 2),
                                       (3, 2, 1)]):
        data += [(day + b * 1000 + i, "AREA", "C_1", user, ad, b) for i in range(n)]
    df, parts = _parts(spark, data)
    job = J.BlacklistJob(spark, new_work_dir(spark, "t-bl") + "/job", threshold=3,
                         compact_every=2)
    got = dict(replay(spark, parts, job, new_work_dir(spark, "t-bl-in")).collect())
    want = simulate_blacklist([("2024-01-01", d[4], d[3], d[5], 0, 0) for d in data], 3)
    assert got == want == {1: 1, 2: 2, 3: 5}


def test_stream_counts_and_top3_equal_batch(spark):
    day = 1704067200000
    data = [(day + i * 7000, "A", f"C{i % 2}", i % 3, i % 4 + 1, i % 3) for i in range(30)]
    df, parts = _parts(spark, data)
    clicks = df.withColumn("date", F.lit("2024-01-01"))
    acd = O.area_city_ad_daily(clicks)
    job = J.AreaCityAdDailyJob(spark, new_work_dir(spark, "t-acd") + "/job")
    assert rows(replay(spark, parts, job, new_work_dir(spark, "t-acd-in"))) == rows(acd)
    job = J.AreaTopAdsJob(spark, new_work_dir(spark, "t-top") + "/job", compact_every=2)
    want = O.area_top_ads_json(O.area_top_ads(O.area_ad_daily(acd), 3))
    assert rows(replay(spark, parts, job, new_work_dir(spark, "t-top-in"))) == rows(want)
    job = J.ClickTrendJob(spark, new_work_dir(spark, "t-tr") + "/job")
    assert rows(replay(spark, parts, job, new_work_dir(spark, "t-tr-in"))) == rows(O.click_trend(df))


def test_stream_keeps_rejected_lines(spark):
    good = "1704067200000 A C_1 1 2"
    parts = [spark.createDataFrame([(good,), ("1704067200000 A C_1 x 2",), ("",)], "value string"),
             spark.createDataFrame([(good,), ("too short",)], "value string")]
    job = J.AreaCityAdDailyJob(spark, new_work_dir(spark, "t-rej") + "/job")
    counts = replay(spark, parts, job, new_work_dir(spark, "t-rej-in"))
    assert rows(counts) == [("2024-01-01", "A", "C_1", 2, 2)]
    assert rows(job.rejects.read(), "value", "batch_id") == [
        ("", 0), ("1704067200000 A C_1 x 2", 0), ("too short", 1)]


def test_daily_watermark_same_dates_and_drops_late_days(spark):
    day = 1704067200000 + 9 * 86400000          # 2024-01-10
    p0 = [(day + i * 1000, "A", "C", 1, 1 + i % 2, 0) for i in range(4)]
    df, parts = _parts(spark, p0)
    want = rows(O.ad_user_daily(df.withColumn("date", F.lit("2024-01-10"))))
    job = J.AdUserDailyJob(spark, new_work_dir(spark, "t-wm") + "/job", watermark="1 day")
    assert rows(replay(spark, parts, job, new_work_dir(spark, "t-wm-in"))) == want
    # a click nine days late, after the watermark moved past it, is dropped
    late = [(1704067200000, "A", "C", 1, 1, 1), (day + 5000, "A", "C", 1, 1, 1)]
    _, late_parts = _parts(spark, p0 + late)
    job = J.AreaTopAdsJob(spark, new_work_dir(spark, "t-wm2") + "/job", watermark="1 day")
    got = rows(replay(spark, late_parts, job, new_work_dir(spark, "t-wm2-in")))
    assert got == [("2024-01-10", "A", '{"1":3,"2":2}')]


def test_trend_watermark_drops_late_buckets(spark):
    t0 = 1704067200000
    data = [(t0 + 600_000 + i * 1000, "A", "C", 1, 1, 0) for i in range(3)]   # 00:10:00..02
    data += [(t0, "A", "C", 1, 1, 1), (t0 + 600_000, "A", "C", 1, 1, 1)]      # 00:00 is late
    _, parts = _parts(spark, data)
    job = J.ClickTrendJob(spark, new_work_dir(spark, "t-trw") + "/job", 20, 10,
                          watermark="1 minute")
    got = rows(replay(spark, parts, job, new_work_dir(spark, "t-trw-in")))
    b = (t0 + 600_000) // 1000
    assert got == [(b + 10, b, 4), (b + 20, b, 4)]


def test_stream_top3_and_trend_exclude_users(spark):
    t0 = 1704067200000
    data = [(t0 + i * 1000, "A", "C", i % 2, 1 + i % 3, 0) for i in range(12)]
    df, parts = _parts(spark, data)
    users = spark.createDataFrame([(1,)], "user_id bigint")
    kept = df.where("user_id <> 1").withColumn("date", F.lit("2024-01-01"))
    job = J.AreaTopAdsJob(spark, new_work_dir(spark, "t-ex") + "/job", exclude_users=users)
    want = O.area_top_ads_json(O.area_top_ads(O.area_ad_daily(O.area_city_ad_daily(kept))))
    assert rows(replay(spark, parts, job, new_work_dir(spark, "t-ex-in"))) == rows(want)
    job = J.ClickTrendJob(spark, new_work_dir(spark, "t-ex2") + "/job", exclude_users=users)
    got = rows(replay(spark, parts, job, new_work_dir(spark, "t-ex2-in")))
    assert got == rows(O.click_trend(kept))
