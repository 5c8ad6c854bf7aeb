"""What lets jobs run for long: sealed logs, bucketed lookups, the arrival ring, one fate for both queries."""
import collections

import pytest
from pyspark.sql import functions as F

from clickpath import operators as O
from clickpath.session import new_work_dir
from clickpath.sinks import IncrementLog, LineLog, ReplaceLog, SetLog, numbered_dirs
from clickpath.sources import format_ad_log
from clickpath.streaming import jobs as J
from clickpath.streaming.replay import replay

from conftest import rows

CLICKS = "ts_ms bigint, area string, city string, user_id bigint, ad_id bigint, batch bigint"
T0 = 1704067200000


def _parts(spark, data):
    df = spark.createDataFrame(data, CLICKS)
    lines = df.select("batch", format_ad_log(df).alias("value"))
    return [lines.where(f"batch = {b}") for b in sorted({d[5] for d in data})]


def test_three_hundred_batches_keep_few_folders(spark):
    log = IncrementLog(spark, new_work_dir(spark, "t-seal") + "/log", "k string, n bigint", ["k"], "n")
    one = {k: spark.createDataFrame([(k, 1)], "k string, n bigint").coalesce(1) for k in "abc"}
    total, most = collections.Counter(), 0
    for b in range(300):
        k = "abc"[b % 3]
        log.write(one[k], b)
        total[k] += 1
        if (b + 1) % 25 == 0:
            log.compact(b)
            most = max(most, len(numbered_dirs(spark, log.path, "g")), len(numbered_dirs(spark, log.snapshot_dir, "upto=")))
    assert most <= 3 and dict(rows(log.totals())) == dict(total)
    # The newest batch is replayed, snapshot and all, and nothing changes.
    log.write(one["c"], 299)
    log.compact(299)
    assert dict(rows(log.totals())) == dict(total) and dict(rows(log.totals(before=299))) == dict(total - collections.Counter("c"))
    with pytest.raises(ValueError, match="sealed"):
        log.totals(before=20)
    # A job that starts again sees the same.
    again = IncrementLog(spark, log.path, "k string, n bigint", ["k"], "n")
    assert dict(rows(again.totals())) == dict(total)
    with pytest.raises(ValueError, match="sealed"):
        again.totals(before=20)


def test_line_log_keeps_repeats(spark):
    log = LineLog(spark, new_work_dir(spark, "t-lines") + "/log", "value string")
    for b in range(4):
        log.write(spark.createDataFrame([("x",), ("x",)], "value string"), b)
    log.compact(3)
    assert log.read().count() == 8


@pytest.mark.parametrize("kind", [ReplaceLog, IncrementLog])
def test_a_lookup_opens_the_buckets_of_its_keys(spark, kind):
    schema, path = "k bigint, n bigint", new_work_dir(spark, "t-buckets") + "/log"
    log = kind(spark, path, schema, ["k"], *(["n"] if kind is IncrementLog else []), buckets=8)
    for b in range(3):
        log.write(spark.range(200).select(F.col("id").alias("k"), F.lit(b + 1).cast("bigint").alias("n")), b)
        if b == 1:
            log.compact(b)
    only = spark.createDataFrame([(7,), (9,)], "k bigint")
    found = log.latest(only=only) if kind is ReplaceLog else log.totals(only=only)
    n = 3 if kind is ReplaceLog else 6
    assert rows(found, "k", "n") == [(7, n), (9, n)]
    wanted = sorted(r[0] for r in only.select(log._bucket()).distinct().collect())
    plan = log.lookup(only, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert len(wanted) < 8 and plan.count("PartitionFilters") == 2   # the snapshot and the batches since
    for scan in plan.split("PartitionFilters: [")[1:]:
        inside = scan[:scan.index("]")]
        assert all(str(w) in inside for w in wanted) and "_bucket" in inside


def test_bucketed_set_log_members(spark):
    log = SetLog(spark, new_work_dir(spark, "t-set") + "/log", "user_id bigint", 4, ["user_id"])
    for b in range(2):
        log.write(spark.range(10).select(F.col("id").alias("user_id")), b)
    assert rows(log.members(), "user_id") == [(k,) for k in range(10)]


def test_trend_by_arrival_equals_the_clicks_of_the_window(spark):
    # Seconds of arrival of each batch, with two in one slot, a gap longer than the window, and a clock that goes back.
    arrivals = [3, 8, 12, 35, 36, 61, 62, 300, 290, 331]
    data = [(T0 + (b * 7 + i * 13 % 50) * 1000, "A", "C", i % 3, 1, b) for b in range(len(arrivals)) for i in range(5)]
    job = J.ArrivalTrendJob(spark, new_work_dir(spark, "t-arr") + "/job", arrival=lambda b: arrivals[b], compact_every=3)
    got = rows(replay(spark, _parts(spark, data), job, new_work_dir(spark, "t-arr-in")))
    slots = []
    for a in arrivals:
        slots.append(max([a // 10, *slots[-1:]]))
    want = collections.Counter()
    for s in set(slots):
        for ts, *_, b in data:
            if s - 6 < slots[b] <= s:
                want[(s + 1) * 10, ts // 10000 * 10] += 1
    assert got == sorted((*k, n) for k, n in want.items())
    kept = numbered_dirs(spark, f"{job.out_dir}/slots", "slot=")
    assert kept and min(kept) > slots[-2] - 6 and len(numbered_dirs(spark, f"{job.out_dir}/windows", "batch_id=")) == 2


def test_arrival_window_is_the_same_after_a_replay(spark):
    seconds = iter([0, 25, 50, 75, 10 ** 6])
    job = J.ArrivalTrendJob(spark, new_work_dir(spark, "t-arr2") + "/job", arrival=lambda _: next(seconds))
    batches = [spark.createDataFrame([(f"{T0 + b * 1000} A C 1 2",)] * (b + 1), "value string") for b in range(4)]
    for b, batch in enumerate(batches):
        job.process(batch, b)
    before = rows(job.result())
    job.process(batches[3], 3)   # its slot is stored, the clock is not asked again
    assert rows(job.result()) == before


def test_a_failing_reject_write_stops_the_job(spark):
    class Broken(LineLog):
        def write(self, df, batch_id):
            raise OSError("no space left for rejects")

    good = "1704067200000 A C_1 1 2"
    parts = [spark.createDataFrame([(good,), ("bad",)], "value string")] * 2
    job = J.ClickTrendJob(spark, new_work_dir(spark, "t-fate") + "/job")
    job.rejects = Broken(spark, f"{job.out_dir}/rejects", "value string")
    with pytest.raises(RuntimeError, match="no space left"):
        replay(spark, parts, job, new_work_dir(spark, "t-fate-in"))
    assert not job.query.isActive and not job.reject_query.isActive


def test_blacklist_lists_a_user_once_and_reads_only_the_list(spark):
    data = [(T0 + b * 1000 + i, "A", "C", user, ad, b) for b, (user, ad, n) in enumerate(
        [(1, 1, 2), (1, 1, 2), (1, 2, 9), (2, 1, 3), (1, 1, 5)]) for i in range(n)]
    job = J.BlacklistJob(spark, new_work_dir(spark, "t-once") + "/job", threshold=3)
    got = rows(replay(spark, _parts(spark, data), job, new_work_dir(spark, "t-once-in")))
    assert got == [(1, 1), (2, 3)]
    assert rows(job.listed.read(), "user_id", "listed_batch") == [(1, 1), (2, 3)]   # not listed again by batches 2 and 4
    assert not hasattr(job, "counts")


@pytest.mark.parametrize("make", [J.AreaCityAdDailyJob, J.AreaTopAdsJob, J.ClickTrendJob])
def test_a_list_that_grows_while_the_job_runs(spark, make):
    data = [(T0 + (b * 11 + i) * 1000, "A", f"C{i % 2}", user, 1 + i % 3, b) for b in range(5) for i in range(6) for user in range(4)]
    first = {0: 1, 2: 3, 3: 0}   # user: the batch that lists them
    listing = J.BlacklistJob(spark, new_work_dir(spark, "t-grow-list") + "/job")
    parts = _parts(spark, data + [(T0, "A", "C0", 9, 1, 5)])
    bad = spark.createDataFrame([("bad line",)], "value string")
    job = make(spark, new_work_dir(spark, "t-grow") + "/job", exclude_users=listing.listed_before, compact_every=2)
    for b, part in enumerate(parts):   # in step: each batch of the job, then that of the list
        lines = part.select("value").union(bad)
        job.process(lines, b)
        if b in (1, 4):
            job.process(lines, b)   # a replay, once with the batch's snapshot written
        now = [(u, b) for u, at in first.items() if at == b]
        listing.listed.write(spark.createDataFrame(now, "user_id bigint, listed_batch bigint"), b)
    kept = [d for d in data if d[5] <= first.get(d[3], 99)] + [(T0, "A", "C0", 9, 1, 5)]
    clicks = spark.createDataFrame(kept, CLICKS).withColumn("date", F.lit("2024-01-01"))
    daily = O.area_city_ad_daily(clicks)
    want = {J.AreaCityAdDailyJob: daily, J.ClickTrendJob: O.click_trend(clicks),
            J.AreaTopAdsJob: O.area_top_ads_json(O.area_top_ads(O.area_ad_daily(daily)))}[make]
    assert len(kept) < len(data) and rows(job.result()) == rows(want)
    assert job.rejects.read().count() == len(parts)


def test_a_list_asked_in_each_batch_runs_as_one_query(spark):
    data = [(T0 + b * 1000 + i, "A", "C", i % 3, 1, b) for b in range(2) for i in range(6)]
    users = lambda clicks, batch_id: clicks.select("user_id").where(F.col("user_id") < batch_id)
    job = J.AreaTopAdsJob(spark, new_work_dir(spark, "t-ask") + "/job", exclude_users=users)
    got = rows(replay(spark, _parts(spark, data), job, new_work_dir(spark, "t-ask-in")))
    assert got == [("2024-01-01", "A", '{"1":10}')] and job.reject_query is None
    with pytest.raises(ValueError, match="watermark"):
        J.ClickTrendJob(spark, new_work_dir(spark, "t-ask2") + "/job", exclude_users=users, watermark="1 minute")
