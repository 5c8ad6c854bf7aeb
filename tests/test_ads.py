import random

from pyspark.sql import functions as F

from clickpath import operators as O
from clickpath.sources import parse_ad_log, reject_ad_log

from conftest import rows

CLICKS = "date string, ad_id bigint, user_id bigint, batch bigint, event_id bigint, ts_ms bigint"


def test_parse_rejects_and_extra_fields(spark):
    # mf_log: 4 fields, 6 fields, bad number, two spaces, empty, trailing space
    lines = ["1704067207179 AREA CITY 7 3",
             "1704067207179 AREA CITY 7",
             "1704067207179 AREA CITY 7 3 extra",
             "1704067207179 AREA CITY x 3",
             "1704067207179  AREA CITY 7 3",
             "",
             "1704067207179 AREA CITY 7 3 "]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    good = rows(parse_ad_log(df))
    assert good == [(1704067207179, "AREA", "CITY", 7, 3, "2024-01-01")] * 3
    bad = sorted(r[0] for r in reject_ad_log(df).collect())
    assert bad == sorted([lines[1], lines[3], lines[4], lines[5]])


def test_format_parse_roundtrip(spark):
    df = spark.createDataFrame([(1704067207179, "MIDDLE EAST", "N_1", 5, 2)],
                               "ts_ms bigint, area string, city string, user_id bigint, ad_id bigint")
    back = parse_ad_log(df.select(O_format(df)))
    assert rows(back) == [(1704067207179, "MIDDLE-EAST", "N_1", 5, 2, "2024-01-01")]


def O_format(df):
    from clickpath.sources import format_ad_log
    return format_ad_log(df).alias("value")


def simulate_blacklist(clicks, threshold):
    """The reference's batch loop, step by step: filter, count, list."""
    listed, state, first = set(), {}, {}
    for b in sorted({c[3] for c in clicks}):
        batch = [c for c in clicks if c[3] == b and c[2] not in listed]
        for date, ad, user, _, _, _ in batch:
            state[(date, ad, user)] = state.get((date, ad, user), 0) + 1
        for (date, ad, user), n in state.items():
            if n >= threshold and user not in listed:
                listed.add(user)
                first[user] = b
    return first


def test_blacklist_one_pass_equals_batch_loop(spark):
    rnd = random.Random(3)
    clicks = [(f"2024-01-0{rnd.randrange(1, 3)}", rnd.randrange(1, 4), rnd.randrange(1, 9),
               rnd.randrange(0, 12), i, 0) for i in range(400)]
    df = spark.createDataFrame(clicks, CLICKS)
    for t in (2, 3, 5, 9):
        want = simulate_blacklist(clicks, t)
        got = dict(O.blacklist(df, t).collect())
        assert got == want, t


def test_threshold_edges(spark):
    # mf_threshold: T-1, T, T+1; T only by two ads together; T inside one batch
    data = []
    add = lambda user, ad, batch, n: data.extend(
        ("2024-01-01", ad, user, batch, len(data) + i, 0) for i in range(n))
    add(1, 1, 0, 2)             # T-1
    add(2, 1, 0, 3)             # T exactly
    add(3, 1, 1, 4)             # T+1, one batch
    add(4, 1, 0, 2); add(4, 2, 0, 2)  # noqa: E702  two ads, neither alone
    add(5, 1, 0, 1); add(5, 1, 2, 2); add(5, 1, 3, 5)  # noqa: E702  crosses in batch 2
    df = spark.createDataFrame(data, CLICKS)
    assert rows(O.blacklist(df, 3)) == [(2, 0), (3, 1), (5, 2)]
    already = spark.createDataFrame([(3,)], "user_id bigint")
    assert rows(O.blacklist(df, 3, listed=already)) == [(2, 0), (5, 2)]
    kept = O.clicks_kept(df, O.blacklist(df, 3))
    # user 5: batches 0 and 2 are kept (3 clicks), batch 3 is dropped
    assert kept.where(F.col("user_id") == 5).count() == 3


def test_top3_json_tie_at_third(spark):
    # mf_json: four ads, tie at third place -> smaller ad id wins
    df = spark.createDataFrame([("d", "A", 1, 5), ("d", "A", 2, 9), ("d", "A", 3, 5),
                                ("d", "A", 4, 7)], "date string, area string, ad_id bigint, n bigint")
    top = O.area_top_ads(df, 3)
    assert rows(top, "ad_id", "rk") == [(1, 3), (2, 1), (4, 2)]
    assert O.area_top_ads_json(top).first()["top3"] == '{"2":9,"4":7,"1":5}'


def test_area_rollup_keeps_totals_and_underscores(spark):
    # Q14: city/area names with '_' stay intact as separate columns
    clicks = spark.createDataFrame(
        [("d", "A_1", "C_1", 1), ("d", "A_1", "C_2", 1), ("d", "A_1", "C_2", 2)],
        "date string, area string, city string, ad_id bigint")
    acd = O.area_city_ad_daily(clicks)
    assert rows(O.area_ad_daily(acd)) == [("d", "A_1", 1, 2), ("d", "A_1", 2, 1)]


def test_trend_windows(spark):
    df = spark.createDataFrame([(1000,), (9999,), (10000,)], "ts_ms bigint")
    got = rows(O.click_trend(df, 20, 10))
    assert got == [(10, 0, 2), (20, 0, 2), (20, 10, 1), (30, 10, 1)]
    ordered = [tuple(r) for r in O.click_trend(df, 20, 10, ordered=True).collect()]
    assert ordered == [(10, 0, 2), (20, 0, 2), (20, 10, 1), (30, 10, 1)]


def test_user_with_a_third_of_all_clicks(spark):
    # real rows (sf0.001 events); every third click is moved to one user
    import os
    from clickpath.sources import load_ad_clicks
    sf = "/root/testdata/sf0.001"
    if not os.path.exists(sf):
        return
    clicks = load_ad_clicks(spark, sf).withColumn(
        "user_id", F.when(F.pmod("event_id", F.lit(3)) == 0, F.lit(0).cast("bigint"))
        .otherwise(F.col("user_id")))
    local = [(r["date"], r["ad_id"], r["user_id"], r["batch"], r["event_id"], 0)
             for r in clicks.collect()]
    for t in (3, 30):
        want = simulate_blacklist(local, t)
        listed = O.blacklist(clicks, t)
        assert dict(listed.collect()) == want
        kept = O.clicks_kept(clicks, listed).count()
        assert kept == sum(1 for c in local if c[2] not in want or c[3] <= want[c[2]])
