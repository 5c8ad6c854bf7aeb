"""Ad-click reports, batch form.

A9 daily (area, city, ad) counts, F10/A10 re-aggregation to (area, ad), W2/X11
top-3 ads per area, A11 daily (ad, user) counts, F7/T8 blacklist (one pass, see
``blacklist``), J2 kept clicks, A12/T4 trend of the last minute.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickpath.functions import floor_div, ranked_map_json
from clickpath.operators import sketch
from clickpath.operators.topk import top_k_per_group

# Fixed values (the reference's defaults): blacklist threshold of 100 clicks per
# (date, ad, user); trend window 60 s sliding by 10 s over 10 s buckets; top 3 ads.
DEFAULT_THRESHOLD = 100
TREND_WINDOW_S = 60
TREND_SLIDE_S = 10
TOP_ADS = 3


def exclude(clicks: DataFrame, users: DataFrame | None) -> DataFrame:
    """Drop clicks of listed users (J2, static form). The list is not size-bounded,
    so the join is left to the planner (AQE broadcasts it when it is small)."""
    if users is None:
        return clicks
    return clicks.join(users.select("user_id").distinct(), "user_id", "left_anti")


def area_city_ad_daily(clicks: DataFrame, exclude_users: DataFrame | None = None) -> DataFrame:
    """(date, area, city, ad_id, n)."""
    return (exclude(clicks, exclude_users).groupBy("date", "area", "city", "ad_id")
            .agg(F.count(F.lit(1)).alias("n")))


def area_rollup(clicks: DataFrame, exclude_users: DataFrame | None = None) -> DataFrame:
    """(date, area, city, ad_id, all_cities, n): the rows of R5 and, with a null city and
    ``all_cities`` true, those that R6 ranks (A9, F10, A10), from one pass.

    Grouping sets: clicks are read once, both levels are counted per task, and one
    shuffle brings the counts together.
    """
    keys = ["date", "area", "city", "ad_id"]
    totals = [k for k in keys if k != "city"]
    return (exclude(clicks, exclude_users).groupingSets([keys, totals], *keys)
            .agg((F.grouping("city") == 1).alias("all_cities"), F.count(F.lit(1)).alias("n"))
            .select(*keys, "all_cities", "n"))


def area_ad_daily(daily: DataFrame) -> DataFrame:
    """(date, area, ad_id, n) from the per-city counts: city dropped from the key."""
    return (daily.groupBy("date", "area", "ad_id")
            .agg(F.sum("n").cast("bigint").alias("n")))


def area_top_ads(area_ad: DataFrame, k: int = TOP_ADS) -> DataFrame:
    """(date, area, ad_id, n, rk): top-k ads per (date, area) by n, ties by ad id."""
    return top_k_per_group(area_ad, ["date", "area"], [F.desc("n"), F.asc("ad_id")], k, "rk")


def area_top_ads_json(top: DataFrame) -> DataFrame:
    """(date, area, top3): ``{"ad": n, ...}`` with keys in rank order (X11).

    The collected group is the top-k rows of one (date, area): at most k entries.
    """
    return (top.groupBy("date", "area")
            .agg(ranked_map_json(F.collect_list(F.struct("rk", "ad_id", "n")), "rk", "ad_id", "n")
                 .alias("top3")))


def ad_user_daily(clicks: DataFrame) -> DataFrame:
    """(date, ad_id, user_id, n)."""
    return clicks.groupBy("date", "ad_id", "user_id").agg(F.count(F.lit(1)).alias("n"))


def blacklist(clicks: DataFrame, threshold: int = DEFAULT_THRESHOLD,
              batch_col: str = "batch", listed: DataFrame | None = None) -> DataFrame:
    """(user_id, first_batch): users whose (date, ad) count reached ``threshold``.

    Batch form of the per-batch feedback loop (T8): a user's clicks are dropped
    only from the batch after the first crossing, so the dropping cannot move
    that crossing. The crossing is therefore the first batch where the running
    count of some (date, ad, user) reaches the threshold. Users already on a
    list (``listed``, e.g. from an earlier run) are dropped first and not
    listed again.

    Counts are pre-aggregated per (date, ad, user, batch) before the running
    sum, so a hot key contributes one row per batch, not one per click.
    """
    clicks = exclude(clicks, listed)
    per_batch = (clicks.groupBy("date", "ad_id", "user_id", F.col(batch_col).alias("batch"))
                 .agg(F.count(F.lit(1)).alias("c")))
    w = (Window.partitionBy("date", "ad_id", "user_id").orderBy("batch")
         .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    running = per_batch.withColumn("running", F.sum("c").over(w))
    return (running.where(F.col("running") >= F.lit(threshold))
            .groupBy("user_id").agg(F.min("batch").cast("bigint").alias("first_batch")))


def clicks_kept(clicks: DataFrame, listed: DataFrame, batch_col: str = "batch",
                sketch_words: int | None = None) -> DataFrame:
    """Clicks that pass the blacklist filter: the user is unlisted, or the click's
    batch is not after the user's listing batch (J2).

    With ``sketch_words`` a sketch of the list of that size is asked first
    (``operators.sketch``, whose ``words_for`` gives the size for a number of users): clicks
    it rules out pass where they are, and only the others are shuffled to meet the list.
    ``listed`` is then read twice and should be stored.
    """
    fb = F.col("first_batch")

    def verified(rows: DataFrame) -> DataFrame:
        return (rows.join(listed.select("user_id", "first_batch"), "user_id", "left")
                .where(fb.isNull() | (F.col(batch_col) <= fb)).select(*clicks.columns))

    if not sketch_words:
        return verified(clicks)
    bits = sketch.packed(sketch.build(listed, "user_id", sketch_words), sketch_words)
    maybe = sketch.might_hold(F.col("user_id"), bits, sketch_words)
    return clicks.where(~maybe).unionByName(verified(clicks.where(maybe)))


def click_trend(clicks: DataFrame, window_s: int = TREND_WINDOW_S,
                slide_s: int = TREND_SLIDE_S, exclude_users: DataFrame | None = None,
                ordered: bool = False) -> DataFrame:
    """(window_end, bucket, n): clicks per ``slide_s`` bucket in every sliding window.

    Epoch seconds. A bucket lies in the ``window_s / slide_s`` windows that end
    ``slide_s .. window_s`` seconds after its start. Counting per bucket first and
    then fanning out the aggregate rows costs far less than expanding every click
    into all its windows.
    """
    per_bucket = (exclude(clicks, exclude_users)
                  .select((floor_div(F.col("ts_ms"), 1000 * slide_s) * slide_s)
                                .alias("bucket"))
                  .groupBy("bucket").agg(F.count(F.lit(1)).alias("n")))
    return trend_windows(per_bucket, window_s, slide_s, ordered)


def trend_windows(bucket_counts: DataFrame, window_s: int = TREND_WINDOW_S,
                  slide_s: int = TREND_SLIDE_S, ordered: bool = False) -> DataFrame:
    """Fan ``(bucket, n)`` counts (bucket = epoch seconds, multiple of ``slide_s``)
    out to ``(window_end, bucket, n)`` for every sliding window holding the bucket.

    ``ordered`` sorts by window, then bucket ascending (O2, as the reference
    prints each window); the sort is over aggregated rows only.
    """
    if window_s % slide_s:
        raise ValueError("window must be a multiple of the slide")
    steps = F.sequence(F.lit(1), F.lit(window_s // slide_s))
    out = (bucket_counts.select("bucket", "n", F.explode(steps).alias("_i"))
           .select((F.col("bucket") + F.col("_i") * slide_s).cast("bigint").alias("window_end"),
                   F.col("bucket").cast("bigint").alias("bucket"), "n"))
    return out.orderBy("window_end", "bucket") if ordered else out
