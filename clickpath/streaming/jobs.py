"""Structured Streaming forms of the ad reports (R4-R7) and the word count.

Each job takes a streaming DataFrame of log lines (``value``), owns one
checkpoint folder and its sink logs under ``out_dir``, and offers ``result()``,
a batch DataFrame over its sinks. Sinks are the keyed logs of
``clickpath.sinks``, written per ``batch_id``: a batch replayed after a failure
overwrites itself, so results stay exact under task and driver restarts.

Every log, that of the rejected lines too, is compacted each ``compact_every``
batches, so a job that runs for months lists and reads a bounded number of folders.

A job's ``exclude_users`` is either a DataFrame, the same for all batches, or a function
``(clicks, batch_id) -> users`` that is asked in each batch, so that the list may grow while
the job runs (``BlacklistJob.listed_before`` is one). A replayed batch asks again and
replaces all that it wrote.

The reference's 5-second micro-batch is ``trigger(processingTime="5 seconds")``;
tests use ``availableNow``.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickpath import operators as O
from clickpath.functions import floor_div
from clickpath.session import remove_dir
from clickpath.sinks import IncrementLog, KeyedLog, LineLog, ReplaceLog, SetLog, mkdirs, numbered_dirs
from clickpath.sources import parse_ad_log, reject_ad_log

FIVE_SECONDS = {"processingTime": "5 seconds"}

# Batches between two snapshots of a job's logs, and buckets of a log that is looked up by key.
COMPACT_EVERY = 100
LOOKUP_BUCKETS = 16

Exclusions = DataFrame | Callable[[DataFrame, int], DataFrame]


class _Job:
    output_mode = "append"

    def __init__(self, spark: SparkSession, out_dir: str, compact_every: int | None = COMPACT_EVERY):
        self.spark = spark
        self.out_dir = out_dir.rstrip("/")
        self.checkpoint = f"{self.out_dir}/_checkpoint"
        self.compact_every = compact_every

    def _maybe_compact(self, batch_id: int, *logs) -> None:
        """Snapshot the logs every ``compact_every`` batches, so the per-batch
        reads of a long-running job cover at most that many batch partitions."""
        logs = [log for log in logs if log is not None]
        if self.compact_every and (int(batch_id) + 1) % self.compact_every == 0:
            for log in logs:
                log.compact(batch_id)

    def _rejects(self) -> KeyedLog:
        """Dead-letter log of lines the parser could not use, per batch (Q18)."""
        return LineLog(self.spark, f"{self.out_dir}/rejects", "value string")

    def _parse(self, batch: DataFrame, batch_id: int, rejects: KeyedLog | None) -> DataFrame:
        if rejects is not None:
            rejects.write(reject_ad_log(batch), batch_id)
        return parse_ad_log(batch)

    exclude_users: Exclusions | None = None

    def _kept(self, clicks: DataFrame, batch_id: int) -> DataFrame:
        """A batch's clicks without those of the users who are listed now."""
        users = self.exclude_users
        return O.exclude(clicks, users(clicks, batch_id) if callable(users) else users)

    def _add(self, log: IncrementLog, count: Callable[[DataFrame], DataFrame], batch: DataFrame, batch_id: int) -> None:
        """Write a batch's rejects, and the counts of its kept clicks, from one copy of its lines."""
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)   # read by both writes, and to look up its users
        try:
            clicks = self._parse(batch, batch_id, self.rejects)
            log.write(count(self._kept(clicks, batch_id)), batch_id)
        finally:
            batch.unpersist()

    def _ask_in_each_batch(self, watermark: str | None) -> bool:
        """Whether clicks can be counted only inside a batch, since its list isn't known before."""
        if not callable(self.exclude_users):
            return False
        if watermark:
            raise ValueError("a watermark needs counts in the state store, so a list that is fixed at the start")
        self.rejects_apart = False
        return True

    def plan(self, lines: DataFrame) -> DataFrame:
        """The streaming part before the per-batch sink."""
        return lines

    # Jobs that count in the streaming plan cannot reach the raw lines in their
    # batches: a second query over the same source keeps what the parser drops.
    # Neither runs on without the other: a batch fails when the other query has.
    rejects: KeyedLog | None = None
    rejects_apart = False
    query: StreamingQuery | None = None
    reject_query: StreamingQuery | None = None

    def _keep_rejects(self, batch: DataFrame, batch_id: int) -> None:
        self._stop_with(self.query)
        self.rejects.write(reject_ad_log(batch), batch_id)
        self._maybe_compact(batch_id, self.rejects)

    def _process(self, batch: DataFrame, batch_id: int) -> None:
        self._stop_with(self.reject_query)
        self.process(batch, batch_id)

    @staticmethod
    def _stop_with(other: StreamingQuery | None) -> None:
        if other is not None and other.exception() is not None:
            raise RuntimeError(f"the job's other query failed: {other.exception()}")

    def process(self, batch: DataFrame, batch_id: int) -> None:
        raise NotImplementedError

    def start(self, lines: DataFrame, trigger: dict | None = None,
              name: str | None = None) -> StreamingQuery:
        self.query = self.reject_query = None
        writer = (self.plan(lines).writeStream.foreachBatch(self._process)
                  .outputMode(self.output_mode)
                  .option("checkpointLocation", self.checkpoint)
                  .trigger(**(trigger or FIVE_SECONDS)))
        if name:
            writer = writer.queryName(name)
        if self.rejects_apart and self.rejects is not None:
            self.reject_query = (lines.writeStream.foreachBatch(self._keep_rejects)
                                 .option("checkpointLocation", f"{self.checkpoint}_rejects")
                                 .trigger(**(trigger or FIVE_SECONDS)).start())
        self.query = writer.start()
        return self.query

    def await_all(self, query: StreamingQuery) -> None:
        """Wait for the job's query and, if it has one, the query of its rejects. If one
        fails, the other is stopped and the failure is raised."""
        queries = [q for q in (query, self.reject_query) if q is not None]
        while any(q.isActive for q in queries) and not any(q.exception() for q in queries):
            next(q for q in queries if q.isActive).awaitTermination(1)
        for q in queries:
            if q.exception() is not None:
                for other in queries:
                    other.stop()
                raise q.exception()


def daily(clicks: DataFrame, watermark: str | None) -> tuple[DataFrame, F.Column]:
    """The day key of parsed clicks: the ``date`` string, or with a ``watermark``
    a one-day event-time ``window`` (UTC days, the same dates) so that the state
    of days older than the watermark is dropped and later events are ignored.
    The reference keeps every day forever; that is the default here too."""
    if not watermark:
        return clicks, F.col("date")
    clicks = (clicks.withColumn("_ts", F.timestamp_millis(F.col("ts_ms")))
              .withWatermark("_ts", watermark))
    return clicks, F.window("_ts", "1 day").alias("_day")


def day_string(df: DataFrame, watermark: str | None) -> DataFrame:
    """Turn the ``_day`` window back into the ``date`` string column."""
    if not watermark:
        return df
    return df.withColumn("date", F.date_format(F.col("_day.start"), "yyyy-MM-dd")).drop("_day")


class AreaCityAdDailyJob(_Job):
    """Per-batch counts (T3) added into a counter log (S13, ``HINCRBY``)."""

    KEYS = ["date", "area", "city", "ad_id"]

    def __init__(self, spark, out_dir, exclude_users: Exclusions | None = None,
                 keep_rejects: bool = True, compact_every: int | None = COMPACT_EVERY):
        super().__init__(spark, out_dir, compact_every)
        self.exclude_users = exclude_users
        self.counts = IncrementLog(
            spark, f"{self.out_dir}/counts",
            "date string, area string, city string, ad_id bigint, n bigint", self.KEYS, "n")
        self.rejects = self._rejects() if keep_rejects else None

    def process(self, batch, batch_id):
        self._add(self.counts, O.area_city_ad_daily, batch, batch_id)
        self._maybe_compact(batch_id, self.counts, self.rejects)

    def result(self) -> DataFrame:
        return self.counts.totals()


class AdUserDailyJob(_Job):
    """Running count per (date, ad, user) in the state store; each batch's
    updated counts replace the stored ones (S14). ``watermark`` bounds the state
    (see ``daily``)."""

    output_mode = "update"
    rejects_apart = True

    def __init__(self, spark, out_dir, watermark: str | None = None, keep_rejects: bool = True,
                 compact_every: int | None = COMPACT_EVERY):
        super().__init__(spark, out_dir, compact_every)
        self.watermark = watermark
        self.rejects = self._rejects() if keep_rejects else None
        self.counts = ReplaceLog(spark, f"{self.out_dir}/counts",
                                 "date string, ad_id bigint, user_id bigint, n bigint",
                                 ["date", "ad_id", "user_id"])

    def plan(self, lines):
        clicks, day = daily(parse_ad_log(lines), self.watermark)
        counts = clicks.groupBy(day, "ad_id", "user_id").agg(F.count(F.lit(1)).alias("n"))
        return day_string(counts, self.watermark)

    def process(self, batch, batch_id):
        self.counts.write(batch, batch_id)
        self._maybe_compact(batch_id, self.counts)

    def result(self) -> DataFrame:
        return self.counts.latest()


class AreaTopAdsJob(_Job):
    """Running count per (date, area, ad) in the state store; after each
    batch the touched (date, area) groups are re-ranked and their top-k JSON
    replaces the stored one (S14, ``HSET``).

    Counting straight at (date, area, ad) equals the reference's per-city state
    re-summed without the city (A9 + F10 + A10), with less state. Ranking runs
    in ``foreachBatch`` because a stream cannot be ranked directly. The counts are
    stored in buckets of (date, area), so a batch opens those of its groups only.
    ``watermark`` bounds the state (see ``daily``).

    With a list that is asked in each batch, clicks are counted inside the batch and
    added into a counter log of the same buckets instead (S13).
    """

    output_mode = "update"
    rejects_apart = True

    def __init__(self, spark, out_dir, k: int = O.ads.TOP_ADS, compact_every: int | None = COMPACT_EVERY,
                 watermark: str | None = None, exclude_users: Exclusions | None = None,
                 keep_rejects: bool = True):
        super().__init__(spark, out_dir, compact_every)
        self.rejects = self._rejects() if keep_rejects else None
        self.k, self.watermark, self.exclude_users = k, watermark, exclude_users
        self.asks = self._ask_in_each_batch(watermark)
        schema, keys = "date string, area string, ad_id bigint, n bigint", ["date", "area", "ad_id"]
        buckets = {"buckets": LOOKUP_BUCKETS, "bucket_keys": ["date", "area"]}
        self.counts = (IncrementLog(spark, f"{self.out_dir}/added", schema, keys, "n", **buckets) if self.asks
                       else ReplaceLog(spark, f"{self.out_dir}/counts", schema, keys, **buckets))
        self.top = ReplaceLog(spark, f"{self.out_dir}/top",
                              "date string, area string, top3 string", ["date", "area"])

    def plan(self, lines):
        if self.asks:
            return lines
        parsed = O.exclude(parse_ad_log(lines), self.exclude_users)   # stream-static anti join
        clicks, day = daily(parsed, self.watermark)
        return day_string(self._count(clicks, day), self.watermark)

    @staticmethod
    def _count(clicks, day="date"):
        return clicks.groupBy(day, "area", "ad_id").agg(F.count(F.lit(1)).alias("n"))

    def process(self, batch, batch_id):
        if self.asks:
            self._add(self.counts, self._count, batch, batch_id)
        else:
            self.counts.write(batch, batch_id)
        touched = self.counts.read_batch(batch_id).select("date", "area")
        current = self.counts.totals(only=touched) if self.asks else self.counts.latest(only=touched)
        self.top.write(O.area_top_ads_json(O.area_top_ads(current, self.k)), batch_id)
        self._maybe_compact(batch_id, self.counts, self.top, self.rejects if self.asks else None)

    def result(self) -> DataFrame:
        return self.top.latest()


class ClickTrendJob(_Job):
    """Clicks per 10-second event-time bucket (a tumbling ``window``) kept in
    the state store; the 60 s / 10 s sliding view is fanned out on read.

    ``watermark`` (e.g. ``"2 minutes"``) bounds the state and drops later events;
    the default keeps every bucket, like the reference, which has no watermark.
    With a list that is asked in each batch, clicks are counted inside the batch and
    added into a counter log instead (S13).
    """

    output_mode = "update"
    rejects_apart = True

    def __init__(self, spark, out_dir, window_s: int = O.ads.TREND_WINDOW_S,
                 slide_s: int = O.ads.TREND_SLIDE_S, watermark: str | None = None,
                 exclude_users: Exclusions | None = None, keep_rejects: bool = True,
                 compact_every: int | None = COMPACT_EVERY):
        super().__init__(spark, out_dir, compact_every)
        self.rejects = self._rejects() if keep_rejects else None
        self.window_s, self.slide_s, self.watermark = window_s, slide_s, watermark
        self.exclude_users = exclude_users
        self.asks = self._ask_in_each_batch(watermark)
        schema, keys = "bucket bigint, n bigint", ["bucket"]
        self.buckets = (IncrementLog(spark, f"{self.out_dir}/added", schema, keys, "n") if self.asks
                        else ReplaceLog(spark, f"{self.out_dir}/buckets", schema, keys))

    def plan(self, lines):
        if self.asks:
            return lines
        clicks = (O.exclude(parse_ad_log(lines), self.exclude_users)   # stream-static anti join
                  .withColumn("ts", F.timestamp_millis(F.col("ts_ms"))))
        if self.watermark:
            clicks = clicks.withWatermark("ts", self.watermark)
        return (clicks.groupBy(F.window("ts", f"{self.slide_s} seconds").alias("w"))
                .agg(F.count(F.lit(1)).alias("n"))
                .select(F.unix_seconds(F.col("w.start")).alias("bucket"), "n"))

    def _count(self, clicks):
        bucket = floor_div(F.col("ts_ms"), 1000 * self.slide_s) * self.slide_s
        return clicks.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))

    def process(self, batch, batch_id):
        if self.asks:
            self._add(self.buckets, self._count, batch, batch_id)
        else:
            self.buckets.write(batch, batch_id)
        self._maybe_compact(batch_id, self.buckets, self.rejects if self.asks else None)

    def _counts(self) -> DataFrame:
        """(bucket, n) as they are now."""
        return self.buckets.totals() if self.asks else self.buckets.latest()

    def result(self, ordered: bool = False) -> DataFrame:
        return O.ads.trend_windows(self._counts(), self.window_s, self.slide_s, ordered)

    def latest(self) -> DataFrame:
        """The current window: (pos, bucket, n) of the last ``window_s`` seconds up to the
        newest bucket, in order of time; buckets without a click are absent, as in the reference."""
        slots = self.window_s // self.slide_s
        newest = self._counts().agg(F.max("bucket").alias("newest"))
        now = self._counts().join(F.broadcast(newest), F.col("bucket") > F.col("newest") - self.window_s)
        order = Window.orderBy("bucket")   # at most window_s / slide_s rows
        return (now.select("bucket", "n").withColumn("pos", F.row_number().over(order).cast("bigint"))
                .where(F.col("pos") <= slots).select("pos", "bucket", "n"))


class ArrivalTrendJob(_Job):
    """R7/T4 by time of arrival: the clicks that *arrived* in the last ``window_s``
    seconds, counted by their 10-second event-time bucket.

    A ring of slots, each ``slide_s`` seconds of arrival, holds one partial count for
    each batch, by event bucket. The window after a batch is the window before it, plus
    the batch's own counts, minus the slots that have left since; so a batch reads the
    previous window (one row for each event bucket in it) and the leaving slots, never
    the clicks of the slots that stay.

    ``arrival`` gives the second at which a batch arrived. By default it is the clock
    at the batch's first run; that is stored, so that a replayed batch gets the same
    slot. Slots that have left, windows and arrivals before the last batch are removed.
    A batch seems never to arrive before the one in front of it.
    """

    def __init__(self, spark, out_dir, window_s: int = O.ads.TREND_WINDOW_S,
                 slide_s: int = O.ads.TREND_SLIDE_S, exclude_users: Exclusions | None = None,
                 keep_rejects: bool = True, arrival: Callable[[int], int] | None = None,
                 keep_views: int | None = None, compact_every: int | None = COMPACT_EVERY):
        super().__init__(spark, out_dir, compact_every)
        if window_s % slide_s:
            raise ValueError("window must be a multiple of the slide")
        self.rejects = self._rejects() if keep_rejects else None
        self.slots, self.slide_s, self.exclude_users = window_s // slide_s, slide_s, exclude_users
        self.arrival, self.keep_views = arrival or (lambda _: int(time.time())), keep_views
        mkdirs(spark, f"{self.out_dir}/views")

    def _slot(self, batch_id: int) -> tuple[int, int | None]:
        """The slot of a batch and that of the batch before it (null for the first)."""
        root = f"{self.out_dir}/arrivals"
        before = numbered_dirs(self.spark, f"{root}/{batch_id - 1}", "slot=")
        known = numbered_dirs(self.spark, f"{root}/{batch_id}", "slot=")
        if not known:
            known = [max([int(self.arrival(batch_id)) // self.slide_s, *before])]
            mkdirs(self.spark, f"{root}/{batch_id}/slot={known[0]}")
        return known[0], before[0] if before else None

    def _counted(self, path: str) -> DataFrame:
        return self.spark.read.schema("bucket bigint, n bigint").parquet(path)

    def process(self, batch, batch_id):
        slot, last = self._slot(batch_id)
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)   # read by two writes
        try:
            clicks = self._kept(self._parse(batch, batch_id, self.rejects), batch_id)
            bucket = floor_div(F.col("ts_ms"), 1000 * self.slide_s) * self.slide_s
            counts = clicks.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
            own = f"{self.out_dir}/slots/slot={slot}/batch_id={batch_id}"
            counts.write.mode("overwrite").parquet(own)
        finally:
            batch.unpersist()
        window = self._counted(own)
        if last is not None:
            window = window.union(self._counted(f"{self.out_dir}/windows/batch_id={batch_id - 1}"))
            for s in self._leaving(last, slot):
                window = window.union(self._counted(f"{self.out_dir}/slots/slot={s}/*").select("bucket", (-F.col("n")).alias("n")))
        window = window.groupBy("bucket").agg(F.sum("n").alias("n")).where("n > 0")
        now = f"{self.out_dir}/windows/batch_id={batch_id}"
        window.coalesce(1).write.mode("overwrite").parquet(now)   # one row for each event bucket
        self._counted(now).coalesce(1).write.mode("overwrite").parquet(f"{self.out_dir}/views/slot={slot}")
        self._forget(batch_id, last)
        self._maybe_compact(batch_id, self.rejects)

    def _leaving(self, last: int, slot: int) -> list[int]:
        """The stored slots that were in the window of ``last`` and are not in that of ``slot``."""
        stored = numbered_dirs(self.spark, f"{self.out_dir}/slots", "slot=")
        return [s for s in stored if last - self.slots < s <= slot - self.slots]

    def _forget(self, batch_id: int, last: int | None) -> None:
        """Remove what no batch from this one on needs, also if this one is replayed."""
        gone = [f"windows/batch_id={b}" for b in numbered_dirs(self.spark, f"{self.out_dir}/windows", "batch_id=") if b < batch_id - 1]
        gone += [f"arrivals/{b}" for b in numbered_dirs(self.spark, f"{self.out_dir}/arrivals", "") if b < batch_id - 1]
        if last is not None:
            gone += [f"slots/slot={s}" for s in numbered_dirs(self.spark, f"{self.out_dir}/slots", "slot=") if s <= last - self.slots]
        if self.keep_views:
            gone += [f"views/slot={s}" for s in numbered_dirs(self.spark, f"{self.out_dir}/views", "slot=")[:-self.keep_views]]
        for folder in gone:
            remove_dir(self.spark, f"{self.out_dir}/{folder}")

    def result(self) -> DataFrame:
        """(window_end, bucket, n): for each slot with a batch, what had arrived in the window up to its last batch."""
        views = self.spark.read.schema("bucket bigint, n bigint, slot bigint").option(
            "basePath", f"{self.out_dir}/views").parquet(f"{self.out_dir}/views")
        return views.select(((F.col("slot") + 1) * self.slide_s).alias("window_end"), "bucket", "n")


class BlacklistJob(_Job):
    """Running counts per (date, ad, user) in the state store (A11); a user whose
    count reaches the threshold in a batch is listed by that batch, once (F7, S12).

    The reference drops a listed user's clicks from the next batch on (J2). That can't
    move a crossing, since a user is listed by the first one (see ``operators.blacklist``), so
    the counts need not know the list. A batch gets only the counts it changed and
    of these only those at the threshold: candidates are looked up in the list, which
    is the only log a batch reads, in the buckets of the candidates. ``watermark``
    bounds the state (see ``daily``).
    """

    output_mode = "update"
    rejects_apart = True

    def __init__(self, spark, out_dir, threshold: int = O.ads.DEFAULT_THRESHOLD,
                 compact_every: int | None = COMPACT_EVERY, keep_rejects: bool = True,
                 watermark: str | None = None):
        super().__init__(spark, out_dir, compact_every)
        self.threshold, self.watermark = threshold, watermark
        self.rejects = self._rejects() if keep_rejects else None
        self.listed = SetLog(spark, f"{self.out_dir}/listed", "user_id bigint, listed_batch bigint",
                             LOOKUP_BUCKETS, ["user_id"])

    def plan(self, lines):
        clicks, day = daily(parse_ad_log(lines), self.watermark)
        counts = clicks.groupBy(day, "ad_id", "user_id").agg(F.count(F.lit(1)).alias("n"))
        return counts.where(F.col("n") >= F.lit(self.threshold)).select("user_id")

    def process(self, batch, batch_id):
        crossed = batch.distinct().persist(StorageLevel.MEMORY_AND_DISK)   # looked up, then written
        try:
            known = self.listed.lookup(crossed, ["user_id"], before=batch_id)
            new = crossed.join(known.select("user_id"), "user_id", "left_anti")
            self.listed.write(new.withColumn("listed_batch", F.lit(int(batch_id)).cast("bigint")), batch_id)
        finally:
            crossed.unpersist()
        self._maybe_compact(batch_id, self.listed)

    def listed_before(self, clicks: DataFrame, batch_id: int | None) -> DataFrame:
        """(user_id): the users of ``clicks`` whom a batch before this one has listed.

        Other jobs over the same batches take it as ``exclude_users``; the list as it is
        now, for jobs with batches of their own, is that before batch ``None``. Only the
        buckets of these users are opened.
        """
        return self.listed.lookup(clicks.select("user_id"), ["user_id"], before=batch_id).select("user_id")

    def result(self) -> DataFrame:
        """(user_id, first_batch): each listed user and the batch that listed them."""
        return (self.listed.read().groupBy("user_id")
                .agg(F.min("listed_batch").alias("first_batch")))


class WordCountJob(_Job):
    """Per-batch word counts of incoming lines (T3, A13), summed in a counter log."""

    def __init__(self, spark, out_dir, compact_every: int | None = COMPACT_EVERY):
        super().__init__(spark, out_dir, compact_every)
        self.counts = IncrementLog(spark, f"{self.out_dir}/counts", "word string, n bigint",
                                   ["word"], "n")

    def process(self, batch, batch_id):
        self.counts.write(O.word_count(batch, "value", lines=True), batch_id)
        self._maybe_compact(batch_id, self.counts)

    def result(self) -> DataFrame:
        return self.counts.totals()
