"""Sketches, atomic replacement, bucketed storage, pushdown, lenient dates and the entry's guard."""
import datetime
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from clickpath import operators as O
from clickpath.functions import civil_days, parse_time_lenient_ms
from clickpath.operators import sketch
from clickpath.session import new_work_dir
from clickpath.sinks import publish, read_published, write_bucketed
from clickpath.sources.adapters import visits_from_events

from conftest import rows

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("words", [1, 256])
def test_sketch_never_misses(spark, words):
    keys = spark.range(0, 400, 2).select(F.col("id").alias("user_id"))
    half = sketch.merge(sketch.build(keys.where("user_id < 200"), "user_id", words), sketch.build(keys.where("user_id >= 200"), "user_id", words))
    assert rows(half) == rows(sketch.build(keys, "user_id", words))
    bits = sketch.packed(half, words)
    probe = spark.range(4000).select(F.when(F.col("id") != 3999, F.col("id")).alias("user_id"))
    found = {r.user_id for r in probe.where(sketch.might_hold(F.col("user_id"), bits, words)).collect()}
    assert set(range(0, 400, 2)) <= found and None not in found
    assert words == 1 or len(found) < 200 + 400   # few false positives
    assert sketch.words_for(0) == sketch.MIN_WORDS and sketch.words_for(10 ** 12) == sketch.MAX_WORDS


@pytest.mark.parametrize("words", [None, 1, 256])
def test_clicks_kept_behind_a_sketch(spark, words):
    clicks = spark.range(300).select(F.when(F.col("id") % 10 != 3, F.col("id") % 30).alias("user_id"), (F.col("id") % 5).alias("batch"), F.col("id").alias("event_id"))
    listed = spark.createDataFrame([(u, u % 4) for u in range(0, 30, 3)], "user_id bigint, first_batch bigint")
    got = rows(O.clicks_kept(clicks, listed, sketch_words=words), "event_id")
    lists = {u: u % 4 for u in range(0, 30, 3)}
    want = sorted((i,) for i in range(300) if i % 10 == 3 or i % 30 not in lists or i % 5 <= lists[i % 30])
    assert got == want
    empty = listed.limit(0)
    assert O.clicks_kept(clicks, empty, sketch_words=words).count() == 300


def test_sketch_shuffles_only_what_it_does_not_rule_out(spark):
    path = new_work_dir(spark, "t-sk")
    spark.range(20000).select(F.col("id").alias("user_id"), F.lit(1).alias("batch")).write.parquet(path + "/clicks")
    spark.createDataFrame([(5, 0), (6, 9)], "user_id bigint, first_batch bigint").write.parquet(path + "/listed")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = O.clicks_kept(spark.read.parquet(path + "/clicks"), spark.read.parquet(path + "/listed"), sketch_words=256)
        assert kept.count() == 19999
        plan = kept._jdf.queryExecution()
        union = plan.optimizedPlan().toString()
        assert union.startswith("Union") and "scalar-subquery" in union
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_publish_is_all_or_nothing(spark):
    path = new_work_dir(spark, "t-pub") + "/t"
    with pytest.raises(FileNotFoundError):
        read_published(spark, path)
    frame = lambda n: spark.range(n).withColumn("p", F.col("id") % 2)
    publish(frame(3), path)
    opened = read_published(spark, path)
    publish(frame(7), path, partition_by=["p"])
    assert opened.count() == 3 and read_published(spark, path).count() == 7
    failing = frame(9).withColumn("x", F.raise_error(F.lit("fails midway")).cast("string"))
    with pytest.raises(Exception, match="fails midway"):
        publish(failing, path)
    assert read_published(spark, path).count() == 7 and opened.count() == 3
    for n in range(10, 14):
        publish(frame(n), path)
    assert read_published(spark, path).count() == 13
    assert len([d for d in os.listdir(path.removeprefix("file:")) if d.startswith("v")]) == 3


def test_page_flow_over_buckets_has_no_shuffle_of_visits(spark):
    visits = spark.createDataFrame([(i, f"s{i % 7}", i % 5 + 1, f"2024-01-01 00:00:{i % 60:02d}") for i in range(300)],
                                   "event_id bigint, session_id string, page_id bigint, action_time string")
    write_bucketed(visits, "t_bucketed", "session_id", ["action_time"], 4, path=new_work_dir(spark, "t-bk") + "/t")
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "true")
    stored = spark.table("t_bucketed")
    try:
        assert "Exchange" not in _plan(O.session_steps(stored).groupBy().count()).replace("Exchange SinglePartition", "")
        assert rows(O.page_flow_conversion(stored, (1, 2, 3))) == rows(O.page_flow_conversion(visits, (1, 2, 3)))
    finally:
        spark.sql("DROP TABLE t_bucketed")


def test_date_bounds_reach_the_scan(spark):
    path = new_work_dir(spark, "t-ev") + "/e"
    day = datetime.datetime(2024, 1, 1)
    spark.createDataFrame([(i, i, "click", day + datetime.timedelta(hours=i), '{"k": 1}') for i in range(240)],
                          "event_id bigint, user_id bigint, event_type string, ts timestamp, props string").write.parquet(path)
    events = spark.read.parquet(path)
    for lo, hi in (("2024-01-03", "2024-01-05"), (None, "2024-01-05"), ("2024-01-04", None), ("2024-01-30", "x"), ("", "2024-01-31")):
        got = O.date_range(visits_from_events(events, lo, hi), lo, hi)
        assert rows(got, "event_id") == rows(O.date_range(visits_from_events(events), lo, hi), "event_id")
    plan = _plan(O.date_range(visits_from_events(events, "2024-01-03", "2024-01-05"), "2024-01-03", "2024-01-05"))
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_civil_days_and_lenient_times(spark):
    dates = [datetime.date(y, m, d) for y in (1, 4, 100, 1600, 1899, 1900, 1970, 2000, 2023, 2024, 2100, 9999) for m in range(1, 13) for d in (1, 28)]
    df = spark.createDataFrame([(d.year, d.month, d.day) for d in dates], "y bigint, m bigint, d bigint")
    got = df.select("y", "m", "d", civil_days(F.col("y"), F.col("m"), F.col("d")).alias("n")).collect()
    epoch = datetime.date(1970, 1, 1)
    assert all(r.n == (datetime.date(r.y, r.m, r.d) - epoch).days for r in got)
    ms = lambda *t: int((datetime.datetime(*t) - datetime.datetime(1970, 1, 1)).total_seconds()) * 1000
    times = {"2024-01-05 10:20:30": ms(2024, 1, 5, 10, 20, 30), "2024-02-30 00:00:00": ms(2024, 3, 1), "2023-02-30 00:00:00": ms(2023, 3, 2),
             "2024-01-01 25:61:00": ms(2024, 1, 2, 2, 1), "2024-13-01 00:00:00": ms(2025, 1, 1), "2024-00-00 0:0:0": ms(2023, 11, 30),
             " 2024- 1-\t5  1: 2:3 and more": ms(2024, 1, 5, 1, 2, 3), "2024-01-05": None, "": None, "no time": None, "2024--1-01 00:00:00": None,
             "2024-01-05T10:20:30": None, None: None}
    df = spark.createDataFrame([(t,) for t in times], "t string")
    assert {r.t: r.ms for r in df.select("t", parse_time_lenient_ms(F.col("t")).alias("ms")).collect()} == times


def test_rollup_has_both_levels(spark):
    clicks = spark.createDataFrame([("d", "A", c, 1) for c in ("x", "x", "y", None)] + [("d", "B", "x", 1)], "date string, area string, city string, ad_id bigint")
    both = O.area_rollup(clicks)
    assert rows(both.where("NOT all_cities").drop("all_cities").fillna("-")) == rows(O.area_city_ad_daily(clicks).select("date", "area", "city", "ad_id", "n").fillna("-"))
    assert rows(both.where("all_cities"), "date", "area", "ad_id", "n") == rows(O.area_ad_daily(O.area_city_ad_daily(clicks)), "date", "area", "ad_id", "n")
    plan = _plan(both)
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning") == 1


def _entry(code):
    run = subprocess.run([sys.executable, "-c", code], cwd=REPO, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    return run.stdout.strip().splitlines()[-1], run.stderr


@pytest.mark.parametrize("missing", ["xxhash", "clickpath.nothing"])
def test_the_core_queries_stand_without_the_corpus_operators(missing):
    """A package that isn't installed, and an import that is broken inside, leave 50 and more queries and say why."""
    pytest.importorskip("corpus_pipeline")
    broken = ("import sys; sys.modules['xxhash'] = None\n" if missing == "xxhash" else
              "import sys, importlib.abc\nclass F(importlib.abc.MetaPathFinder):\n"
              "    def find_spec(self, name, path, target=None):\n"
              "        if name == 'clickpath.llm.components': raise ImportError('broken inside', name='clickpath.nothing')\n"
              "sys.meta_path.insert(0, F())\n")
    out, said = _entry(broken + "import __spark_entry__ as E\nprint(len(E.queries()), any(q.startswith('op') for q in E.queries()))")
    n, has_llm = out.split()
    assert int(n) >= 57 and has_llm == "False" and "left out" in said


def test_the_entry_without_the_corpus_folders():
    code = ("import sys, importlib.abc\nclass F(importlib.abc.MetaPathFinder):\n    def find_spec(self, name, path, target=None):\n"
            "        if name.startswith('clickpath.llm') or name == 'corpus_pipeline': raise ModuleNotFoundError(name, name=name)\n"
            "sys.meta_path.insert(0, F())\nimport __spark_entry__ as E\nprint(len(E.queries()), len(E.oracle_sql()))")
    out, _ = _entry(code)
    n, m = map(int, out.split())
    assert n == m >= 57
