from clickpath.session import new_work_dir
from clickpath.sinks import IncrementLog, ReplaceLog, SetLog

from conftest import rows


def test_empty_logs_are_readable(spark):
    work = new_work_dir(spark, "t-empty")
    assert SetLog(spark, f"{work}/s", "user_id bigint").members().count() == 0
    inc = IncrementLog(spark, f"{work}/i", "k string, n bigint", ["k"], "n")
    assert inc.totals().count() == 0


def test_increment_replay_is_idempotent(spark):
    # mf_replay: the same batch delivered twice counts once
    work = new_work_dir(spark, "t-inc")
    log = IncrementLog(spark, f"{work}/i", "k string, n bigint", ["k"], "n")
    d0 = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n bigint")
    d1 = spark.createDataFrame([("a", 5)], "k string, n bigint")
    log.write(d0, 0)
    log.write(d1, 1)
    log.write(d0, 0)
    assert rows(log.totals()) == [("a", 6), ("b", 2)]
    assert rows(log.totals(before=1)) == [("a", 1), ("b", 2)]
    only = spark.createDataFrame([("b",)], "k string")
    assert rows(log.totals(only=only)) == [("b", 2)]


def test_set_and_replace_logs(spark):
    work = new_work_dir(spark, "t-set")
    s = SetLog(spark, f"{work}/s", "user_id bigint")
    s.write(spark.createDataFrame([(1,), (2,)], "user_id bigint"), 0)
    s.write(spark.createDataFrame([(2,), (3,)], "user_id bigint"), 1)
    assert rows(s.members()) == [(1,), (2,), (3,)]
    r = ReplaceLog(spark, f"{work}/r", "k string, v string", ["k"])
    r.write(spark.createDataFrame([("a", "old"), ("b", "b0")], "k string, v string"), 0)
    r.write(spark.createDataFrame([("a", "new")], "k string, v string"), 1)
    r.write(spark.createDataFrame([("a", "old"), ("b", "b0")], "k string, v string"), 0)
    assert rows(r.latest()) == [("a", "new"), ("b", "b0")]


def test_write_many_replaces_only_its_batches(spark):
    work = new_work_dir(spark, "t-many")
    log = IncrementLog(spark, f"{work}/i", "k string, n bigint", ["k"], "n")
    df = spark.createDataFrame([("a", 1, 0), ("a", 2, 1)], "k string, n bigint, b bigint")
    log.write_many(df, "b")
    log.write_many(df.where("b = 1"), "b")
    assert rows(log.totals()) == [("a", 3)]


def test_compaction_keeps_results_and_replay(spark):
    work = new_work_dir(spark, "t-compact")
    inc = IncrementLog(spark, f"{work}/i", "k string, n bigint", ["k"], "n")
    rep = ReplaceLog(spark, f"{work}/r", "k string, v bigint", ["k"])
    st = SetLog(spark, f"{work}/s", "k string")
    for b in range(6):
        df = spark.createDataFrame([("a", b), (f"k{b % 2}", 1)], "k string, n bigint")
        inc.write(df, b)
        rep.write(df.withColumnRenamed("n", "v"), b)
        st.write(df.select("k"), b)
        if b in (2, 4):
            for log in (inc, rep, st):
                log.compact(b)
    assert rows(inc.totals()) == [("a", 15), ("k0", 3), ("k1", 3)]
    assert rows(inc.totals(before=4)) == [("a", 6), ("k0", 2), ("k1", 2)]   # snapshot 2 + batch 3
    assert rows(inc.totals(before=2)) == [("a", 1), ("k0", 1), ("k1", 1)]   # no snapshot below 2
    assert rows(rep.latest()) == [("a", 5), ("k0", 1), ("k1", 1)]
    assert rows(rep.latest(before=4)) == [("a", 3), ("k0", 1), ("k1", 1)]
    assert rows(st.members()) == [("a",), ("k0",), ("k1",)]
    assert rows(inc.read_batch(1), "k", "n") == [("a", 1), ("k1", 1)]
    inc.write(spark.createDataFrame([("a", 1)], "k string, n bigint"), 1)   # replay batch 1
    assert rows(inc.totals()) == [("a", 15), ("k0", 3), ("k1", 3)]          # snapshot 4 covers it


def test_batches_after_a_snapshot_go_to_a_new_generation(spark):
    import os

    import pytest
    work = new_work_dir(spark, "t-gen")
    log = IncrementLog(spark, f"{work}/i", "k string, n bigint", ["k"], "n")
    one = spark.createDataFrame([("a", 1)], "k string, n bigint")
    for b in range(3):
        log.write(one, b)
    with pytest.raises(ValueError):
        log.compact(1)              # batch 2 already written: would be stranded
    log.compact(2)
    log.write(spark.createDataFrame([("a", 10)], "k string, n bigint"), 3)
    local = work.replace("file:", "")
    assert sorted(os.listdir(f"{local}/i/g-1")) == ["batch_id=0", "batch_id=1", "batch_id=2"]
    assert [d for d in os.listdir(f"{local}/i/g2") if d.startswith("batch_id")] == ["batch_id=3"]
    assert rows(log.totals()) == [("a", 13)]
    assert rows(log.totals(before=3)) == [("a", 3)]
    assert rows(log.read_batch(1), "k", "n") == [("a", 1)]
    log.compact(2)                  # again, e.g. for a replayed batch 2: same snapshot
    assert rows(log.totals()) == [("a", 13)]
