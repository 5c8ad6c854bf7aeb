import uuid

from clickpath.plans import reports as R
from clickpath.session import new_work_dir
from clickpath.sinks import overwrite_table
from clickpath.streaming.sources import file_lines

from conftest import rows
from test_categories import frame, visit


def _table(spark):
    data = [visit(i, session=f"s{i % 4}", click=i % 3 + 1, page=i % 5 + 1,
                  t=f"2024-01-0{i % 3 + 1} 10:00:{i:02d}") for i in range(30)]
    name = f"uva_{uuid.uuid4().hex[:8]}"
    overwrite_table(frame(spark, data), name, path=f"{new_work_dir(spark, 't-rep')}/{name}")
    return name


def test_batch_jobs_read_filter_and_sink(spark):
    name = _table(spark)
    out = f"top_{uuid.uuid4().hex[:8]}"
    top = R.category_top10_job(spark, name, "2024-01-02", "", task_id="t1", table=out)
    assert rows(spark.table(out)) == rows(top)
    assert {r["task_id"] for r in top.collect()} == {"t1"}
    assert sum(r["click_count"] for r in top.collect()) == 20       # two of three dates
    sessions = R.category_top10_sessions_job(spark, name, task_id="t2")
    assert sessions.count() == 12
    assert sessions.columns == ["task_id", "category_id", "session_id", "click_count"]
    assert top.columns == ["task_id", "category_id", "click_count", "order_count", "pay_count"]
    assert R.page_flow_job(spark, name, "1,2,3").count() >= 0
    assert {r["page_id"] for r in R.page_dwell_job(spark, name).collect()} <= {1, 2, 3, 4, 5}


def test_start_stream_job(spark):
    work = new_work_dir(spark, "t-rep-stream")
    spark.createDataFrame([("1704067200000 A C 1 2",)], "value string").write.text(f"{work}/in/b0")
    query, job = R.start_stream_job(spark, "area_city_ad_daily", file_lines(spark, f"{work}/in/*"),
                                    f"{work}/job", {"availableNow": True})
    query.awaitTermination()
    assert rows(job.result()) == [("2024-01-01", "A", "C", 2, 1)]


def test_command_line_batch_report(spark):
    from clickpath.__main__ import main
    name = _table(spark)
    out = f"cli_{uuid.uuid4().hex[:8]}"
    main(["category-top10", "--visits", name, "--start", "2024-01-02", "--table", out,
          "--task-id", "cli"])
    got = spark.table(out).collect()
    assert {r["task_id"] for r in got} == {"cli"} and sum(r["click_count"] for r in got) == 20
    main(["page-flow", "--visits", name, "--flow", "1,2,3", "--hot-rows", "2",
          "--table", out + "_flow"])
    assert spark.table(out + "_flow").columns == ["page_from", "page_to", "transitions",
                                                  "views", "rate"]


def test_command_line_stream_once(spark):
    from clickpath.__main__ import main
    work = new_work_dir(spark, "t-cli-stream")
    lines = [("1704067200000 A C 1 2",), ("1704067201000 A C 1 2",), ("bad",)]
    spark.createDataFrame(lines, "value string").write.text(f"{work}/in/b0")
    main(["stream", "area_city_ad_daily", "--files", f"{work}/in/*", "--out", f"{work}/job",
          "--once"])
    from clickpath.streaming.jobs import AreaCityAdDailyJob
    job = AreaCityAdDailyJob(spark, f"{work}/job")
    assert rows(job.result()) == [("2024-01-01", "A", "C", 2, 2)]
    assert rows(job.rejects.read(), "value") == [("bad",)]
