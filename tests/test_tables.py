import uuid

from pyspark.sql import functions as F

from clickpath import operators as O
from clickpath.session import new_work_dir
from clickpath.sinks import overwrite_table
from clickpath.sources import broadcast_if_small, plan_size_bytes, read_visit_actions

from conftest import rows
from test_categories import frame, visit


def test_partitioned_table_prunes_date_range(spark):
    data = [visit(i, t=f"2024-01-0{d} 10:00:00") for i, d in enumerate([1, 2, 3, 3, 4])]
    name = f"visits_{uuid.uuid4().hex[:8]}"
    path = f"{new_work_dir(spark, 't-table')}/{name}"
    overwrite_table(frame(spark, data), name, path=path, partition_by=["date"])
    v = read_visit_actions(spark, name)
    got = O.date_range(v, "2024-01-02", "2024-01-03")
    assert sorted(r["event_id"] for r in got.collect()) == [1, 2, 3]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "2024-01-02" in plan
    # the same table read back by path keeps the schema and the tie key
    assert read_visit_actions(spark, path).columns[:2] == ["date", "user_id"]


def test_exclude_users_and_broadcast_check(spark):
    clicks = spark.createDataFrame([(1, 1000), (2, 1000), (2, 11000)], "user_id bigint, ts_ms bigint")
    users = spark.createDataFrame([(2,)], "user_id bigint")
    assert rows(O.click_trend(clicks, 10, 10, exclude_users=users)) == [(10, 0, 1)]
    # a scan with statistics is hinted; unknown size (local rows) never is
    known = spark.range(5).withColumnRenamed("id", "user_id")
    assert 0 < plan_size_bytes(known) < 1024
    hinted = broadcast_if_small(known)._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" in hinted
    assert broadcast_if_small(known, max_bytes=0) is known
    assert broadcast_if_small(users) is users
    assert O.exclude(clicks, None) is clicks
    assert clicks.where(F.col("user_id") == 2).count() == 2


def test_read_parquet_reinfers_after_rewrite(spark):
    import time
    from clickpath.sources.tables import read_parquet
    path = f"{new_work_dir(spark, 't-schema')}/t"
    spark.range(3).write.parquet(path)
    assert read_parquet(spark, path).columns == ["id"]
    assert read_parquet(spark, path).columns == ["id"]          # cached schema
    time.sleep(1.1)
    spark.range(3).selectExpr("id", "id * 2 AS x").write.mode("overwrite").parquet(path)
    df = read_parquet(spark, path)
    assert df.columns == ["id", "x"] and df.count() == 3


def test_read_parquet_missing_path_raises_spark_error(spark):
    import pytest
    from pyspark.errors import AnalysisException
    from clickpath.sources.tables import read_parquet
    with pytest.raises(AnalysisException):
        read_parquet(spark, "/nonexistent/clickpath/table.parquet")


def test_column_added_in_a_nested_folder_is_seen(spark, tmp_path):
    from clickpath.sources.tables import read_parquet
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path + "/p=1")
    assert set(read_parquet(spark, path).columns) == {"id", "p"}
    spark.range(3).selectExpr("id", "id * 2 AS extra").write.mode("overwrite").parquet(path + "/p=1")
    assert set(read_parquet(spark, path).columns) == {"id", "extra", "p"}
