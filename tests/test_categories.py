from clickpath import operators as O
from clickpath.schema import VISIT_ACTION

from conftest import rows

COLS = [f.name for f in VISIT_ACTION.fields]


def visit(eid, session="u-1", click=-1, orders=None, pays=None, page=1, t="2024-01-01 00:00:00"):
    r = dict(date=t[:10], user_id=1, session_id=session, page_id=page, action_time=t,
             search_keyword=None, click_category_id=click, click_product_id=-1,
             order_category_ids=orders, order_product_ids=None, pay_category_ids=pays,
             pay_product_ids=None, city_id=1)
    return (eid, *[r[c] for c in COLS])


def frame(spark, data):
    schema = "event_id bigint, " + ", ".join(f"{f.name} {f.dataType.simpleString()}"
                                              for f in VISIT_ACTION.fields)
    return spark.createDataFrame(data, schema)


def test_action_kind_precedence(spark):
    # mf_kinds: click+order counts as click; order+pay as order; none; null click id
    v = frame(spark, [visit(1, click=5, orders="7"), visit(2, orders="7,8", pays="9"),
                      visit(3), visit(4, click=None, pays="9,9")])
    got = rows(O.category_metric_counts(v))
    assert got == [("5", "click", 1), ("7", "order", 1), ("8", "order", 1), ("9", "pay", 2)]


def test_empty_ids_count_like_java_split(spark):
    v = frame(spark, [visit(1, orders=""), visit(2, orders=",,"), visit(3, orders="a,,b,,")])
    got = rows(O.category_metric_counts(v))
    assert got == [("", "order", 2), ("a", "order", 1), ("b", "order", 1)]


def test_top10_ties_broken_by_id(spark):
    # mf_ties: 12 categories with equal counts -> the 10 smallest ids as strings
    data = [visit(i, click=i) for i in range(1, 13)]
    top = O.category_top10(frame(spark, data))
    assert [r["category_id"] for r in top.collect()] == sorted(str(i) for i in range(1, 13))[:10]


def test_top10_three_key_order(spark):
    data = [visit(1, click=1), visit(2, click=2), visit(3, orders="2"), visit(4, pays="1"),
            visit(5, pays="1")]
    top = O.category_top10(frame(spark, data), task_id="t")
    assert [tuple(r) for r in top.collect()] == [("t", "2", 1, 1, 0), ("t", "1", 1, 0, 2)]


def test_top_sessions_keep_dashed_ids_and_tie_order(spark):
    # mf_keys / Q2: session ids with '-' stay whole; ties by session id
    data = []
    for i, s in enumerate(["b-1-x", "a-2-y", "c-3", "a-2-y"]):
        data.append(visit(i, session=s, click=3))
    data.append(visit(9, session="z", click=-7))  # negative id is still a click
    out = rows(O.category_top10_sessions(frame(spark, data), k_sessions=2),
               "category_id", "session_id", "click_count", "rn")
    assert out == [("-7", "z", 1, 1), ("3", "a-2-y", 2, 1), ("3", "b-1-x", 1, 2)]


def test_session_clicks_sum_to_clicks(spark):
    data = [visit(i, session=f"s{i % 3}", click=i % 4 + 1) for i in range(40)]
    v = frame(spark, data)
    total = sum(r["click_count"] for r in O.category_session_clicks(v).collect())
    assert total == O.click_rows(v).count() == 40


def test_date_bounds_like_the_reference(spark):
    # mf_bounds: null / '' / blank / tab bounds mean no filter; bounds are inclusive
    v = frame(spark, [visit(i, t=f"2024-01-0{d} 10:00:00") for i, d in enumerate([1, 2, 3])])
    for empty in (None, "", "   ", "\t", "\t \n"):
        assert O.date_range(v, empty, empty).count() == 3, repr(empty)
    assert O.date_range(v, "2024-01-01", "2024-01-01").count() == 1      # equal to the first
    assert O.date_range(v, "2024-01-03", None).count() == 1              # equal to the last
    assert O.date_range(v, "2024-01-02", "2024-01-03").count() == 2


def test_category_with_a_third_of_all_clicks(spark):
    # real rows (sf0.001 events); every third click goes to category 7
    import os
    from pyspark.sql import functions as F
    from clickpath.sources import load_visits
    sf = "/root/testdata/sf0.001"
    if not os.path.exists(sf):
        return
    v = load_visits(spark, sf)
    v = v.withColumn("click_category_id", F.when(
        (F.col("click_category_id") != -1) & (F.pmod("event_id", F.lit(3)) == 0),
        F.lit(7).cast("bigint")).otherwise(F.col("click_category_id")))
    got = rows(O.category_top10_sessions(v), "category_id", "session_id", "click_count", "rn")
    top = {r["category_id"] for r in O.category_top10(v).collect()}
    counts = {}
    for r in v.where("click_category_id <> -1").select("click_category_id", "session_id").collect():
        key = (str(r[0]), r[1])
        counts[key] = counts.get(key, 0) + 1
    want = []
    for cat in top:
        ranked = sorted(((-n, s) for (c, s), n in counts.items() if c == cat))[:10]
        want += [(cat, s, -n, i + 1) for i, (n, s) in enumerate(ranked)]
    assert "7" in top and got == sorted(want)
