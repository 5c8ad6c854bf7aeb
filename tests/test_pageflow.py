import random
import re
from datetime import datetime, timedelta, timezone

from clickpath import operators as O
from clickpath.operators.sessions import session_steps, session_successors

from conftest import rows

SCHEMA = "event_id bigint, session_id string, page_id bigint, action_time string, date string"
T0 = datetime(2024, 1, 1, 23, 58, 0, tzinfo=timezone.utc)


def at(seconds):
    t = T0 + timedelta(seconds=seconds)
    return t.strftime("%Y-%m-%d %H:%M:%S")


def frame(spark, data):
    return spark.createDataFrame([(e, s, p, at(t), at(t)[:10]) for e, s, p, t in data], SCHEMA)


def brute_steps(data):
    by_session = {}
    for e, s, p, t in data:
        by_session.setdefault(s, []).append((at(t), e, p, t))
    out = []
    for acts in by_session.values():
        acts.sort()
        for (_, e1, p1, t1), (_, _, p2, t2) in zip(acts, acts[1:]):
            out.append((e1, p1, p2, (t2 - t1) * 1000))
    return sorted(out)


def test_steps_any_slice_width_equal_brute_force(spark):
    rnd = random.Random(7)
    data, eid = [], 0
    for s in range(12):
        n = rnd.choice([1, 2, 5, 40])           # single-action and long sessions
        for _ in range(n):
            t = rnd.randrange(0, 7200)          # spans several slices and midnight
            if rnd.random() < 0.2 and data:     # equal seconds inside a session
                t = data[-1][3]
            data.append((eid, f"u-{s}", rnd.randrange(1, 8), t))
            eid += 1
    want = brute_steps(data)
    df = frame(spark, data)
    for width in (1, 7, 60, 3600, 86400 * 30):
        got = rows(session_steps(df, width).selectExpr(
            "event_id", "page_from", "page_to", "t_to_ms - t_from_ms"))
        assert got == want, width
    # hot-slice splitting: every (session, slice) over 3 rows cut into groups of
    # at most 2 tie values per second
    for width in (60, 3600, 86400 * 30):
        got = rows(session_steps(df, width, hot_rows=3, sub_tie_rows=2).selectExpr(
            "event_id", "page_from", "page_to", "t_to_ms - t_from_ms"))
        assert got == want, ("hot", width)


def test_one_hot_session_second_is_split(spark):
    # one session with 200 actions inside the same second: the plain slice is a
    # single group; with hot_rows the largest window group has sub_tie_rows rows
    data = [(i, "hot", i % 5 + 1, 30) for i in range(200)] + [(500, "cold", 1, 0)]
    df = frame(spark, data)
    want = brute_steps(data)
    got = session_steps(df, 3600, hot_rows=50, sub_tie_rows=16)
    assert rows(got.selectExpr("event_id", "page_from", "page_to",
                               "t_to_ms - t_from_ms")) == want
    plan = re.sub(r"#\d+L?", "", got._jdf.queryExecution().executedPlan().toString())
    assert "hashpartitioning(session_id, _slice, _sub_t, _sub_k" in plan


def test_successors_cover_every_action_once(spark):
    rnd = random.Random(11)
    data = [(i, f"u-{rnd.randrange(5)}", rnd.randrange(1, 4), rnd.randrange(0, 9000))
            for i in range(120)]
    df = frame(spark, data)
    for width in (1, 600, 86400):
        succ = session_successors(df, width)
        assert sorted(r["event_id"] for r in succ.collect()) == list(range(120))
        # one action per session has no successor
        assert succ.where("NOT has_next").count() == len({d[1] for d in data})


def test_flow_conversion_semantics(spark):
    # mf_sessions: single action; page outside the flow breaks a hop; repeated pair
    data = [(0, "a", 1, 0), (1, "a", 2, 10), (2, "a", 3, 20), (3, "a", 9, 30), (4, "a", 4, 40),
            (5, "b", 1, 0),
            (6, "c", 1, 0), (7, "c", 2, 0), (8, "c", 1, 5), (9, "c", 2, 6)]
    out = rows(O.page_flow_conversion(frame(spark, data), "1,2,3,4,1,2"))
    # views: page 1 -> 4, 2 -> 3, 3 -> 1; pairs 1-2 (x3), 2-3 (x1); 3-4 broken by 9
    assert out == [(1, 2, 3, 4, 0.75), (2, 3, 1, 3, 1 / 3)]


def test_date_bound_cuts_session(spark):
    # a session over midnight loses its crossing step when the range cuts it (Q8)
    data = [(0, "a", 1, 0), (1, "a", 2, 60), (2, "a", 3, 150)]   # 23:58, 23:59, 00:00:30
    v = frame(spark, data)
    assert rows(O.page_transition_counts(v)) == [(1, 2, 1), (2, 3, 1)]
    cut = O.date_range(v, " ", "2024-01-01")   # blank start bound = no bound
    assert rows(O.page_transition_counts(cut)) == [(1, 2, 1)]


def test_avg_dwell_truncates(spark):
    data = [(0, "a", 1, 0), (1, "a", 1, 1), (2, "a", 2, 3), (3, "b", 1, 0), (4, "b", 3, 1)]
    # page 1 dwell: 1000, 2000, 1000 -> 4000 / 3 = 1333 (truncated); page 2: last, no row
    assert rows(O.page_avg_dwell(frame(spark, data))) == [(1, 1333)]


def test_adjacent_pairs(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(["1", "2", "3"],), (["1"],), ([],)], "a array<string>")
    got = [r[0] for r in df.select(O.adjacent_pairs(F.col("a"))).collect()]
    assert [[tuple(p) for p in g] for g in got] == [[("1", "2"), ("2", "3")], [], []]
    assert O.flow_pairs("1,2,1,2,3") == [(1, 2), (2, 1), (2, 3)]


def test_session_with_a_third_of_all_rows(spark):
    # real rows (sf0.001 events); every third action is moved into one session
    import os
    from pyspark.sql import functions as F
    from clickpath.sources import load_visits
    sf = "/root/testdata/sf0.001"
    if not os.path.exists(sf):
        return
    v = load_visits(spark, sf).withColumn(
        "session_id", F.when(F.pmod("event_id", F.lit(3)) == 0, F.lit("hot"))
        .otherwise(F.col("session_id")))
    acts = {}
    for r in v.select("session_id", "action_time", "event_id", "page_id").collect():
        acts.setdefault(r[0], []).append((r[1], r[2], r[3]))
    want = {}
    for seq in acts.values():
        seq.sort()
        for (_, _, p1), (_, _, p2) in zip(seq, seq[1:]):
            want[(p1, p2)] = want.get((p1, p2), 0) + 1
    want = sorted((a, b, n) for (a, b), n in want.items())
    assert len(acts["hot"]) * 3 >= sum(len(s) for s in acts.values()) - 3
    assert rows(O.page_transition_counts(v)) == want
    assert rows(O.page_transition_counts(v, hot_rows=20)) == want
