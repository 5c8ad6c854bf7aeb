"""Page flow reports (R3: single-hop conversion, R8: average dwell time).

X7 flow pairs, F5/A4 views of the flow pages, W3/A5 transition counts, F6 pair
membership, J3 lookup of the denominator (default 1), A6 ratio, W4 dwell rows,
A7 truncating mean.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickpath.operators.sessions import (DEFAULT_SLICE_SECONDS, session_steps,
                                         session_successors)

DEFAULT_FLOW = (1, 2, 3, 4, 5, 6, 7)


def parse_flow(flow: str | Sequence[int]) -> list[int]:
    """A target flow from ``"1,2,3"`` or a sequence of page ids."""
    if isinstance(flow, str):
        return [int(p) for p in flow.split(",") if p.strip()]
    return [int(p) for p in flow]


def flow_pairs(flow: str | Sequence[int]) -> list[tuple[int, int]]:
    """Adjacent pairs of the flow, first occurrence order, repeats once."""
    pages = parse_flow(flow)
    seen: dict[tuple[int, int], None] = {}
    for pair in zip(pages, pages[1:]):
        seen.setdefault(pair, None)
    return list(seen)


def in_pairs(pairs: Sequence[tuple[int, int]], first: str = "page_from",
             second: str = "page_to") -> F.Column:
    """``(first, second) IN (pairs)`` for a literal pair list."""
    if not pairs:
        return F.lit(False)
    values = ", ".join(f"({int(a)}L, {int(b)}L)" for a, b in pairs)
    return F.expr(f"({first}, {second}) IN ({values})")


def adjacent_pairs(arr: F.Column) -> F.Column:
    """Array of ``struct(first, second)`` for neighbouring elements of an array."""
    n = F.size(arr)
    return F.when(n >= 2, F.arrays_zip(F.slice(arr, 1, n - 1).alias("first"),
                                       F.slice(arr, 2, n - 1).alias("second"))) \
            .otherwise(F.array().cast("array<struct<first:string,second:string>>"))


def page_view_counts(visits: DataFrame, pages: Sequence[int]) -> DataFrame:
    """(page_id, views) for the given pages; all views, also a session's last."""
    return (visits.where(F.col("page_id").isin(list(pages)))
            .groupBy("page_id").agg(F.count(F.lit(1)).alias("views")))


def page_transition_counts(visits: DataFrame, slice_seconds: int = DEFAULT_SLICE_SECONDS,
                           hot_rows: int | None = None) -> DataFrame:
    """(page_from, page_to, n) over all adjacent steps of all sessions."""
    return (session_steps(visits, slice_seconds, hot_rows=hot_rows)
            .groupBy("page_from", "page_to").agg(F.count(F.lit(1)).alias("n")))


def page_flow_conversion(visits: DataFrame, flow: str | Sequence[int] = DEFAULT_FLOW,
                         slice_seconds: int = DEFAULT_SLICE_SECONDS,
                         hot_rows: int | None = None) -> DataFrame:
    """Conversion of each adjacent pair of the target flow.

    ``rate = transitions / views(page_from)``; pairs never seen are absent. (The
    reference defaults a missing view count to 1; a hop's own first action is
    always a view, so the default can never apply.) Apply a date range to
    ``visits`` first: sessions crossing a bound are cut, as in the reference (Q8).

    One pass, no join: every action appears once with its successor, so one
    small aggregate over ``(page_from, pair_to)`` - ``pair_to`` is the successor
    when the step is a flow pair, else null - holds both numbers. The views of a
    page (all its actions, also a session's last, Q9) are the sum over its rows,
    taken by a window on that aggregate. A page outside the flow between two flow
    pages breaks the hop (Q10), so all actions take part in the ordering and only
    results are filtered.
    """
    pages = parse_flow(flow)
    is_hop = F.col("has_next") & in_pairs(flow_pairs(pages))
    per_pair = (session_successors(visits, slice_seconds, hot_rows=hot_rows)
                .where(F.col("page_from").isin(pages))
                .groupBy("page_from", F.when(is_hop, F.col("page_to")).alias("pair_to"))
                .agg(F.count(F.lit(1)).alias("n")))
    views = F.sum("n").over(Window.partitionBy("page_from")).cast("bigint")
    return (per_pair.select("*", views.alias("views"))
            .where(F.col("pair_to").isNotNull())
            .select("page_from", F.col("pair_to").alias("page_to"),
                    F.col("n").alias("transitions"), "views",
                    (F.col("n").cast("double") / F.col("views")).alias("rate")))


def page_dwell_rows(visits: DataFrame, slice_seconds: int = DEFAULT_SLICE_SECONDS,
                    hot_rows: int | None = None) -> DataFrame:
    """(event_id, page_id, dwell_ms): time to the next action of the session.

    Times are whole seconds, so dwell is a multiple of 1000; the last action of a
    session has no row.
    """
    return session_steps(visits, slice_seconds, hot_rows=hot_rows).select(
        "event_id", F.col("page_from").alias("page_id"),
        (F.col("t_to_ms") - F.col("t_from_ms")).alias("dwell_ms"))


def page_avg_dwell(visits: DataFrame, slice_seconds: int = DEFAULT_SLICE_SECONDS,
                   hot_rows: int | None = None) -> DataFrame:
    """(page_id, avg_dwell_ms): truncating integer mean, as ``sum / size`` on longs.

    Steps with a time that does not parse have no dwell and are left out;
    ``page_dwell_dropped`` returns them.
    """
    return (page_dwell_rows(visits, slice_seconds, hot_rows).where(F.col("dwell_ms").isNotNull())
            .groupBy("page_id")
            .agg(F.expr("sum(dwell_ms) div count(dwell_ms)").alias("avg_dwell_ms")))


def page_dwell_dropped(visits: DataFrame, slice_seconds: int = DEFAULT_SLICE_SECONDS,
                       hot_rows: int | None = None) -> DataFrame:
    """(event_id, page_id): the steps that ``page_avg_dwell`` leaves out, since a time did not parse."""
    return (page_dwell_rows(visits, slice_seconds, hot_rows).where(F.col("dwell_ms").isNull())
            .select("event_id", "page_id"))
