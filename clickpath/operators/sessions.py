"""Adjacent steps inside a time-ordered session.

The reference groups each session into memory, sorts it and zips it with its
tail. Here the next action is a ``lead`` over a window on ``session_id``: one
shuffle and one sort of the rows. Only a session with more than ``hot_rows``
actions, which would be too much for one task, goes another way:

1. Its actions are cut into slices by a leading part of the time string, and a
   slice with more than ``hot_rows`` actions again by the whole string and by
   ranges of tie values. A leading part never decreases in string order, whatever
   the string holds, so every group is a contiguous run of the session.
2. ``lead`` inside each group gives every step within it; the first and last row
   of each group go through a second ``lead`` over ``session_id``, which gives
   the steps that cross a border.

Both ways order by the time string and the tie key, and times are parsed for the
dwell time alone, so a session's steps are the same whichever way it takes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickpath.functions import floor_div, parse_time_ms
from clickpath.sources.tables import broadcast_if_small, stored

DEFAULT_SLICE_SECONDS = 3600
DEFAULT_SUB_TIE_ROWS = 1 << 20

# A session (and a slice) with more actions than this is split.
DEFAULT_HOT_ROWS = 1_000_000

# Length of the part of ``yyyy-MM-dd HH:mm:ss`` that stays the same for so many seconds.
_PREFIXES = ((86_400, 10), (3_600, 13), (60, 16), (0, 19))


def _groups_above(rows: DataFrame, keys: list[str], limit: int) -> DataFrame | None:
    """The key values with more than ``limit`` rows as columns ``_hot_<key>``; None if there
    are none. Counted once: the list is stored, and both decisions, whether there is any and
    whether it can be broadcast, are taken from what was stored."""
    big = (rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > F.lit(limit))
           .select(*(F.col(k).alias(f"_hot_{k}") for k in keys), F.lit(True).alias("_hot")))
    big = stored(big, "hot-groups")
    return None if big.isEmpty() else broadcast_if_small(big)


def _is_hot(keys: list[str]) -> F.Column:
    found = F.lit(True)
    for k in keys:
        found = found & F.col(k).eqNullSafe(F.col(f"_hot_{k}"))
    return found


def _step(next_page: F.Column, next_t: F.Column, has_next: F.Column) -> list[F.Column]:
    return [F.col("session_id"), F.col("_tie").alias("event_id"), F.col("page_id").alias("page_from"),
            next_page.alias("page_to"), F.col("t_ms").alias("t_from_ms"), next_t.alias("t_to_ms"),
            has_next.alias("has_next")]


def _by_session(rows: DataFrame) -> DataFrame:
    w = Window.partitionBy("session_id").orderBy("action_time", "_tie")
    return rows.select(*_step(F.lead("page_id").over(w), F.lead("t_ms").over(w),
                              F.lead(F.lit(True)).over(w).isNotNull()))


def _by_slices(rows: DataFrame, hot: DataFrame, slice_seconds: int, hot_rows: int, sub_tie_rows: int) -> DataFrame:
    """Successors where the sessions in ``hot`` are cut to slices; all others are one slice.

    Rows are shuffled once, by slice. The borders of a hot session's slices are then
    stitched; they are read from the same shuffle.
    """
    prefix = next(n for least, n in _PREFIXES if slice_seconds >= least)
    rows = rows.join(hot, _is_hot(["session_id"]), "left").select(
        *rows.columns, F.col("_hot").isNotNull().alias("_cut"),
        F.when(F.col("_hot"), F.substring("action_time", 1, prefix)).alias("_slice"))
    groups = ["session_id", "_slice"]
    large = _groups_above(rows.where("_cut"), groups, hot_rows)
    if large is not None:
        rows = rows.join(large, F.col("_cut") & _is_hot(groups), "left").select(
            *rows.columns, F.when(F.col("_hot"), F.col("action_time")).alias("_sub_t"),
            F.when(F.col("_hot"), floor_div(F.col("_tie"), sub_tie_rows)).alias("_sub_k"))
        groups = [*groups, "_sub_t", "_sub_k"]
    # Shuffle on all group keys: a shuffle join on fewer would otherwise satisfy
    # the window and keep each hot session or slice in one task.
    rows = rows.repartition(*groups)
    order = [F.col("action_time"), F.col("_tie")]
    w_slice = Window.partitionBy(*groups).orderBy(*order)
    marked = rows.select(
        "*",
        F.lead("page_id").over(w_slice).alias("_next_page"),
        F.lead("t_ms").over(w_slice).alias("_next_t"),
        F.lead(F.lit(True)).over(w_slice).isNull().alias("_last"),
        (F.row_number().over(w_slice) == 1).alias("_first"),
    )
    inner = marked.where(~F.col("_last") | ~F.col("_cut")).select(
        *_step(F.col("_next_page"), F.col("_next_t"), ~F.col("_last")))
    w_session = Window.partitionBy("session_id").orderBy(*order)
    borders = (marked.where(F.col("_cut") & (F.col("_first") | F.col("_last")))
               .select("session_id", "action_time", "_tie", "page_id", "t_ms", "_last"))
    tails = borders.select(
        "*", F.lead("page_id").over(w_session).alias("_next_page"), F.lead("t_ms").over(w_session).alias("_next_t"),
        F.lead(F.lit(True)).over(w_session).isNotNull().alias("_more")).where(F.col("_last"))
    return inner.unionByName(tails.select(*_step(F.col("_next_page"), F.col("_next_t"), F.col("_more"))))


def session_successors(visits: DataFrame, slice_seconds: int = DEFAULT_SLICE_SECONDS,
                       tie_col: str | None = None, hot_rows: int | None = None,
                       sub_tie_rows: int = DEFAULT_SUB_TIE_ROWS) -> DataFrame:
    """Every action of a session with the action that follows it, exactly once.

    Output: ``session_id, event_id, page_from, page_to, t_from_ms, t_to_ms,
    has_next`` (``event_id`` is the tie key of the action; ``page_to`` and
    ``t_to_ms`` are null and ``has_next`` false for a session's last action).
    Order within a session is the string ``action_time`` then the tie key
    (``event_id`` if present, else ``page_id``); the reference left equal
    seconds in arbitrary order. A time that does not parse takes its place by
    its string, a null time comes first; both have a null ``t_..._ms``.

    A session with more than ``hot_rows`` actions (one narrow counting pass
    finds them) is cut by ``slice_seconds``, rounded down to a day, an hour, a
    minute or a second, and further where a slice is as large, down to
    ``sub_tie_rows`` tie values of one time string.
    """
    tie = tie_col or ("event_id" if "event_id" in visits.columns else "page_id")
    hot_rows = DEFAULT_HOT_ROWS if hot_rows is None else hot_rows
    rows = visits.select("session_id", "action_time", F.col(tie).alias("_tie"), "page_id",
                         parse_time_ms(F.col("action_time")).alias("t_ms"))
    hot = _groups_above(visits.select("session_id"), ["session_id"], hot_rows)
    if hot is None:
        return _by_session(rows)
    return _by_slices(rows, hot, slice_seconds, hot_rows, sub_tie_rows)


def session_steps(visits: DataFrame, slice_seconds: int = DEFAULT_SLICE_SECONDS,
                  tie_col: str | None = None, hot_rows: int | None = None,
                  sub_tie_rows: int = DEFAULT_SUB_TIE_ROWS) -> DataFrame:
    """Every pair of consecutive actions of a session (W3, J4): ``session_id,
    event_id, page_from, page_to, t_from_ms, t_to_ms``."""
    return (session_successors(visits, slice_seconds, tie_col, hot_rows, sub_tie_rows)
            .where(F.col("has_next")).drop("has_next"))
