"""Category funnel reports (R1: top-10 categories, R2: top-10 sessions per category).

A1 per (category, kind) counts, A2 pivot, O1 ordered top-k, A3 per (category,
session) clicks, J1 semi filter by the top list, W1 per-category top-k.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpath.functions import java_split
from clickpath.sources.tables import broadcast_if_small
from clickpath.operators.filters import action_kind, has_click
from clickpath.operators.topk import top_k_per_group

KINDS = ("click", "order", "pay")
# Fixed values (the reference's defaults): top 10 categories, top 10 sessions each.
TOP_CATEGORIES = 10
TOP_SESSIONS = 10


def category_events(visits: DataFrame) -> DataFrame:
    """One row per (category id, kind) occurrence (A1 input, X6).

    A click row gives its click category; an order/pay row gives each id of its
    comma list (Java split rule, so ``"a,,b"`` gives an empty id too).
    """
    kind = F.col("kind")
    ids = (F.when(kind == "click", F.array(F.col("click_category_id").cast("string")))
           .when(kind == "order", java_split(F.col("order_category_ids"), ","))
           .when(kind == "pay", java_split(F.col("pay_category_ids"), ",")))
    return (visits.select(action_kind().alias("kind"), "click_category_id",
                          "order_category_ids", "pay_category_ids")
            .where(kind.isNotNull())
            .select("kind", F.explode(ids).alias("category_id")))


def category_metric_counts(visits: DataFrame) -> DataFrame:
    """(category_id, kind, n) (A1). Partial aggregation runs before the shuffle."""
    return (category_events(visits).groupBy("category_id", "kind")
            .agg(F.count(F.lit(1)).alias("n")))


def category_metrics(visits: DataFrame) -> DataFrame:
    """(category_id, click_count, order_count, pay_count), missing = 0 (A2).

    One aggregation with three conditional counts: no second shuffle for the pivot.
    """
    kind = F.col("kind")
    return (category_events(visits).groupBy("category_id")
            .agg(*[F.count_if(kind == k).alias(f"{k}_count") for k in KINDS]))


def category_top10(visits: DataFrame, k: int = TOP_CATEGORIES,
                   task_id: str | None = None) -> DataFrame:
    """Top-k categories by click, then order, then pay count; ties by id.

    ``orderBy().limit()`` plans as ``TakeOrderedAndProject``: each task keeps k rows.
    """
    top = (category_metrics(visits)
           .orderBy(F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"),
                    F.asc("category_id"))
           .limit(k))
    if task_id is not None:
        top = top.select(F.lit(task_id).alias("task_id"), *top.columns)
    return top


def category_session_clicks(visits: DataFrame) -> DataFrame:
    """(category_id, session_id, click_count) over click rows."""
    return (visits.where(has_click())
            .groupBy(F.col("click_category_id").cast("string").alias("category_id"), "session_id")
            .agg(F.count(F.lit(1)).alias("click_count")))


def clicks_in_categories(visits: DataFrame, categories: DataFrame) -> DataFrame:
    """Click rows whose category is in ``categories``.

    A top-k list is broadcast (its planned size is bounded by ``LIMIT k``): a
    map-side semi join, no shuffle of the clicks. A larger list passed here
    fails the size check and the planner picks the join.
    """
    clicks = (visits.where(has_click())
              .withColumn("category_id", F.col("click_category_id").cast("string")))
    return clicks.join(broadcast_if_small(categories.select("category_id")), "category_id",
                       "left_semi")


def category_top10_sessions(visits: DataFrame, k_categories: int = TOP_CATEGORIES,
                            k_sessions: int = TOP_SESSIONS,
                            task_id: str | None = None) -> DataFrame:
    """Top sessions by clicks within each top category (R2, W1); ties by session id."""
    top = category_top10(visits, k_categories)
    counts = (clicks_in_categories(visits, top)
              .groupBy("category_id", "session_id").agg(F.count(F.lit(1)).alias("click_count")))
    ranked = top_k_per_group(counts, ["category_id"],
                             [F.desc("click_count"), F.asc("session_id")], k_sessions)
    if task_id is not None:
        ranked = ranked.select(F.lit(task_id).alias("task_id"), *ranked.columns)
    return ranked
