"""Row filters and predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NO_CLICK = -1  # sentinel for "no click" in click_category_id / click_product_id


def bound_is_set(value: str | None) -> bool:
    """Python side of F2 for parameters: not None and not blank after Java trim."""
    return value is not None and any(ord(ch) > 0x20 for ch in value)


def date_range(df: DataFrame, start: str | None = None, end: str | None = None,
               col: str = "date") -> DataFrame:
    """Inclusive range on a ``yyyy-MM-dd`` string column (F1).

    Blank or absent bounds mean no filter. Bounds are literals, never pasted SQL,
    and the comparison is on the string as in the reference, so it pushes down to
    the scan (and prunes files of a table partitioned by date).
    """
    if bound_is_set(start):
        df = df.where(F.col(col) >= F.lit(start))
    if bound_is_set(end):
        df = df.where(F.col(col) <= F.lit(end))
    return df


def has_click(c: Column | str = "click_category_id") -> Column:
    """True for rows with a click; a null id counts as no click."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNotNull() & (c != F.lit(NO_CLICK))  # two plain predicates: both reach the scan


def click_rows(visits: DataFrame) -> DataFrame:
    """Only the click actions."""
    return visits.where(has_click())


def action_kind() -> Column:
    """``click``, else ``order``, else ``pay``, else null: one kind per row."""
    return (F.when(has_click(), F.lit("click"))
            .when(F.col("order_category_ids").isNotNull(), F.lit("order"))
            .when(F.col("pay_category_ids").isNotNull(), F.lit("pay")))
