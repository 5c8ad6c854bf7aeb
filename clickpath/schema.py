"""Fixed row schemas of the inputs and results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# One row per page action of a user session. Exactly one action kind per row:
# click ids are -1 when there is no click; id lists are comma-joined or null.
VISIT_ACTION = T.StructType([
    T.StructField("date", T.StringType()),            # yyyy-MM-dd
    T.StructField("user_id", T.LongType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("page_id", T.LongType()),
    T.StructField("action_time", T.StringType()),     # yyyy-MM-dd HH:mm:ss
    T.StructField("search_keyword", T.StringType()),
    T.StructField("click_category_id", T.LongType()),
    T.StructField("click_product_id", T.LongType()),
    T.StructField("order_category_ids", T.StringType()),
    T.StructField("order_product_ids", T.StringType()),
    T.StructField("pay_category_ids", T.StringType()),
    T.StructField("pay_product_ids", T.StringType()),
    T.StructField("city_id", T.LongType()),
])

CATEGORY_TOP10 = T.StructType([
    T.StructField("task_id", T.StringType()),
    T.StructField("category_id", T.StringType()),
    T.StructField("click_count", T.LongType()),
    T.StructField("order_count", T.LongType()),
    T.StructField("pay_count", T.LongType()),
])

CATEGORY_TOP10_SESSION = T.StructType([
    T.StructField("task_id", T.StringType()),
    T.StructField("category_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("click_count", T.LongType()),
])


def conform(df: DataFrame, schema: T.StructType, keep_extra: bool = False) -> DataFrame:
    """Select the schema's columns with casts, in schema order.

    Missing columns are an error (a wrong table is caught early); extra columns
    are dropped unless ``keep_extra``.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    if keep_extra:
        names = {f.name for f in schema.fields}
        cols += [F.col(c) for c in df.columns if c not in names]
    return df.select(*cols)
