"""Word count of text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpath.functions import java_split


def word_count(texts: DataFrame, text_col: str = "text", lines: bool = False) -> DataFrame:
    """(word, n) over whole texts.

    Each text is cut at ``\\n`` into lines (``lines=True``: the column already holds
    one line), and each line on one space by the Java rule, so inner empty words
    count and trailing ones do not. Two chained explodes stay in generated code;
    partial aggregation merges hot words before the shuffle.
    """
    line = F.col(text_col)
    if not lines:
        texts = texts.select(F.explode(F.split(line, "\n")).alias(text_col))
    return (texts.select(F.explode(java_split(line, " ")).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))
