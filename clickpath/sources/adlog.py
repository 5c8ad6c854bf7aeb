"""Ad-click log lines: ``"<epoch ms> <area> <city> <user id> <ad id>"``.

The reference splits each line on one space (Java rule: trailing empty fields
dropped) and takes fields 0-4; a short line fails its whole batch. Here a line
that does not give five fields with numeric time/user/ad goes to a reject
output instead, so one bad producer cannot stop the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpath.functions import DATE_FMT, format_time, java_split

FIELD_SEP = " "
N_FIELDS = 5


def _fields(value: F.Column) -> F.Column:
    return java_split(value, FIELD_SEP)


def _parsed(lines: DataFrame, value_col: str) -> DataFrame:
    """The typed fields of each line plus ``_ok`` (five fields, numbers parse)."""
    split = lines.select("*", _fields(F.col(value_col)).alias("_f"))
    f = F.col("_f")
    ts_ms = F.get(f, 0).try_cast("bigint")
    user_id = F.get(f, 3).try_cast("bigint")
    ad_id = F.get(f, 4).try_cast("bigint")
    ok = (F.coalesce(F.size(f) >= N_FIELDS, F.lit(False))
          & ts_ms.isNotNull() & user_id.isNotNull() & ad_id.isNotNull())
    return split.select("*", ts_ms.alias("ts_ms"), F.get(f, 1).alias("area"),
                        F.get(f, 2).alias("city"), user_id.alias("user_id"),
                        ad_id.alias("ad_id"), ok.alias("_ok"))


def parse_ad_log(lines: DataFrame, value_col: str = "value", keep: tuple = ()) -> DataFrame:
    """Good lines as typed clicks with their ``date`` (UTC); extra fields are ignored.

    ``keep`` names input columns to carry through (e.g. a batch id).
    """
    return (_parsed(lines, value_col).where(F.col("_ok"))
            .select(*keep, "ts_ms", "area", "city", "user_id", "ad_id",
                    format_time(F.col("ts_ms"), DATE_FMT).alias("date")))


def reject_ad_log(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Lines the parser cannot use, unchanged, for a dead-letter sink."""
    return _parsed(lines, value_col).where(~F.col("_ok")).select(value_col)


def format_ad_log(clicks: DataFrame) -> F.Column:
    """The log line of a click row (inverse of ``parse_ad_log``).

    Spaces inside area/city would shift the fields on parse, so they become ``-``.
    """
    def clean(c: str) -> F.Column:
        return F.regexp_replace(F.col(c), " ", "-")
    return F.concat_ws(FIELD_SEP, F.col("ts_ms").cast("string"), clean("area"), clean("city"),
                       F.col("user_id").cast("string"), F.col("ad_id").cast("string"))


def publish_lines(lines: DataFrame, path: str, value_col: str = "value") -> None:
    """Write lines as text files (the batch stand-in for producing to a topic, S7)."""
    lines.select(F.col(value_col).alias("value")).write.mode("overwrite").text(path)


def publish_kafka(lines: DataFrame, bootstrap_servers: str, topic: str, value_col: str = "value") -> None:
    """Produce lines to a Kafka topic, one record each.

    Needs the Spark Kafka connector on the classpath; untested here, where there is none.
    """
    (lines.select(F.col(value_col).cast("string").alias("value")).write.format("kafka")
     .option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic).save())
