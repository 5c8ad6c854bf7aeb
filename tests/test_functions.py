from pyspark.sql import functions as F

from clickpath.functions import (floor_10s_text, floor_seconds, format_time, is_not_empty,
                                 java_split, java_split_lines_words, json_field, parse_time_ms,
                                 ranked_map_json, substring0)


def one(spark, value, fn, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(fn(F.col("v")).alias("r")).first()["r"]


def test_java_split_id_lists(spark):
    # mf_id_lists: '', ',,', 'a,,b,,', ',a', null -> 1, 0, 3, 2, 0 ids
    cases = {"": [""], ",,": [], "a,,b,,": ["a", "", "b"], ",a": ["", "a"], "1,2": ["1", "2"]}
    for s, want in cases.items():
        assert one(spark, s, lambda c: java_split(c, ",")) == want, s
    assert one(spark, None, lambda c: java_split(c, ",")) is None


def test_java_split_regex_chars_and_line_ends(spark):
    assert one(spark, "a.b..", lambda c: java_split(c, ".")) == ["a", "b"]
    # a trailing line terminator is a field, not a place to strip at
    assert one(spark, "a b \r", lambda c: java_split(c, " ")) == ["a", "b", "\r"]


def test_words_of_text(spark):
    text = "a  b \n   \n\nc"
    assert one(spark, text, java_split_lines_words) == ["a", "", "b", "", "c"]


def test_is_not_empty_java_trim(spark):
    for s, want in [(None, False), ("", False), (" ", False), ("\t\n", False),
                    ("\x01 ", False), ("a", True), (" a ", True), ("\u00a0", True)]:
        assert one(spark, s, is_not_empty) is want, repr(s)


def test_time_format_parse_floor(spark):
    ts = 1704067207179  # 2024-01-01 00:00:07.179 UTC
    assert one(spark, ts, format_time, "bigint") == "2024-01-01 00:00:07"
    assert one(spark, ts, lambda c: format_time(c, "yyyy-MM-dd"), "bigint") == "2024-01-01"
    assert one(spark, "2024-01-01 00:00:07", parse_time_ms) == 1704067207000
    assert one(spark, "not a time", parse_time_ms) is None
    assert one(spark, "2024-01-01 00:00:07", floor_10s_text) == "2024-01-01 00:00:00"
    assert one(spark, ts, lambda c: floor_seconds(c, 10), "bigint") == 1704067200
    assert one(spark, -1, lambda c: floor_seconds(c, 10), "bigint") == -10


def test_substring_and_json(spark):
    assert one(spark, "2024-01-01 13:00:07", lambda c: substring0(c, 11, 13)) == "13"
    assert one(spark, '{"k": 69}', lambda c: json_field(c, "k")) == "69"
    assert one(spark, '{"k": 69}', lambda c: json_field(c, "x")) is None


def test_ranked_map_json_keeps_rank_order(spark):
    # mf_json: keys come out in rank order, not key order
    df = spark.createDataFrame([(1, 2, 16), (2, 1, 15), (3, 6, 14)], "rk bigint, ad bigint, n bigint")
    out = df.agg(ranked_map_json(F.collect_list(F.struct("rk", "ad", "n")), "rk", "ad", "n")
                 .alias("j")).first()["j"]
    assert out == '{"2":16,"1":15,"6":14}'
