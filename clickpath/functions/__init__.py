"""Scalar Column helpers; all built-in Spark expressions (no Python UDFs)."""

from clickpath.functions.jsonfmt import json_field, ranked_map_json
from clickpath.functions.strings import (concat_key, is_not_empty, java_split,
                                         java_split_lines_words, substring0)
from clickpath.functions.timefmt import (DATE_FMT, TIME_FMT, civil_days, floor_10s_text, floor_div, floor_seconds,
                                         format_date, format_time, parse_time_lenient_ms, parse_time_ms)

__all__ = [
    "DATE_FMT", "TIME_FMT", "civil_days", "concat_key", "floor_10s_text", "floor_div", "floor_seconds", "format_date",
    "format_time", "is_not_empty", "java_split", "java_split_lines_words", "json_field",
    "parse_time_lenient_ms", "parse_time_ms", "ranked_map_json", "substring0",
]
