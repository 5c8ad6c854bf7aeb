"""JSON Column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_field(c: Column, key: str) -> Column:
    """Top-level field of a JSON object as a string; missing -> null."""
    return F.get_json_object(c, f"$.{key}")


def ranked_map_json(entries: Column, rank: str, key: str, value: str) -> Column:
    """Compact JSON object of ``key: value`` with keys in ``rank`` order (X11).

    ``entries`` is an array of structs holding ``rank``, ``key`` and ``value``;
    a Spark map keeps insertion order, so ``to_json`` writes keys by rank.
    """
    ordered = F.array_sort(F.transform(
        entries, lambda e: F.struct(e[rank].alias("r"), e[key].cast("string").alias("k"),
                                    e[value].alias("v"))))
    return F.to_json(F.map_from_entries(
        F.transform(ordered, lambda e: F.struct(e["k"].alias("key"), e["v"].alias("value")))))
