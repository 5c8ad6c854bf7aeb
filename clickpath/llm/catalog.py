"""The queries of this subpackage and, where SQL can express them, their DuckDB SQL.

Each query applies one operator with production parameters to its whole table
and derives the columns of its contract from the operator's result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clickpath.llm import (decontaminate, filter_audit, language, packing, prefix_trie, quality, sharding, simhash, suffix_dedup, token_files,
                           tool_calls, warc, weighted_minhash)
from clickpath.llm.common import materialise, read
from clickpath.session import new_work_dir

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.classify(docs, read(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(read(spark, sf_dir, "documents"), with_kept=False).drop("kept")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = language.fit(docs)
    return language.identify(docs.select("doc_id", "text"), model).select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read(spark, sf_dir, "documents"), shards=sharding.SHARDS)


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_minhash.fingerprints(read(spark, sf_dir, "documents"))


def op7_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = tool_calls.from_conversations(read(spark, sf_dir, "conversations"))
    return tool_calls.link(calls, results, tool_calls.SCHEMAS)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), with_ids=False).drop("ids")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_work_dir(spark, "token-files") + "/ids"
    token_files.write(read(spark, sf_dir, "documents"), path)
    return token_files.read(spark, path, with_ids=False).drop("ids")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_work_dir(spark, "warc") + "/archives"
    warc.write(read(spark, sf_dir, "pages"), path)
    return warc.captures(materialise(warc.read(spark, path, with_payload=False), "warc-records"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.shared_prefixes(read(spark, sf_dir, "conversations"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(spark, f"{sf_dir.rstrip('/')}/documents.parquet", read(spark, sf_dir, "labels"))


QUERIES: dict[str, Query] = {
    "op1_quality": op1_quality,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_language": op3_language,
    "op4_decontaminate": op4_decontaminate,
    "op5_sharding": op5_sharding,
    "op6_fingerprints": op6_fingerprints,
    "op7_tool_calls": op7_tool_calls,
    "op8_packing": op8_packing,
    "op9_token_files": op9_token_files,
    "op10_simhash": op10_simhash,
    "op11_warc": op11_warc,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_filter_audit": op13_filter_audit,
}

ORACLE_SQL: dict[str, str] = {
    "op4_decontaminate": decontaminate.oracle_sql(),
    "op7_tool_calls": tool_calls.oracle_sql(),
    "op11_warc": warc.oracle_sql(),
    "op12_prefix_trie": prefix_trie.oracle_sql(),
    "op13_filter_audit": filter_audit.oracle_sql(),
}
