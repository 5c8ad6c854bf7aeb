"""Sharding by a k-d tree over document metadata.

Equal texts form one group and stay together. The tree splits the groups again
and again at the weighted median of the dimension that is widest in a node, until
each leaf holds the target bytes; leaves are the shards. A group that fills a shard
can get one of its own first, so that it takes no part in the halving. Medians are found by
counting: each round sums the weights of a fixed number of bins for all nodes of
a level at once, keeps the bin that the median falls into, and bins it anew. The
driver sees one row for each node of a level. Each pass finds the nodes of the stored
groups from the cuts above, and every fourth level is stored, so plans stay short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickpath.llm import common

SHARDS = 8

# Bins of a node in one counting round.
BINS = 1024

# A median is finished group by group once its bin holds so many or fewer.
FINISHED = 2000

# Levels whose cuts a pass applies to the groups before these are stored with their nodes.
STORED_LEVELS = 4

# Metadata of a group, in order of preference where two are equally wide.
DIMENSIONS = ["n_bytes", "source_code", "lang_code", "first_id"]

# Stands for the null doc_id of a group whose ids are all null.
NO_ID = -1


def _documents(docs: DataFrame) -> DataFrame:
    """The small columns that sharding needs; the text is read once."""
    text = F.coalesce("text", F.lit(""))
    have = {c.lower() for c in docs.columns}
    code = lambda c: F.crc32(F.coalesce(F.col(c).cast("string"), F.lit(""))) if c in have else F.lit(0)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.md5(text).alias("digest"),
        code("source").cast("long").alias("source_code"), code("lang").cast("long").alias("lang_code"))


def _groups(rows: DataFrame) -> DataFrame:
    """One row per distinct text: its weight, its metadata and an even tie-break number."""
    return rows.groupBy("digest").agg(
        F.sum("size").alias("weight"), F.first("size").alias("n_bytes"), F.min("source_code").alias("source_code"),
        F.min("lang_code").alias("lang_code"), F.coalesce(F.min("doc_id"), F.lit(NO_ID).cast("long")).alias("first_id"),
    ).withColumn("tie", F.conv(F.substring("digest", 1, 15), 16, 10).cast("long"))


def _descend(groups: DataFrame, splits: list[dict]) -> DataFrame:
    """Move the groups of split nodes to a child: node 2n holds what is at or below the split, 2n + 1 the rest."""
    if not splits:
        return groups
    table = groups.sparkSession.createDataFrame(  # a row for each split node, at most as many as shards
        [(s["node"], s["dim"], s["value"], s["tie"]) for s in splits],
        "node long, dim string, cut_value long, cut_tie long")
    value = F.coalesce(*(F.when(F.col("dim") == d, F.col(d)) for d in DIMENSIONS))
    below = (value < F.col("cut_value")) | ((value == F.col("cut_value")) & (F.col("tie") <= F.col("cut_tie")))
    moved = groups.join(F.broadcast(table), "node", "left")
    return moved.withColumn("node", F.when(F.col("dim").isNull(), F.col("node")).otherwise(
        2 * F.col("node") + F.when(below, 0).otherwise(1))).drop("dim", "cut_value", "cut_tie")


def _medians(groups: DataFrame, nodes: list[dict]) -> list[dict]:
    """Adds to each node (node, dim, shares, weight) the split (value, tie).

    In order of (value, tie) a group goes below the split while twice the weight
    up to and with it, less its own, is within twice the share of the weight that
    the lower child is to hold: the cut nearest to that share. Bins and groups are summed up
    on the executors; one row for each node comes back.
    """
    spark: SparkSession = groups.sparkSession
    exact = lambda c: (F.col(c) if isinstance(c, str) else c).cast("decimal(38,0)")
    goal = exact("total") * F.floor(F.col("shares") / 2).cast("decimal(10,0)")

    def in_range(of: list[dict]) -> DataFrame:
        """The groups of some nodes whose key x lies in the node's range."""
        table = spark.createDataFrame([(n["node"], n["dim"], n["key"], n["low"], n["high"], n.get("at"), n["before"], n["weight"], n["shares"]) for n in of],
                                      "node long, dim string, key string, low long, high long, at long, before long, total long, shares long")
        rows = groups.join(F.broadcast(table), "node")  # a row for each node of a level, fewer than shards
        rows = rows.withColumn("value", F.coalesce(*(F.when(F.col("dim") == d, F.col(d)) for d in DIMENSIONS)))
        rows = rows.withColumn("x", F.when(F.col("key") == "value", F.col("value")).otherwise(F.col("tie")))
        return rows.filter(F.col("x").between(F.col("low"), F.col("high")) & (F.col("at").isNull() | (F.col("value") == F.col("at"))))

    todo = [n | {"key": "value", "low": n["least"], "high": n["most"], "before": 0} for n in nodes]
    done = []
    while todo:
        step = F.floor((F.col("high") - F.col("low")) / BINS).cast("long") + 1
        bins = in_range(todo).groupBy("node", "before", "total", "shares", ((F.col("x") - F.col("low")) / step).cast("long").alias("bin")).agg(
            F.sum("weight").alias("w"), F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        by_bin = Window.partitionBy("node").orderBy("bin")  # at most BINS rows
        summed = bins.withColumn("upto", F.col("before") + F.sum("w").over(by_bin))
        # The first bin that reaches the goal, or else the last.
        reached = exact("upto") * exact("shares") >= goal
        chosen = summed.groupBy("node").agg(F.coalesce(
            F.min(F.when(reached, F.struct("bin", "w", "n", "lo", "hi", "upto"))), F.max(F.struct("bin", "w", "n", "lo", "hi", "upto"))).alias("b"))
        found = {r["node"]: r["b"] for r in chosen.collect()}
        small = []
        for n in todo:
            last = found[n["node"]]
            n |= {"low": last["lo"], "high": last["hi"], "before": last["upto"] - last["w"]}
            if last["n"] <= FINISHED:
                small.append(n)
            elif n["key"] == "value" and last["lo"] == last["hi"]:
                n |= {"key": "tie", "at": last["lo"], "low": 0, "high": (1 << 60) - 1}
        if small:
            in_order = Window.partitionBy("node").orderBy("value", "tie")  # at most FINISHED rows
            rows = in_range(small).withColumn("upto", F.col("before") + F.sum("weight").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
            below = exact(F.col("upto") * 2 - F.col("weight")) * exact("shares") <= goal * 2
            cuts = {r["node"]: r["cut"] for r in rows.filter(below).groupBy("node").agg(F.max(F.struct("value", "tie")).alias("cut")).collect()}
            for n in small:
                none = (n["low"] - 1, 0) if n["key"] == "value" else (n["at"], n["low"] - 1)
                value, tie = cuts.get(n["node"], none)
                done.append(n | {"value": value, "tie": tie})
        todo = [n for n in todo if n not in small]
    return done


def assign(groups: DataFrame, shards: int) -> DataFrame:
    """``groups`` (weight, tie and the dimensions) with the shard of each row."""
    spans = groups.agg(*(F.min(d).alias(f"min_{d}") for d in DIMENSIONS), *(F.max(d).alias(f"max_{d}") for d in DIMENSIONS)).first()
    whole = {d: (spans[f"max_{d}"] or 0) - (spans[f"min_{d}"] or 0) or 1 for d in DIMENSIONS}
    placed = groups.withColumn("node", F.lit(1).cast("long"))
    open_nodes, leaves, level = {1: shards}, {}, 0
    while open_nodes:
        leaves |= {n: k for n, k in open_nodes.items() if k == 1}
        open_nodes = {n: k for n, k in open_nodes.items() if k > 1}
        if not open_nodes:
            break
        stats = placed.groupBy("node").agg(
            F.sum("weight").alias("weight"), *(F.min(d).alias(f"min_{d}") for d in DIMENSIONS),
            *(F.max(d).alias(f"max_{d}") for d in DIMENSIONS)).collect()  # a row for each node, at most as many as shards
        nodes = []
        for r in stats:
            if r["node"] in open_nodes:
                dim = max(DIMENSIONS, key=lambda d: ((r[f"max_{d}"] - r[f"min_{d}"]) / whole[d], -DIMENSIONS.index(d)))
                nodes.append({"node": r["node"], "dim": dim, "shares": open_nodes[r["node"]], "weight": r["weight"],
                              "least": r[f"min_{dim}"], "most": r[f"max_{dim}"]})
        placed, level = _descend(placed, _medians(placed, nodes)), level + 1
        if level % STORED_LEVELS == 0:
            placed = common.materialise(placed, "shard-level")
        open_nodes = {c: k for n, s in open_nodes.items() for c, k in ((2 * n, s // 2), (2 * n + 1, s - s // 2))}
    numbers = groups.sparkSession.createDataFrame(
        [(n, i) for i, n in enumerate(sorted(leaves, key=lambda n: bin(n)[2:]))], "node long, shard int")
    return placed.join(F.broadcast(numbers), "node")


def _alone(groups: DataFrame, shards: int, total: int) -> list[str]:
    """The digests of the groups that get a shard of their own, the heaviest first.

    These are the groups of at least an equal part of the bytes that are left for
    the shards that are left, until there is none or one shard is left.
    """
    found: list[str] = []
    least = None
    while len(found) < shards - 1:
        left = shards - len(found)
        target = -(-total // left)
        heavy = groups.filter(F.col("weight") >= target)
        if least is not None:  # those above are found already
            heavy = heavy.filter(F.col("weight") < least)
        rows = heavy.orderBy(F.desc("weight"), "tie", "digest").limit(left - 1).select("digest", "weight").collect()  # fewer rows than shards
        if not rows:
            break
        found += [r["digest"] for r in rows]
        total, least = total - sum(r["weight"] for r in rows), target
    return found


def shard(docs: DataFrame, target_bytes: int | None = None, shards: int | None = None, alone: bool = True) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Give the target bytes of a leaf, or the number of shards (their target is an
    equal part of all bytes); a node of k targets' bytes is split at the fraction
    (k // 2) / k of its weight. With ``alone``, as by default, each group of at least the target bytes
    first gets a shard of its own, numbered after the tree's, and the rest is split into
    the other shards with the target that is left. Without, such a group keeps the shares
    of its side of the tree, so shards beside it may be empty or uneven. ``size`` is the text's UTF-8 bytes plus one, so a
    null text weighs 1; null and empty texts are equal. The law is ``bytes``:
    sizes are near equal, with ``alone`` as near as whole groups of equal texts
    and cuts along one dimension at a time allow. ``slot`` numbers a shard's rows from 0 in
    order of an MD5 of the id. ``grown_shard`` is null under this law. Rows that
    repeat are kept; a null doc_id, source or lang is a value like any other, and
    a table without source or lang is split on the rest. An empty table gives no rows.
    """
    rows = common.materialise(_documents(docs), "shard-rows")
    groups = common.materialise(_groups(rows), "shard-groups")
    total = groups.agg(F.sum("weight")).first()[0] or 1
    if shards is None:
        shards = max(1, -(-total // (target_bytes or total)))
    own = _alone(groups, shards, total) if alone else []
    if own:
        first = shards - len(own)
        table = groups.sparkSession.createDataFrame([(d, first + k) for k, d in enumerate(own)], "digest string, shard int")
        rest = groups.join(F.broadcast(table), "digest", "left_anti")
        placed = assign(rest, first).select("digest", "shard").union(table)
    else:
        placed = assign(groups, shards).select("digest", "shard")
    # Joined twice by ``gapless``, from the stored rows and groups.
    numbered = rows.join(placed, "digest").select("doc_id", "size", "text_crc32", "shard", "digest")
    return common.gapless(numbered, ["shard"], ["doc_id", "digest"], "slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
