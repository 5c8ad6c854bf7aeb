"""Tool-call linking for chat data.

Calls and results meet in a hash join by conversation and identifier. Calls are
put in topological order of what they wait for, their arguments are validated
against the tools' schemas, and each linked call is written as one line of
canonical JSON (keys sorted at every depth, no white space). Only DataFrame and
SQL functions are used; no conversation is ever gathered in one row or task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpath.llm import common

# {tool: {argument: (type, required)}}; types are string, integer, number, boolean, array and object.
Schemas = dict[str, dict[str, tuple[str, bool]]]

# How Spark names the type of a JSON value, by schema type.
VARIANT_TYPES = {"string": ["STRING"], "integer": ["BIGINT"], "number": ["BIGINT", "DOUBLE", "DECIMAL"],
                 "boolean": ["BOOLEAN"], "array": ["ARRAY"], "object": ["OBJECT"]}

# Calls with more waits than this are not looked through for needless ones.
LOOKED_THROUGH = 8


def identity(conversation: Column, identifier: Column) -> Column:
    """One key for a conversation and an identifier; null conversations are equal, a null identifier has none."""
    part = F.coalesce(conversation.cast("string"), F.lit("\x00"))
    return F.when(identifier.isNotNull(), F.md5(F.concat(part, F.lit("\x1f"), identifier)))


def canonical(json: Column) -> Column:
    """Canonical form of a JSON text; null if it isn't JSON or repeats a key."""
    return F.to_json(F.try_parse_json(json))


def argument_errors(tool: Column, arguments: Column, schemas: Schemas) -> Column:
    """What is wrong with a call's arguments, in a fixed order; an empty array if they are valid."""
    value = F.try_parse_json(arguments)
    names = F.coalesce(F.json_object_keys(arguments), F.array().cast("array<string>"))
    is_object = F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))
    found = F.when(F.col("call_errors_unknown"), F.array(F.lit("unknown tool")))
    for name, fields in sorted(schemas.items()):
        checks = []
        for field, (kind, required) in sorted(fields.items()):
            got = F.schema_of_variant(F.try_variant_get(value, f"$.{field}", "variant"))
            fits = F.lit(False)
            for t in VARIANT_TYPES[kind]:
                fits = fits | got.startswith(t)
            if required:
                checks.append(F.when(~F.array_contains(names, field), F.lit(f"missing {field}")))
            checks.append(F.when(F.array_contains(names, field) & ~F.coalesce(fits, F.lit(False)), F.lit(f"{field} is not {kind}")))
        extra = F.array_sort(F.array_except(names, F.array(*(F.lit(f) for f in sorted(fields)))))
        checks = F.concat(F.array_compact(F.array(*checks)), F.transform(extra, lambda x: F.concat(F.lit("unexpected "), x)))
        found = F.when(tool == name, F.when(is_object, checks).otherwise(F.array(F.lit("arguments are not an object")))) if found is None \
            else found.when(tool == name, F.when(is_object, checks).otherwise(F.array(F.lit("arguments are not an object"))))
    return found.otherwise(F.array().cast("array<string>"))


def _reduced(edges: DataFrame) -> DataFrame:
    """``edges`` without those that a longer way makes needless.

    A call needn't wait for j if it waits for a k that waits for j and stands behind j by turn, then key.
    Of the waits of a call that lie in one cycle the last is never dropped, so what can't be put in
    order without the dropped ones can't be with them, and levels stay as they are. Only
    calls of at most LOOKED_THROUGH waits are looked through, so the join gives no more
    rows for each edge than that.
    """
    few = edges.groupBy("key").agg(F.count(F.lit(1)).alias("waits")).filter(F.col("waits") <= LOOKED_THROUGH)
    few = common.materialise(edges.join(few.select("key"), "key").select(
        F.col("key").alias("to"), F.col("to").alias("beyond"), F.col("reach").alias("beyond_turn")), "call-ways")
    ways = edges.join(few, "to").filter((F.col("key") != F.col("to")) & (F.struct("beyond_turn", "beyond") < F.struct("reach", "to")))
    needless = ways.filter(F.col("key") != F.col("beyond")).select("key", F.col("beyond").alias("to")).distinct()
    return edges.join(needless, ["key", "to"], "left_anti")


def levels(calls: DataFrame) -> DataFrame:
    """(key, level, late) of each call (key, turn, after: array of keys) that can be put in order.

    Level 0 waits for no known call; any other is one above the highest it waits
    for, of whatever turn. Calls on a cycle, or behind one, have no row. ``late``
    calls wait, if only by way of others, for a call of a later turn.

    Needless waits are dropped first, so that calls which wait for the last few calls
    before them form a chain. Chains of calls that wait for one call each are shortened by doubling, so they take as
    many rounds as the logarithm of their length. Then each round follows the waits for the calls
    placed in the round before, adds them up in the calls that are still open, and places those
    whose waits are complete. Every round is stored, so none depends on the ones before it.
    """
    nodes = common.materialise(calls.groupBy("key").agg(F.min("turn").alias("turn")), "call-nodes")
    waits_for = calls.select("key", F.explode("after").alias("to")).filter(F.col("to").isNotNull()).distinct()
    known = waits_for.join(nodes.select(F.col("key").alias("to"), F.col("turn").alias("reach")), "to")
    edges = common.materialise(_reduced(common.materialise(known.select("key", "to", "reach"), "call-edges")), "call-edges")
    waits = common.materialise(edges.groupBy("key").agg(F.count(F.lit(1)).alias("waits")), "call-waits")
    # The call that each call with one wait leads to, in so many steps, and the latest turn on the way.
    chains = edges.join(waits.filter("waits = 1"), "key").select("key", "to", F.lit(1).alias("steps"), "reach")
    chains, unfinished = common.materialise(chains, "call-chains"), None
    while True:
        beyond = chains.select(F.col("key").alias("to"), F.col("to").alias("end"), F.col("steps").alias("more"), F.col("reach").alias("reach_on"))
        chains = common.materialise(chains.join(beyond, "to", "left").select(
            "key", F.coalesce("end", "to").alias("to"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
            F.greatest("reach", "reach_on").alias("reach"), F.col("end").isNotNull().alias("endless")), "call-chains")
        # A round ends some chain unless those that are left run into a cycle.
        was, unfinished = unfinished, chains.filter("endless").count()
        if unfinished in (0, was):
            break
    ends = chains.select(F.col("key").alias("to"), F.col("to").alias("end"), F.col("steps").alias("more"), F.col("reach").alias("reach_on"), "endless")
    forks = edges.join(waits.filter("waits > 1"), "key").join(ends, "to", "left").filter(~F.coalesce("endless", F.lit(False)))
    forks = common.materialise(forks.select(
        "key", F.coalesce("end", "to").alias("to"), (F.coalesce("more", F.lit(0)) + 1).alias("steps"), F.greatest("reach", "reach_on").alias("reach")), "call-forks")
    first = nodes.join(waits, "key", "left_anti").select("key", F.lit(0).alias("level"), F.lit(None).cast("long").alias("reach"))
    rounds = [common.materialise(first, "call-levels")]
    still = common.materialise(waits.filter("waits > 1").select(
        "key", F.col("waits").alias("open"), F.lit(0).alias("level"), F.lit(None).cast("long").alias("reach")), "open-calls")
    while True:
        newest = rounds[-1].select(F.col("key").alias("to"), "level", F.col("reach").alias("reach_on"))
        came = forks.join(newest, "to").groupBy("key").agg(
            F.count(F.lit(1)).alias("came"), F.max(F.col("level") + F.col("steps")).alias("up"), F.max(F.greatest("reach", "reach_on")).alias("far"))
        after = common.materialise(still.join(came, "key", "left").select(
            "key", (F.col("open") - F.coalesce("came", F.lit(0))).alias("open"), F.greatest("level", "up").alias("level"), F.greatest("reach", "far").alias("reach")), "open-calls")
        new = common.materialise(after.filter("open = 0").select("key", "level", "reach"), "call-levels")
        if new.isEmpty():
            break
        rounds.append(new)
        still = after.filter("open > 0")
    placed = rounds[0]
    for more in rounds[1:]:
        placed = placed.union(more)
    at = placed.select(F.col("key").alias("to"), "level", F.col("reach").alias("reach_on"))
    chained = chains.filter("NOT endless").join(at, "to").select(
        "key", (F.col("level") + F.col("steps")).alias("level"), F.greatest("reach", "reach_on").alias("reach"))
    return placed.union(chained).join(nodes, "key").select(
        "key", "level", F.coalesce(F.col("reach") > F.col("turn"), F.lit(False)).alias("late"))


def link(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """One row per call, and one per identifier that only results have.

    ``calls``: conv_id, turn, call_id, tool, arguments (JSON text), after (array of
    call_ids of the same conversation, or null). ``results``: conv_id, turn,
    call_id, content. Returns conv_id, call_id, turn, result_turn, level, status,
    errors, n_calls, n_results, line. The order of work is (level, turn, call_id).

    status is, the first that holds: ``orphan result`` (no call), ``no id`` (null
    call_id; never linked), ``out of order`` (waits, if only by way of others, for itself
    or for a call that does, and so has no level; or for a call of a later turn, which
    has a level above that call's), ``duplicate id`` (another call with the id comes first by turn, then
    arguments), ``invalid arguments``, ``no result``, ``early result`` (its turn
    isn't after the call's), ``ok``. Of several results the first by turn, then
    content, is linked; n_results counts them all. An identifier in ``after`` that
    no call has is not waited for. line is the canonical JSON, with the arguments
    as text if they aren't JSON. Repeated rows are duplicates of each other that
    stay apart; empty tables give no rows; other columns are ignored.
    """
    calls = calls.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("call_id").cast("string").alias("call_id"), "tool", "arguments", "after")
    calls = calls.withColumn("key", identity(F.col("conv_id"), F.col("call_id")))
    calls = calls.withColumn("after", F.transform(F.coalesce("after", F.array().cast("array<string>")), lambda a: identity(F.col("conv_id"), a)))
    results = results.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("call_id").cast("string").alias("call_id"), "content")
    results = results.withColumn("key", identity(F.col("conv_id"), F.col("call_id")))
    first_result = results.groupBy("key", "conv_id", "call_id").agg(
        F.min(F.struct("turn", "content")).alias("result"), F.count(F.lit(1)).alias("n_results"))
    known = calls.filter(F.col("key").isNotNull())
    lead = known.groupBy("key").agg(F.min(F.struct("turn", "arguments")).alias("lead"), F.count(F.lit(1)).alias("n_calls"))
    order = levels(known.select("key", "turn", "after"))
    linked = first_result.filter(F.col("key").isNotNull()).select("key", "result", "n_results", F.lit(True).alias("has_result"))
    # Stored, so that a hot identifier's calls meet plain shuffles that can be split.
    facts = common.materialise(lead.join(order, "key", "left").join(linked, "key", "left"), "call-facts")
    rows = calls.drop("after").join(facts, "key", "left")
    rows = rows.withColumn("call_errors_unknown", ~F.coalesce(F.col("tool").isin(*schemas), F.lit(False)))
    rows = rows.withColumn("errors", argument_errors(F.col("tool"), F.col("arguments"), schemas))
    same = F.struct("turn", "arguments").eqNullSafe(F.col("lead"))
    rows = rows.withColumn("status", F.when(F.col("key").isNull(), "no id").when(F.col("level").isNull() | F.col("late"), "out of order")
                           .when(~same, "duplicate id").when(F.size("errors") > 0, "invalid arguments")
                           .when(F.col("has_result").isNull(), "no result").when(F.col("result.turn") <= F.col("turn"), "early result").otherwise("ok"))
    orphans = first_result.join(lead.select("key"), "key", "left_anti").select(
        "conv_id", "call_id", F.lit(None).cast("long").alias("turn"), F.col("result.turn").alias("result_turn"), F.lit(None).cast("int").alias("level"),
        F.lit("orphan result").alias("status"), F.array().cast("array<string>").alias("errors"), F.lit(0).cast("long").alias("n_calls"), "n_results",
        F.lit(None).cast("string").alias("tool"), F.lit(None).cast("string").alias("arguments"), F.col("result.content").alias("content"))
    whole = rows.select("conv_id", "call_id", "turn", F.col("result.turn").alias("result_turn"), "level", "status", "errors",
                        F.coalesce("n_calls", F.lit(1)).alias("n_calls"), F.coalesce("n_results", F.lit(0)).alias("n_results"),
                        "tool", "arguments", F.col("result.content").alias("content")).union(orphans)
    return whole.select("conv_id", "call_id", "turn", "result_turn", "level", "status", F.array_join("errors", "; ").alias("errors"),
                        "n_calls", "n_results", _line().alias("line"))


def _line() -> Column:
    """A row as canonical JSON: its members in order of their names, null ones left out."""
    def member(name: str, json: Column) -> Column:
        return F.concat(F.lit(f'"{name}":'), json)

    def text(c: Column) -> Column:  # a JSON string
        return F.regexp_extract(F.to_json(F.struct(F.coalesce(c, F.lit("")).alias("x"))), r"(?s)^\{\"x\":(.*)\}$", 1)

    shown = F.coalesce(canonical(F.col("arguments")), text(F.col("arguments")))
    members = [F.when(F.col("arguments").isNotNull(), member("arguments", shown)),
               F.when(F.col("call_id").isNotNull(), member("call_id", text(F.col("call_id")))),
               F.when(F.col("content").isNotNull(), member("content", text(F.col("content")))),
               F.when(F.col("level").isNotNull(), member("level", F.col("level").cast("string"))),
               member("status", text(F.col("status"))),
               F.when(F.col("tool").isNotNull(), member("tool", text(F.col("tool"))))]
    return F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*members)), ","), F.lit("}"))


# The tools that ``from_conversations`` calls.
SCHEMAS: Schemas = {
    "answer": {"limit": ("integer", True), "query": ("string", True)},
    "rewrite": {"style": ("string", False), "text": ("string", True)},
}


def from_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results as a plain chat implies them, with the faults that real logs have.

    With n the length of its text in characters, a user's turn t makes the call ``call-t`` (without an
    identifier where n is a multiple of 13): to ``browse``, which has no schema, where n is a multiple
    of 11, else to ``answer`` for an even n and ``rewrite`` for an odd one; ``answer`` gets its
    word count as ``limit``, as a text where that is a multiple of five. It waits for the calls of
    the two user turns before, and where n is a multiple of 17 for that of the next, which comes
    later. Where n is a multiple of 3, a second call rewrites what the first returns and waits for it and the
    call of the turn before; where n is a multiple of 7, a third call repeats the first's identifier. An
    assistant's turn t is the result of ``call-(t - 1)``, but where n is a multiple of 19 that of
    ``call-(t + 1)``, too early, and where it is one of 23 that of a call nobody made.
    """
    size, n, turn = F.length("text"), F.size(F.split("text", " ")), F.col("turn")
    identifier = lambda t: F.concat(F.lit("call-"), t.cast("string"))
    limit = F.when(n % 5 == 0, F.to_json(F.struct(F.col("text").alias("query"), n.cast("string").alias("limit")))).otherwise(
        F.to_json(F.struct(F.col("text").alias("query"), n.alias("limit"))))
    asked = turns.filter(F.col("role") == "user")
    first = asked.select(
        "conv_id", "turn", F.when(size % 13 != 0, identifier(turn)).alias("call_id"),
        F.when(size % 11 == 0, "browse").when(size % 2 == 0, "answer").otherwise("rewrite").alias("tool"),
        F.when((size % 2 == 0) & (size % 11 != 0), limit).otherwise(F.to_json(F.struct("text"))).alias("arguments"),
        F.array_compact(F.array(identifier(turn - 2), identifier(turn - 4), F.when(size % 17 == 0, identifier(turn + 2)))).alias("after"))
    second = asked.filter(size % 3 == 0).select(
        "conv_id", "turn", F.concat(identifier(turn), F.lit("-rewrite")).alias("call_id"), F.lit("rewrite").alias("tool"),
        F.to_json(F.struct(F.concat(F.lit("result of "), identifier(turn)).alias("text"), F.lit("plain").alias("style"))).alias("arguments"),
        F.array(identifier(turn), identifier(turn - 2)).alias("after"))
    third = asked.filter(size % 7 == 0).select(
        "conv_id", "turn", identifier(turn).alias("call_id"), F.lit("rewrite").alias("tool"),
        F.lit('{"text":"~ once more"}').alias("arguments"), F.array().cast("array<string>").alias("after"))
    results = turns.filter(F.col("role") == "assistant").select(
        "conv_id", "turn", F.when(size % 23 == 0, F.concat(F.lit("lost-"), turn.cast("string"))).when(size % 19 == 0, identifier(turn + 1))
        .otherwise(identifier(turn - 1)).alias("call_id"), F.col("text").alias("content"))
    return first.union(second).union(third), results


def oracle_sql() -> str:
    """DuckDB SQL of the query: levels by a recursive walk along the waits."""
    text = lambda c: f"json_quote({c})"
    return f"""
WITH RECURSIVE u AS (SELECT *, length(text) AS n, len(string_split(text, ' ')) AS words FROM conversations),
     calls AS (
       SELECT conv_id, turn, CASE WHEN n % 13 != 0 THEN 'call-' || turn END AS call_id,
              CASE WHEN n % 11 = 0 THEN 'browse' WHEN n % 2 = 0 THEN 'answer' ELSE 'rewrite' END AS tool,
              CASE WHEN n % 2 != 0 OR n % 11 = 0 THEN '{{"text":' || {text('text')} || '}}'
                   WHEN words % 5 = 0 THEN '{{"query":' || {text('text')} || ',"limit":"' || words || '"}}'
                   ELSE '{{"query":' || {text('text')} || ',"limit":' || words || '}}' END AS arguments,
              CASE WHEN n % 2 != 0 OR n % 11 = 0 THEN '{{"text":' || {text('text')} || '}}'
                   WHEN words % 5 = 0 THEN '{{"limit":"' || words || '","query":' || {text('text')} || '}}'
                   ELSE '{{"limit":' || words || ',"query":' || {text('text')} || '}}' END AS shown,
              CASE WHEN n % 11 = 0 THEN 'unknown tool' WHEN n % 2 = 0 AND words % 5 = 0 THEN 'limit is not integer' ELSE '' END AS errors,
              list_filter(['call-' || (turn - 2), 'call-' || (turn - 4), CASE WHEN n % 17 = 0 THEN 'call-' || (turn + 2) END], lambda x: x IS NOT NULL) AS after
       FROM u WHERE role = 'user'
       UNION ALL SELECT conv_id, turn, 'call-' || turn || '-rewrite', 'rewrite', '{{"text":"result of call-' || turn || '","style":"plain"}}',
              '{{"style":"plain","text":"result of call-' || turn || '"}}', '', ['call-' || turn, 'call-' || (turn - 2)] FROM u WHERE role = 'user' AND n % 3 = 0
       UNION ALL SELECT conv_id, turn, 'call-' || turn, 'rewrite', '{{"text":"~ once more"}}', '{{"text":"~ once more"}}', '', [] FROM u WHERE role = 'user' AND n % 7 = 0),
     results AS (
       SELECT conv_id, turn, CASE WHEN n % 23 = 0 THEN 'lost-' || turn WHEN n % 19 = 0 THEN 'call-' || (turn + 1) ELSE 'call-' || (turn - 1) END AS call_id, text AS content
       FROM u WHERE role = 'assistant'),
     node AS (SELECT conv_id, call_id, min(turn) AS turn, count(*) AS n_calls, min({{'turn': turn, 'arguments': arguments}}) AS lead
              FROM calls WHERE call_id IS NOT NULL GROUP BY ALL),
     edge AS (SELECT DISTINCT e.conv_id, e.call_id, e.to_id FROM (SELECT conv_id, call_id, unnest(after) AS to_id FROM calls WHERE call_id IS NOT NULL) e
              JOIN node ON node.conv_id = e.conv_id AND node.call_id = e.to_id),
     walk AS (SELECT conv_id, call_id, call_id AS at_id, 0 AS steps FROM node
              UNION SELECT w.conv_id, w.call_id, e.to_id, w.steps + 1 FROM walk w
                    JOIN edge e ON e.conv_id = w.conv_id AND e.call_id = w.at_id
                    JOIN (SELECT conv_id, count(*) AS n FROM node GROUP BY 1) c ON c.conv_id = w.conv_id AND w.steps < c.n),
     placed AS (SELECT w.conv_id, w.call_id, max(w.steps) AS level, max(t.turn) FILTER (w.steps > 0) > any_value(o.turn) AS late
                FROM walk w JOIN node t ON t.conv_id = w.conv_id AND t.call_id = w.at_id JOIN node o ON o.conv_id = w.conv_id AND o.call_id = w.call_id
                     JOIN (SELECT conv_id, count(*) AS n FROM node GROUP BY 1) c ON c.conv_id = w.conv_id
                GROUP BY w.conv_id, w.call_id HAVING max(w.steps) < any_value(c.n)),
     answer AS (SELECT conv_id, call_id, min({{'turn': turn, 'content': content}}) AS result, count(*) AS n_results FROM results GROUP BY ALL),
     whole AS (
       SELECT c.conv_id, c.call_id, c.turn, a.result.turn AS result_turn, p.level,
              CASE WHEN c.call_id IS NULL THEN 'no id' WHEN p.level IS NULL OR p.late THEN 'out of order'
                   WHEN {{'turn': c.turn, 'arguments': c.arguments}} != k.lead THEN 'duplicate id' WHEN c.errors != '' THEN 'invalid arguments'
                   WHEN a.n_results IS NULL THEN 'no result' WHEN a.result.turn <= c.turn THEN 'early result' ELSE 'ok' END AS status,
              c.errors, coalesce(k.n_calls, 1) AS n_calls, coalesce(a.n_results, 0) AS n_results, c.tool, c.shown, a.result.content AS content
       FROM calls c LEFT JOIN node k USING (conv_id, call_id) LEFT JOIN placed p USING (conv_id, call_id) LEFT JOIN answer a USING (conv_id, call_id)
       UNION ALL SELECT conv_id, call_id, NULL, result.turn, NULL, 'orphan result', '', 0, n_results, NULL, NULL, result.content
       FROM answer ANTI JOIN node USING (conv_id, call_id))
SELECT conv_id, call_id, turn, result_turn, level, status, errors, n_calls, n_results,
       '{{' || concat_ws(',', '"arguments":' || shown, '"call_id":' || {text('call_id')}, '"content":' || {text('content')}, '"level":' || level,
                         '"status":' || {text('status')}, '"tool":' || {text('tool')}) || '}}' AS line
FROM whole"""
