"""Chat formatting: linking tool calls to their results.

Calls and results meet in a hash join by (conversation, call identifier).  Both sides are first reduced to a row per
identifier, with partial aggregation, so that repeated rows, however many, meet as one.  Arguments are validated against
the tool's schema, calls are put in topological order of the calls they depend on, and each link is serialised as
canonical JSON: keys in order at every level, no blanks.

Topological order: where every dependency stands earlier in its conversation, the position is such an order already,
and an equi-join on the dependencies proves it.  Only conversations in which some dependency stands later are peeled
level by level (Kahn), by joins, however long the conversation.

Defined results: rows without a conversation or identifier are kept under a null key and never link; of repeated calls
or results the one with the least position counts, and the numbers of both are reported; a call without a result is
"unanswered", a result without a call is an "orphan" with null name; arguments that are not a JSON object are an error
of the call; a dependency that does not exist is an error and does not order anything; calls on a cycle have no order; very
long arguments and results are kept whole; empty tables give no rows; columns beyond the named ones, whatever their names,
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Workspace

CALLS = "conv_id long, call_id string, position long, name string, arguments string, depends_on array<string>"
RESULTS = "conv_id long, call_id string, position long, content string"
#: A row for each field of each tool: type is a SQL type name as schema_of_variant gives it.
SCHEMAS = "name string, field string, type string, required boolean"


def _first_of(df: DataFrame, fields: list[str], n: str) -> DataFrame:
    """One row for each (conv_id, call_id): the row of least position (ties: least content), and the number of rows."""
    row = F.struct("position", *[F.to_json(f) if df.schema[f].dataType.typeName() == "variant" else F.col(f) for f in fields])
    out = df.groupBy("conv_id", "call_id").agg(F.min(row).alias("r"), F.count(F.lit(1)).alias(n))
    return out.select("conv_id", "call_id", n, *[F.col("r")[f].alias(f) for f in ("position", *fields)])


def _base_type(c: Column) -> Column:
    return F.regexp_extract(F.schema_of_variant(c), "^[A-Z]+", 0)


def validate(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """Add ``args`` (variant, null unless an object) and ``errors``."""
    fields = schemas.groupBy("name").agg(F.sort_array(F.collect_set(F.struct("field", "type", "required"))).alias("fields"))
    parsed = calls.withColumn("args", F.try_parse_json("arguments")).withColumn(
        "args", F.when(_base_type(F.col("args")) == "OBJECT", F.col("args"))
    )
    known = parsed.join(fields, "name", "left")
    keys = F.json_object_keys("arguments")

    def problem(x: Column) -> Column:
        value = F.try_variant_get("args", F.concat(F.lit("$['"), x["field"], F.lit("']")), "variant")
        missing = F.when(x["required"], F.concat(F.lit("missing "), x["field"]))
        wrong = F.when(_base_type(value) != x["type"], F.concat(F.lit("wrong type of "), x["field"]))
        return F.when(value.isNull(), missing).otherwise(wrong)

    unknown = F.transform(F.array_except(F.array_sort(keys), F.transform("fields", lambda x: x["field"])), lambda k: F.concat(F.lit("unknown "), k))
    found = F.filter(F.concat(F.transform("fields", problem), unknown), lambda e: e.isNotNull())
    errors = (
        F.when(F.col("fields").isNull(), F.array(F.lit("unknown tool")))
        .when(F.col("args").isNull(), F.array(F.lit("arguments are not a JSON object")))
        .otherwise(found)
    )
    return known.withColumn("errors", F.coalesce(errors, F.array().cast("array<string>"))).drop("fields")


def topological_order(work: Workspace, calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, topo, dangling): ``topo`` increases along every dependency; null on a cycle."""
    nodes = calls.select("conv_id", "call_id", "position")
    wanted = calls.select("conv_id", "call_id", "position", F.explode(F.array_distinct("depends_on")).alias("needs"))
    target = nodes.select("conv_id", F.col("call_id").alias("needs"), F.col("position").alias("needs_position"))
    edges = wanted.join(target, ["conv_id", "needs"], "left")
    dangling = edges.where(F.col("needs_position").isNull()).groupBy("conv_id", "call_id").agg(F.count(F.lit(1)).alias("dangling"))
    edges = edges.where(F.col("needs_position").isNotNull())
    backward = work.write(edges.where(F.col("needs_position") >= F.col("position")).select("conv_id").distinct())
    topo = nodes.withColumn("topo", F.col("position"))
    if not backward.isEmpty():
        hard = work.write(nodes.join(backward, "conv_id", "left_semi"))
        left = work.write(edges.join(backward, "conv_id", "left_semi").select("conv_id", "call_id", "needs"))
        done, level = None, 0
        todo = hard
        while True:
            ready = work.write(todo.join(left, ["conv_id", "call_id"], "left_anti").select("conv_id", "call_id", F.lit(level).cast("long").alias("topo")))
            if ready.isEmpty():
                break
            done = ready if done is None else work.write(done.unionByName(ready))
            todo = work.write(todo.join(ready, ["conv_id", "call_id"], "left_anti"))
            left = work.write(left.join(ready.select("conv_id", F.col("call_id").alias("needs")), ["conv_id", "needs"], "left_anti"))
            level += 1
        cyclic = todo.select("conv_id", "call_id", F.lit(None).cast("long").alias("topo"))
        peeled = cyclic if done is None else done.unionByName(cyclic)
        easy = nodes.join(backward, "conv_id", "left_anti").select("conv_id", "call_id", F.col("position").alias("topo"))
        # Conversations without an identifier never have dependencies that link.
        topo = easy.unionByName(peeled)
    return topo.select("conv_id", "call_id", "topo").join(dangling, ["conv_id", "call_id"], "left").withColumn("dangling", F.coalesce("dangling", F.lit(0)))


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """A row per call identifier, and one per orphan result."""
    with Workspace(calls.sparkSession) as work:
        return work.keep(_linked(work, calls, results, schemas))


def _linked(work: Workspace, calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    one_call = _first_of(calls, ["name", "arguments", "depends_on"], "n_calls")
    one_result = _first_of(results, ["content"], "n_results").withColumnRenamed("position", "result_position")
    checked = validate(one_call, schemas)
    order = topological_order(work, one_call)
    ordered = checked.join(order, ["conv_id", "call_id"], "left")
    both = ordered.join(one_result, ["conv_id", "call_id"], "full_outer")
    orphan = F.col("n_calls").isNull()
    extra = F.array(
        F.when(orphan, F.lit("orphan result")),
        F.when(~orphan & F.col("n_results").isNull(), F.lit("unanswered")),
        F.when(F.col("dangling") > 0, F.lit("dangling dependency")),
        F.when(~orphan & F.col("topo").isNull() & F.col("conv_id").isNotNull() & F.col("call_id").isNotNull() & F.col("position").isNotNull(), F.lit("cycle")),
        F.when(F.col("n_calls") > 1, F.lit("repeated call")),
        F.when(F.col("n_results") > 1, F.lit("repeated result")),
    )
    errors = F.concat(F.coalesce("errors", F.array().cast("array<string>")), F.filter(extra, lambda e: e.isNotNull()))
    body = F.struct(F.col("args").alias("arguments"), F.col("call_id").alias("id"), F.col("name").alias("name"), F.col("content").alias("result"))
    return both.select(
        "conv_id", "call_id", "topo", "name", "position", "result_position",
        F.coalesce("n_calls", F.lit(0)).alias("n_calls"), F.coalesce("n_results", F.lit(0)).alias("n_results"),
        (F.size(errors) == 0).alias("valid"), F.array_join(errors, "; ").alias("errors"),
        F.to_json(body, {"ignoreNullFields": "false"}).alias("canonical"),
    )


# --- the conversations table as calls and results ----------------------------------------------------------------


def from_conversations(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Each user turn is a call of the tool "reply", each system turn one of "configure"; the assistant turn that follows
    a call's turn is its result; a user turn depends on the user turn two before it, a first one on turn 0's system turn.
    Some arguments do not fit the tools' schema: where the turn leaves 3 by division by 5, n_chars is text; where it leaves
    4, there is a "question" in the place of the "prompt".
    """
    c = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")
    )

    def name(turn: Column) -> Column:
        return F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))

    n_chars, text, rest = F.length("text"), F.col("text"), F.col("turn") % 5
    args = F.when(rest == 3, F.to_json(F.struct("turn", text.alias("prompt"), n_chars.cast("string").alias("n_chars"))))
    args = args.when(rest == 4, F.to_json(F.struct("turn", text.alias("question"), n_chars.alias("n_chars"))))
    args = args.otherwise(F.to_json(F.struct("turn", text.alias("prompt"), n_chars.alias("n_chars"))))
    parent = F.when(F.col("turn") >= 2, F.array(name(F.col("turn") - 2))).otherwise(F.array().cast("array<string>"))
    user = F.col("role") == "user"
    calls = c.where(F.col("role").isin("user", "system")).select(
        "conv_id", name(F.col("turn")).alias("call_id"), F.col("turn").alias("position"), F.when(user, "reply").otherwise("configure").alias("name"),
        args.alias("arguments"), F.coalesce(F.when(user, parent), F.array().cast("array<string>")).alias("depends_on"),
    )
    results = c.where(F.col("role") == "assistant").select(
        "conv_id", name(F.col("turn") - 1).alias("call_id"), F.col("turn").alias("position"), F.col("text").alias("content")
    )
    rows = [(n, f, t, True) for n in ("reply", "configure") for f, t in (("n_chars", "BIGINT"), ("prompt", "STRING"), ("turn", "BIGINT"))]
    values = ", ".join(f"('{n}', '{f}', '{t}', {str(r).lower()})" for n, f, t, r in rows)
    schemas = conversations.sparkSession.sql(f"SELECT * FROM VALUES {values} AS v(name, field, type, required)")
    return calls, results, schemas


ORACLE_SQL = """
WITH c AS (SELECT conv_id, 'c' || conv_id || '-' || turn AS call_id, min(turn) AS position, count(*) AS n_calls, min(role) AS role,
        arg_min(text, text) AS text, bool_or(role = 'user' AND turn >= 2) AS depends
    FROM conversations WHERE role IN ('user', 'system') GROUP BY conv_id, turn),
r AS (SELECT conv_id, 'c' || conv_id || '-' || (turn - 1) AS call_id, min(turn) AS result_position, count(*) AS n_results, min(text) AS content
    FROM conversations WHERE role = 'assistant' GROUP BY conv_id, turn),
l AS (SELECT c.*, c.depends AND p.call_id IS NULL AS dangling FROM c LEFT JOIN c p ON c.conv_id = p.conv_id AND p.position = c.position - 2),
e AS (SELECT coalesce(l.conv_id, r.conv_id) AS conv_id, coalesce(l.call_id, r.call_id) AS call_id, l.position, r.result_position, l.role, l.text, r.content,
        coalesce(n_calls, 0) AS n_calls, coalesce(n_results, 0) AS n_results,
        concat_ws('; ', CASE WHEN n_calls IS NULL THEN NULL WHEN position % 5 = 3 THEN 'wrong type of n_chars' WHEN position % 5 = 4 THEN 'missing prompt; unknown question' END,
            CASE WHEN n_calls IS NULL THEN 'orphan result' END, CASE WHEN n_calls IS NOT NULL AND n_results IS NULL THEN 'unanswered' END,
            CASE WHEN dangling THEN 'dangling dependency' END, CASE WHEN n_calls > 1 THEN 'repeated call' END, CASE WHEN n_results > 1 THEN 'repeated result' END) AS errors
    FROM l FULL OUTER JOIN r ON l.conv_id = r.conv_id AND l.call_id = r.call_id)
SELECT conv_id, call_id, position AS topo, CASE role WHEN 'user' THEN 'reply' WHEN 'system' THEN 'configure' END AS name, position, result_position,
    n_calls, n_results, errors = '' AS valid, errors,
    '{"arguments":' || coalesce('{"n_chars":' || CASE WHEN position % 5 = 3 THEN '"' || length(text) || '"' ELSE CAST(length(text) AS VARCHAR) END
        || CASE WHEN position % 5 = 4 THEN ',"question":' ELSE ',"prompt":' END || CAST(to_json(text) AS VARCHAR) || ',"turn":' || position || '}', 'null')
    || ',"id":' || CAST(to_json(call_id) AS VARCHAR) || ',"name":' || coalesce('"' || CASE role WHEN 'user' THEN 'reply' WHEN 'system' THEN 'configure' END || '"', 'null')
    || ',"result":' || coalesce(CAST(to_json(content) AS VARCHAR), 'null') || '}' AS canonical
FROM e
"""
