"""Chat formatting: tool calls linked with their results, put in topological order, checked
against schemas, and written as canonical JSON.

A call has an identifier, may name the call it builds on, and carries its arguments as JSON.
Calls and results are hash-joined by conversation and identifier.  A call's depth is the
number of calls it builds on, found by doubling pointers, so a chain of a million calls takes
twenty rounds; calls on a cycle, or behind one, and calls on an unknown one have no depth.
Within a conversation calls are numbered by depth, turn and identifier, over key ranges, so
that no conversation is numbered by one task.

Arguments are checked for JSON, for missing and unknown parameters, and for types.  Canonical
JSON has sorted keys on all levels and no spaces.

Defined cases: of several results of one call the earliest, then the smallest text, counts;
the same holds for repeated calls (turn, then arguments), and ``repeats`` tells how often a
call occurred.  Null or empty arguments are an invalid JSON.  Results without a call are left
out of the linked table and are listed by :func:`unclaimed`.  Calls without identifier or
conversation are left out.  Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlab.llm.common import table, within, written

KEY = ["conv_id", "call_id"]
# Parameter types and the types of a parsed value that fit them.
FITS = {"string": ["STRING"], "integer": ["BIGINT"], "number": ["BIGINT", "DOUBLE", "DECIMAL"], "boolean": ["BOOLEAN"], "object": ["OBJECT"], "array": ["ARRAY"]}


def first_of(rows: DataFrame, keys: list[str], order: list[str], rest: list[str]) -> DataFrame:
    """One row per key: the smallest by ``order``, and the number of rows."""
    smallest = F.min_by(F.struct(*rest), F.struct(*order))
    return rows.groupBy(*keys).agg(smallest.alias("_x"), F.count("*").alias("repeats")).select(*keys, *[F.col(f"_x.{c}") for c in rest], "repeats")


def depths(calls: DataFrame) -> DataFrame:
    """``conv_id, call_id, depth``: how many calls stand above each; null on or behind a cycle or an unknown call."""
    known = calls.select(*KEY, "parent_id")
    parents = known.select("conv_id", F.col("call_id").alias("parent_id"), F.lit(True).alias("_there"))
    now = known.join(parents, ["conv_id", "parent_id"], "left").select(
        *KEY, F.when(F.col("_there"), F.col("parent_id")).alias("up"), F.when(F.col("parent_id").isNull(), 0).when(F.col("_there"), 1).cast("long").alias("depth"))
    now = written(now, "depth")
    size, reach = now.count(), 1
    while reach < 2 * size and not now.where("up IS NOT NULL").isEmpty():
        above = now.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("_up"), F.col("depth").alias("_depth"))
        step = now.where("up IS NOT NULL").join(above, ["conv_id", "up"]).select(*KEY, F.col("_up").alias("up"), (F.col("depth") + F.col("_depth")).alias("depth"))
        now = written(now.where("up IS NULL").unionByName(step), "depth")
        reach *= 2
    return now.select(*KEY, F.when(F.col("up").isNull(), F.col("depth")).alias("depth"))


def kind(value: Column) -> Column:
    """The type of a parsed value without its details."""
    return F.regexp_extract(F.schema_of_variant(value), r"^([A-Z]+)", 1)


def problems(values: Column, params: Column) -> Column:
    """What is wrong with a map of parsed arguments, sorted; empty if nothing."""
    fits = F.create_map(*[x for name, kinds in FITS.items() for x in (F.lit(name), F.array(*map(F.lit, kinds)))])
    given = F.map_keys(values)
    lacking = F.transform(F.filter(params, lambda p: p["required"] & ~F.array_contains(given, p["name"])), lambda p: F.concat(F.lit("missing "), p["name"]))
    extra = F.transform(F.array_except(given, F.transform(params, lambda p: p["name"])), lambda n: F.concat(F.lit("unknown "), n))
    wrong = F.filter(params, lambda p: F.array_contains(given, p["name"]) & ~F.coalesce(F.array_contains(fits[p["type"]], kind(values[p["name"]])), F.lit(False)))
    return F.array_sort(F.concat(lacking, extra, F.transform(wrong, lambda p: F.concat(F.lit("type "), p["name"]))))


def quoted(text: Column) -> Column:
    """A JSON string, or null."""
    json = F.to_json(F.struct(text.alias("x")))
    return F.when(text.isNull(), "null").otherwise(json.substr(F.lit(6), F.length(json) - 6))


def link_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """Calls with their results.

    ``calls``: ``conv_id, turn, call_id, parent_id, name, arguments``; ``results``: ``conv_id,
    turn, call_id, content``; ``schemas``: ``name, params`` with ``params`` an array of ``name,
    type, required``.  Returns ``conv_id, call_id, turn, name, depth, position, answered,
    repeats, errors, record``; ``record`` is canonical JSON.
    """
    calls = first_of(calls.where("call_id IS NOT NULL AND conv_id IS NOT NULL"), KEY, ["turn", "arguments", "name", "parent_id"], ["turn", "parent_id", "name", "arguments"])
    calls = written(calls, "calls")
    answers = first_of(results.where("call_id IS NOT NULL"), KEY, ["turn", "content"], ["content"]).withColumnRenamed("repeats", "answers")
    linked = calls.join(depths(calls), KEY).join(answers, KEY, "left")
    linked = linked.join(schemas.select("name", "params"), "name", "left")

    linked = linked.withColumn("_json", F.try_parse_json(F.when(F.col("arguments").isNotNull() & (F.trim("arguments") != ""), F.col("arguments"))))
    is_object = F.coalesce(F.schema_of_variant("_json").startswith("OBJECT"), F.lit(False))
    linked = linked.withColumn("_values", F.when(is_object, F.expr("try_cast(_json AS map<string, variant>)")))
    errors = (F.when(F.col("_json").isNull(), F.array(F.lit("not JSON"))).when(F.col("_values").isNull(), F.array(F.lit("not an object")))
              .when(F.col("params").isNull(), F.array(F.lit("unknown tool"))).otherwise(problems(F.col("_values"), F.col("params"))))
    linked = linked.withColumn("errors", F.array_join(errors, ", "))
    record = F.concat(F.lit('{"arguments":'), F.coalesce(F.to_json("_json"), quoted(F.col("arguments"))), F.lit(',"id":'), quoted(F.col("call_id")),
                      F.lit(',"name":'), quoted(F.col("name")), F.lit(',"result":'), quoted(F.col("content")), F.lit("}"))
    linked = linked.select("conv_id", "call_id", "turn", "name", "depth", F.col("answers").isNotNull().alias("answered"), "repeats", "errors", record.alias("record"))
    order = [F.col("depth").asc_nulls_last(), F.col("turn"), F.col("call_id")]
    return within(linked, ["conv_id"], order, "position").select("conv_id", "call_id", "turn", "name", "depth", "position", "answered", "repeats", "errors", "record")


def unclaimed(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Results that belong to no call."""
    return results.join(calls.select(*KEY).distinct(), KEY, "left_anti")


# -- the given conversations as tool calls -----------------------------------------------

def calls_of(turns: DataFrame) -> DataFrame:
    """Every assistant turn as a call that builds on the assistant turn two before.

    The tool and its arguments follow from the turn; some turns make arguments that don't fit.
    """
    size = F.length(F.coalesce("text", F.lit("")))
    said = F.coalesce("text", F.lit(""))
    rows = turns.where("role = 'assistant'")
    mine = rows.select("conv_id", "turn").distinct().select("conv_id", (F.col("turn") + 2).alias("turn"), F.lit(True).alias("_there"))
    rows = rows.join(mine, ["conv_id", "turn"], "left")
    name = F.when(size % 3 == 0, "search").when(size % 3 == 1, "translate").otherwise("summarise")
    arguments = (F.when(size % 7 == 0, F.to_json(F.struct(F.col("turn").alias("turn"), F.lit("many").alias("limit"), said.alias("text"))))
                 .when(size % 11 == 0, F.to_json(F.struct(F.col("turn").alias("turn"))))
                 .when(size % 13 == 0, said)
                 .otherwise(F.to_json(F.struct(said.alias("text"), F.col("turn").alias("turn"), size.alias("limit")))))
    called = lambda turn: F.concat(F.lit("call-"), F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))
    return rows.select("conv_id", "turn", called(F.col("turn")).alias("call_id"), F.when(F.col("_there"), called(F.col("turn") - 2)).alias("parent_id"), name.alias("name"), arguments.alias("arguments"))


def results_of(turns: DataFrame) -> DataFrame:
    """Every user turn as the result of the call one turn before."""
    call = F.concat(F.lit("call-"), F.col("conv_id").cast("string"), F.lit("-"), (F.col("turn") - 1).cast("string"))
    return turns.where("role = 'user' AND turn > 0").select("conv_id", "turn", call.alias("call_id"), F.col("text").alias("content"))


def schemas(spark: SparkSession) -> DataFrame:
    """What the three tools take."""
    params = "array(struct('text' AS name, 'string' AS type, true AS required), struct('turn' AS name, 'integer' AS type, false AS required), struct('limit' AS name, 'integer' AS type, {0} AS required))"
    each = [f"SELECT '{name}' AS name, {params.format(needed)} AS params" for name, needed in (("search", "true"), ("translate", "false"), ("summarise", "false"))]
    return spark.sql(" UNION ALL ".join(each))


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations as linked, ordered and checked tool calls."""
    turns = table(spark, sf_dir, "conversations")
    return link_calls(calls_of(turns), results_of(turns), schemas(spark))
