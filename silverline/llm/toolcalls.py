"""Chat formatting: tool calls linked with their results, ordered, checked against schemas, as canonical JSON."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverline.llm.common import materialise, running_total

#: JSON types as they show in the schema of a parsed value.
TYPES = {
    "string": r"^STRING$",
    "integer": r"^(BIGINT|DECIMAL\(\d+,0\))$",
    "number": r"^(BIGINT|DECIMAL\(\d+,\d+\)|DOUBLE|FLOAT)$",
    "boolean": r"^BOOLEAN$",
    "array": r"^ARRAY",
    "object": r"^OBJECT",
    "null": r"^VOID$",
}


def canonical_json(text: Column) -> Column:
    """JSON without spaces, keys sorted at every level, numbers and escapes in their shortest form; null if it is not JSON."""
    return F.to_json(F.try_parse_json(text))


def _errors(arguments: Column, schema: Mapping) -> Column:
    """What is wrong with the arguments of one tool, as an array of strings."""
    value = F.try_parse_json(arguments)
    checks = []
    properties = schema.get("properties", {})
    for name, rule in properties.items():
        path = "$['" + name.replace("'", "\\'") + "']"
        kind = F.schema_of_variant(F.try_variant_get(value, path, "variant"))
        there = kind.isNotNull()
        if name in schema.get("required", ()):
            checks.append(F.when(~there, f"missing {name}"))
        if "type" in rule:
            checks.append(F.when(there & ~kind.rlike(TYPES[rule["type"]]), f"type of {name}"))
        number, string = F.try_variant_get(value, path, "double"), F.try_variant_get(value, path, "string")
        if "minimum" in rule:
            checks.append(F.when(number < rule["minimum"], f"{name} too small"))
        if "maximum" in rule:
            checks.append(F.when(number > rule["maximum"], f"{name} too large"))
        if "minLength" in rule:
            checks.append(F.when(F.length(string) < rule["minLength"], f"{name} too short"))
        if "maxLength" in rule:
            checks.append(F.when(F.length(string) > rule["maxLength"], f"{name} too long"))
        if "enum" in rule:
            checks.append(F.when(there & ~F.coalesce(string.isin([str(x) for x in rule["enum"]]), F.lit(False)), f"{name} not listed"))
    if schema.get("additionalProperties") is False:
        known = F.array(*map(F.lit, properties)) if properties else F.expr("cast(array() as array<string>)")
        extra = F.array_except(F.json_object_keys(arguments), known)
        checks.append(F.when(F.size(extra) > 0, F.concat(F.lit("unknown "), F.array_join(F.array_sort(extra), ", "))))
    is_object = F.coalesce(F.schema_of_variant(value).rlike(TYPES["object"]), F.lit(False))
    found = F.filter(F.array(*checks), lambda x: x.isNotNull()) if checks else F.expr("cast(array() as array<string>)")
    return F.when(~is_object, F.array(F.lit("not an object"))).otherwise(found)


def _depths(nodes: DataFrame) -> DataFrame:
    """How many calls each call comes after: (conv_id, call_id, depth), null on and behind a cycle.

    Pointers double from round to round, so a chain of n calls takes log(n) rounds; a pointer that is left when
    they reach further than there are calls goes round a cycle.
    """
    state = nodes.select("conv_id", "call_id", F.col("after").alias("to"), F.col("after").isNotNull().cast("long").alias("depth"))
    state = materialise(state, "depths")
    reach, total = 1, state.count()
    while reach <= total and state.where("to is not null").limit(1).count():
        ahead = state.select(
            F.col("conv_id").alias("c"), F.col("call_id").alias("at"), F.col("to").alias("next"), F.col("depth").alias("more")
        )
        joined = state.join(ahead, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("to") == F.col("at")), "left")
        state = materialise(
            joined.select("conv_id", "call_id", F.col("next").alias("to"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")),
            "depths",
        )
        reach *= 2
    return state.select("conv_id", "call_id", F.when(F.col("to").isNull(), F.col("depth")).alias("depth"))


def link_tool_calls(calls: DataFrame, results: DataFrame, tools: Mapping[str, Mapping]) -> tuple[DataFrame, DataFrame]:
    """Link calls with results by identifier, put them in order and check them.

    `calls` has conv_id, turn, call_id, name, arguments (JSON text) and after (the id of the call of the same conversation
    whose result it needs, or null); `results` has conv_id, turn, call_id, content; `tools` maps names to schemas (type,
    properties with type, minimum, maximum, minLength, maxLength, enum; required; additionalProperties). Other columns are ignored.

    Returns two tables. The linked calls: `conv_id`, `call_id`, `turn`, `name`, `after`, `depth` (calls it comes after, one by
    one), `position` (from 0 in its conversation: after what it needs, then by turn and id), `n_results`, `errors`, `valid`,
    `line` (canonical JSON with after, arguments, id, name, position, result). And the results without a call.

    A null conversation is a conversation. A row that repeats the id of a call is not a call of its own: of equal ids the
    earliest stands, by turn, name and arguments, and `n_calls` counts the rows. Every row without an id is a call of its own: no call
    can come after it and no result belongs to it; its `call_id` is empty and its line has a null id. A result without an id has no call.
    Of several results the earliest is taken. An `after` that names no call, or the call itself, is dropped and reported as an error; calls
    on a cycle or behind one have a null depth, come last and are reported. Arguments that are null or not a JSON object are
    reported and serialised as null. Empty tables give empty tables.

    A conversation or an id of any size spreads: ids are reduced to one row before any join, and positions come from
    range-partitioned sums.
    """
    call = F.struct("turn", "name", "arguments", "after")
    named = calls.where("call_id is not null").groupBy("conv_id", "call_id").agg(F.min(call).alias("c"), F.count("*").alias("n_calls"))
    named = named.select("conv_id", "call_id", "c.*", "n_calls", F.lit(0).cast("long").alias("tie"), F.lit(0).cast("long").alias("row"))
    # The row number only tells rows apart that are equal in everything else.
    unnamed = calls.where("call_id is null").select(
        "conv_id", "call_id", "turn", "name", "arguments", "after", F.lit(1).cast("long").alias("n_calls"),
        F.xxhash64("name", "arguments", "after").alias("tie"), F.monotonically_increasing_id().alias("row"),
    )
    first = materialise(named.union(unnamed), "calls")
    known = first.where("call_id is not null").select(F.col("conv_id").alias("k_conv"), F.col("call_id").alias("k_call"))
    needs = F.col("conv_id").eqNullSafe(F.col("k_conv")) & (F.col("after") == F.col("k_call")) & ~F.col("after").eqNullSafe(F.col("call_id"))
    linked = first.join(known, needs, "left")
    linked = linked.withColumn("lost", F.col("after").isNotNull() & F.col("k_call").isNull())
    linked = materialise(linked.withColumn("after", F.col("k_call")).drop("k_conv", "k_call"), "linked")
    depths = _depths(linked.where("call_id is not null"))
    depths = depths.select(F.col("conv_id").alias("k_conv"), F.col("call_id").alias("k_call"), F.col("depth").alias("k_depth"))
    # A call without an id is one further than the call that it needs.
    deep = F.col("conv_id").eqNullSafe(F.col("k_conv")) & (F.coalesce("call_id", "after") == F.col("k_call"))
    depth = F.when(F.col("call_id").isNotNull(), F.col("k_depth")).when(F.col("after").isNotNull(), F.col("k_depth") + 1).otherwise(F.lit(0))
    answer = results.where("call_id is not null").groupBy("conv_id", "call_id").agg(
        F.min(F.struct("turn", "content")).alias("r"), F.count("*").alias("n_results")
    )
    answer = answer.select(F.col("conv_id").alias("r_conv"), F.col("call_id").alias("r_call"), F.col("r.content").alias("result"), "n_results")
    same = lambda c, k: F.col("conv_id").eqNullSafe(F.col(c)) & (F.col("call_id") == F.col(k))
    linked = linked.join(depths, deep, "left").withColumn("depth", depth).join(answer, same("r_conv", "r_call"), "left")
    checks = F.array(F.lit("unknown tool"))
    for name, schema in tools.items():
        checks = F.when(F.col("name") == name, _errors(F.col("arguments"), schema)).otherwise(checks)
    linked = linked.select(
        "conv_id",
        "call_id",
        "turn",
        "name",
        "after",
        "depth",
        "n_calls",
        F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"),
        F.concat(
            checks,
            F.when(F.col("lost"), F.array(F.lit("unknown after"))).otherwise(F.expr("cast(array() as array<string>)")),
            F.when(F.col("depth").isNull(), F.array(F.lit("cycle"))).otherwise(F.expr("cast(array() as array<string>)")),
        ).alias("errors"),
        F.when(F.schema_of_variant(F.try_parse_json("arguments")).rlike(TYPES["object"]), canonical_json(F.col("arguments"))).alias("args"),
        "result",
        "tie",
        "row",
        F.lit(1).alias("one"),
        F.col("depth").isNull().alias("last"),
    )
    placed = running_total(
        materialise(linked, "checked"), ["conv_id"], ["last", "depth", "turn", "call_id", "tie", "row"], "one", "position"
    )
    quoted = lambda c: F.when(F.col(c).isNull(), "null").otherwise(_quoted(F.col(c)))
    line = F.concat(
        F.lit('{"after":'), quoted("after"),
        F.lit(',"arguments":'), F.coalesce("args", F.lit("null")),
        F.lit(',"id":'), quoted("call_id"),
        F.lit(',"name":'), quoted("name"),
        F.lit(',"position":'), F.col("position").cast("string"),
        F.lit(',"result":'), quoted("result"),
        F.lit("}"),
    )
    placed = placed.select(
        "conv_id", F.coalesce("call_id", F.lit("")).alias("call_id"), "turn", "name", "after", "depth", "position", "n_calls", "n_results", "errors",
        (F.size("errors") == 0).alias("valid"), line.alias("line"),
    )
    return placed, results.join(known, same("k_conv", "k_call"), "left_anti")


def _quoted(text: Column) -> Column:
    """A JSON string."""
    body = F.to_json(F.array(text))
    return F.substring(body, F.lit(2), F.length(body) - 2)
