"""Chat formatting: tool calls linked to their results, in topological order, validated, as canonical JSON.

Calls and results meet in an equality join on (conversation, call id). A call may name a parent call whose result it uses;
its depth is the length of that chain, found by pointer doubling: every round each call looks up where its ancestor points,
so chains of n calls take log2(n) equality joins and no conversation is ever gathered. (depth, position, call id) is a
topological order. Arguments are checked against the tool's JSON schema, and every message is one canonical JSON line: keys
sorted, no spaces, text as it is.

Defined results: of calls that share an id in a conversation the first by position counts, the others are ``duplicate`` and
stay; of results that share an id the first by (position, content) counts, the others are rows of kind ``duplicate result``
if ``link`` is asked for them, as the query does; a call without a result is unanswered, a result without a call is an
``orphan`` row; a parent that does not exist is no parent; calls on a cycle, or that depend on one, have a null depth and
the error ``cycle``; an unknown tool, arguments that are no JSON (NaN, numbers beyond a double and too deep nesting included), violated schemas
and schemas that are no object or can't be applied are errors; halves of surrogate pairs are escaped; null ids link with
nothing; extra columns are ignored. Of a table of turns every row is in the result: as a call, as the result in its call's
line, as an orphan or duplicate, or as a ``message`` if its role is neither user nor assistant.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lintlake.functions.scale import stage

#: Chains are followed for so many doublings; longer ones can't exist in fewer rows than 2 ** this.
MAX_DOUBLINGS = 40


_LONE = re.compile("[\ud800-\udfff]")


def canonical(value) -> str:
    """Canonical JSON; halves of surrogate pairs, which no UTF-8 text can hold, are escaped."""
    line = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    return _LONE.sub(lambda half: f"\\u{ord(half[0]):04x}", line)


def _refuse(name: str):
    raise ValueError(f"{name} is no JSON")


def _number(text: str) -> float:
    value = float(text)
    return value if math.isfinite(value) else _refuse(text)


def parsed(text: str):
    """The value of a JSON text; ValueError for what is no JSON, numbers beyond a double and too deep nesting."""
    try:
        value = json.loads(text, parse_constant=_refuse, parse_float=_number)
        canonical(value)
        return value
    except RecursionError:
        raise ValueError("nested too deeply") from None


def same(a, b) -> bool:
    """Equality of JSON values: true is not 1, but 1 is 1.0."""
    if isinstance(a, bool) or isinstance(b, bool):
        return a is b
    if isinstance(a, list) and isinstance(b, list):
        return len(a) == len(b) and all(map(same, a, b))
    if isinstance(a, dict) and isinstance(b, dict):
        return a.keys() == b.keys() and all(same(a[k], b[k]) for k in a)
    return a == b


_TYPES = {
    "string": lambda v: isinstance(v, str),
    "boolean": lambda v: isinstance(v, bool),
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool),
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "object": lambda v: isinstance(v, dict),
    "array": lambda v: isinstance(v, list),
    "null": lambda v: v is None,
}


def violation(value, schema: dict, at: str = "$") -> str | None:
    """The first thing about a value that its schema forbids: type, enum, limits, required, properties, items."""
    if "type" in schema:
        kinds = schema["type"] if isinstance(schema["type"], list) else [schema["type"]]
        if not any(_TYPES[k](value) for k in kinds):
            return f"{at} is not of type {'/'.join(kinds)}"
    if "enum" in schema and not any(same(value, x) for x in schema["enum"]):
        return f"{at} is not one of the allowed values"
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value) or value > schema.get("maximum", value):
            return f"{at} is out of range"
    if isinstance(value, (str, list)):
        kind = "Length" if isinstance(value, str) else "Items"
        if not schema.get(f"min{kind}", 0) <= len(value) <= schema.get(f"max{kind}", len(value)):
            return f"{at} has a length out of range"
    if isinstance(value, list) and "items" in schema:
        return next((e for i, x in enumerate(value) if (e := violation(x, schema["items"], f"{at}[{i}]"))), None)
    if isinstance(value, dict):
        known = schema.get("properties", {})
        for name in schema.get("required", []):
            if name not in value:
                return f"{at}.{name} is missing"
        for name in sorted(value):
            if name in known:
                if found := violation(value[name], known[name], f"{at}.{name}"):
                    return found
            elif schema.get("additionalProperties") is False:
                return f"{at}.{name} is not allowed"
    return None


def depths(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, depth) of calls (conv_id, call_id, parent_id) with unique ids: null on and behind cycles."""
    known = calls.select("conv_id", F.col("call_id").alias("parent_id"))
    real = calls.join(known, ["conv_id", "parent_id"], "left_semi").select("conv_id", "call_id", F.col("parent_id").alias("next"))
    roots = calls.select("conv_id", "call_id").join(real.select("conv_id", "call_id"), ["conv_id", "call_id"], "left_anti")
    now = roots.select("conv_id", "call_id", F.lit(None).cast("string").alias("next"), F.lit(0).cast("long").alias("depth"))
    now = stage(now.union(real.withColumn("depth", F.lit(1).cast("long"))), "depths")
    total = now.count()
    for doubling in range(MAX_DOUBLINGS):
        if 1 << doubling > total or not now.filter("next is not null").limit(1).count():
            break
        there = now.select("conv_id", F.col("call_id").alias("next"), F.col("next").alias("after"), F.col("depth").alias("more"))
        now = stage(
            now.join(there, ["conv_id", "next"], "left").select(
                "conv_id", "call_id", F.col("after").alias("next"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")
            ),
            "depths",
        )
    return now.select("conv_id", "call_id", F.when(F.col("next").isNull(), F.col("depth")).alias("depth"))


_LINKED = "call_id string, kind string, depth long, position long, answered boolean, error string, line string"


def _checked(arguments, text: str, schemas: dict[str, dict | None]) -> str | None:
    """The violation of a schema, or that the schema itself is of no use."""
    if text not in schemas:
        try:
            schema = parsed(text)
        except ValueError:
            schema = None
        schemas[text] = schema if isinstance(schema, dict) else None
    if schemas[text] is None:
        return "schema is not a JSON object"
    try:
        return violation(arguments, schemas[text])
    except (KeyError, TypeError, AttributeError, RecursionError):
        return "schema is not usable"


def _serialise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schemas: dict[str, dict | None] = {}
    for batch in batches:
        errors, lines = [], []
        for row in batch.to_pylist():
            error, arguments = row["error"], None
            if row["call_id"] is not None and row["arguments"] is not None:
                try:
                    arguments = parsed(row["arguments"])
                except ValueError:
                    error = error or "arguments are not JSON"
                if row["schema"] is None:
                    error = error or "unknown tool"
                elif error is None:
                    error = _checked(arguments, row["schema"], schemas)
            message = {"call": row["call_id"], "tool": row["tool"], "arguments": arguments, "parent": row["parent_id"]}
            if row["answered"] or row["kind"] in ("orphan", "duplicate result"):
                message["result"] = row["content"]
            if error:
                message["error"] = error
            errors.append(error)
            lines.append(canonical(message))
        names = ["conv_id", "call_id", "kind", "depth", "position", "answered"]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(n) for n in names], pa.array(errors, pa.string()), pa.array(lines, pa.string())], [*names, "error", "line"]
        )


def link(calls: DataFrame, results: DataFrame, tools: DataFrame, surplus: bool = False) -> DataFrame:
    """One row per call or orphan result: conv_id, call_id, kind, depth, position, answered, error, line.

    calls: conv_id, call_id, parent_id, position, tool, arguments (JSON). results: conv_id, call_id, position, content.
    tools: tool, schema (JSON). Sorted by (conv_id, depth, position, call_id), the lines of a conversation are its format.
    With ``surplus``, a call's results after the first are rows too.
    """
    order = Window.partitionBy("conv_id", "call_id").orderBy("position", "tool", "arguments", "parent_id")
    calls = calls.select("conv_id", "call_id", "parent_id", F.col("position").cast("long").alias("position"), "tool", "arguments")
    identified = F.col("call_id").isNotNull() & F.col("conv_id").isNotNull()
    ranked = stage(calls.withColumn("first", identified & (F.row_number().over(order) == 1)), "calls")
    answer = F.struct(F.col("position").cast("long").alias("position"), "content")
    given = results.select("conv_id", "call_id", answer.alias("answer")).dropna(subset=["conv_id", "call_id"])
    answers = given.groupBy("conv_id", "call_id").agg(F.min("answer").alias("answer"))
    unique = ranked.filter("first")
    linked = unique.join(answers, ["conv_id", "call_id"], "left").join(depths(unique), ["conv_id", "call_id"])
    tools = tools.groupBy("tool").agg(F.min("schema").alias("schema"))
    columns = ["conv_id", "call_id", "kind", "parent_id", "depth", "position", "tool", "arguments", "answered", "content", "error"]
    proper = linked.select(
        "conv_id", "call_id", F.lit("call").alias("kind"), "parent_id", "depth", "position", "tool", "arguments",
        F.col("answer").isNotNull().alias("answered"), F.col("answer.content").alias("content"),
        F.when(F.col("depth").isNull(), "cycle").alias("error"),
    )
    nothing = lambda kind: F.lit(None).cast(kind)
    repeated = ranked.filter("not first").select(
        "conv_id", "call_id", F.lit("duplicate").alias("kind"), "parent_id", nothing("long").alias("depth"), "position", "tool", "arguments",
        F.lit(False).alias("answered"), nothing("string").alias("content"),
        F.when(identified, "duplicate id").otherwise("no id").alias("error"),
    )
    alone = results.select("conv_id", "call_id", F.col("position").cast("long").alias("position"), "content").join(
        unique.select("conv_id", "call_id"), ["conv_id", "call_id"], "left_anti"
    ).select(
        "conv_id", "call_id", F.lit("orphan").alias("kind"), nothing("string").alias("parent_id"), nothing("long").alias("depth"), "position",
        nothing("string").alias("tool"), nothing("string").alias("arguments"), F.lit(False).alias("answered"), "content",
        F.lit("no such call").alias("error"),
    )
    rows = proper.select(columns).union(repeated.select(columns)).union(alone.select(columns))
    if surplus:
        # Equal results are counted before they meet their call's answer, and become rows again after it.
        copies = given.groupBy("conv_id", "call_id", "answer").agg(F.count("*").alias("copies"))
        taken = linked.select("conv_id", "call_id", F.col("answer").alias("taken"))
        left = F.col("copies") - F.when(F.col("answer") == F.col("taken"), 1).otherwise(0)
        more = copies.join(taken, ["conv_id", "call_id"]).withColumn("left", left).filter("left > 0")
        more = more.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "left"))).select(
            "conv_id", "call_id", F.lit("duplicate result").alias("kind"), nothing("string").alias("parent_id"), nothing("long").alias("depth"),
            "answer.position", nothing("string").alias("tool"), nothing("string").alias("arguments"), F.lit(False).alias("answered"),
            "answer.content", F.lit("duplicate result").alias("error"),
        )
        rows = rows.union(more.select(columns))
    rows = rows.join(tools, "tool", "left")
    kind = rows.schema["conv_id"].dataType.simpleString()
    return rows.mapInArrow(_serialise, f"conv_id {kind}, {_LINKED}")


ASK = {
    "type": "object",
    "properties": {"question": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}},
    "required": ["question", "turn"],
    "additionalProperties": False,
}


def turns_as_calls(spark: SparkSession, conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Calls, results and tools of plain conversations.

    A user's turn is a call of the tool ``ask`` that builds on the user's turn two turns before; the turn after it, if it
    is the assistant's, is its result. Other assistant's turns are results without a call; all other turns are neither, see
    ``turns_as_messages``.
    """
    turns = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", F.col("text").cast("string").alias("text"))
    name = lambda turn: F.concat_ws("-", F.lit("ask"), F.col("conv_id").cast("string"), turn.cast("string"))
    calls = turns.filter("role = 'user'").select(
        "conv_id", name(F.col("turn")).alias("call_id"), name(F.col("turn") - 2).alias("parent_id"), F.col("turn").alias("position"),
        F.lit("ask").alias("tool"), F.to_json(F.struct(F.col("text").alias("question"), "turn")).alias("arguments"),
    )
    results = turns.filter("role = 'assistant'").select(
        "conv_id", name(F.col("turn") - 1).alias("call_id"), F.col("turn").alias("position"), F.col("text").alias("content")
    )
    return calls, results, spark.createDataFrame([("ask", json.dumps(ASK))], "tool string, schema string")


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        roles, texts = batch.column("role").to_pylist(), batch.column("text").to_pylist()
        lines = [canonical({"role": role, "content": text}) for role, text in zip(roles, texts, strict=True)]
        n = len(lines)
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), pa.nulls(n, pa.string()), pa.array(["message"] * n, pa.string()), pa.nulls(n, pa.int64()),
             batch.column("turn"), pa.array([False] * n, pa.bool_()), pa.nulls(n, pa.string()), pa.array(lines, pa.string())],
            ["conv_id", *_LINKED.replace(" string", "").replace(" long", "").replace(" boolean", "").split(", ")],
        )


def turns_as_messages(conversations: DataFrame) -> DataFrame:
    """The turns that are neither calls nor results, system turns above all, as rows of kind ``message`` like those of ``link``."""
    turns = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    others = turns.filter(~F.coalesce(F.col("role").isin("user", "assistant"), F.lit(False)))
    return others.mapInArrow(_write, f"conv_id {turns.schema['conv_id'].dataType.simpleString()}, {_LINKED}")


def linked_turns(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The linked rows of plain conversations: every turn is in a row of its own or is the result in its call's line."""
    return link(*turns_as_calls(spark, conversations), surplus=True).union(turns_as_messages(conversations))
