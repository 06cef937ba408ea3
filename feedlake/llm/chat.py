"""Chat formatting: tool calls linked to results, in dependency order, checked
against schemas and written as canonical JSON.

Tables.  ``calls``: conv_id long, pos long, call_id, name, arguments (JSON),
needs (ids of calls whose results the arguments use).  ``results``: conv_id,
pos, call_id, content.  ``schemas``: name, schema (JSON Schema text).

Linking.  Rows that are equal count once.  Of several calls with one id in a
conversation the one with the smallest (pos, name and arguments) stands for it, of
several results the one with the smallest (pos, content); both are found by
aggregation, then hash-joined on (conv_id, call_id).  Status: ``linked``;
``unanswered`` (call without result); ``orphan`` (result without call);
``duplicate`` (not the first of its id).

Order.  A result comes after its call, a call after the results it needs.
Messages keep their log position unless something they need comes later; then
they move behind it: (time, steps) is raised along the dependencies until
nothing changes, and messages are ordered by (time, steps, log position).  Only
messages out of order take part, so a log in order takes no round, whatever its
length; a disordered one takes as many as its longest chain of moved messages.
A message raised more often than its conversation has messages is on or behind
a cycle: it is marked and keeps its log position.

Arguments are parsed, checked against the call's schema (type, enum, const,
properties, required, additionalProperties, items, and the bounds of numbers,
strings and arrays), and written with sorted keys and without spaces.

Edge cases: null conv_id or call_id: the row is kept with status ``orphan``
(result) or ``unanswered`` (call), linked with nothing; null arguments count as
invalid JSON; a need that names no linked call is an error of the call, not an
edge; a name without schema is an error; empty tables give no rows.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.llm.prefix import running_sum
from feedlake.llm.scratch import written

#: Schema tables up to this many rows are broadcast.
BROADCAST_SCHEMAS = 1_000
BUCKET_TIMES = 1024
_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def _is(value: Any, kind: str) -> bool:
    if kind == "number":
        return isinstance(value, (int, float)) and not isinstance(value, bool)
    if kind == "integer":
        return _is(value, "number") and float(value).is_integer()
    return kind in _TYPES and isinstance(value, _TYPES[kind])


def _same(a: Any, b: Any) -> bool:
    return type(a) is type(b) and a == b or _is(a, "number") and _is(b, "number") and a == b


def check(value: Any, schema: dict, at: str = "$") -> list[str]:
    """What of ``schema`` the value breaks, in a fixed order."""
    errors = []
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_is(value, k) for k in kinds):
        return [f"{at}: not {' or '.join(kinds)}"]
    if "enum" in schema and not any(_same(value, x) for x in schema["enum"]):
        errors.append(f"{at}: not in enum")
    if "const" in schema and not _same(value, schema["const"]):
        errors.append(f"{at}: not the constant")
    size = len(value) if isinstance(value, (str, list)) else value if _is(value, "number") else None
    low, high = {str: ("minLength", "maxLength"), list: ("minItems", "maxItems")}.get(type(value), ("minimum", "maximum"))
    if size is not None and size < schema.get(low, -math.inf):
        errors.append(f"{at}: below {low}")
    if size is not None and size > schema.get(high, math.inf):
        errors.append(f"{at}: above {high}")
    if isinstance(value, str) and "pattern" in schema and not re.search(schema["pattern"], value):
        errors.append(f"{at}: no match of pattern")
    if isinstance(value, list) and isinstance(schema.get("items"), dict):
        for i, item in enumerate(value):
            errors += check(item, schema["items"], f"{at}[{i}]")
    if isinstance(value, dict):
        own = schema.get("properties", {})
        errors += [f"{at}.{k}: missing" for k in sorted(schema.get("required", [])) if k not in value]
        for k in sorted(value):
            if k in own:
                errors += check(value[k], own[k], f"{at}.{k}")
            elif schema.get("additionalProperties", True) is False:
                errors.append(f"{at}.{k}: not allowed")
            elif isinstance(schema.get("additionalProperties"), dict):
                errors += check(value[k], schema["additionalProperties"], f"{at}.{k}")
    return errors


def canonical(value: Any) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def _no_constant(text: str) -> Any:
    raise ValueError(text)


def parsed(text: str | None) -> Any:
    """JSON value of a text; ValueError if it is none (NaN and infinities included)."""
    try:
        value = json.loads(text or "", parse_constant=_no_constant)
        canonical(value).encode()
        return value
    except RecursionError as deep:
        raise ValueError("too deep") from deep


@lru_cache(maxsize=256)
def _schema(text: str) -> dict | None:
    try:
        value = json.loads(text)
    except ValueError:
        return None
    return value if isinstance(value, dict) else None


def message(row: dict) -> tuple[str, list[str]]:
    """(canonical JSON, errors) of a call or result row."""
    if row["kind"] == "result":
        return canonical({"content": row["body"], "id": row["call_id"], "type": "result"}), []
    errors, arguments = [], row["body"]
    try:
        arguments = parsed(row["body"])
        schema = _schema(row["schema"]) if row["schema"] is not None else None
        errors = ["no usable schema"] if schema is None else check(arguments, schema)
    except ValueError:
        errors = ["arguments are not JSON"]
    errors += [f"needs unknown call {x}" for x in row["unmet"] or ()]
    return canonical({"arguments": arguments, "id": row["call_id"], "name": row["name"], "type": "call"}), errors


def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [message(row) for row in batch.select(["kind", "call_id", "name", "body", "schema", "unmet"]).to_pylist()]
        kept = [c for c in batch.schema.names if c not in ("body", "schema", "unmet")]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in kept), pa.array([text for text, _ in out], pa.string()),
             pa.array(["; ".join(errors) for _, errors in out], pa.string())], names=[*kept, "json", "errors"])


def _messages(calls: DataFrame, results: DataFrame) -> DataFrame:
    """All distinct messages with an id: kind, conv_id, call_id, pos, name, needs, tie, body; written once."""
    none = F.array().cast("array<string>")
    calls = calls.select("conv_id", "pos", "call_id", "name", F.col("arguments").alias("body"), F.lit("call").alias("kind"),
                         F.array_sort(F.array_distinct(F.coalesce("needs", none))).alias("needs"))
    results = results.select("conv_id", "pos", "call_id", F.lit(None).cast("string").alias("name"),
                             F.col("content").alias("body"), F.lit("result").alias("kind"), none.alias("needs"))
    tie = F.md5(F.to_json(F.struct("name", "body", "needs")).cast("binary"))
    return written(calls.unionByName(results).distinct().withColumns({"tie": tie, "id": F.monotonically_increasing_id()}),
                   "messages")


def _linked(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, status, node) of every message, and the calls with their results by identifier.

    Works on the messages without their bodies.
    """
    known = rows.filter("conv_id is not null and call_id is not null")
    first = {kind: known.filter(F.col("kind") == kind).groupBy("conv_id", "call_id")
             .agg(F.min(F.struct("pos", "tie", "id", "needs")).alias(kind)) for kind in ("call", "result")}
    pairs = written(first["call"].join(first["result"].hint("shuffle_hash"), ["conv_id", "call_id"], "full_outer"), "pairs")
    alone = {"call": "unanswered", "result": "orphan"}
    both = F.col("call").isNotNull() & F.col("result").isNotNull()
    firsts = [pairs.filter(F.col(kind).isNotNull()).select(
        F.col(f"{kind}.id").alias("id"), F.when(both, "linked").otherwise(status).alias("status"),
        F.concat(F.lit(kind[0]), "call_id").alias("node")) for kind, status in alone.items()]
    named = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    status = F.coalesce("status", F.when(named, F.lit("duplicate")).when(F.col("kind") == "call", alone["call"])
                        .otherwise(alone["result"]))
    return rows.join(firsts[0].union(firsts[1]), "id", "left").withColumn("status", status), pairs


def _edges(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Dependencies between first messages (conv_id, src, dst by kind and id, with positions), and unmet needs."""
    answered = pairs.filter(F.col("result").isNotNull())
    own = answered.filter(F.col("call").isNotNull()).select(
        "conv_id", F.concat(F.lit("c"), "call_id").alias("src"), F.col("call.pos").alias("src_pos"),
        F.concat(F.lit("r"), "call_id").alias("dst"), F.col("result.pos").alias("dst_pos"))
    wants = pairs.filter(F.col("call").isNotNull()).select(
        "conv_id", F.col("call_id").alias("by"), F.col("call.pos").alias("call_pos"), F.explode("call.needs").alias("call_id"))
    met = wants.join(answered.select("conv_id", "call_id", F.col("result.pos").alias("result_pos"), F.lit(True).alias("met")),
                     ["conv_id", "call_id"], "left")
    need = met.filter("met").select("conv_id", F.concat(F.lit("r"), "call_id").alias("src"), F.col("result_pos").alias("src_pos"),
                                    F.concat(F.lit("c"), "by").alias("dst"), F.col("call_pos").alias("dst_pos"))
    unmet = (met.filter("met is null").groupBy("conv_id", F.concat(F.lit("c"), "by").alias("node"))
             .agg(F.array_sort(F.collect_list("call_id")).alias("unmet")))
    return own.unionByName(need), unmet


def _raised(edges: DataFrame, sizes: DataFrame) -> DataFrame | None:
    """conv_id, node, time, steps, cyclic of the messages that move; None if none does."""
    state = None
    better = edges.filter("src_pos >= dst_pos").select(
        "conv_id", F.col("dst").alias("node"), F.struct(F.col("src_pos").alias("time"), F.lit(1).cast("long").alias("steps")).alias("v"))
    while True:
        change = better.groupBy("conv_id", "node").agg(F.max("v").alias("v"))
        if state is not None:
            old = state.select("conv_id", "node", F.col("v").alias("old"))
            change = change.join(old, ["conv_id", "node"], "left").filter("old is null or v > old").drop("old")
        change = (change.join(sizes, "conv_id").withColumn("cyclic", F.col("v.steps") > F.col("size")).drop("size"))
        change = written(change, "raised")
        if change.isEmpty():
            break
        kept = change if state is None else state.join(change, ["conv_id", "node"], "left_anti").unionByName(change)
        state = written(kept, "state")
        step = F.struct(F.col("v.time").alias("time"), (F.col("v.steps") + 1).alias("steps"))
        better = (edges.join(change.filter("not cyclic").select("conv_id", F.col("node").alias("src"), "v"), ["conv_id", "src"])
                  .select("conv_id", F.col("dst").alias("node"), "dst_pos", step.alias("v"))
                  .filter("v.time >= dst_pos").drop("dst_pos"))
    return None if state is None else state.select("conv_id", "node", F.col("v.time").alias("time"),
                                                   F.col("v.steps").alias("steps"), "cyclic")


def format_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """conv_id, place, kind, call_id, name, status, cyclic, json, errors: one row for each distinct message.

    ``place`` numbers a conversation's messages from 0 in dependency order.
    """
    messages = _messages(calls, results)
    rows, pairs = _linked(messages.drop("body"))
    edges, unmet = _edges(pairs)
    edges = written(edges, "edges")
    moved = _raised(edges, written(messages.groupBy("conv_id").agg(F.count(F.lit(1)).alias("size")), "sizes"))
    if moved is None:
        rows = rows.withColumns({"time": F.lit(None).cast("long"), "steps": F.lit(None).cast("long"), "cyclic": F.lit(False)})
    else:
        rows = rows.join(moved, ["conv_id", "node"], "left")
    stays = F.col("time").isNull() | F.coalesce("cyclic", F.lit(False))
    rows = rows.join(unmet, ["conv_id", "node"], "left").select(
        "id", "conv_id", "kind", "call_id", "pos", "tie", "status", "unmet", F.coalesce("cyclic", F.lit(False)).alias("cyclic"),
        F.when(stays, F.coalesce("pos", F.lit(0))).otherwise(F.col("time")).alias("time"),
        F.when(stays, F.lit(0).cast("long")).otherwise(F.col("steps")).alias("steps"),
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("group"), F.lit(1).cast("long").alias("one"))
    rows = written(rows.withColumn("bucket", F.floor(F.col("time") / BUCKET_TIMES)), "ordered")
    placed = running_sum(rows, ["group"], "bucket", ["time", "steps", "pos", "kind", "call_id", "tie", "id"], "one", "place")

    one = schemas.groupBy("name").agg(F.min("schema").alias("schema"))
    small = schemas.limit(BROADCAST_SCHEMAS + 1).count() <= BROADCAST_SCHEMAS
    bodies = messages.select("id", "name", "body")
    done = (placed.select("id", "conv_id", "place", "kind", "call_id", "status", "cyclic", "unmet").join(bodies, "id")
            .join(F.broadcast(one) if small else one, "name", "left")
            .select("conv_id", "place", "kind", "call_id", "name", "status", "cyclic", "body", "schema", "unmet"))
    out = T.StructType([f for f in done.schema if f.name not in ("body", "schema", "unmet")]
                       + [T.StructField("json", T.StringType()), T.StructField("errors", T.StringType())])
    return done.mapInArrow(_written, out)
