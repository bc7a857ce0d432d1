"""Tool calls of conversations: linked, ordered, validated, and written as canonical JSON.

Method. Calls and results meet in a hash join on conversation and call identifier; of several
results of a call the earliest is its result, and a result without a call stays as an orphan. Calls
are ordered topologically: a call's step is one more than the largest step of the calls it depends
on. Calls that depend on one other call form chains, which are contracted first by doubling: in each
round a call learns the ancestor of its ancestor and the distance to it, so a chain of n calls takes
log2(n) rounds and ends at a call with no or several dependencies. Only these are then settled round
by round, as many as lie behind each other at most; each round writes what it has settled and nothing
else. Arguments are checked against the schema of
their tool. Each linked call becomes one JSON text with sorted keys, no white space and every
character as itself, so equal calls are equal texts.

No step groups a conversation: keys are (conversation, call), so a conversation with a third of all
messages is spread like any other. (step, turn, call_id) orders the calls of a conversation.

Schemas are the object form of JSON Schema: `properties` with `type` (string, integer, number,
boolean, array, object, null or a list of these), `enum`, `minimum`, `maximum`, `minLength`,
`items`, nested `properties`; `required`; `additionalProperties` false.

Status of a call, the first that holds: `duplicate` (a later call with an identifier already used in
the conversation), `cycle` (it depends on itself, directly or not; its step is null), `unknown_tool`,
`malformed` (arguments that are no JSON object; null counts as none), `invalid` (arguments against
the schema), `dangling` (it depends on a call that is not there; such dependencies do not count for
the step), `unanswered`, `ok`. Results without a call, and repeated results, are rows of status `orphan` and
`extra_result`; messages of any other kind, or of none, are rows of status `message`, so every message
is a row or the result in one. Calls without a conversation or identifier are `unidentified` and link with nothing.
Numbers are written as Python writes them; of repeated keys in an object the last counts. Equal
rows are a call and its duplicate. Columns not named here are not read. No rows in, no rows out.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import ready, stored

_KINDS = {"string": str, "boolean": bool, "array": list, "object": dict, "null": type(None)}
_RESULT = ("conv_id long, turn long, call_id string, name string, step int, status string, "
           "errors array<string>, json string")


def canonical(value: object) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def _is(value: object, kind: str) -> bool:
    if kind in ("integer", "number"):
        number = isinstance(value, (int, float)) and not isinstance(value, bool)
        return number and (kind == "number" or float(value).is_integer())
    return isinstance(value, _KINDS[kind])


def violations(value: object, schema: dict, path: str = "") -> list[str]:
    """What is wrong with a value, as `path: reason`, in order of the path."""
    here, out = path or "arguments", []
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_is(value, k) for k in kinds):
        return [f"{here}: not {' or '.join(kinds)}"]
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{here}: not one of the values")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value):
            out.append(f"{here}: too small")
        if value > schema.get("maximum", value):
            out.append(f"{here}: too large")
    if isinstance(value, str) and len(value) < schema.get("minLength", 0):
        out.append(f"{here}: too short")
    if isinstance(value, list) and "items" in schema:
        for at, item in enumerate(value):
            out += violations(item, schema["items"], f"{path}[{at}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        inner = lambda key: f"{path}.{key}" if path else key
        out += [f"{inner(k)}: missing" for k in sorted(schema.get("required", [])) if k not in value]
        for key in sorted(value):
            if key in known:
                out += violations(value[key], known[key], inner(key))
            elif schema.get("additionalProperties") is False:
                out.append(f"{inner(key)}: not allowed")
    return out


def _reject(name: str) -> None:
    raise ValueError(name)


def _written(schemas: dict[str, dict]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            status, errors, texts = [], [], []
            for row in batch.to_pylist():
                wrong: list[str] = []
                arguments, state = None, row["state"]
                try:
                    # not-a-number and infinities are no JSON
                    arguments = json.loads(row["arguments"] or "null", parse_constant=_reject)
                    canonical(arguments).encode()
                except (ValueError, RecursionError):
                    arguments, wrong = None, ["arguments: no JSON"]
                if not state:
                    if row["name"] not in schemas:
                        state, wrong = "unknown_tool", []
                    elif not isinstance(arguments, dict):
                        state, wrong = "malformed", wrong or ["arguments: no object"]
                    elif wrong := violations(arguments, schemas[row["name"]]):
                        state = "invalid"
                    else:
                        state = ("dangling" if row["dangling"] else
                                 "ok" if row["answered"] else "unanswered")
                status.append(state)
                errors.append(wrong)
                texts.append(canonical({
                    "arguments": arguments, "conversation": row["conv_id"],
                    "depends_on": sorted(set(row["depends_on"] or ()) - {None}), "id": row["call_id"],
                    "name": row["name"], "result": row["result"], "step": row["step"]}))
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in ("conv_id", "turn", "call_id", "name", "step")), pa.array(status),
                 pa.array(errors, pa.list_(pa.string())), pa.array(texts, pa.string())],
                ["conv_id", "turn", "call_id", "name", "step", "status", "errors", "json"])
    return run


_CALL = ["conv_id", "call_id"]


def _chains(edges: DataFrame, single: DataFrame) -> DataFrame:
    """(conv_id, call_id, end, far): for every call with one dependency, the nearest call before it that
    has none or several, and the number of calls from there. Calls that a cycle holds have none."""
    chain = stored(edges.join(single, _CALL, "left_semi").select(
        *_CALL, F.col("needed").alias("end"), F.lit(1).cast("long").alias("far")), "chains")
    on = single.select("conv_id", F.col("call_id").alias("end"), F.lit(True).alias("on"))
    # a call is done when its end is no link itself
    done = [stored(chain.join(on, ["conv_id", "end"], "left_anti").select(*chain.columns), "chain-ends")]
    left = stored(chain.join(on, ["conv_id", "end"], "left_semi").select(*chain.columns), "chain-links")
    for _ in range(max(chain.count(), 1).bit_length() + 1):  # by then only cycles are left
        if left.isEmpty():
            break
        known = done[0]
        for part in done[1:]:
            known = known.unionByName(part)
        step = (known.withColumn("last", F.lit(True)).unionByName(left.withColumn("last", F.lit(False)))
                .toDF("conv_id", "end", "next", "more", "last"))
        moved = stored(left.join(step, ["conv_id", "end"]).select(
            *_CALL, F.col("next").alias("end"), (F.col("far") + F.col("more")).alias("far"), "last"), "chain-moved")
        done.append(moved.where("last").drop("last"))
        left = moved.where("not last").drop("last")
    return _union(done)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _steps(calls: DataFrame, edges: DataFrame) -> DataFrame:
    """(conv_id, call_id, step) of every call that no cycle holds back."""
    counted = stored(edges.groupBy(*_CALL).agg(F.count("*").alias("needs")), "tool-needs")
    free = calls.select(*_CALL).join(counted, _CALL, "left_anti")
    chains = stored(_chains(edges, counted.where("needs = 1").drop("needs")), "chains-whole")
    # calls with several dependencies, and the ends of the chains that lead to them
    waiting = counted.where("needs > 1")
    near = edges.join(waiting, _CALL).join(
        chains.select("conv_id", F.col("call_id").alias("needed"), "end", "far"), ["conv_id", "needed"], "left")
    wanted = stored(near.join(counted.where("needs = 1").select("conv_id", F.col("call_id").alias("needed"), F.lit(True).alias("linked")),
                              ["conv_id", "needed"], "left")
                    # a link without an end hangs on a cycle and is never settled
                    .select(*_CALL, "needs", F.when(F.col("linked"), F.col("end")).otherwise(F.col("needed")).alias("end"),
                            F.coalesce("far", F.lit(0)).alias("far")), "tool-junctions")
    settled = [stored(free.withColumn("step", F.lit(0).cast("long")), "steps")]
    heard, fresh = None, settled[0]
    while not fresh.isEmpty():
        told = (wanted.join(fresh.withColumnRenamed("call_id", "end"), ["conv_id", "end"])
                .groupBy(*_CALL, "needs").agg(F.count("*").alias("n"), F.max(F.col("step") + F.col("far")).alias("top")))
        if heard is not None:
            told = (heard.unionByName(told).groupBy(*_CALL, "needs")
                    .agg(F.sum("n").alias("n"), F.max("top").alias("top")))
        state = stored(told, "heard")
        heard = state.where("n < needs")
        fresh = stored(state.where("n = needs").select(*_CALL, (F.col("top") + 1).alias("step")), "steps")
        settled.append(fresh)
    ends = _union(settled)
    linked = chains.join(ends.withColumnRenamed("call_id", "end"), ["conv_id", "end"]).select(
        *_CALL, (F.col("step") + F.col("far")).alias("step"))
    return ends.unionByName(linked).withColumn("step", F.col("step").cast("int"))


def link_tool_calls(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """messages(conv_id, turn, kind, call_id, name, arguments, depends_on, content) → a row per call,
    per result that no call claims, and per other message: conv_id, turn, call_id, name, step, status,
    errors, json.

    `kind` is `call` or `result`, anything else is a message; `arguments` is JSON text, `depends_on` the identifiers of calls of the same conversation, `content` a result's text.
    """
    ready(messages.sparkSession)
    kind = F.when(F.col("kind").isin("call", "result"), F.col("kind")).otherwise("message").alias("kind")
    given = stored(messages.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), kind,
        F.col("call_id").cast("string").alias("call_id"), F.col("name").cast("string").alias("name"),
        F.col("arguments").cast("string").alias("arguments"),
        F.col("depends_on").cast("array<string>").alias("depends_on"),
        F.col("content").cast("string").alias("content"))
        .withColumn("row", F.monotonically_increasing_id()), "tool-messages")
    key = ["conv_id", "call_id"]
    has_key = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    # the earliest of each identifier; the row number settles ties
    first = (given.where(has_key & (F.col("kind") != "message")).groupBy("kind", *key)
             .agg(F.min_by("row", F.struct(F.coalesce("turn", F.lit(1 << 62)), "row")).alias("row")))
    heads = stored(given.join(first.select("row"), "row", "left_semi"), "tool-heads")
    calls, results = heads.where("kind = 'call'"), heads.where("kind = 'result'")
    # a conversation's dependencies, and those that are calls of it
    wanted = calls.select(*key, F.explode(F.array_distinct("depends_on")).alias("needed")).where(
        "needed is not null")
    there = calls.select("conv_id", F.col("call_id").alias("needed"), F.lit(True).alias("there"))
    edges = stored(wanted.join(there, ["conv_id", "needed"], "left"), "tool-edges")
    dangling = edges.where("there is null").select(*key, F.lit(True).alias("dangling")).distinct()
    steps = _steps(calls, edges.where("there").drop("there"))
    linked = (calls.drop("content", "kind", "row")
              .join(results.select(*key, F.col("content").alias("result"), F.lit(True).alias("answered"))
                    .hint("shuffle_hash"), key, "left")
              .join(steps, key, "left").join(dangling, key, "left")
              .withColumn("state", F.when(F.col("step").isNull(), "cycle")))
    unclaimed = (given.join(first.select("row"), "row", "left_anti").unionByName(
        results.join(calls.select(*key), key, "left_anti")))
    state = (F.when(F.col("kind") == "message", "message").when(~has_key, "unidentified")
             .when(F.col("kind") == "call", "duplicate"))
    others = (unclaimed.join(calls.select(*key, F.lit(True).alias("known")), key, "left")
              .select("conv_id", "turn", "call_id", "name", "arguments", "depends_on",
                      F.when(F.col("kind") != "call", F.col("content")).alias("result"),
                      (F.col("kind") == "result").alias("answered"), F.lit(None).cast("int").alias("step"),
                      F.lit(None).cast("boolean").alias("dangling"),
                      F.coalesce(state, F.when(F.col("known"), "extra_result").otherwise("orphan"))
                      .alias("state")))
    return linked.unionByName(others).mapInArrow(_written(schemas), _RESULT)
