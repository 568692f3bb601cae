"""Operator 1: tool calls linked with their results, ordered, validated, canonical.

Results meet the turns of the calls of their (conversation, call id) in a hash join and link to
the nearest one before them.  Inside a turn a call
comes after the calls it depends on; its level, the longest way down to a call without
dependencies, is found by peeling: each round settles the calls none of whose
dependencies is left.  Arguments are checked against the JSON schema of the called tool,
and call and result are serialised as canonical JSON (sorted keys, no blanks, shortest
numbers).
"""

from __future__ import annotations

import json
import math
import re
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelforge.llm.common import read, written
from labelforge.operators.sizing import sized_join

KEYS = ["conv_id", "call_id"]
# The tools of the registered query.
SCHEMAS = {
    "search": {"type": "object", "required": ["query"], "additionalProperties": False, "properties": {
        "query": {"type": "string", "minLength": 1}, "limit": {"type": "integer", "minimum": 0, "maximum": 40},
        "after": {"type": "array", "items": {"type": "string"}}}},
    "translate": {"type": "object", "required": ["query", "limit"], "properties": {
        "query": {"type": "string", "maxLength": 400}, "limit": {"type": "integer"}}},
    "lookup": {"type": "object", "required": ["query"], "properties": {
        "query": {"type": "string"}, "limit": {"type": ["integer", "null"], "enum": [None, *range(0, 50, 2)]}}},
}


_quoted = json.encoder.encode_basestring  # a JSON string that keeps letters beyond ASCII


class BadJson(ValueError):
    """A text that isn't JSON, or holds one key twice."""


def _pairs(pairs: list) -> dict:
    out = dict(pairs)
    if len(out) < len(pairs):
        raise BadJson("repeated key")
    return out


def _constant(name: str):
    raise BadJson(f"{name} is no number")


def parse(text: str):
    try:
        return json.loads(text, object_pairs_hook=_pairs, parse_constant=_constant)
    except (BadJson, RecursionError):
        raise
    except ValueError as e:
        raise BadJson("no JSON") from e


def canonical(value) -> str:
    """JSON with keys sorted by UTF-16 units, no blanks, and shortest numbers."""
    if isinstance(value, dict):
        items = sorted(value.items(), key=lambda x: x[0].encode("utf-16-be", "surrogatepass"))
        return "{" + ",".join([f"{_quoted(k)}:{canonical(v)}" for k, v in items]) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(canonical, value)) + "]"
    if isinstance(value, float):
        if not math.isfinite(value):
            raise BadJson("number out of range")
        if value == int(value) and abs(value) < 1e21:
            return str(int(value))
        mantissa, _, power = repr(value).partition("e")
        return mantissa + (f"e{'-' if power[0] == '-' else '+'}{power.lstrip('+-').lstrip('0')}" if power else "")
    return _quoted(value) if isinstance(value, str) else json.dumps(value)


_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def _is(value, kind: str) -> bool:
    if kind in ("integer", "number"):
        number = isinstance(value, (int, float)) and not isinstance(value, bool)
        return number and (kind == "number" or value == int(value))
    return isinstance(value, _TYPES[kind])


# Keywords that say something about a value, and those that only describe it.
_KEYWORDS = {"type", "enum", "const", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "multipleOf",
             "minLength", "maxLength", "pattern", "minItems", "maxItems", "uniqueItems", "items", "required",
             "properties", "additionalProperties", "minProperties", "maxProperties", "anyOf", "allOf", "oneOf", "not"}
_NOTES = {"title", "description", "default", "examples", "$schema", "$id", "$comment", "deprecated"}


def check_schema(schema, path: str = "$") -> None:
    """Raises on keywords that ``violations`` would not check."""
    if isinstance(schema, bool):
        return
    unknown = set(schema) - _KEYWORDS - _NOTES
    if unknown:
        raise ValueError(f"{path}: schema keywords {sorted(unknown)} are not supported")
    for k, own in schema.get("properties", {}).items():
        check_schema(own, f"{path}.{k}")
    for k in ("items", "additionalProperties", "not"):
        if k in schema:
            check_schema(schema[k], f"{path}.{k}")
    for k in ("anyOf", "allOf", "oneOf"):
        for own in schema.get(k, []):
            check_schema(own, f"{path}.{k}")


def _multiple(value, step) -> bool:
    return Fraction(str(value)) % Fraction(str(step)) == 0


def violations(value, schema: dict | bool, path: str = "$") -> list[str]:
    """What of a value breaks a JSON schema (``_KEYWORDS``; ``check_schema`` refuses others)."""
    if isinstance(schema, bool):
        return [] if schema else [f"{path}: nothing allowed"]
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_is(value, k) for k in kinds):
        return [f"{path}: type"]
    out = []
    if "enum" in schema and not any(canonical(value) == canonical(e) for e in schema["enum"]):
        out.append(f"{path}: enum")
    if "const" in schema and canonical(value) != canonical(schema["const"]):
        out.append(f"{path}: const")
    if _is(value, "number"):
        bounds = (("minimum", lambda b: value < b), ("maximum", lambda b: value > b),
                  ("exclusiveMinimum", lambda b: value <= b), ("exclusiveMaximum", lambda b: value >= b),
                  ("multipleOf", lambda b: not _multiple(value, b)))
        out += [f"{path}: {k}" for k, bad in bounds if k in schema and bad(schema[k])]
    if isinstance(value, (str, list, dict)):
        what = {str: "Length", list: "Items", dict: "Properties"}[type(value)]
        out += [f"{path}: min{what}"] * (len(value) < schema.get(f"min{what}", 0))
        out += [f"{path}: max{what}"] * (len(value) > schema.get(f"max{what}", len(value)))
    if isinstance(value, str) and "pattern" in schema and not re.search(schema["pattern"], value):
        out.append(f"{path}: pattern")
    if isinstance(value, list):
        if schema.get("uniqueItems") and len(set(map(canonical, value))) < len(value):
            out.append(f"{path}: uniqueItems")
        if "items" in schema:
            out += [x for k, v in enumerate(value) for x in violations(v, schema["items"], f"{path}[{k}]")]
    if isinstance(value, dict):
        known, other = schema.get("properties", {}), schema.get("additionalProperties", True)
        out += [f"{path}.{k}: required" for k in schema.get("required", []) if k not in value]
        for k, v in value.items():
            if k in known:
                out += violations(v, known[k], f"{path}.{k}")
            elif other is False:
                out.append(f"{path}.{k}: unknown")
            elif other is not True:
                out += violations(v, other, f"{path}.{k}")
    for own in schema.get("allOf", []):
        out += violations(value, own, path)
    fits = {k: [not violations(value, own, path) for own in schema[k]] for k in ("anyOf", "oneOf") if k in schema}
    out += [f"{path}: anyOf"] * ("anyOf" in fits and not any(fits["anyOf"]))
    out += [f"{path}: oneOf"] * ("oneOf" in fits and sum(fits["oneOf"]) != 1)
    out += [f"{path}: not"] * ("not" in schema and not violations(value, schema["not"], path))
    return sorted(out)


def examine(call_id, name, arguments, result, schemas: dict) -> tuple[list[str], str]:
    """(errors, canonical JSON) of one call; arguments that are no JSON stay as text."""
    try:
        value = parse(arguments or "")
        text = canonical(value)
        errors = violations(value, schemas[name]) if name in schemas else ["$: unknown tool"]
    except (BadJson, RecursionError) as e:
        text, errors = canonical(arguments), [f"$: {e if isinstance(e, BadJson) else 'too deep'}"]
    rest = ",".join(f'"{k}":{canonical(v)}' for k, v in (("id", call_id), ("name", name), ("result", result)))
    return errors, f'{{"arguments":{text},{rest}}}'


def levels(calls: DataFrame, depends: DataFrame) -> DataFrame:
    """``calls(conv_id, turn, call_id)`` and ``depends(conv_id, turn, call_id, parent)`` -> conv_id,
    turn, call_id and ``level``: 0 without dependencies in the same turn, else one more than the
    highest of those; null for calls on a cycle, or behind one.  As many rounds as levels, over
    numbers that stand for the calls; the calls without dependencies leave before the first."""
    own = ["conv_id", "turn", "call_id"]
    numbered = written(calls.select(*own).withColumn("n", F.monotonically_increasing_id()), "numbers")
    at = numbered.select("conv_id", "turn", F.col("call_id").alias("parent"), F.col("n").alias("p"))
    edges = depends.join(numbered, own).select("conv_id", "turn", "parent", "n") \
        .join(at, ["conv_id", "turn", "parent"]).select("n", "p").distinct()
    left = written(edges, "edges")
    pending = written(left.select("n").distinct(), "pending")
    settled, level, size = [], 0, pending.count()
    while size:
        level += 1
        # dependencies that are still pending themselves
        left = written(left.join(pending.withColumnRenamed("n", "p"), "p", "left_semi"), "edges")
        still = written(left.select("n").distinct(), "pending")
        rest = still.count()
        if rest == size:  # only cycles and what hangs on them
            settled.append(still.withColumn("level", F.lit(None).cast("int")))
            break
        settled.append(pending.join(still, "n", "left_anti").withColumn("level", F.lit(level)))
        pending, size = still, rest
    if not settled:
        return numbered.select(*own, F.lit(0).alias("level"))
    above = settled[0]
    for more in settled[1:]:
        above = above.unionByName(more)
    return numbered.join(above.withColumn("deep", F.lit(True)), "n", "left") \
        .select(*own, F.when(F.col("deep"), F.col("level")).otherwise(0).alias("level"))


def _nearest(df: DataFrame, key: str, turns: DataFrame, out: str) -> DataFrame:
    """``df(conv_id, key, turn, ...)`` with ``out``: the last turn, up to its own, with a call of the
    id in ``key`` (null without one; a null turn comes after all).

    A hash join: ``turns`` has one row per id.  The other side may hold one id in a third of its
    rows; beyond the size of a broadcast it is salted."""
    named = turns.select(F.col("conv_id").alias("_conv"), F.col("call_id").alias("_id"), "turns").hint("shuffle_hash")
    met = sized_join(df, named, lambda a, b: (a["conv_id"] == b["_conv"]) & (a[key] == b["_id"]), "left", df.columns[:3])
    last = F.array_max(F.filter("turns", lambda t: F.col("turn").isNull() | (t <= F.col("turn"))))
    return met.select(*df.columns, last.alias(out))


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: dict) -> DataFrame:
    """``calls(conv_id, turn, call_id, name, arguments, depends_on)`` and ``results(conv_id,
    call_id, content[, turn])`` -> one row per row of either that is not shown by another:
    conv_id, turn, call_id, name, level, status, n_missing (dependencies without a call of
    theirs before), valid, errors, canonical.

    An id may be used again in a later turn; a result belongs to the last call of its id up to its
    own turn (results without a turn: to the last one).  Status: ``linked`` and ``unanswered``
    calls, ``orphan`` results, which have no such call, and ``duplicate`` rows: calls that repeat
    an id within one turn (the smallest name, arguments and dependencies is the call) and further
    results of one call (the first turn, then the smallest content is its result).  Nothing is
    dropped but rows with a null conversation or id, which link to nothing.

    The order (turn, level, call_id) is topological; dependencies count within a turn.  A null turn
    of a call is 0.  Other nulls are values like any other (null arguments are no JSON).  Texts of
    any length are taken whole, other columns are ignored.  Empty tables give an empty result.
    Schema keywords that are not checked raise an error."""
    for tool, own in schemas.items():
        check_schema(own, tool)
    ids = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    one = ["conv_id", "turn", "call_id"]
    body = F.struct("name", "arguments", "depends_on")
    given = calls.where(ids).select("conv_id", F.coalesce("turn", F.lit(0)).cast("long").alias("turn"), "call_id",
                                    "name", "arguments", "depends_on")
    # equal rows fall together first, however many there are
    alike = written(given.groupBy(*one, "name", "arguments", "depends_on").agg(F.count(F.lit(1)).alias("times")), "calls")
    kept = alike.groupBy(*one).agg(F.min(body).alias("c")).select(*one, "c.*")
    first = kept.select(*[F.col(c).alias(f"_{c}") for c in one], F.struct("name", "arguments", "depends_on").alias("_body"))
    again = alike.join(first, F.expr(" and ".join(f"{c} = _{c}" for c in one)), "inner") \
        .withColumn("more", F.col("times") - F.when(body.eqNullSafe(F.col("_body")), 1).otherwise(0)).where("more > 0") \
        .select(*one, "name", "arguments", F.explode(F.array_repeat(F.lit(None).cast("string"), F.col("more").cast("int")))
                .alias("result"))
    # the turns in which a conversation calls an id: as many as it has turns, at most
    turns = written(kept.groupBy(*KEYS).agg(F.collect_set("turn").alias("turns")), "turns")

    turn = F.col("turn").cast("long") if "turn" in results.columns else F.lit(None).cast("long")
    said = results.where(ids).select("conv_id", "call_id", turn.alias("turn"), "content") \
        .groupBy("conv_id", "call_id", "turn", "content").agg(F.count(F.lit(1)).alias("times"))
    met = written(_nearest(said, "call_id", turns, "at"), "results")
    order = F.struct(F.col("turn").isNull(), "turn", "content")
    answers = met.where("at is not null").groupBy("conv_id", F.col("at").alias("turn"), "call_id") \
        .agg(F.min(order).alias("first")).select(*one, "first", F.col("first.content").alias("result"),
                                                 F.lit(True).alias("answered"))
    told = answers.select(F.col("conv_id").alias("_conv"), F.col("turn").alias("_at"), F.col("call_id").alias("_id"), "first")
    further = met.join(told, (F.col("conv_id") == F.col("_conv")) & (F.col("call_id") == F.col("_id"))
                       & (F.col("at") == F.col("_at")), "left") \
        .withColumn("more", F.col("times") - F.when(order.eqNullSafe(F.col("first")), 1).otherwise(0)).where("more > 0") \
        .select("conv_id", F.coalesce("at", "turn").alias("turn"), "call_id", F.lit(None).cast("string").alias("name"),
                F.lit(None).cast("string").alias("arguments"), F.col("content").alias("result"),
                F.when(F.col("at").isNull(), "orphan").otherwise("duplicate").alias("status"),
                F.explode(F.sequence(F.lit(1), F.col("more").cast("int"))).alias("_copy")).drop("_copy")

    depends = written(_nearest(kept.select("conv_id", F.explode("depends_on").alias("parent"), "turn", "call_id"),
                               "parent", turns, "at"), "depends")
    missing = depends.where("at is null").groupBy(*one).agg(F.count_distinct("parent").alias("n_missing"))
    placed = levels(kept, depends.where("at = turn").select(*one, "parent"))
    linked = kept.drop("depends_on").join(answers.drop("first").hint("shuffle_hash"), one, "left") \
        .join(placed.hint("shuffle_hash"), one, "left").join(missing.hint("shuffle_hash"), one, "left") \
        .withColumn("status", F.when(F.col("answered"), "linked").otherwise("unanswered"))
    none = [F.lit(None).cast("int").alias("level"), F.lit(None).cast("long").alias("n_missing")]
    columns = [*one, "name", "arguments", "result", "status", "level", "n_missing"]
    rows = linked.select(*columns) \
        .unionByName(again.withColumn("status", F.lit("duplicate")).select("*", *none).select(*columns)) \
        .unionByName(further.select("*", *none).select(*columns)) \
        .withColumn("n_missing", F.coalesce("n_missing", F.lit(0)).cast("long"))
    names = ["conv_id", "turn", "call_id", "name", "level", "status", "n_missing"]
    schema = rows.select(*names).schema.add("valid", "boolean").add("errors", "string").add("canonical", "string")

    def judge(i, n, a, r, s):
        if s == "orphan":
            return ["$: no call"], canonical({"id": i, "result": r})
        if s == "duplicate" and n is None and a is None:
            return ["$: not the call's result"], canonical({"id": i, "result": r})
        return examine(i, n, a, r, schemas)

    def check(it):
        for batch in it:
            columns = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
            found = [judge(*x) for x in zip(*(columns[c].to_pylist() for c in
                                              ("call_id", "name", "arguments", "result", "status")))]
            yield pa.RecordBatch.from_arrays(
                [*(columns[n] for n in names), pa.array([not e for e, _ in found], pa.bool_()),
                 pa.array(["; ".join(e) for e, _ in found], pa.string()),
                 pa.array([c for _, c in found], pa.string())], names=[*names, "valid", "errors", "canonical"])

    return rows.mapInArrow(check, schema)


def tool_traffic(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results as ``conversations(conv_id, turn, role, text)`` imply them: every
    sentence of an assistant turn calls a tool, the sentence at its place in the next turn
    answers it, and later sentences depend on earlier ones (the k-th on the k/2-th)."""
    said = conversations.where("text is not null").select(
        "conv_id", "turn", "role", F.posexplode(F.split("text", "[.\\n]\\s*")).alias("k", "s")).where("s <> ''")
    def name(turn, k):
        return F.substring(F.sha2(F.concat_ws(":", "conv_id", turn, k), 256), 1, 24)
    k, n = F.col("k"), F.length("s")
    tool = F.element_at(F.array(*map(F.lit, SCHEMAS)), (n % len(SCHEMAS) + 1).cast("int"))
    depends = F.when((k > 0) & (k % 4 != 3), F.array(name(F.col("turn"), F.floor(k / 2)))) \
        .when(k % 4 == 3, F.array(name(F.col("turn"), F.floor(k / 2)), name(F.col("turn") - 2, k))) \
        .otherwise(F.array().cast("array<string>"))
    arguments = F.when(n % 7 == 0, F.to_json(F.struct((n % 50).alias("limit")))) \
        .when(n % 11 == 0, F.to_json(F.struct((n % 50).cast("string").alias("limit"), F.col("s").alias("query")))) \
        .otherwise(F.to_json(F.struct(F.col("s").alias("query"), (n % 50).alias("limit"))))
    calls = said.where("role = 'assistant'").select(
        "conv_id", "turn", name(F.col("turn"), k).alias("call_id"), tool.alias("name"),
        arguments.alias("arguments"), depends.alias("depends_on"))
    results = said.where("role <> 'assistant'").select(
        "conv_id", name(F.col("turn") - 1, k).alias("call_id"), F.col("s").alias("content"), "turn")
    return calls, results


def query(spark, sf_dir: str) -> DataFrame:
    """op1: every tool call that the conversations imply, linked, ordered and validated."""
    return link_tool_calls(*tool_traffic(read(spark, sf_dir, "conversations")), SCHEMAS)
