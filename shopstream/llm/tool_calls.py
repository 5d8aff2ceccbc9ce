"""Chat formatting: link tool calls with their results.

1. Link: calls and results are reduced to one row per (conversation, call id)
   with partial aggregates (the first by turn and content stays, the rest are
   counted), then joined on that key; a hot conversation is spread over its
   call ids and a repeated id is one row.
2. Order: a call may name calls it comes after. Where every such call has an
   earlier turn, the turns are a topological order already. Conversations with
   another dependency are layered (longest path), each in one task; those too
   large for that in rounds of joins, which take the calls that wait for no
   open call and skip over calls that wait for one, so that chains take rounds
   by the logarithm of their length. What is left waits in a cycle.
   Positions come from a range sort by (conversation, layer, turn, id) and a
   prefix sum over ranges, so a conversation may span many tasks.
3. Validate: arguments are parsed and checked against the tool's JSON schema
   (type, required, properties, additionalProperties, items, enum, minimum,
   maximum, minLength, maxLength).
4. Serialise: canonical JSON - keys sorted, no blanks, text as UTF-8.

status: ``linked``, ``no_result``, ``orphan_result`` (no call), ``early_result``
(result before its call), ``cycle``. Calls that depend on an unknown call
report ``unknown dependency``; the dependency orders nothing.

Defined results: null ids link with null ids; null or malformed arguments,
numbers beyond a double (or of over 4,300 digits), nesting of over 200 levels,
repeated keys and unknown tools make a call invalid, with the reason in
``errors`` and null arguments in the message; null content is JSON null;
repeated calls and results are counted in ``n_calls`` and ``n_results``. Other
columns of the inputs are not read. Empty inputs give no rows.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise, scratch_path
from .common import join_safe

_TYPES = {"string": str, "boolean": bool, "object": dict, "array": list, "null": type(None)}


#: Deepest nesting of arguments.
MOST_LEVELS = 200


class _Repeated(ValueError):
    pass


def _pairs(pairs: list[tuple[str, object]]) -> dict:
    out = dict(pairs)
    if len(out) < len(pairs):
        raise _Repeated
    return out


def _constant(name: str) -> object:
    raise ValueError(name)


def _float(text: str) -> float:
    value = float(text)
    if math.isinf(value):  # beyond a double
        raise ValueError(text)
    return value


def _too_deep(value: object) -> bool:
    level = [value]
    for _ in range(MOST_LEVELS + 1):
        level = [x for v in level if isinstance(v, (dict, list)) for x in (v.values() if isinstance(v, dict) else v)]
        if not level:
            return False
    return True


def parse(text: str | None) -> tuple[object, str | None]:
    """(value, None) of strict JSON, or (None, why not)."""
    if text is None:
        return None, "no arguments"
    try:
        value = json.loads(text, object_pairs_hook=_pairs, parse_constant=_constant, parse_float=_float)
    except _Repeated:
        return None, "repeated key"
    except RecursionError:
        return None, "nested too deep"
    except ValueError:
        return None, "not JSON"
    return (None, "nested too deep") if _too_deep(value) else (value, None)


def canonical(value: object) -> str:
    """Sorted keys, no blanks, whole floats as integers, UTF-8 where possible."""
    text = json.dumps(_plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    if any(0xD800 <= ord(c) < 0xE000 for c in text):  # a lone surrogate has no UTF-8
        text = json.dumps(_plain(value), sort_keys=True, separators=(",", ":"))
    return text


def _plain(v: object) -> object:
    if isinstance(v, dict):
        return {k: _plain(x) for k, x in v.items()}
    if isinstance(v, list):
        return [_plain(x) for x in v]
    if isinstance(v, float) and math.isfinite(v) and v.is_integer() and abs(v) < 2**53:
        return int(v)
    return v


def _is(value: object, kind: str) -> bool:
    if kind in ("number", "integer"):
        number = isinstance(value, (int, float)) and not isinstance(value, bool)
        return number and (kind == "number" or isinstance(value, int) or value.is_integer())
    return isinstance(value, _TYPES.get(kind, object))


def violations(value: object, schema: dict, path: str = "$") -> list[str]:
    """Broken rules of a JSON schema (the keywords named above)."""
    kinds = schema.get("type")
    if kinds is not None and not any(_is(value, k) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return [f"{path}: type"]
    out = []
    if "enum" in schema and canonical(value) not in map(canonical, schema["enum"]):  # true is not 1
        out.append(f"{path}: enum")
    if isinstance(value, str):
        size = len(value)
        out += [f"{path}: minLength"] * (size < schema.get("minLength", 0))
        out += [f"{path}: maxLength"] * (size > schema.get("maxLength", size))
    if _is(value, "number"):
        out += [f"{path}: minimum"] * (value < schema.get("minimum", value))
        out += [f"{path}: maximum"] * (value > schema.get("maximum", value))
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            out += violations(x, schema["items"], f"{path}[{i}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{path}.{k}: required" for k in schema.get("required", []) if k not in value]
        for k in sorted(value):
            if k in known:
                out += violations(value[k], known[k], f"{path}.{k}")
            elif schema.get("additionalProperties", True) is False:
                out.append(f"{path}.{k}: not allowed")
    return out


def link(calls: DataFrame, results: DataFrame) -> DataFrame:
    """One row per (conv_id, call_id) with the first call, the first result,
    counts of both and the status."""
    one_call = calls.groupBy("conv_id", "call_id").agg(
        F.min(F.struct("turn", "name", "arguments", "after")).alias("c"), F.count(F.lit(1)).alias("n_calls"))
    one_result = results.groupBy("conv_id", "call_id").agg(
        F.min(F.struct("turn", "content")).alias("r"), F.count(F.lit(1)).alias("n_results"))
    theirs = one_result.select(F.col("conv_id").alias("r_conv"), F.col("call_id").alias("r_call"), "r", "n_results")
    both = one_call.join(theirs, F.col("conv_id").eqNullSafe(F.col("r_conv"))
                         & F.col("call_id").eqNullSafe(F.col("r_call")), "full_outer")
    has_call, has_result = F.col("c").isNotNull(), F.col("r").isNotNull()
    status = (F.when(~has_call, "orphan_result").when(~has_result, "no_result")
              .when(F.col("r.turn") < F.col("c.turn"), "early_result").otherwise("linked"))
    pick = [F.when(has_call, F.col(a)).otherwise(F.col(b)).alias(a)
            for a, b in (("conv_id", "r_conv"), ("call_id", "r_call"))]
    return both.select(
        *pick, F.coalesce("c.turn", "r.turn").alias("turn"), "c.name", "c.arguments", "c.after", "r.content",
        F.coalesce("n_calls", F.lit(0)).alias("n_calls"), F.coalesce("n_results", F.lit(0)).alias("n_results"),
        status.alias("status"))


#: Above every layer; bounds what a cycle adds up to.
_MOST_LAYERS = 1 << 40

#: Size (ids and 100 bytes an edge) up to which one task orders a conversation.
MOST_BYTES = 32 << 20

_LAYERS = "conv_id {conv}, call_id string, layer long"


def _layered(table: pa.Table) -> pa.Table:
    """Layers of one conversation's calls; a row is a call or one dependency."""
    conv = table["conv_id"][0]
    rows = list(zip(table["call_id"].to_pylist(), table["dep"].to_pylist(), table["edge"].to_pylist()))
    waits = {call: 0 for call, _, _ in rows}
    after: dict[str | None, list[str | None]] = {}
    for call, dep, edge in rows:
        if edge:
            waits[call] += 1
            after.setdefault(dep, []).append(call)
    layer: dict[str | None, int | None] = dict.fromkeys(waits)
    ready, depth = [c for c, n in waits.items() if not n], 0
    while ready:
        following = []
        for c in ready:
            layer[c] = depth
            for d in after.get(c, ()):
                waits[d] -= 1
                if not waits[d]:
                    following.append(d)
        ready, depth = following, depth + 1
    return pa.table([pa.array([conv.as_py()] * len(layer), conv.type), pa.array(list(layer), pa.string()),
                     pa.array(list(layer.values()), pa.int64())], names=["conv_id", "call_id", "layer"])


def dependency_layers(linked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(layers, unknown): layer of the calls of conversations that turns alone
    do not order (null: in or behind a cycle), and (conv_id, call_id) of calls
    that name an unknown call.

    A conversation of up to ``MOST_BYTES`` is ordered in one task, in time
    linear in its edges; larger ones by ``_rounds`` over all their calls.
    """
    spark = linked.sparkSession
    calls = linked.where("status <> 'orphan_result'").select("conv_id", "call_id", "turn")
    edges = (linked.where("status <> 'orphan_result'")
             .select("conv_id", "call_id", "turn", F.explode("after").alias("dep")).distinct())
    known = calls.select("conv_id", F.col("call_id").alias("dep"), F.col("turn").alias("dep_turn"))
    known = known.withColumn("known", F.lit(True))
    resolved = materialise(join_safe(edges, known, ["conv_id", "dep"], "left").withColumn(
        "known", F.coalesce("known", F.lit(False))), "call-edges")
    unknown = resolved.where("not known").select("conv_id", "call_id").distinct()
    wrong = resolved.where("known and not coalesce(dep_turn < turn, false)").select("conv_id").distinct()
    edge = F.lit(True).alias("edge")
    waiting = join_safe(resolved.where("known").select("conv_id", "call_id", "dep", edge), wrong, ["conv_id"], "left_semi")
    alone = join_safe(calls.select("conv_id", "call_id", F.lit(None).cast("string").alias("dep"), (~edge).alias("edge")),
                      wrong, ["conv_id"], "left_semi")
    rows = materialise(alone.unionByName(waiting), "call-waits")
    size = F.sum(F.lit(100) + F.coalesce(F.octet_length("call_id"), F.lit(0)) + F.coalesce(F.octet_length("dep"), F.lit(0)))
    large = materialise(rows.groupBy("conv_id").agg(size.alias("size")).where(F.col("size") > MOST_BYTES)
                        .select("conv_id"), "large-logs")
    schema = _LAYERS.format(conv=linked.schema["conv_id"].dataType.simpleString())
    layers = join_safe(rows, large, ["conv_id"], "left_anti").groupBy("conv_id").applyInArrow(_layered, schema)
    if large.take(1):
        layers = layers.unionByName(_rounds(join_safe(rows, large, ["conv_id"], "left_semi")))
    return layers, unknown


def _rounds(rows: DataFrame) -> DataFrame:
    """Layers of the calls of rows (conv_id, call_id, dep, edge) in rounds.

    The layer of a call is ``max(least, layer(dep) + far)`` over its open
    dependencies. A round takes the calls without open dependencies, then
    replaces every edge to a taken call by a bound and every edge to a call
    with one open dependency by an edge to that dependency. A chain so halves
    in each round instead of losing one call, and edges never grow in number.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "call-layers")
    schema = rows.select("conv_id", "call_id").schema.add("layer", "long")
    open_calls = rows.where("not edge").select("conv_id", "call_id", F.lit(0).cast("long").alias("least"))
    waits = rows.where("edge").select("conv_id", "call_id", "dep", F.lit(1).cast("long").alias("far"))
    while True:
        counted = waits.groupBy("conv_id", "call_id").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("dep", "far")).alias("only"))
        state = materialise(join_safe(open_calls, counted, ["conv_id", "call_id"], "left"), "call-state")
        ready = state.where("n is null")
        some = bool(ready.take(1))
        part = ready if some else state  # what no round takes is in or behind a cycle
        part.select("conv_id", "call_id", (F.col("least") if some else F.lit(None)).cast("long").alias("layer")) \
            .write.mode("append").parquet(path)
        if not some:
            return spark.read.schema(schema).parquet(path)
        taken = ready.select("conv_id", F.col("call_id").alias("dep"), F.col("least").alias("dep_least"))
        one = state.where("n = 1").select("conv_id", "call_id", "least", "only", F.col("only.dep").alias("dep"))
        one = join_safe(one, taken.withColumn("gone", F.lit(True)), ["conv_id", "dep"], "left")
        theirs = taken.select("*", F.lit(None).cast(one.schema["only"].dataType).alias("only")).unionByName(one.select(
            "conv_id", F.col("call_id").alias("dep"),
            F.greatest("least", F.col("dep_least") + F.col("only.far")).alias("dep_least"),
            F.when(F.col("gone").isNull(), F.col("only")).alias("only"))).withColumn("short", F.lit(True))
        steps = materialise(join_safe(waits, theirs, ["conv_id", "dep"], "left"), "call-steps")
        bounds = steps.where("short").groupBy("conv_id", "call_id").agg(
            F.max(F.least(F.col("dep_least") + F.col("far"), F.lit(_MOST_LAYERS))).alias("bound"))
        open_calls = materialise(join_safe(state.where("n is not null").select("conv_id", "call_id", "least"),
                                           bounds, ["conv_id", "call_id"], "left").select(
            "conv_id", "call_id", F.greatest("least", "bound").alias("least")), "open-calls")
        over = F.col("only").isNotNull()
        waits = materialise(steps.where("short is null or only is not null").select(
            "conv_id", "call_id", F.when(over, F.col("only.dep")).otherwise(F.col("dep")).alias("dep"),
            F.least(F.col("far") + F.when(over, F.col("only.far")).otherwise(0), F.lit(_MOST_LAYERS)).alias("far"))
            .groupBy("conv_id", "call_id", "dep").agg(F.max("far").alias("far")), "open-waits")


def ordered(linked: DataFrame) -> DataFrame:
    """linked with layer, unknown_dep and position (from 1) per conversation."""
    layers, unknown = dependency_layers(linked)
    layers, unknown = layers.withColumn("layered", F.lit(True)), unknown.withColumn("unknown_dep", F.lit(True))
    wide = join_safe(linked, layers, ["conv_id", "call_id"], "left")
    wide = join_safe(wide, unknown, ["conv_id", "call_id"], "left").withColumn(
        "unknown_dep", F.coalesce("unknown_dep", F.lit(False)))
    cyclic = F.coalesce("layered", F.lit(False)) & F.col("layer").isNull()
    wide = wide.withColumn("status", F.when(cyclic, "cycle").otherwise(F.col("status"))).withColumn(
        "layer", F.when(cyclic, F.lit(_MOST_LAYERS)).otherwise(F.coalesce("layer", F.lit(0)))).drop("layered")
    order = ("conv_id", "layer", "turn", "call_id")
    placed = materialise(wide.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "call-order")
    counts = placed.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("conv_id", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = placed.withColumn("nth", F.row_number().over(
        Window.partitionBy("conv_id", "part").orderBy("layer", "turn", "call_id")))
    return join_safe(numbered, starts, ["conv_id", "part"]).select(
        *wide.columns, (F.col("before") + F.col("nth")).alias("position"))


def formatted(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """All four steps. calls: conv_id, call_id, turn, name, arguments (JSON),
    after (array of call ids); results: conv_id, call_id, turn, content;
    schemas: name, schema (JSON), one row per tool."""
    linked = materialise(link(calls, results), "linked-calls")
    rows = ordered(linked)
    tools = schemas.groupBy("name").agg(F.min("schema").alias("schema"))
    rows = rows.join(tools, "name", "left")
    out_schema = rows.select("conv_id", "position", "call_id", "turn", "name", "status", "n_calls", "n_results").schema
    out_schema = (out_schema.add("valid", "boolean").add("errors", T.ArrayType(T.StringType())).add("message", "string"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            valid, errors, messages = [], [], []
            cols = {c: b.column(i) for i, c in enumerate(b.schema.names)}
            for r in zip(*(cols[c].to_pylist() for c in (
                    "status", "call_id", "name", "arguments", "schema", "content", "unknown_dep"))):
                status, call_id, name, arguments, schema, content, unknown_dep = r
                value, bad = (None, None) if status == "orphan_result" else parse(arguments)
                errs = [bad] if bad else []
                if status == "orphan_result":
                    errs.append("no call")
                elif schema is None:
                    errs.append("unknown tool")
                elif not bad:
                    errs += violations(value, json.loads(schema))
                if unknown_dep:
                    errs.append("unknown dependency")
                valid.append(not errs)
                errors.append(errs)
                messages.append(canonical({"arguments": value, "call_id": call_id, "name": name, "result": content}))
            yield pa.RecordBatch.from_arrays(
                [cols[c] for c in out_schema.names[:8]] + [
                    pa.array(valid, pa.bool_()), pa.array(errors, pa.list_(pa.string())),
                    pa.array(messages, pa.string())], names=out_schema.names)

    return rows.mapInArrow(check, out_schema)
