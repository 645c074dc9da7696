"""Tool-call linking: calls and results joined by identifier, ordered, checked, serialised.

Calls and results carry an identifier that is unique in a conversation.  The
result side is first reduced to one row per identifier, so that the hash join
of calls with results never multiplies rows, however often an identifier
repeats.  A call may name calls it depends on.  The topological order is that
of positions, except where a call stands before one it depends on: such a call
is pushed behind it.  Pushes spread in rounds over the dependency edges (joins
of the calls that still move), so no conversation meets in one task.
Arguments are checked against the tool's schema and serialised as canonical
JSON (sorted keys, shortest numbers, no white space).
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.llm.common import numbered, read_table, ship_package, stored

CALLS = "array<struct<id:string,name:string,arguments:string,after:array<string>>>"


# ---------------------------------------------------------------- JSON kernel

def _number(x: float) -> str:
    """The shortest form of a number, as ECMAScript prints it."""
    if x == 0:
        return "0"
    mantissa, _, power = repr(abs(x)).partition("e")
    whole, _, part = mantissa.partition(".")
    part = "" if part == "0" else part
    digits, point = whole + part, len(whole) + int(power or 0)
    stripped = digits.lstrip("0")
    point -= len(digits) - len(stripped)
    digits = stripped.rstrip("0") or "0"
    n = len(digits)
    if n <= point <= 21:
        out = digits + "0" * (point - n)
    elif 0 < point <= 21:
        out = f"{digits[:point]}.{digits[point:]}"
    elif -6 < point <= 0:
        out = "0." + "0" * -point + digits
    else:
        e = point - 1
        out = digits[0] + ("." + digits[1:] if n > 1 else "") + f"e{'+' if e >= 0 else '-'}{abs(e)}"
    return ("-" if x < 0 else "") + out


def canonical(value) -> str:
    """Canonical JSON of a parsed value; integers beyond 2**53 keep their digits."""
    if isinstance(value, dict):
        keys = sorted(value, key=lambda k: k.encode("utf-16-be", "surrogatepass"))
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{canonical(value[k])}" for k in keys) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(canonical, value)) + "]"
    if isinstance(value, float):
        return _number(value)
    return json.dumps(value, ensure_ascii=False)


TYPES = {
    "object": lambda v: isinstance(v, dict), "array": lambda v: isinstance(v, list),
    "string": lambda v: isinstance(v, str), "boolean": lambda v: isinstance(v, bool),
    "null": lambda v: v is None,
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "integer": lambda v: not isinstance(v, bool) and (isinstance(v, int) or isinstance(v, float) and v.is_integer()),
}


def violations(value, schema: dict, at: str = "$") -> list[str]:
    """Where a value breaks a JSON schema (type, enum, bounds, items, properties, required)."""
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(TYPES[k](value) for k in kinds):
        return [f"{at}: not {' or '.join(kinds)}"]
    found = []
    if "enum" in schema and not any(canonical(value) == canonical(e) for e in schema["enum"]):
        found.append(f"{at}: not one of the listed values")
    if TYPES["number"](value):
        if value < schema.get("minimum", -math.inf) or value > schema.get("maximum", math.inf):
            found.append(f"{at}: out of bounds")
    size, least, most = {str: (len, "minLength", "maxLength"), list: (len, "minItems", "maxItems")}.get(
        type(value), (None, "", ""))
    if size and not schema.get(least, 0) <= size(value) <= schema.get(most, math.inf):
        found.append(f"{at}: wrong length")
    if isinstance(value, list) and "items" in schema:
        for i, v in enumerate(value):
            found += violations(v, schema["items"], f"{at}[{i}]")
    if isinstance(value, dict):
        inside = schema.get("properties", {})
        found += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for k, v in value.items():
            if k in inside:
                found += violations(v, inside[k], f"{at}.{k}")
            elif schema.get("additionalProperties", True) is False:
                found.append(f"{at}.{k}: not allowed")
    return found


def _no_constant(name: str):
    raise ValueError(f"{name} is not JSON")


def check_arguments(name: str | None, arguments: str | None, schemas: dict[str, dict]) -> tuple[str | None, list[str]]:
    """(canonical arguments, errors); canonical is null if they are no JSON."""
    try:
        value = json.loads(arguments if arguments is not None else "", parse_constant=_no_constant)
        text = canonical(value)
    except (ValueError, RecursionError):
        return None, ["$: not JSON"]
    if name not in schemas:
        return text, ["unknown tool"]
    return text, violations(value, schemas[name])


# ----------------------------------------------------------------- operators

def calls_of(messages: DataFrame) -> DataFrame:
    """One row per call: conv_id, turn, place, call_id, name, arguments, after.

    Calls stand in assistant messages as JSON ``{"tool_calls": [...]}``; other
    texts hold none.
    """
    parsed = F.from_json("text", f"tool_calls {CALLS}")
    return (messages.where("role = 'assistant' and text like '%tool_calls%'")
            .select("conv_id", "turn", F.posexplode(parsed["tool_calls"]).alias("place", "c"))
            .select("conv_id", "turn", "place", F.col("c.id").alias("call_id"), "c.name", "c.arguments", "c.after"))


def results_of(messages: DataFrame) -> DataFrame:
    """One row per result message: conv_id, turn, call_id, content."""
    parsed = F.from_json("text", "tool_call_id string, content string")
    return (messages.where("role = 'tool'").select("conv_id", "turn", parsed.alias("r"))
            .select("conv_id", "turn", F.col("r.tool_call_id").alias("call_id"), F.col("r.content").alias("content")))


def _pushed(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, behind, hops, cyclic) of the calls that must move behind a later one.

    ``behind`` is the largest position among the calls it waits for, directly
    or through others; it only grows, so its rounds end on cycles too.  Calls
    behind the same position are then ranked by the longest chain of
    dependencies among them (``hops``); a chain longer than their number means
    that the call is on a cycle, or waits for one at the same position.  The
    usual conversation costs one round of either.
    """
    firsts = calls.where("first").select("conv_id", "call_id", "position", "after")
    edges = stored(firsts.select("conv_id", "call_id", "position", F.explode("after").alias("on"))
                   .where("on is not null").distinct()
                   .join(firsts.select("conv_id", F.col("call_id").alias("on"), F.col("position").alias("on_position")),
                         ["conv_id", "on"]), "tools-edges")
    moved = stored(edges.where("on_position >= position").groupBy("conv_id", "call_id")
                   .agg(F.max("on_position").alias("behind")), "tools-moved")
    while True:
        later = moved.select("conv_id", F.col("call_id").alias("on"), F.col("behind").alias("on_behind"))
        push = (edges.join(later, ["conv_id", "on"]).where("on_behind >= position")
                .groupBy("conv_id", "call_id").agg(F.max("on_behind").alias("p")))
        both = moved.join(push, ["conv_id", "call_id"], "full").select(
            "conv_id", "call_id", F.greatest("behind", "p").alias("n"), "behind")
        both = stored(both.select("conv_id", "call_id", F.col("n").alias("behind"),
                                  (~F.col("n").eqNullSafe(F.col("behind"))).alias("changed")), "tools-moved")
        grown = both.where("changed").limit(1).count()
        moved = both.drop("changed")
        if not grown:
            break
    sizes = moved.groupBy("conv_id", "behind").agg(F.count("*").alias("size"))
    moved = stored(moved.join(sizes, ["conv_id", "behind"]).withColumn("hops", F.lit(1)).withColumn(
        "cyclic", F.lit(False)), "tools-hops")
    place = moved.select("conv_id", "call_id", "behind")
    level = stored(edges.select("conv_id", "call_id", "on").join(place, ["conv_id", "call_id"])
                   .join(place.withColumnRenamed("call_id", "on"), ["conv_id", "on", "behind"])
                   .select("conv_id", "call_id", "on"), "tools-level")
    while True:
        later = moved.select("conv_id", F.col("call_id").alias("on"), F.col("hops").alias("on_hops"),
                             F.col("cyclic").alias("on_cyclic"))
        push = (level.join(later, ["conv_id", "on"]).groupBy("conv_id", "call_id")
                .agg((F.max("on_hops") + 1).alias("h"), F.max("on_cyclic").alias("c")))
        nxt = moved.join(push, ["conv_id", "call_id"], "left")
        hops = F.when(F.col("cyclic"), F.col("hops")).otherwise(F.greatest("hops", F.coalesce("h", F.lit(1))))
        cyclic = F.col("cyclic") | F.coalesce("c", F.lit(False)) | (hops > F.col("size"))
        nxt = stored(nxt.select("conv_id", "call_id", "behind", "size", hops.alias("hops"), cyclic.alias("cyclic"),
                                ((hops > F.col("hops")) | (cyclic & ~F.col("cyclic"))).alias("changed")), "tools-hops")
        if not nxt.where("changed").limit(1).count():
            return nxt.select("conv_id", "call_id", "behind", "hops", "cyclic")
        moved = nxt.drop("changed")


def link(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per call, and per result without a call.

    Columns: conv_id, call_id, name, turn, place (of the call), result_turn,
    rank (topological, from 0 inside the conversation; null for results
    without a call), status, errors, json (the linked call in canonical JSON).

    status, the first that holds: ``no_id`` (null id), ``duplicate`` (a call
    whose id an earlier call has; it links to nothing), ``cycle`` (on a cycle of
    dependencies, or waiting for one at the same position), ``early``
    (the result stands before the call), ``unanswered``, ``invalid`` (broken
    arguments), ``linked``; ``orphan`` for a result without a call.  Of several
    results of an id the first counts.  A null conv_id is a conversation of
    its own.  Malformed messages hold no call; extra columns are ignored; an
    empty table gives an empty result.
    """
    spark = messages.sparkSession
    ship_package(spark)
    # as text with a mark, so that no conversation shares the null one's key
    key = F.when(F.col("conv_id").isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), F.col("conv_id").cast("string")))
    messages = messages.select(key.alias("conv_id"),
                               F.col("conv_id").alias("conv"), "turn", "role", "text")
    ids = messages.groupBy("conv_id").agg(F.first("conv").alias("conv"))
    calls = numbered(calls_of(messages), ["conv_id"], ["turn", "place", "call_id", "arguments"], "position", "tools-calls")
    firsts = (calls.where("call_id is not null").groupBy("conv_id", "call_id")
              .agg(F.min("position").alias("first_position")))
    calls = calls.join(firsts, ["conv_id", "call_id"], "left").withColumn(
        "first", F.coalesce(F.col("position") == F.col("first_position"), F.lit(False))).drop("first_position")
    calls = stored(calls, "tools-numbered")
    results = (results_of(messages).where("call_id is not null").groupBy("conv_id", "call_id")
               .agg(F.min(F.struct("turn", "content")).alias("result")))
    moved = _pushed(calls)
    key = ["conv_id", "call_id"]
    answered = calls.where("first").join(moved, key, "left").join(results, key, "full")
    rest = calls.where("not first")
    for c, kind in (("behind", "long"), ("hops", "int"), ("cyclic", "boolean")):
        rest = rest.withColumn(c, F.lit(None).cast(kind))
    rest = rest.withColumn("result", F.lit(None).cast(answered.schema["result"].dataType))
    rows = answered.unionByName(rest)

    def serialise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for call_id, name, arguments, content in zip(b["call_id"], b["name"], b["arguments"], b["content"]):
                args, errors = check_arguments(name, arguments, schemas)
                call = {"id": call_id, "name": name, "arguments": json.loads(args) if args is not None else arguments,
                        "result": content}
                out.append((canonical(call), errors))
            got = pd.DataFrame(out, columns=["json", "errors"], index=b.index)
            yield pd.concat([b.drop(columns=["arguments", "content"]), got], axis=1)

    text = ["conv_id", "call_id", "name", "arguments", "content"]
    numbers = ["turn", "place", "result_turn", "position", "behind", "hops"]
    flat = rows.where("position is not null").select(
        "conv_id", "call_id", "name", "arguments", F.col("result.content").alias("content"),
        *[F.col(c).cast("string").alias(c) for c in ("turn", "place", "position", "behind", "hops")],
        F.col("result.turn").cast("string").alias("result_turn"),
        F.when(F.col("call_id").isNull(), "no_id").when(~F.col("first"), "duplicate").when(F.col("cyclic"), "cycle")
        .when(F.col("result.turn") < F.col("turn"), "early").when(F.col("result").isNull(), "unanswered").alias("fault"))
    kept = [c for c in flat.columns if c not in ("arguments", "content")]
    made = flat.mapInPandas(serialise, ", ".join(f"{c} string" for c in kept) + ", json string, errors array<string>")
    made = made.select(*[c for c in text if c in kept], *[F.col(c).cast("long").alias(c) for c in numbers],
                       F.coalesce("fault", F.when(F.size("errors") > 0, "invalid").otherwise("linked")).alias("status"),
                       "errors", "json")
    made = made.withColumn("late", F.coalesce("behind", "position")).withColumn("pushes", F.coalesce("hops", F.lit(0)))
    ranked = numbered(made, ["conv_id"], ["late", "pushes", "position"], "rank", "tools-ranked")
    orphans = answered.where("position is null").select(
        "conv_id", "call_id", F.lit(None).cast("string").alias("name"), F.lit(None).cast("long").alias("turn"),
        F.lit(None).cast("long").alias("place"), F.col("result.turn").cast("long").alias("result_turn"),
        F.lit(None).cast("long").alias("rank"), F.lit("orphan").alias("status"),
        F.array().cast("array<string>").alias("errors"), F.lit(None).cast("string").alias("json"))
    out = ranked.select("conv_id", "call_id", "name", "turn", "place", "result_turn", "rank", "status", "errors", "json"
                        ).union(orphans)
    return out.join(ids, "conv_id").select(F.col("conv").alias("conv_id"), *[c for c in out.columns if c != "conv_id"])


# --------------------------------------------------------------------- query

SCHEMAS = {
    "search": {"type": "object", "required": ["query"], "additionalProperties": False,
               "properties": {"query": {"type": "string", "minLength": 1}, "limit": {"type": "integer", "minimum": 1,
                                                                                      "maximum": 50}}},
    "measure": {"type": "object", "required": ["words", "share"], "additionalProperties": False,
                "properties": {"words": {"type": "integer", "minimum": 1}, "share": {"type": "number", "maximum": 20}}},
    "note": {"type": "object", "required": ["tags"], "additionalProperties": False,
             "properties": {"tags": {"type": "array", "minItems": 1, "items": {"type": "string"}}}},
}


def derived_messages(conversations: DataFrame) -> DataFrame:
    """Tool messages made from ``conversations``: conv_id, turn, role, text.

    The table has prose only.  Every non-blank line of an assistant turn
    becomes a call of the tool that its number of words picks, with arguments
    from the line; it depends on the next line's call if the line's length is
    a multiple of 5, on the one two lines before if of 4, and on a line of the
    previous assistant turn if of 3.  The following turn holds the results:
    one per call whose line has not a multiple of 7 characters.
    """
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike(r"\S"))
    name = lambda t, i: F.concat(F.lit("c"), t.cast("string"), F.lit("_"), i.cast("string"))

    def call(line, i):
        n, w = F.length(line), F.split(F.trim(line), r"\s+")
        on = F.filter(F.array(F.when(n % 5 == 0, name(F.col("turn"), i + 1)), F.when(n % 4 == 0, name(F.col("turn"), i - 2)),
                              F.when(n % 3 == 0, name(F.col("turn") - 2, F.lit(0)))), lambda x: x.isNotNull())
        search = F.to_json(F.struct(F.element_at(w, 1).alias("query"), (n % 60).alias("limit")))
        measure = F.to_json(F.struct(F.size(w).alias("words"), (n / F.size(w)).alias("share")))
        note = F.to_json(F.struct(F.slice(w, 1, n % 4).alias("tags")))
        tool = F.size(w) % 3
        return F.struct(name(F.col("turn"), i).alias("id"),
                        F.when(tool == 0, "search").when(tool == 1, "measure").otherwise("note").alias("name"),
                        F.when(tool == 0, search).when(tool == 1, measure).otherwise(note).alias("arguments"), on.alias("after"))

    spoken = conversations.where("role = 'assistant'").select("conv_id", "turn", lines.alias("lines"))
    calls = spoken.where(F.size("lines") > 0).select(
        "conv_id", "turn", F.lit("assistant").alias("role"),
        F.to_json(F.struct(F.transform("lines", call).alias("tool_calls"))).alias("text"))
    results = (spoken.select("conv_id", "turn", F.posexplode("lines").alias("i", "line")).where(F.length("line") % 7 != 0)
               .select("conv_id", (F.col("turn") + 1).alias("turn"), F.lit("tool").alias("role"),
                       F.to_json(F.struct(name(F.col("turn"), F.col("i")).alias("tool_call_id"),
                                          F.sha1("line").alias("content"))).alias("text")))
    return calls.union(results)


def op1_tool_call_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linked calls of the tool messages derived from every row of ``conversations``."""
    return link(derived_messages(read_table(spark, sf_dir, "conversations")), SCHEMAS)
