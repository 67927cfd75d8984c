"""Chat formatting: links tool calls to their results, orders them, checks arguments, and writes canonical JSON.

Messages are rows (conv_id, turn, role, text, calls, call_id): `calls` is an array of (id, name, arguments) with arguments
as JSON text, `call_id` names the call that a row of role `tool` answers. Arguments may use another call's result by the
string "$result:<id>". Calls and results are hash-joined by (conv_id, id), so a conversation of any length is spread
over tasks; nothing gathers a conversation.

Order. A row's place is (order_turn, order_level, order_slot), comparable inside a conversation. A message stands at its
turn, level 0. A call stands at its turn, or that of the latest call whose result it uses, at a level above that of every
call it uses; its result stands right behind it. So sorting by the place puts every call behind what it depends on and every
result behind its call, wherever the result row came in.

Faults are listed, never dropped: a call's id given twice (the first by turn and slot counts), a call without result, a
result without call, a second result, use of an unknown id, a cycle, an unknown tool, arguments that are no JSON object
(NaN and infinite numbers, numbers out of range, a key given twice, half a surrogate pair and more than DEEPEST levels of nesting
count as such; the text is then written as it is), missing, unknown or wrongly typed arguments. Calls on a cycle keep their own turn at level -1. Null texts are written as
null. Null ids link with nothing. Repeated rows are further calls or results of the same id.
Texts are taken whole, whatever their length; an empty table gives no rows. Only the six columns of a message are read, so others can't clash.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pointloom.llm.common import materialize

MESSAGE = "conv_id long, turn long, role string, text string, calls array<struct<id string, name string, arguments string>>, call_id string"
KINDS = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "object": dict, "array": list}
#: Levels of nesting up to which arguments are taken as JSON.
DEEPEST = 300
_USE = re.compile(r"\$result:(.+)\Z", re.S)

#: Tools by name: {argument: (type, required)}.
Tools = dict[str, dict[str, tuple[str, bool]]]


def canonical(value) -> str:
    """JSON with sorted keys, no spaces and no escapes beyond the needed ones."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def used_ids(value) -> list[str]:
    """Ids of the calls whose results a JSON value uses."""
    found, waiting = set(), [value]
    while waiting:
        v = waiting.pop()
        if isinstance(v, str):
            m = _USE.match(v)
            found.update([m[1]] if m else [])
        elif isinstance(v, (dict, list)):
            waiting.extend(v.values() if isinstance(v, dict) else v)
    return sorted(found)


class Fault(ValueError):
    """Arguments that can't be taken as JSON; the message says why."""


def _number(text: str) -> float:
    value = float(text)
    if not math.isfinite(value):
        raise Fault("arguments hold a number out of range")
    return value


def _constant(name: str):
    raise Fault("arguments are not JSON")  # NaN and Infinity are no JSON


def _object(pairs: list[tuple[str, object]]) -> dict:
    made = dict(pairs)
    if len(made) < len(pairs):
        raise Fault("arguments hold a key twice")
    return made


def _too_deep(value) -> bool:
    level = [value]
    for _ in range(DEEPEST):
        level = [w for v in level if isinstance(v, (dict, list)) for w in (v.values() if isinstance(v, dict) else v)]
        if not level:
            return False
    return True


def parse_arguments(text: str | None):
    """The JSON value of an argument text, which `canonical` can write again; Fault if there is none."""
    try:
        value = json.loads(text or "", parse_float=_number, parse_constant=_constant, object_pairs_hook=_object)
    except Fault:
        raise
    except RecursionError as e:
        raise Fault("arguments are nested too deeply") from e
    except ValueError as e:
        raise Fault("arguments are not JSON") from e
    if _too_deep(value):
        raise Fault("arguments are nested too deeply")
    try:
        canonical(value).encode()
    except UnicodeEncodeError as e:
        raise Fault("arguments hold half a surrogate pair") from e
    return value


def check_call(name: str | None, arguments: str | None, tools: Tools) -> tuple[object, list[str]]:
    """(parsed arguments or the raw text, faults) of a call."""
    try:
        value = parse_arguments(arguments)
    except Fault as e:
        return arguments, [str(e)]
    if not isinstance(value, dict):
        return value, ["arguments are not an object"]
    if name not in tools:
        return value, ["unknown tool"]
    wanted, faults = tools[name], []
    for key, (kind, required) in sorted(wanted.items()):
        if key not in value:
            if required:
                faults.append(f"missing {key}")
        elif isinstance(value[key], bool) and kind in ("integer", "number") or not (
            isinstance(value[key], KINDS[kind]) or isinstance(value[key], str) and _USE.match(value[key])
        ):
            faults.append(f"{key} is not {kind}")
    return value, faults + [f"unknown {key}" for key in sorted(set(value) - set(wanted))]


def written_messages(messages: DataFrame, tools: Tools) -> DataFrame:
    """Messages with json string and checked array<struct<id, name, uses, faults>>."""
    added = "json string, checked array<struct<id string, name string, uses array<string>, faults array<string>>>"
    schema = StructType([*messages.schema, *messages.sparkSession.createDataFrame([], added).schema])
    checked_type = pa.list_(pa.struct([("id", pa.string()), ("name", pa.string()), ("uses", pa.list_(pa.string())), ("faults", pa.list_(pa.string()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, checks = [], []
            for role, text, calls, call_id in zip(*[b.column(b.schema.get_field_index(c)).to_pylist() for c in ("role", "text", "calls", "call_id")], strict=True):
                out, checked = {"role": role, "content": text}, []
                if calls:
                    listed = []
                    for c in (c for c in calls if c is not None):
                        value, faults = check_call(c["name"], c["arguments"], tools)
                        listed.append({"id": c["id"], "type": "function", "function": {"name": c["name"], "arguments": value}})
                        checked.append({"id": c["id"], "name": c["name"], "uses": used_ids(value), "faults": faults})
                    out["tool_calls"] = listed
                if role == "tool":
                    out["tool_call_id"] = call_id
                texts.append(canonical(out))
                checks.append(checked)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string()), pa.array(checks, checked_type)], names=schema.names)

    return messages.mapInArrow(run, schema)


def ordered_calls(calls: DataFrame) -> DataFrame:
    """(conv_id, id, at, level) of each call (conv_id, id, turn, uses): its place; cycles at level -1.

    Level by level: a round settles all calls whose uses are settled, so there are as many rounds as the longest chain of
    uses. Uses of unknown ids don't count.
    """
    known = calls.select("conv_id", "id")
    uses = materialize(
        calls.select("conv_id", "id", F.explode("uses").alias("use")).join(known.withColumnRenamed("id", "use"), ["conv_id", "use"]), "uses"
    )
    waiting = uses.select("conv_id", "id").distinct()
    settled = materialize(
        calls.join(waiting, ["conv_id", "id"], "left_anti").select("conv_id", "id", F.col("turn").alias("at"), F.lit(0).alias("level")), "settled"
    )
    done, left = [settled], uses
    turns = calls.select("conv_id", "id", "turn")
    while not left.isEmpty():
        seen = done[0]
        for d in done[1:]:
            seen = seen.unionByName(d)
        place = seen.select("conv_id", F.col("id").alias("use"), "at", "level")
        state = left.join(place, ["conv_id", "use"], "left").groupBy("conv_id", "id").agg(
            F.max("at").alias("at"), F.max("level").alias("level"), F.max(F.col("level").isNull()).alias("open")
        )
        ready = materialize(
            state.where(~F.col("open")).join(turns, ["conv_id", "id"])
            .select("conv_id", "id", F.greatest("turn", "at").alias("at"), (F.col("level") + 1).alias("level")), "settled"
        )
        if ready.isEmpty():
            cycle = left.select("conv_id", "id").distinct().join(turns, ["conv_id", "id"])
            done.append(cycle.select("conv_id", "id", F.col("turn").alias("at"), F.lit(-1).alias("level")))
            break
        done.append(ready)
        left = materialize(left.join(ready.select("conv_id", "id"), ["conv_id", "id"], "left_anti"), "uses")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def format_chats(messages: DataFrame, tools: Tools) -> DataFrame:
    """kind (message, call, result), conv_id, turn, slot, id, order_turn, order_level, order_slot, faults, json.

    One row for each message (also results) and for each call. `json` of a call is null: it is part of its message's.
    """
    rows = materialize(written_messages(messages.select("conv_id", "turn", "role", "text", "calls", "call_id"), tools), "messages")
    calls = rows.select("conv_id", "turn", F.posexplode("checked").alias("slot", "c")).select(
        "conv_id", "turn", "slot", F.col("c.id").alias("id"), F.col("c.uses").alias("uses"), F.col("c.faults").alias("faults")
    )
    calls = materialize(calls, "calls")
    linked = calls.where("id is not null").groupBy("conv_id", "id").agg(
        F.min(F.struct("turn", "slot", "uses")).alias("c")
    ).select("conv_id", "id", "c.*")
    linked = materialize(linked, "linked")
    place = materialize(ordered_calls(linked).join(linked.select("conv_id", "id", F.col("slot").alias("first_slot"), F.col("turn").alias("first_turn")), ["conv_id", "id"]), "places")
    answers = rows.where("role = 'tool' and call_id is not null").groupBy("conv_id", F.col("call_id").alias("id")).agg(
        F.min("turn").alias("answered")
    )
    missing = calls.where("id is not null").select("conv_id", "turn", "slot", F.explode("uses").alias("id")).join(
        linked.select("conv_id", "id"), ["conv_id", "id"], "left_anti"
    ).groupBy("conv_id", "turn", "slot").agg(F.array_sort(F.collect_set(F.concat(F.lit("uses unknown "), "id"))).alias("lost"))
    full = calls.join(place, ["conv_id", "id"], "left").join(answers, ["conv_id", "id"], "left").join(missing, ["conv_id", "turn", "slot"], "left")
    again = F.col("id").isNotNull() & ((F.col("turn") != F.col("first_turn")) | (F.col("slot") != F.col("first_slot")))
    fault = lambda when, text: F.when(when, F.array(F.lit(text))).otherwise(F.array().cast("array<string>"))
    none = F.array().cast("array<string>")
    call_rows = full.select(
        F.lit("call").alias("kind"), "conv_id", "turn", "slot", "id",
        F.coalesce("at", "turn").alias("order_turn"), F.coalesce("level", F.lit(0)).alias("order_level"), (2 * F.col("slot") + 1).alias("order_slot"),
        F.concat(
            "faults", F.coalesce("lost", none), fault(F.col("id").isNull(), "no id"), fault(again, "id given before"),
            fault(F.col("level") == -1, "cycle"), fault(F.col("answered").isNull(), "no result"),
        ).alias("faults"), F.lit(None).cast("string").alias("json"),
    )
    tool = rows.where("role = 'tool'").select("conv_id", "turn", F.col("call_id").alias("id"), "json")
    result_rows = tool.join(place, ["conv_id", "id"], "left").join(answers, ["conv_id", "id"], "left").select(
        F.lit("result").alias("kind"), "conv_id", "turn", F.lit(None).cast("int").alias("slot"), "id",
        F.coalesce("at", "turn").alias("order_turn"), F.coalesce("level", F.lit(0)).alias("order_level"),
        F.coalesce(2 * F.col("first_slot") + 2, F.lit(0)).alias("order_slot"),
        F.concat(fault(F.col("first_turn").isNull(), "no call"), fault(F.col("turn") > F.col("answered"), "second result")).alias("faults"), "json",
    )
    message_rows = rows.where("coalesce(role, '') <> 'tool'").select(
        F.lit("message").alias("kind"), "conv_id", "turn", F.lit(None).cast("int").alias("slot"), F.lit(None).cast("string").alias("id"),
        F.col("turn").alias("order_turn"), F.lit(-2).alias("order_level"), F.lit(0).alias("order_slot"), none.alias("faults"), "json",
    )
    return message_rows.unionByName(call_rows).unionByName(result_rows)


# The tools that the query's derived calls name.
TOOLS: Tools = {
    "search": {"query": ("string", True), "limit": ("integer", False)},
    "lookup": {"query": ("string", True), "exact": ("boolean", False)},
    "convert": {"query": ("string", True), "limit": ("number", True)},
}


def with_tool_calls(conversations: DataFrame) -> DataFrame:
    """Conversations as messages with calls and results that follow from their texts.

    Turns are spread by ten. Each assistant turn calls the tool that its length picks, with its first words and number of
    words as arguments; every third one uses the result of the call two turns before. Its last line comes back as the
    result: just after it, or, by length, a turn too early, or not at all.
    """
    size, words = F.length("text"), F.regexp_count("text", F.lit(r"\S+"))
    call_id = lambda turn: F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))
    query = F.when(size % 3 == 0, F.concat(F.lit("$result:"), call_id(F.col("turn") - 2))).otherwise(
        F.array_join(F.slice(F.split("text", r"\s+"), 1, 5), " ")
    )
    calls = F.when(
        F.col("role") == "assistant",
        F.array(F.struct(
            call_id(F.col("turn")).alias("id"),
            F.element_at(F.array(*map(F.lit, [*TOOLS, "shout"])), (size % 4 + 1).cast("int")).alias("name"),
            F.when(size % 11 == 0, F.col("text")).otherwise(F.to_json(F.struct(query.alias("query"), words.alias("limit")))).alias("arguments"),
        )),
    )
    none = F.lit(None).cast("array<struct<id string, name string, arguments string>>")
    shown = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), (F.col("turn") * 10).alias("turn"), "role", "text",
        F.coalesce(calls, none).alias("calls"), F.lit(None).cast("string").alias("call_id"),
    )
    results = conversations.where((F.col("role") == "assistant") & (size % 13 != 0)).select(
        F.col("conv_id").cast("long").alias("conv_id"), (F.col("turn") * 10 + F.when(size % 7 == 0, -15).otherwise(1)).alias("turn"),
        F.lit("tool").alias("role"), F.element_at(F.split("text", "\n"), -1).alias("text"), none.alias("calls"), call_id(F.col("turn")).alias("call_id"),
    )
    return shown.unionByName(results)


def op6_chats(conversations: DataFrame) -> DataFrame:
    """All messages, calls and results of the conversations in their order."""
    return format_chats(with_tool_calls(conversations), TOOLS)
