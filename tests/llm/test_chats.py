"""Linking, order, checks and canonical JSON of chats against a version for one conversation at a time."""

import json
from collections import defaultdict

from pointloom.llm import chats as C


def brute(messages, tools):
    """messages: (conv_id, turn, role, text, calls, call_id) -> sorted rows of format_chats."""
    by, out = defaultdict(list), []
    for m in messages:
        by[m[0]].append(m)
    for conv, ms in by.items():
        calls = [(t, s, i, n, a) for _, t, _, _, cs, _ in ms for s, (i, n, a) in enumerate(cs or [])]
        parsed = {}
        first, uses = {}, {}
        for t, s, i, n, a in sorted(calls, key=lambda c: c[:2]):
            if i is not None and (i not in first or (t, s) < first[i]):
                first[i] = (t, s)
        for t, s, i, n, a in calls:
            parsed[(t, s, i)] = C.check_call(n, a, tools)
            if i is not None and first[i] == (t, s):
                uses[i] = [u for u in C.used_ids(parsed[(t, s, i)][0]) if any(c[2] == u for c in calls)]
        place = {}
        while True:
            new = {
                i: (max([first[i][0], *(place[u][0] for u in us)]), max((place[u][1] for u in us), default=-1) + 1)
                for i, us in uses.items() if i not in place and all(u in place for u in us)
            }
            if not new:
                break
            place |= new
        cyclic = set(uses) - set(place)
        place |= {i: (first[i][0], -1) for i in cyclic}
        answered = {}
        for _, t, r, _, _, c in ms:
            if r == "tool" and c is not None:
                answered[c] = min(t, answered.get(c, t))
        for t, s, i, n, a in calls:
            faults = list(parsed[(t, s, i)][1])
            if i is None:
                faults.append("no id")
            else:
                lost = sorted(f"uses unknown {u}" for u in C.used_ids(parsed[(t, s, i)][0]) if u not in first)
                faults += lost
                if first[i] != (t, s):
                    faults.append("id given before")
                if i in cyclic:
                    faults.append("cycle")
            if i not in answered:
                faults.append("no result")
            at, level = place.get(i, (t, 0))
            out.append(("call", conv, t, s, i, at, level, 2 * s + 1, tuple(faults), None))
        for _, t, r, text, cs, c in ms:
            j = {"content": text, "role": r}
            if cs:
                j["tool_calls"] = [
                    {"id": i, "type": "function", "function": {"name": n, "arguments": C.check_call(n, a, tools)[0]}} for i, n, a in cs
                ]
            if r == "tool":
                j["tool_call_id"] = c
            j = json.dumps(j, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
            if r == "tool":
                faults = [] if c in place else ["no call"]
                if c is not None and t > answered[c]:
                    faults.append("second result")
                at, level = place.get(c, (t, 0))
                out.append(("result", conv, t, None, c, at, level, 2 * first[c][1] + 2 if c in first else 0, tuple(faults), j))
            else:
                out.append(("message", conv, t, None, None, t, -2, 0, (), j))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(tuple(v) if isinstance(v, list) else v for v in r) for r in df.collect()), key=repr)


def test_every_fault_and_the_order(spark):
    use = lambda i: json.dumps({"query": f"$result:{i}"})
    messages = [
        (1, 0, "user", "hé \"there\"", None, None),
        (1, 1, "assistant", None, [("a", "search", '{"query": "x", "limit": 3}'), ("b", "lookup", use("z"))], None),
        (1, 2, "tool", "of a", None, "a"), (1, 3, "tool", "again", None, "a"), (1, 0, "tool", "early b", None, "b"),
        (1, 4, "assistant", "", [("z", "search", '{"limit": true, "other": 1}')], None), (1, 5, "tool", None, None, "z"),
        (1, 6, "assistant", "t", [("a", "search", "[1]"), (None, "nope", "{}"), ("q", "convert", '{"query": "q", "limit": 1.5}')], None),
        (1, 7, "tool", "orphan", None, "none"), (1, 8, "tool", "no id", None, None),
        (2, 0, "assistant", "loop", [("p", "search", use("q")), ("q", "search", use("p")), ("r", "search", use("gone")), ("s", "search", use("r"))], None),
        (2, 1, None, "no role", [], None),
    ]
    df = spark.createDataFrame(messages, C.MESSAGE)
    got = rows_of(C.format_chats(df, C.TOOLS))
    assert got == brute(messages, C.TOOLS)
    place = {(r[0], r[4]): r[5:8] for r in got if r[1] == 1 and r[4]}
    assert place[("result", "z")] > place[("call", "z")] and place[("call", "b")] > place[("call", "z")]
    assert C.format_chats(df.limit(0), C.TOOLS).count() == 0


def test_query(spark, sf_dir):
    from pointloom.llm.queries import ALL

    made = C.with_tool_calls(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    messages = [(r.conv_id, r.turn, r.role, r.text, [tuple(c) for c in r.calls] if r.calls else None, r.call_id) for r in made.collect()]
    got = rows_of(ALL["op6_chats"](spark, sf_dir))
    assert got == brute(messages, C.TOOLS)
    assert {"cycle"} != {f for r in got for f in r[8]} and any("missing" in f or "unknown tool" in f for r in got for f in r[8])


BAD = {
    '{"a": "\\ud800"}': "arguments hold half a surrogate pair", '{"a": ' + "[" * 1000 + "]" * 1000 + "}": "arguments are nested too deeply",
    '{"a": ' + "[" * 200_000 + "]" * 200_000 + "}": "arguments are nested too deeply", '{"a": NaN}': "arguments are not JSON",
    '{"a": -Infinity}': "arguments are not JSON", '{"a": 1e999}': "arguments hold a number out of range", '{"a": 1, "a": 2}': "arguments hold a key twice",
    '{"b": {"c": 1, "c": 1}}': "arguments hold a key twice", "[1": "arguments are not JSON", "": "arguments are not JSON", "[1]": "arguments are not an object",
}


def test_arguments_that_are_no_json_are_faults(spark):
    import json

    tools = {"t": {"a": ("string", False)}}
    calls = [(str(i), "t", a) for i, a in enumerate([*BAD, '{"a": "' + "x" * 300_000 + '"}', '{"a": "\\ud83d\\ude00"}'])]
    rows = spark.createDataFrame([(1, 0, "assistant", None, calls, None, 3)], C.MESSAGE + ", checked int")
    out = C.format_chats(rows, tools).collect()
    faults = {r.id: list(r.faults) for r in out if r.kind == "call"}
    for i, fault in enumerate(BAD.values()):
        assert fault in faults[str(i)]
    assert not [f for f in faults[str(len(BAD))] + faults[str(len(BAD) + 1)] if f.startswith("arguments")]
    message = json.loads(next(r.json for r in out if r.kind == "message"), parse_constant=lambda c: 1 / 0)
    written = [c["function"]["arguments"] for c in message["tool_calls"]]
    assert written[: len(BAD)] == [*list(BAD)[:-1], [1]] and written[-1] == {"a": "\U0001f600"}
    assert C.format_chats(rows.limit(0), tools).count() == 0
