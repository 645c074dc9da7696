"""Linking, order, validation and canonical JSON."""

import json

import pytest

from churnlens.llm import tool_calls as tc

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, rank int"


def call(i, name="search", arguments='{"query": "x"}', after=()):
    return {"id": i, "name": name, "arguments": arguments, "after": list(after)}


def said(conv, turn, *calls):
    return (conv, turn, "assistant", json.dumps({"tool_calls": list(calls)}), 0)


def answered(conv, turn, i, content="ok"):
    return (conv, turn, "tool", json.dumps({"tool_call_id": i, "content": content}), 0)


@pytest.mark.parametrize("value,text", [
    ({"b": 1, "a": [1.0, 2.5, None, True]}, '{"a":[1,2.5,null,true],"b":1}'),
    ({"é": "€\n\"", "z": 1e21, "y": 1e-7, "x": 0.000001}, '{"x":0.000001,"y":1e-7,"z":1e+21,"é":"€\\n\\""}'),
    ([-0.0, 1e20, 123456789012345680000.0, 5e-324, 1.5e300], "[0,100000000000000000000,123456789012345680000,5e-324,1.5e+300]"),
    ({"\U0001f600": 1, "דּ": 2}, '{"\U0001f600":1,"דּ":2}'), ({}, "{}"), ("", '""'),
])
def test_canonical(value, text):
    assert tc.canonical(value) == text
    assert json.loads(text, parse_int=float) == json.loads(json.dumps(value), parse_int=float)


def test_violations():
    s = tc.SCHEMAS["search"]
    assert tc.violations({"query": "a", "limit": 3}, s) == []
    assert tc.violations({"limit": 99, "more": 1}, s) == ["$.query: missing", "$.limit: out of bounds", "$.more: not allowed"]
    assert tc.violations({"tags": ["a", 1]}, tc.SCHEMAS["note"]) == ["$.tags[1]: not string"]
    assert tc.violations(True, {"type": "integer"}) and not tc.violations(2.0, {"type": "integer"})
    assert tc.check_arguments("search", "{oops", tc.SCHEMAS) == (None, ["$: not JSON"])
    assert tc.check_arguments("search", '{"query": NaN}', tc.SCHEMAS)[0] is None
    assert tc.check_arguments("other", "{}", tc.SCHEMAS) == ("{}", ["unknown tool"])
    assert tc.check_arguments(None, None, tc.SCHEMAS)[1] == ["$: not JSON"]


def test_link(spark):
    rows = [
        said(1, 0, call("a", after=["b"]), call("b", after=["c"]), call("c"), call("d", after=["gone"])),
        answered(1, 1, "a"), answered(1, 1, "a", "second"), answered(1, 1, "b"), answered(1, 1, "c"), answered(1, 1, "x"),
        said(2, 4, call("a", "search", '{"limit":0}'), call("a"), call(None)), answered(2, 5, "a"),
        said(3, 2, call("p", after=["q"]), call("q", after=["p"]), call("r", after=["p"]), call("s", after=["s"]), call("t"),
             call("u", after=["v"]), call("v", after=["w"]), call("w")),
        answered(3, 1, "t"), answered(3, 3, "p"),
        (4, 0, "assistant", "tool_calls but no JSON", 0), (4, 1, "tool", None, 0), (4, 2, None, None, 0), (4, 3, "user", "hi", 0),
        said(None, 0, call("n")), answered(None, 1, "n"),
    ]
    got = tc.link(spark.createDataFrame(rows, SCHEMA), tc.SCHEMAS).collect()
    by = {}
    for r in got:
        by.setdefault((r.conv_id, r.call_id), []).append(r)
    one = lambda c, i: by[c, i][0]
    assert len(got) == 4 + 1 + 3 + 8 + 1
    assert [one(1, i).rank for i in "abcd"] == [2, 1, 0, 3]
    assert [one(1, i).status for i in "abcdx"] == ["linked"] * 3 + ["unanswered", "orphan"]
    assert json.loads(one(1, "a").json) == {"id": "a", "name": "search", "arguments": {"query": "x"}, "result": "ok"}
    assert sorted(r.status for r in by[2, "a"]) == ["duplicate", "invalid"] and one(2, None).status == "no_id"
    assert [one(3, i).status for i in "pqrst"] == ["cycle", "cycle", "unanswered", "cycle", "early"]
    assert one(3, "w").rank < one(3, "v").rank < one(3, "u").rank
    assert sorted(r.rank for r in got if r.conv_id == 3) == list(range(8))
    assert one(None, "n").status == "linked"
    assert tc.link(spark.createDataFrame([], SCHEMA), tc.SCHEMAS).collect() == []


def test_long_chains_of_pushes(spark):
    n = 12
    rows = [said(1, 0, *(call(f"c{i}", after=[f"c{i + 1}"]) for i in range(n)))]
    got = tc.link(spark.createDataFrame(rows, SCHEMA), tc.SCHEMAS).collect()
    assert {r.call_id: r.rank for r in got} == {f"c{i}": n - 1 - i for i in range(n)}


def test_whole_table(spark):
    messages = tc.derived_messages(spark.read.parquet(f"{SF}/conversations.parquet"))
    raw = messages.collect()
    calls = {(m.conv_id, c["id"]): (m.turn, c) for m in raw if m.role == "assistant" for c in json.loads(m.text)["tool_calls"]}
    answers = {(m.conv_id, json.loads(m.text)["tool_call_id"]) for m in raw if m.role == "tool"}
    got = tc.op1_tool_call_links(spark, SF).collect()
    assert {(r.conv_id, r.call_id) for r in got} == set(calls) and len(got) == len(calls)
    rank = {(r.conv_id, r.call_id): r for r in got}

    stuck = set()
    for conv in {k[0] for k in calls}:
        own = sorted((turn, int(i.split("_")[1]), i, c) for (v, i), (turn, c) in calls.items() if v == conv)
        place = {i: n for n, (_, _, i, _) in enumerate(own)}
        edges = [(i, on) for _, _, i, c in own for on in c.get("after") or [] if on in place]
        late, changed = {}, set()
        for _ in range(len(own) + 2):  # a place that still moves after so many rounds moves for ever
            changed = set()
            for i, on in edges:
                behind, hops = late.get(on, (place[on], 0))
                if behind >= place[i] and (behind, hops + 1) > late.get(i, (-1, 0)):
                    late[i] = (behind, hops + 1)
                    changed.add(i)
        stuck |= {(conv, i) for i in changed}
    for k, (turn, c) in calls.items():
        r = rank[k]
        assert (r.status == "cycle") == (k in stuck), k
        if k not in stuck:
            assert all(rank[k[0], on].rank < r.rank for on in c.get("after") or [] if (k[0], on) in calls)
            errors = tc.check_arguments(c["name"], c["arguments"], tc.SCHEMAS)[1]
            assert r.status == ("unanswered" if k not in answers else "invalid" if errors else "linked")
    for conv in {k[0] for k in calls}:
        assert sorted(r.rank for k, r in rank.items() if k[0] == conv) == list(range(sum(k[0] == conv for k in calls)))


def test_no_conversation_shares_the_null_ones_key(spark):
    rows = [(c, 0, "assistant", json.dumps({"tool_calls": [call("x")]})) for c in ("-", "null", "=", "", None)]
    got = tc.link(spark.createDataFrame(rows, "conv_id string, turn long, role string, text string"), tc.SCHEMAS).collect()
    assert {(r.conv_id, r.status) for r in got} == {(c, "unanswered") for c in ("-", "null", "=", "", None)} and len(got) == 5
