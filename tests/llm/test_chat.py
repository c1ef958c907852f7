import json
import random

import pytest

from tallyforge.llm import chat

MESSAGES = "conv_id long, turn long, role string, text string"
SCHEMAS = {"add": {"type": "object", "properties": {"x": {"type": ["integer", "null"]}}, "required": ["x"]}, "any": {}}


def call(i, name="any", arguments=None, after=()):
    return f"<tool_call>{json.dumps({'id': i, 'name': name, 'arguments': arguments or {}, 'after': list(after)})}</tool_call>"


def brute(rows):
    """(conv, turn) -> body, by reading each conversation again and again; turns are unique, texts well formed."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: r[1])
        calls, results = {}, {}
        for _, turn, role, text in own:
            if role == "assistant":
                for at, part in enumerate(text.split("<tool_call>")[1:]):
                    c = json.loads(part.split("</tool_call>")[0])
                    calls.setdefault(c["id"], (turn, at, c["after"]))
            if role == "tool":
                results.setdefault(json.loads(text)["tool_call_id"], turn)
        depth = {}
        ordered = any(after for _, _, after in calls.values())
        while True:
            more = {i: max([depth[a] + 1 for a in after], default=0) for i, (_, _, after) in calls.items() if i not in depth and all(a in depth for a in after)}
            if not more:
                break
            depth |= more

        def place(i):
            return max([calls[i][0], *(place(a) for a in calls[i][2])])

        for _, turn, role, text in own:
            body = {"content": text, "role": role, "turn": turn}
            where, rank = turn, 0
            if role == "tool":
                found = json.loads(text)
                i = found["tool_call_id"]
                body |= {"content": found["content"], "tool_call_id": i, "linked": i in calls and results[i] == turn}
                rank = 1 + 2 * depth.get(i, 0)
                if i in calls:
                    where = max([turn, calls[i][0]] + ([place(i)] if i in depth else []))
            elif role == "assistant" and "<tool_call>" in text:
                body["content"], body["tool_calls"] = text.split("<tool_call>")[0], []
                for at, part in enumerate(text.split("<tool_call>")[1:]):
                    c = json.loads(part.split("</tool_call>")[0])
                    i = c["id"]
                    valid = c["name"] == "any" or c["name"] == "add" and (c["arguments"].get("x", "") is None or type(c["arguments"].get("x", "")) is int)
                    status = "duplicate" if calls[i][:2] != (turn, at) else "cycle" if ordered and i not in depth else "invalid" if not valid else "answered" if i in results else "open"
                    body["tool_calls"].append({"arguments": c["arguments"], "depth": depth.get(i, 0), "id": i, "name": c["name"], "status": status})
                    rank = max(rank, 2 * depth.get(i, 0))
                    where = max([where] + ([place(i)] if ordered and i in depth else []))
                body["tool_calls"].sort(key=lambda c: c["depth"])
            out[conv, turn] = (body, where, rank)
    return out


@pytest.mark.parametrize("small, seed", [(10_000, 1), (0, 1), (0, 2), (4, 3)])
def test_linking_against_brute_force(spark, small, seed):
    rng = random.Random(seed)
    rows = []
    for conv in range(25):
        ids = [f"i{k}" for k in range(rng.randint(1, 9))]
        for turn in range(rng.randint(1, 12)):
            kind = rng.random()
            if kind < 0.5:
                # Mostly earlier ids, so that long chains come about; some cycles, some unknown ids.
                pick = lambda: rng.choice(ids + ["lost"] * (rng.random() < 0.1))
                calls = [(pick(), rng.choice(["any", "add", "other"]), rng.choice([{"x": 1}, {"x": None}, {"x": 1.5}, {}])) for _ in range(rng.randint(0, 3))]
                after = lambda i: [a for a in ids + ["lost"] if rng.random() < 0.25 and (a < i or rng.random() < 0.1)]
                rows.append((conv, turn, "assistant", "say " + "".join(call(i, n, a, after(i)) for i, n, a in calls)))
            elif kind < 0.8:
                rows.append((conv, turn, "tool", json.dumps({"tool_call_id": rng.choice(ids), "content": f"r{turn}"})))
            else:
                rows.append((conv, turn, "user", "é\x1f\t<tool_call>"))
    got = chat.formatted(spark.createDataFrame(rows, MESSAGES).repartition(5), SCHEMAS, small).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    for r in got:
        body, place, rank = want[r.conv_id, r.turn]
        assert r.message == chat.canonical(body) and (r.place, r.rank) == (place, rank), (r, body, place, rank)


def test_long_chain_in_a_large_conversation(spark):
    n = 70
    rows = [(None, i, "assistant", call(f"n{i}", after=[f"n{i + 1}"] if i < n - 1 else [])) for i in range(n)] + [(None, n, "assistant", call("x", after=["n0", "n3"]))]
    got = {r.turn: r for r in chat.formatted(spark.createDataFrame(rows, MESSAGES), SCHEMAS, 5).collect()}
    assert [json.loads(got[i].message)["tool_calls"][0]["depth"] for i in range(n + 1)] == [n - 1 - i for i in range(n)] + [n]
    assert all(got[i].place == n - 1 for i in range(n)) and got[n].place == n


def test_a_repeated_id_within_a_message(spark):
    got = chat.formatted(spark.createDataFrame([(1, 0, "assistant", call("a") + call("a"))], MESSAGES), SCHEMAS).first()
    assert [c["status"] for c in json.loads(got.message)["tool_calls"]] == ["open", "duplicate"]


BAD = [
    '{"id": "a", "name": "any", "arguments": ' + "[" * 5000 + "]" * 5000 + "}", '{"id": "a", "name": "any", "arguments": ' + "[" * 101 + "]" * 101 + "}",
    '{"id": "a", "name": "any", "arguments": NaN}', '{"id": "a", "name": "any", "arguments": {"x": -Infinity}}', '{"id": "a", "name": "add", "arguments": {"x": 1e999}}',
    '{"id": "a", "name": "any", "arguments": "\\ud800"}', '{"id": "\\udfff", "name": "any"}', '{"id": "a", "name": "any", "arguments": {"\\ud800": 1}}',
    '{"id": "a", "name": "any", "after": ["\\ud800"]}', "[]", "7", "null", "", '{"id": 1}', '{"id": "a", "name": "any", "after": [1]}', "1" * 5000,
]


def test_bad_json_stays_content(spark):
    texts = [f"<tool_call>{b}</tool_call>" for b in BAD]
    results = ['{"tool_call_id": "x", "content": "\\ud800"}', '{"tool_call_id": "x", "content": NaN}', '{"tool_call_id": "x", "content": ' + "[" * 3000 + "]" * 3000 + "}", '{"tool_call_id": 3, "content": 1}', "{", '{"tool_call_id": "x"}']
    rows = [(1, i, "assistant", t) for i, t in enumerate(texts)] + [(1, 100 + i, "tool", t) for i, t in enumerate(results)]
    got = {r.turn: r for r in chat.formatted(spark.createDataFrame(rows, MESSAGES), SCHEMAS).collect()}
    assert len(got) == len(rows)
    assert all(r.n_calls == 0 and r.linked is None and json.loads(r.message)["content"] == dict((x[1], x[3]) for x in rows)[t] for t, r in got.items())


def test_marks_are_read_in_linear_time():
    text = "<tool_call>" * 200_000
    assert chat.split("assistant", text, {}) == (text, [], None)
    assert chat.split("assistant", "a<tool_call>b<tool_call>c</tool_call>d", {})[0] == "a<tool_call>b<tool_call>c</tool_call>d"


@pytest.mark.parametrize("value, schema, ok", [
    (None, {"type": ["integer", "null"]}, True), (2.0, {"type": "integer"}, True), (2.5, {"type": ["integer", "string"]}, False), (1, {"enum": [True]}, False),
    (True, {"enum": [True]}, True), (1.0, {"enum": [1]}, True), ([1, {"a": False}], {"enum": [[1, {"a": 0}]]}, False), (10**400, {"type": "integer", "minimum": 0.5}, True),
])
def test_types_and_equality(value, schema, ok):
    chat.check_schema(schema)
    assert chat.conforms(value, schema) is ok


def test_bad_schemas_are_refused_at_once(spark):
    for schema in ({"type": "text"}, {"items": {"type": ["x"]}}, []):
        with pytest.raises(ValueError):
            chat.formatted(spark.createDataFrame([], MESSAGES), {"t": schema})
