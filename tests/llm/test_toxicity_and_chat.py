import json
import math
import random
import zlib

import numpy as np
import pytest

from tallyforge.llm import chat, toxicity
from tallyforge.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import same_as_sql

# Toxicity


def corpus(n=500, seed=1):
    """Clean words, and toxic words: two fixed ones and a stem with endings of its own."""
    rng = random.Random(seed)
    syllables = ["ka", "lo", "mi", "ter", "an", "so", "pre", "du", "il", "é"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    out = []
    for i in range(n):
        words = [word() for _ in range(rng.randint(0, 150))]
        toxic = rng.random() < 0.25 and len(words) > 5
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words[rng.randrange(len(words))] = rng.choice(["vilex", "grobb", "zyrq" + word()])
        out.append((i, " ".join(words), int(toxic)))
    return out


def test_gradients():
    rng = np.random.default_rng(0)
    texts = [b"ab cd ef", b"", b"x y z ab ab"]
    words, windows, _ = toxicity.read(texts)
    net = toxicity.Network(3)
    net.p = {k: v.astype(np.float64) + (rng.standard_normal(v.shape) * 0.3 if k not in ("word", "gram") else rng.standard_normal(v.shape) * 0.5) for k, v in net.p.items()}
    label = np.array([1.0, 0.0, 1.0])

    def loss():
        z = net.forward(net.gates(net.inputs(words)), windows)
        return float(np.mean(np.log1p(np.exp(z)) - label * z))

    g = net.gradients(words, windows, label)
    for k, grad in g.items():
        at = np.unravel_index(np.argmax(np.abs(grad)), grad.shape)
        before, step = net.p[k][at], 1e-3
        net.p[k][at] = before + step
        up = loss()
        net.p[k][at] = before - step
        down = loss()
        net.p[k][at] = before
        assert abs((up - down) / (2 * step) - grad[at]) < 2e-2 * abs(grad[at]) + 2e-4, k


def test_windows_overlap_and_cover():
    for n in (0, 1, 16, 17, 32, 33, 48, 49, 100):
        words, windows, of = toxicity.read([b" ".join(b"w%d" % i for i in range(n)), b"tail"])
        own = windows[of == 0]
        assert set(own[own >= 0].tolist()) == set(range(n)) and (of == 1).sum() == 1
        starts = own[:, 0].tolist()
        assert starts == ([-1] if n == 0 else list(range(0, max(n - 16, 1), 16)))


def plain_score(net, text):
    """The score by loops over windows, words and units, straight from the definition."""
    sig = lambda x: 1 / (1 + math.exp(-x))
    words = text.lower().translate(None, b".,;:!?\"()[]{}").split()
    p = {k: v.astype(float).tolist() for k, v in net.p.items() if k not in ("word", "gram")}

    def vector(word):
        code = [ord(c) for c in f"<{word.decode('utf-8', 'replace')}>"]
        grams = []
        for n in (3, 4, 5):
            for i in range(len(code) - n + 1):
                h = 0
                for c in code[i : i + n]:
                    h = ((h ^ c) * 0x100000001B3 + n) % 2**64
                grams.append((h ^ h >> 29) % toxicity.GRAM_ROWS)
        summed = [sum(float(net.p["gram"][g, j]) for g in grams) / math.sqrt(len(grams)) if grams else 0.0 for j in range(toxicity.GRAM_DIM)]
        return [float(v) for v in net.p["word"][zlib.crc32(word) % toxicity.WORD_ROWS]] + summed

    def states(vectors, way):
        w, u, b, size = p[f"w{way}"], p[f"u{way}"], p[f"b{way}"], toxicity.HIDDEN
        h, out = [0.0] * size, []
        for x in vectors:
            g = [sum(x[i] * w[i][k] for i in range(len(x))) + b[k] for k in range(3 * size)]
            hu = [sum(h[i] * u[i][k] for i in range(size)) for k in range(3 * size)]
            z, r = ([sig(g[s * size + k] + hu[s * size + k]) for k in range(size)] for s in (0, 1))
            c = [math.tanh(g[2 * size + k] + r[k] * hu[2 * size + k]) for k in range(size)]
            h = [(1 - z[k]) * c[k] + z[k] * h[k] for k in range(size)]
            out.append(h)
        return out

    logits = []
    for start in range(0, max(1, len(words) - 16), 16):
        vectors = [vector(w) for w in words[start : start + 32]]
        if not vectors:
            logits.append(net.none)
            continue
        both = [f + b for f, b in zip(states(vectors, "f"), states(vectors[::-1], "b")[::-1])]
        weight = []
        for h in both:
            a = [math.tanh(sum(h[i] * p["wa"][i][k] for i in range(len(h))) + p["ba"][k]) for k in range(toxicity.ATTENTION)]
            weight.append(math.exp(sum(x * y for x, y in zip(a, p["va"]))))
        pooled = [sum(w * h[i] for w, h in zip(weight, both)) / sum(weight) for i in range(2 * toxicity.HIDDEN)]
        logits.append(sum(x * y for x, y in zip(pooled, p["wo"])) + p["bo"][0])
    return sig(net.scale * max(logits) + net.shift)


def test_scores_against_plain_loops(spark):
    net = toxicity.Network(5)
    rng = np.random.default_rng(2)
    for k, v in net.p.items():
        net.p[k] = (v + rng.standard_normal(v.shape) * (0.5 if k in ("word", "gram") else 0.4)).astype(np.float32)
    net.scale, net.shift, net.none = 1.7, -0.4, -0.9
    texts = [t for _, t, _ in corpus(40, 3)] + ["", None, "Ünï, cödé! x", "a", " ".join(f"w{i}" for i in range(49))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for r in toxicity.score(docs, net).collect():
        assert abs(r.score - plain_score(net, (texts[r.doc_id] or "").encode())) < 1e-5


def test_repeated_ids_are_learned_alike(spark):
    # Two texts of one doc_id: the least is learned from, whichever comes first.
    rows = corpus(60)
    labels = spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id long, toxic int")
    both = [(i, t) for i, t, _ in rows] + [(i, "zz other " + t) for i, t, _ in rows]
    models = [toxicity.fitted(spark.createDataFrame(b, "doc_id long, text string").repartition(n), labels) for b, n in ((both, 1), (both[::-1], 5))]
    assert all((models[0].p[k] == models[1].p[k]).all() for k in models[0].p)


def test_a_long_text_scores_like_its_windows(monkeypatch):
    net = toxicity.Network(1)
    net.p["wo"] *= 5
    text = b" ".join(b"w%d" % (i * i % 611) for i in range(900))
    whole = net.score([text, b"a"])
    monkeypatch.setattr(toxicity, "SCORED_BYTES", 1000)
    assert np.allclose(net.score([text, b"a"]), whole, atol=1e-6)


def test_held_out_accuracy(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "en", 9) for i, t, _ in rows], "doc_id long, text string, lang string, score int").repartition(3)
    labels = spark.createDataFrame([(i, 1, x) for i, _, x in rows] + [(7000, 0, 1)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    truth = {i: x for i, _, x in rows}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for i, r in got.items())
    held = [i for i, r in got.items() if r.held_out]
    right = [got[i].predicted == truth[i] for i in held]
    assert len(held) > 80 and np.mean(right) > 0.93


def test_held_out_labels_are_not_learned(spark):
    rows = corpus(120)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    flip = lambda i, x: 1 - x if zlib.crc32(str(i).encode()) % 4 == 2 else x
    scores = []
    for change in (lambda i, x: x, flip):
        labels = spark.createDataFrame([(i, change(i, x)) for i, _, x in rows], "doc_id long, toxic int")
        scores.append({r.doc_id: r.score for r in toxicity.toxicity(docs, labels).collect()})
    assert scores[0] == scores[1]


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "x"), (3, "a b"), (3, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one_kind = spark.createDataFrame([(1, 1), (2, None), (None, 1), (3, 1), (4, 1), (5, 1)], "doc_id long, toxic int")
    assert [r.score for r in toxicity.toxicity(docs, none).collect()] == [0.0] * 5
    assert [r.score for r in toxicity.toxicity(docs, one_kind).collect()] == [1.0] * 5
    assert toxicity.toxicity(docs.limit(0), none).count() == 0


# Chat


def test_plain_conversations(spark, duck, sf):
    same_as_sql(QUERIES["op5_chat_format"](spark, sf), duck, ORACLE_SQL["op5_chat_format"])


SCHEMAS = {"add": {"type": "object", "properties": {"x": {"type": "integer", "minimum": 0}, "y": {"type": "number"}}, "required": ["x"], "additionalProperties": False}, "any": {}}


@pytest.mark.parametrize("value, schema, ok", [
    (1, {"type": "integer"}, True), (1.5, {"type": "integer"}, False), (True, {"type": "integer"}, False), (1.5, {"type": "number", "maximum": 1}, False),
    ("a", {"enum": ["a"]}, True), ("b", {"enum": ["a"]}, False), ([1, "a"], {"type": "array", "items": {"type": "integer"}}, False), (None, {"type": "null"}, True),
    ({"x": 1}, SCHEMAS["add"], True), ({"y": 1}, SCHEMAS["add"], False), ({"x": 1, "z": 1}, SCHEMAS["add"], False), ({"x": -1}, SCHEMAS["add"], False), ([], {"type": "object"}, False),
])
def test_conforms(value, schema, ok):
    assert chat.conforms(value, schema) is ok


def call(i, name="add", after=(), **arguments):
    return f"<tool_call>{json.dumps({'id': i, 'name': name, 'arguments': arguments, 'after': list(after)})}</tool_call>"


def result(i, content):
    return json.dumps({"tool_call_id": i, "content": content})


def test_tool_calls(spark):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "look " + call("a", x=1) + call("b", after=["a"], x="no")), (1, 2, "tool", result("a", {"k": 2, "a": 1})),
        (1, 3, "tool", result("b", "é")), (1, 4, "tool", result("zz", "lost")), (1, 5, "assistant", call("a", x=2)), (1, 6, "tool", "not json"),
        (2, 0, "tool", result("c", "early")), (2, 3, "assistant", call("c", "any", after=["d"])), (2, 4, "assistant", call("d", "none")),
        (3, 0, "assistant", call("p", "any", after=["q"]) + call("q", "any", after=["p"]) + "<tool_call>broken</tool_call>"), (3, 1, "assistant", call("r", "any", after=["missing"])),
        (4, 0, None, None), (None, None, "assistant", "x"), (4, 0, None, None), (5, 0, "user", call("u", "any")),
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, calls int").repartition(3)
    got = chat.formatted(df, SCHEMAS).collect()
    assert len(got) == len(rows)
    by = {(r.conv_id, r.turn): r for r in got}
    body = {k: json.loads(r.message) for k, r in by.items()}
    assert all(r.message == chat.canonical(json.loads(r.message)) for r in got)
    first = body[1, 1]
    assert first["content"] == "look " and [(c["id"], c["status"], c["depth"]) for c in first["tool_calls"]] == [("a", "answered", 0), ("b", "invalid", 1)]
    assert first["tool_calls"][0]["arguments"] == {"x": 1}
    assert body[1, 2] == {"content": '{"a":1,"k":2}', "linked": True, "role": "tool", "tool_call_id": "a", "turn": 2}
    assert (by[1, 4].linked, by[1, 3].linked) == (False, True)
    assert [c["status"] for c in body[1, 5]["tool_calls"]] == ["duplicate"]
    assert body[1, 6] == {"content": "not json", "role": "tool", "turn": 6}
    # c waits for d, and c's early result for c.
    ordered = [r.turn for r in sorted((r for r in got if r.conv_id == 2), key=lambda r: (r.place, r.rank, r.turn))]
    assert ordered == [4, 3, 0] and [c["depth"] for c in body[2, 3]["tool_calls"]] == [1]
    assert [(c["id"], c["status"]) for c in body[3, 0]["tool_calls"]] == [("p", "cycle"), ("q", "cycle")] and body[3, 0]["content"] == "<tool_call>broken</tool_call>"
    assert body[3, 1]["tool_calls"][0]["status"] == "cycle"
    assert body[4, 0] == {"content": None, "role": "user", "turn": 0} and body[None, None]["content"] == "x"
    assert body[5, 0]["content"] == call("u", "any")
    assert chat.formatted(df.limit(0), SCHEMAS).count() == 0


def test_calls_without_a_conversation(spark):
    rows = [
        (None, 0, "tool", result("b", "early")), (None, 1, "assistant", call("a", x=1) + call("b", "any", after=["a"])), (None, 2, "tool", result("a", "r")),
        (None, None, "assistant", call("c", "any", after=["c"])), (0, 0, "assistant", call("a", "any")), (0, 1, "tool", result("b", "of no call here")),
    ]
    got = {(r.conv_id, r.turn): r for r in chat.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3), SCHEMAS).collect()}
    calls = lambda *k: [(c["id"], c["status"], c["depth"]) for c in json.loads(got[k].message)["tool_calls"]]
    assert len(got) == len(rows)
    assert calls(None, 1) == [("a", "answered", 0), ("b", "answered", 1)] and calls(None, None) == [("c", "cycle", 0)]
    assert got[None, 0].linked and got[None, 2].linked and (got[None, 0].place, got[None, 0].rank) == (1, 3)
    assert calls(0, 0) == [("a", "open", 0)] and got[0, 1].linked is False  # the null conversation is not conversation 0


def test_long_chains_are_ordered(spark):
    rows = [(1, i, "assistant", call(f"n{i}", "any", after=[f"n{i + 1}"] if i < 6 else [])) for i in range(7)]
    got = chat.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), SCHEMAS).collect()
    assert [r.turn for r in sorted(got, key=lambda r: (r.place, r.rank, r.turn))] == [6, 5, 4, 3, 2, 1, 0]
