"""Chat formatting with linked tool calls; one row per message, so no conversation is gathered in a task.

Messages are (conv_id, turn, role, text).  An assistant's text may hold calls,
``<tool_call>{"id": .., "name": .., "arguments": {..}, "after": [ids]}</tool_call>``; a message of role
``tool`` is a result, ``{"tool_call_id": .., "content": ..}``.

1. ``parsed``   splits texts into content, calls and result (Python, map side, no shuffle).
2. ``linked``   hash-joins calls and results by (conversation, call id).  Of calls that repeat an id the
                earliest (turn, then place in the message) counts, and of results likewise; the others are
                marked duplicates.
3. ``depths``   orders calls topologically by the ``after`` lists of the calls that count.  A conversation
                of at most SMALL calls is ordered in one task; larger ones by distributed rounds, which
                follow chains by pointer doubling.  Calls on a cycle, or behind an id that no call has,
                get no depth.  Conversations without such lists take no part.
4. ``formatted`` validates arguments against the tools' schemas and writes each message as canonical
                JSON (keys sorted, no spaces, text as is).  (place, rank, turn) order a conversation: a
                result never stands before its call, nor a call before those that it names.

JSON is what the standard allows: NaN, infinite numbers (also 1e999), lone surrogates and values nested
deeper than MOST_NESTED are refused, and a call or result that holds one stays content.  Messages with a
null conv_id are one conversation.  A null text is content null, a null role "user".  Text that does not
parse as a call stays content.  Rows that repeat a message are formatted each.  Empty tables give empty
results.  Further columns of the messages are left out.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import by_key
from .common import bounded_batches, discard, salted_join, shuffle_width, written

OPEN, CLOSE = "<tool_call>", "</tool_call>"
MOST_NESTED = 100
#: Calls of a conversation that one task orders.
SMALL = 10_000
_CALLS = "array<struct<id:string,name:string,arguments:string,valid:boolean,after:array<string>>>"
_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}
_NUMBERS = ("integer", "number")


def canonical(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def _refused(text: str):
    raise ValueError(f"no JSON number: {text}")


def _finite(text: str) -> float:
    value = float(text)
    return value if math.isfinite(value) else _refused(text)


def parse(text: str):
    """The JSON value of a text; ValueError for anything else (see above)."""
    try:
        value = json.loads(text, parse_constant=_refused, parse_float=_finite)
    except RecursionError:
        raise ValueError("nested too deep") from None
    todo = [(value, 1)]
    while todo:
        part, depth = todo.pop()
        if isinstance(part, str):
            part.encode()  # a lone surrogate is a ValueError
        elif isinstance(part, (dict, list)):
            if depth > MOST_NESTED:
                raise ValueError("nested too deep")
            if isinstance(part, dict):
                todo += [(k, depth) for k in part]
                part = part.values()
            todo += [(p, depth + 1) for p in part]
    return value


def check_schema(schema) -> None:
    """ValueError for a schema that ``conforms`` could not apply; run once, before any task."""
    if not isinstance(schema, dict):
        raise ValueError(f"a schema is an object, not {schema!r}")
    kinds = schema.get("type", [])
    for kind in kinds if isinstance(kinds, list) else [kinds]:
        if kind not in _NUMBERS and kind not in _TYPES:
            raise ValueError(f"unknown type {kind!r}")
    for part in [*schema.get("properties", {}).values(), *([schema["items"]] if "items" in schema else [])]:
        check_schema(part)


def _is(value, kind: str) -> bool:
    if kind in _NUMBERS:
        return not isinstance(value, bool) and isinstance(value, (int, float)) and (kind == "number" or isinstance(value, int) or value.is_integer())
    return isinstance(value, _TYPES[kind])


def _equal(a, b) -> bool:
    """Equality of JSON values: true is not 1, but 1.0 is."""
    if isinstance(a, bool) or isinstance(b, bool):
        return a is b
    if isinstance(a, list) and isinstance(b, list):
        return len(a) == len(b) and all(map(_equal, a, b))
    if isinstance(a, dict) and isinstance(b, dict):
        return a.keys() == b.keys() and all(_equal(v, b[k]) for k, v in a.items())
    return a == b


def conforms(value, schema: dict) -> bool:
    """Whether ``value`` meets a JSON schema of type (one or a list), enum, properties, required, additionalProperties, items, minimum and maximum."""
    kinds = schema.get("type", [])
    kinds = kinds if isinstance(kinds, list) else [kinds]
    if kinds and not any(_is(value, kind) for kind in kinds):
        return False
    if _is(value, "number") and not schema.get("minimum", value) <= value <= schema.get("maximum", value):
        return False
    if "enum" in schema and not any(_equal(value, e) for e in schema["enum"]):
        return False
    if isinstance(value, dict):
        known = schema.get("properties", {})
        if any(k not in value for k in schema.get("required", ())):
            return False
        if schema.get("additionalProperties", True) is False and any(k not in known for k in value):
            return False
        return all(conforms(v, known[k]) for k, v in value.items() if k in known)
    if isinstance(value, list) and "items" in schema:
        return all(conforms(v, schema["items"]) for v in value)
    return True


def _call(text: str, schemas: dict[str, dict]) -> dict | None:
    try:
        found = parse(text)
        call_id, name, arguments = found["id"], found["name"], found.get("arguments", {})
        after = found.get("after", [])
    except (ValueError, KeyError, TypeError, AttributeError):
        return None
    if not (isinstance(call_id, str) and isinstance(name, str) and isinstance(after, list) and all(isinstance(a, str) for a in after)):
        return None
    valid = name in schemas and conforms(arguments, schemas[name])
    return {"id": call_id, "name": name, "arguments": canonical(arguments), "valid": valid, "after": sorted(set(after))}


def split(role: str, text: str | None, schemas: dict[str, dict]) -> tuple[str | None, list[dict], str | None]:
    """content, calls, id of the call that the message answers."""
    if text is None:
        return None, [], None
    if role == "tool":
        try:
            found = parse(text)
            content = found["content"]
            if isinstance(found["tool_call_id"], str):
                return content if isinstance(content, str) else canonical(content), [], found["tool_call_id"]
        except (ValueError, KeyError, TypeError):
            pass
        return text, [], None
    if role != "assistant":
        return text, [], None
    calls, kept, at = [], [], 0
    # Every opening mark is looked at once: without a closing mark behind it there is none behind later ones.
    while (begin := text.find(OPEN, at)) >= 0 and (end := text.find(CLOSE, begin)) >= 0:
        call = _call(text[begin + len(OPEN) : end], schemas)
        end += len(CLOSE)
        kept.append(text[at : end if call is None else begin])
        if call is not None:
            calls.append(call)
        at = end
    return "".join([*kept, text[at:]]), calls, None


def parsed(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """conv_id, turn, role, message (of messages without call or answer, else content), calls, answers, _row; written."""
    bounded_batches(messages.sparkSession)
    plain = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("user")).alias("role"), "text")
    call = pa.struct([("id", pa.string()), ("name", pa.string()), ("arguments", pa.string()), ("valid", pa.bool_()), ("after", pa.list_(pa.string()))])
    names = ["conv_id", "turn", "role", "message", "content", "calls", "answers"]

    def one(turn: int | None, role: str, text: str | None) -> tuple:
        content, calls, answers = split(role, text, schemas)
        if calls or answers is not None:
            return None, content, calls, answers
        return canonical({"content": content, "role": role, "turn": turn}), None, calls, None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [one(*r) for r in zip(*(b.column(c).to_pylist() for c in ("turn", "role", "text")), strict=True)]
            message, content, calls, answers = zip(*found, strict=True) if found else ((), (), (), ())
            new = [pa.array(message, pa.string()), pa.array(content, pa.string()), pa.array(calls, pa.list_(call)), pa.array(answers, pa.string())]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in names[:3]] + new, names=names)

    rows = plain.mapInArrow(run, f"conv_id long, turn long, role string, message string, content string, calls {_CALLS}, answers string")
    return written(rows.withColumn("_row", F.monotonically_increasing_id()), "chat-messages")


def _conv() -> Column:
    """The key of a conversation in joins: "" for null, which would match nothing; no number casts to it."""
    return F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv")


def _call_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(F.size("calls") > 0).select(_conv(), "turn", "_row", F.posexplode("calls").alias("_at", "c")).select("conv", "turn", "_row", "_at", "c.*")


def linked(rows: DataFrame) -> DataFrame:
    """conv, id, call (turn, _row, _at) and result (turn, _row) of each call id that was called or answered."""
    calls = _call_rows(rows).groupBy("conv", "id").agg(F.min(F.struct("turn", "_row", "_at")).alias("call"))
    results = rows.filter("answers is not null").groupBy(_conv(), F.col("answers").alias("id")).agg(F.min(F.struct("turn", "_row")).alias("result"))
    return calls.join(results, ["conv", "id"], "full")


def order_calls(calls: list[tuple[str, int | None, list[str]]]) -> dict[str, tuple[int, int | None]]:
    """id -> depth, place of the calls (id, turn, after) of one conversation that can be ordered."""
    waits = {i: set(after) for i, _, after in calls}
    turn = {i: t for i, t, _ in calls}
    behind: dict[str, list[str]] = {}
    for i, after in waits.items():
        for a in after:
            behind.setdefault(a, []).append(i)
    done = {i: (0, turn[i]) for i, after in waits.items() if not after}
    todo, left = list(done), {i: len(after) for i, after in waits.items()}
    for i in todo:  # grows
        for j in behind.get(i, ()):
            left[j] -= 1
            if not left[j]:
                places = [p for p in (turn[j], *(done[a][1] for a in waits[j])) if p is not None]
                done[j] = 1 + max(done[a][0] for a in waits[j]), max(places, default=None)
                todo.append(j)
    return done


def _larger(nodes: DataFrame) -> DataFrame:
    """conv, id, depth, place by distributed rounds.

    A call that waits for one undecided call only has depth max(least, depth of that call + steps): such
    chains are shortened by pointer doubling.  A round decides all calls that wait for decided ones, and the chains behind them;
    rounds are as many as calls with several undecided predecessors follow on each other.
    """
    nodes = written(nodes.select("conv", "id", "turn", "after"), "chat-nodes")
    edges = written(nodes.select("conv", "id", "turn", F.explode("after").alias("before")), "chat-edges")
    done = written(nodes.filter(F.size("after") == 0).select("conv", "id", F.lit(0).alias("depth"), F.col("turn").alias("place")), "chat-depths")
    while True:
        told = edges.join(done.select("conv", F.col("id").alias("before"), "depth", "place"), ["conv", "before"], "left")
        told = told.groupBy("conv", "id").agg(
            F.coalesce(F.max("depth") + 1, F.lit(0)).alias("least"), F.greatest(F.max("turn"), F.max("place")).alias("place"),
            F.count_if(F.col("depth").isNull()).alias("open"), F.max(F.when(F.col("depth").isNull(), F.col("before"))).alias("to"),
        )
        told = written(told, "chat-told")
        ready = told.filter("open = 0").select("conv", "id", F.col("least").alias("depth"), "place")
        chains = written(told.filter("open = 1").select("conv", "id", "to", "least", F.lit(1).alias("steps"), "place"), "chat-chains")
        for _ in range(max(1, chains.count()).bit_length() + 1):
            far = chains.select("conv", F.col("id").alias("to"), F.col("to").alias("_to"), F.col("least").alias("_least"), F.col("steps").alias("_steps"), F.col("place").alias("_place"))
            moved = chains.join(far, ["conv", "to"], "left").select(
                "conv", "id", F.coalesce("_to", "to").alias("to"), F.greatest("least", F.col("_least") + F.col("steps")).alias("least"),
                (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("steps"), F.greatest("place", "_place").alias("place"), F.col("_to").isNotNull().alias("_moved"))
            moved = written(moved, "chat-chains")
            discard(chains)
            chains = moved.drop("_moved")
            chains._stored = moved._stored
            if not moved.filter("_moved").limit(1).count():
                break
        ends = ready.select("conv", F.col("id").alias("to"), F.col("depth").alias("_depth"), F.col("place").alias("_place"))
        along = chains.join(ends, ["conv", "to"]).select("conv", "id", F.greatest("least", F.col("_depth") + F.col("steps")).alias("depth"), F.greatest("place", "_place").alias("place"))
        fresh = written(ready.unionByName(along), "chat-ready")
        if not fresh.limit(1).count():
            return done
        more = written(done.unionByName(fresh), "chat-depths")
        rest = written(edges.join(fresh, ["conv", "id"], "left_anti"), "chat-edges")
        discard(done, edges, told, chains, fresh)
        done, edges = more, rest


def depths(rows: DataFrame, small: int = SMALL) -> DataFrame:
    """conv, id, depth, place of the calls of conversations with ``after`` lists.

    place: the latest turn of the call and all that it waits for.  Both are null on and behind cycles and unknown ids.
    """
    spark = rows.sparkSession
    first = F.struct("turn", "_row", "_at")
    nodes = _call_rows(rows).groupBy("conv", "id").agg(F.min("turn").alias("turn"), F.min_by(F.array_distinct("after"), first).alias("after"))
    nodes = written(nodes, "chat-calls")
    sizes = nodes.groupBy("conv").agg(F.count(F.lit(1)).alias("_calls"), F.max(F.size("after") > 0).alias("_some")).filter("_some").drop("_some")
    nodes = written(salted_join(nodes, sizes, ["conv"], ["id"]), "chat-calls")

    def order(conv: str, calls: Iterator[dict]) -> Iterator[tuple]:
        for i, (depth, place) in order_calls([(c["id"], c["turn"], c["after"]) for c in calls]).items():
            yield conv, i, depth, place

    few = nodes.filter(F.col("_calls") <= small).drop("_calls")
    done = by_key(few, "conv", shuffle_width(spark), order, "conv string, id string, depth int, place long")
    large = nodes.filter(F.col("_calls") > small)
    if large.limit(1).count():
        done = done.unionByName(_larger(large))
    return nodes.select("conv", "id").join(done, ["conv", "id"], "left")


def formatted(messages: DataFrame, schemas: dict[str, dict] | None = None, small: int = SMALL) -> DataFrame:
    """conv_id, turn, role, place, rank, message, n_calls, n_valid, n_answered, linked; one row per message."""
    schemas = schemas or {}
    for schema in schemas.values():
        check_schema(schema)
    rows = parsed(messages, schemas)
    order = depths(rows, small).select("conv", "id", F.col("depth").alias("_depth"), F.col("place").alias("_place"), F.lit(True).alias("_ordered"))
    known = written(linked(rows).join(order, ["conv", "id"], "left"), "chat-known")
    # A call id may be frequent within its conversation: its rows are spread over tasks.
    calls = salted_join(_call_rows(rows), known, ["conv", "id"], ["_row", "_at"])
    # What a message's calls come to: one row for each message with calls.
    again = (F.col("call._row") != F.col("_row")) | (F.col("call._at") != F.col("_at"))
    told = calls.groupBy("_row").agg(
        F.array_sort(F.collect_list(F.struct("_at", "id", F.col("result").isNotNull().alias("answered"), again.alias("again"), (F.col("_ordered").isNotNull() & F.col("_depth").isNull()).alias("loop"), F.coalesce("_depth", F.lit(0)).alias("depth")))).alias("_told"),
        # A call stands no earlier than the calls that it waits for, a result no earlier than its call.
        F.max("_place").alias("_after"), F.max("_depth").alias("_rank"),
    )
    own = salted_join(rows.filter("answers is not null").select("_row", _conv(), F.col("answers").alias("id")), known, ["conv", "id"], ["_row"])
    own = own.select(
        "_row", F.greatest("call.turn", "_place").alias("_call_place"), F.coalesce("_depth", F.lit(0)).alias("_call_depth"),
        (F.col("call").isNotNull() & (F.col("result._row") == F.col("_row"))).alias("_linked"),
    )
    busy = rows.filter("message is null").drop("message").join(told, "_row", "left").join(own, "_row", "left")
    zero = F.lit(0).cast("long")
    plain = rows.filter("message is not null").select(
        "conv_id", "turn", "role", F.col("turn").alias("place"), zero.alias("rank"), "message",
        zero.alias("n_calls"), zero.alias("n_valid"), zero.alias("n_answered"), F.lit(None).cast("boolean").alias("linked"),
    )
    return plain.unionByName(_busy(busy))


def _busy(rows: DataFrame) -> DataFrame:
    """Messages with calls or an answer, as ``formatted`` returns them."""
    names = ["conv_id", "turn", "role", "place", "rank", "message", "n_calls", "n_valid", "n_answered", "linked"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]

    def one(r: dict) -> tuple:
        body = {"content": r["content"], "role": r["role"], "turn": r["turn"]}
        calls, told = r["calls"] or [], {t["_at"]: t for t in r["_told"] or []}
        if r["answers"] is not None:
            body |= {"tool_call_id": r["answers"], "linked": bool(r["_linked"])}
        if calls:
            body["tool_calls"] = []
            for at, c in enumerate(calls):
                t = told[at]
                status = "duplicate" if t["again"] else "cycle" if t["loop"] else "invalid" if not c["valid"] else "answered" if t["answered"] else "open"
                body["tool_calls"].append({"arguments": json.loads(c["arguments"]), "depth": t["depth"], "id": c["id"], "name": c["name"], "status": status})
            # Calls of one message in the order of their depths, then as written.
            body["tool_calls"].sort(key=lambda c: c["depth"])
        place = max([x for x in (r["turn"], r["_after"], r["_call_place"]) if x is not None], default=None)
        rank = 2 * (r["_call_depth"] or 0) + 1 if r["answers"] is not None else 2 * (r["_rank"] or 0)
        return (r["conv_id"], r["turn"], r["role"], place, rank, canonical(body), len(calls), sum(c["valid"] for c in calls), sum(t["answered"] for t in told.values()), r["_linked"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [one(r) for r in b.to_pylist()]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)], names=names)

    return rows.drop("_row").mapInArrow(run, "conv_id long, turn long, role string, place long, rank long, message string, n_calls long, n_valid long, n_answered long, linked boolean")
