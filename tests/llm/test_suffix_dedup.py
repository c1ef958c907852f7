import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyforge.llm import suffix_dedup as S
from tallyforge.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import same_as_sql

LAST = 1 << 62


def brute(rows, depth=50):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - depth + 1):
            k = b[p : p + depth]
            first[k] = min(first.get(k, LAST), LAST if i is None else i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for p in range(len(b) - depth + 1):
            if first[b[p : p + depth]] < (LAST if i is None else i):
                gone[p : p + depth] = [True] * depth
        spans = sum(1 for q in range(len(b)) if gone[q] and (q == 0 or not gone[q - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def got(df, **options):
    return sorted(map(tuple, S.remove_repeats(df, **options).collect()), key=str)


def test_against_brute_force(spark, sf):
    real = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = real + [
        (None, real[3][1]), (5000, None), (5001, ""), (5002, "a" * 3000), (5003, "b" * 20 + "a" * 300 + "c"), (3, real[3][1]),
        (5004, real[5][1][100:400] + real[7][1][30:200]), (5005, "ab" * 500), (5006, "x" * 49), (5007, "x" * 49), (5008, "é" * 60), (5009, "aé" + "é" * 40),
        (-7, real[9][1][50:500]),
    ]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n_removed int").repartition(5)
    want = brute(rows)
    assert sum(r[2] for r in want) > 10_000
    assert got(df, block_bytes=100_000, buckets=13) == want
    assert got(df) == want


def test_sql(spark, duck, sf):
    same_as_sql(QUERIES["op3_suffix_dedup"](spark, sf), duck, ORACLE_SQL["op3_suffix_dedup"])


def test_empty_table(spark):
    assert got(spark.createDataFrame([], "doc_id long, text string")) == []
    assert got(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")) == brute([(1, None), (2, "")])


def test_kept_text(spark):
    a = "".join(random.Random(2).choice("abcdef ") for _ in range(300))
    df = spark.createDataFrame([(1, a), (2, "xx" + a[:100] + "yy")], "doc_id long, text string")
    kept = {r.doc_id: bytes(r.kept).decode() for r in S.remove_repeats(df, texts=True).collect()}
    assert kept == {1: a, 2: "xxyy"}


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("ab", max_size=60), min_size=1, max_size=6), st.integers(2, 12))
def test_first_owners(strings, depth):
    strings = [s.encode() for s in strings if len(s) >= depth]
    if not strings:
        return
    lengths = np.array(list(map(len, strings)))
    owners = np.arange(len(strings))[::-1].copy()
    data = np.frombuffer(b"".join(strings), np.uint8)
    first = S.first_owners(data, np.cumsum(lengths) - lengths, lengths - depth + 1, owners, depth)
    windows = [(s[p : p + depth], o) for s, o in zip(strings, owners) for p in range(len(s) - depth + 1)]
    least = {}
    for w, o in windows:
        least[w] = min(least.get(w, LAST), o)
    assert first.tolist() == [least[w] for w, _ in windows]


@pytest.mark.parametrize("chunk", [1 << 18, 64])
def test_runs_hold_every_window_once(chunk, monkeypatch):
    monkeypatch.setattr(S, "CHUNK", chunk)
    rng = random.Random(4)
    texts = ["".join(rng.choice("abc ") for _ in range(n)).encode() for n in (0, 10, 49, 50, 51, 400, 0, 777)]
    ends = np.cumsum(list(map(len, texts)))
    start, count, value, doc = S.runs(np.frombuffer(b"".join(texts), np.uint8), ends)
    seen = sorted((int(d), int(s) + k) for s, n, d in zip(start, count, doc) for k in range(n))
    want = sorted((d, int(ends[d]) - len(t) + p) for d, t in enumerate(texts) for p in range(len(t) - 49))
    assert seen == want
    # Equal windows have one value wherever they stand.
    again = S.runs(np.frombuffer(b"zz" + texts[7], np.uint8), np.array([2 + len(texts[7])]))
    assert set(value[doc == 7].tolist()) <= set(again[2].tolist())


def test_hot_values_are_dealt_by_window(spark, sf):
    # One phrase in many documents, each time amid other words, some of which repeat too.
    rng = random.Random(7)
    phrase = "all rights reserved, see the license of"
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 9))) for _ in range(40)]
    some = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(i, f"{some(6)} {phrase} {some(6)}") for i in range(300)]
    rows += [(1000 + i, rows[i * 3][1][rng.randint(0, 30) :]) for i in range(60)] + [(r.doc_id + 5000, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").limit(40).collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute(rows)
    assert sum(r[2] for r in want) > 3000
    for hot_runs in (0, 1, 20):
        assert got(df, block_bytes=10_000, buckets=7, hot_runs=hot_runs) == want


def test_hot_windows_spread_over_buckets():
    rng = random.Random(3)
    # The phrase whose gram has the least hash of many leads nearly all windows around it.
    phrase = min(("".join(rng.choice("ijklmn") for _ in range(24)) for _ in range(3000)), key=lambda p: S._window_values(np.frombuffer(p.encode(), np.uint8), 24, 24)[0])
    docs = [("".join(rng.choice("abcdefgh ") for _ in range(40)) + phrase + "".join(rng.choice("abcdefgh ") for _ in range(40))).encode() for _ in range(2000)]
    cell = S.pack_parts(S.squeeze(np.arange(2000).tobytes()), S.squeeze(b"\1" * 2000), S.pack_numbers(np.array(list(map(len, docs)))), S.squeeze(b"".join(docs)))
    loads = []
    for hot_runs in (1 << 19, 100):
        block = S.Block(cell, 31, S.DEPTH)
        answers = {}
        for b, asked in block.asks():
            answers |= {bucket: bits for _, bucket, bits, _ in S._shared(iter([{"block": 1, "bucket": b, "cell": asked}]), hot_runs)}
        block.share(answers)
        loads.append(np.diff(block.string_edges))
    assert loads[0].max() > 0.75 * loads[0].sum() and loads[1].max() < 0.1 * loads[1].sum()


def test_a_very_long_text(spark):
    rng = random.Random(1)
    long = "".join(rng.choices("abcdefghij ", k=3_000_000))
    df = spark.createDataFrame([(2, long), (1, long[1_000_000:1_000_200]), (3, long[500:100_500])], "doc_id long, text string")
    assert [r[:4] for r in got(df, block_bytes=500_000)] == [(1, 200, 0, 0), (2, 3_000_000, 200, 1), (3, 100_000, 100_000, 1)]
