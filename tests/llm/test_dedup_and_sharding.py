import collections
import random
import zlib

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyforge.llm import exact_dedup, sharding, simhash
from tallyforge.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import same_as_sql

CLASH = "doc_id long, text string, lang string, source string, n_chars long, sha string, kept int, size int, fp int, _row int, rank int"


def wide(spark, pairs):
    return spark.createDataFrame([(i, t, None, None, None, "s", 1, 2, 3, 4, 5) for i, t in pairs], CLASH)


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


# Exact duplicates


def test_exact_sql(spark, duck, sf):
    same_as_sql(QUERIES["op7_exact_dedup"](spark, sf), duck, ORACLE_SQL["op7_exact_dedup"])


PAIRS = [(1, "Ab"), (2, "aB"), (3, "É"), (4, "é"), (5, None), (6, ""), (7, "x"), (7, "x"), (None, "x"), (8, "l" * 200_000), (None, None)] + [(100 + i, "hot") for i in range(300)]


@pytest.mark.parametrize("support", [1e-4, 0.3])
def test_exact_groups(spark, support):
    rows = exact_dedup.duplicate_groups(wide(spark, PAIRS).repartition(4), support).collect()
    groups = collections.defaultdict(list)
    for i, t in PAIRS:
        groups[lower(t)].append(i)
    assert len(rows) == len(PAIRS)
    best = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    assert sorted((str(r.keep_id), r.group_size) for r in rows) == sorted((str(best[lower(t)]), len(groups[lower(t)])) for _, t in PAIRS)
    kept = [r for r in rows if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)
    left = exact_dedup.deduplicate(wide(spark, PAIRS), support)
    assert left.columns == [c.split()[0] for c in CLASH.split(", ")]
    assert sorted((str(r.doc_id), lower(r.text)) for r in left.collect()) == sorted((str(i), t) for t, i in best.items())


def test_exact_empty(spark):
    none = wide(spark, [])
    assert exact_dedup.duplicate_groups(none).count() == 0 and exact_dedup.deduplicate(none).count() == 0


# Sharding


def check_shards(pairs, rows):
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in rows) == sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in pairs)
    assert {(r.law, r.grown_shard) for r in rows} <= {("bytes", None)}
    slots, sizes = collections.defaultdict(list), collections.Counter()
    for r in rows:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(16))
    largest = max((len((t or "").encode()) + 1 for _, t in pairs), default=0)
    mean = sum(sizes.values()) / 16
    assert all(abs(sizes[s] - mean) <= largest for s in range(16))


def test_shards(spark, sf):
    pairs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()] + PAIRS
    check_shards(pairs, sharding.shard_by_bytes(wide(spark, pairs).repartition(3)).collect())


def test_shards_of_equal_rows(spark):
    pairs = [(7, "same text")] * 4000 + [(i, None) for i in range(500)] + [(9999, "w" * 3000)]
    check_shards(pairs, sharding.shard_by_bytes(wide(spark, pairs).repartition(3)).collect())


def test_equal_texts_stay_together(spark):
    pairs = [(i, f"text {i % 400}") for i in range(4000)]
    shards = collections.defaultdict(set)
    for r in sharding.shard_by_bytes(wide(spark, pairs)).collect():
        shards[r.text_crc32].add(r.shard)
    assert sum(len(s) > 1 for s in shards.values()) <= 15


def test_shards_empty_and_few(spark):
    assert sharding.shard_by_bytes(wide(spark, [])).count() == 0
    check_shards([(1, "a")], sharding.shard_by_bytes(wide(spark, [(1, "a")])).collect())


# SimHash


def brute_fp(t):
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
    sh = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def sets_of(fps, near=4):
    up = list(range(len(fps)))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= near:
                up[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def simhash_pairs(spark, sf):
    real = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    near = [(6000 + i, " ".join(w for k, w in enumerate(t.split()) if k != 5 + i)) for i, (_, t) in enumerate(real[:40])]
    return real + near + PAIRS[:11] + [(9000, "\x85a\xa0b c"), (9001, "one two three four"), (9002, "ONE two\tthree\nfour")]


def test_simhash(spark, sf):
    pairs = simhash_pairs(spark, sf)
    fps = [brute_fp(t) for _, t in pairs]
    roots = sets_of(fps)
    least = {}
    for (i, _), r in zip(pairs, roots):
        if i is not None:
            least[r] = min(least.get(r, 1 << 62), i)
    want = sorted((str(i), f"{f:016x}", least.get(r)) for (i, _), f, r in zip(pairs, fps, roots))
    assert len(set(roots)) < len(set(fps))
    got = simhash.near_duplicates(wide(spark, pairs).repartition(3)).collect()
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == want
    one = simhash.keep_one(wide(spark, pairs))
    assert one.columns[:3] == ["doc_id", "text", "lang"] and one.count() == len(set(roots))
    assert sorted(r.doc_id for r in one.collect()) == sorted(least.values())
    assert simhash.near_duplicates(wide(spark, [])).count() == 0 and simhash.keep_one(wide(spark, [])).count() == 0


def test_parts_meet_whatever_four_bits_differ():
    rng = random.Random(5)
    for count in (10, 10**6, 10**9, 10**13):
        masks = simhash.part_masks(count)
        for _ in range(300):
            spoiled = sum(1 << b for b in rng.sample(range(64), 4))
            assert any(not m & spoiled for m in masks)


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 4))
def test_connect(seed, meetings):
    rng = np.random.default_rng(seed)
    centers = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    fps = np.unique(centers[rng.integers(0, 6, 150)] ^ (np.uint64(1) << rng.integers(0, 64, 150, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 150, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 150, dtype=np.uint64)))
    meeting = np.sort(rng.integers(0, meetings, len(fps)))
    got = simhash.connect(meeting, fps)
    for m in range(meetings):
        own = np.flatnonzero(meeting == m)
        roots = sets_of([int(f) for f in fps[own]])
        assert len(set(zip(roots, got[own].tolist()))) == len(set(roots)) == len(set(got[own].tolist()))


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (-5, 200)], "a long, b long")
    got = {r.node: r.label for r in simhash.components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, -5: -5, 200: -5}


def test_long_texts(spark):
    words = [f"w{i * 7919 % 100_003}x{i}" for i in range(200_000)]
    changed = words[:777] + ["other"] + words[778:]
    rows = [(1, " ".join(words)), (2, "\n".join(words)), (3, " ".join(changed)), (4, " ".join(words[::-1])), (5, " ".join(words).upper()), (6, "x" * 3_000_000)]
    got = {r.doc_id: r for r in simhash.near_duplicates(wide(spark, rows)).collect()}
    assert [got[i].component_id for i in range(1, 7)] == [1, 1, 1, 4, 1, 6] and got[6].fingerprint == f"{brute_fp('x' * 3_000_000):016x}"
    assert {r.doc_id for r in exact_dedup.deduplicate(wide(spark, rows)).collect()} == {2, 3, 4, 5, 6}


def test_ties_of_exact_duplicates_do_not_depend_on_partitions(spark):
    rows = [(1, "aB"), (1, "Ab"), (1, "AB"), (None, "ab")] * 3
    left = [exact_dedup.deduplicate(wide(spark, r).repartition(n)).select("doc_id", "text").collect() for r, n in ((rows, 1), (rows[::-1], 4))]
    assert left[0] == left[1] and len(left[0]) == 1


def test_loose_rows_of_a_dense_meeting():
    rng = np.random.default_rng(6)
    center = rng.integers(0, 1 << 63, 1, dtype=np.uint64)
    near = np.repeat(center, 3000)
    for _ in range(4):
        near ^= np.uint64(1) << rng.integers(0, 64, 3000, dtype=np.uint64)
    fps = np.unique(np.concatenate((near, rng.integers(0, 1 << 63, 200, dtype=np.uint64), near[:100] ^ np.uint64(0xFF00))))
    got = simhash.connect(np.zeros(len(fps), int), fps)
    roots = sets_of([int(f) for f in fps])
    assert len(set(zip(roots, got.tolist()))) == len(set(roots)) == len(set(got.tolist()))
