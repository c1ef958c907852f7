"""SimHash near-duplicates linked through pivot distance tables.

1. ``fingerprints``: 64 bits of the majority of the shingles' XXH64 values, one row per document.
2. Equal fingerprints become one row with its least doc_id, so copies cost one candidate.
3. ``links``: fingerprints at most NEAR bits apart agree on SHARED of SHARED + NEAR parts of their
   bits (NEAR differing bits spoil at most NEAR parts), so they meet under some choice of parts; more
   parts are asked for the more fingerprints there are, which keeps a meeting's expected size level.
   There, a table holds each fingerprint's Hamming distances to PIVOTS reference fingerprints.  Two
   fingerprints whose distances to any pivot differ by more than NEAR are discarded (triangle
   inequality); survivors are verified bit by bit.  Rows are ordered by the first pivot's distance, so
   the comparison of a row stops at the first that is too far, and pairs already connected are not
   compared (``connect``).  What leaves a task is at most one link a row, to its set's first member: never all pairs.
4. ``components``: least labels by propagation with pointer jumping, each round written to the shared
   folder.

Words are runs without the six ASCII white-space characters, lower-cased A-Z; shingles are SHINGLE
words joined by spaces, repeats included (fewer words: all of them; none: fingerprint zero, linked
like any other).  A null text counts as empty; a null doc_id never names a component unless all its
members' are null.  Repeated rows count each; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import ragged
from .common import bounded_batches, discard, frequent_keys, salted_join, shuffle_width, without, written

BITS = 64
SHINGLE = 4
SEED = 42
NEAR = 4
PIVOTS = 16
#: Fingerprints expected to meet under one choice of parts, at most.
MEETING = 64
#: Rows compared at a time, unless one meeting holds more.
COMPARED = 200_000
#: Rows behind it that each row of a meeting is compared with first, and pairs looked at together after that.
STEPS, PAIRS = 32, 1 << 20


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    import xxhash

    words = text.lower().split()  # on bytes: A-Z and the six characters only
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        values = [digest(joined, SEED)]
    else:
        starts, at = [], 0
        for w in words:
            starts.append(at)
            at += len(w) + 1
        starts.append(at)
        view = memoryview(joined)
        values = [digest(view[a : b - 1], SEED) for a, b in zip(starts, starts[shingle:])]
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(values), 1 << 14):
        part = np.array(values[i : i + (1 << 14)], "<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(values), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, keep: list[str], shingle: int = SHINGLE) -> DataFrame:
    """The columns ``keep`` of ``docs`` as _own_..., fp (a signed long) and _row; written."""
    bounded_batches(docs.sparkSession)
    slim = docs.select(*(F.col(c).alias(f"_own_{c}") for c in keep), F.col("text").cast("binary").alias("_text"))
    own = slim.columns[:-1]
    schema = slim.select(*own).withColumn("fp", F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = np.array([fingerprint(t or b"", shingle) for t in b.column("_text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(c) for c in own] + [pa.array(values)], names=[*own, "fp"])

    return written(slim.mapInArrow(run, schema).withColumn("_row", F.monotonically_increasing_id()), "simhash-rows")


def part_masks(fingerprint_count: int, near: int = NEAR) -> list[int]:
    """Bit masks such that fingerprints at most ``near`` bits apart agree under one of them at least."""
    for shared in range(1, 6):
        parts = shared + near
        cuts = [BITS * i // parts for i in range(parts + 1)]
        if fingerprint_count <= MEETING << (shared * (BITS // parts)):
            break
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [sum(c) for c in combinations(masks, shared)]


def pivots(count: int = PIVOTS) -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, 1 << 64, count, dtype=np.uint64)


def _union(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Gives the sets of i[k] and j[k] one label, the least row of them all; labels stay roots."""
    while len(i):
        a, b = label[i], label[j]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label != (up := label[label])).any():
            label[:] = up
        open_ = label[i] != label[j]
        i, j = i[open_], j[open_]


def connect(meeting: np.ndarray, fps: np.ndarray, near: int = NEAR) -> np.ndarray:
    """For each row a row of its connected set, the same for all of the set; links only inside a meeting.

    Rows are compared with the next STEPS of their meeting first, which connects most of any dense set.
    Then the rows outside their meeting's largest set are compared with all that the first pivot's
    distance leaves in reach: rows of one set need no comparison, so a meeting of n rows, k of them
    outside its largest set, costs k times n at most.
    """
    table = np.bitwise_count(fps[:, None] ^ pivots()[None, :]).astype(np.int8)
    order = np.lexsort((table[:, 0], meeting))
    meeting, fps, table = meeting[order], fps[order], table[order]
    n = len(fps)
    label = np.arange(n)

    def verified(i: np.ndarray, j: np.ndarray) -> None:
        apart = label[i] != label[j]
        i, j = i[apart], j[apart]
        within = np.abs(table[i] - table[j]).max(axis=1, initial=0) <= near
        i, j = i[within], j[within]
        same = np.bitwise_count(fps[i] ^ fps[j]) <= near
        _union(label, i[same], j[same])

    at, step = np.arange(n), 0
    while len(at) and step < STEPS:
        step += 1
        at = at[at + step < n]
        # Neither a longer step nor a farther first coordinate can come back into reach.
        at = at[(meeting[at] == meeting[at + step]) & (table[at + step, 0] - table[at, 0] <= near)]
        verified(at, at + step)
    if len(at):
        opens = np.flatnonzero(np.concatenate(([True], meeting[1:] != meeting[:-1])))
        number = np.cumsum(np.concatenate(([0], meeting[1:] != meeting[:-1])))
        # Of each meeting a row of its largest set.
        sets, times = np.unique(label, return_counts=True)
        by_size = np.lexsort((times, number[sets]))
        largest = sets[by_size[np.searchsorted(number[sets][by_size], np.arange(len(opens)), side="right") - 1]]
        place = number * 256 + table[:, 0]
        loose = np.flatnonzero(label != label[largest[number]])
        while len(loose):
            low, high = np.searchsorted(place, place[loose] - near), np.searchsorted(place, place[loose] + near, side="right")
            some = max(1, int(np.searchsorted(np.cumsum(high - low), PAIRS, side="right")))
            verified(np.repeat(loose[:some], (high - low)[:some]), ragged(low[:some], (high - low)[:some]))
            loose = loose[some:]
            loose = loose[label[loose] != label[largest[number[loose]]]]
    out = np.empty(n, np.int64)
    out[order] = order[label]
    return out


def links(fps: DataFrame, near: int = NEAR) -> DataFrame:
    """a, b: fingerprints of one connected set; written.  ``fps`` holds each fingerprint once."""
    spark = fps.sparkSession
    bounded_batches(spark)
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in part_masks(fps.count(), near)]
    keys = F.explode(F.array(*(F.struct(F.lit(k).alias("choice"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("part")) for k, m in enumerate(signed))))
    rows = fps.select(keys.alias("k"), "fp").select("k.choice", "k.part", "fp")

    def pairs(choice: np.ndarray, part: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        meeting = np.cumsum(np.concatenate(([False], (choice[1:] != choice[:-1]) | (part[1:] != part[:-1]))))
        root = connect(meeting, fp.view(np.uint64), near)
        moved = root != np.arange(len(fp))
        return pa.RecordBatch.from_arrays([pa.array(fp[moved]), pa.array(fp[root[moved]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append([batch.column(c).to_numpy(zero_copy_only=False) for c in ("choice", "part", "fp")])
            size += batch.num_rows
            if size >= COMPARED:
                all_ = [np.concatenate(c) for c in zip(*held, strict=True)]
                last = np.flatnonzero((all_[0] != all_[0][-1]) | (all_[1] != all_[1][-1]))
                cut = int(last[-1]) + 1 if len(last) else 0  # the last meeting may go on
                if cut:
                    yield pairs(*(c[:cut] for c in all_))
                held, size = [[c[cut:] for c in all_]], len(all_[0]) - cut
        if size:
            yield pairs(*(np.concatenate(c) for c in zip(*held, strict=True)))

    found = rows.repartition(shuffle_width(spark), "choice", "part").sortWithinPartitions("choice", "part").mapInArrow(run, "a long, b long")
    return written(found.distinct(), "simhash-links")


def components(edges: DataFrame) -> DataFrame:
    """node, label: the least node that each node of ``edges`` (a, b) reaches."""
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "component-edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "component-labels")
    hubs = frequent_keys(both, ["b"])
    while True:
        near = salted_join(both, labels.select(F.col("node").alias("b"), "label"), ["b"], ["a"], hot=hubs).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("_near"))
        hooked = labels.join(near, "node").select("node", F.least("label", "_near").alias("_to"), F.col("label").alias("_was"))
        hooked = written(hooked, "component-hooks")
        # Many nodes point to one label; those are dealt to several tasks as well.
        jumped = salted_join(hooked, labels.select(F.col("node").alias("_to"), F.col("label").alias("_far")), ["_to"], ["node"]).select("node", F.least("_to", "_far").alias("label"), "_was")
        new = written(jumped, "component-labels")
        discard(labels, hooked)
        if not new.filter("label != _was").limit(1).count():
            return new.select("node", "label")
        labels = new


def _grouped(rows: DataFrame, first: Column) -> DataFrame:
    """fp and the least ``first`` of its component; one row per distinct fingerprint."""
    fps = written(rows.groupBy("fp").agg(F.min(first).alias("_first")), "simhash-distinct")
    sets = fps.join(components(links(fps.select("fp"))).withColumnRenamed("node", "fp"), "fp", "left").select("fp", "_first", F.coalesce("label", "fp").alias("_set"))
    sets = written(sets, "simhash-sets")
    least = sets.groupBy("_set").agg(F.min("_first").alias("_first"))
    return salted_join(sets.select("fp", "_set"), least, ["_set"], ["fp"]).select("fp", "_first")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, component_id; one row per document."""
    rows = fingerprints(docs, ["doc_id"]).select(F.col("_own_doc_id").alias("doc_id"), "fp", "_row")
    found = _grouped(rows, F.col("doc_id")).withColumnRenamed("_first", "component_id")
    return salted_join(rows, found, ["fp"], ["_row"]).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component, the one of least doc_id; columns unchanged."""
    columns = docs.columns
    rows = fingerprints(docs, columns)
    rank = F.struct(F.col("_own_doc_id").isNull().alias("null"), F.col("_own_doc_id").alias("id"), "_row")
    winners = written(_grouped(rows.select("_own_doc_id", "fp", "_row"), rank).select(F.col("_first._row").alias("_row")).distinct(), "simhash-winners")
    losers = written(rows.select("_row").join(winners, "_row", "left_anti"), "simhash-losers")
    left = without(rows, losers)
    return left.select(*(F.col(f"_own_{c}").alias(c) for c in columns))
