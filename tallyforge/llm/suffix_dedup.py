"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

A byte is removed if a string of DEPTH bytes that covers it also starts in a document with a smaller
doc_id.  Suffixes need ordering through DEPTH bytes only: ``first_owners`` sorts them by
most-significant-digit passes, drops a suffix as soon as its digits so far are its own or one owner's,
and what is left equal after the last pass are exactly the repeated windows.

Distribution: windows are dealt to buckets by the least hash of their GRAM-byte grams, so that equal
windows meet.  Neighbouring windows share that value for some dozen positions and travel as one
string.  A first exchange asks which values occur in two documents at all; strings travel only for
those.  Blocks of documents ask once for each distinct string, so frequent passages cost a string a block.
A value that leads more than HOT_RUNS runs (a frequent gram amid varied text) would fill its bucket: its
windows are dealt one by one, by the hash of all their bytes, to all buckets.

1. ``_blocks``   packs documents into blocks (written).
2. ``asks``      blocks ask buckets which of their values are shared; ``_shared`` answers in bits, also which
                 values are hot.
3. ``sends``     blocks send the strings of shared values; ``_owned`` sorts a bucket's suffixes and
                 answers with each window's first owner.
4. ``removed``   blocks remove what a smaller doc_id owns.

A null text counts as empty.  Documents of one doc_id do not remove each other's bytes; a null doc_id
counts as 2^63 - 1, the largest.  Texts under DEPTH bytes stay whole.  Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import arrow_rows, arrow_types, by_key, document_blocks, expand, pack_numbers, pack_parts, pack_strings, ragged, squeeze, unpack_numbers, unpack_parts, unpack_strings
from .common import block_size, bounded_batches, shuffle_width, written

DEPTH = 50
GRAM = 24
#: Blocks grow with the root of the input, so that cells (blocks x buckets) do not outgrow their contents.
LEAST_BLOCK, MOST_BLOCK, BLOCK_ROOT = 8 << 20, 128 << 20, 12.8
BUCKET_BYTES = 64 << 20
#: Runs of one value that a bucket takes, of some 76 bytes each.
HOT_RUNS = 1 << 19
CHUNK = 1 << 18
LAST = np.iinfo(np.int64).max
_BASE = 0x9E3779B97F4A7C15 | 1
_ROW = "block long, bucket int, cell binary, docs binary"
_NAMES = [c.split()[0] for c in _ROW.split(", ")]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


_LETTERS = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def _window_values(data: np.ndarray, depth: int, gram: int) -> np.ndarray:
    """For each window of ``depth`` bytes the least hash of the grams in it."""
    n = len(data)
    # Hashes of runs of 1, 2, 4, ... bytes; a gram's hash joins the powers that make up its length.
    run, length, have, got = _LETTERS[data], 1, None, 0
    while True:
        if gram & length:
            if have is None:
                have, got = run, length
            else:
                count = n - got - length + 1
                have = run[:count] * np.uint64(pow(_BASE, got, 1 << 64)) + have[length : length + count]
                got += length
        if 2 * length > gram:
            break
        run = run[: n - 2 * length + 1] * np.uint64(pow(_BASE, length, 1 << 64)) + run[length : n - length + 1]
        length *= 2
    least, width, span = _mix(have), 1, depth - gram + 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    return least


def runs(data: np.ndarray, ends: np.ndarray, depth: int = DEPTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, number of windows, value (48 bits) and document of the runs of windows with one value.

    ``ends``: where each document ends in ``data``.
    """
    begins = np.concatenate(([0], ends[:-1])).astype(np.int64)
    at, values = [], []
    for c in range(0, max(0, len(data) - depth + 1), CHUNK):
        stop = min(c + CHUNK, len(data) - depth + 1)
        v = _window_values(data[max(0, c - 1) : stop + depth - 1], depth, gram)
        if c == 0:
            v = np.concatenate((v[:1] + np.uint64(1), v))  # the first window opens a run
        opens = v[1:] != v[:-1]
        opens[begins[np.searchsorted(begins, c) : np.searchsorted(begins, stop)] - c] = True
        found = np.flatnonzero(opens)
        at.append(found + c)
        values.append(v[1:][found] >> np.uint64(16))
    if not at:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    at, values = np.concatenate(at), np.concatenate(values)
    doc = np.searchsorted(begins, at, side="right") - 1  # empty documents share a start; the last of them holds it
    until = np.minimum(np.concatenate((at[1:], [LAST])), ends[doc] - depth + 1)
    real = until > at
    return at[real], (until - at)[real], values[real], doc[real]


def first_owners(data: np.ndarray, starts: np.ndarray, counts: np.ndarray, owners: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """The least owner of each window's bytes, over all windows; strings' windows one after the other.

    String i has ``counts[i]`` windows from ``starts[i]`` on and belongs to ``owners[i]``.
    """
    at = ragged(starts, counts)
    owner = np.repeat(owners, counts)
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    words = np.ndarray((len(data) + 1,), ">u8", padded, 0, (1,))  # eight bytes from each byte on
    live, group, done = np.arange(len(at)), np.zeros(len(at), np.uint64), 0
    while done < depth and len(live):
        groups = int(group[-1]) + 1
        room = 64 - (groups - 1).bit_length()
        take = min(depth - done, room // 8)
        key = words[at[live] + done].astype(np.uint64) >> np.uint64(64 - 8 * take)
        if groups > 1:
            key |= group << np.uint64(8 * take)
        order = np.argsort(key)
        key, live = key[order], live[order]
        done += take
        # Groups of one owner need no further digits.
        opens = np.concatenate(([True], key[1:] != key[:-1]))
        begin = np.flatnonzero(opens)
        own = owner[live]
        mixed = np.minimum.reduceat(own, begin) != np.maximum.reduceat(own, begin)
        number = np.cumsum(opens) - 1
        stay = mixed[number]
        live = live[stay]
        group = (np.cumsum(mixed) - 1)[number[stay]].astype(np.uint64)
    if len(live):
        begin = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        least = np.minimum.reduceat(owner[live], begin)
        owner[live] = least[group.astype(np.int64)]
    return owner


def _blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    schema = "block long, docs binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for doc_ids, texts in document_blocks(batches, block_bytes):
            known = np.array([d is not None for d in doc_ids], np.uint8)
            ids = np.array([LAST if d is None else d for d in doc_ids], np.int64)
            lengths = pack_numbers(np.array(list(map(len, texts))))
            cell = pack_parts(squeeze(ids.tobytes()), squeeze(known.tobytes()), lengths, squeeze(b"".join(texts)))
            yield from arrow_rows([(block, cell)], ["block", "docs"], [pa.int64(), pa.binary()])
            block += 1

    bounded_batches(docs.sparkSession)
    return written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(run, schema), "suffix-blocks", "none")


class Block:
    """A block's documents and its runs of windows."""

    def __init__(self, cell: bytes, buckets: int, depth: int):
        ids, known, lengths, text = unpack_parts(cell)
        self.ids, self.known = np.frombuffer(expand(ids), np.int64), expand(known)
        self.data = np.frombuffer(expand(text), np.uint8)
        self.ends = np.cumsum(unpack_numbers(lengths).astype(np.int64))
        self.start, self.count, self.value, self.doc = runs(self.data, self.ends, depth)
        self.depth, self.buckets = depth, buckets
        # Distinct values by bucket; run -> its value's place.
        values, self.place = np.unique(self.value, return_inverse=True)
        bucket = (values % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        self.place, self.values = back[self.place], values[order]
        self.edges = np.searchsorted(bucket[order], np.arange(buckets + 1))

    def asks(self) -> Iterator[tuple[int, bytes]]:
        """By bucket: its values, whether two documents of this block hold each, and how many runs it has beyond the first."""
        low, high = np.full(len(self.values), LAST), np.full(len(self.values), -1)
        np.minimum.at(low, self.place, self.doc)
        np.maximum.at(high, self.place, self.doc)
        several, more = low < high, np.bincount(self.place, minlength=len(self.values)) - 1
        for b in range(self.buckets):
            cut = slice(self.edges[b], self.edges[b + 1])
            if cut.start < cut.stop:
                steps = np.diff(self.values[cut] // np.uint64(self.buckets), prepend=np.uint64(0))
                yield b, pack_parts(pack_numbers(steps), squeeze(np.packbits(several[cut]).tobytes()), pack_numbers(more[cut]))

    def share(self, bits: dict[int, bytes]) -> None:
        """Keeps the runs whose values are shared, takes hot ones apart, and numbers their distinct strings by bucket."""
        shared, hot = np.zeros(len(self.values), bool), np.zeros(len(self.values), bool)
        for b, cell in bits.items():
            cut = slice(self.edges[b], self.edges[b + 1])
            shared[cut], hot[cut] = (np.unpackbits(np.frombuffer(expand(x), np.uint8), count=cut.stop - cut.start).view(bool) for x in unpack_parts(cell))
        kept = np.flatnonzero((shared & ~hot)[self.place])
        apart = np.flatnonzero((shared & hot)[self.place])
        windows = ragged(self.start[apart], self.count[apart])
        start, doc = np.concatenate((self.start[kept], windows)), np.concatenate((self.doc[kept], np.repeat(self.doc[apart], self.count[apart])))
        end = start + np.concatenate((self.count[kept], np.ones(len(windows), np.int64))) + self.depth - 1
        # No string is of both kinds: windows of the same bytes have the same value.
        bucket = (np.concatenate((self.value[kept], self._hashes(windows))) % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        self.run_start, self.run_doc = start[order], doc[order]
        text, numbers = self.data.tobytes(), {}
        number = numbers.setdefault
        self.string = np.array([number(text[s:e], len(numbers)) for s, e in zip(self.run_start.tolist(), end[order].tolist(), strict=True)], np.int64)
        self.strings = list(numbers)
        self.owner = np.full(len(numbers), LAST)
        np.minimum.at(self.owner, self.string, self.ids[self.run_doc])
        string_bucket = np.zeros(len(numbers), np.int64)
        string_bucket[self.string] = bucket[order]
        self.string_edges = np.searchsorted(string_bucket, np.arange(self.buckets + 1))

    def _hashes(self, windows: np.ndarray) -> np.ndarray:
        """Of all bytes of each window."""
        found = np.zeros(len(windows), np.uint64)
        chunk = windows // CHUNK
        for c in np.unique(chunk):
            own = chunk == c
            found[own] = _window_values(self.data[c * CHUNK : (c + 1) * CHUNK + self.depth - 1], self.depth, self.depth)[windows[own] - c * CHUNK]
        return found

    def sends(self) -> Iterator[tuple[int, bytes]]:
        for b in range(self.buckets):
            cut = slice(self.string_edges[b], self.string_edges[b + 1])
            if cut.start < cut.stop:
                yield b, pack_parts(pack_strings(self.strings[cut]), squeeze(self.owner[cut].tobytes()))

    def removed(self, answers: dict[int, bytes]) -> np.ndarray:
        """Whether each byte goes."""
        pieces, lengths, owners = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for b in sorted(answers):
            p, n, o = unpack_parts(answers[b])
            pieces.append(unpack_numbers(p).astype(np.int64))
            lengths.append(unpack_numbers(n).astype(np.int64))
            owners.append(np.frombuffer(expand(o), np.int64))
        pieces, lengths, owners = map(np.concatenate, (pieces, lengths, owners))
        first = np.cumsum(pieces) - pieces
        offset = np.cumsum(lengths) - lengths
        offset -= np.repeat(offset[first] if len(first) else offset, pieces)  # within its string
        mine = pieces[self.string]
        each = ragged(first[self.string], mine)
        begin = np.repeat(self.run_start, mine) + offset[each]
        goes = owners[each] < np.repeat(self.ids[self.run_doc], mine)
        begin, end = begin[goes], (begin + lengths[each] + self.depth - 1)[goes]
        change = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(change, begin, 1)
        np.add.at(change, end, -1)
        return np.cumsum(change[:-1]) > 0

    def results(self, gone: np.ndarray, texts: bool) -> Iterator[tuple]:
        begin = 0
        for doc_id, known, end in zip(self.ids.tolist(), self.known, self.ends.tolist(), strict=True):
            mask = gone[begin:end]
            kept = self.data[begin:end][~mask].tobytes()
            spans = int(np.count_nonzero(mask[1:] & ~mask[:-1])) + int(len(mask) and mask[0])
            row = (doc_id if known else None, end - begin, int(np.count_nonzero(mask)), spans, hashlib.sha256(kept).hexdigest())
            yield (*row, kept) if texts else row
            begin = end


def _shared(rows: Iterator[dict], hot_runs: int) -> Iterator[tuple]:
    """Bits of a bucket's values that two documents hold, and of those that lead more than ``hot_runs`` runs."""
    blocks, values, several, more = [], [], [], []
    for row in rows:
        steps, bits, extra = unpack_parts(row["cell"])
        v = np.cumsum(unpack_numbers(steps), dtype=np.uint64)
        blocks.append((row["block"], row["bucket"]))
        values.append(v)
        several.append(np.unpackbits(np.frombuffer(expand(bits), np.uint8), count=len(v)).view(bool))
        more.append(unpack_numbers(extra).astype(np.int64))
    _, number, times = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
    shared = times > 1
    shared[number[np.concatenate(several)]] = True
    extra = np.concatenate(more)
    np.add.at(times, number[extra > 0], extra[extra > 0])
    hot, at = times > hot_runs, 0
    for (block, bucket), v in zip(blocks, values, strict=True):
        own = number[at : at + len(v)]
        yield block, bucket, pack_parts(*(squeeze(np.packbits(x[own]).tobytes()) for x in (shared, hot))), None
        at += len(v)


def _owned(rows: Iterator[dict], depth: int) -> Iterator[tuple]:
    """The first owners of the windows of a bucket's strings, as runs of equal owners."""
    numbers: dict[bytes, int] = {}
    owners, asked = [], []
    for row in rows:
        strings, own = unpack_parts(row["cell"])
        own = np.frombuffer(expand(own), np.int64)
        mine = np.array([numbers.setdefault(s, len(numbers)) for s in unpack_strings(strings)], np.int64)
        asked.append((row["block"], row["bucket"], mine))
        owners.append(own)
    least = np.full(len(numbers), LAST)
    np.minimum.at(least, np.concatenate([m for _, _, m in asked]), np.concatenate(owners))
    lengths = np.fromiter(map(len, numbers), np.int64, len(numbers))
    data = np.frombuffer(b"".join(numbers), np.uint8)
    counts = lengths - depth + 1
    del owners
    first = first_owners(data, np.cumsum(lengths) - lengths, counts, least, depth)
    opens = np.concatenate(([True], first[1:] != first[:-1]))
    begins = np.cumsum(counts) - counts
    opens[begins] = True
    piece = np.flatnonzero(opens)
    size = np.diff(piece, append=len(first))
    from_piece = np.searchsorted(piece, begins)
    pieces = np.diff(from_piece, append=len(piece))
    for block, bucket, mine in asked:
        each = ragged(from_piece[mine], pieces[mine])
        yield block, bucket, pack_parts(pack_numbers(pieces[mine]), pack_numbers(size[each]), squeeze(first[piece[each]].tobytes())), None


def _block_of(rows: Iterator[dict], buckets: int, depth: int) -> tuple[Block | None, dict, dict]:
    """The documents, the bits and the owners that reach a block."""
    block, bits, owners = None, {}, {}
    for row in rows:
        if row["docs"] is not None:
            block = Block(row["docs"], buckets, depth)
        else:
            (bits if row["kind"] == 0 else owners)[row["bucket"]] = row["cell"]
    return block, bits, owners


def remove_repeats(docs: DataFrame, depth: int = DEPTH, block_bytes: int | None = None, buckets: int | None = None, texts: bool = False, hot_runs: int = HOT_RUNS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if ``texts``, the bytes that stay (kept)."""
    spark = docs.sparkSession
    width = shuffle_width(spark)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    block_bytes = block_bytes or block_size(total, LEAST_BLOCK, MOST_BLOCK, BLOCK_ROOT)
    buckets = buckets or max(width, min(total // BUCKET_BYTES, block_bytes // 1024))
    blocks = _blocks(docs, block_bytes)
    types = arrow_types(spark, _ROW)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.column("block")[i].as_py()
                asks = Block(batch.column("docs")[i].as_py(), buckets, depth).asks()
                yield from arrow_rows(((block, b, cell, None) for b, cell in asks), _NAMES, types)

    def send(block: int, rows: Iterator[dict]) -> Iterator[tuple]:
        own, bits, _ = _block_of(rows, buckets, depth)
        own.share(bits)
        for b, cell in own.sends():
            yield block, b, cell, None

    def cut(_: int, rows: Iterator[dict]) -> Iterator[tuple]:
        own, bits, answers = _block_of(rows, buckets, depth)
        own.share(bits)
        yield from own.results(own.removed(answers), texts)

    kind = lambda df, k: df.withColumn("kind", F.lit(k))
    whole = kind(blocks.select("block", F.lit(-1).alias("bucket"), F.lit(None).cast("binary").alias("cell"), "docs"), 2)
    bits = kind(written(by_key(blocks.mapInArrow(ask, _ROW), "bucket", width, lambda _, rows: _shared(rows, hot_runs), _ROW), "suffix-shared", "none"), 0)
    strings = by_key(bits.unionByName(whole), "block", width, send, _ROW)
    owned = kind(by_key(strings, "bucket", width, lambda _, rows: _owned(rows, depth), _ROW), 1)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * texts
    return by_key(bits.unionByName(whole).unionByName(owned), "block", width, cut, schema)
