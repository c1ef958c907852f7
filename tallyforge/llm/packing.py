"""Packing documents into fixed-length token sequences by Karmarkar-Karp multiway differencing.

Each task packs its own documents, a group of about GROUP_TOKENS tokens at a time, so nothing is
shuffled and memory is bounded by a group and one Arrow batch.

* A document is its token ids and an end id.  What fills whole windows becomes sequences of its own;
  the rest of each document is one item.
* ``difference`` merges partial partitions, the largest imbalance first, adding the k sums of one in
  descending order to those of the other in ascending order.  ``windows`` starts with the fewest
  windows that could do and raises their number whenever one exceeds the capacity.
* Since documents may be cut, the last windows are then dissolved to fill the others to the brim.
  What is left over is cut at powers of two, which need no padding.

A null text counts as empty and yields its end id alone.  Rows that repeat a doc_id are packed each.
Empty tables give empty results.  Sequence ids hold the task's partition number in their upper bits.
"""

from __future__ import annotations

import heapq
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches

CAPACITY = 4096
END_ID = 2
GROUP_TOKENS = 1 << 19
#: Bytes of words and ids that a worker remembers in each of two generations, with what an entry takes besides.
REMEMBERED_BYTES, ENTRY_BYTES = 160 << 20, 120
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]

_memory: dict = {}


class WordEncoder:
    """Ids of whole texts, from the library's ids of each white-space separated word.

    The vocabulary drops white space and never merges across it, nor across the border of letters and
    punctuation, so a text's ids are those of its parts in turn.  A plain word, Latin letters and at
    most some closing marks, goes to the library's merges directly, in lower case; any other word goes
    through the whole library.  Tests hold this against the library on whole texts.
    """

    PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,!?;:]*)")

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.merge = self.tokenizer.model.tokenize
        # How the library spells each plain letter's bytes before it merges them.
        letters = [chr(c) for c in (*range(97, 123), *range(0xDF, 0xF7), *range(0xF8, 0x100))]
        self.spelling = {ord(c): self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in letters}
        self.older: dict[bytes, bytes] = {}
        self._renew()

    def _renew(self) -> None:
        self.known: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {"": b""}
        self.size = 0

    def _whole(self, text: str) -> bytes:
        return _cell(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def learn(self, word: bytes) -> bytes:
        if (cell := self.older.get(word)) is not None:
            return cell
        text = word.decode()
        plain = self.PLAIN.fullmatch(text)
        if plain is None:
            return self._whole(text)
        letters, marks = plain[1].lower(), plain[2]
        if (head := self.parts.get(letters)) is None:
            head = self.parts[letters] = _cell([t.id for t in self.merge(letters.translate(self.spelling))])
            self.size += len(letters) + len(head) + ENTRY_BYTES
        if (end := self.parts.get(marks)) is None:
            end = self.parts[marks] = self._whole(marks)
            self.size += len(marks) + len(end) + ENTRY_BYTES
        return head + end

    def encode(self, words: list[bytes]) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        known = self.known
        cells = list(map(known.get, words))
        if None in cells:
            # By the cell's place, since the memory may be renewed on the way.
            for i in [i for i, cell in enumerate(cells) if cell is None]:
                if (cell := self.known.get(words[i])) is None:
                    if self.size > REMEMBERED_BYTES:  # frequent words come back from the older generation
                        self.older = self.known
                        self._renew()
                    cell = self.known[words[i]] = self.learn(words[i])
                    self.size += len(words[i]) + len(cell) + ENTRY_BYTES
                cells[i] = cell
        return b"".join(cells)


def _cell(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def difference(sizes: np.ndarray, k: int) -> list[list[int]]:
    """Karmarkar-Karp: the items of k windows of near-equal sums."""
    n = len(sizes)
    after, tail = np.full(n, -1), np.arange(n)
    # A partial partition holds the slots in use only, by descending sum; all others are empty.
    sums = [np.array([s]) for s in sizes]
    heads = [np.array([i]) for i in range(n)]
    heap = [(-int(s), i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        sa, sb, ha, hb = sums[a], sums[b], heads[a], heads[b]
        both = len(sa) + len(sb) - k
        if both <= 0:
            s, h = np.concatenate((sa, sb)), np.concatenate((ha, hb))
        else:  # the smallest slots of one meet the largest of the other
            x, y = ha[len(sa) - both :], hb[len(sb) - both :][::-1]
            after[tail[x]] = y
            tail[x] = tail[y]
            s = np.concatenate((sa[: len(sa) - both], sa[len(sa) - both :] + sb[len(sb) - both :][::-1], sb[: len(sb) - both]))
            h = np.concatenate((ha, hb[: len(sb) - both]))
        order = np.argsort(-s, kind="stable")
        s, h = s[order], h[order]
        least = s[-1] if len(s) == k else 0
        sums[a], heads[a], sums[b], heads[b] = s, h, None, None
        # Sums stay whole here; imbalance is what ranks a partial partition.
        heapq.heappush(heap, (-int(s[0] - least), a))
    found = []
    for head in heads[heap[0][1]] if heap else []:
        items = []
        while head >= 0:
            items.append(int(head))
            head = after[head]
        found.append(items)
    return found + [[] for _ in range(k - len(found))]


def windows(sizes: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Near-equal windows within the capacity; no item may exceed it."""
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        found = difference(sizes, k)
        most = max((int(sizes[w].sum()) for w in found if w), default=0)
        if most <= capacity:
            return found
        k += max(1, k * (most - capacity) // (2 * capacity))


def sequences(lengths: np.ndarray, capacity: int = CAPACITY) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document, start, length) of documents of these lengths, without padding.

    All sequences are full but the last few, whose lengths are distinct powers of two.
    """
    done = [[(d, at, capacity)] for d, n in enumerate(lengths) for at in range(0, int(n) - capacity + 1, capacity)]
    rest = lengths % capacity
    items = np.flatnonzero(rest)
    if not len(items):
        return done
    pieces = [[(int(items[i]), int(lengths[items[i]] - rest[items[i]]), int(rest[items[i]])) for i in w] for w in windows(rest[items], capacity)]
    fills = [sum(p[2] for p in w) for w in pieces]
    order = sorted(range(len(pieces)), key=lambda j: -fills[j])
    full = int(rest.sum()) // capacity
    spare = [p for j in order[full:] for p in pieces[j]]

    def take(want: int) -> list[tuple[int, int, int]]:
        got = []
        while want:
            d, at, n = spare.pop()
            if n > want:
                spare.append((d, at + want, n - want))
                n = want
            got.append((d, at, n))
            want -= n
        return got

    done += [pieces[j] + take(capacity - fills[j]) for j in order[:full]]
    left = int(rest.sum()) - full * capacity
    done += [take(1 << bit) for bit in reversed(range(left.bit_length())) if left >> bit & 1]
    return done


def _rows(ids: list[bytes], doc_ids: list, first: int, capacity: int) -> tuple[pa.RecordBatch, int]:
    lengths = np.array([len(x) // 4 for x in ids], dtype=np.int64)
    out: list[list] = [[] for _ in _COLUMNS]
    packed = sequences(lengths, capacity)
    for number, pieces in enumerate(packed, first):
        offset = 0
        for d, at, n in pieces:
            crc = zlib.crc32(memoryview(ids[d])[4 * at : 4 * (at + n)])
            for column, value in zip(out, (doc_ids[d], at, n, crc, int(lengths[d]), number, offset), strict=True):
                column.append(value)
            offset += n
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=_COLUMNS), first + len(packed)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    bounded_batches(spark)
    with open(tokenizer_path, encoding="utf-8") as f:  # the vocabulary's size is fixed
        definition = spark.sparkContext.broadcast(f.read())
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if _memory.get("of") != tokenizer_path:
            _memory.update(of=tokenizer_path, encoder=WordEncoder(definition.value))
        encoder = _memory["encoder"]
        number, tokens = TaskContext.get().partitionId() << 40, 0
        ids: list[bytes] = []
        doc_ids: list = []
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids.append(encoder.encode((text or b"").split()) + end)
                doc_ids.append(doc_id)
                tokens += len(ids[-1]) // 4
                if tokens >= group_tokens:
                    rows, number = _rows(ids, doc_ids, number, capacity)
                    yield rows
                    ids, doc_ids, tokens = [], [], 0
        if ids:
            yield _rows(ids, doc_ids, number, capacity)[0]

    # Plain bytes: their split() parts at the six ASCII white-space characters alone.
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(run, SCHEMA)
