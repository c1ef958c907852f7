"""Byte-level BPE by a global distinct-word shuffle.

1. Pre-tokens of each document are exploded with their positions.  A block of documents keeps its
   distinct pre-tokens once and, for each position, the pre-token's number in the block.
2. The distinct pre-tokens of all blocks are shuffled by hash, and each is encoded once: the task of a
   bucket remembers the ids of all its pre-tokens.  Buckets grow in number with the input, so that a
   bucket holds the distinct pre-tokens of BUCKET_BYTES of it; blocks grow with its root, and once they
   have reached MOST_BLOCK a bucket's share grows with the root of the input too.
3. The ids are joined back to the blocks, and texts are reassembled by position.

Decoding joins the token-byte table: the tables of token bytes have as many rows as the vocabulary,
whose size is fixed, so they go to every worker.

A null text counts as empty.  Rows that repeat a doc_id are encoded each.  Empty tables give empty
results.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import arrow_rows, arrow_types, by_key, document_blocks, expand, pack_numbers, pack_parts, pack_strings, ragged, squeeze, unpack_numbers, unpack_parts, unpack_strings
from .common import block_size, bounded_batches, shuffle_width, stored_bytes, written

#: Blocks grow with the root of the input, from BLOCK_BYTES to MOST_BLOCK.
BLOCK_BYTES, MOST_BLOCK, BLOCK_ROOT = 32 << 20, 128 << 20, 12.8
BUCKET_BYTES = 256 << 20
#: Bytes of a block for each bucket at least.
LEAST_CELL = 1024
#: The bucket number of documents, which orders them behind the replies.
LAST = (1 << 31) - 1
_ROW = "block long, bucket int, words binary, docs binary"
_memory: dict = {}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def fingerprint(ranks: dict[bytes, int]) -> str:
    """Names a vocabulary by its contents."""
    named = hashlib.blake2b(digest_size=16)
    for token in sorted(ranks):
        named.update(b"%d %d " % (ranks[token], len(token)) + token)
    return named.hexdigest()


def kept(name: tuple, make):
    """What ``make`` gives, kept under the name for a worker's life; one thing of each kind (``name[0]``)."""
    if _memory.get(name[0], (None,))[0] != name:
        _memory[name[0]] = name, make()
    return _memory[name[0]][1]


def encoder(pattern: str, ranks: dict[bytes, int], vocabulary: str):
    """The library's encoding."""
    import tiktoken

    return kept(("encoding", pattern, vocabulary), lambda: tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}))


def answered(bucket: int, rows: Iterator[dict], encode_one) -> Iterator[tuple]:
    """For each cell of a bucket's words the lengths and ids of their encodings; each distinct word is encoded once."""
    known: dict[bytes, bytes] = {}
    for row in rows:
        cells = []
        for w in unpack_strings(row["words"]):
            if (cell := known.get(w)) is None:
                cell = known[w] = np.array(encode_one(w.decode()), "<u4").tobytes()
            cells.append(cell)
        lengths = np.fromiter(map(len, cells), np.int64, len(cells)) // 4
        yield row["block"], bucket, pack_parts(pack_numbers(lengths), pack_numbers(np.frombuffer(b"".join(cells), "<u4"))), None


class TokenBytes:
    """The token-byte table, laid out to look up many ids at once."""

    def __init__(self, cells: dict[int, bytes]):
        size = max(cells, default=-1) + 1
        self.lengths = np.zeros(size, np.int64)
        for i, c in cells.items():
            self.lengths[i] = len(c)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(cells.get(i, b"") for i in range(size)), np.uint8)

    def join(self, ids: np.ndarray) -> bytes:
        return self.data[ragged(self.starts[ids], self.lengths[ids])].tobytes()


class Block:
    """Consecutive documents: their distinct pre-tokens, dealt to buckets, and each position's number."""

    def __init__(self, doc_ids: list, texts: list[bytes], split, buckets: int):
        numbers: dict[str, int] = {}
        number, at = numbers.setdefault, []
        for text in texts:
            at.append(np.array([number(w, len(numbers)) for w in split(text.decode())], dtype=np.uint32))
        self.doc_ids, self.at = doc_ids, at
        self.words = [w.encode() for w in numbers]
        bucket = np.fromiter((zlib.crc32(w) % buckets for w in self.words), np.int64, len(self.words))
        self.order = np.argsort(bucket, kind="stable")
        self.buckets, self.edges = buckets, np.searchsorted(bucket[self.order], np.arange(buckets + 1))
        # Named by its contents: blocks of one name have the same words and positions.
        name = hashlib.blake2b(repr(doc_ids).encode(), digest_size=8)
        for text in texts:
            name.update(len(text).to_bytes(8, "little"))
            name.update(text)
        self.name = int.from_bytes(name.digest(), "big", signed=True)

    def asked(self) -> Iterator[tuple]:
        for b in range(self.buckets):
            if self.edges[b] < self.edges[b + 1]:
                yield self.name, b, pack_strings([self.words[i] for i in self.order[self.edges[b] : self.edges[b + 1]]]), None

    def documents(self) -> tuple:
        """Positions hold ranks by frequency, which take the least room."""
        at = np.concatenate(self.at)
        ranked = np.argsort(-np.bincount(at, minlength=len(self.words)), kind="stable")
        rank, place = np.empty(len(ranked), np.int64), np.empty(len(ranked), np.int64)
        rank[ranked] = np.arange(len(ranked))
        place[self.order] = np.arange(len(ranked))
        known = np.array([d is not None for d in self.doc_ids], np.uint8)
        ids = np.array([d or 0 for d in self.doc_ids], np.int64).tobytes()
        sizes = np.array(list(map(len, self.at)))
        return self.name, LAST, None, pack_parts(squeeze(ids), squeeze(known.tobytes()), pack_numbers(sizes), pack_numbers(place[ranked]), pack_numbers(rank[at]))


def _blocks(docs: DataFrame, pattern: str, buckets: int, block_bytes: int, rows_of) -> DataFrame:
    """block, bucket, words, docs: what ``rows_of`` gives for each block."""
    spark = docs.sparkSession
    types, names = arrow_types(spark, _ROW), [c.split()[0] for c in _ROW.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        split = regex.compile(pattern).findall
        for doc_ids, texts in document_blocks(batches, block_bytes):
            yield from arrow_rows(rows_of(Block(doc_ids, texts, split, buckets)), names, types)

    bounded_batches(spark)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(run, _ROW)


def encode(docs: DataFrame, ranks_path: str, pattern: str, block_bytes: int | None = None, finish=None, schema: str = "doc_id long, ids binary", stored: bool = False) -> DataFrame:
    """doc_id and its token ids as little-endian unsigned 32-bit integers, or what ``finish(ids)`` makes of them.

    ``finish`` takes an array of ids and returns the further columns of ``schema``.  The documents are
    read twice, once for their words and once for their positions, and must come in the same order
    both times: ``stored`` says that ``docs`` is read from files; anything else is written first.
    """
    spark = docs.sparkSession
    if not stored:
        docs = written(docs.select("doc_id", "text"), "bpe-documents")
    table = read_ranks(ranks_path)
    ranks, vocabulary = spark.sparkContext.broadcast(table), fingerprint(table)
    width, total = shuffle_width(spark), stored_bytes(docs)
    block_bytes = block_bytes or block_size(total, BLOCK_BYTES, MOST_BLOCK, BLOCK_ROOT)
    buckets = max(width, min(total // BUCKET_BYTES, block_bytes // LEAST_CELL))
    words = _blocks(docs, pattern, buckets, block_bytes, Block.asked).select("block", "bucket", "words")
    documents = _blocks(docs, pattern, buckets, block_bytes, lambda block: [block.documents()])

    def answer(bucket: int, rows: Iterator[dict]) -> Iterator[tuple]:
        return answered(bucket, rows, encoder(pattern, ranks.value, vocabulary).encode_ordinary)

    def assemble(block: int, rows: Iterator[dict]) -> Iterator[tuple]:
        lengths, ids, last = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], -1
        for row in rows:  # replies by bucket, then the documents
            if row["docs"] is None:
                if row["bucket"] == last:  # another block of the same contents asked as well
                    continue
                last = row["bucket"]
                n, i = map(unpack_numbers, unpack_parts(row["words"]))
                lengths.append(n)
                ids.append(i)
                continue
            size = np.concatenate(lengths).astype(np.int64)
            pool = np.concatenate(ids).astype(np.uint32)
            start = np.cumsum(size) - size
            doc_ids, known, counts, place, at = unpack_parts(row["docs"])
            place = unpack_numbers(place).astype(np.int64)
            if len(place) != len(size):
                raise RuntimeError("the documents changed between the two passes")
            size, start = size[place], start[place]
            at, done = unpack_numbers(at).astype(np.int64), 0
            for doc_id, is_known, n in zip(np.frombuffer(expand(doc_ids), np.int64).tolist(), expand(known), unpack_numbers(counts).tolist(), strict=True):
                words = at[done : done + n]
                done += n
                own = pool[ragged(start[words], size[words])]
                yield (doc_id if is_known else None, *((own.astype("<u4").tobytes(),) if finish is None else finish(own)))

    replies = by_key(words, "bucket", width, answer, _ROW)
    return by_key(replies.unionByName(documents), "block", width, assemble, schema, ("bucket",))


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id and the bytes that its ids stand for; unknown ids stand for none."""
    spark = encoded.sparkSession
    bounded_batches(spark)
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = TokenBytes({r: t for t, r in ranks.value.items()})
        for batch in batches:
            cells = [table.join(np.frombuffer(x or b"", "<u4")) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(cells, pa.binary())], names=["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def decimal_table(ranks: dict[bytes, int]) -> TokenBytes:
    """Each id as decimal digits and a comma."""
    return TokenBytes({r: b"%d," % r for r in ranks.values()})


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, block_bytes: int | None = None, stored: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: texts encoded, and the ids decoded again."""
    table = read_ranks(ranks_path)
    ranks, vocabulary = docs.sparkSession.sparkContext.broadcast(table), fingerprint(table)
    sha = lambda b: hashlib.sha256(b).hexdigest()

    def finish(ids: np.ndarray) -> tuple:
        digits, cells = kept(("tables", vocabulary), lambda: (decimal_table(ranks.value), TokenBytes({r: t for t, r in ranks.value.items()})))
        return len(ids), sha(digits.join(ids)[:-1]), sha(cells.join(ids))

    return encode(docs, ranks_path, pattern, block_bytes, finish, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", stored)
