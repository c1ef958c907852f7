"""Packed blocks: binary cells that move many values as one row.

Operators that look up every word or window of the corpus would shuffle billions of tiny rows.  They
move blocks instead: a block holds some megabytes of documents, asks each bucket of a hash for all its
values in one cell, and gets one cell back.  A value that is frequent in the corpus is asked for once
a block, however often it occurs there, so no bucket sees more of it than there are blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .common import bounded_batches

_zip, _unzip = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def squeeze(data: bytes) -> bytes:
    return _zip.compress(data)


def expand(data: bytes) -> bytes:
    return _unzip.decompress(data)


def pack_numbers(values: np.ndarray) -> bytes:
    """Non-negative integers, byte plane by byte plane, compressed."""
    values = np.ascontiguousarray(values, dtype="<u8")
    top = int(values.max()) if len(values) else 0
    planes = max(1, (top.bit_length() + 7) // 8)
    raw = values.view(np.uint8).reshape(-1, 8)[:, :planes]
    return bytes([planes]) + squeeze(np.ascontiguousarray(raw.T).tobytes())


def unpack_numbers(data: bytes) -> np.ndarray:
    planes = data[0]
    raw = np.frombuffer(expand(data[1:]), np.uint8).reshape(planes, -1)
    out = np.zeros((raw.shape[1], 8), np.uint8)
    out[:, :planes] = raw.T
    return out.reshape(-1).view("<u8")


def pack_strings(values: list[bytes]) -> bytes:
    lengths = pack_numbers(np.fromiter(map(len, values), np.int64, len(values)))
    return len(lengths).to_bytes(4, "little") + lengths + squeeze(b"".join(values))


def unpack_strings(data: bytes) -> list[bytes]:
    cut = 4 + int.from_bytes(data[:4], "little")
    ends = np.cumsum(unpack_numbers(data[4:cut]).astype(np.int64)).tolist()
    joined, at, out = expand(data[cut:]), 0, []
    for end in ends:
        out.append(joined[at:end])
        at = end
    return out


def pack_parts(*parts: bytes) -> bytes:
    return b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def unpack_parts(data: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at : at + 8], "little")
        out.append(data[at + 8 : at + 8 + n])
        at += 8 + n
    return out


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indexes start, start + 1, ... of each run, one run after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def by_key(rows: DataFrame, key: str, partitions: int, handle: Callable, schema: str, order: tuple[str, ...] = ()) -> DataFrame:
    """``handle(key, rows)`` for each key, with its rows (dicts, in ``order``) as a stream; yields rows as dicts.

    The stream is read as it is handled, so a key's rows need not fit in memory unless ``handle`` keeps them.
    """
    bounded_batches(rows.sparkSession)
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stream():
            for batch in batches:
                for i in range(batch.num_rows):  # one cell at a time: cells are large
                    yield {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}

        rest, ahead = stream(), [None]
        ahead[0] = next(rest, None)

        def own(value):
            while ahead[0] is not None and ahead[0][key] == value:
                row, ahead[0] = ahead[0], None
                yield row
                del row
                ahead[0] = next(rest, None)

        while ahead[0] is not None:
            value = ahead[0][key]
            group = own(value)
            yield from arrow_rows(handle(value, group), names, types)
            for _ in group:  # what a handler leaves unread
                pass

    spark = rows.sparkSession
    types = arrow_types(spark, schema)
    return rows.repartition(partitions, key).sortWithinPartitions(key, *order).mapInArrow(run, schema)


def arrow_types(spark, schema: str) -> list[pa.DataType]:
    plain = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(), "double": pa.float64()}
    return [plain[c.split()[1]] for c in schema.split(", ")]


def arrow_rows(rows, names: list[str], types: list[pa.DataType], most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows (tuples) as batches of about ``most`` bytes of binary cells."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(x) for x in row if isinstance(x, bytes))
        if size >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)


def document_blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[list, list[bytes]]]:
    """(doc_ids, texts as bytes) of consecutive documents, of at least ``most`` bytes but for the last."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            ids.append(doc_id)
            texts.append(text or b"")
            size += len(texts[-1]) + 100
            if size >= most:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts
