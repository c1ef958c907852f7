import base64
import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyforge.llm import blocks, bpe, packing

RANKS, WORDS = P.path("byte_bpe_multi_50k.tiktoken"), P.path("word_bpe_49k.json")
ODD = [None, "", " ", "\n\n \t", "a" * 20000, "the " * 30000, "It's  don't\twe'll 1,000.5", "ß ẞ Ÿ ÀÉ Σ ΑΣ", "<|endoftext|> <|startoftext|>x", "á é́. ﬁ", "नमस्ते 你好", "x\x1cy\x1d\xa0z ", "!!! ?!, ...", "a\x00b", "İı µªº ½"]


def frame(spark, texts, extra=""):
    return spark.createDataFrame([(i, t, "en", "s", -1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_tokens int")


@pytest.fixture(scope="module")
def docs(spark, sf):
    real = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()]
    rows = ODD + real + real[:2]
    return rows, frame(spark, rows).repartition(3)


def library():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_byte_bpe_is_the_librarys(docs):
    rows, df = docs
    sha = lambda b: hashlib.sha256(b).hexdigest()
    own = library()
    want = []
    for i, t in enumerate(rows):
        ids = own.encode_ordinary(t or "")
        want.append((i, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())))
    for block in (1, 50_000, bpe.BLOCK_BYTES):
        assert sorted(map(tuple, bpe.round_trip(df, RANKS, P.PATTERN, block).collect())) == want


def test_decode_inverts_encode(docs):
    rows, df = docs
    encoded = bpe.encode(df, RANKS, P.PATTERN, 100_000)
    got = {r.doc_id: bytes(r.decoded) for r in bpe.decode(encoded, RANKS).collect()}
    assert got == {i: (t or "").encode() for i, t in enumerate(rows)}


def test_byte_bpe_repeats_nulls_and_empty(spark):
    df = spark.createDataFrame([(None, "a b"), (3, "a b"), (3, "a b")], "doc_id long, text string")
    got = bpe.round_trip(df, RANKS, P.PATTERN).collect()
    assert len(got) == 3 and len({r.ids_sha256 for r in got}) == 1 and sorted(str(r.doc_id) for r in got) == ["3", "3", "None"]
    assert bpe.round_trip(df.limit(0), RANKS, P.PATTERN).count() == 0


def test_each_word_is_encoded_once():
    words = [(b"%d" % i) * 900 for i in range(20_000)]  # 80 MB in all
    cells = [{"block": k, "words": blocks.pack_strings(words[k * 1000 : (k + 4) * 1000] + words[:50])} for k in range(20)]
    times = collections.Counter()

    def encode_one(text):
        times[text] += 1
        return [len(text), int(text[:3])]

    for row, (block, bucket, cell, docs) in zip(cells, bpe.answered(5, iter(cells), encode_one), strict=True):
        lengths, ids = map(blocks.unpack_numbers, blocks.unpack_parts(cell))
        own = blocks.unpack_strings(row["words"])
        assert (block, bucket, docs) == (row["block"], 5, None) and set(lengths) == {2} and ids.reshape(-1, 2).tolist() == [[len(w), int(w[:3])] for w in own]
    assert len(times) == 20_000 and set(times.values()) == {1}


def test_vocabularies_of_one_size_are_kept_apart(spark, tmp_path):
    ranks = bpe.read_ranks(RANKS)
    a, b = sorted(ranks, key=ranks.get)[300:302]
    other = {**ranks, a: ranks[b], b: ranks[a]}
    path = tmp_path / "other.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for t, r in other.items()))
    df = spark.createDataFrame([(1, (a + b" " + b).decode("utf-8", "ignore") + " the end")], "doc_id long, text string").repartition(1)
    first = bpe.round_trip(df, RANKS, P.PATTERN).first()
    second = bpe.round_trip(df, str(path), P.PATTERN).first()
    assert first.decoded_sha256 == second.decoded_sha256 and first.ids_sha256 != second.ids_sha256


def test_word_memory_is_bounded_by_bytes(monkeypatch):
    with open(WORDS, encoding="utf-8") as f:
        encoder = packing.WordEncoder(f.read())
    text = [w for i in range(400) for w in (b"the", b"z" * 300 + b"%d" % i, b"word%d." % (i % 7), "é".encode() * (i % 90))]
    want = encoder.encode(text)
    monkeypatch.setattr(packing, "REMEMBERED_BYTES", 20_000)
    small = packing.WordEncoder.__new__(packing.WordEncoder)
    small.__dict__.update(encoder.__dict__, older={})
    small._renew()
    assert b"".join(small.encode(text[i : i + 37]) for i in range(0, len(text), 37)) == want and small.encode(text) == want
    assert sum(len(k) + len(v) for k, v in {**small.known, **small.older}.items()) < 60_000


@settings(max_examples=60, deadline=None)
@given(st.text())
def test_word_encoder_is_the_librarys(text):
    from tokenizers import Tokenizer

    if not hasattr(test_word_encoder_is_the_librarys, "pair"):
        with open(WORDS, encoding="utf-8") as f:
            definition = f.read()
        test_word_encoder_is_the_librarys.pair = packing.WordEncoder(definition), Tokenizer.from_str(definition)
    own, whole = test_word_encoder_is_the_librarys.pair
    text = text.encode("utf-8", "ignore").decode()
    assert np.frombuffer(own.encode(text.encode().split()), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def check_pieces(rows, got):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(WORDS)
    ids = {i: [*whole.encode(t or "", add_special_tokens=False).ids, 2] for i, t in rows}
    pieces, seqs = {}, {}
    for r in got:
        own = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert r.length > 0 and zlib.crc32(own.tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, own in ids.items():
        at = 0
        for start, n in sorted(pieces[i]):
            assert start == at
            at += n
        assert at == len(own)
    lengths = []
    for parts in seqs.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        lengths.append(at)
    assert all(n == 4096 or n < 4096 and n & (n - 1) == 0 for n in lengths)
    return lengths


def test_pack(docs):
    rows, df = docs
    for group in (5_000, packing.GROUP_TOKENS):
        check_pieces(list(enumerate(rows)), packing.pack(df, WORDS, group_tokens=group).collect())


def test_pack_edges(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], "doc_id long, text string").coalesce(1)
    got = packing.pack(df, WORDS).collect()
    assert sorted(r.doc_tokens for r in got) == [1, 2, 2] and len({r.sequence_id for r in got}) <= 2
    assert packing.pack(df.limit(0), WORDS).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 9000), max_size=80))
def test_sequences(lengths):
    lengths = np.array(lengths, np.int64)
    covered = [np.zeros(n, int) for n in lengths]
    sizes = []
    for pieces in packing.sequences(lengths):
        sizes.append(sum(n for _, _, n in pieces))
        for d, at, n in pieces:
            covered[d][at : at + n] += 1
    assert all((c == 1).all() for c in covered)
    short = [n for n in sizes if n != 4096]
    assert len(set(short)) == len(short) and all(n & (n - 1) == 0 for n in short)


def test_difference_is_near_equal():
    rng = random.Random(1)
    sizes = np.array([rng.randint(1, 3000) for _ in range(500)])
    found = packing.difference(sizes, 150)
    assert sorted(i for w in found for i in w) == list(range(500))
    sums = [sizes[w].sum() for w in found]
    assert max(sums) - min(sums) < 0.15 * np.mean(sums)
    wins = packing.windows(sizes)
    assert all(sizes[w].sum() <= 4096 for w in wins)
    assert [len(w) for w in packing.difference(np.array([5]), 3)] == [1, 0, 0]
