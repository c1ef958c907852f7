"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained here in numpy.

A word's input joins its word vector and the sum of the vectors of its character n-grams, so unseen
forms of a known stem are recognised.  The network reads windows of WINDOW words that overlap by half;
a document's score is that of its most toxic window, calibrated.

Labels hold for documents, not windows.  Nothing but the labels guides the fitting: the network learns from
any window of a document for WARM epochs, then repeatedly picks each document's strongest window and learns
from that one and, for clean documents, from random others too.  Words and n-grams that hardly any document
uses stay zero, the weights are the mean of the last epochs, and scores are calibrated on documents of the
sample that were not learned from.

Bounds: fitting uses at most FIT_ROWS documents of each label, of at most FIT_BYTES bytes each, in the
order of a hash of doc_id; rows whose crc32(doc_id as text) mod 4 is HELD_OUT are never used.  Scoring
reads every window of every whole text, in parallel and without a shuffle; the model, whose size is
fixed, goes to the workers.

A text without words gets the mean logit of the clean documents fitted to.  Without labels of both kinds the score is the
share of toxic labels.  Rows that repeat a doc_id are scored each; empty tables give empty results.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import ragged
from .common import bounded_batches

WINDOW, STRIDE = 32, 16
WORD_ROWS, GRAM_ROWS = 1 << 15, 1 << 16
WORD_DIM, GRAM_DIM, HIDDEN, ATTENTION = 6, 10, 8, 8
GRAMS = (3, 4, 5)
HELD_OUT = 2
FIT_ROWS, FIT_BYTES = 1200, 20_000
EPOCHS, BATCH, RATE = 12, 96, 0.02
#: Epochs that learn from any window of a document, before they learn from its strongest.
WARM = 3
#: Small samples go through more epochs, so that there are so many steps at least.
LEAST_STEPS = 300
#: Bounds of the number of documents that must use a row of a table.
LEAST_DOCUMENTS = 5, 20
#: Documents whose n-grams are counted at a time.
COUNTED = 200
#: One document in so many is kept for calibration, of labels with at least so many documents.
CALIBRATED, LEAST_APART = 5, 50
PREDICTED = 0.3
#: Texts are scored so many bytes at a time.
SCORED_BYTES = 4 << 20
_DROPPED = b".,;:!?\"()[]{}"


class Words:
    """The distinct words of some texts: row in the word table and rows in the n-gram table."""

    def __init__(self, words: list[bytes]):
        self.row = np.fromiter((zlib.crc32(w) % WORD_ROWS for w in words), np.int64, len(words))
        text = "<" + "><".join(w.decode("utf-8", "replace") for w in words) + ">" if words else ""
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
        sizes = np.fromiter((len(w.decode("utf-8", "replace")) + 2 for w in words), np.int64, len(words))
        begin = np.cumsum(sizes) - sizes
        rows, owner = [], []
        for n in GRAMS:
            count = np.maximum(sizes - n + 1, 0)
            at = ragged(begin, count)
            h = np.zeros(len(at), np.uint64)
            for j in range(n):
                h = (h ^ codes[at + j]) * np.uint64(0x100000001B3) + np.uint64(n)
            rows.append(((h ^ (h >> np.uint64(29))) % np.uint64(GRAM_ROWS)).astype(np.int64))
            owner.append(np.repeat(np.arange(len(words)), count))
        owner, rows = np.concatenate(owner), np.concatenate(rows)
        order = np.argsort(owner, kind="stable")
        self.gram, self.gram_of = rows[order], owner[order]
        self.grams = np.bincount(owner, minlength=len(words))
        self.first = np.cumsum(self.grams) - self.grams

    def summed(self, table: np.ndarray, many: int = 50_000) -> np.ndarray:
        out = np.zeros((len(self.row), table.shape[1]), table.dtype)
        for begin in range(0, len(self.row), many):  # some words at a time bound the memory
            some = begin + np.flatnonzero(self.grams[begin : begin + many])
            if len(some):
                grams = self.gram[self.first[some[0]] : self.first[some[-1]] + self.grams[some[-1]]]
                total = np.add.reduceat(table[grams], self.first[some] - self.first[some[0]], axis=0)
                out[some] = total / np.sqrt(self.grams[some], dtype=table.dtype)[:, None]
        return out


def split_long(text: bytes) -> list[bytes]:
    """A very long text in parts that have the same windows together as the whole."""
    if len(text) <= SCORED_BYTES:
        return [text]
    words = clean(text)
    step = SCORED_BYTES // 8 // STRIDE * STRIDE
    return [b" ".join(words[i : i + step + WINDOW - STRIDE]) for i in range(0, max(1, len(words) - (WINDOW - STRIDE)), step)]


def clean(text: bytes) -> list[bytes]:
    """Lower-case words without punctuation."""
    return text.lower().translate(None, _DROPPED).split()


def read(texts: list[bytes]) -> tuple[Words, np.ndarray, np.ndarray]:
    """Distinct words, windows of their numbers (-1: none) and each window's text."""
    numbers: dict[bytes, int] = {}
    number, parts, sizes = numbers.setdefault, [], []
    for text in texts:
        own = np.array([number(w, len(numbers)) for w in clean(text)], np.int64)
        parts.append(own)
        sizes.append(len(own))
    sizes = np.array(sizes, np.int64)
    windows = np.maximum(1, -(-(sizes - (WINDOW - STRIDE)) // STRIDE))
    of = np.repeat(np.arange(len(texts)), windows)
    step = ragged(np.zeros(len(texts), np.int64), windows) * STRIDE
    begin = (np.cumsum(sizes) - sizes)[of] + step
    flat = np.concatenate([*parts, np.full(WINDOW, -1)])
    inside = step[:, None] + np.arange(WINDOW)[None, :] < sizes[of][:, None]
    at = np.minimum(begin[:, None] + np.arange(WINDOW)[None, :], len(flat) - 1)
    return Words(list(numbers)), np.where(inside, flat[at], -1), of


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class Network:
    """Word and n-gram tables, a GRU each way, attention pooling and a logistic output."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        dim = WORD_DIM + GRAM_DIM
        init = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = {"word": init(WORD_ROWS, WORD_DIM), "gram": init(GRAM_ROWS, GRAM_DIM), "wo": init(2 * HIDDEN), "bo": np.zeros(1, np.float32)}
        for way in "fb":
            self.p |= {f"w{way}": init(dim, 3 * HIDDEN), f"u{way}": init(HIDDEN, 3 * HIDDEN), f"b{way}": np.zeros(3 * HIDDEN, np.float32)}
        self.p |= {"wa": init(2 * HIDDEN, ATTENTION), "ba": np.zeros(ATTENTION, np.float32), "va": init(ATTENTION)}
        self.scale, self.shift = 1.0, 0.0
        #: The logit of a text without words: the mean of the clean documents'.
        self.none = 0.0

    def inputs(self, words: Words) -> np.ndarray:
        """One row for each word and one of zeros for no word."""
        x = np.concatenate((self.p["word"][words.row], words.summed(self.p["gram"])), axis=1)
        return np.concatenate((x, np.zeros((1, x.shape[1]), np.float32)))

    def _run(self, gates: np.ndarray, number: np.ndarray, way: str, keep: bool) -> tuple[np.ndarray, list]:
        """States after each step, in the window's order; number: steps x windows."""
        steps, n = number.shape
        u, h = self.p[f"u{way}"], np.zeros((n, HIDDEN), np.float32)
        states, kept = np.empty((steps, n, HIDDEN), np.float32), []
        for t in range(steps) if way == "f" else reversed(range(steps)):
            g, hu = gates[number[t]], h @ u
            zr = _sigmoid(g[:, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            c = np.tanh(g[:, 2 * HIDDEN :] + r * hu[:, 2 * HIDDEN :])
            real = (number[t] >= 0)[:, None]
            new = np.where(real, c + z * (h - c), h)
            if keep:
                kept.append((t, h, z, r, c, hu[:, 2 * HIDDEN :], real))
            h = states[t] = new
        return states, kept

    def gates(self, x: np.ndarray) -> list[np.ndarray]:
        """What the words' inputs add to the gates of either way."""
        return [x @ self.p[f"w{w}"] + self.p[f"b{w}"] for w in "fb"]

    def forward(self, gates: list[np.ndarray], windows: np.ndarray, keep: bool = False):
        """Logits of windows of words with these gates."""
        number = np.ascontiguousarray(windows.T)
        ways = [self._run(gate, number, w, keep) for gate, w in zip(gates, "fb", strict=True)]
        h = np.concatenate([s for s, _ in ways], axis=2)
        a = np.tanh(h @ self.p["wa"] + self.p["ba"])
        e = np.where(number >= 0, a @ self.p["va"], np.float32(-1e9))
        e = np.exp(e - e.max(axis=0)) * (number >= 0)
        alpha = e / np.maximum(e.sum(axis=0), 1e-9)
        pooled = (alpha[:, :, None] * h).sum(axis=0)
        logit = pooled @ self.p["wo"] + self.p["bo"][0]
        return (logit, (number, ways, h, a, alpha, pooled)) if keep else logit

    def gradients(self, words: Words, windows: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss."""
        x, p, n = self.inputs(words), self.p, len(label)
        logit, (number, ways, h, a, alpha, pooled) = self.forward(self.gates(x), windows, keep=True)
        d_logit = ((_sigmoid(logit) - label) / n).astype(np.float32)
        g = {"wo": pooled.T @ d_logit, "bo": d_logit.sum(keepdims=True)}
        d_pool = d_logit[:, None] * p["wo"]
        d_alpha = (h * d_pool).sum(axis=2)
        d_e = alpha * (d_alpha - (alpha * d_alpha).sum(axis=0))
        d_a = d_e[:, :, None] * p["va"] * (1 - a * a)
        g |= {"va": np.einsum("tnk,tn->k", a, d_e), "wa": np.einsum("tnh,tnk->hk", h, d_a), "ba": d_a.sum(axis=(0, 1))}
        d_h = alpha[:, :, None] * d_pool + d_a @ p["wa"].T
        d_x = np.zeros_like(x)
        for k, way in enumerate("fb"):
            u, w = p[f"u{way}"], p[f"w{way}"]
            g_u, d_gates = np.zeros_like(u), np.zeros((len(x), 3 * HIDDEN), np.float32)
            back = np.zeros((n, HIDDEN), np.float32)
            for t, before, z, r, c, hu, real in reversed(ways[k][1]):
                d = back + d_h[t, :, k * HIDDEN : (k + 1) * HIDDEN]
                own = d * real
                d_c = own * (1 - z) * (1 - c * c)
                d_pre = np.concatenate((own * (before - c) * z * (1 - z), d_c * hu * r * (1 - r), d_c), axis=1)
                d_hu = d_pre.copy()
                d_hu[:, 2 * HIDDEN :] *= r
                g_u += before.T @ d_hu
                np.add.at(d_gates, number[t], d_pre)
                back = d * ~real + own * z + d_hu @ u.T
            d_gates[-1] = 0  # no word
            g |= {f"u{way}": g_u, f"b{way}": d_gates.sum(axis=0), f"w{way}": x.T @ d_gates}
            d_x += d_gates @ w.T
        g["word"], g["gram"] = np.zeros_like(p["word"]), np.zeros_like(p["gram"])
        np.add.at(g["word"], words.row, d_x[:-1, :WORD_DIM])
        each = d_x[:-1, WORD_DIM:] / np.sqrt(np.maximum(words.grams, 1), dtype=np.float32)[:, None]
        np.add.at(g["gram"], words.gram, each[words.gram_of])
        return g

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Of each text the strongest window's calibrated probability."""
        parts = [(k, part) for k, text in enumerate(texts) for part in split_long(text)]
        words, windows, of = read([part for _, part in parts])
        strongest = np.full(len(texts), -np.inf)
        found = np.where((windows >= 0).any(axis=1), self.logits(words, windows), self.none)
        np.maximum.at(strongest, [k for k, _ in parts], _strongest(found, of, len(parts))[0])
        return _sigmoid(self.scale * strongest + self.shift)

    def logits(self, words: Words, windows: np.ndarray, many: int = 4096) -> np.ndarray:
        gates = self.gates(self.inputs(words))
        return np.concatenate([self.forward(gates, windows[i : i + many]) for i in range(0, len(windows), many)] or [np.zeros(0, np.float32)])


def _strongest(values: np.ndarray, of: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's largest value and the window that has it; windows stand in the order of their texts."""
    order = np.lexsort((values, of))
    last = np.searchsorted(of[order], np.arange(texts), side="right") - 1
    return values[order[last]], order[last]


def _frequent(words: Words, windows: np.ndarray, of: np.ndarray, size: int, grams: bool) -> np.ndarray:
    """Whether each row of a table is used by one document in a hundred, within LEAST_DOCUMENTS."""
    at, slot = np.nonzero(windows >= 0)
    pair = np.unique(of[at] * len(words.row) + windows[at, slot])
    doc, number = np.divmod(pair, max(1, len(words.row)))
    held = np.zeros(size, np.int64)
    for begin in range(0, int(of[-1]) + 1 if len(of) else 0, COUNTED):  # some documents at a time bound the memory
        own = slice(*np.searchsorted(doc, (begin, begin + COUNTED)))
        if grams:
            rows, docs = words.gram[ragged(words.first[number[own]], words.grams[number[own]])], np.repeat(doc[own], words.grams[number[own]])
        else:
            rows, docs = words.row[number[own]], doc[own]
        held += np.bincount(np.unique(docs * size + rows) % size, minlength=size)
    return held >= np.clip((int(of[-1]) + 1) // 100 if len(of) else 0, *LEAST_DOCUMENTS)


def _part(words: Words, numbers: np.ndarray) -> Words:
    """The words of these numbers alone."""
    out = Words.__new__(Words)
    out.row, out.grams = words.row[numbers], words.grams[numbers]
    out.gram, out.gram_of = words.gram[ragged(words.first[numbers], out.grams)], np.repeat(np.arange(len(numbers)), out.grams)
    out.first = np.cumsum(out.grams) - out.grams
    return out


def fit(texts: list[bytes], label: np.ndarray, odds: float | None = None, seed: int = 7) -> Network:
    """A network fitted to documents and their labels (0, 1); both must occur.

    ``odds``: of label 1 where the scores are to hold, if the documents were picked by label.
    """
    label = label.astype(np.float32)
    rng, net = np.random.default_rng(seed), Network(seed)
    words, windows, of = read(texts)
    # One document in CALIBRATED of either label is kept for the scale of the scores, if there are enough.
    apart = np.zeros(len(texts), bool)
    for kind in (0, 1):
        own = rng.permutation(np.flatnonzero(label == kind))
        apart[own[: len(own) // CALIBRATED if len(own) >= LEAST_APART else 0]] = True
    learned = np.flatnonzero(~apart)
    toxic, clean = learned[label[learned] > 0], np.flatnonzero((label[of] == 0) & ~apart[of])
    first, last = np.searchsorted(of, np.arange(len(texts))), np.searchsorted(of, np.arange(len(texts)), side="right")

    # What few documents show would be learned by heart: its rows of the tables stay zero.
    used = {"word": _frequent(words, windows, of, WORD_ROWS, False)[:, None], "gram": _frequent(words, windows, of, GRAM_ROWS, True)[:, None]}
    for k, rows in used.items():
        net.p[k] *= rows

    state = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    mean, averaged, step = None, 0, 0
    size = 2 * (2 * len(learned) - len(toxic))
    epochs = max(EPOCHS, -(-LEAST_STEPS * BATCH // size))
    for epoch in range(epochs):
        if epoch * EPOCHS < WARM * epochs:  # any window, until the network can tell which one counts
            picked = rng.integers(first, last)
        elif epoch * EPOCHS // epochs != (epoch - 1) * EPOCHS // epochs:
            picked = _strongest(net.logits(words, windows), of, len(texts))[1]
        more = rng.choice(clean, min(len(clean), len(learned)), replace=False)
        # As many toxic windows as clean ones.
        short = len(more) + len(learned) - 2 * len(toxic)
        again = rng.choice(toxic, short) if short > 0 else toxic[:0]
        train = rng.permutation(np.concatenate((picked[learned], more, picked[again])))
        for i in range(0, len(train), BATCH):
            part = train[i : i + BATCH]
            own, back = np.unique(windows[part], return_inverse=True)
            none = int(len(own) and own[0] == -1)
            g = net.gradients(_part(words, own[none:]), back.reshape(len(part), -1) - none, label[of[part]])
            step += 1
            rate = RATE * min(1, step / 20) * (1 - 0.9 * epoch / epochs)
            for k, v in g.items():
                if k in used:
                    v *= used[k]
                m, s = state[k]
                m += 0.1 * (v - m)
                s += 0.01 * (v * v - s)
                net.p[k] -= (rate * m / (1 - 0.9**step) / (np.sqrt(s / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
        if epoch >= epochs - max(1, epochs // 3):  # the mean of the last epochs varies less
            averaged += 1
            mean = {k: v.copy() for k, v in net.p.items()} if mean is None else {k: mean[k] + (v - mean[k]) / averaged for k, v in net.p.items()}
    net.p = {k: v.astype(np.float32) for k, v in mean.items()}
    strongest = _strongest(net.logits(words, windows), of, len(texts))[0].astype(np.float64)
    net.none = float(strongest[label == 0].mean())
    told = apart if apart.any() else ~apart
    net.scale, net.shift = _calibrated(strongest[told], label[told].astype(np.float64))
    if odds is not None:
        net.shift += float(np.log(odds * (len(label) - label.sum()) / label.sum()))
    return net


def _calibrated(value: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Scale and shift of the logistic curve through (value, label), by Newton's method on smoothed labels."""
    toxic = label.sum()
    target = np.where(label > 0, (toxic + 1) / (toxic + 2), 1 / (len(label) - toxic + 2))
    x, w = np.stack((value, np.ones_like(value)), axis=1), np.array([1.0, 0.0])
    for _ in range(50):
        q = _sigmoid(x @ w)
        hessian = (x * (q * (1 - q))[:, None]).T @ x + 1e-3 * np.eye(2)
        move = np.linalg.solve(hessian, x.T @ (q - target) + 1e-3 * (w - [1.0, 0.0]))
        w -= np.clip(move, -1, 1)
    return float(max(w[0], 0.05)), float(w[1])


def remainder(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4, F.lit(0))


def fitted(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, most_bytes: int = FIT_BYTES) -> Network | float:
    """A network, or the share of toxic labels where one kind is missing."""
    known = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").alias("_toxic")).filter((remainder("_id") != HELD_OUT) & F.col("_toxic").isin(0, 1) & F.col("_id").isNotNull())
    order = F.xxhash64("_id")
    # At most 2 * rows rows.
    chosen = known.filter("_toxic = 1").orderBy(order).limit(rows).union(known.filter("_toxic = 0").orderBy(order).limit(rows))
    sample = (
        docs.select(F.col("doc_id").alias("_id"), F.col("text").cast("binary").alias("_text"))
        .filter(F.coalesce(F.octet_length("_text"), F.lit(0)) <= most_bytes)
        .join(F.broadcast(chosen.groupBy("_id").agg(F.max("_toxic").alias("_toxic"))), "_id")
        .groupBy("_id", "_toxic").agg(F.min("_text").alias("_text"))  # of rows that repeat a doc_id the least text
        .collect()
    )
    sample.sort(key=lambda r: r["_id"])
    label = np.array([r["_toxic"] for r in sample], np.int64)
    if not 0 < label.sum() < len(label):
        return float(label.mean()) if len(label) else 0.0
    seen = {r["_toxic"]: r["count"] for r in known.groupBy("_toxic").count().collect()}
    return fit([bytes(r["_text"] or b"") for r in sample], label, seen[1] / seen[0])


def score(docs: DataFrame, model: Network | float) -> DataFrame:
    """doc_id, held_out, score, predicted; one row per document."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for b in batches:
            texts = [t or b"" for t in b.column("text").to_pylist()]
            scores, at = [], 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) <= SCORED_BYTES):
                    size += len(texts[end])
                    end += 1
                scores.append(np.full(end - at, net) if isinstance(net, float) else net.score(texts[at:end]).astype(np.float64))
                at = end
            found = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(found), pa.array((found >= PREDICTED).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (remainder() == HELD_OUT).alias("held_out"), F.col("text").cast("binary").alias("text"))
    return slim.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fitted(docs, labels))
