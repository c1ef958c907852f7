"""Secret scans with corpus-wide ownership frequency.

``find`` scans whole texts for the base kinds (assign, access, hex) and for further candidates: keys
with a provider's prefix, private-key headers and mixed tokens of high entropy.  ``ownership`` counts,
for each candidate's hash, the distinct repositories and owners that hold it.  A value held by at most
OWNERS owners in at most REPOSITORIES repositories is taken for a live credential; one held by more of
either is a widely copied example.  Base spans are always reported, with both counts; further
candidates only where they look live.

Skew: (hash, owner) and (hash, repository) are made distinct before counting, so a copied example
costs a row for each task and owner.  Candidates are joined with the counts by hash; only hashes that a
Misra-Gries pass finds frequent are salted.

A further candidate counts only where it overlaps no base span and no further span of an earlier kind;
the test is a binary search among disjoint ranges, so a text costs as much as its sorting.

A null text counts as empty; null repositories and owners count as one.  Repeated rows report each.
Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, salted_join, written

#: Kinds in the order that breaks ties between spans of one start; the first three are the base kinds.
KINDS = ["assign", "access", "hex", "provider", "pem", "token"]
BASE = KINDS[:3]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
LEAST_VALUE = 6
# A run shorter than the least length can hold no match of that length, so the length stands in the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
PROVIDER = re.compile(r"(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+)")
PEM = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----")
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{24,}")
LEAST_ENTROPY = 3.5  # bits a character
OWNERS = 2
REPOSITORIES = 3  # an owner's own key may stand in a few of its repositories
_HINTS = ("password", "passwd", "secret", "token", "api_key", "apikey")
_PROVIDERS = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "xox", "sk_live_", "AIza", "eyJ")
_FOUND = "array<struct<kind:int,start:int,end:int,hash:long>>"
_SPANS = "array<struct<start:int,kind:int,end:int,live:boolean,n_repositories:bigint,n_owners:bigint>>"


def _mixed(value: str) -> bool:
    if not (any(c.isdigit() for c in value) and any(c.islower() for c in value) and any(c.isupper() for c in value)):
        return False
    n = len(value)
    return -sum(k / n * math.log2(k / n) for k in Counter(value).values()) >= LEAST_ENTROPY


def _ranges(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the disjoint ranges that the spans cover together."""
    starts, ends = [], []
    for start, end in sorted(spans):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def find(text: str) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, value) in code points, end exclusive, by start and then kind."""
    found = []
    low = text.lower()
    if any(h in low for h in _HINTS):
        found += [(0, m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [(1, m.start(), m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [(2, m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    taken = _ranges([(s, e) for _, s, e, _ in found])
    for kind, pattern, here in ((3, PROVIDER, any(p in text for p in _PROVIDERS)), (4, PEM, "PRIVATE KEY" in text), (5, TOKEN, True)):
        if not here:
            continue
        starts, ends = taken
        new = []
        for m in pattern.finditer(text):
            if kind == 5 and not _mixed(m[0]):
                continue
            # Ranges are disjoint: only the last that begins before the match ends can reach into it.
            at = bisect_left(starts, m.end()) - 1
            if at < 0 or ends[at] <= m.start():
                new.append((kind, m.start(), m.end(), m[0]))
        if new:
            found += new
            taken = _ranges([*zip(starts, ends, strict=True), *((s, e) for _, s, e, _ in new)])
    return sorted(found, key=lambda x: (x[1], x[0]))


def _hash(value: str) -> int:
    return int.from_bytes(hashlib.blake2b(value.encode(), digest_size=8).digest(), "big", signed=True)


def candidates(docs: DataFrame, repository: Column, owner: Column, keep: list[str]) -> DataFrame:
    """_row, repository, owner, the spans found and the columns ``keep`` as _own_...; written."""
    bounded_batches(docs.sparkSession)
    slim = docs.select(*(F.col(c).alias(f"_own_{c}") for c in keep), repository.alias("repository"), owner.alias("owner"), F.col("text").alias("_text"))
    own = slim.columns[:-1]
    schema = slim.select(*own).withColumn("found", F.lit(None).cast(_FOUND)).schema
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("hash", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [[{"kind": k, "start": s, "end": e, "hash": _hash(v)} for k, s, e, v in find(t or "")] for t in b.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in own] + [pa.array(found, kind)], names=[*own, "found"])

    return written(slim.mapInArrow(run, schema).withColumn("_row", F.monotonically_increasing_id()), "secret-candidates")


def ownership(found: DataFrame) -> DataFrame:
    """hash, n_repositories, n_owners; a hash's rows are made distinct before they are counted."""
    each = found.select(F.explode("found.hash").alias("hash"), "repository", "owner").distinct()
    return each.groupBy("hash").agg(F.countDistinct("repository").alias("n_repositories"), F.countDistinct("owner").alias("n_owners"))


def classified(found: DataFrame, owners: int = OWNERS, repositories: int = REPOSITORIES) -> DataFrame:
    """_row, spans (kind, start, end, live, n_repositories, n_owners) of the rows with any, in order."""
    counts = written(ownership(found), "secret-owners")
    each = found.select("_row", F.explode("found").alias("s")).select("_row", "s.*")
    live = (F.col("n_owners") <= owners) & (F.col("n_repositories") <= repositories)
    each = salted_join(each, counts, ["hash"], ["_row", "start"]).filter((F.col("kind") < len(BASE)) | live)
    return each.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end", live.alias("live"), "n_repositories", "n_owners"))).alias("spans"))


def _name(kind: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, KINDS)), kind + 1)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", _name(s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, repository: Column | None = None, owner: Column | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example, repositories, owners; one row per document.

    repositories and owners: how many hold each span's value, in the order of the spans.
    """
    repository, owner = _parties(repository, owner)
    found = candidates(docs, repository, owner, ["doc_id"])
    all_spans = F.coalesce("spans", F.expr(f"cast(array() as {_SPANS})"))
    rows = found.select("_row", "_own_doc_id").join(classified(found), "_row", "left").select(F.col("_own_doc_id").alias("doc_id"), all_spans.alias("spans"))
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    count = lambda test: F.size(F.filter("spans", test)).cast("long")
    of_kind = lambda k: count(lambda s: s["kind"] == k)
    return rows.select(
        "doc_id",
        *(of_kind(k).alias(f"n_{name}") for k, name in enumerate(BASE)),
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
        count(lambda s: s["live"]).alias("n_live"),
        count(lambda s: ~s["live"]).alias("n_example"),
        *(F.array_join(F.transform("spans", lambda s: s[f"n_{c}"].cast("string")), ",").alias(c) for c in ("repositories", "owners")),
    )


def _parties(repository: Column | None, owner: Column | None) -> tuple[Column, Column]:
    """By default a source is an owner, and a language of a source a repository."""
    return F.xxhash64("source", "lang") if repository is None else repository, F.xxhash64("source") if owner is None else owner


def replaced(text: str, spans: list[dict]) -> str:
    """``text`` with spans cut out; spans that overlap are cut out as one, live if any of them is."""
    merged: list[list] = []
    for s in spans:
        if merged and s["start"] < merged[-1][1]:
            merged[-1][1:] = max(merged[-1][1], s["end"]), merged[-1][2] or s["live"]
        else:
            merged.append([s["start"], s["end"], s["live"]])
    out, at = [], 0
    for start, end, live in merged:
        out += [text[at:start], "<SECRET>" if live else "<EXAMPLE>"]
        at = end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, repository: Column | None = None, owner: Column | None = None) -> DataFrame:
    """``docs`` with reported spans replaced by <SECRET> or <EXAMPLE> and n_chars to match; no row goes."""
    repository, owner = _parties(repository, owner)
    columns = docs.columns
    found = candidates(docs, repository, owner, columns)
    own = [f"_own_{c}" for c in columns]
    clean = found.filter(F.size("found") == 0).select(*own)
    hit = found.filter(F.size("found") > 0).join(classified(found), "_row", "left").select(*own, "spans")
    schema = clean.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [replaced(t, s) if s else t for t, s in zip(b.column("_own_text").to_pylist(), b.column("spans").to_pylist(), strict=True)]
            new = {"_own_text": pa.array(texts, b.column("_own_text").type)}
            if "_own_n_chars" in own:
                new["_own_n_chars"] = pa.array([None if t is None else len(t) for t in texts], b.column("_own_n_chars").type)
            yield pa.RecordBatch.from_arrays([new.get(c, b.column(c)) for c in own], names=own)

    return clean.union(hit.mapInArrow(run, schema)).select(*(F.col(f"_own_{c}").alias(c) for c in columns))
