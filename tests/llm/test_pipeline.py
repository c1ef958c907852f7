"""run() against the stages written plainly in Python."""

import collections

import corpus_pipeline
import public_tokenizers as P
from tests.llm.test_dedup_and_sharding import brute_fp, lower, sets_of
from tests.llm.test_packing_and_encoding import check_pieces
from tests.llm.test_quality_and_secrets import TOKEN, good

from tallyforge.llm import quality, secret_scan

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def brute(spark, rows):
    """(doc_id, text) of the documents that are packed."""
    verdict = quality.quality(spark.createDataFrame(rows, COLUMNS)).collect()
    good_ids = collections.Counter(r.doc_id for r in verdict if r.kept)
    kept = [r for r in rows if good_ids[r[0]] > 0]
    best = {}
    for r in kept:
        key = lower(r[1])
        if key not in best or r[0] > best[key][0]:
            best[key] = r
    kept = sorted(best.values())
    roots = sets_of([brute_fp(r[1]) for r in kept])
    first = {}
    for r, root in zip(kept, roots):
        first.setdefault(root, r)
    kept = list(first.values())
    owners = collections.defaultdict(set)
    found = {r[0]: secret_scan.find(r[1]) for r in kept}
    for r in kept:
        for _, _, _, v in found[r[0]]:
            owners[v].add(r[3])
    out = []
    for r in kept:
        spans = [{"start": s, "end": e, "live": len(owners[v]) <= secret_scan.OWNERS} for k, s, e, v in found[r[0]] if k < 3 or len(owners[v]) <= secret_scan.OWNERS]
        out.append((r[0], secret_scan.replaced(r[1], spans)))
    return out


def test_run(spark, sf, tmp_path):
    real = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select(*[c.split()[0] for c in COLUMNS.split(", ")]).collect()]
    extra = [(9000, good(1) + f" {TOKEN}", "en", "src1"), (9001, good(1).upper(), "en", "src2"), (9002, good(1), "en", "src2"), (9003, None, None, None), (9004, "", "en", "src1"), (9005, good(3) + " password=hunter22", None, "src1")]
    rows = real + [(*r, len(r[1] or "")) for r in extra]
    spark.createDataFrame(rows, COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    want = brute(spark, rows)
    assert {r.doc_id for r in got} == {i for i, _ in want} and 0 < len(want) < len(rows)
    assert any("<SECRET>" in t for _, t in want)
    check_pieces(want, got)


def test_stages_keep_columns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and out.count() <= docs.count(), name
        assert stage(spark, docs.limit(0), sf).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), sf).count() == 0
    assert P.path("word_bpe_49k.json")


def test_clashing_columns_and_long_texts(spark, tmp_path):
    more = ["fp", "_row", "sha", "_sha", "found", "kept", "spans", "level", "fence_level", "n_words", "repository", "owner", "hash", "_key", "_salt", "_text", "_own_text", "seq"]
    long = " ".join(f"wo{i * 7919 % 100_003 if i % 2 else i * 104_729 % 99_991}" for i in range(500_000))  # 4 MB, hardly a window twice
    rows = [(i, good(i), "en", "s", 0) for i in range(30)] + [(50, long, "en", "s", 0), (51, long.upper(), "en", "t", 0), (52, long + f" {TOKEN}", "en", "t", 0), (53, long[2_000_000:], "de", "t", 0), (54, None, None, None, None), (7, good(7), "en", "s", 0)]
    plain = spark.createDataFrame(rows, COLUMNS)
    wide = plain.selectExpr("*", *(f"{i} AS {c}" for i, c in enumerate(more)))
    results = []
    for name, docs in (("plain", plain), ("wide", wide)):
        docs.repartition(3).write.parquet(str(tmp_path / name / "documents.parquet"))
        got = corpus_pipeline.run(spark, str(tmp_path / name)).collect()
        results.append(sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in got if r.doc_id != 7))
    # Where documents are cut depends on their neighbours; which are kept, and how long they are, does not.
    whole = [{i: sum(n for j, _, n, _ in r if j == i) for i, *_ in r} for r in results]
    assert whole[0] == whole[1] and {51, 53} <= set(whole[0]) and not {50, 54} & set(whole[0])
    stages = wide
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stages = stage(spark, stages, str(tmp_path))
        assert stages.columns == wide.columns, name
    assert [stages.select(c).distinct().collect() for c in more] == [[(i,)] for i in range(len(more))]


def test_stages_leave_no_tables_behind(spark, sf):
    from tallyforge import scratch

    before = set(scratch.held())
    corpus_pipeline.run(spark, sf).count()
    assert len(set(scratch.held()) - before) == 1  # the last stage's documents
