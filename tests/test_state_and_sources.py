import json
import struct
import zlib

import numpy as np
from pyspark.sql import functions as F

from tallyforge import schema as S
from tallyforge import telemetry
from tallyforge.config import Config, Telemetry, load
from tallyforge.operators import stages, state, summary
from tallyforge.plans import report
from tallyforge.plans.run import Count
from tallyforge.sources import files, images, ocr, providers, scan
from tallyforge.streaming.watch import watch
from tests.conftest import COUNT

CFG = load(COUNT, {})


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_insert_is_idempotent(spark):
    table = spark.createDataFrame([("a", 1)], "k string, v int")
    new = spark.createDataFrame([("a", 2), ("b", 3), ("b", 3)], "k string, v int")
    after, added = state.insert_if_absent(table, new, "k")
    assert rows(added) == [("b", 3)] and rows(after) == [("a", 1), ("b", 3)]
    assert rows(state.insert_if_absent(after, new, "k")[0]) == rows(after)


def test_upsert_keeps_what_is_not_given(spark):
    table = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, v int, w string")
    delta = spark.createDataFrame([("a", None), ("c", 5)], "k string, v int")
    assert rows(state.upsert(table, delta, "k")) == [("a", None, "x"), ("b", 2, "y"), ("c", 5, None)]
    assert rows(state.update(table, delta, "k")) == [("a", None, "x"), ("b", 2, "y")]
    empty = table.limit(0)
    assert rows(state.upsert(empty, delta, "k")) == [("a", None, None), ("c", 5, None)]
    assert rows(state.update(table, delta.limit(0), "k")) == rows(table)


def test_chosen_attempts(spark):
    tries = spark.createDataFrame([("p", 1, True, False), ("p", 2, True, True), ("p", 3, True, True), ("q", 1, True, False), ("q", 2, True, False), ("q", 3, False, False), ("r", 1, False, False)], "layout string, attempt int, found boolean, valid boolean")
    assert rows(stages.chosen_attempts(tries)) == [("p", 2, True), ("q", 2, False)]


def test_modal_share_ties(spark):
    df = spark.createDataFrame([("g", "b"), ("g", "a"), ("g", "b"), ("g", "a"), ("h", "z")], "layout string, t string")
    assert rows(stages.modal_share(df, "layout", "t")) == [("g", 4, 2, "a"), ("h", 1, 1, "z")]


def test_reconcile_without_official(spark):
    none = files.official_totals(spark, None)
    assert summary.reconciled(summary.reconcile(spark.createDataFrame([("D", 4)], "party string, ours long"), none)).first()["ok"] is True


def test_official_file(spark, tmp_path):
    path = tmp_path / "o.json"
    path.write_text(json.dumps({"source": "s", "contests": {"D": {"writein_total": 100}, "R": {"writein_total": None}}}, indent=1))
    got = summary.reconcile(spark.createDataFrame([("D", 85)], "party string, ours long"), files.official_totals(spark, str(path)))
    assert {r["party"]: (r["ours"], r["official"], r["ok"]) for r in got.collect()} == {"D": (85, 100, True), "R": (0, None, None)}


def test_tsv(spark):
    tsv = "text\tleft\ttop\twidth\theight\tconf\nGovernor\t5\t9\t1\t1\t91.5\ngovernor\t6\t7\t1\t1\t91.5\nbad\tx\t1\t1\t1\t1\nshort\t1\n \t1\t1\t1\t1\t1\nvote\t8\t80\t1\t1\t40"
    words = ocr.parse_tsv(spark.createDataFrame([(1, tsv), (2, "")], "id int, tsv string"), "id")
    assert rows(words.select("text", "left", "top", "conf")) == [("Governor", 5, 9, 91.5), ("governor", 6, 7, 91.5), ("vote", 8, 80, 40.0)]
    head = ocr.header_word(words, "id").first()
    assert (head["text"], head["top"]) == ("governor", 7)
    assert ocr.next_contest_top(words, "id", F.lit(0), F.lit(10), F.lit(7)).first()["next_top"] == 80
    listed = ocr.words_of(words, "id").first()["words"]
    assert [w["text"] for w in listed] == ["Governor", "governor", "vote"]
    assert images.find_header([w.asDict() for w in listed], CFG)["top"] == 7


def test_providers(spark):
    crops = spark.createDataFrame([("a", b"1"), ("b", b"x")], "path string, content binary")

    def provider(content):
        return json.dumps({"text": "t", "oval": "Filled", "confidence": int(content)})

    got = {r["path"]: r for r in providers.read_with(crops, provider, 2).collect()}
    assert got["a"]["err"] is None and got["a"]["latency_ms"] >= 0 and got["b"]["err"].startswith("read: ")
    known = providers.read_from_table(crops, spark.createDataFrame([("a", "r")], "path string, reply string"))
    assert {r["path"]: r["err"] for r in known.collect()} == {"a": None, "b": "read: no reply"}
    body = json.loads(providers.HttpVision(CFG).request(b"img"))
    assert body["format"] == "json" and body["options"] == {"temperature": 0.0} and "Governor" in body["prompt"]
    assert providers.CommandOcr(("cat",))(b"text") == "text"


def png(pixels):
    """A gray PNG."""
    h, w = pixels.shape
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    raw = b"".join(b"\0" + row.tobytes() for row in pixels)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def test_images(spark, tmp_path):
    pixels = np.full((1200, 1000), 255, np.uint8)
    pixels[300, 110:320] = 0
    pixels[270:296, 200:260] = 0
    (tmp_path / "a.png").write_bytes(png(pixels))
    (tmp_path / "b.png").write_bytes(b"no image")
    loaded = images.load(spark, str(tmp_path))
    assert loaded.select("width", "height", "channels").collect() == [(1000, 1200, 1)]
    word = spark.createDataFrame([([("Governor", 50, 100, 9, 9, 90.0)],)], "words array<struct<text:string,left:int,top:int,width:int,height:int,conf:double>>")
    cfg = Config(locate=CFG.locate.__class__(col_w_frac=0.3))
    found = images.locate(loaded.crossJoin(word), lambda image, window: 305, lambda image, box: "Write-In", cfg).first()
    assert found["found"] and found["valid"] and round(found["y1"] * 1200) == 326
    scored = loaded.withColumns({c: F.lit(found[c]) for c in ("x0", "y0", "x1", "y1", "ox0", "oy0", "ox1", "oy1")})
    ink = images.score_ink(scored, cfg).first()
    assert ink["err"] is None and ink["line_ink_score"] > 0.1
    broken = images.score_ink(scored.withColumn("data", F.lit(b"x")), cfg).first()
    assert broken["err"].startswith("mark: ") and broken["line_ink_score"] is None
    assert images.gray(bytes([10, 20, 30]), 1, 1, 3)[0, 0] == (30 * 299 + 20 * 587 + 10 * 114) // 1000


def test_scan_and_watch(spark, tmp_path):
    root = tmp_path / "scans"
    for name in ("AB-1/AB-1+001.jpg", "AB-1/AB-1+002.JPG.part", "AB-1/odd.jpg", "AB-1/.AB-1+9.jpg", "CD-1/AB-1+5.jpg"):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(b"x")
    paths = scan.list_files(spark, str(root), CFG)
    assert [(r["box"], r["seq"], r["status"]) for r in scan.manifest(paths, CFG).collect()] == [("AB-1", "001", "pending")]
    assert scan.skipped(paths, CFG).first()["n"] == 1
    assert [r["box"] for r in scan.boxes_on_disk(paths).collect()] == ["AB-1"]
    table, log = str(tmp_path / "t"), str(tmp_path / "c")
    watch(spark, str(root), table, log, CFG, None).awaitTermination(120)
    (root / "AB-1/AB-1+003.jpeg").write_bytes(b"x")
    watch(spark, str(root), table, log, CFG, None).awaitTermination(120)
    watch(spark, str(root), table, str(tmp_path / "other"), CFG, None).awaitTermination(120)  # a lost log adds nothing twice
    assert sorted(r["seq"] for r in spark.read.parquet(table).collect()) == ["001", "003"]


def test_coverage_counts_box_folders(spark, tmp_path):
    for name in ("AB-1/AB-1+001.jpg", "AB-2/AB-2+001.jpg.part", "CD-1/AB-1+5.jpg"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    (tmp_path / "AB-3").mkdir()
    (tmp_path / "AB-4.txt").write_bytes(b"x")
    boxes = scan.list_boxes(spark, str(tmp_path), CFG)
    ingested = scan.manifest(scan.list_files(spark, str(tmp_path), CFG), CFG)
    assert rows(summary.missing(boxes, ingested, "box")) == [("AB-2",), ("AB-3",)]
    assert tuple(summary.coverage(boxes, ingested, "box").first()) == (3, 1, 2)
    assert scan.list_boxes(spark, str(tmp_path / "none"), CFG) is None


def test_run_end_to_end(spark, tmp_path):
    count = Count(spark, str(tmp_path / "state"), CFG)
    names = [f"/r/AB-{b}/AB-{b}+{i:03d}.jpg" for b in (1, 2) for i in range(12)]
    paths = spark.createDataFrame([(n,) for n in names], "path string")
    count.ingest(paths)
    count.ingest(paths)
    assert count.table("images").count() == 24
    pages = paths.select("path", F.lit("Official Primary Democratic").alias("header"), F.when(F.col("path").contains("AB-1/"), "1000-1").otherwise("2000-2").alias("style_text"), F.lit(100).alias("width"), F.lit(3000).alias("height"), F.when(F.col("path").endswith("+011.jpg"), "unreadable").alias("err"))
    count.classify(pages)
    tries = count.to_locate()
    assert tries.count() == 12
    box = {c: F.lit(0.1) for c in ("x0", "y0", "x1", "y1", "ox0", "oy0", "ox1", "oy1")}
    count.locate(tries.select("path", F.lit(True).alias("found"), F.col("layout").endswith("1000-1").alias("valid")).withColumns(box))
    dark = F.substring("path", -6, 2).cast("int") >= 5
    count.mark(paths.select("path", F.when(dark, 0.9).otherwise(0.0).alias("oval_fill_score"), F.lit(0.0).alias("line_ink_score"), F.lit(None).cast("string").alias("err")), "/crops")
    assert {r["status"]: r["n"] for r in summary.counts_by(count.table("images"), "status").collect()} == {"marked": 12, "skip_blank": 10, "error": 2}
    assert rows(count.table("review").select("reason").distinct()) == [("unvalidated_region",)]
    reply = F.when(F.col("path").contains("AB-1/"), '{"text": "Marker", "oval": "filled", "confidence": 0.9}').otherwise('{"text": "Vote for one", "oval": "empty", "confidence": 0.9}')
    count.read(paths.select("path", reply.alias("reply"), F.lit(None).cast("string").alias("err")))
    count.match(min_count=4)
    assert {r["match"]: r["quarantined"] for r in count.table("results").filter("match IS NOT NULL").collect()} == {"marker": 0, "not_marker": 1}
    assert rows(count.table("review").select("reason").distinct()) == [("mislocated_region",)]
    before = rows(count.table("results").drop("updated_at"))
    count.match(rescore=True, min_count=4)
    assert rows(count.table("results").drop("updated_at")) == before
    official = spark.createDataFrame([("Democratic", 6)], "party string, official long")
    assert count.check(official)
    found = report.collect(count, official, spark.createDataFrame([("AB-1",), ("AB-2",), ("AB-3",)], "box string"))
    assert found["summary"]["target_total"] == 6 and found["coverage"]["missing"] == 1 and [t["name"] for t in found["tally"]] == ["marker"]
    page = report.render(found, "Count <1>")
    assert "Count &lt;1&gt;" in page and "Marker" in page and json.loads(report.manifest(found))["summary"]["images_total"] == 24
    files.write_tables(count.table("results"), count.table("review"), str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out/results.csv")).count() == count.table("results").count()


def test_manifest_has_the_whole_tally(spark, tmp_path):
    # 45 names with 60 to 16 votes, and the target below them all with 12.
    votes = {f"name {i:02d}": 60 - i for i in range(45)} | {"marker": 12}
    reads = [(f"/r/{n}/{i}", n, "Democratic" if i % 2 else "Republican") for n, k in votes.items() for i in range(k)]
    given = spark.createDataFrame(reads, "path string, candidate string, party string")
    count = Count(spark, str(tmp_path / "state"), CFG)
    count.save(
        images=given.select("path", F.lit("AB-1").alias("box"), F.lit("1").alias("seq"), F.lit("done").alias("status"), "party"),
        results=given.select("path", "candidate", F.col("candidate").alias("match"), F.lit("/gone.png").alias("crop_path"), F.lit(0.5).alias("vision_conf")),
    )
    found = report.collect(count, files.official_totals(spark, None))
    report.write_manifest(found, str(tmp_path / "manifest.json"))
    written = json.loads((tmp_path / "manifest.json").read_text())
    assert written == json.loads(report.manifest(found)) and list(written) == ["summary", "validation", "top_folded", "candidate_tally", "gallery"]
    assert [(t["name"], t["total"]) for t in written["candidate_tally"]] == list(votes.items())
    assert written["candidate_tally"][-1]["by_party"] == {"Democratic": 6, "Republican": 6}
    page = report.render(found, "t")
    assert "<h3>Marker: 12</h3>" in page and page.count("<td>Name ") == 40 and "6 further names" in page


def test_marking_writes_crops(spark, tmp_path):
    # Two pages with ink, one without, and one with ink whose file is gone; the region reaches past the lower edge.
    folder = tmp_path / "scans" / "AB-1"
    folder.mkdir(parents=True)
    blank = np.full((40, 50), 255, np.uint8)
    inked = blank.copy()
    inked[20:30, 10:30] = np.arange(200, dtype=np.uint8).reshape(10, 20)
    for seq, pixels in (("001", inked), ("002", blank), ("00 3", inked)):
        (folder / f"AB-1+{seq}.jpg").write_bytes(png(pixels))
    loaded = images.load(spark, str(folder))
    listed = scan.list_files(spark, str(tmp_path / "scans"), CFG)
    assert rows(loaded.select("path")) == rows(listed)
    table = listed.union(spark.createDataFrame([("file:/gone/AB-1+004.jpg",)], "path string")).withColumn("seq", F.regexp_extract("path", r"\+(.*)\.jpg", 1))
    region = {"x0": 0.1, "y0": 0.25, "x1": 0.7, "y1": 1.1}
    count = Count(spark, str(tmp_path / "state"), CFG)
    count.save(
        images=table.select("path", "seq", F.lit("AB-1").alias("box"), F.lit("located").alias("status"), F.lit("L").alias("layout")),
        regions=spark.range(1).select(F.lit("L").alias("layout"), F.lit(1).alias("valid"), *(F.lit(v).alias(k) for k, v in region.items())),
    )
    scores = table.select("path", F.when(F.col("seq") == "002", 0.0).otherwise(0.9).alias("oval_fill_score"), F.lit(0.0).alias("line_ink_score"), F.lit(None).cast("string").alias("err"))
    crops = tmp_path / "crops"
    count.mark(scores, str(crops), pixels=loaded)
    assert sorted(p.name for p in crops.iterdir()) == ["AB-1_00 3.png", "AB-1_001.png"]
    back = images.load(spark, str(crops)).collect()
    want = np.zeros((34, 30), np.uint8)
    want[:30] = inked[10:40, 5:35]
    assert len(back) == 2 and all((images.gray(r["data"], r["width"], r["height"], r["channels"]) == want).all() for r in back)
    after = {r["seq"]: (r["status"], r["err"]) for r in count.table("images").collect()}
    assert after == {"001": ("marked", None), "002": ("skip_blank", None), "00 3": ("marked", None), "004": ("error", "mark: no image to crop")}
    assert {r["crop_path"] for r in count.table("results").filter("has_mark = 1").collect()} == {str(p) for p in crops.iterdir()}


def test_a_bad_crop_is_an_error(spark):
    given = spark.createDataFrame([("a", "a.png", b"x", 9, 9, 1, 0.0, 0.0, 1.0, 1.0), ("b", "b.png", b"x", 1, 1, 1, 1.0, 0.0, 0.0, 1.0)], "path string, crop_path string, data binary, width int, height int, channels int, x0 double, y0 double, x1 double, y1 double")
    assert all(r["content"] is None and r["err"].startswith("mark: ") for r in images.cut(given).collect())


def test_conformed_adds_columns(spark):
    old = spark.createDataFrame([("a",)], "path string")
    assert S.conformed(old, S.RESULTS).first()["quarantined"] is None


def test_telemetry(spark):
    seen = []
    recorder = telemetry.Recorder(Telemetry(enabled=True), (lambda *a: seen.append(a), lambda *a: 1 / 0))
    with recorder.stage("x"):
        pass
    assert seen[0][0] == "stage.duration" and "x" in recorder.seconds
    assert telemetry.parse_headers("a=1, b = 2=3,c") == {"a": "1", "b": "2=3"} and telemetry.parse_headers("") is None
    df, rows_seen = telemetry.counted(spark.range(5), "read")
    df.collect()
    assert rows_seen.get["rows"] == 5
    empty = [spark.createDataFrame([], t) for t in (S.IMAGES, S.RESULTS, S.REVIEW)]
    assert [tuple(r) for r in telemetry.gauges(*empty).collect()] == [("review.queue.size", None, 0)]
    assert telemetry.latency(spark.createDataFrame([(5.0,)], "latency_ms double")).first()["n"] == 1
