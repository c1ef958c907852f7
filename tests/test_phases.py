import json
import os
import zlib

import numpy as np
import pytest

from tallyforge import __main__ as cli
from tallyforge import schema as S
from tallyforge import telemetry
from tallyforge.config import Telemetry, load
from tallyforge.plans.run import Count
from tests.conftest import COUNT
from tests.test_state_and_sources import png

CFG = load(COUNT, {})
# Gray values that stand for what OCR and the vision model would read.
HEADERS = {10: "Official Primary\nDemocratic", 20: "OFFICIAL PRIMARY Republican", 30: "Target Card", 40: "nothing here"}
STYLES = {1: "Style 1000-1", 2: "Style 2000-2-A", 3: ""}
LABEL, HAND = 77, 33


def page(header, style, label=True, marked=False, hand=False):
    image = np.full((3000, 1000), 255, np.uint8)
    image[0, 0], image[0, 620] = header, style
    image[800, 85:216] = 0  # the line
    if label:
        image[805, 100] = LABEL
    if marked:
        image[772:800, 33:80] = 0
    if hand:
        image[780, 120] = HAND
    return png(image)


def pixels(content):
    """A gray PNG without filters."""
    width, height = int.from_bytes(content[16:20], "big"), int.from_bytes(content[20:24], "big")
    at, data = 8, b""
    while at < len(content):
        n = int.from_bytes(content[at : at + 4], "big")
        if content[at + 4 : at + 8] == b"IDAT":
            data += content[at + 8 : at + 8 + n]
        at += 12 + n
    return np.frombuffer(zlib.decompress(data), np.uint8).reshape(height, width + 1)[:, 1:]


class Ocr:
    def text(self, content, psm):
        image = pixels(content)
        if psm == 7:
            return STYLES[image[0, 0]]
        if image.shape[1] == 1000:
            return HEADERS[image[0, 0]]
        return "xx Write - In" if (image == LABEL).any() else "Vote for one"

    def table(self, content, psm):
        image = pixels(content)
        rows = ["text\tleft\ttop\twidth\theight\tconf", "bad\tx\t1\t1\t1\t1"]
        if psm == 3:
            rows += ["Governor\t50\t500\t9\t9\t91.5", "governor\t50\t900\t9\t9\t80"]
        else:
            rows += [f"Write-In.\t5\t{y}\t9\t9\t50" for y in np.flatnonzero((image == LABEL).any(axis=1))[:1]]
        return "\r\n".join(rows)


def vision(content):
    if (pixels(content) == HAND).any():
        return json.dumps({"text": "Marker", "oval": "filled", "confidence": 0.9})
    return "Vote for one"


@pytest.fixture
def scans(tmp_path):
    root = tmp_path / "scans"
    files = {f"AB-1/AB-1+00{i}.jpg": page(10, 1, marked=i < 3, hand=i < 2) for i in range(6)}
    files |= {f"AB-2/AB-2+00{i}.jpg": page(20, 2, label=False, marked=i == 0) for i in range(4)}
    files |= {"AB-2/AB-2+010.jpg": page(30, 3), "AB-2/AB-2+011.jpg": page(40, 3), "AB-2/AB-2+012.jpg": page(10, 3), "AB-2/AB-2+013.jpg": b"no picture", "AB-3/AB-3+001.jpg.part": b"x"}
    for name, content in files.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(content)
    return root


def test_scans_to_report(spark, tmp_path, scans):
    said = []
    official = tmp_path / "official.json"
    official.write_text(json.dumps({"source": "portal", "as_of": "today", "status": "unofficial", "contests": {"Democratic": {"writein_total": 2}, "Republican": {"writein_total": 9}}}))
    base = ["--state", str(tmp_path / "state"), "--root", str(scans), "--config", COUNT, "--official", str(official)]
    run = lambda *what: cli.main([*what, *base], spark, Ocr(), vision, lambda *a: said.append(" ".join(map(str, a))))
    assert run("ingest") == 0 and json.loads(said[-1][8:]) == {"pending": 14}
    assert json.loads(said[-2][10:]) == {"on_disk": 3, "ingested": 2, "missing": 1, "first": ["AB-3"]}
    # One box and a limit first, then the rest.
    assert run("classify", "--box", "AB-1", "--limit", "2") == 0 and json.loads(said[-1][8:]) == {"pending": 12, "classified": 2}
    assert run("all") == 1  # the Republican total is far off
    assert any("Republican: ours 0, official 9, -100.0% OUT OF TOLERANCE" in s for s in said) and any(s.startswith("Democratic: ours 2, official 2, +0.0%") for s in said)
    count = Count(spark, str(tmp_path / "state"), CFG)
    images = {os.path.basename(r["path"]): r for r in count.table("images").collect()}
    status = {n: r["status"] for n, r in images.items()}
    assert status == {f"AB-1+00{i}.jpg": "done" if i < 3 else "skip_blank" for i in range(6)} | {f"AB-2+00{i}.jpg": "done" if i == 0 else "skip_blank" for i in range(4)} | {
        "AB-2+010.jpg": "skip_no_governor", "AB-2+011.jpg": "skip_no_governor", "AB-2+012.jpg": "skip_no_governor", "AB-2+013.jpg": "error"}
    assert [images[f"AB-2+01{i}.jpg"]["page_kind"] for i in range(4)] == ["target_card", "ballot_back", "ballot_front", None]
    assert images["AB-2+013.jpg"]["err"] == "classify: the image does not decode"
    regions = {r["layout"]: r for r in count.table("regions").collect()}
    assert {k: r["valid"] for k, r in regions.items()} == {"Democratic|1000-1": 1, "Republican|2000-2": 0}
    assert [round(regions["Democratic|1000-1"][c] * n) for c, n in (("x0", 1000), ("y0", 3000), ("x1", 1000), ("y1", 3000), ("ox0", 1000), ("oy1", 3000))] == [5, 740, 225, 826, 31, 806]
    results = {os.path.basename(r["path"]): r for r in count.table("results").collect() if r["has_mark"]}
    assert {n: (r["candidate"], r["vision_oval"]) for n, r in results.items()} == {"AB-1+000.jpg": ("marker", "filled"), "AB-1+001.jpg": ("marker", "filled"), "AB-1+002.jpg": ("vote for one", "unsure"), "AB-2+000.jpg": ("vote for one", "unsure")}
    assert sorted(os.listdir(tmp_path / "state/crops")) == ["AB-1_000.png", "AB-1_001.png", "AB-1_002.png", "AB-2_000.png"]
    assert sorted(r["reason"] for r in count.table("review").collect()) == ["low_conf", "low_conf"]
    # Nothing new: nothing changes.  A new scan goes through on its own; the region is not looked for again.
    before = count.generation()
    assert run("classify") == run("locate") == run("mark") == run("read") == 0 and count.generation() == before
    (scans / "AB-1/AB-1+777.jpg").write_bytes(page(10, 1, label=False, marked=True, hand=True))
    assert run("all") == 1
    assert {r["vision_text"] for r in count.table("results").collect() if r["path"].endswith("777.jpg")} == {"Marker"}
    assert count.table("regions").count() == 2
    assert run("rescore") == 0 and run("export", "--out", str(tmp_path / "out")) == 0 and run("retry") == 0
    assert spark.read.parquet(str(tmp_path / "out/results.parquet")).count() == count.table("results").count()
    assert run("manifest", "--out", str(tmp_path / "m.json")) == 0 and run("report", "--out", str(tmp_path / "r.html"), "--title", "A <b>") == 0
    manifest = json.loads((tmp_path / "m.json").read_text())
    assert {k: manifest["validation"][k] for k in ("source", "as_of", "official_status", "boxes_on_disk")} == {"source": "portal", "as_of": "today", "official_status": "unofficial", "boxes_on_disk": 3}
    assert manifest["candidate_tally"] == [{"name": "marker", "total": 3, "by_party": {"Democratic": 3}}, {"name": "vote for one", "total": 2, "by_party": {"Democratic": 1, "Republican": 1}}]
    html = (tmp_path / "r.html").read_text()
    assert "A &lt;b&gt;" in html and html.count("<figure>") == 5


def test_a_failed_mark_or_read_is_an_error(spark, tmp_path, scans):
    state, base = tmp_path / "state", ["--state", str(tmp_path / "state"), "--root", str(scans), "--config", COUNT]
    run = lambda what: cli.main([what, *base], spark, Ocr(), vision, lambda *a: None)
    for what in ("ingest", "classify", "locate"):
        run(what)
    os.remove(scans / "AB-1/AB-1+000.jpg")
    (scans / "AB-1/AB-1+001.jpg").write_bytes(b"spoiled since")
    run("mark")
    os.remove(state / "crops/AB-1_002.png")
    run("read")
    errors = {os.path.basename(r["path"])[:8]: r["err"] for r in Count(spark, str(state), CFG).table("images").filter("status = 'error'").collect() if "AB-1" in r["path"]}
    assert errors == {"AB-1+000": "mark: the file is gone", "AB-1+001": "mark: the image does not decode", "AB-1+002": "read: the crop is gone"}


def test_a_run_that_dies_while_saving_keeps_its_last_state(spark, tmp_path, monkeypatch):
    count = Count(spark, str(tmp_path / "state"), CFG)
    rows = lambda *paths: spark.createDataFrame([(p,) for p in paths], "path string")
    listed = lambda c=None: sorted(r["path"] for r in (c or count).table("images").collect())
    count.save(images=rows("a"))
    assert (count.generation(), listed()) == (1, ["a"])

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:  # between the tables and the commit
        m.setattr(count, "_commit", dies)
        with pytest.raises(KeyboardInterrupt):
            count.save(images=rows("a", "b"), review=rows("r"))
    assert (count.generation(), listed(), count.table("review").count()) == (1, ["a"], 0)
    (tmp_path / "state/commits/2f.new").write_text('{"images": "nowhere"}')  # a commit that was never renamed
    again = Count(spark, str(tmp_path / "state"), CFG)
    assert (again.generation(), listed(again)) == (1, ["a"])
    count.save(review=rows("r"))
    assert count.folders(2)["images"] == count.folders(1)["images"]  # what did not change is not written again
    assert (listed(), count.table("review").count(), [r["path"] for r in count.table("images", 1).collect()]) == (["a"], 1, ["a"])
    with pytest.raises(RuntimeError):
        again._commit(2, {})
    assert count.table("review").count() == 1 and {f.name for f in (tmp_path / "state/commits").iterdir() if f.suffix == ".json"} == {"1.json", "2.json"}


def test_exporters(spark):
    sent = []
    cfg = Telemetry(enabled=True, endpoint="http://here/", headers="a=b", export_interval_ms=10**9)
    out = telemetry.OtlpExporter(cfg, {}, lambda *a: sent.append(a))
    recorder = telemetry.Recorder(cfg, (out,))
    recorder.images("read", 3)
    recorder.images("read", 4)
    recorder.cache(5, 1)
    recorder.latency({"n": 2, "p50": 7.5, "p95": None})
    recorder.gauges(spark.createDataFrame([("a", "done")], "path string, status string"), spark.createDataFrame([], S.RESULTS), spark.createDataFrame([], S.REVIEW))
    assert not sent
    recorder.close()
    (url, body, headers), = sent
    assert url == "http://here/v1/metrics" and headers["a"] == "b"
    metrics = {m["name"]: m for m in json.loads(body)["resourceMetrics"][0]["scopeMetrics"][0]["metrics"]}
    points = lambda n, k: {tuple(a["value"]["stringValue"] for a in p["attributes"]): p["asDouble"] for p in metrics[f"tally.{n}"][k]["dataPoints"]}
    assert points("images.processed", "sum") == {("read",): 7} and points("locate.cache", "sum") == {("hit",): 5, ("miss",): 1}
    assert points("vision.read.latency", "gauge") == {("p50",): 7.5} and points("images.by_status", "gauge") == {("done",): 1} and points("review.queue.size", "gauge") == {("",): 0}
    recorder.close()
    assert len(sent) == 1  # nothing new
    failing = telemetry.Recorder(cfg, (telemetry.OtlpExporter(cfg, {}, lambda *a: 1 / 0),))
    failing.images("x", 1)
    failing.close()
    assert telemetry.recorder(Telemetry()).exporters == () and len(telemetry.recorder(cfg, {}).exporters) == 1


def test_inflight(spark):
    reads = [(0.0, 2500.0), (1.0, 500.0), (1.2, 100.0), (1.5, 100.0), (None, None), (9.0, None)]
    assert telemetry.inflight(spark.createDataFrame(reads, "began double, latency_ms double")).first()["most"] == 3
    assert telemetry.inflight(spark.createDataFrame([], "began double, latency_ms double")).first()["most"] == 0
