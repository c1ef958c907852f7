import random
from difflib import SequenceMatcher

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.config import Config, Locate, from_mapping, java_regex, load
from tallyforge.functions import geometry, raster, similarity, text
from tallyforge.operators import stages
from tests.conftest import COUNT

CFG = load(COUNT, {})


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'int' if isinstance(v, int) else 'double' if isinstance(v, float) else 'string'}" for k, v in values.items()))
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("path, box, seq", [
    ("/scans/AB-0001/AB-0001+10011.jpg", "AB-0001", "10011"), ("AB-0002+00007.JPEG", "AB-0002", "00007"),
    ("AB-1.jpg", None, None), ("AB-1+2.png", None, None), ("ab-3+4.jpg", "ab-3", "4"),
])
def test_parse_name(spark, path, box, seq):
    assert tuple(one(spark, text.parse_name(F.col("p")), p=path)) == (box, seq)


@pytest.mark.parametrize("raw, code", [("a 4303-1-WS b 4303-1", "4303-1-WS"), ("4303-12 4303-1-A", "4303-1-A"), ("1234-5 6789-0", "1234-5"), ("none", None)])
def test_style(spark, raw, code):
    assert one(spark, text.style_code(F.col("t")), t=raw) == code


@pytest.mark.parametrize("party, style, layout", [(None, "4303-1-WS", "other|4303-1"), ("Democratic", None, None), ("Democratic", "x", None), ("Republican", "4303-22", "Republican|4303-22"), ("", "4303-1", "other|4303-1")])
def test_layout(spark, party, style, layout):
    assert one(spark, text.layout_key(F.col("p"), F.col("s")), p=party, s=style) == layout


@pytest.mark.parametrize("raw, norm", [("  Tína  VOTEK-2 ", "t na votek"), (None, ""), ("", ""), ("!!", ""), ("A\tb\nC", "a b c")])
def test_normalize(spark, raw, norm):
    assert one(spark, text.normalize(F.col("t")), t=raw) == norm


GOLDEN = [
    ("marker", 0.9, 1.0, "marker"), ("the marker", 0.9, 1.0, "marker"), ("not marker", 0.9, 1.0, "marker"), ("marker", 0.2, 1.0, "review"),
    ("marger", 0.9, 0.99, "marker"), ("manker", 0.9, 0.99, "marker"), ("darker", 0.9, 0.99, "marker"), ("larker", 0.9, 0.99, "marker"), ("marke", 0.9, 0.99, "marker"),
    ("markeng", 0.9, 0.7692, "review"), ("mar k", 0.9, 0.7273, "review"), ("", 0.9, 0.0, "not_marker"), (None, None, 0.0, "not_marker"),
]


def test_golden_matches(spark):
    reads = spark.createDataFrame([(str(i), t, c) for i, (t, c, _, _) in enumerate(GOLDEN)], "path string, vision_text string, vision_conf double")
    got = {r["path"]: r for r in stages.matched(reads, CFG).collect()}
    for i, (raw, conf, score, match) in enumerate(GOLDEN):
        r = got[str(i)]
        assert (round(r["match_score"], 4), r["match"]) == (score, match), raw
    low = got["3"]
    assert (low["candidate"], low["reason"]) == ("marker", "low_conf")
    assert (got["11"]["candidate"], got["11"]["reason"]) == ("", None)
    assert got["9"]["reason"] == "unknown_candidate"


@pytest.mark.parametrize("raw, name", [("c brazen", "corinne brazan"), ("corinne bra", "corinne brazan"), ("not votek", "not votek"), ("votek nina", "nina votek"), ("zzz", "zzz"), ("", "")])
def test_folds(spark, raw, name):
    norms = spark.createDataFrame([(raw,)], "norm string")
    assert similarity.folded_names(norms, CFG).first()["candidate"] == name


def test_no_candidates(spark):
    norms = spark.createDataFrame([("a",)], "norm string")
    assert similarity.folded_names(norms, Config(candidates=())).first()["candidate"] == "a"


def test_ratio_is_the_sequence_ratio(spark):
    rng = random.Random(3)
    pairs = [("".join(rng.choice("abc ") for _ in range(rng.randint(0, 9))), "".join(rng.choice("abc ") for _ in range(rng.randint(0, 9)))) for _ in range(200)] + [("tide", "diet"), ("diet", "tide")]
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", similarity.ratio("a", "b").alias("r")).collect()
    assert all(r["r"] == SequenceMatcher(None, r["a"], r["b"]).ratio() for r in got)
    assert similarity.ratio_of("tide", "diet") == 0.25 and similarity.ratio_of("diet", "tide") == 0.5


def scan_runs(mask, gap):
    """The definition, read off pixel by pixel."""
    runs, start, last = [], None, None
    for i, v in enumerate(mask):
        if v:
            start, last = i if start is None or i - last - 1 > gap else start, i
            runs = [r for r in runs if r[0] != start] + [(start, last - start + 1)]
    best = (0, 0)
    for s, n in sorted(runs):
        if n > best[1]:
            best = (s, n)
    return best


def test_longest_run(spark):
    rng = np.random.default_rng(1)
    masks = [rng.random(60) < p for p in (0, 0.1, 0.3, 0.5, 0.9, 1) for _ in range(8)]
    for gap in (0, 2, 8):
        assert [raster.longest_run(m, gap) for m in masks] == [scan_runs(m, gap) for m in masks]
    rows = spark.createDataFrame([(i, [bool(v) for v in m]) for i, m in enumerate(masks)], "id int, mask array<boolean>")
    got = {r["id"]: (r["start"], r["length"]) for r in raster.dark_runs(rows, "id", "mask", 2).collect()}
    assert got == {i: scan_runs(m, 2) for i, m in enumerate(masks)}


def test_density():
    image = np.array([[0, 200], [50, 110]], np.uint8)
    assert raster.density(image, (0, 0, 2, 2), 110) == 0.5
    assert raster.density(image, (-5, -5, 1, 1), 110) == 1.0
    assert raster.density(image, (2, 2, 1, 1), 110) == 0.0


def page(line_y=300, border_y=None):
    image = np.full((1200, 1000), 255, np.uint8)
    image[line_y, 110:200] = 0
    image[line_y, 205:320] = 100  # a break that is bridged
    if border_y:
        image[border_y, 5:215] = 0
    return image


def test_find_line():
    cfg = Config(locate=Locate(col_w_frac=0.3))
    header = {"text": "Governor", "left": 50, "top": 100, "conf": 90.0}
    near = raster.find_line(page(), header, [], 305, cfg)
    assert (near.y, near.start, near.end, near.col_x0, near.col_x1) == (300, 110, 305, 5, 305)
    assert raster.find_line(page(), header, [], 200, cfg).y == 184  # nothing under the label: an estimate
    assert raster.find_line(page(), header, [], None, cfg).y == 300
    heading = [{"text": "Vote", "left": 60, "top": 200, "conf": 90.0}]
    assert raster.find_line(page(), header, heading, None, cfg) is None  # the next contest begins above the line
    assert raster.find_line(page(), {**header, "top": 1190}, [], None, cfg) is None


def test_boxes(spark):
    box = F.struct(F.lit(0.5).alias("x0"), F.lit(0.25).alias("y0"), F.lit(0.999).alias("x1"), F.lit(1.0).alias("y1"))
    assert tuple(one(spark, geometry.pixels(box, F.col("w"), F.col("h")), w=101, h=10)) == (50, 2, 100, 10)
    back = geometry.fractions(geometry.pixels(box, F.col("w"), F.col("h")), F.col("w"), F.col("h"))
    assert one(spark, back, w=100, h=100)["x0"] == 0.5
    assert raster.to_pixels((0.5, 0.25, 0.999, 1.0), 101, 10) == (50, 2, 100, 10)
    assert tuple(one(spark, geometry.band(CFG.classify.style_band, F.col("w"), F.col("h")), w=100, h=100)) == (62, 0, 100, 6)


def test_gate_is_strict(spark):
    marked = lambda o, l, n: one(spark, stages.is_marked(F.col("o"), F.col("l"), F.lit(0.0), F.lit(0.0), F.col("n")), o=o, l=l, n=n)  # noqa: E731, E741
    assert marked(0.12, 0.07, 8) is False and marked(0.13, 0.0, 8) is True and marked(0.0, 0.08, 8) is True
    assert marked(0.18, 0.11, 7) is False and marked(0.19, 0.0, 7) is True


def test_reports_escape_and_format(spark):
    assert one(spark, text.html_escape(F.col("t")), t="<a & \"b\" 'c'>") == "&lt;a &amp; &quot;b&quot; &#x27;c&#x27;&gt;"
    assert one(spark, text.html_escape(F.col("t")), t=None) == ""
    assert one(spark, text.thousands(F.col("n")), n=1234567) == "1,234,567"
    assert one(spark, text.signed_percent(F.col("x")), x=0.1234) == "+12.3%"
    assert one(spark, text.relative_delta(F.col("a"), F.col("b")), a=4, b=0) is None
    assert one(spark, text.bar_width(F.col("a"), F.col("b")), a=1, b=0) == 0.6


def test_config(tmp_path):
    assert load(environ={}) == Config() and Config().names == ("sample",)
    path = tmp_path / "c.toml"
    path.write_text('images_root = "/x"\n[target]\nterm = "stylus"\nunknown = 1\n[classify]\nheader_band = [0.0, 0.0, 1.0, 0.2]\n[[parties]]\nlabel = "P"\nmatch = "p"\n[[candidates]]\nname = "stylus"\naliases = ["stylus"]\n')
    c = load(str(path), {"TALLYFORGE_READ_WORKERS": "9", "TALLYFORGE_TELEMETRY": "1"})
    assert (c.target.term, c.target.strict, c.images_root, c.vision.read_workers, c.telemetry.enabled) == ("stylus", 0.84, "/x", 9, True)
    assert c.classify.header_band == (0.0, 0.0, 1.0, 0.2) and c.names == ("stylus",) and c.party_labels == ("P",)
    assert load(environ={"TALLYFORGE_CONFIG": str(path)}).target.term == "stylus"
    assert from_mapping({}, {"TALLYFORGE_ROOT": "/y"}).images_root == "/y"
    assert from_mapping({"target": {"strict": 1}}, {}).target.strict == 1.0 and c.locate == Locate() and hash(c) == hash(load(str(path), {"TALLYFORGE_READ_WORKERS": "9", "TALLYFORGE_TELEMETRY": "yes"}))
    for bad in ({"target": {"min_alias": 1.5}}, {"locate": {"dark": "x"}}, {"negations": "no"}, {"candidates": [{"name": "a"}]}):
        with pytest.raises(ValueError):
            from_mapping(bad, {})
    assert java_regex("(?P<a>x)") == "(?<a>x)" and "Governor" in CFG.prompt()
