"""The manifest (JSON) and the report (HTML) of a count, rendered on the driver from small aggregates.

The manifest has the whole tally, the report's table its first TABLE_ROWS names.
"""

from __future__ import annotations

import base64
import html
import os
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import summary as S
from ..sources.files import manifest_document
from .run import Count

PAGE = """<!DOCTYPE html>
<html lang="en"><head><meta charset="utf-8"><title>{title}</title><style>
body{{font:16px/1.5 sans-serif;max-width:60rem;margin:2rem auto}}table{{border-collapse:collapse}}td,th{{padding:.2rem .8rem;text-align:left}}
.bar{{background:#468;height:.7rem}}.split{{display:flex;height:1rem}}.ok{{color:#264}}.off{{color:#a30}}figure{{display:inline-block;margin:.4rem}}
</style></head><body><h1>{title}</h1>
<h2>Images</h2><table>{funnel}</table>
<h2>Reads</h2><div class="split">{split}</div><p>{note}</p>
<h2>Tally</h2><table><tr><th>#</th><th>Name</th><th>Votes</th><th>By party</th><th></th></tr>{rows}</table><p>{tail}</p>
<h2>Gallery</h2>{gallery}
<h2>Checks</h2><p>{coverage}</p><table><tr><th>Party</th><th>Ours</th><th>Official</th><th>Delta</th></tr>{checks}</table>
</body></html>"""


def _text(value) -> str:
    return html.escape("" if value is None else str(value))


# The least width of a bar in per cent, and the least weight of the ambiguous part.
LEAST_WIDTH, LEAST_PART = 0.6, 40


def _width(n: int, total: int) -> str:
    return f"{max(100 * n / total if total else 0, LEAST_WIDTH):.2f}"


def party_counts(by_party: dict[str, int]) -> str:
    """Counts by party, the largest first."""
    return ", ".join(f"{p} {n:,}" for p, n in sorted(by_party.items(), key=lambda x: (-x[1], x[0])))


def collect(count: Count, official: DataFrame, expected_boxes: DataFrame | None = None, files: DataFrame | None = None) -> dict:
    """What manifest and report show: tens of rows, collected; ``names`` is the frame of the whole tally.

    expected_boxes: the box folders on disk (``scan.list_boxes``).
    """
    cfg, images, results, review = count.cfg, count.table("images"), count.table("results"), count.table("review")
    scoped = count.scoped()
    tallied = S.tally(scoped).persist()  # a row for each name, read several times here
    pictures: dict[str, list[dict]] = {}
    for r in S.gallery(scoped, tallied, cfg, files).orderBy("name", "rank").collect():
        pictures.setdefault(r["name"], []).append({k: r[k] for k in ("box", "seq", "party", "text", "crop_path")})
    coverage = S.coverage(expected_boxes, images, "box").first().asDict() if expected_boxes is not None else {"on_disk": None, "ingested": images.select("box").distinct().count(), "missing": None}
    # Pictures can be of names beyond the table's rows: their totals come from the whole tally.
    totals = {r["name"]: r["total"] for r in tallied.filter(F.col("name").isin(*pictures)).collect()} if pictures else {}
    return {
        "status": {r["status"]: r["n"] for r in S.counts_by(images, "status").collect()},
        "summary": S.summary(images, results, review, cfg).first().asDict(),
        "tally": [r.asDict() for r in S.first_names(tallied).orderBy("rank").collect()],
        "names": S.in_order(tallied),
        "totals": totals,
        "tail": S.tail(tallied).first().asDict(),
        "note": [f"{r['name'].title()} {r['total']}" for r in S.top_names(tallied, cfg.target.term).collect()],
        "gallery": pictures,
        "coverage": coverage,
        "official": _about(official),
        "checks": [r.asDict() for r in S.reconcile(S.filled_by_party(scoped), official).orderBy("party").collect()],
    }


def _about(official: DataFrame) -> dict:
    """Where the official totals come from; nulls without any."""
    names = ("source", "as_of", "status")
    row = official.select(*names).first() if set(names) <= set(official.columns) else None
    return {n: row[n] if row else None for n in names}


def manifest_parts(found: dict) -> Iterator[str]:
    """The manifest in pieces; the tally comes to the driver one partition at a time."""
    coverage, official = found["coverage"], found["official"]
    validation = {
        "boxes_ingested": coverage["ingested"], "boxes_on_disk": coverage["on_disk"], "boxes_missing": coverage["missing"],
        "source": official["source"], "as_of": official["as_of"], "official_status": official["status"], "contests": found["checks"],
    }
    tally = ({"name": t["name"], "total": t["total"], "by_party": t["by_party"]} for t in found["names"].toLocalIterator())
    return manifest_document(found["summary"], validation, found["note"], tally, found["gallery"])


def manifest(found: dict) -> str:
    return "".join(manifest_parts(found))


def write_manifest(found: dict, path: str) -> None:
    with open(path, "w", encoding="utf-8") as f:
        f.writelines(manifest_parts(found))


def _figure(item: dict) -> str:
    """A crop with its caption; nothing if the file is gone."""
    if not os.path.exists(item["crop_path"]):
        return ""
    with open(item["crop_path"], "rb") as f:
        data = base64.b64encode(f.read()).decode()
    return f'<figure><img src="data:image/png;base64,{data}" alt=""><figcaption>{_text(item["text"] or "(blank)")} ({_text(item["party"])}, {_text(item["box"])} {_text(item["seq"])})</figcaption></figure>'


def _split(s: dict) -> str:
    """Three parts: the target, other names, ambiguous reads (never too thin to be seen)."""
    parts = ((s["target_total"], "#468"), (s["other_names"], "#9ac"), (max(s["ambiguous"], LEAST_PART), "#ddd"))
    return "".join(f'<div style="flex:{n};background:{c}"></div>' for n, c in parts)


def coverage_text(c: dict) -> str:
    if not c["on_disk"]:
        return f"{c['ingested']:,} boxes ingested"
    return f"{c['ingested']:,} of {c['on_disk']:,} boxes ingested ({100 * c['ingested'] / c['on_disk']:.1f}%)"


def check_row(c: dict) -> str:
    delta = "" if c["delta"] is None else f"{c['delta']:+.1%}"
    official = "" if c["official"] is None else f"{c['official']:,}"
    return f'<tr class="{"ok" if c["ok"] else "off"}"><td>{_text(c["party"])}</td><td>{c["ours"]:,}</td><td>{official}</td><td>{delta}</td></tr>'


def render(found: dict, title: str) -> str:
    total = sum(found["status"].values())
    most = found["tally"][0]["total"] if found["tally"] else 0
    bar = lambda n, of: f'<div class="bar" style="width:{_width(n, of)}%"></div>'
    funnel = "".join(f"<tr><td>{_text(k)}</td><td>{n:,}</td><td style='width:20rem'>{bar(n, total)}</td></tr>" for k, n in sorted(found["status"].items(), key=lambda x: (-x[1], str(x[0]))))
    rows = "".join(f"<tr><td>{t['rank']}</td><td>{_text(t['name'].title())}</td><td>{t['total']:,}</td><td>{_text(party_counts(t['by_party']))}</td><td style='width:20rem'>{bar(t['total'], most)}</td></tr>" for t in found["tally"])
    pictures = "".join(f"<h3>{_text(n.title())}: {found['totals'].get(n, len(items)):,}</h3>{''.join(map(_figure, items))}" for n, items in found["gallery"].items())
    return PAGE.format(
        title=_text(title), funnel=funnel, split=_split(found["summary"]), note=_text(", ".join(found["note"])), rows=rows,
        tail=f"{found['tail']['names']:,} further names, {found['tail']['votes']:,} votes", gallery=pictures,
        coverage=_text(coverage_text(found["coverage"])), checks="".join(map(check_row, found["checks"])),
    )
