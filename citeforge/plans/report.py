"""The report over canonical publications: small aggregates, collected, as JSON and HTML."""

from __future__ import annotations

import datetime as dt
import html
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import metrics
from ..sources.together import SCHEMA, TogetherSink
from .ticks import nice_ticks


def report(pubs: DataFrame, datasets: DataFrame, order: list[str], generated: str) -> dict:
    """Totals, years, subjects and citation ranges; every part has few rows. Publications are computed once."""
    pubs = pubs.select("journal", "subject", "authors", "institutions", "countries", "year", "cited", *order).persist()
    try:
        return _report(pubs, datasets, order, generated)
    finally:
        pubs.unpersist()


def _report(pubs: DataFrame, datasets: DataFrame, order: list[str], generated: str) -> dict:
    stats = metrics.summary(pubs).first().asDict()
    stats |= metrics.distinct_authors(pubs).first().asDict()
    for c in ("institutions", "countries"):
        stats |= metrics.distinct_items(pubs, c, c).first().asDict()
    stats["datasets"] = datasets.count()
    rows = lambda df: [r.asDict() for r in df.collect()]
    return {
        "generated": generated,
        "stats": stats,
        "publicationsByYear": rows(metrics.by_year(pubs).orderBy("year")),
        "topSubjects": rows(metrics.top_subjects(pubs, order)),
        "citationDistribution": rows(metrics.citation_buckets(pubs).orderBy("nth").select("label", "count")),
    }


def to_json(data: dict) -> str:
    return json.dumps(data, indent=2, ensure_ascii=False)


def bars(rows: list[dict], label: str, value: str, width: int = 720, height: int = 240) -> str:
    """Bars with round ticks; zero values draw none."""
    top = max([1, *(r[value] for r in rows)])
    step = width / max(1, len(rows))
    out = [f'<line x1="0" x2="{width}" y1="{height * (1 - t / top):.1f}" y2="{height * (1 - t / top):.1f}"/><text x="0" y="{height * (1 - t / top):.1f}">{t:,.0f}</text>' for t in nice_ticks(top)]
    for i, r in enumerate(rows):
        if r[value]:
            h = height * r[value] / top
            out.append(f'<rect x="{i * step:.1f}" y="{height - h:.1f}" width="{step * 0.8:.1f}" height="{h:.1f}"><title>{html.escape(str(r[label]))}: {r[value]:,}</title></rect>')
    return f'<svg viewBox="0 0 {width} {height}">{"".join(out)}{year_labels(rows, lambda i: i * step, height)}</svg>'


def year_labels(rows: list[dict], at, height: int) -> str:
    """The first and the last year, and every fifth."""
    last = len(rows) - 1
    return "".join(f'<text x="{at(i):.1f}" y="{height}">{r["year"]}</text>' for i, r in enumerate(rows) if "year" in r and (i in (0, last) or r["year"] % 5 == 0))


def line(rows: list[dict], value: str, width: int = 720, height: int = 240) -> str:
    """A line over its area and a grid; one year alone is a point in the middle."""
    top, n = max([1, *(r[value] for r in rows)]), len(rows)
    at = lambda i: (i / (n - 1) if n > 1 else 0.5) * width
    grid = "".join(f'<line x1="0" x2="{width}" y1="{height * (1 - t / top):.1f}" y2="{height * (1 - t / top):.1f}"/><text x="0" y="{height * (1 - t / top):.1f}">{t:,.0f}</text>' for t in nice_ticks(top))
    points = " ".join(f"{at(i):.1f},{height * (1 - r[value] / top):.1f}" for i, r in enumerate(rows))
    area = f'<polygon points="{at(0):.1f},{height} {points} {at(n - 1):.1f},{height}"/>' if n else ""
    return f'<svg viewBox="0 0 {width} {height}">{grid}{area}<polyline fill="none" points="{points}"/>{year_labels(rows, at, height)}</svg>'


def shares(rows: list[dict], label: str, value: str, full: int = 100, least: int = 0) -> str:
    """Horizontal bars as a share of the largest; non-zero ones have at least ``least``."""
    top = max([1, *(r[value] for r in rows)])
    size = lambda v: max(round(full * v / top), least) if v else 0
    return "".join(f'<li><span>{html.escape(r[label])}</span><i style="width:{size(r[value])}px"></i><b>{r[value]:,}</b></li>' for r in rows)


def cards(stats: dict, names: tuple[str, ...]) -> str:
    return "".join(f'<div class="card"><b>{stats[n]:,}</b><span>{html.escape(n)}</span></div>' for n in names)


def long_date(iso: str) -> str:
    """Day, month and year of an ISO date or timestamp; other text as it is."""
    try:
        d = dt.date.fromisoformat(iso[:10])
    except ValueError:
        return iso
    return f"{d.day} {d:%B} {d.year}"


#: Counts up from 0 to the number that a card holds.
COUNT_UP = "<script>document.querySelectorAll('.card b').forEach(b=>{const n=+b.textContent.replace(/,/g,'');let t0;const f=t=>{t0??=t;const p=Math.min(1,(t-t0)/1200);b.textContent=Math.round(n*p).toLocaleString('en-AU');p<1&&requestAnimationFrame(f)};requestAnimationFrame(f)})</script>"

HERO = ("publications", "citations", "authors", "institutions", "countries", "datasets")


def dashboard(data: dict) -> str:
    s = data["stats"]
    note = f"<p>{s['without_subject']:,} publications lack subject data.</p>" if s["without_subject"] else ""
    years = data["publicationsByYear"]
    return (
        f"<!doctype html><meta charset=utf-8><title>Research output</title><h1>{html.escape(s['year_range'])}</h1>{cards(s, HERO)}"
        f"{bars(years, 'year', 'count')}{line(years, 'cumulative_citations')}<ul>{shares(data['topSubjects'], 'topic', 'count')}</ul>{note}"
        f"<ul>{shares(data['citationDistribution'], 'label', 'count', 280, 3)}</ul><footer>{html.escape(long_date(data['generated']))}</footer>"
    )


def widget(data: dict) -> str:
    """Six counters that count up, and the date."""
    return f"<!doctype html><meta charset=utf-8>{cards(data['stats'], HERO)}<p>{html.escape(long_date(data['generated']))}</p>{COUNT_UP}"


def save(spark: SparkSession, folder: str, files: dict[str, str]) -> None:
    """Writes texts as files of a folder, all of them or none."""
    spark.dataSource.register(TogetherSink)
    rows = spark.createDataFrame(list(files.items()), SCHEMA)
    rows.write.format("together").option("path", folder).mode("append").save()


def counters(df: DataFrame, **conditions) -> DataFrame:
    """A one-row metrics frame of a run."""
    return df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in conditions.items()])
