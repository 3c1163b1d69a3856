"""Tables with versions, upserts by bucket, kept answers, scans that go on, archived queue files, files that appear together."""

import json
import random
import threading
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import functions as F

from citeforge.operators import distinct, intervals, merge
from citeforge.plans import jobs, report, run
from citeforge.sources import cache, lookups, paged, tables, together
from citeforge.sources.snapshots import ConcurrentWrite, Table, bucket_of
from citeforge.streaming import pending


class Busy(BaseHTTPRequestHandler):
    """Counts what it's asked; ``broken`` paths fail."""

    asked: Counter = Counter()
    broken: set = set()

    def log_message(self, *_):
        pass

    def do_GET(self):
        at, q = urlparse(self.path), parse_qs(urlparse(self.path).query)
        page = q.get("page", q.get("cursorMark", [""]))[0]
        Busy.asked[f"{at.path} {page}"] += 1
        status, data = 404, {}
        if any(b in f"{self.path} {page}" for b in Busy.broken):
            status = 500
        elif at.path == "/works":
            status, data = 200, {"results": [{"doi": f"10.1/p{page}-{i}", "title": "T", "publication_year": 2001} for i in range(25 if int(page) < 3 else 2)]}
        elif at.path.startswith("/europepmc"):
            status, data = 200, {"resultList": {"result": [{"doi": f"10.2/{page}{i}", "title": "E"} for i in range(100)]}, "nextCursorMark": {"*": "b", "b": "c"}.get(page, "")}
        elif at.path.startswith("/graph"):
            status, data = 200, {"data": [{"externalIds": {"DOI": "10.3/s"}}]}
        elif at.path.startswith("/works/doi:"):
            key = at.path.removeprefix("/works/doi:")
            status, data = (200, {"title": "Index", "doi": key, "cited_by_count": 4, "topics": [{"display_name": "S"}]}) if key.startswith("10.9%2Fa") else (404, {})
        elif at.path.startswith("/works/"):
            key = at.path.removeprefix("/works/")
            status, data = (200, {"message": {"DOI": "10.9/both", "title": ["Registry"], "author": [{"given": "A", "family": "B"}], "container-title": ["J"]}}) if key in ("10.9%2Fa-both", "10.1%2Fp1-0") else (404, {})
        elif at.path.startswith("/fdsnws"):
            self.send_response(200)
            self.end_headers()
            return self.wfile.write(b"#Network|Description|Start|End|Total\n7A|Old net|2005-01-01T00:00:00||3\n7A|New net|2015-01-01|x|1\n")
        elif at.path.startswith("/ws/networks"):
            status, data = 200, {"networks": [{"fdsn_code": "7A", "doi": "10.7914/old", "start_date": "2005-01-01"}, {"fdsn_code": "7A", "doi": "10.7914/new", "start_date": "2015-01-01"}]}
        elif at.path.endswith("/related"):
            status, data = 200, {"children": [{"id": f"{at.path.split('/')[-2]}-c", "title": at.path.split("/")[-2]}] if "root" in at.path and "-c" not in at.path else []}
        self.send_response(status)
        self.end_headers()
        self.wfile.write(json.dumps(data).encode())


@pytest.fixture()
def site():
    Busy.asked, Busy.broken = Counter(), set()
    server = ThreadingHTTPServer(("127.0.0.1", 0), Busy)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


FAST = {"pause": "0", "delay": "0"}


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_versions(spark, tmp_path):
    t = Table(spark, f"file://{tmp_path}/t")
    assert t.version() == 0 and t.read(schema="id long").count() == 0
    with pytest.raises(FileNotFoundError):
        t.read()
    assert t.overwrite(spark.range(3), counts={"n": F.count(F.lit(1)), "odd": F.count_if(F.col("id") % 2 == 1)}) == {"n": 3, "odd": 1}
    old = t.read()
    t.overwrite(t.read().where("id > 0"), ("writer", 1))
    t.overwrite(spark.range(99), ("writer", 1))  # committed already
    assert rows(t.read()) == [(1,), (2,)] and rows(old) == [(0,), (1,), (2,)] and t.versions() == [1, 2]
    assert t.rollback(1) == 3 and rows(t.read()) == [(0,), (1,), (2,)]
    t.overwrite(spark.range(0))
    assert t.read().count() == 0 and t.read().columns == ["id"]
    gone = t.vacuum(keep=2)
    assert len(gone) == 1 and t.versions() == [3, 4] and t.read(3).count() == 3


def test_a_second_writer_is_found_out(spark, tmp_path):
    t = Table(spark, f"file://{tmp_path}/t", "key", 4)
    t.overwrite(spark.createDataFrame([("a", 1)], "key string, v int"))

    def meanwhile(old, new):
        Table(spark, f"file://{tmp_path}/t").overwrite(spark.createDataFrame([("b", 2)], "key string, v int"))
        return new

    with pytest.raises(ConcurrentWrite):
        t.upsert(spark.createDataFrame([("a", 3)], "key string, v int"), meanwhile)
    assert rows(t.read()) == [("b", 2)]


@pytest.mark.parametrize("step", ["write", "names", "manifest"])
def test_a_run_that_dies_leaves_the_table(spark, tmp_path, monkeypatch, step):
    t = Table(spark, f"file://{tmp_path}/t", "key", 4)
    t.overwrite(spark.createDataFrame([("a", 1)], "key string, v int"))

    def dies(*_):
        raise KeyboardInterrupt

    new = spark.createDataFrame([("a", 2), ("c", 5)], "key string, v int")
    with monkeypatch.context() as m:
        if step == "write":
            new = new.withColumn("v", F.expr("if(v = 5, cast(raise_error('dead') AS int), v)"))
        else:
            m.setattr(t.store, "names" if step == "names" else "write", dies if step == "manifest" else lambda p: dies() if "/data/" in p else ["000000000001.json"])
        with pytest.raises((KeyboardInterrupt, Exception)):
            t.upsert(new, lambda old, fresh: fresh)
    assert rows(t.read()) == [("a", 1)] and t.versions() == [1]
    t.upsert(spark.createDataFrame([("a", 2)], "key string, v int"), lambda old, fresh: fresh)
    assert rows(t.read()) == [("a", 2)] and len(t.vacuum(1)) >= 1


def test_upserts_write_the_buckets_of_their_keys(spark, tmp_path):
    t = Table(spark, f"file://{tmp_path}/t", "key", 32)
    first = spark.range(2000).selectExpr("concat('k', id) AS key", "id AS v")
    t.overwrite(first)
    before = t.manifest()["folders"]
    new = spark.createDataFrame([(f"k{i}", -i) for i in (5, 6, 5000)], "key string, v long")
    fold = lambda old, fresh: old.join(fresh.select("key"), "key", "left_anti").unionByName(fresh)
    t.upsert(new, fold, run=("w", 3))
    after, touched = t.manifest()["folders"], {str(r[0]) for r in new.select(bucket_of(F.col("key"), 32)).collect()}
    assert {b for b in after if after[b] != before.get(b)} == touched and len(touched) <= 3
    assert rows(t.read()) == rows(fold(first, new)) and t.upsert(new.withColumn("v", F.lit(0).cast("long")), fold, run=("w", 3)) == {}
    assert rows(t.read()) == rows(fold(first, new))


def test_merge_by_bucket_equals_a_full_merge(spark, tmp_path):
    rnd = random.Random(4)
    pub = lambda i, n: (f"10.1/{rnd.choice('ABab')}{rnd.randrange(n)}" if rnd.random() < 0.9 else "", rnd.choice(["", "x", "yy"]), rnd.randrange(9), [rnd.choice("st")], i)
    schema = "doi string, title string, cited bigint, sources array<string>, nth long"
    old, new = spark.createDataFrame([pub(i, 40) for i in range(120)], schema), spark.createDataFrame([pub(i, 60) for i in range(30)], schema)
    table = run.publications(spark, f"file://{tmp_path}", 16)
    table.overwrite(merge.keyed(merge.canonical(old, "nth")), counts=run._counted(0) | {"added": F.lit(0), "updated": F.lit(0), "next": F.max("nth") + 1})
    fresh = merge.merge_hits(new.withColumn("seq", F.struct("nth"))).drop("n_hits")
    got = run._merged_in(table, fresh, [F.col("seq.nth")], F.lit("2024-01-01"), ("test", 1))
    whole = merge.merge_into(jobs._placed(old, F.col("nth")), jobs._placed(fresh, F.col("seq.nth")), F.lit("2024-01-01"))
    c = merge.merge_counters(whole).first()
    assert got == {"total": c["total"], "added": c["added"], "updated": c["updated"]}
    cols = ["key", "doi", "title", "cited", "sources", "date_added"]
    assert sorted(map(str, table.read().select(*cols).collect())) == sorted(map(str, whole.select(*cols).collect()))
    stored = table.read().select("nth", "key", "date_added").orderBy("nth").collect()
    assert [r["nth"] for r in stored[:120]] == list(range(120)) and all(r["date_added"] for r in stored[120:]) and len({r["nth"] for r in stored}) == len(stored)
    assert run._merged_in(table, fresh, [F.col("seq.nth")], F.lit("2024-01-01"), ("test", 1))["total"] == c["total"] and table.version() == 2


def test_a_failed_swap_puts_the_old_table_back(spark, tmp_path, monkeypatch):
    at = f"file://{tmp_path}/t"
    tables.overwrite(spark.range(2), at)
    real = tables.Store.move
    with monkeypatch.context() as m:
        m.setattr(tables.Store, "move", lambda self, a, b: real(self, a, b) if ".new-" not in a else (_ for _ in ()).throw(OSError("no")))
        with pytest.raises(OSError):
            tables.overwrite(spark.range(9), at)
    assert spark.read.parquet(at).count() == 2 and [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["t"]


def test_answers_are_kept(spark, site, tmp_path):
    t = cache.open_table(spark, f"file://{tmp_path}/c", 4)
    keys = spark.createDataFrame([("10.9/a",), ("10.9/b",), ("10.9/x",), ("10.9/a",), ("",), (None,)], "key string")
    Busy.broken = {"10.9%2Fx"}
    ask = lambda day: [r["key"] for r in cache.ask(t, keys, "openalex", now=F.lit(f"2024-01-{day:02d}").cast("timestamp"), base=site, pause=0.0, delay=0.0).collect()]
    n = lambda k: Busy.asked[f"/works/doi:10.9%2F{k} "]
    assert ask(1) == ["10.9/a"] and (n("a"), n("b")) == (1, 1) and n("x") > 1  # a failure is tried again at once, and by the next run
    Busy.asked.clear()
    Busy.broken = set()
    assert ask(2) == ["10.9/a"] and (n("a"), n("b"), n("x")) == (0, 0, 1)
    Busy.asked.clear()
    assert ask(3) == ["10.9/a"] and not Busy.asked
    assert ask(10) == ["10.9/a"] and (n("a"), n("b"), n("x")) == (0, 1, 1)  # what was unknown is asked again after a week


def test_scans_go_on_where_they_stopped(spark, site, tmp_path):
    spark.dataSource.register(paged.PagedSource)
    settings, home = jobs.Settings(["q"], min_year=2020), f"file://{tmp_path}"
    Busy.broken = {"/works?per_page=25&page=2", "cursorMark=b"}
    got = run.search(spark, settings, home, 2020, "2024-01-01", base=site, **FAST)
    assert got["failed"] == {"openalex": 2, "europepmc": 1, "europepmc_ack": 1} and got["raw"] == 25 + 200 + 1 and got["total"] == 100 + 1  # the others are too old
    broken = paged.failures(spark.read.schema(paged.SCHEMA).parquet(f"{home}/landed/2024-01-01/europepmc")).first()
    assert broken["page"] == 2 and "500" in broken["error"]
    Busy.asked.clear()
    Busy.broken = set()
    got = run.search(spark, settings, home, 2020, "2024-01-01", base=site, **FAST)
    assert got["failed"] == {} and not Busy.asked["/works 1"] and Busy.asked["/works 2"] == Busy.asked["/works 3"] == 2 and not any(k.startswith("/graph") for k in Busy.asked)
    assert sum(n for k, n in Busy.asked.items() if "europepmc" in k) == 4 and got["total"] == 300 + 1
    Busy.asked.clear()
    assert run.search(spark, settings, home, 2020, "2024-01-01", base=site, **FAST)["added"] == 0 and not Busy.asked


def test_queue_is_emptied_and_says_who_answered(spark, site, tmp_path):
    home = f"file://{tmp_path}"
    (tmp_path / "queue").mkdir()
    put = lambda name, *dois: (tmp_path / "queue" / name).write_text(json.dumps([{"doi": d} for d in dois]))
    put("a.json", "https://doi.org/10.9/A-both", "10.9/a-index", "10.9/none")
    run.submissions(spark, home, base=site, pause=0.0, delay=0.0)
    pubs = {r["key"]: r for r in run.publications(spark, home).read().collect()}
    assert {k: r["sources"] for k, r in pubs.items()} == {"10.9/a-both": ["Crossref", "OpenAlex"], "10.9/a-index": ["OpenAlex"]} and pubs["10.9/a-both"]["search_terms"] == ["Manual submission"]
    Busy.asked.clear()
    put("b.json", "10.9/none", "10.9/a-index", "10.9/new")
    run.submissions(spark, home, base=site, pause=0.0, delay=0.0)
    assert {k.split("10.9%2F")[1].strip() for k in Busy.asked} == {"new"}  # neither what is known nor what was rejected
    assert sorted(r["key"] for r in spark.read.parquet(f"{home}/rejected").collect()) == ["10.9/new", "10.9/none", "10.9/none"]
    assert [p.name for p in (tmp_path / "queue").iterdir() if p.suffix == ".json"] == [] and len(list((tmp_path / "queue-archive").rglob("*.json"))) == 2
    run.submissions(spark, home, base=site, pause=0.0, delay=0.0)
    assert run.publications(spark, home).read().count() == 2


def test_maintenance_asks_for_gaps_only(spark, site, tmp_path):
    home = f"file://{tmp_path}"
    assert run.maintain(spark, home)["total"] == 0
    full = dict(title="T", authors="A", journal="J", subject="S", is_oa="Yes")
    recs = [dict(doi="10.1/full", **full), dict(doi="doi:10.1/FULL", **full | {"title": "Longer"}), dict(doi="10.1/p1-0", **full | {"authors": ""}), dict(doi="10.9/a", **full | {"subject": ""}), dict(doi="10.9/zz", **full | {"title": ""})]
    old = spark.createDataFrame([(*[r[c] for c in ("doi", *full)], i) for i, r in enumerate(recs)], f"doi string, {', '.join(f'{c} string' for c in full)}, nth long")
    table = run.publications(spark, home)
    table.overwrite(merge.keyed(merge.canonical(old, "nth")))
    got = run.maintain(spark, home, base=site, pause=0.0, delay=0.0)
    assert got == {"total": 4, "removed": 1, "filled": 2}
    pubs = {r["key"]: r for r in table.read().collect()}
    assert pubs["10.1/full"]["title"] == "Longer" and pubs["10.1/p1-0"]["authors"] == "A B" and pubs["10.9/a"]["subject"] == "S" and "removed" not in table.read().columns
    assert {k.strip() for k in Busy.asked} == {"/works/10.1%2Fp1-0", "/works/10.9%2Fzz", "/works/doi:10.9%2Fa", "/works/doi:10.9%2Fzz"}


def test_platforms_fail_alone(spark, site, tmp_path):
    spark.dataSource.register(paged.PagedSource)
    home, given = f"file://{tmp_path}", {"base": site, **FAST}
    Busy.broken = {"/dois"}
    got = run.datasets(spark, home, ["c"], ["root1", "root2"], given, stations=f"{site}/nowhere", registry=site, catalogue=site)
    assert [f["platform"] for f in got["failed"]] == ["datacite", "stations"] and (got["total"], got["with_doi"]) == (2, 0)
    got = run.datasets(spark, home, ["c"], ["root1", "root2"], given, stations=site, registry=site, catalogue=site)
    sets = {(r["name"], r["doi"]) for r in Table(spark, f"{home}/datasets").read().collect()}
    assert [f["platform"] for f in got["failed"]] == ["datacite"] and {("Old net", "10.7914/old"), ("New net", "10.7914/new")} <= sets and got["total"] == len(sets) == 4


def test_stations_keep_their_place(spark, site):
    got = rows(lookups.station_networks(spark, site).select("at", "code", "name", "year"))
    assert got == [(0, "7A", "Old net", 2005), (1, "7A", "New net", 2015)]


def test_files_appear_together(spark, tmp_path, monkeypatch):
    (tmp_path / "report.json").write_text("old")
    report.save(spark, f"file://{tmp_path}", {"report.json": "new é", "a.html": "a"})
    assert (tmp_path / "report.json").read_text() == "new é" and (tmp_path / "a.html").read_text() == "a"
    w = together.TogetherWriter(str(tmp_path))
    done = w.write(iter([{"name": "report.json", "content": "x"}, {"name": "b.html", "content": "b"}]))
    (tmp_path / w.beside / "b.html").unlink()  # the second move fails
    with pytest.raises(OSError):
        w.commit([done, None])
    assert (tmp_path / "report.json").read_text() == "new é" and sorted(p.name for p in tmp_path.iterdir()) == ["a.html", "report.json"]
    w = together.TogetherWriter(str(tmp_path))
    w.write(iter([{"name": "c.html", "content": "c"}]))
    w.abort([None])
    assert sorted(p.name for p in tmp_path.iterdir()) == ["a.html", "report.json"]
    with pytest.raises(ValueError):
        w.write(iter([{"name": "../x", "content": ""}]))


@pytest.mark.parametrize("seed", range(2))
def test_interval_counts(spark, seed):
    rnd = random.Random(seed)
    values = [rnd.choice([rnd.randrange(-60, 60), rnd.randrange(-(10**12), 10**12), 7]) for _ in range(400)] + [None]
    spans = [(i, *sorted((rnd.choice([rnd.randrange(-70, 70), rnd.randrange(-(10**13), 10**13)]) for _ in "ab"))) for i in range(80)]
    spans += [(80, 3, 2), (81, None, 5), (82, 7, 7), (83, -(2**62), 2**62 - 1), (84, 7, 7)]
    df = spark.createDataFrame([(v,) for v in values], "x bigint")
    got = intervals.counts(df, spark.createDataFrame(spans, "id int, lo bigint, hi bigint"), "x")
    want = [(i, lo, hi, sum(v is not None and lo is not None and lo <= v <= hi for v in values)) for i, lo, hi in spans]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == want
    assert "NestedLoop" not in got._jdf.queryExecution().toString()
    assert [r["n"] for r in intervals.counts(df.limit(0), spark.createDataFrame(spans[:3], "id int, lo bigint, hi bigint"), "x").collect()] == [0, 0, 0]
    assert intervals.counts(df, spark.createDataFrame([(1, 5, 2)], "id int, lo bigint, hi bigint"), "x").first()["n"] == 0


def test_distinct_counts_add_up(spark):
    rnd = random.Random(3)
    rec = lambda: (f"J{rnd.randrange(9)}", "; ".join(rnd.choices(["A b", "a B", "c", " "], k=2)), "S; T" if rnd.random() < 0.5 else "", [f"i{rnd.randrange(70)}"], ["AU"])
    schema = "journal string, authors string, subject string, institutions array<string>, countries array<string>"
    parts = [spark.createDataFrame([rec() for _ in range(60)] + [(None, None, "", None, [])], schema) for _ in range(2)]
    words = spark.createDataFrame([], distinct.DICTIONARY)
    maps = []
    for p in parts:
        found = distinct.items(p)
        words = distinct.extended(words, found)
        maps.append(distinct.bitmaps(found, words))
    assert words.count() == words.select("code").distinct().count() == words.select("kind", "item").distinct().count()
    got = {r["kind"]: r["n"] for r in distinct.numbers(distinct.united(*maps)).collect()}
    every = distinct.items(parts[0].union(parts[1]))
    assert got == {r["kind"]: r["n"] for r in every.groupBy("kind").agg(F.count_distinct("item").alias("n")).collect()} and set(got) == {"journals", "authors", "subjects", "institutions", "countries"}


def test_scan_frame_equals_the_list(spark):
    settings = jobs.Settings(['a "b"', "c", "d"], min_year=2004)
    got = rows(jobs.scan_frame(settings.frame(spark), 2026, 2004).select("service", "query_idx", "pass", "win", "filter", "years", "pages", "text"))
    want = sorted((n, s.query_idx, s.pass_, s.win, s.filter, s.years, s.pages, s.text) for n, *_ in jobs.ORDER for s in jobs.scans(settings, n, 2026))
    assert got == want


def test_every_record_is_parsed_once(spark):
    from citeforge.sources import geonetwork

    plan = geonetwork.metadata(spark.createDataFrame([("a", "{}")], "id string, record string"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") + plan.lower().count("parsejson") >= 1 and "get_json_object" not in plan


def test_batches_ask_for_their_own_keys(spark, tmp_path):
    (tmp_path / "q").mkdir()
    (tmp_path / "q" / "a.json").write_text('[{"doi": "10.1/a"}, {"doi": "10.1/k"}]')
    seen, empty = [], spark.createDataFrame([], "key string, title string, authors string, journal string, publisher string, type string, year int, cited bigint, subject string, is_oa string")
    ask = lambda keys: seen.append(sorted(r["key"] for r in keys.collect())) or (empty, empty)
    for _ in range(2):
        pending.drained(spark, str(tmp_path / "q"), str(tmp_path / "c"), lambda: spark.sql("SELECT '10.1/k' AS key"), ask, lambda d, n: d.collect(), lambda d, n: d.collect(), str(tmp_path / "arch"))
        (tmp_path / "q" / "b.json").write_text('[{"doi": "10.1/b"}]')
    assert seen == [["10.1/a"], ["10.1/b"]]
