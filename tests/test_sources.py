import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import functions as F

from citeforge.plans import jobs, run
from citeforge.sources import fetch, geonetwork, lookups, paged, payloads


class Handler(BaseHTTPRequestHandler):
    """Pages of 'works', a cursor, a token, and errors by the query's text."""

    busy = 0

    def log_message(self, *_):
        pass

    def answer(self, status, data=None):
        self.send_response(status)
        self.end_headers()
        self.wfile.write(json.dumps(data if data is not None else {}).encode())

    def do_GET(self):
        at, q = urlparse(self.path), parse_qs(urlparse(self.path).query)
        if at.path == "/busy":
            Handler.busy += 1
            return self.answer(*((200, {"ok": 1}) if Handler.busy > 2 else (429,)))
        if at.path == "/gone":
            return self.answer(404)
        if at.path == "/bad":
            return self.answer(400)
        if at.path == "/works":
            n = int(q["page"][0])
            return self.answer(200, {"results": [{"doi": f"https://doi.org/10.1/{q['filter'][0].split('.')[0]}{n}-{i}" if i % 2 else f"https://doi.org/10.1/Same{n}-{i}", "title": "T", "publication_year": 2000} for i in range(25 if n < 2 else 3)]})
        if at.path.startswith("/europepmc"):
            c = q["cursorMark"][0]
            return self.answer(200, {"resultList": {"result": [{"doi": f"10.2/{c}{i}", "title": "E"} for i in range(100)]}, "nextCursorMark": "" if c == "b c" else "b c"})
        if at.path.startswith("/graph"):
            return self.answer(200, {"data": [{"externalIds": {"DOI": f"10.3/{i}"}} for i in range(100)]}) if q["offset"][0] == "0" else self.answer(400)
        if at.path.startswith("/works/doi:"):
            return self.answer(200, {"title": "<i>Index</i>", "doi": "https://doi.org/10.9/a", "publication_year": 2001, "cited_by_count": 4, "type": "article"}) if at.path.endswith("10.9%2Fa") else self.answer(404)
        if at.path.startswith("/works/"):
            return self.answer(200, {"message": {"DOI": "10.9/A", "title": ["Registry"], "is-referenced-by-count": 9}}) if at.path.endswith("10.9%2Fa") else self.answer(500 if at.path.endswith("x") else 404)
        if at.path.endswith("/related"):
            return self.answer(200, {"children": {"root": [{"id": "c1", "title": "One"}, {"@id": "c2", "title": {"en": "Two"}}], "c1": [{"id": "g1", "title": "Grand"}]}.get(at.path.split("/")[-2], [])})
        if "/api/records/" in at.path:
            return self.answer(200, {"gmd:dataSetURI": {"gco:CharacterString": {"#text": f"https://doi.org/10.25914/{at.path.split('/')[-1]}"}}}) if at.path.endswith("c1") else self.answer(403)
        if at.path.startswith("/fdsnws"):
            self.send_response(200)
            self.end_headers()
            return self.wfile.write(b"#Network|Description|Start|End|Total\nAA|First net|2005-01-01T00:00:00||3\nBB|Second|2010-01-01|x|1\nshort|line\n")
        if at.path.startswith("/ws/networks"):
            return self.answer(200, {"networks": [{"fdsn_code": "AA", "doi": "10.7914/aa", "start_date": "2005-01-01"}, {"fdsn_code": "BB"}]})
        if at.path.startswith("/dois"):
            return self.answer(200, {"data": [{"id": "10.5/x", "attributes": {"doi": "10.5/X", "titles": [{"title": "Rocks"}], "publicationYear": 2015}}]})
        self.answer(500)

    def do_POST(self):
        body = self.rfile.read(int(self.headers["Content-Length"])).decode()
        if self.path == "/api/auth":
            return self.answer(200, {"token": "t"}) if json.loads(body)["key"] == "k" else self.answer(401)
        ok = self.headers["Authorization"] == "JWT t" and body.startswith('search publications for "a \\"b\\""')
        self.answer(200, {"publications": [{"doi": "10.4/a"}]}) if ok else self.answer(403)


@pytest.fixture(scope="module")
def site():
    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_fetch(site):
    assert fetch.fetch_json(f"{site}/busy", delay=0) == {"ok": 1} and Handler.busy == 3
    assert fetch.fetch_json(f"{site}/gone") == {}
    with pytest.raises(OSError):
        fetch.fetch_json(f"{site}/bad", delay=0)
    with pytest.raises(OSError):
        fetch.fetch_json(f"{site}/else", retries=1, delay=0)


SETTINGS = jobs.Settings(['a "b"', "c"], min_year=2019)


def test_scans(tmp_path):
    first, rest = (jobs.scans(SETTINGS, "openalex", 2026)[k] for k in (0, -1))
    assert (first.years, first.pages, rest.query_idx, rest.years, rest.pages) == (",publication_year:2019-2023", 20, 1, "", 2)
    assert [s.text for s in jobs.scans(SETTINGS, "europepmc_ack", 2026)] == ['ACK_FUND:"a b"'] and [s.pages for s in jobs.scans(SETTINGS, "europepmc", 2026)] == [5, 2]
    (tmp_path / "c.json").write_text('{"search_queries": ["x"], "min_year": 2001, "other": 1}')
    assert jobs.Settings.load(str(tmp_path / "c.json")) == jobs.Settings(["x"], 2001)


def test_paged_harvest(spark, site, tmp_path):
    spark.dataSource.register(paged.PagedSource)
    got = {n: jobs.land(spark, SETTINGS, n, 2026, str(tmp_path / n), key="k", base=site, pause="0", delay="0") for n in ("openalex", "semantic_scholar", "europepmc", "dimensions")}
    assert {n: d.count() for n, d in got.items()} == {"openalex": 2 * 2 * 28 + 2 * 28, "semantic_scholar": 100, "europepmc": 400, "dimensions": 1}
    assert jobs.land(spark, SETTINGS, "core", 2026, str(tmp_path / "core"), base=site).count() == 0
    assert jobs.land(spark, SETTINGS, "dimensions", 2026, str(tmp_path / "no"), key="wrong", base=site).count() == 0
    queries = SETTINGS.frame(spark)
    assert [tuple(r) for r in queries.select("label", "primary").collect()] == [("a b", True), ("c", False)]
    hits = jobs.hits(got, queries)
    alex = hits.where(F.array_contains("sources", "OpenAlex"))
    assert alex.where("seq.query_idx = 1").count() == 28 + 13 and alex.where("seq.query_idx = 0").count() == 2 * 28 + 13  # second passes add what is new
    existing = spark.createDataFrame([("10.3/5", 0), ("10.9/x", 1), ("", 2)], "doi string, nth long")
    merged, counts = jobs.harvest_run(got, queries, existing, F.lit("2026-01-02"), 1997)
    c = counts.first()
    assert c["raw"] == c["filtered"] == hits.count() and c["total"] == c["added"] + 3 and c["updated"] == 1
    stored = jobs.numbered(merged).orderBy("nth").collect()
    assert [r["doi"] for r in stored[:3]] == ["10.3/5", "10.9/x", ""] and stored[0]["sources"] == ["Semantic Scholar"] and stored[3]["search_terms"] == ["a b", "c"] and str(stored[3]["date_added"]) == "2026-01-02"


RECORD = {
    "gmd:dataSetURI": {"gco:CharacterString": {"#text": "see https://doi.org/10.25914/abc-12"}},
    "gmd:identificationInfo": {"gmd:MD_DataIdentification": {"gmd:citation": {"gmd:CI_Citation": {
        "gmd:citedResponsibleParty": [
            {"gmd:CI_ResponsibleParty": {"gmd:role": {"gmd:CI_RoleCode": {"@codeListValue": "author"}}, "gmd:individualName": {"gco:CharacterString": {"#text": "A"}}}},
            {"gmd:CI_ResponsibleParty": {"gmd:role": {"gmd:CI_RoleCode": {"@codeListValue": "publisher"}}, "gmd:individualName": {"gco:CharacterString": "P"}}},
            {"gmd:CI_ResponsibleParty": {"gmd:role": {"gmd:CI_RoleCode": {"@codeListValue": "originator"}}, "gmd:individualName": {"gco:CharacterString": ""}, "gmd:organisationName": {"gco:CharacterString": "O"}}},
        ],
        "gmd:date": {"gmd:CI_Date": {"gmd:date": {"gco:Date": {"#text": "2012-03-04"}}}},
    }}}},
}


def test_catalogue(spark):
    alone = {"x": "10.25914/zz-9", "gmd:identificationInfo": {"gmd:MD_DataIdentification": {"gmd:citation": {"gmd:CI_Citation": {"gmd:citedResponsibleParty": RECORD["gmd:identificationInfo"]["gmd:MD_DataIdentification"]["gmd:citation"]["gmd:CI_Citation"]["gmd:citedResponsibleParty"][0]}}}}}
    raw = spark.createDataFrame([("u1", json.dumps(RECORD)), ("u2", json.dumps(alone)), ("u3", "{}"), ("u4", None), ("u5", "not json")], "id string, record string")
    got = {r["id"]: (r["doi"], r["authors"], r["year"]) for r in geonetwork.metadata(raw).collect()}
    assert got == {"u1": ("10.25914/abc-12", "A, O", 2012), "u2": ("10.25914/zz-9", "A", None), "u3": ("", "", None), "u4": ("", "", None), "u5": ("", "", None)}
    lists = [("r", {"children": [{"id": "u1", "title": {"fr": "F", "eng": "E"}}, {"@id": "u2", "title": "plain"}, {"id": "u3", "title": "", "defaultTitle": "D"}]}), ("u1", {"children": {"id": "g", "title": {"fr": "F"}}}), ("u2", {})]
    edges = geonetwork.children(spark.createDataFrame([(p, json.dumps(r)) for p, r in lists], "parent string, record string"))
    rows, counts = jobs.inventory_run([jobs.catalogue(edges, geonetwork.metadata(raw), F.lit("r")), jobs.catalogue(edges, geonetwork.metadata(raw), F.lit("r"))])
    assert [(r["name"], r["doi"], r["uuid"]) for r in rows.orderBy("at").collect()] == [("E", "10.25914/abc-12", "u1"), ("F", "", "g"), ("plain", "10.25914/zz-9", "u2"), ("D", "", "u3")]
    assert tuple(counts.first()) == (4, 2)


def test_station_identifiers(spark):
    lines = spark.createDataFrame([("#h|d|s|e|n",), ("1A|One|2010-01-01|x|5",), ("1A|Two|2015-01-01|x|5",), ("2B|Three||x|5",)], "value string")
    nets = spark.createDataFrame([("1A", "2010-05-01", "10.7/a", 0), ("1A", "2012-01-01", "10.7/b", 1), ("1A", "", "", 2), ("2B", None, "10.7/c", 3)], payloads.NETWORKS.replace("fdsn_code string, start_date string, doi string", "fdsn_code string, start_date string, doi string, seq int"))
    got = {r["name"]: r["doi"] for r in jobs.seismic(payloads.station_networks(lines), payloads.network_registry(nets)).collect()}
    assert got == {"One": "10.7/a", "Two": "10.7/b", "Three": "10.7/c"}


def test_projection_corners(spark):
    one = lambda name, row, **kw: payloads.READERS[name](payloads.read_records(spark.createDataFrame([(json.dumps(row),)], "record string"), payloads.SCHEMAS[name]), **kw).first()
    a = one("openalex", {"doi": "https://doi.org/10.1/x", "title": "T", "publication_year": 0, "authorships": [{"author": {"display_name": "A"}}, {"author": {}}], "open_access": {}}, lookup=True)
    assert (a["is_oa"], a["year"], a["authors"]) == ("No", None, "A; ") and one("openalex", {"doi": "10.1/x"}, lookup=True) is None
    c = one("crossref", {"message": {"DOI": "10.1/C", "title": "T", "published-print": {"date-parts": []}, "published-online": {"date-parts": [[2011]]}}})
    assert (c["year"], c["title"]) == (2011, "T")
    assert one("crossref", {"message": {"DOI": "10.1/C", "published-print": {"date-parts": [[None]]}, "published-online": {"date-parts": [[2011]]}}})["year"] is None
    assert one("dimensions", {"doi": "d", "title": "<b>x</b>", "authors": [{"first_name": "F", "full_name": "Full"}, {"last_name": "L"}]})["authors"] == "Full"
    assert one("core", {"doi": "HTTPS://DOI.org/10.1/k", "yearPublished": 0, "publishedDate": "2007"})["doi"] == "10.1/k"


def test_maintenance(spark):
    rows = spark.createDataFrame([("10.1/a", "", "A", 1), ("doi:10.1/A", "long", "", 2), ("", "x", "", 3)], "doi string, title string, authors string, nth int").withColumn("seq", F.struct("nth")).drop("nth")
    look = "key string, title string, authors string, journal string, publisher string, type string, year int, cited bigint, subject string, is_oa string"
    registry = spark.createDataFrame([("10.1/a", "R", "R", "J", "P", "t", 2001, 4, "S", "Unknown")], look)
    done, counts = jobs.maintain_run(rows, registry, registry.limit(0))
    r = done.first()
    assert (r["title"], r["authors"], r["journal"], r["cited"], r["is_oa"]) == ("long", "A", "J", 4, "Unknown") and tuple(counts.first()) == (1, 1, 1)


def test_lookups(spark, site, tmp_path):
    keys = spark.createDataFrame([("10.9/a",), ("10.9/b",), ("10.9/x",), ("",), (None,)], "key string")
    registry, index = lookups.publications(keys, f"file://{tmp_path}", base=site, pause=0.0, delay=0.0)
    assert [(r["key"], r["title"], r["cited"]) for r in registry.collect()] == [("10.9/a", "Registry", 9)]
    assert [(r["key"], r["title"], r["year"]) for r in index.collect()] == [("10.9/a", "Index", 2001)]
    counts = lookups.citation_counts(keys.where("key <> ''"), f"file://{tmp_path}", base=site, pause=0.0, delay=0.0)
    assert {r["key"]: r["cited"] for r in counts.collect()} == {"10.9/a": 4, "10.9/b": 0, "10.9/x": 0}
    assert lookups.network_registry(spark, f"{site}/nowhere").count() == 0


def test_runs_end_to_end(spark, site, tmp_path):
    spark.dataSource.register(paged.PagedSource)
    home = f"file://{tmp_path}/home"
    settings = jobs.Settings(queries=["one"], primary_max_pages=1)
    for n in range(2):  # the second run finds all of it there
        got = run.search(spark, settings, home, 2000, "2024-05-06", base=site, pause="0", delay="0")
        assert got["raw"] > 0 and got["added"] == (got["total"] if n == 0 else 0)
    sets = run.datasets(spark, home, ["client"], "root", {"base": site, "pause": "0"}, stations=site, registry=site, catalogue=site)
    assert sets["total"] == 6 and sets["with_doi"] == 3
    (tmp_path / "home" / "queue").mkdir()
    (tmp_path / "home" / "queue" / "q.json").write_text('[{"doi": "https://doi.org/10.9/A"}, {"doi": "10.9/none"}]')
    run.submissions(spark, home, base=site, pause=0.0, delay=0.0)
    pubs = {r["doi"]: r for r in run.publications(spark, home).read().collect()}
    assert len(pubs) == got["total"] + 1 and pubs["10.9/a"]["title"] == "Registry" and pubs["10.9/a"]["cited"] == 9
    assert [r["key"] for r in spark.read.parquet(f"{home}/rejected").collect()] == ["10.9/none"]
    data = run.publish(spark, home, "2024-05-06T07:08:09Z")
    assert data["stats"]["publications"] == len(pubs) and data["stats"]["datasets"] == 6
    assert "6 May 2024" in (tmp_path / "home" / "index.html").read_text() and json.loads((tmp_path / "home" / "report.json").read_text())["stats"] == data["stats"]
