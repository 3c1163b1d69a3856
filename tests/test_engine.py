import random

import pytest
from pyspark.sql import functions as F

from citeforge.functions import scalars as S
from citeforge.operators import merge, metrics
from citeforge.plans import catalog, report
from citeforge.plans.ticks import nice_ticks
from citeforge.sources import payloads, tables
from citeforge.streaming import pending


def one(spark, text, f):
    return spark.createDataFrame([(text,)], "x string").select(f(F.col("x"))).first()[0]


def test_scalars(spark):
    assert one(spark, "HTTPS://doi.org/10.1/AB ", S.normalise_doi) == "10.1/ab"
    assert one(spark, " doi:10.1/x", S.normalise_doi) == "doi:10.1/x"
    assert one(spark, None, S.normalise_doi) == ""
    assert one(spark, "<b>a</b>  b ", S.strip_html) == "a b"
    assert one(spark, "2020abc", S.int_prefix) == 2020
    assert one(spark, "abc", S.int_prefix) is None
    assert one(spark, "see https://doi.org/10.1234/a-b, ok", S.find_doi) == "10.1234/a-b"
    assert one(spark, '<a href="x">&', S.html_escaped) == "&lt;a href=&quot;x&quot;&gt;&amp;"
    assert one(spark, "a b&c", S.url_component) == "a%20b%26c"
    assert one(spark, "JournalArticle", S.camel_split) == "journal article"


def fold(rows):
    """The merge as an ordered loop."""
    out = {}
    for r in sorted(rows, key=lambda r: r["seq"]):
        k = (r["doi"] or "").lower().removeprefix("doi:").strip()
        if not k:
            continue
        if k not in out:
            out[k] = dict(r, sources=list(dict.fromkeys(r["sources"])))
            continue
        t = out[k]
        t["sources"] += [s for s in dict.fromkeys(r["sources"]) if s not in t["sources"]]
        t["cited"] = max(t["cited"], r["cited"])
        if len(r["title"]) > len(t["title"]):
            t["title"] = r["title"]
        t["year"] = t["year"] or r["year"]
        if t["is_oa"] == "Unknown":
            t["is_oa"] = r["is_oa"]
        if len(r["institutions"]) > len(t["institutions"]):
            t["institutions"] = r["institutions"]
    return out


@pytest.mark.parametrize("seed", range(3))
def test_merge_follows_the_order(spark, seed):
    rnd = random.Random(seed)
    rows = [
        {"seq": i, "doi": rnd.choice(["", "doi:", ""]) + rnd.choice(["10.1/A", "10.1/a", "10.1/b", "10.1/c "]) if rnd.random() < 0.9 else "", "title": rnd.choice(["", "x", "yy", "zz", "Untitled"]), "year": rnd.choice([None, 0, 1999, 2001]),
         "cited": rnd.randrange(9), "is_oa": rnd.choice(["Unknown", "Yes", "No"]), "sources": rnd.choices("abc", k=2), "institutions": rnd.choices("pq", k=rnd.randrange(3))}
        for i in range(60)
    ]
    schema = "seq int, doi string, title string, year int, cited bigint, is_oa string, sources array<string>, institutions array<string>"
    df = spark.createDataFrame([tuple(r[c.split()[0]] for c in schema.split(", ")) for r in rnd.sample(rows, len(rows))], schema).withColumn("seq", F.struct("seq"))
    got = {r["key"]: r for r in merge.merge_hits(df).collect()}
    want = fold(rows)
    assert got.keys() == want.keys()
    for k, w in want.items():
        for c in ("doi", "title", "cited", "is_oa", "sources", "institutions"):
            assert got[k][c] == w[c], (k, c)
        assert (got[k]["year"] or 0) == (w["year"] or 0)


def pubs(spark, n=40):
    rows = [(f"10.1/{i}", f"T{i}", "A; B" if i % 2 else "b", f"J{i % 3}" if i % 4 else "", 2000 + i % 5 * 2 if i % 7 else None, i * 3, "Geology; Rocks" if i % 3 else "", [f"I{i % 6}"], ["AU"]) for i in range(n)]
    return spark.createDataFrame(rows, "doi string, title string, authors string, journal string, year int, cited bigint, subject string, institutions array<string>, countries array<string>")


def test_metrics_invariants(spark):
    p = pubs(spark)
    s = metrics.summary(p).first()
    years = metrics.by_year(p).orderBy("year").collect()
    assert s["publications"] == 40 and [y["year"] for y in years] == list(range(2000, 2009))
    assert years[-1]["cumulative"] == sum(y["count"] for y in years) == p.where("year is not null").count()
    assert sum(b["count"] for b in metrics.citation_buckets(p).collect()) == 40
    assert metrics.top_subjects(p, ["doi"]).collect()[0]["topic"] == "Rocks"
    assert metrics.distinct_authors(p).first()[0] == 2
    empty = p.limit(0)
    assert metrics.by_year(empty).count() == 0 and metrics.summary(empty).first()["year_range"] == "N/A"


def test_report_and_ticks(spark):
    data = report.report(pubs(spark), spark.range(3), ["doi"], "2026-01-01")
    assert data["stats"]["datasets"] == 3 and "<svg" in report.dashboard(data) and "card" in report.widget(data)
    assert '"generated"' in report.to_json(data)
    assert nice_ticks(21096) == [0, 5000, 10000, 15000, 20000] and nice_ticks(0) == [0]


def test_payloads(spark):
    one = lambda name, row: payloads.READERS[name](spark.read.schema(payloads.SCHEMAS[name]).json(spark.sparkContext.parallelize([row]))).first()
    a = one("openalex", '{"doi":"https://doi.org/10.1/X","title":"<i>T</i>","publication_year":2001,"authorships":[{"author":{"display_name":"A"},"institutions":[{"display_name":"I","country_code":"AU"}]},{"author":{"display_name":"B"},"institutions":[{"display_name":"I"}]}],"type":"book-chapter","topics":[{"display_name":"p"}]}')
    assert (a["doi"], a["title"], a["authors"], a["type"], a["is_oa"], a["institutions"], a["countries"], a["author_count"]) == ("10.1/X", "T", "A; B", "book chapter", "No", ["I"], ["AU"], 2)
    c = one("crossref", '{"message":{"DOI":"10.1/C","title":["A title"],"author":[{"given":"G","family":"F"}],"published-online":{"date-parts":[[2011]]},"container-title":["J"]}}')
    assert (c["title"], c["authors"], c["year"], c["journal"], c["is_oa"]) == ("A title", "G F", 2011, "J", "Unknown")
    e = one("europepmc", '{"doi":"10.1/e","title":"T","authorString":"X, Y","pubYear":"2020abc","isOpenAccess":"Y","keywordList":{"keyword":["k"]}}')
    assert (e["authors"], e["year"], e["is_oa"], e["subject"]) == ("X, Y", 2020, "Yes", "k")
    s = one("semantic_scholar", '{"title":"T","externalIds":{"DOI":"10.1/s"},"publicationTypes":["JournalArticle"],"s2FieldsOfStudy":[{"category":"A"},{"category":"A"}],"openAccessPdf":{"url":"u"}}')
    assert (s["type"], s["subject"], s["is_oa"]) == ("journal article", "A", "Yes")
    k = one("core", '{"doi":"http://doi.org/10.1/k","authors":["A",{"name":"B"}],"publishedDate":"2007-01-01"}')
    assert (k["doi"], k["authors"], k["year"], k["is_oa"], k["title"]) == ("10.1/k", "A; B", 2007, "Yes", "Untitled")
    d = one("dimensions", '{"doi":"10.1/d","authors":[{"first_name":"F","last_name":"L"},{"full_name":"Z"},{}],"category_for":[{"name":""},{"name":"b"},{"name":"c"},{"name":"d"}]}')
    assert (d["authors"], d["subject"], d["is_oa"]) == ("F L; Z", "b; c", "No")
    st = payloads.station_networks(spark.createDataFrame([("#c|d|s|e|n",), ("1A|Net|2010-01-01|2011|5",), ("bad|line",)], "value string")).collect()
    assert [(r["code"], r["year"]) for r in st] == [("1A", 2010)]


def test_envelope_overwrite_and_queue(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"metadata": {}, "records": [{"doi": "10.1/a"}]}')
    assert payloads.envelope(spark, str(tmp_path / "p.json"), "doi string, year int").first()["doi"] == "10.1/a"
    assert payloads.envelope(spark, str(tmp_path / "none.json"), "doi string").count() == 0
    at = str(tmp_path / "t")
    tables.overwrite(spark.range(3), at)
    tables.overwrite(spark.read.parquet(at).where("id > 0"), at)
    assert spark.read.parquet(at).count() == 2
    (tmp_path / "q").mkdir()
    (tmp_path / "q" / "a.json").write_text('[{"doi": "10.1/a"}, {"doi": "doi:10.1/b"}, {"doi": "10.1/zz"}]')
    look = spark.createDataFrame([("10.1/b", "T", "A", "J", "P", "book", 2001, 5, "S", "Yes")], "key string, title string, authors string, journal string, publisher string, type string, year int, cited bigint, subject string, is_oa string")
    got, lost = [], []
    for _ in range(2):
        pending.drain(spark, str(tmp_path / "q"), str(tmp_path / "c"), lambda: spark.createDataFrame([("10.1/a",)], "key string"), lambda: (look, look.limit(0)), lambda d: got.extend(r["key"] for r in d.collect()), lambda d: lost.extend(r["key"] for r in d.collect()))
    assert got == ["10.1/b"] and lost == ["10.1/zz"]


def test_contract():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and "by_year_cumulative" in e.queries()


def test_updated_compares_lists_not_their_lengths(spark):
    seq = "struct(1L AS p)"
    old = spark.sql(f"SELECT '10.1/a' AS doi, array('X', 'X') AS sources, {seq} AS seq UNION ALL SELECT '10.1/b', array('X', 'X'), {seq}")
    new = spark.sql(f"SELECT '10.1/a' AS doi, array('Y') AS sources, {seq} AS seq UNION ALL SELECT '10.1/b', array('X'), {seq}")
    got = {r["key"]: (r["sources"], r["updated"]) for r in merge.merge_into(old, new, F.current_date()).collect()}
    assert got == {"10.1/a": (["X", "Y"], True), "10.1/b": (["X"], False)}


def test_a_hot_key_is_gathered_by_its_lists(spark):
    hits = spark.range(200_000).selectExpr("'10.1/hot' AS doi", "struct(id AS p) AS seq", "array(concat('s', id % 3)) AS sources", "array('t') AS search_terms", "concat('t', id % 7) AS title")
    r = merge.merge_hits(hits).first()
    assert r["n_hits"] == 200_000 and r["sources"] == ["s0", "s1", "s2"] and r["search_terms"] == ["t"] and r["title"] == "t0"


def test_unicode_blanks_and_unknown_counts(spark):
    pubs = spark.createDataFrame([("a b", None), ("\ta b", 0), ("a b ", 3), (" ;", 7)], "authors string, cited bigint")
    assert metrics.distinct_authors(pubs).first()["authors"] == 1
    assert [r["count"] for r in metrics.citation_buckets(pubs).orderBy("nth").collect()][:3] == [2, 1, 1]


def test_queue_may_feed_the_table_that_it_reads(spark, tmp_path):
    at = lambda n: f"file://{tmp_path}/{n}"
    pending.drain(spark, at("none"), at("c0"), None, None, None, None)  # no folder: nothing to do
    (tmp_path / "q").mkdir()
    (tmp_path / "q" / "a.json").write_text('[{"doi": "10.1/A"}, {"doi": "10.1/b"}, {"doi": "10.1/k"}]')
    (tmp_path / "q" / "b.json").write_text("no json")
    tables.overwrite(spark.sql("SELECT '10.1/k' AS key"), at("known"))
    registry = spark.sql("SELECT '10.1/a' AS key, 'T' AS title, '' AS authors, '' AS journal, '' AS publisher, '' AS type, '' AS subject, 2000 AS year, 1 AS cited, 'Yes' AS is_oa")
    rejects = []
    accept = lambda df: tables.overwrite(spark.read.parquet(at("known")).unionByName(df.select("key")), at("known"))
    pending.drain(spark, at("q"), at("c"), lambda: spark.read.parquet(at("known")), lambda: (registry, registry.limit(0)), accept, lambda df: rejects.extend(r["key"] for r in df.collect()))
    assert sorted(r["key"] for r in spark.read.parquet(at("known")).collect()) == ["10.1/a", "10.1/k"] and rejects == ["10.1/b"]


def _read(df):
    """How often the plan of df reads and shuffles what is not shared with another part of it."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("ReusedExchange"), plan.count("Window ["), plan.count("FileScan")


def test_folds_share_the_shuffles_of_their_joins(spark, tmp_path):
    least = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan shows what is shared before it runs
    try:
        for f in (catalog.merge_hits, catalog.maintain_dedup):
            assert _read(f(spark, "/root/testdata/sf0.001")) == (2, 0, 5)
        assert _read(catalog.merge_into_existing(spark, "/root/testdata/sf0.001"))[1:] == (1, 6)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", least)
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_counters_carry_only_what_they_need(spark):
    """A merge's counters read no texts, and its two uses of the new hits share their shuffles."""
    least = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan shows what is shared before it runs
    try:
        counters = catalog.merge_counters(spark, "/root/testdata/sf0.001")
        assert _read(counters)[1:] == (1, 6)
        assert not any(c in counters._jdf.queryExecution().executedPlan().toString() for c in ("p_name", "p_type", "c_name", "s_name", "o_orderdate", "l_quantity"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", least)
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("seed", range(2))
def test_merge_into_folds_new_hits_into_the_last_row(spark, seed):
    """Against the fold of the last row of each key with its new hits, one after the other."""
    rnd = random.Random(seed)
    schema = "seq int, doi string, title string, year int, cited bigint, is_oa string, sources array<string>, institutions array<string>"
    names = [c.split()[0] for c in schema.split(", ")]
    rows = [(i, rnd.choice(["10.1/A", "10.1/b", "doi:10.1/a ", "10.1/c", "10.1/d", ""]), rnd.choice(["", "x", "yy", "zz"]), rnd.choice([None, 0, 1999, 2001]), rnd.randrange(9), rnd.choice(["Unknown", "Yes", "No"]), rnd.choices("abc", k=2), rnd.choices("pq", k=rnd.randrange(3))) for i in range(24)]
    df = spark.createDataFrame(rows, schema).withColumn("seq", F.struct("seq"))
    got = merge.merge_into(df.where("seq.seq < 10"), df.where("seq.seq >= 10"), F.current_date()).collect()
    dicts = [dict(zip(names, r)) for r in rows]
    key = lambda r: r["doi"].lower().removeprefix("doi:").strip()
    last = {key(r): r["seq"] for r in dicts[:10] if key(r)}
    folds = fold([r for r in dicts if r["seq"] >= 10 or last.get(key(r)) == r["seq"]])
    passed = [r for r in dicts[:10] if last.get(key(r)) != r["seq"]]
    shown = lambda r, k, added, updated: (k, r["doi"], r["title"], r["year"], r["cited"], r["is_oa"], tuple(r["sources"]), tuple(r["institutions"]), added, updated)
    want = [shown(r, key(r), False, False) for r in passed]
    for k, r in folds.items():
        had = set(dicts[last[k]]["sources"]) if k in last else set()
        want.append(shown(dict(r, year=r["year"] or None), k, k not in last, k in last and len(r["sources"]) > len(had)))
    assert sorted(map(repr, want)) == sorted(repr(shown(r, r["key"], r["added"], r["updated"])) for r in got)
    assert all((r["o"]["is_new"] == 1) == r["added"] == (r["date_added"] is not None) for r in got)
