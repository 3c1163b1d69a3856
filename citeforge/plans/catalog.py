"""The engine's operators as queries over the driver's tables, each with the DuckDB SQL of its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import distinct, enrich, harvest, intervals, inventory, merge, metrics
from ..sources import geonetwork, lookups, payloads, tables
from ..sources.snapshots import Table
from ..sources.staging import new_path, staged
from ..streaming import pending
from . import jobs
from .ticks import axis_ticks

GENERIC = ("promo anodized", "brand#12")
SEQ = ["seq1", "seq2", "seq3", "seq4"]

#: A bibliographic view of the tables that reads alike in Spark SQL and DuckDB: an order is a publication, a line item a hit.
RAW = """
SELECT l.l_linenumber AS seq1, l.l_partkey AS seq2, l.l_suppkey AS seq3, l.l_extendedprice AS seq4, l.l_orderkey AS orderkey,
  CASE l.l_linenumber % 4
    WHEN 0 THEN concat('https://doi.org/10.5555/ORD.', CAST(l.l_orderkey AS STRING))
    WHEN 1 THEN concat('doi:10.5555/Ord.', CAST(l.l_orderkey AS STRING), ' ')
    WHEN 2 THEN concat('10.5555/ord.', CAST(l.l_orderkey AS STRING))
    ELSE CASE WHEN l.l_orderkey % 10 = 0 THEN '' ELSE concat('http://doi.org/10.5555/ord.', CAST(l.l_orderkey AS STRING)) END
  END AS doi,
  CASE WHEN l.l_partkey % 11 = 0 THEN '' ELSE p.p_name END AS title,
  c.c_name AS authors, CASE WHEN l.l_partkey % 13 = 0 THEN '' ELSE p.p_brand END AS journal, c.c_mktsegment AS publisher, o.o_orderpriority AS type,
  CASE WHEN l.l_partkey % 7 = 0 THEN NULL ELSE CAST(year(o.o_orderdate) AS INT) END AS year,
  CAST(l.l_quantity AS BIGINT) AS cited,
  CASE l.l_returnflag WHEN 'A' THEN 'Yes' WHEN 'N' THEN 'No' ELSE 'Unknown' END AS is_oa,
  CASE WHEN l.l_partkey % 17 = 0 THEN '' ELSE concat(p.p_type, '; ', p.p_brand) END AS subject,
  CASE l.l_linenumber % 3 WHEN 0 THEN 'OpenAlex' WHEN 1 THEN 'Europe PMC' ELSE 'Crossref' END AS source,
  l.l_linestatus AS term, CAST(l.l_linenumber AS INT) AS author_count,
  l.l_partkey % 3 AS n_inst, s.s_name AS inst1, concat(s.s_name, '-', CAST(l.l_partkey % 5 AS STRING)) AS inst2
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey JOIN {part} p ON l.l_partkey = p.p_partkey
JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {supplier} s ON l.l_suppkey = s.s_suppkey
"""
#: RAW's joins as Spark runs them: customers go to the fewer orders, and line items meet orders last, so hits of one order lie together and fold before they are shuffled.
JOINS = """
FROM {lineitem} l JOIN {supplier} s ON l.l_suppkey = s.s_suppkey JOIN {part} p ON l.l_partkey = p.p_partkey
JOIN ({orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey) ON l.l_orderkey = o.o_orderkey
"""
#: Always true, and asks the last join for these columns: uses of the hits that need some only then share its shuffles with those that need all.
SHARED = "AND hash({}) % 2 < 2"
#: What identifiers, lists and order of records are made of, which is all that a merge's counters need; and what whole records are.
#: A column of the orders is among them, as a condition on line items alone would leave the last join.
COUNTED = "l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice, l.l_linestatus, o.o_orderkey"
WHOLE = f"{COUNTED}, l.l_quantity, l.l_returnflag, p.p_name, p.p_brand, p.p_type, s.s_name, c.c_name, c.c_mktsegment, o.o_orderpriority, o.o_orderdate"
KEY = "trim(regexp_replace(regexp_replace(lower(doi), '^https?://doi[.]org/', ''), '^doi:', ''))"
DUCK_RAW = RAW.format(lineitem="lineitem", orders="orders", part="part", customer="customer", supplier="supplier")
O = "ORDER BY seq1, seq2, seq3, seq4"  # noqa: E741


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_hits(spark: SparkSession, sf_dir: str, shared: str = "") -> DataFrame:
    names = ("lineitem", "orders", "part", "customer", "supplier")
    return spark.sql(RAW[: RAW.index("FROM {lineitem}")] + JOINS + (SHARED.format(shared) if shared else ""), **{n: _t(spark, sf_dir, n) for n in names})


def hits(spark: SparkSession, sf_dir: str, shared: str = WHOLE) -> DataFrame:
    raw = raw_hits(spark, sf_dir, shared)
    inst = F.when(F.col("n_inst") == 0, F.array().cast("array<string>")).when(F.col("n_inst") == 1, F.array("inst1")).otherwise(F.array("inst1", "inst2"))
    return raw.withColumns({"seq": F.struct(*SEQ), "sources": F.array("source"), "search_terms": F.array("term"), "institutions": inst, "countries": F.array(F.substring("inst1", -2, 2))})


def pubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_hits(hits(spark, sf_dir))


def _flat(df: DataFrame) -> DataFrame:
    """Arrays as joined strings, the struct of the order dropped."""
    lists = [c for c, t in df.dtypes if t == "array<string>"]
    return df.withColumns({c: F.array_join(c, "; ") for c in lists}).drop("seq", "o", "date_added")


def _fold_sql(src: str, order: str, maintain: bool = False, extra: str = "") -> str:
    """A merge of ``src`` (raw columns and key) by key in DuckDB; order is an ORDER BY clause."""
    by = order.removeprefix("ORDER BY ")
    inst = "CASE n_inst WHEN 0 THEN '' WHEN 1 THEN inst1 ELSE inst1 || '; ' || inst2 END"
    texts = ", ".join(f"first({t} ORDER BY length({t}) DESC, {by}) AS {t}" for t in merge.TEXTS)
    lists = (
        f"first({inst} {order}) AS institutions, first(right(inst1, 2) {order}) AS countries, first(author_count {order}) AS author_count"
        if maintain
        else f"first({inst} ORDER BY n_inst DESC, {by}) AS institutions, first(right(inst1, 2) {order}) AS countries, max(author_count) AS author_count"
    )
    return f"""
SELECT m.key, m.* EXCLUDE (key), s.sources, t.search_terms FROM (
  SELECT key, first(doi {order}) AS doi, {texts}, first(year {order}) FILTER (WHERE year IS NOT NULL AND year <> 0) AS year, max(cited) AS cited,
    coalesce(first(is_oa {order}) FILTER (WHERE is_oa <> 'Unknown'), 'Unknown') AS is_oa, {lists}{extra}
  FROM {src} GROUP BY key) m
JOIN (SELECT key, string_agg(v, '; ' ORDER BY o) AS sources FROM (SELECT key, source AS v, min(row({by})) AS o FROM {src} GROUP BY key, source) GROUP BY key) s ON s.key = m.key
JOIN (SELECT key, string_agg(v, '; ' ORDER BY o) AS search_terms FROM (SELECT key, term AS v, min(row({by})) AS o FROM {src} GROUP BY key, term) GROUP BY key) t ON t.key = m.key
"""


DUCK_KEYED = f"raw AS ({DUCK_RAW}), keyed AS (SELECT *, {KEY} AS key FROM raw), full_key AS (SELECT * FROM keyed WHERE key <> '')"
DUCK_PUBS = f"{DUCK_KEYED}, pub AS ({_fold_sql('full_key', O, extra=', count(*) AS n_hits, min(row(seq1, seq2, seq3, seq4)) AS seq')})"
_REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {}


def query(sql: str):
    def add(f):
        _REGISTRY[f.__name__.lstrip("_")] = (f, sql)
        return f

    return add


@query(f"WITH {DUCK_KEYED} SELECT orderkey, seq1, seq2, seq3, doi, key FROM full_key")
def normalise_key(spark, sf_dir):
    return raw_hits(spark, sf_dir).withColumn("key", S.normalise_doi(F.col("doi"))).where("key <> ''").select("orderkey", "seq1", "seq2", "seq3", "doi", "key")


@query(r"SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]*>', '', 'g'), '\s+', ' ', 'g')) AS text FROM pages")
def strip_html(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", S.strip_html(F.col("html")).alias("text"))


@query(r"""SELECT p_partkey, trim(regexp_replace(replace(concat('"', p_name, '"  ', p_brand), '"', ''), '\s+', ' ', 'g')) AS label, lower(trim(regexp_replace(p_type, '([A-Z])', ' \1', 'g'))) AS words,
  replace(p_name, ' ', '-') AS dashed, replace(replace(p_type, '-', ' '), '"', '') AS kind FROM part""")
def label_cleanup(spark, sf_dir):
    quoted = F.concat(F.lit('"'), "p_name", F.lit('"  '), "p_brand")
    return _t(spark, sf_dir, "part").select(
        "p_partkey", S.query_label(quoted).alias("label"), S.camel_split(F.col("p_type")).alias("words"), F.replace("p_name", F.lit(" "), F.lit("-")).alias("dashed"), S.quotes_dropped(S.hyphens_to_blanks(F.col("p_type"))).alias("kind")
    )


@query(r"SELECT o_orderkey, TRY_CAST(nullif(regexp_extract(o_orderpriority, '^\s*([+-]?\d+)', 1), '') AS INT) AS priority FROM orders")
def parse_int_prefix(spark, sf_dir):
    return _t(spark, sf_dir, "orders").select("o_orderkey", S.int_prefix(F.col("o_orderpriority")).alias("priority"))


@query(rf"""WITH {DUCK_KEYED} SELECT orderkey, seq1, seq2, seq3, CASE WHEN starts_with(doi, '10.') THEN doi ELSE nullif(regexp_extract(concat('see ', doi, ' there'), '(?:doi[.]org/)?(10[.]\d{{4,}}/[^\s"''<,]+)', 1), '') END AS found FROM raw""")
def extract_identifier(spark, sf_dir):
    text = F.when(F.col("doi").startswith("10."), F.col("doi")).otherwise(F.concat(F.lit("see "), "doi", F.lit(" there")))
    return raw_hits(spark, sf_dir).select("orderkey", "seq1", "seq2", "seq3", S.find_doi(text).alias("found"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_field(spark, sf_dir):
    return _t(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


@query(f"WITH {DUCK_KEYED} SELECT orderkey, seq1, seq2, seq3, year FROM raw WHERE year IS NULL OR year = 0 OR year >= 1997")
def year_floor_filter(spark, sf_dir):
    return harvest.year_floor(raw_hits(spark, sf_dir), 1997).select("orderkey", "seq1", "seq2", "seq3", "year")


@query(f"WITH {DUCK_PUBS} SELECT * EXCLUDE (seq) FROM pub")
def merge_hits(spark, sf_dir):
    return _flat(pubs(spark, sf_dir))


_INTO = f"""{DUCK_KEYED}, old AS (SELECT *, 0 AS n FROM keyed WHERE seq1 <= 2), ranked AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY seq1 DESC, seq2 DESC, seq3 DESC, seq4 DESC) AS r FROM old),
every AS (SELECT * EXCLUDE (r) FROM ranked WHERE r = 1 AND key <> '' UNION ALL BY NAME SELECT *, 1 AS n FROM full_key WHERE seq1 > 2),
folded AS ({_fold_sql('every', 'ORDER BY n, seq1, seq2, seq3, seq4', extra=", min(n) = 1 AS added, max(n) AS any_new, max(CASE WHEN n = 0 THEN 1 END) AS had, count(DISTINCT source) AS now")}),
passed AS (SELECT key, doi, title, authors, journal, publisher, type, subject, year, cited, is_oa, CASE n_inst WHEN 0 THEN '' WHEN 1 THEN inst1 ELSE inst1 || '; ' || inst2 END AS institutions,
  right(inst1, 2) AS countries, author_count, source AS sources, term AS search_terms, false AS added, false AS updated FROM ranked WHERE r > 1 OR key = ''),
result AS (SELECT * EXCLUDE (any_new, had, now), NOT added AND any_new = 1 AND now > had AS updated FROM folded UNION ALL BY NAME SELECT * FROM passed)"""


def _merged_into(spark, sf_dir, shared=WHOLE):
    h = hits(spark, sf_dir, shared)
    return merge.merge_into(h.where("seq1 <= 2"), h.where("seq1 > 2"), F.lit("2026-01-01"))


@query(f"WITH {_INTO} SELECT * FROM result")
def merge_into_existing(spark, sf_dir):
    return _flat(_merged_into(spark, sf_dir))


@query(f"WITH {_INTO} SELECT count(*) AS total, count(*) FILTER (WHERE added) AS added, count(*) FILTER (WHERE updated) AS updated FROM result")
def merge_counters(spark, sf_dir):
    return merge.merge_counters(_merged_into(spark, sf_dir, COUNTED))


@query(f"WITH {DUCK_KEYED} {_fold_sql('full_key', O, maintain=True, extra=', count(*) - 1 AS removed')}")
def maintain_dedup(spark, sf_dir):
    return _flat(merge.maintain(hits(spark, sf_dir)))


@query(f"""WITH {DUCK_KEYED}, a AS (SELECT * FROM raw WHERE source = 'OpenAlex'), b AS (SELECT *, row_number() OVER (PARTITION BY lower(doi) {O}) AS r FROM raw WHERE source <> 'OpenAlex' AND lower(doi) NOT IN (SELECT lower(doi) FROM a))
SELECT orderkey, seq1, seq2, seq3, doi, source FROM a UNION ALL SELECT orderkey, seq1, seq2, seq3, doi, source FROM b WHERE r = 1""")
def priority_union(spark, sf_dir):
    r = raw_hits(spark, sf_dir)
    return harvest.priority_union(r.where("source = 'OpenAlex'"), r.where("source <> 'OpenAlex'"), "doi", [F.col(c) for c in SEQ]).select("orderkey", "seq1", "seq2", "seq3", "doi", "source")


@query("SELECT o_custkey, o_orderkey, nth FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey)::INT AS nth FROM orders) WHERE nth <= 5")
def capped_scan(spark, sf_dir):
    return harvest.capped(_t(spark, sf_dir, "orders"), ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey")], 5).select("o_custkey", "o_orderkey", "nth")


@query(f"""WITH {DUCK_PUBS}, t AS (SELECT count(*) AS publications, sum(cited)::BIGINT AS citations, count(*) FILTER (WHERE cited > 0) AS cited_publications, count(DISTINCT nullif(journal, '')) AS journals,
  count(*) FILTER (WHERE subject = '') AS without_subject, min(year) AS first_year, max(year) AS last_year FROM pub)
SELECT *, floor((20 * (100 * cited_publications) + publications) / (2 * publications)) / 10 AS cited_percent, floor((20 * citations + publications) / (2 * publications)) / 10 AS average_citations, first_year || '–' || last_year AS year_range FROM t""")
def summary_stats(spark, sf_dir):
    return metrics.summary(pubs(spark, sf_dir))


@query(f"WITH {DUCK_PUBS} SELECT count(DISTINCT lower(trim(a))) AS authors FROM (SELECT unnest(string_split(authors, ';')) AS a FROM pub) WHERE trim(a) <> ''")
def distinct_authors(spark, sf_dir):
    return metrics.distinct_authors(pubs(spark, sf_dir))


@query(f"WITH {DUCK_PUBS} SELECT (SELECT count(DISTINCT x) FROM (SELECT unnest(string_split(institutions, '; ')) AS x FROM pub) WHERE x <> '') AS institutions, (SELECT count(DISTINCT countries) FROM pub) AS countries")
def distinct_institutions_countries(spark, sf_dir):
    p = pubs(spark, sf_dir)
    return metrics.distinct_items(p, "institutions", "institutions").join(metrics.distinct_items(p, "countries", "countries"))  # two single rows


@query(f"""WITH {DUCK_PUBS}, per AS (SELECT year, count(*) AS c, sum(cited)::BIGINT AS s FROM pub WHERE year IS NOT NULL AND year <> 0 GROUP BY year), spine AS (SELECT unnest(range((SELECT min(year) FROM per), (SELECT max(year) FROM per) + 1))::INT AS year)
SELECT spine.year, coalesce(c, 0) AS "count", sum(coalesce(c, 0)) OVER (ORDER BY spine.year)::BIGINT AS cumulative, coalesce(s, 0) AS citations, sum(coalesce(s, 0)) OVER (ORDER BY spine.year)::BIGINT AS cumulative_citations FROM spine LEFT JOIN per ON per.year = spine.year""")
def by_year_cumulative(spark, sf_dir):
    return metrics.by_year(pubs(spark, sf_dir))


@query(f"""WITH {DUCK_PUBS}, each AS (SELECT seq, unnest(string_split(subject, ';')) AS t, generate_subscripts(string_split(subject, ';'), 1) - 1 AS pos FROM pub)
SELECT trim(t) AS topic, count(*) AS "count" FROM each WHERE trim(t) <> '' AND lower(trim(t)) NOT IN {GENERIC} GROUP BY trim(t) ORDER BY count(*) DESC, min(row(seq, pos)) LIMIT 15""")
def top_subjects(spark, sf_dir):
    return metrics.top_subjects(pubs(spark, sf_dir), ["seq"], generic=GENERIC)


_BOUNDS = ", ".join(f"({i}, '{label}', {lo}, {hi})" for i, (lo, hi, label) in enumerate(metrics.BUCKETS))


@query(f"WITH {DUCK_PUBS} SELECT b.nth::INT AS nth, b.label, count(pub.key) AS \"count\" FROM (VALUES {_BOUNDS}) b(nth, label, lo, hi) LEFT JOIN pub ON pub.cited BETWEEN b.lo AND b.hi GROUP BY b.nth, b.label")
def citation_buckets(spark, sf_dir):
    return metrics.citation_buckets(pubs(spark, sf_dir))


@query("WITH y AS (SELECT min(year(o_orderdate))::INT AS a, max(year(o_orderdate))::INT AS b FROM orders) SELECT s::INT AS start, least(s + 1, b)::INT AS \"end\", (SELECT count(*) FROM orders WHERE year(o_orderdate) BETWEEN s AND least(s + 1, b)) AS n FROM (SELECT unnest(range(a, b + 1, 2)) AS s, b FROM y)")
def year_windows(spark, sf_dir):
    years = _t(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("y")).agg(F.count(F.lit(1)).alias("n"))
    ends = years.agg(F.min("y").alias("a"), F.max("y").alias("b"))
    w = ends.select(F.explode(F.sequence("a", "b", F.lit(2))).alias("start"), "b").select("start", F.least(F.col("start") + 1, F.col("b")).alias("end"))
    return intervals.counts(years, w.select("start", "end", F.col("start").alias("lo"), F.col("end").alias("hi")), "y", "n").select("start", "end", "n")


_LOOKUPS = """wanted AS (SELECT CAST(p_partkey AS STRING) AS key FROM {part}),
registry AS (SELECT CAST(p_partkey AS STRING) AS key, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_name END AS title, '' AS authors, p_brand AS journal, CASE WHEN p_partkey % 4 = 0 THEN '' ELSE p_type END AS publisher, p_type AS type,
  CAST(CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE 1990 + p_size % 30 END AS INT) AS year, CAST(p_size AS BIGINT) AS cited, p_brand AS subject, 'Unknown' AS is_oa FROM {part} WHERE p_partkey % 6 <> 0),
idx AS (SELECT CAST(p_partkey AS STRING) AS key, concat('alt ', p_name) AS title, p_name AS authors, 'J' AS journal, 'P' AS publisher, 'article' AS type, CAST(2001 AS INT) AS year, CAST(p_size % 7 * 10 AS BIGINT) AS cited,
  CASE WHEN p_partkey % 2 = 0 THEN '' ELSE p_type END AS subject, CASE WHEN p_size % 3 = 0 THEN 'Yes' ELSE 'No' END AS is_oa FROM {part} WHERE p_partkey % 4 <> 0),
have AS (SELECT CAST(p_partkey AS STRING) AS key, CASE WHEN p_size % 3 = 0 THEN '' ELSE 'T' END AS title, CASE WHEN p_size % 5 = 0 THEN '' ELSE 'A' END AS authors, CASE WHEN p_size % 4 = 0 THEN '' ELSE 'J0' END AS journal,
  CASE WHEN p_size % 2 = 0 THEN '' ELSE 'P0' END AS publisher, CASE WHEN p_partkey % 2 = 0 THEN '' ELSE 'book' END AS type, CAST(CASE WHEN p_size % 6 = 0 THEN NULL ELSE 1999 END AS INT) AS year, CAST(20 AS BIGINT) AS cited,
  CASE WHEN p_size % 7 = 0 THEN '' ELSE 'S' END AS subject, CASE WHEN p_size % 8 = 0 THEN 'Unknown' ELSE 'Yes' END AS is_oa FROM {part})"""


def _lookup(spark, sf_dir, name):
    return spark.sql(f"WITH {_LOOKUPS} SELECT * FROM {name}", part=_t(spark, sf_dir, "part"))


_DL = _LOOKUPS.format(part="part")
_OR = lambda *xs: "coalesce(" + ", ".join(f"nullif({x}, '')" for x in xs) + ", '')"


@query(f"""WITH {_DL} SELECT w.key, {", ".join(f"{_OR(f'r.{c}', f'i.{c}')} AS {c}" for c in ("title", "authors", "journal", "publisher", "type"))}, coalesce(nullif(r.year, 0), nullif(i.year, 0)) AS year,
  greatest(coalesce(r.cited, 0), coalesce(i.cited, 0)) AS cited, {_OR('i.subject', 'r.subject')} AS subject, coalesce(nullif(i.is_oa, ''), nullif(r.is_oa, ''), 'Unknown') AS is_oa, r.key IS NULL AND i.key IS NULL AS rejected
FROM wanted w LEFT JOIN registry r ON r.key = w.key LEFT JOIN idx i ON i.key = w.key""")
def lookup_enrich(spark, sf_dir):
    return enrich.assemble(_lookup(spark, sf_dir, "wanted"), _lookup(spark, sf_dir, "registry"), _lookup(spark, sf_dir, "idx"))


@query(f"""WITH {_DL}, j AS (SELECT h.*, r.key AS rk, i.key AS ik, {", ".join(f"r.{c} AS r_{c}, i.{c} AS i_{c}" for c in ("title", "authors", "journal", "publisher", "type", "year", "cited", "subject", "is_oa"))} FROM have h
  LEFT JOIN registry r ON r.key = h.key AND (h.title = '' OR h.authors = '' OR h.journal = '')
  LEFT JOIN idx i ON i.key = h.key AND (h.subject = '' OR h.is_oa = 'Unknown' OR ((h.title = '' OR h.authors = '') AND r.key IS NULL))),
n AS (SELECT key, {", ".join(f"{c} AS o_{c}" for c in ("title", "authors", "journal", "publisher", "type", "subject", "is_oa", "year", "cited"))}, {", ".join(f"{_OR(c, f'r_{c}', f'i_{c}')} AS {c}" for c in ("title", "authors", "journal", "publisher", "type"))}, {_OR('subject', 'i_subject', 'r_subject')} AS subject,
  coalesce(nullif(is_oa, 'Unknown'), nullif(i_is_oa, 'Unknown'), nullif(r_is_oa, 'Unknown'), 'Unknown') AS is_oa, coalesce(nullif(year, 0), nullif(r_year, 0), i_year) AS year, greatest(cited, coalesce(r_cited, 0), coalesce(i_cited, 0)) AS cited FROM j)
SELECT key, title, authors, journal, publisher, type, subject, is_oa, year, cited, {" OR ".join(f"{c} IS DISTINCT FROM o_{c}" for c in ("title", "authors", "journal", "publisher", "type", "subject", "is_oa", "year", "cited"))} AS filled FROM n""")
def conditional_fill(spark, sf_dir):
    return enrich.fill_gaps(_lookup(spark, sf_dir, "have"), _lookup(spark, sf_dir, "registry"), _lookup(spark, sf_dir, "idx"))


@query("SELECT key, event_id FROM (SELECT CAST(user_id AS STRING) AS key, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0)) WHERE r = 1")
def pending_anti_join(spark, sf_dir):
    queue = _t(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("key"), "event_id")
    known = _t(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").cast("string").alias("key"))
    return enrich.pending(queue, known, [F.col("event_id")]).select("key", "event_id")


@query("""WITH l AS (SELECT c_custkey, c_nationkey AS code, (c_custkey % 5)::INT AS year FROM customer), r AS (SELECT s_nationkey AS code, (s_suppkey % 5)::INT AS year, s_name AS doi, s_suppkey AS seq FROM supplier),
e AS (SELECT code, year, arg_max(doi, seq) AS d FROM r GROUP BY ALL), c AS (SELECT code, arg_max(doi, seq) AS d FROM r GROUP BY ALL)
SELECT c_custkey, l.code, l.year, coalesce(e.d, c.d, '') AS doi FROM l LEFT JOIN e ON e.code = l.code AND e.year = l.year LEFT JOIN c ON c.code = l.code""")
def two_tier_lookup(spark, sf_dir):
    left = _t(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("code"), (F.col("c_custkey") % 5).cast("int").alias("year"))
    right = _t(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("code"), (F.col("s_suppkey") % 5).cast("int").alias("year"), F.col("s_name").alias("doi"), F.col("s_suppkey").alias("seq"))
    return inventory.two_tier(left, right, "code", "year", "doi", "seq").select("c_custkey", "code", "year", "doi")


@query("SELECT concat('n', n_nationkey) AS id, n_name AS title, n_nationkey::BIGINT AS a, -1::BIGINT AS b FROM nation WHERE n_regionkey = 1 UNION ALL SELECT concat('s', s_suppkey), s_name, n_nationkey, s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey = 1")
def hierarchy_two_level(spark, sf_dir):
    nations = _t(spark, sf_dir, "nation").select(F.concat(F.lit("r"), "n_regionkey").alias("parent"), F.concat(F.lit("n"), "n_nationkey").alias("id"), F.col("n_name").alias("title"), F.col("n_nationkey").cast("long").alias("pos"))
    sellers = _t(spark, sf_dir, "supplier").select(F.concat(F.lit("n"), "s_nationkey").alias("parent"), F.concat(F.lit("s"), "s_suppkey").alias("id"), F.col("s_name").alias("title"), F.col("s_suppkey").alias("pos"))
    return inventory.two_levels(nations.unionByName(sellers), F.lit("r1"))


@query("SELECT doc_id, key FROM (SELECT doc_id, key, row_number() OVER (PARTITION BY key ORDER BY doc_id) AS r FROM (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN concat('10.5555/', doc_id % 97) ELSE concat(source, ':', substr(lower(text), 1, 50)) END AS key FROM documents)) WHERE r = 1")
def dataset_dedup(spark, sf_dir):
    rows = _t(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("https://doi.org/10.5555/"), (F.col("doc_id") % 97).cast("string"))).otherwise("").alias("doi"), F.col("text").alias("name"), F.col("source").alias("platform"))
    return inventory.dedup_datasets(rows, [F.col("doc_id")]).select("doc_id", "key")


@query("SELECT conv_id, coalesce(string_agg(CASE WHEN turn % 2 = 0 THEN concat('i', turn) ELSE concat('o', turn) END, '; ' ORDER BY turn, role, text) FILTER (WHERE role = 'user'), '') AS names FROM conversations GROUP BY conv_id")
def role_filter_names(spark, sf_dir):
    party = F.struct(
        "turn", "role", "text",
        F.when(F.col("turn") % 2 == 0, F.concat(F.lit("i"), "turn")).otherwise("").alias("individual"),
        F.concat(F.lit("o"), "turn").alias("organisation"),
    )
    per = _t(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(party)).alias("ps"))
    ps = F.transform("ps", lambda p: F.struct(F.when(p["role"] == "user", "author").otherwise(p["role"]).alias("role"), p["individual"], p["organisation"]))
    return per.select("conv_id", inventory.names_by_role(ps).alias("names"))


@query("""WITH y AS (SELECT count(*) AS c FROM orders GROUP BY year(o_orderdate)), m AS (SELECT max(c) AS top, max(c) / 5.0 AS raw FROM y), g AS (SELECT *, pow(10, floor(log10(raw))) AS mag FROM m),
s AS (SELECT *, CASE WHEN raw / mag <= 1.5 THEN mag WHEN raw / mag <= 3.5 THEN 2 * mag WHEN raw / mag <= 7.5 THEN 5 * mag ELSE 10 * mag END AS step FROM g)
SELECT i::BIGINT AS nth, i * step AS tick FROM (SELECT step, unnest(range(0, floor(top / step)::BIGINT + 1)) AS i FROM s)""")
def axis_ticks_query(spark, sf_dir):
    return axis_ticks(_t(spark, sf_dir, "orders").groupBy(F.year("o_orderdate")).count().agg(F.max("count").alias("top")), "top")


def _payload(spark, sf_dir, reader, *fields, keep=("p_partkey",), **kw):
    """Parts as landed JSON answers (``fields`` in SQL), projected by a reader."""
    rows = _t(spark, sf_dir, "part").selectExpr("p_partkey", f"to_json(named_struct({', '.join(fields)})) AS record")
    return payloads.READERS[reader](payloads.read_records(rows, payloads.SCHEMAS[reader], *keep), keep=keep, **kw)


_ID = "concat('10.5555/P', p_partkey)"


@query(f"""SELECT p_partkey, {_ID} AS doi, CASE WHEN p_size % 5 = 0 THEN 'Untitled' ELSE p_name END AS title, CASE WHEN p_size % 3 = 0 THEN p_brand ELSE p_brand || '; B' END AS authors, CASE WHEN p_size % 4 = 0 THEN '' ELSE p_type END AS journal, '' AS publisher,
  CASE WHEN p_size % 7 = 0 THEN NULL ELSE 1990 + p_size END::INT AS year, p_size::BIGINT AS cited, 'book part' AS type, CASE WHEN p_size % 2 = 0 THEN 'Yes' ELSE 'No' END AS is_oa, p_type || '; x; y' AS subject,
  CASE WHEN p_size % 3 = 0 THEN 1 ELSE 2 END::INT AS author_count, CASE WHEN p_size % 3 = 0 THEN p_brand ELSE p_brand || '; ' || p_type END AS institutions, 'AU' AS countries FROM part WHERE p_partkey % 9 <> 0""")
def payload_openalex(spark, sf_dir):
    inst = "array(named_struct('display_name', p_brand, 'country_code', 'AU'), named_struct('display_name', '', 'country_code', 'AU'))"
    other = "named_struct('author', named_struct('display_name', 'B'), 'institutions', array(named_struct('display_name', p_type, 'country_code', 'AU'), named_struct('display_name', p_brand, 'country_code', 'AU')))"
    own = f"named_struct('author', named_struct('display_name', p_brand), 'institutions', {inst})"
    return _flat(_payload(
        spark, sf_dir, "openalex", "'doi', CASE WHEN p_partkey % 9 = 0 THEN '' ELSE concat('https://doi.org/10.5555/P', p_partkey) END", "'title', CASE WHEN p_size % 5 = 0 THEN '<br> ' ELSE concat('<i>', p_name, '</i>') END",
        "'publication_year', CASE WHEN p_size % 7 = 0 THEN 0 ELSE 1990 + p_size END", f"'authorships', CASE WHEN p_size % 3 = 0 THEN array({own}) ELSE array({own}, {other}) END", "'primary_location', CASE WHEN p_size % 4 = 0 THEN NULL ELSE named_struct('source', named_struct('display_name', p_type)) END",
        "'cited_by_count', p_size", "'type', 'book-part'", "'open_access', named_struct('is_oa', p_size % 2 = 0)", "'topics', array(named_struct('display_name', p_type), named_struct('display_name', 'x'), named_struct('display_name', 'y'), named_struct('display_name', 'z'))",
    ))


@query(f"""SELECT p_partkey, lower({_ID}) AS doi, p_name AS title, p_brand || ' F; G' AS authors, 'J' AS journal, p_type AS publisher, CASE WHEN p_size % 4 = 0 THEN NULL WHEN p_size % 2 = 0 THEN 2001 ELSE 2011 END::INT AS year, p_size::BIGINT AS cited, 'journal article' AS type, 'Unknown' AS is_oa, 'a; b; c' AS subject FROM part""")
def payload_crossref(spark, sf_dir):
    return _payload(
        spark, sf_dir, "crossref",
        "'message', named_struct('DOI', concat('10.5555/P', p_partkey), 'title', array(p_name, 'other'), 'author', array(named_struct('given', p_brand, 'family', 'F'), named_struct('given', NULL, 'family', 'G')), "
        "'published-print', CASE WHEN p_size % 2 = 0 THEN named_struct('date-parts', array(array(CASE WHEN p_size % 4 = 0 THEN 0 ELSE 2001 END))) END, 'published-online', named_struct('date-parts', array(array(2011, 5))), "
        "'container-title', array('J', 'K'), 'publisher', p_type, 'is-referenced-by-count', p_size, 'type', 'journal-article', 'subject', array('a', 'b', 'c', 'd'))",
    )


@query(f"""SELECT p_partkey, {_ID} AS doi, p_name AS title, p_brand AS authors, CASE WHEN p_size % 2 = 0 THEN '' ELSE 'J' END AS journal, '' AS publisher, 2000::INT AS year, p_size::BIGINT AS cited, 'journal article,  review' AS type, CASE WHEN p_size % 3 = 0 THEN 'Yes' ELSE 'No' END AS is_oa,
  CASE WHEN p_type = 'S' THEN 'S; T' ELSE p_type || '; S; T' END AS subject FROM part""")
def payload_semantic_scholar(spark, sf_dir):
    cat = lambda x: f"named_struct('category', {x})"
    return _payload(
        spark, sf_dir, "semantic_scholar", "'externalIds', named_struct('DOI', concat('10.5555/P', p_partkey))", "'title', p_name", "'authors', array(named_struct('name', p_brand))", "'year', 2000", "'citationCount', p_size", "'journal', CASE WHEN p_size % 2 = 1 THEN named_struct('name', 'J') END",
        "'openAccessPdf', CASE WHEN p_size % 3 = 0 THEN named_struct('url', 'u') END", "'publicationTypes', array('JournalArticle', 'Review')", f"'s2FieldsOfStudy', array({cat('p_type')}, {cat('NULL')}, {cat('p_type')}, {cat(repr('S'))}, {cat(repr('T'))}, {cat(repr('U'))})",
    )


@query(f"""SELECT p_partkey, {_ID} AS doi, p_name AS title, CASE WHEN p_size % 2 = 0 THEN 'X, ' || p_brand ELSE p_brand || ' L; M' END AS authors, 'J' AS journal, '' AS publisher, CASE WHEN p_size % 3 = 0 THEN NULL ELSE 2003 END::INT AS year, p_size::BIGINT AS cited, p_type AS type,
  CASE WHEN p_size % 5 = 0 THEN 'Yes' ELSE 'No' END AS is_oa, CASE WHEN p_size % 2 = 0 THEN 'k; l' ELSE 'm1; m2; m3' END AS subject FROM part""")
def payload_europepmc(spark, sf_dir):
    mesh = ", ".join(f"named_struct('descriptorName', 'm{i}')" for i in range(1, 5))
    return _payload(
        spark, sf_dir, "europepmc", "'doi', concat('10.5555/P', p_partkey)", "'title', p_name", "'authorList', CASE WHEN p_size % 2 = 1 THEN named_struct('author', array(named_struct('firstName', p_brand, 'lastName', 'L'), named_struct('firstName', '', 'lastName', 'M'))) END", "'authorString', concat('X, ', p_brand)",
        "'journalTitle', 'J'", "'pubYear', CASE WHEN p_size % 3 = 0 THEN 'x' ELSE '2003b' END", "'citedByCount', p_size", "'pubType', p_type", "'isOpenAccess', CASE WHEN p_size % 5 = 0 THEN 'Y' ELSE 'N' END", f"'meshHeadingList', CASE WHEN p_size % 2 = 1 THEN named_struct('meshHeading', array({mesh})) END", "'keywordList', named_struct('keyword', array('k', 'l'))",
    )


@query(f"""SELECT p_partkey, {_ID} AS doi, p_name AS title, p_brand || '; N' AS authors, 'J' AS journal, p_type AS publisher, CASE WHEN p_size % 2 = 0 THEN 2001 ELSE 2007 END::INT AS year, p_size::BIGINT AS cited, 'thesis' AS type, 'Yes' AS is_oa, p_type AS subject FROM part""")
def payload_core(spark, sf_dir):
    return _payload(
        spark, sf_dir, "core", "'doi', concat('HTTP://doi.org/10.5555/P', p_partkey)", "'title', p_name", "'authors', array(p_brand, '', to_json(named_struct('name', 'N')))", "'yearPublished', CASE WHEN p_size % 2 = 0 THEN 2001 ELSE 0 END", "'publishedDate', '2007-02-03'", "'journals', array(named_struct('title', 'J'))", "'publisher', p_type",
        "'citationCount', p_size", "'documentType', 'thesis'", "'subjects', array(p_type)",
    )


@query(f"""SELECT p_partkey, {_ID} AS doi, p_name AS title, p_brand || ' L; Full' AS authors, 'J' AS journal, '' AS publisher, 2002::INT AS year, p_size::BIGINT AS cited, p_type AS type, CASE WHEN p_size % 2 = 0 THEN 'Yes' ELSE 'No' END AS is_oa, p_type || '; c' AS subject FROM part""")
def payload_dimensions(spark, sf_dir):
    who = "array(named_struct('first_name', p_brand, 'last_name', 'L', 'full_name', 'q'), named_struct('first_name', 'Half', 'last_name', '', 'full_name', 'Full'), named_struct('first_name', '', 'last_name', '', 'full_name', ''))"
    return _payload(
        spark, sf_dir, "dimensions", "'doi', concat('10.5555/P', p_partkey)", "'title', concat(p_name, ' <sub></sub>')", "'year', 2002", "'journal', named_struct('title', 'J')", f"'authors', {who}", "'times_cited', p_size", "'type', p_type", "'open_access', CASE WHEN p_size % 2 = 0 THEN array('gold') ELSE array() END",
        "'category_for', array(named_struct('name', p_type), named_struct('name', ''), named_struct('name', 'c'), named_struct('name', 'd'))",
    )


@query("""SELECT CASE WHEN s_suppkey % 3 = 0 THEN 'id' || s_suppkey ELSE '10.5555/S' || s_suppkey END AS doi, CASE WHEN s_suppkey % 4 = 0 THEN 'Untitled' ELSE s_name END AS name, s_name || ', G., Org, Unknown' AS authors, CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE 2010 END::INT AS year, 'EarthBank' AS platform,
  CASE WHEN s_suppkey % 2 = 0 THEN 'Dataset' ELSE 'Image' END AS type FROM supplier""")
def payload_datacite(spark, sf_dir):
    creators = "array(named_struct('name', 'q', 'familyName', s_name, 'givenName', 'Given'), named_struct('name', 'Org', 'familyName', 'f', 'givenName', NULL), named_struct('name', '', 'familyName', NULL, 'givenName', NULL))"
    answer = f"""to_json(named_struct('id', concat('id', s_suppkey), 'attributes', named_struct('doi', CASE WHEN s_suppkey % 3 > 0 THEN concat('10.5555/S', s_suppkey) END, 'titles', CASE WHEN s_suppkey % 4 = 0 THEN array() ELSE array(named_struct('title', s_name)) END,
      'creators', {creators}, 'publicationYear', CASE WHEN s_suppkey % 5 > 0 THEN 2010 END, 'types', CASE WHEN s_suppkey % 2 = 1 THEN named_struct('resourceTypeGeneral', 'Image') END))) AS record"""
    return payloads.datacite(payloads.read_records(_t(spark, sf_dir, "supplier").selectExpr(answer), payloads.DATACITE))


@query("SELECT 'N' || s_nationkey AS code, s_name AS name, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 2000 + s_suppkey % 7 END::INT AS year, 'AusPass' AS platform, 'Seismic Network' AS type FROM supplier WHERE s_suppkey % 4 <> 0")
def payload_stations(spark, sf_dir):
    start = "CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE concat(2000 + s_suppkey % 7, '-01-01T00:00:00') END"
    return payloads.station_networks(_t(spark, sf_dir, "supplier").selectExpr(f"CASE WHEN s_suppkey % 4 = 0 THEN concat(s_name, '|short') ELSE concat_ws('|', concat('N', s_nationkey), concat(' ', s_name, ' '), {start}, '', '3') END AS value"))


@query("""SELECT 's' || s_suppkey AS id, CASE WHEN s_suppkey % 3 = 0 THEN '10.5555/d' || s_suppkey WHEN s_suppkey % 3 = 1 THEN '10.25914/x-' || s_suppkey ELSE '' END AS doi, CASE WHEN s_suppkey % 2 = 0 THEN s_name ELSE s_name || ', Org' END AS authors, CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE 2014 END::INT AS year FROM supplier""")
def payload_catalogue(spark, sf_dir):
    text = lambda x: f"named_struct('gco:CharacterString', {x})"
    party = lambda role, who, org: f"named_struct('gmd:CI_ResponsibleParty', named_struct('gmd:role', named_struct('gmd:CI_RoleCode', named_struct('@codeListValue', '{role}')), 'gmd:individualName', {text(who)}, 'gmd:organisationName', {text(org)}))"
    one, more = party("author", "s_name", "'q'"), f"{party('publisher', repr('P'), repr('q'))}, {party('creator', repr(''), repr('Org'))}"
    cite = f"""named_struct('gmd:citedResponsibleParty', CASE WHEN s_suppkey % 2 = 0 THEN array({one}) ELSE array({one}, {more}) END,
      'gmd:date', CASE WHEN s_suppkey % 5 > 0 THEN named_struct('gmd:CI_Date', named_struct('gmd:date', named_struct('gco:Date', named_struct('#text', '2014-05-06')))) END)"""
    record = f"""to_json(named_struct('gmd:dataSetURI', CASE WHEN s_suppkey % 3 = 0 THEN {text("concat('see https://doi.org/10.5555/d', s_suppkey, ', there')")} END, 'note', CASE WHEN s_suppkey % 3 = 1 THEN concat('cites 10.25914/x-', s_suppkey, '.') END,
      'gmd:identificationInfo', named_struct('gmd:MD_DataIdentification', named_struct('gmd:citation', named_struct('gmd:CI_Citation', {cite}))))) AS record"""
    return geonetwork.metadata(_t(spark, sf_dir, "supplier").selectExpr("concat('s', s_suppkey) AS id", record))


@query("""SELECT 'r' || n_regionkey AS parent, 'n' || n_nationkey AS id, CASE n_nationkey % 4 WHEN 0 THEN n_name WHEN 1 THEN 'E ' || n_name WHEN 2 THEN 'F ' || n_name ELSE 'D ' || n_name END AS title, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS pos FROM nation""")
def payload_children(spark, sf_dir):
    child = """struct(n_nationkey AS k, concat('n', n_nationkey) AS id, concat('D ', n_name) AS defaultTitle, CASE n_nationkey % 4 WHEN 0 THEN n_name WHEN 1 THEN to_json(map('fr', concat('F ', n_name), 'eng', concat('E ', n_name))) WHEN 2 THEN to_json(map('fr', concat('F ', n_name))) ELSE '' END AS title)"""
    lists = _t(spark, sf_dir, "nation").groupBy(F.concat(F.lit("r"), "n_regionkey").alias("parent")).agg(F.array_sort(F.collect_list(F.expr(child))).alias("children"))
    raw = F.expr("""concat('{"children":[', array_join(transform(children, c -> concat('{"id":"', c.id, '","defaultTitle":"', c.defaultTitle, '","title":', CASE WHEN c.title LIKE '{%' THEN c.title ELSE concat('"', c.title, '"') END, '}')), ','), ']}')""")
    return geonetwork.children(lists.select("parent", raw.alias("record")))


@query("SELECT p_partkey, p_size::INT AS n, replace(replace(replace(replace(t, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;') AS escaped, replace(p_name, ' ', '%20') AS url FROM (SELECT *, concat('<a b=\"', p_name, '\"> & ', p_brand) AS t FROM part)")
def escaping(spark, sf_dir):
    text = F.concat(F.lit('<a b="'), "p_name", F.lit('"> & '), "p_brand")
    return _t(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("int").alias("n"), S.html_escaped(text).alias("escaped"), S.url_component(F.col("p_name")).alias("url"))


_PART_DOI = "CASE WHEN p_partkey % 3 = 0 THEN concat(' https://doi.org/10.5555/P', CAST(p_size AS STRING)) ELSE '' END"


@query(f"""WITH {DUCK_KEYED} SELECT orderkey, seq1, seq2, seq3, 'OpenAlex' AS sources, trim(regexp_replace(replace(concat('"', term, '"  ', is_oa), '"', ''), '\\s+', ' ', 'g')) AS search_terms FROM raw""")
def tagged_hits(spark, sf_dir):
    label = S.query_label(F.concat(F.lit('"'), "term", F.lit('"  '), "is_oa"))
    tagged = harvest.tagged(raw_hits(spark, sf_dir).drop("source"), "OpenAlex", label)
    return _flat(tagged.select("orderkey", "seq1", "seq2", "seq3", "sources", "search_terms"))


@query("SELECT s_suppkey AS id, s_name AS name, NULL AS code, 'supplier' AS platform FROM supplier UNION ALL SELECT c_custkey, c_name, c_nationkey, 'customer' FROM customer UNION ALL SELECT p_partkey, p_name, NULL, 'part' FROM part")
def platform_union(spark, sf_dir):
    t = lambda name, p, *more: _t(spark, sf_dir, name).select(F.col(f"{p[0]}_{p}key").alias("id"), F.col(f"{p[0]}_name").alias("name"), *more, F.lit(name).alias("platform"))
    return inventory.union_platforms(t("supplier", "supp"), t("customer", "cust", F.col("c_nationkey").alias("code")), t("part", "part"))


@query(f"""WITH r AS (SELECT *, {_PART_DOI} AS doi FROM part), k AS (SELECT *, {KEY} AS d FROM r),
u AS (SELECT DISTINCT CASE WHEN d <> '' THEN d ELSE concat(p_brand, ':', substr(lower(p_name), 1, 50)) END AS key, d <> '' AS has FROM k)
SELECT count(*) AS total, count(*) FILTER (WHERE has) AS with_doi FROM u""")
def inventory_counters(spark, sf_dir):
    rows = _t(spark, sf_dir, "part").select(F.trim(F.expr(_PART_DOI)).alias("doi"), F.col("p_name").alias("name"), F.col("p_brand").alias("platform"), F.struct("p_partkey").alias("at"))
    return jobs.inventory_run([rows.where("p_partkey % 2 = 0"), rows.where("p_partkey % 2 = 1")])[1]


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'none' ELSE 'found' END AS kind, 'T' || (o_orderkey % 1000) AS title FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 UNION ALL SELECT o_orderkey, 'none', '' FROM orders WHERE o_orderkey % 5 = 0 AND o_orderkey % 7 <> 0")
def pending_stream(spark, sf_dir):
    """The queue of all orders as JSON files, drained once: known keys are left out, the others accepted or rejected."""
    root = new_path(spark, "pending")
    key = F.concat(F.lit("10.5555/o"), F.col("o_orderkey").cast("string"))
    every = _t(spark, sf_dir, "orders").select("o_orderkey", key.alias("key"))
    lists = every.groupBy(F.floor(F.col("o_orderkey") / 1000).alias("file")).agg(F.to_json(F.collect_list(F.struct(F.concat(F.lit("https://doi.org/"), F.upper("key")).alias("doi")))).alias("value"))
    lists.write.partitionBy("file").text(f"{root}/queue")  # one JSON array a file
    empty = [F.lit("").alias(c) for c in ("authors", "journal", "publisher", "type", "subject")]
    registry = every.where("o_orderkey % 5 <> 0").select("key", F.concat(F.lit("T"), (F.col("o_orderkey") % 1000).cast("string")).alias("title"), *empty, F.lit(2000).alias("year"), F.lit(1).alias("cited"), F.lit("Yes").alias("is_oa"))
    write = lambda kind: lambda df: df.select("key", (F.col("title") if kind == "found" else F.lit("")).alias("title")).write.mode("append").parquet(f"{root}/{kind}")
    pending.drain(spark, f"{root}/queue", f"{root}/checkpoint", lambda: every.where("o_orderkey % 7 = 0").select("key"), lambda: (registry, registry.limit(0)), write("found"), write("none"))
    read = lambda kind: spark.read.schema("key string, title string").parquet(f"{root}/{kind}").withColumn("kind", F.lit(kind))
    return read("found").unionByName(read("none")).select(F.regexp_extract("key", "o(\\d+)$", 1).cast("long").alias("o_orderkey"), "kind", "title")


@query("SELECT c_custkey AS id, c_name AS name, c_nationkey + 1 AS code FROM customer")
def table_overwrite(spark, sf_dir):
    """A table rewritten from itself: readers see the old rows or the new ones."""
    path = new_path(spark, "overwrite")
    tables.overwrite(_t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("code")), path)
    tables.overwrite(spark.read.parquet(path).withColumn("code", F.col("code") + 1), path)
    return spark.read.parquet(path)


@query("SELECT p_partkey AS id, p_name AS name FROM part")
def envelope_records(spark, sf_dir):
    """Records of JSON documents {records: [...]}, of 100 keys each, a file for each; a path that is missing adds none."""
    path = new_path(spark, "envelope")
    docs = _t(spark, sf_dir, "part").groupBy(F.expr("p_partkey div 100").alias("doc")).agg(F.collect_list(F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))).alias("records"))
    docs.write.partitionBy("doc").json(path)
    schema = "id bigint, name string"
    return payloads.envelope(spark, path, schema).unionByName(payloads.envelope(spark, f"{path}-none", schema))


@query("""WITH q AS (SELECT p_partkey::INT AS i, p_name AS t FROM part), y AS (SELECT unnest([0, 1, 2]) AS win, unnest([1997, 2002, 2007]) AS a), p AS (SELECT unnest([0, 1]) AS pass, unnest(['fulltext.search', 'default.search']) AS filter)
SELECT 'openalex' AS service, i AS query_idx, pass::INT AS pass, win::INT AS win, filter, ',publication_year:' || a || '-' || least(a + 4, 2010) AS years, 20 AS pages, t AS text FROM q, y, p WHERE i = 0
UNION ALL SELECT 'openalex', i, pass::INT, 0, filter, '', 2, t FROM q, p WHERE i > 0 UNION ALL SELECT 'europepmc', i, 0, 0, '', '', CASE WHEN i = 0 THEN 5 ELSE 2 END, t FROM q
UNION ALL SELECT s, i, 0, 0, '', '', n, CASE WHEN s = 'europepmc_ack' THEN 'ACK_FUND:"' || t || '"' ELSE t END FROM q, (SELECT unnest(['semantic_scholar', 'europepmc_ack', 'core', 'dimensions']) AS s, unnest([5, 5, 2, 2]) AS n) WHERE i = 0""")
def scan_plan(spark, sf_dir):
    """What a harvest asks of all services, for as many queries as there are parts."""
    return jobs.scan_frame(_t(spark, sf_dir, "part").select(F.col("p_partkey").alias("query_idx"), F.col("p_name").alias("text")), 2010)


@query("SELECT s_suppkey, lo, hi, (SELECT count(*) FROM lineitem WHERE l_partkey BETWEEN lo AND hi) AS n FROM (SELECT s_suppkey, s_suppkey * 7 - 20 AS lo, s_suppkey * 7 - 20 + (s_suppkey % 40 - 3) * 5 AS hi FROM supplier)")
def interval_counts(spark, sf_dir):
    """Line items of the parts in each of many ranges; some hold nothing."""
    lo = F.col("s_suppkey") * 7 - 20
    ranges = _t(spark, sf_dir, "supplier").select("s_suppkey", lo.alias("lo"), (lo + (F.col("s_suppkey") % 40 - 3) * 5).alias("hi"))
    return intervals.counts(_t(spark, sf_dir, "lineitem"), ranges, "l_partkey")


@query(f"""WITH {DUCK_KEYED} SELECT count(DISTINCT nullif(journal, '')) AS journals, (SELECT count(DISTINCT lower(trim(a))) FROM (SELECT unnest(string_split(authors, ';')) AS a FROM raw) WHERE trim(a) <> '') AS authors,
  (SELECT count(DISTINCT trim(a)) FROM (SELECT unnest(string_split(subject, ';')) AS a FROM raw) WHERE trim(a) <> '') AS subjects, (SELECT count(DISTINCT x) FROM (SELECT unnest([inst1, inst2][:n_inst]) AS x FROM raw)) AS institutions, count(DISTINCT right(inst1, 2)) AS countries FROM raw""")
def distinct_bitmaps(spark, sf_dir):
    """Exact distinct counts of five kinds, from the bitmaps of two runs."""
    found = staged(distinct.items(hits(spark, sf_dir, shared=""), (F.col("orderkey") % 2).alias("run")), "distinct-items")
    words, maps = spark.createDataFrame([], distinct.DICTIONARY), []
    for run in (0, 1):
        own = found.where(F.col("run") == run)
        words = staged(distinct.extended(words, own), "distinct-words")
        maps.append(distinct.bitmaps(own, words))
    return distinct.numbers(distinct.united(*maps)).agg(*distinct.wide("journals", "authors", "subjects", "institutions", "countries"))


@query("SELECT '10.5555/o' || o_orderkey AS key, CASE WHEN o_orderkey % 100 = 1 THEN -o_custkey ELSE o_custkey END AS v FROM orders")
def bucketed_upsert(spark, sf_dir):
    """A table in buckets of its keys; one in a hundred is added and one in a hundred changed, in their buckets only."""
    rows = _t(spark, sf_dir, "orders").select(F.concat(F.lit("10.5555/o"), F.col("o_orderkey").cast("string")).alias("key"), F.col("o_custkey").alias("v"), "o_orderkey")
    table = Table(spark, new_path(spark, "upsert"), "key", 64)
    table.overwrite(rows.where("o_orderkey % 100 <> 0").select("key", "v"))
    new = staged(rows.where("o_orderkey % 100 < 2").select("key", F.when(F.col("o_orderkey") % 100 == 1, -F.col("v")).otherwise(F.col("v")).alias("v")), "upsert-new")
    table.upsert(new, lambda old, fresh: old.join(fresh.select("key"), "key", "left_anti").unionByName(fresh), run=("query", 1))
    return table.read()


@query("SELECT c_custkey AS id, c_name AS name, c_nationkey AS code FROM customer")
def snapshot_rollback(spark, sf_dir):
    """A table overwritten from itself and rolled back: the first version again."""
    table = Table(spark, new_path(spark, "snapshots"))
    table.overwrite(_t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("code")))
    table.overwrite(table.read().where("id % 2 = 0").withColumn("code", F.col("code") + 1))
    table.rollback(1)
    return table.read()


@query(f"WITH {_INTO} SELECT count(*) AS total, count(*) FILTER (WHERE added) AS added, count(*) FILTER (WHERE updated) AS updated FROM result")
def observed_counters(spark, sf_dir):
    """The counters of a merge, observed in the one write that makes the table."""
    merged = _merged_into(spark, sf_dir, COUNTED).select("doi", "sources", F.col("added").alias("_added"), F.col("updated").alias("_updated"))
    seen = Table(spark, new_path(spark, "observed")).overwrite(merged, counts={"total": F.count(F.lit(1)), "added": F.count_if("_added"), "updated": F.count_if("_updated")})
    return spark.createDataFrame([(seen["total"], seen["added"], seen["updated"])], "total bigint, added bigint, updated bigint")


@query("""SELECT 1 AS rank, p_partkey AS "row", '10.5555/P' || p_partkey AS doi, p_name AS title, (1960 + p_size)::INT AS year, 'Semantic Scholar' AS sources, 'a b' AS search_terms FROM part
UNION ALL SELECT 4, s_suppkey, '10.5555/S' || s_suppkey, s_name, 2001, 'CORE', 'a b' FROM supplier""")
def service_union(spark, sf_dir):
    """Hits of two services, landed as JSON, in one table: each with its place in the order, its source and its query's label."""
    land = lambda t, n, record: _t(spark, sf_dir, t).selectExpr("0 AS query_idx", "0 AS pass", "0 AS win", "1 AS page", f"{n} AS row", f"to_json(named_struct({record})) AS record")
    landed = {
        "semantic_scholar": land("part", "p_partkey", "'title', p_name, 'externalIds', named_struct('DOI', concat('10.5555/P', p_partkey)), 'year', 1960 + p_size"),
        "core": land("supplier", "s_suppkey", "'title', s_name, 'doi', concat('https://doi.org/10.5555/S', s_suppkey), 'yearPublished', 2001"),
    }
    every = jobs.hits(landed, jobs.Settings(['a "b"']).frame(spark))
    return every.select(F.col("seq.rank").alias("rank"), F.col("seq.row").alias("row"), "doi", "title", "year", F.array_join("sources", "; ").alias("sources"), F.array_join("search_terms", "; ").alias("search_terms"))


@query(f"""WITH {_DL} SELECT w.key, {", ".join(f"{_OR(f'r.{c}', f'i.{c}')} AS {c}" for c in ("title", "journal"))}, concat_ws('; ', CASE WHEN r.key IS NOT NULL THEN 'Crossref' END, CASE WHEN i.key IS NOT NULL THEN 'OpenAlex' END) AS sources, r.key IS NULL AND i.key IS NULL AS rejected
FROM wanted w LEFT JOIN registry r ON r.key = w.key LEFT JOIN idx i ON i.key = w.key""")
def submission_record(spark, sf_dir):
    """What two lookups make of a submitted key, and which of them know it."""
    out = enrich.assemble(_lookup(spark, sf_dir, "wanted"), _lookup(spark, sf_dir, "registry"), _lookup(spark, sf_dir, "idx"), pending.NAMES)
    return out.select("key", "title", "journal", F.array_join("sources", "; ").alias("sources"), "rejected")


@query("SELECT CAST(p_partkey AS STRING) AS key, CASE WHEN p_partkey % 4 = 0 OR p_size % 5 = 0 THEN 0 ELSE p_size END::BIGINT AS cited FROM part")
def citation_lookup(spark, sf_dir):
    """Citation counts from answers of a lookup; some keys are unknown there, some answers hold no count."""
    part = _t(spark, sf_dir, "part")
    answers = part.where("p_partkey % 4 <> 0").selectExpr("CAST(p_partkey AS STRING) AS key", "CASE WHEN p_size % 5 = 0 THEN '{}' ELSE to_json(named_struct('cited_by_count', p_size)) END AS record")
    return lookups.counted(part.select(F.col("p_partkey").cast("string").alias("key")), answers)


@query("""WITH l AS (SELECT s_suppkey, 'N' || s_nationkey AS code, s_name AS name, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 2000 + s_suppkey % 7 END::INT AS year FROM supplier WHERE s_suppkey % 4 <> 0),
r AS (SELECT 'N' || c_nationkey AS code, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 2000 + c_custkey % 9 END::INT AS year, '10.7914/' || c_custkey AS doi, c_custkey AS seq FROM customer WHERE c_custkey % 6 <> 0 AND c_nationkey % 5 <> 0),
e AS (SELECT code, year, arg_max(doi, seq) AS d FROM r GROUP BY ALL), c AS (SELECT code, arg_max(doi, seq) AS d FROM r GROUP BY ALL)
SELECT s_suppkey AS at, l.code, l.name, l.year, coalesce(e.d, c.d, '') AS doi FROM l LEFT JOIN e ON e.code = l.code AND e.year = l.year LEFT JOIN c ON c.code = l.code""")
def seismic_networks(spark, sf_dir):
    """Lines of a station service with the identifiers of a registry: by code and first year, else by code; codes recur."""
    start = "CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE concat(2000 + s_suppkey % 7, '-01-01T00:00:00') END"
    lines = _t(spark, sf_dir, "supplier").selectExpr("s_suppkey AS at", f"CASE WHEN s_suppkey % 4 = 0 THEN concat(s_name, '|short') ELSE concat_ws('|', concat('N', s_nationkey), concat(' ', s_name, ' '), {start}, '', '3') END AS value")
    registry = _t(spark, sf_dir, "customer").where("c_nationkey % 5 <> 0").selectExpr(
        "concat('N', c_nationkey) AS fdsn_code", "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE concat(2000 + c_custkey % 9, '-03-04') END AS start_date", "CASE WHEN c_custkey % 6 = 0 THEN '' ELSE concat('10.7914/', c_custkey) END AS doi", "c_custkey AS seq"
    )
    return jobs.seismic(payloads.station_networks(lines, "at"), payloads.network_registry(registry)).select("at", "code", "name", "year", "doi")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {n.removesuffix("_query"): f for n, (f, _) in _REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {n.removesuffix("_query"): sql for n, (_, sql) in _REGISTRY.items()}
