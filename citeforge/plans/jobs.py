"""The runs end to end: harvest, dataset inventory and maintenance, from landed answers to tables.

Landed hits are (query_idx, pass, win, page, row, record) for each service, as ``sources.paged`` reads them. Every run
returns frames and a one-row frame of counters; writing is the caller's (``sources.tables``).
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import enrich, harvest, inventory, merge
from ..sources import geonetwork, payloads
from ..sources.files import Store
from ..sources.paged import SCHEMA, Scan, left, scans_json

#: Services in the order in which their hits count: (name, reader, label in ``sources``, only for the first query).
ORDER = (
    ("openalex", "openalex", "OpenAlex", False),
    ("semantic_scholar", "semantic_scholar", "Semantic Scholar", True),
    ("europepmc", "europepmc", "Europe PMC", False),
    ("europepmc_ack", "europepmc", "Europe PMC", True),
    ("core", "core", "CORE", True),
    ("dimensions", "dimensions", "Dimensions", True),
)
PLACE = ("query_idx", "pass", "win", "page", "row")


@dataclass(frozen=True)
class Settings:
    queries: list[str] = field(default_factory=list)
    min_year: int = 1997
    primary_max_pages: int = 20
    secondary_max_pages: int = 2
    email: str = ""

    @staticmethod
    def load(path: str) -> Settings:
        """From a JSON file; unknown settings are ignored."""
        with open(path, encoding="utf-8") as f:
            given = json.load(f)
        given = {("queries" if k == "search_queries" else k): v for k, v in given.items()}
        return Settings(**{k: v for k, v in given.items() if k in Settings.__dataclass_fields__})

    def frame(self, spark: SparkSession) -> DataFrame:
        """query_idx, text, label, primary (the first query)."""
        rows = spark.createDataFrame([(i, q) for i, q in enumerate(self.queries)], "query_idx int, text string")
        return rows.select("query_idx", "text", S.query_label(F.col("text")).alias("label"), (F.col("query_idx") == 0).alias("primary"))


def scans(settings: Settings, name: str, current_year: int) -> list[Scan]:
    """What to ask a service: for each query one scan, or one for each pass and window of years of the first query."""
    first_only = next(o[3] for o in ORDER if o[0] == name)
    pages = {"semantic_scholar": 5, "europepmc": 5, "europepmc_ack": 5, "core": 2, "dimensions": 2}
    pages_of = lambda i: settings.secondary_max_pages if name == "europepmc" and i > 0 else pages[name]
    out = []
    for i, text in enumerate(settings.queries[:1] if first_only else settings.queries):
        if name != "openalex":
            out.append(Scan(i, 'ACK_FUND:"' + text.replace('"', "") + '"' if name == "europepmc_ack" else text, pages=pages_of(i)))
            continue
        starts = range(settings.min_year, current_year + 1, 5) if i == 0 else (None,)
        for w, a in enumerate(starts):
            years = "" if a is None else f",publication_year:{a}-{min(a + 4, current_year)}"
            for p, kind in enumerate(("fulltext.search", "default.search")):
                out.append(Scan(i, text, p, w, kind, years, settings.primary_max_pages if i == 0 else settings.secondary_max_pages))
    return out


def scan_frame(queries: DataFrame, current_year: int, min_year: int = 1997, primary_max_pages: int = 20, secondary_max_pages: int = 2) -> DataFrame:
    """scans() of all services for queries(query_idx, text) of any number, as a frame: service, query_idx, pass, win, filter, years, pages, text."""
    first = F.col("query_idx") == 0
    q = queries.select(F.col("query_idx").cast("int").alias("query_idx"), "text")
    none = F.lit("").alias("filter"), F.lit("").alias("years")
    ack = F.concat(F.lit('ACK_FUND:"'), S.quotes_dropped(F.col("text")), F.lit('"'))
    limits = {"semantic_scholar": 5, "europepmc_ack": 5, "core": 2, "dimensions": 2}
    plain = F.array(F.struct(F.lit("europepmc").alias("service"), F.when(first, 5).otherwise(secondary_max_pages).alias("pages"), F.col("text").alias("asked")), *[F.struct(F.lit(n).alias("service"), F.when(first, k).alias("pages"), (ack if n == "europepmc_ack" else F.col("text")).alias("asked")) for n, k in limits.items()])
    others = q.select("query_idx", F.explode(plain).alias("s")).where("s.pages is not null")  # most services are asked for the first query only
    others = others.select("s.service", "query_idx", F.lit(0).alias("pass"), F.lit(0).alias("win"), *none, "s.pages", F.col("s.asked").alias("text"))
    starts = F.when(first, F.sequence(F.lit(min_year), F.lit(current_year), F.lit(5))).otherwise(F.array(F.lit(None).cast("int")))
    alex = q.select("query_idx", "text", F.posexplode(starts).alias("win", "start")).select("*", F.posexplode(F.array(F.lit("fulltext.search"), F.lit("default.search"))).alias("pass", "filter"))
    years = F.when(F.col("start").isNull(), "").otherwise(F.concat(F.lit(",publication_year:"), F.col("start").cast("string"), F.lit("-"), F.least(F.col("start") + 4, F.lit(current_year)).cast("string")))
    alex = alex.select(F.lit("openalex").alias("service"), "query_idx", "pass", "win", "filter", years.alias("years"), F.when(first, primary_max_pages).otherwise(secondary_max_pages).alias("pages"), "text")
    return alex.unionByName(others)


def land(spark: SparkSession, settings: Settings, name: str, current_year: int, path: str, key: str = "", resume: bool = False, **options: str) -> DataFrame:
    """Asks a service and writes its answers to ``path`` before anything is done with them. ``paged`` must be registered.

    ``resume``: what lies there stays, and only scans that are not done are asked, from where they stopped. Rows are hits; how each scan
    ended lies beside them (paged.failures).
    """
    service = next(o[1] for o in ORDER if o[0] == name)
    wanted = scans(settings, name, current_year)
    there = resume and Store(spark, path).exists(f"{path}/_SUCCESS")
    wanted = left(spark.read.schema(SCHEMA).parquet(path), wanted) if there else wanted
    if wanted or not there:
        given = {"service": service, "scans": scans_json(wanted), "key": key, "mail": settings.email, **options}
        spark.read.format("paged").options(**given).load().write.mode("append" if there else "overwrite").parquet(path)
    return spark.read.schema(SCHEMA).parquet(path).where("record is not null")


def hits(landed: dict[str, DataFrame], queries: DataFrame) -> DataFrame:
    """Canonical hits of all services, each with ``seq``; services that are missing from ``landed`` have none."""
    labels = F.broadcast(queries.select("query_idx", "label"))  # a row for each query of the settings
    every = []
    for rank, (name, reader, source, _) in enumerate(ORDER):
        if name not in landed:
            continue
        own = payloads.read_records(landed[name], payloads.SCHEMAS[reader], *PLACE)
        rows = payloads.READERS[reader](own, keep=PLACE)
        rows = rows.withColumn("seq", F.struct("query_idx", F.lit(rank).alias("rank"), F.col("pass"), "win", "page", "row"))
        if name == "openalex":  # the full-text pass wins within a query
            rows = rows.withColumn("_q", F.concat_ws(":", "query_idx", F.col("doi")))
            rows = harvest.priority_union(rows.where("pass = 0"), rows.where("pass > 0"), "_q", [F.col("seq")]).drop("_q")
        every.append(merge.canonical(harvest.tagged(rows.join(labels, "query_idx"), source, F.col("label")), "seq"))
    return reduce(DataFrame.unionByName, every)


def _placed(df: DataFrame, *fields: Column) -> DataFrame:
    """``seq`` as six longs, the same type for stored records and new ones."""
    return df.withColumn("seq", F.struct(*[c.cast("long").alias(f"p{i}") for i, c in enumerate((*fields, *[F.lit(-1)] * (6 - len(fields))))]))


def numbered(merged: DataFrame) -> DataFrame:
    """Records to store, with ``nth``, which grows in the order of the result (by a range sort, not in one task)."""
    return merged.orderBy("o").withColumn("nth", F.monotonically_increasing_id()).drop("o", "added", "updated", "seq")


def renumbered(merged: DataFrame, start: int) -> DataFrame:
    """Records of a merge to store: known ones keep their ``nth``, added ones follow from ``start`` on, in the order of the result."""
    nth = F.when(F.col("added"), F.lit(start) + F.monotonically_increasing_id()).otherwise(F.col("o.seq.p0"))
    return merged.orderBy("o").withColumn("nth", nth).drop("o", "seq")


def harvest_run(landed: dict[str, DataFrame], queries: DataFrame, existing: DataFrame, run_date: Column, min_year: int = 1997) -> tuple[DataFrame, DataFrame]:
    """(publications, counters): hits from ``min_year`` on, one record a key, folded into existing ones (with ``nth``).

    Publications are as merge_into() gives them; numbered() makes them the next run's existing ones.
    """
    raw = hits(landed, queries)
    fresh = merge.merge_hits(harvest.year_floor(raw, min_year)).drop("key", "n_hits")
    place = [F.col("seq")[c] for c in ("query_idx", "rank", "pass", "win", "page", "row")]
    merged = merge.merge_into(_placed(existing, F.col("nth")), _placed(fresh, *place), run_date)
    unknown_or_late = F.col("year").isNull() | (F.col("year") == 0) | (F.col("year") >= min_year)
    counts = raw.agg(F.count(F.lit(1)).alias("raw"), F.count_if(unknown_or_late).alias("filtered"))
    return merged, counts.join(merge.merge_counters(merged))  # two single rows


def inventory_run(platforms: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(datasets, counters): rows of all platforms in their order (``at``), the first of each key."""
    rows = inventory.union_platforms(*[p.withColumn("at", F.struct(F.lit(i).alias("platform_nth"), F.col("at").alias("nth"))) for i, p in enumerate(platforms)])
    kept = inventory.dedup_datasets(rows, [F.col("at")])
    return kept.drop("key"), kept.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.coalesce("doi", F.lit("")) != "").alias("with_doi"))


def seismic(stations: DataFrame, registry: DataFrame) -> DataFrame:
    """Station networks (with ``at``) with the identifiers that a registry (code, year, doi, seq) knows."""
    return inventory.two_tier(stations, registry, "code", "year", "doi", "seq").withColumn("authors", F.lit(""))


def catalogue(edges: DataFrame, meta: DataFrame, root: Column) -> DataFrame:
    """Two levels below a root record, with what their own records say."""
    return geonetwork.datasets(inventory.two_levels(edges, root), meta).withColumn("at", F.struct("a", "b")).drop("a", "b")


def maintain_run(existing: DataFrame, registry: DataFrame, index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(publications, counters): one record a key, gaps filled from two lookup tables (key, ...)."""
    one = merge.maintain(existing)
    filled = enrich.fill_gaps(one, registry, index)
    return filled, filled.agg(F.count(F.lit(1)).alias("total"), F.sum("removed").alias("removed"), F.count_if("filled").alias("filled"))
