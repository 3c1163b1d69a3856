"""Whole runs over a home folder: search, datasets, the pending queue, maintenance, and what is published from them.

Below ``home``: landed/ (answers as they came), cache/ (answers of lookups), publications, datasets (tables with versions,
sources.snapshots), rejected, queue and its archive, report.json, index.html, widget.html. Every run lands what it asks, and commits a
table with one move; its counters are observed in the write that makes the table. A service or platform that fails is
reported and does not stop the others.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import enrich, harvest, merge
from ..sources import cache, lookups, paged, payloads
from ..sources.paged import Scan, scans_json
from ..sources.snapshots import Table
from ..sources.staging import staged
from ..streaming import pending
from . import jobs, report

BUCKETS = 64
EMPTY = "key string, doi string, nth long"
MANUAL = "Manual submission"


def publications(spark: SparkSession, home: str, buckets: int = BUCKETS) -> Table:
    return Table(spark, f"{home}/publications", "key", buckets, "nth")


def _counted(start: int) -> dict:
    """What is observed in a write of publications; ``next`` is the number that the next added record may get."""
    return {"added": F.count_if("_added"), "updated": F.count_if("_updated"), "next": F.greatest(F.coalesce(F.max("nth"), F.lit(-1)) + 1, F.lit(start))}


def _next(table: Table) -> int:
    return ((table.manifest() or {}).get("counts") or {}).get("next", 0)


def _merged_in(table: Table, fresh: DataFrame, place: list, run_date, run: tuple[str, int] | None = None) -> dict:
    """Publications with fresh records (one a key) folded in; only the buckets of their keys are read and written."""
    start = _next(table)

    def fold(old: DataFrame, new: DataFrame) -> DataFrame:
        merged = merge.merge_into(jobs._placed(old, F.col("nth")), jobs._placed(new, *place), run_date)
        return jobs.renumbered(merged, start).withColumnsRenamed({"added": "_added", "updated": "_updated"})

    seen = table.upsert(fresh, fold, EMPTY, run, _counted(start))
    return {"total": table.read().count(), "added": seen["added"], "updated": seen["updated"]}  # footers only


def search(spark: SparkSession, settings: jobs.Settings, home: str, current_year: int, run_date: str, keys: dict[str, str] | None = None, **options: str) -> dict:
    """Asks all services, folds the hits into the publications of ``home``, and returns the counters, with ``failed`` scans of each service.

    Answers lie in landed/<run_date>/: a run that is repeated on its date asks only for what is missing there.
    """
    landed, failed = {}, {}
    for name, *_ in jobs.ORDER:
        path = f"{home}/landed/{run_date}/{name}"
        landed[name] = jobs.land(spark, settings, name, current_year, path, (keys or {}).get(name, ""), resume=True, **options)
        if n := paged.failures(spark.read.schema(paged.SCHEMA).parquet(path)).count():
            failed[name] = n
    seen = Observation()
    late = F.col("year").isNull() | (F.col("year") == 0) | (F.col("year") >= settings.min_year)
    raw = jobs.hits(landed, settings.frame(spark)).observe(seen, F.count(F.lit(1)).alias("raw"), F.count_if(late).alias("filtered"))
    raw = staged(raw, "search-hits")  # answers are parsed once, and counted then
    fresh = staged(merge.merge_hits(harvest.year_floor(raw, settings.min_year)).drop("n_hits"), "search-records")
    place = [F.col("seq")[c] for c in ("query_idx", "rank", "pass", "win", "page", "row")]
    return seen.get | _merged_in(publications(spark, home), fresh, place, F.lit(run_date)) | {"failed": failed}


def datasets(spark: SparkSession, home: str, clients: list[str], roots: str | list[str], datacite: dict[str, str] | None = None, **bases: str) -> dict:
    """Lists the data sets of all platforms into ``home`` and returns the counters. ``bases``: addresses in place of the services' own (tests).

    ``roots``: records of the catalogue, each with its collection. A platform that fails adds no rows and is named in ``failed``.
    """
    flat = lambda df: df.withColumn("at", F.to_json(F.struct("at")))
    fast = {"pause": 0.0, "delay": 0.0} if "catalogue" in bases else {}

    def samples() -> DataFrame:
        given = {"service": "datacite", "scans": scans_json([Scan(i, c) for i, c in enumerate(clients)]), **(datacite or {})}
        first = lookups.landed(spark.read.format("paged").options(**given).load(), f"{home}/landed/datacite")
        if errors := paged.failures(first).take(1):
            failed.append({"platform": "datacite", "error": errors[0]["error"]})
        return payloads.datacite(payloads.read_records(first.withColumn("at", F.struct("query_idx", "page", "row")), payloads.DATACITE, "at"), "at")

    def seismic() -> DataFrame:
        return jobs.seismic(lookups.station_networks(spark, bases.get("stations", "")), lookups.network_registry(spark, bases.get("registry", "")))

    def collection(root: str) -> DataFrame:
        return jobs.catalogue(*lookups.catalogue(spark, root, f"{home}/landed/catalogue/{root}", base=bases.get("catalogue", ""), **fast), F.lit(root))

    failed: list[dict] = []
    frames = []
    steps: list[tuple[str, Callable[[], DataFrame]]] = [("datacite", samples), ("stations", seismic)]
    steps += [(f"catalogue {r}", lambda r=r: collection(r)) for r in ([roots] if isinstance(roots, str) else roots)]
    for name, step in steps:
        try:
            frames.append(staged(flat(step()), "datasets-platform"))
        except Exception as e:  # noqa: BLE001 - whatever a platform fails with, the others go on
            failed.append({"platform": name, "error": f"{type(e).__name__}: {e}"[:500]})
    if not frames:
        return {"total": 0, "with_doi": 0, "failed": failed}
    kept, _ = jobs.inventory_run(frames)
    counts = {"total": F.count(F.lit(1)), "with_doi": F.count_if(F.coalesce("doi", F.lit("")) != "")}
    return Table(spark, f"{home}/datasets").overwrite(kept.drop("at"), counts=counts) | {"failed": failed}


def submissions(spark: SparkSession, home: str, mail: str = "", now=None, **options) -> None:
    """Drains home/queue: what a service knows becomes a publication, what none knows goes to home/rejected.

    Answers are kept in home/cache: a key that was rejected is not asked again before its answer is too old.
    """
    table = publications(spark, home)
    known = lambda: table.read(schema=EMPTY).select("key")

    def ask(keys: DataFrame) -> tuple[DataFrame, DataFrame]:
        return lookups.projected(*[cache.ask(cache.open_table(spark, f"{home}/cache/{s}"), keys, s, mail, now, **options) for s in ("crossref", "openalex")])

    def accept(found: DataFrame, nth: int) -> None:
        new = staged(found.withColumn("doi", F.col("key")).withColumn("search_terms", F.array(F.lit(MANUAL))).withColumn("at", F.monotonically_increasing_id()), "submissions-found")
        if not new.isEmpty():
            _merged_in(table, new, [F.col("at")], F.current_date(), ("submissions", nth))

    def reject(df: DataFrame, nth: int) -> None:
        if not df.isEmpty():
            df.write.mode("overwrite").parquet(f"{home}/rejected/batch={nth}")

    pending.drained(spark, f"{home}/queue", f"{home}/queue-checkpoint", known, ask, accept, reject, f"{home}/queue-archive")


def maintain(spark: SparkSession, home: str, mail: str = "", now=None, **options) -> dict:
    """Publications reduced to one a key, gaps filled from the lookups; a service is asked only where something is missing that it may know."""
    table = publications(spark, home)
    if not table.version():
        return {"total": 0, "removed": 0, "filled": 0}
    one = staged(merge.maintain(table.read().withColumn("seq", F.struct("nth"))), "maintain-records")
    answers = lambda keys, s: cache.ask(cache.open_table(spark, f"{home}/cache/{s}"), keys, s, mail, now, **options)
    no_names = enrich.missing("title") | enrich.missing("authors")
    said = staged(answers(one.where(no_names | enrich.missing("journal")).select("key"), "crossref"), "maintain-registry")
    registry, _ = lookups.projected(said, said.limit(0))
    nameless = one.join(registry.select("key"), "key", "left_anti").where(no_names)
    asked = one.where(enrich.missing("subject") | enrich.no_flag()).select("key").unionByName(nameless.select("key"))
    _, index = lookups.projected(said.limit(0), answers(asked, "openalex"))
    filled = enrich.fill_gaps(one, registry, index).withColumn("seq", F.col("seq.nth")).orderBy("seq").withColumn("nth", F.monotonically_increasing_id()).drop("seq")
    filled = filled.withColumnsRenamed({"removed": "_removed", "filled": "_filled"})  # counted, not stored
    counts = {"total": F.count(F.lit(1)), "removed": F.coalesce(F.sum("_removed"), F.lit(0)), "filled": F.count_if("_filled"), "next": F.coalesce(F.max("nth"), F.lit(-1)) + 1}
    seen = table.overwrite(filled, counts=counts)
    return {k: seen[k] for k in ("total", "removed", "filled")}


def publish(spark: SparkSession, home: str, generated: str) -> dict:
    """Writes report.json, index.html and widget.html beside the tables that they describe; all of them or none, by the report sink."""
    pubs = merge.canonical(publications(spark, home).read(schema=EMPTY), "nth")
    sets = Table(spark, f"{home}/datasets").read(schema="doi string, name string")
    data = report.report(pubs, sets, ["nth"], generated)
    report.save(spark, home, {"report.json": report.to_json(data), "index.html": report.dashboard(data), "widget.html": report.widget(data)})
    return data
