"""Lookups by key in public services: publications by identifier, catalogue records and their children, seismic networks.

ask() gives (key, record), the answer as JSON text, and no row for a key that is unknown or whose request fails: nothing
known is nothing to fill in. Answers are landed before anything is done with them, so no later action asks again.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote
from urllib.request import Request, urlopen

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import geonetwork, payloads
from .fetch import fetch_json


@dataclass(frozen=True)
class Lookup:
    base: str
    path: str
    pause: float


# Addresses and pauses of public services. {k}: key, {m}: mail.
LOOKUPS = {
    "crossref": Lookup("https://api.crossref.org", "/works/{k}?mailto={m}", 0.2),
    "openalex": Lookup("https://api.openalex.org", "/works/doi:{k}?mailto={m}", 0.2),
    "openalex_count": Lookup("https://api.openalex.org", "/works/doi:{k}?select=cited_by_count&mailto={m}", 0.2),
    "children": Lookup("https://geonetwork.nci.org.au", "/geonetwork/srv/api/records/{k}/related?type=children", 0.2),
    "record": Lookup("https://geonetwork.nci.org.au", "/geonetwork/srv/api/records/{k}", 0.1),
}
STATIONS = ("https://auspass.edu.au", "/fdsnws/station/1/query?level=network&format=text")
REGISTRY = ("https://www.fdsn.org", "/ws/networks/1/query?format=json")
JSON_ONLY = {"Accept": "application/json"}


def asked(keys: DataFrame, name: str, mail: str = "", base: str = "", askers: int = 4, pause: float | None = None, delay: float = 3.0) -> DataFrame:
    """(key, record, status) for each key: found, unknown (the service has no such key) or failed. ``askers`` requests at a time at most, with a pause after each."""
    service = LOOKUPS[name]
    wait = service.pause if pause is None else pause

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for key in b["key"]:
                try:
                    answer = fetch_json((base or service.base) + service.path.format(k=quote(key, safe=""), m=quote(mail, safe="")), JSON_ONLY, delay=delay)
                    rows.append((key, json.dumps(answer, ensure_ascii=False), "found") if answer else (key, None, "unknown"))
                except (OSError, ValueError):  # HTTP and connection errors, or no JSON
                    rows.append((key, None, "failed"))
                time.sleep(wait)
            yield pd.DataFrame(rows, columns=["key", "record", "status"])

    return keys.where("key is not null and key <> ''").select("key").distinct().repartition(askers).mapInPandas(run, "key string, record string, status string")


def ask(keys: DataFrame, name: str, mail: str = "", **options) -> DataFrame:
    """(key, record) for each key that the service knows."""
    return asked(keys, name, mail, **options).where("status = 'found'").select("key", "record")


def landed(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def projected(crossref: DataFrame, openalex: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(registry, index) rows by key, as operators.enrich takes them, of answers (key, record)."""
    read = lambda df, name: payloads.read_records(df, payloads.SCHEMAS[name], "key")
    return payloads.crossref(read(crossref, "crossref"), keep=("key",)).drop("doi"), payloads.openalex(read(openalex, "openalex"), lookup=True, keep=("key",)).drop("doi")


def publications(keys: DataFrame, folder: str, mail: str = "", **options) -> tuple[DataFrame, DataFrame]:
    """(registry, index) rows of what the services say now."""
    return projected(*[landed(ask(keys, name, mail, **options), f"{folder}/{name}") for name in ("crossref", "openalex")])


def citation_counts(keys: DataFrame, folder: str, mail: str = "", **options) -> DataFrame:
    """(key, cited) for every key; 0 where nothing is known."""
    return counted(keys, landed(ask(keys, "openalex_count", mail, **options), f"{folder}/openalex_count"))


def counted(keys: DataFrame, answers: DataFrame) -> DataFrame:
    """(key, cited) for every key, of answers (key, record); 0 where there is none, or none that says."""
    return keys.select("key").join(answers, "key", "left").select("key", F.coalesce(F.get_json_object("record", "$.cited_by_count").cast("bigint"), F.lit(0)).alias("cited"))


def catalogue(spark: SparkSession, root: str, folder: str, **options) -> tuple[DataFrame, DataFrame]:
    """(edges, metadata) of two levels below a root record, as plans.jobs.catalogue takes them."""
    level = lambda keys, n: geonetwork.children(landed(ask(keys, "children", **options), f"{folder}/children-{n}").withColumnRenamed("key", "parent"))
    first = level(spark.createDataFrame([(root,)], "key string"), 1)
    second = level(first.select(F.col("id").alias("key")), 2)
    edges = first.unionByName(second.where(F.col("parent") != root))
    records = landed(ask(edges.select(F.col("id").alias("key")), "record", **options), f"{folder}/records")
    return edges, geonetwork.metadata(records.withColumnRenamed("key", "id"))


def station_networks(spark: SparkSession, base: str = "") -> DataFrame:
    """Networks of the station service, with ``at``, their place in its answer: one page of text, on the driver. Errors are raised."""
    with urlopen(Request((base or STATIONS[0]) + STATIONS[1]), timeout=60) as answer:
        lines = answer.read().decode().strip().split("\n")[1:]
    return payloads.station_networks(spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "at long, value string"), "at")


def network_registry(spark: SparkSession, base: str = "") -> DataFrame:
    """(code, year, doi, seq) of the registry of networks; empty if it cannot be read."""
    try:
        answer = fetch_json((base or REGISTRY[0]) + REGISTRY[1], retries=0)
        given = answer.get("networks") or [] if isinstance(answer, dict) else answer
    except (OSError, ValueError):
        given = []
    rows = [(n.get("fdsn_code"), n.get("start_date"), n.get("doi"), i) for i, n in enumerate(given) if isinstance(n, dict)]
    return payloads.network_registry(spark.createDataFrame(rows, payloads.NETWORKS + ", seq long"))
