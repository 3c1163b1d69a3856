"""Paged search services as a Python data source: ``spark.read.format("paged")``.

One partition for each scan (a query, a pass, a window of years): its pages depend on each other, scans do not. Rows are
(query_idx, pass, win, page, row, record): the order of a hit and its JSON text. What is read should be written out at
once, so that no later action asks the services again.

Every scan ends with a row without a record that says how: ``done``, or ``failed`` with the page, the cursor to go on from and
the error. A page that fails ends its own scan and nothing else; what came before is kept. left() gives the scans that are still to
do after what has been landed, each from where it stopped.

Options: ``service``; ``scans``, a JSON list of {query_idx, text, pass, win, filter, pages}; ``key``, ``mail``; ``base``, which
takes the place of the service's address (tests); ``pause``, seconds between pages.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from dataclasses import dataclass, replace
from urllib.parse import quote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .fetch import fetch_json

SCHEMA = "query_idx int, pass int, win int, page int, row int, record string, status string, cursor string, error string"


@dataclass(frozen=True)
class Service:
    """``numbering``: pages by number from 1, by offset, or by a cursor that each answer names. ``partial``: a failing page ends the scan for good."""

    base: str
    path: str
    records: tuple[str, ...]
    size: int
    numbering: str
    pause: float = 0.2
    partial: bool = False
    needs_key: bool = False
    headers: tuple[tuple[str, str], ...] = ()
    body: str = ""
    retries: int = 3
    delay: float = 3.0


# Addresses, fields, page sizes and pauses of public services. {q}: query, {n}: page, {o}: offset, {c}: cursor, {k}: key, {m}: mail, {f}: filter.
SERVICES = {
    "openalex": Service(
        "https://api.openalex.org", "/works?per_page=25&page={n}&filter={f}:{q}{w}&select=id,doi,title,publication_year,authorships,primary_location,cited_by_count,type,open_access,topics&sort=publication_year:desc&mailto={m}",
        ("results",), 25, "page", 0.1,
    ),
    "semantic_scholar": Service(
        "https://api.semanticscholar.org", "/graph/v1/paper/search?query={q}&offset={o}&limit=100&fields=title,authors,year,citationCount,externalIds,journal,openAccessPdf,publicationTypes,s2FieldsOfStudy",
        ("data",), 100, "offset", 3.0, partial=True, headers=(("x-api-key", "{k}"),), retries=2, delay=5.0,
    ),
    "europepmc": Service(
        "https://www.ebi.ac.uk", "/europepmc/webservices/rest/search?query={q}&resultType=core&pageSize=100&cursorMark={c}&format=json&sort=P_PDATE_D+desc",
        ("resultList", "result"), 100, "cursor",
    ),
    "core": Service("https://api.core.ac.uk", "/v3/search/works?q={q}&limit=100&offset={o}", ("results",), 100, "offset", 0.5, partial=True, needs_key=True, headers=(("Authorization", "Bearer {k}"),), retries=2, delay=2.0),
    "dimensions": Service(
        "https://app.dimensions.ai", "/api/dsl", ("publications",), 100, "offset", 1.0, partial=True, needs_key=True, headers=(("Authorization", "JWT {k}"), ("Content-Type", "text/plain")),
        body='search publications for "{s}" return publications[doi+title+year+journal+authors+times_cited+type+open_access+category_for] limit 100 skip {o}', retries=0,
    ),
    "datacite": Service("https://api.datacite.org", "/dois?client-id={q}&page[size]=100&page[number]={n}&sort=-created", ("data",), 100, "page"),
}
CURSOR = "nextCursorMark"


@dataclass
class Scan(InputPartition):
    query_idx: int
    text: str
    pass_: int = 0
    win: int = 0
    filter: str = ""
    years: str = ""
    pages: int | None = None
    page: int = 0  # pages that have been read
    cursor: str = "*"


def left(landed: DataFrame, scans: list[Scan]) -> list[Scan]:
    """The scans that landed rows do not show as done; those that failed go on from the page that did."""
    at = ["query_idx", "pass", "win"]
    ends = landed.where("status is not null").groupBy(*at).agg(F.max(F.col("status") == "done").alias("done"), F.max(F.struct("page", "cursor")).alias("last"))
    known = {tuple(r[c] for c in at): r for r in ends.collect()}  # a row for each scan of the settings
    out = []
    for s in scans:
        r = known.get((s.query_idx, s.pass_, s.win))
        if r is None:
            out.append(s)
        elif not r["done"]:
            out.append(replace(s, page=r["last"]["page"] - 1, cursor=r["last"]["cursor"]))
    return out


def failures(landed: DataFrame) -> DataFrame:
    """query_idx, pass, win, page, error of the scans that are not done."""
    at = ["query_idx", "pass", "win"]
    ends = landed.where("status is not null").groupBy(*at).agg(F.max(F.col("status") == "done").alias("done"), F.max(F.struct("page", "error")).alias("last"))
    return ends.where("not done").select(*at, "last.*")


def scans_json(scans: list[Scan]) -> str:
    return json.dumps([{k: v for k, v in vars(s).items()} for s in scans])


class PagedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.service = SERVICES[options["service"]]
        self.base = options.get("base") or self.service.base
        self.key, self.mail = options.get("key", ""), options.get("mail", "")
        self.pause = float(options.get("pause", self.service.pause))
        self.delay = float(options.get("delay", self.service.delay))
        self.scans = [Scan(**s) for s in json.loads(options["scans"])]

    def partitions(self) -> list[InputPartition]:
        """No scans where a key is needed and none is given."""
        return [] if self.service.needs_key and not self.key else self.scans

    def _token(self) -> str:
        """The key itself, or what a service gives for it."""
        if self.service.body:
            return fetch_json(f"{self.base}/api/auth", {"Content-Type": "application/json"}, json.dumps({"key": self.key}).encode(), retries=0).get("token") or ""
        return self.key

    def _ask(self, scan: Scan, page: int, cursor: str, token: str) -> dict:
        s = self.service
        fill = {"q": quote(scan.text, safe=""), "s": scan.text.replace('"', '\\"'), "n": page, "o": (page - 1) * s.size, "c": quote(cursor, safe=""), "k": token, "m": quote(self.mail, safe=""), "f": scan.filter, "w": scan.years}
        headers = {k: v.format(**fill) for k, v in s.headers if token or "{k}" not in v}
        body = s.body.format(**fill).encode() if s.body else None
        return fetch_json(self.base + s.path.format(**fill), headers, body, s.retries, self.delay)

    def read(self, scan: Scan | None) -> Iterator[tuple]:
        s = self.service
        if scan is None:  # what Spark makes of an empty list of partitions
            return
        cursor, page = scan.cursor, scan.page
        at = (scan.query_idx, scan.pass_, scan.win)
        try:
            if s.body and not (token := self._token()):
                raise OSError("no token for the key")
        except OSError as e:  # a key that is not accepted: no rows
            yield *at, page + 1, -1, None, "failed", cursor, str(e)[:500]
            return
        token = token if s.body else self.key
        while scan.pages is None or page < scan.pages:
            page += 1
            if page > scan.page + 1:
                time.sleep(self.pause)
            try:
                answer = self._ask(scan, page, cursor, token)
                rows = answer
                for name in s.records:
                    rows = (rows or {}).get(name) or {}
                records = [json.dumps(r, ensure_ascii=False) for r in rows]
                following = answer.get(CURSOR) or ""
            except (OSError, ValueError, AttributeError, TypeError) as e:  # HTTP and connection errors, or another kind of answer
                yield *at, page, -1, None, "done" if s.partial else "failed", cursor, f"{type(e).__name__}: {e}"[:500]
                return
            for i, r in enumerate(records):
                yield *at, page, i, r, None, None, None
            cursor = following
            if len(records) < s.size or (s.numbering == "cursor" and not cursor):
                break
        yield *at, page, -1, None, "done", cursor, None


class PagedSource(DataSource):
    """Register with ``spark.dataSource.register(PagedSource)``."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return PagedReader(dict(self.options))
