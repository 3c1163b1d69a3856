"""Tables of immutable data folders and numbered manifests: commits by one move, readers on a snapshot, rollback, upserts by bucket.

Below a table's path: data/<id>/ (written once, never changed) and manifests/<number>.json, each of which says what the table is at
that version: its folders (of the whole table, or one for each bucket of keys), its schema, the last run of each writer, and what
was counted while it was written. A commit writes its data, then moves a manifest to the next number, where there must be none: two
writers that began at one version cannot both get it (ConcurrentWrite). A run that dies before that leaves the table as it was; its
data folder is in no manifest and goes with the next vacuum().

Moves within one folder must fail where the target exists, as they do in HDFS; object stores need a committer that can do the same.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .files import Store

BUCKET = "_bucket"


class ConcurrentWrite(RuntimeError):
    """Another writer has committed since this one read the table."""


def bucket_of(key: Column, buckets: int, spread: Column | None = None) -> Column:
    """The bucket of a key; rows without one, which nothing looks for, are dealt by ``spread``."""
    h = F.xxhash64(key) if spread is None else F.when(F.coalesce(key, F.lit("")) == "", F.xxhash64(spread)).otherwise(F.xxhash64(key))
    return F.pmod(h, F.lit(buckets)).cast("int")


class Table:
    """``key``, ``buckets`` and ``spread`` hold for a table that does not exist yet; of an existing one its manifest says how it is dealt.

    Rows without a key are dealt by the column ``spread``, which no merge may change.

    An upsert rewrites what its keys' buckets hold, so there should be as many as make one a fraction of a run's own work.
    """

    def __init__(self, spark: SparkSession, path: str, key: str | None = None, buckets: int = 0, spread: str | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self.store = Store(spark, self.path)
        self.dealt = {"key": key, "buckets": buckets, "spread": spread}

    def _dealt(self, m: dict | None) -> dict:
        return {k: (m or self.dealt)[k] for k in ("key", "buckets", "spread")}

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self.store.names(f"{self.path}/manifests") if n.endswith(".json") and n[:-5].isdigit()]

    def version(self) -> int:
        """The last one; 0 if nothing has been committed."""
        return max(self.versions(), default=0)

    def manifest(self, version: int | None = None) -> dict | None:
        n = self.version() if version is None else version
        return json.loads(self.store.read(self._manifest(n))) if n else None

    def _manifest(self, n: int) -> str:
        return f"{self.path}/manifests/{n:012d}.json"

    def read(self, version: int | None = None, only: list[int] | None = None, schema: str | None = None) -> DataFrame:
        """The table at a version, which no later commit changes. ``only``: of these buckets. No table: no rows, of ``schema``."""
        m = self.manifest(version)
        if m is None:
            if schema is None:
                raise FileNotFoundError(self.path)
            return self.spark.createDataFrame([], schema)
        wanted = None if only is None else set(only)
        folders = [f"{self.path}/{f}" for b, f in m["folders"].items() if wanted is None or int(b) in wanted]
        known = StructType.fromJson(m["schema"])
        return self.spark.read.schema(known).parquet(*folders) if folders else self.spark.createDataFrame([], known)

    def _written(self, df: DataFrame, m: dict | None, counts: dict[str, Column]) -> tuple[dict[str, str], dict, dict]:
        """(folders, schema, what was counted) of df, written once: the counts are observed in that write."""
        name = f"data/{uuid.uuid4().hex}"
        seen = Observation() if counts else None
        out = df.observe(seen, *[c.alias(n) for n, c in counts.items()]) if counts else df
        keep = [c for c in df.columns if not c.startswith("_")]
        key, buckets, spread = self._dealt(m).values()
        if buckets:
            dealt = out.select(*keep, bucket_of(F.col(key), buckets, F.col(spread) if spread else None).alias(BUCKET))
            dealt.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/{name}")  # a large bucket is written by several tasks
            folders = {n.split("=")[1]: f"{name}/{n}" for n in self.store.names(f"{self.path}/{name}") if n.startswith(f"{BUCKET}=")}
        else:
            out.select(*keep).write.parquet(f"{self.path}/{name}")
            folders = {"0": name}
        return folders, json.loads(df.select(*keep).schema.json()), seen.get if seen else {}

    def _commit(self, base: int, m: dict) -> int:
        n = base + 1
        try:
            self.store.write(self._manifest(n), json.dumps(m | {"version": n, "parent": base}, default=str))
        except FileExistsError as e:
            raise ConcurrentWrite(f"{self.path} has a version {n} already") from e
        return n

    def _done(self, m: dict | None, run: tuple[str, int] | None) -> bool:
        return bool(m and run and m["runs"].get(run[0], -1) >= run[1])

    def _runs(self, m: dict | None, run: tuple[str, int] | None) -> dict:
        return (m["runs"] if m else {}) | ({run[0]: run[1]} if run else {})

    def overwrite(self, df: DataFrame, run: tuple[str, int] | None = None, counts: dict[str, Column] | None = None) -> dict:
        """All rows anew; the counts of this write. df may read the table itself. ``run`` (writer, number): one that is committed is not repeated."""
        base = self.version()
        m = self.manifest(base)
        if self._done(m, run):
            return m["counts"]
        folders, schema, seen = self._written(df, m, counts or {})
        self._commit(base, self._dealt(m) | {"folders": folders, "schema": schema, "runs": self._runs(m, run), "counts": seen})
        return seen

    def upsert(self, new: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], schema: str | None = None, run: tuple[str, int] | None = None, counts: dict[str, Column] | None = None) -> dict:
        """Merges rows with a key into the buckets that their keys fall in; the others keep their folders. The counts of this write.

        ``merge(old, new)`` gets what these buckets hold and gives what they hold afterwards: it must not make keys of other
        buckets. ``new`` is used twice, so it should be a written table. A run that is committed already does nothing.
        """
        base = self.version()
        m = self.manifest(base)
        if self._done(m, run):
            return m["counts"]
        own = self._dealt(m)
        touched = [r[0] for r in new.select(bucket_of(F.col(own["key"]), own["buckets"])).distinct().collect()]  # ``buckets`` numbers at most
        if m is None:
            old = self.spark.createDataFrame([], schema or new.schema)
        else:
            old = self.read(base, only=touched)
        folders, written, seen = self._written(merge(old, new), m, counts or {})
        kept = {b: f for b, f in (m["folders"] if m else {}).items() if int(b) not in set(touched)}
        if set(kept) & set(folders):
            raise ValueError("the merge made keys of buckets that it did not read")
        self._commit(base, own | {"folders": kept | folders, "schema": written, "runs": self._runs(m, run), "counts": seen})
        return seen

    def rollback(self, version: int) -> int:
        """A new version that is what the table was at ``version``; runs that came since count as not done."""
        return self._commit(self.version(), self.manifest(version))

    def vacuum(self, keep: int = 2) -> list[str]:
        """Deletes the manifests but the last ``keep`` and data folders in none of these; not while a writer or an older reader is at work."""
        versions = self.versions()
        for n in versions[:-keep]:
            self.store.delete(self._manifest(n))
        for n in self.store.names(f"{self.path}/manifests"):
            if n.endswith(".tmp"):
                self.store.delete(f"{self.path}/manifests/{n}")
        used = {f.split("/")[1] for n in versions[-keep:] for f in self.manifest(n)["folders"].values()}
        gone = [n for n in self.store.names(f"{self.path}/data") if n not in used]
        for n in gone:
            self.store.delete(f"{self.path}/data/{n}")
        return gone
