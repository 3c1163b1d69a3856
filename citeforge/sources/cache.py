"""Answers of lookup services, kept: a table by key with what was found, what is unknown there, and since when.

A key is asked again when its answer is too old: found ones after ``found_days``, unknown ones after ``unknown_days``. A request that
fails says nothing about its key, so it is not kept and the next run asks again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import lookups
from .snapshots import Table
from .staging import staged

SCHEMA = "key string, record string, asked_at timestamp"
FOUND_DAYS, UNKNOWN_DAYS, BUCKETS = 90, 7, 64


def open_table(spark, path: str, buckets: int = BUCKETS) -> Table:
    return Table(spark, path, key="key", buckets=buckets)


def fresh(table: Table, now: Column, found_days: int = FOUND_DAYS, unknown_days: int = UNKNOWN_DAYS) -> DataFrame:
    """SCHEMA rows whose answers still count."""
    days = F.when(F.col("record").isNull(), unknown_days).otherwise(found_days)
    return table.read(schema=SCHEMA).where(F.col("asked_at") + F.make_interval(days=days) > now)


def latest(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row for each key: the new one if there is one."""
    return old.join(new.select("key"), "key", "left_anti").unionByName(new)


def ask(table: Table, keys: DataFrame, service: str, mail: str = "", now: Column | None = None, found_days: int = FOUND_DAYS, unknown_days: int = UNKNOWN_DAYS, **options) -> DataFrame:
    """(key, record) for those of keys(key) that the service knows, as lookups.ask(); the service is asked for what the table doesn't answer.

    What it says is committed to the table before it is used, so a run that dies later asks nothing twice.
    """
    now = F.current_timestamp() if now is None else now
    wanted = staged(keys.where("key is not null and key <> ''").select("key").distinct(), "cache-wanted")
    known = fresh(table, now, found_days, unknown_days)
    open_keys = staged(wanted.join(known.select("key"), "key", "left_anti"), "cache-open")
    if not open_keys.isEmpty():
        said = staged(lookups.asked(open_keys, service, mail, **options).where("status <> 'failed'").select("key", "record", now.alias("asked_at")), "cache-answers")
        if not said.isEmpty():
            table.upsert(said, latest, SCHEMA)
        known = fresh(table, now, found_days, unknown_days)
    return wanted.join(known.where("record is not null").select("key", "record"), "key")
