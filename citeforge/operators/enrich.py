"""Lookups by key: full assembly, filling of gaps, and anti-joins against what is known."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import number_or, or_else
from .harvest import first_per_key


def _named(df: DataFrame, p: str) -> DataFrame:
    return df.select(F.col("key"), *[F.col(c).alias(f"{p}_{c}") for c in df.columns if c != "key"], F.lit(True).alias(f"{p}_found"))


def assemble(wanted: DataFrame, registry: DataFrame, index: DataFrame, names: tuple[str, str] | None = None) -> DataFrame:
    """Records of wanted(key) from two lookup tables; ``rejected`` where neither knows the key.

    Subject and access flag prefer the index, everything else the registry; citations are the larger count. ``names`` of the two
    tables: adds ``sources``, those that know the key.
    """
    j = wanted.join(_named(registry, "r"), "key", "left").join(_named(index, "i"), "key", "left")
    r, i = (lambda c: F.col(f"r_{c}")), (lambda c: F.col(f"i_{c}"))
    texts = {c: or_else(r(c), i(c), F.lit("")) for c in ("title", "authors", "journal", "publisher", "type")}
    return j.select(
        *[c for c in wanted.columns],
        *[v.alias(c) for c, v in texts.items()],
        number_or(r("year"), number_or(i("year"), F.lit(None).cast("int"))).alias("year"),
        F.greatest(F.coalesce(r("cited"), F.lit(0)), F.coalesce(i("cited"), F.lit(0))).alias("cited"),
        or_else(i("subject"), r("subject"), F.lit("")).alias("subject"),
        or_else(i("is_oa"), r("is_oa"), F.lit("Unknown")).alias("is_oa"),
        (F.col("r_found").isNull() & F.col("i_found").isNull()).alias("rejected"),
        *([F.array_compact(F.array(F.when(F.col("r_found"), names[0]), F.when(F.col("i_found"), names[1]))).alias("sources")] if names else []),
    )


def missing(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("")) == ""


def no_flag() -> Column:
    return F.coalesce(F.col("is_oa"), F.lit("")).isin("", "Unknown")


def fill_gaps(pubs: DataFrame, registry: DataFrame, index: DataFrame) -> DataFrame:
    """pubs(key, ...) with gaps filled; a lookup is consulted only where something it is asked for is missing.

    The registry: title, authors or journal. The index: subject or access flag, or title or authors if the registry knew nothing.
    Adds ``filled``: whether anything changed.
    """
    for_registry = missing("title") | missing("authors") | missing("journal")
    open_rows = for_registry | missing("subject") | no_flag()
    p = pubs.withColumn("_r", for_registry)
    r = _named(registry, "r").withColumnRenamed("key", "_rk")
    p = p.join(r, (F.col("key") == F.col("_rk")) & F.col("_r"), "left")
    unknown = F.col("r_found").isNull()
    p = p.withColumn("_i", missing("subject") | no_flag() | ((missing("title") | missing("authors")) & unknown))
    i = _named(index, "i").withColumnRenamed("key", "_ik")
    p = p.join(i, (F.col("key") == F.col("_ik")) & F.col("_i"), "left")
    new = {c: or_else(F.col(c), F.col(f"r_{c}"), F.col(f"i_{c}"), F.lit("")) for c in ("title", "authors", "journal", "publisher", "type")}
    new["subject"] = or_else(F.col("subject"), F.col("i_subject"), F.col("r_subject"), F.lit(""))
    oa = lambda c: F.nullif(F.nullif(F.col(c), F.lit("Unknown")), F.lit(""))
    new["is_oa"] = F.coalesce(oa("is_oa"), oa("i_is_oa"), oa("r_is_oa"), F.lit("Unknown"))
    new["year"] = number_or(F.col("year"), number_or(F.col("r_year"), F.col("i_year")))
    new["cited"] = F.greatest(F.col("cited"), F.coalesce(F.col("r_cited"), F.lit(0)), F.coalesce(F.col("i_cited"), F.lit(0)))
    old = {c: F.coalesce(F.col(c), F.lit("Unknown") if c == "is_oa" else F.lit("")) if c not in ("year", "cited") else F.col(c) for c in new}
    new = {c: F.when(open_rows, v).otherwise(old[c]) for c, v in new.items()}
    changed = None
    for c, v in new.items():
        d = ~v.eqNullSafe(old[c])
        changed = d if changed is None else changed | d
    rest = [c for c in pubs.columns if c not in new]
    return p.select(*rest, *[v.alias(c) for c, v in new.items()], changed.alias("filled"))


def pending(queue: DataFrame, existing: DataFrame, order: list[Column]) -> DataFrame:
    """Queued keys that are not there yet, the first of each; empty keys are dropped."""
    fresh = queue.where("key <> ''").join(existing.select("key").distinct(), "key", "left_anti")
    return first_per_key(fresh, [F.col("key")], order)
