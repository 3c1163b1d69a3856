"""Entity resolution of publication records: order-faithful folds, as one aggregation per key.

Rows carry ``seq``, a struct that orders all hits; "first" always means least seq.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import normalise_doi

TEXTS = ("title", "authors", "journal", "publisher", "type", "subject")
DEFAULTS = {
    **{t: ("string", "''") for t in ("doi", *TEXTS)},
    "year": ("int", "null"),
    "cited": ("bigint", "0"),
    "is_oa": ("string", "'Unknown'"),
    "sources": ("array<string>", "array()"),
    "search_terms": ("array<string>", "array()"),
    "author_count": ("int", "0"),
    "institutions": ("array<string>", "array()"),
    "countries": ("array<string>", "array()"),
}


def canonical(df: DataFrame, *keep: str) -> DataFrame:
    """Canonical columns with defaults; missing columns are added, others dropped unless kept."""
    have = set(df.columns)
    cols = [F.coalesce(F.col(c), F.expr(d).cast(t)).cast(t).alias(c) if c in have else F.expr(d).cast(t).alias(c) for c, (t, d) in DEFAULTS.items()]
    return df.select(*cols, *[k for k in keep if k in have])


def _first(x: str, order: Column, known: Column) -> Column:
    return F.min_by(F.when(known, F.col(x)), F.when(known, order))


def _longest(x: str, size: Column, order: Column) -> Column:
    """The largest; the earliest of those as large (structs compare by fields, and -size puts the largest first)."""
    return F.min_by(F.col(x), F.struct(-size, order))


LISTS = ("sources", "search_terms")


def folded(rows: DataFrame, order: Column, *more: Column, maintain: bool = False) -> DataFrame:
    """One record for each key of rows: folds(), ``more`` aggregates, and ordered set unions of LISTS.

    Lists are reduced to the distinct ones of a key before they are gathered, so a key with very many hits is gathered
    only as far as its lists differ; everything else folds partially, before the shuffle. Rows are used twice: where they come out of
    joins, all their columns should go through the shuffles of these (as in catalog.JOINS), so that both uses share them.
    """
    each = rows.groupBy("key", *LISTS).agg(F.min(order).alias("_o"))
    lists = each.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("_o", *LISTS))).alias("_lists"))
    union = lambda x: F.array_distinct(F.flatten(F.transform("_lists", lambda r: r[x])))
    lists = lists.select("key", *[union(x).alias(x) for x in LISTS])
    return rows.groupBy("key").agg(*folds(order, maintain), *more).join(lists, "key")


def folds(order: Column, maintain: bool = False) -> list[Column]:
    """One aggregate for each field but LISTS; ``maintain``: lists of affiliations stay those of the first record."""
    out = [F.min_by("doi", order).alias("doi")]
    out += [_longest(t, F.length(t), order).alias(t) for t in TEXTS]
    out += [
        _first("year", order, F.col("year").isNotNull() & (F.col("year") != 0)).alias("year"),
        F.max("cited").alias("cited"),
        F.coalesce(_first("is_oa", order, F.col("is_oa") != "Unknown"), F.lit("Unknown")).alias("is_oa"),
    ]
    lists = ("institutions", "countries")
    if maintain:
        return out + [F.min_by(c, order).alias(c) for c in (*lists, "author_count")]
    return out + [_longest(c, F.size(c), order).alias(c) for c in lists] + [F.max("author_count").alias("author_count")]


def keyed(df: DataFrame) -> DataFrame:
    return df.withColumn("key", normalise_doi(F.col("doi")))


def merge_hits(hits: DataFrame) -> DataFrame:
    """One record per key; rows without a key are dropped."""
    rows = keyed(canonical(hits, "seq")).where("key <> ''")
    return folded(rows, F.col("seq"), F.count(F.lit(1)).alias("n_hits"), F.min("seq").alias("seq"))


def merge_into(existing: DataFrame, new: DataFrame, run_date: Column) -> DataFrame:
    """existing with new folded in: new hits go to the last existing row of their key, other rows pass unchanged.

    Adds ``o`` (the order of the result), ``added`` and ``updated`` (its list of sources grew). Rows without a key pass as they are, wherever
    they lie: they have no last row to look for.
    """
    tag = lambda df, n: keyed(canonical(df, "seq", "date_added")).withColumn("o", F.struct(F.lit(n).alias("is_new"), F.col("seq")))
    old = tag(existing if "date_added" in existing.columns else existing.withColumn("date_added", F.lit(None).cast("date")), 0)
    # rows without a key are dealt by their place; no key begins with a blank, so none of these meets a key
    old = old.withColumn("_at", F.when(F.col("key") == "", F.concat(F.lit(" "), F.xxhash64("seq").cast("string"))).otherwise(F.col("key")))
    last = Window.partitionBy("_at").orderBy(F.col("seq").desc())
    old = old.withColumn("_target", (F.row_number().over(last) == 1) & (F.col("key") != "")).drop("seq")
    fresh = folded(tag(new.drop("date_added"), 1).where("key <> ''"), F.col("o"), F.min("o").alias("o"))
    both = old.alias("old").join(fresh.alias("new"), (F.col("old._at") == F.col("new.key")) & F.col("old._target"), "full")
    return both.select(*_into(run_date))


def _into(run_date: Column) -> list[Column]:
    """What a row old of merge_into() and the folded hits new of its key make, either of which may be missing; all hits of new come after old."""
    o, n = (lambda c: F.col(f"old.{c}")), (lambda c: F.col(f"new.{c}"))
    added, target, met = o("key").isNull(), F.coalesce(o("_target"), F.lit(False)), n("key").isNotNull()
    either = lambda c, kept: F.when(added | (met & ~kept), n(c)).otherwise(o(c)).alias(c)
    known = o("year").isNotNull() & (o("year") != 0)
    union = {x: F.when(added, n(x)).when(target, F.array_distinct(F.concat(o(x), F.coalesce(n(x), F.array().cast("array<string>"))))).otherwise(o(x)) for x in LISTS}
    return [
        F.coalesce(o("key"), n("key")).alias("key"),
        either("doi", F.lit(True)),
        *[either(t, F.length(o(t)) >= F.length(n(t))) for t in TEXTS],
        F.when(added | (target & ~known), n("year")).otherwise(o("year")).alias("year"),
        F.greatest(o("cited"), n("cited")).alias("cited"),
        either("is_oa", o("is_oa") != "Unknown"),
        *[either(c, F.size(o(c)) >= F.size(n(c))) for c in ("institutions", "countries")],
        F.greatest(o("author_count"), n("author_count")).alias("author_count"),
        F.when(added, run_date.cast("date")).otherwise(o("date_added")).alias("date_added"),
        F.coalesce(o("o"), n("o")).alias("o"),
        *[c.alias(x) for x, c in union.items()],
        added.alias("added"),
        (~added & met & (F.size(union["sources"]) > F.size(F.array_distinct(o("sources"))))).alias("updated"),
    ]


def merge_counters(merged: DataFrame) -> DataFrame:
    return merged.agg(F.count(F.lit(1)).alias("total"), F.count_if("added").alias("added"), F.count_if("updated").alias("updated"))


def maintain(existing: DataFrame) -> DataFrame:
    """Existing records reduced to one per key; affiliations stay those of the first, date_added is the first there is."""
    with_date = existing if "date_added" in existing.columns else existing.withColumn("date_added", F.lit(None).cast("date"))
    rows = keyed(canonical(with_date, "seq", "date_added")).where("key <> ''")
    seq = F.col("seq")
    return folded(rows, seq, _first("date_added", seq, F.col("date_added").isNotNull()).alias("date_added"), (F.count(F.lit(1)) - 1).alias("removed"), F.min("seq").alias("seq"), maintain=True)
