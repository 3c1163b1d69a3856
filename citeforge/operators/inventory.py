"""Dataset inventory: two-tier lookups, two-level hierarchies, first-per-key dedup, names by role."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import normalise_doi, or_else
from .harvest import first_per_key

ROLES = ("author", "creator", "originator")


def two_tier(left: DataFrame, right: DataFrame, code: str, year: str, value: str, seq: str) -> DataFrame:
    """left with ``value`` of the last right row of the same code and year, else of the same code, else ''."""
    exact = right.groupBy(code, year).agg(F.max_by(value, seq).alias("_exact"))
    loose = right.groupBy(code).agg(F.max_by(value, seq).alias("_loose"))
    return left.join(exact, [code, year], "left").join(loose, code, "left").withColumn(value, F.coalesce("_exact", "_loose", F.lit(""))).drop("_exact", "_loose")


def two_levels(edges: DataFrame, root: Column) -> DataFrame:
    """Children of root and their children, from edges(parent, id, title, pos); pre-order by (child, grandchild)."""
    child = edges.where(F.col("parent") == root).select("id", "title", F.col("pos").alias("a"), F.lit(-1).cast("long").alias("b"))
    grand = edges.select(F.col("parent").alias("_p"), F.col("id").alias("gid"), F.col("title").alias("gtitle"), F.col("pos").cast("long").alias("gpos"))
    below = child.join(grand, F.col("id") == F.col("_p")).select(F.col("gid").alias("id"), F.col("gtitle").alias("title"), "a", F.col("gpos").alias("b"))
    return child.unionByName(below)


def dedup_datasets(rows: DataFrame, order: list[Column]) -> DataFrame:
    """The first row of each identifier, else of each platform and beginning of the name."""
    doi = normalise_doi(F.col("doi"))
    key = F.when(doi != "", doi).otherwise(F.concat(F.col("platform"), F.lit(":"), F.substring(F.lower(F.coalesce("name", F.lit(""))), 1, 50)))
    return first_per_key(rows.withColumn("key", key), [F.col("key")], order)


def union_platforms(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def names_by_role(parties: Column, sep: str = "; ") -> Column:
    """Names (of a person, else of an organisation) in array<struct<role, individual, organisation>> with an author's role."""
    own = F.filter(parties, lambda p: p["role"].isin(*ROLES))
    return F.array_join(F.filter(F.transform(own, lambda p: or_else(p["individual"], p["organisation"], F.lit(""))), lambda s: s != ""), sep)
