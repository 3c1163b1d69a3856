"""Exact numbers of distinct items that add up over runs: dictionary codes and bitmaps beside the table.

A dictionary gives every item of a kind a number; known ones keep theirs. A run's bitmaps say which numbers occur in it, in buckets of
32,768; bitmaps of several runs, or years, are united without reading their rows again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import trimmed
from ..sources.staging import staged

DICTIONARY, BITMAPS = "kind string, item string, code bigint", "kind string, bucket bigint, bits binary"


def items(pubs: DataFrame, *keep: Column) -> DataFrame:
    """(keep..., kind, item) of every journal, author, institution, country and subject of publications, in one scan."""
    several = lambda c, kind, name=F.lower: F.transform(F.split(c, ";"), lambda x: F.struct(F.lit(kind).alias("kind"), name(trimmed(x)).alias("item")))
    listed = lambda c, kind: F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("item")))
    same = lambda x: x
    every = F.concat(
        F.array(F.struct(F.lit("journals").alias("kind"), F.col("journal").alias("item"))),
        several(F.coalesce("authors", F.lit("")), "authors"), several(F.coalesce("subject", F.lit("")), "subjects", same), listed("institutions", "institutions"), listed("countries", "countries"),
    )
    return pubs.select(*keep, F.explode(every).alias("x")).select("*", "x.*").drop("x").where(F.coalesce(trimmed(F.col("item")), F.lit("")) != "")


def extended(dictionary: DataFrame, found: DataFrame) -> DataFrame:
    """DICTIONARY rows: the old ones, and new items of found(kind, item) with numbers after the largest of their kind.

    New items are numbered within range partitions, which leave gaps; so does nothing else.
    """
    new = staged(found.select("kind", "item").distinct().join(dictionary.select("kind", "item"), ["kind", "item"], "left_anti").repartitionByRange("kind", "item").sortWithinPartitions("kind", "item").withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id() - F.shiftleft(F.col("_p").cast("bigint"), 33)), "distinct-new")
    sizes = new.groupBy("_p").agg(F.count(F.lit(1)).alias("n")).collect()  # a row for each partition
    starts, at = [], 0
    for r in sorted(sizes, key=lambda r: r["_p"]):
        starts.append((r["_p"], at))
        at += r["n"]
    top = (dictionary.agg(F.max("code")).first()[0] + 1) if not dictionary.isEmpty() else 0
    placed = new.join(F.broadcast(new.sparkSession.createDataFrame(starts, "_p int, _0 bigint")), "_p")
    return dictionary.unionByName(placed.select("kind", "item", (F.col("_i") + F.col("_0") + top).alias("code")))


def bitmaps(found: DataFrame, dictionary: DataFrame, *by: str) -> DataFrame:
    """(by..., kind, bucket, bits) of found(by..., kind, item): an item that occurs often is reduced to one row a task first."""
    coded = found.select(*by, "kind", "item").distinct().join(dictionary, ["kind", "item"])
    return coded.groupBy(*by, "kind", F.expr("code div 32768").alias("bucket")).agg(F.bitmap_construct_agg(F.expr("code % 32768")).alias("bits"))


def united(*runs: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Bitmaps of several runs as one; also of all values of columns that are left out of ``by``."""
    every = runs[0]
    for r in runs[1:]:
        every = every.unionByName(r)
    return every.groupBy(*by, "kind", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def numbers(maps: DataFrame, *by: str) -> DataFrame:
    """(by..., kind, n): how many items occur."""
    return maps.groupBy(*by, "kind").agg(F.sum(F.bitmap_count("bits")).alias("n"))


def wide(*kinds: str) -> list[Column]:
    """One column for each kind, for an aggregate over (kind, n)."""
    return [F.coalesce(F.max(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).alias(k) for k in kinds]
