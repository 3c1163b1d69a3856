"""Combining scans: year floor, caps per query, priority unions, year windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def year_floor(hits: DataFrame, least: int) -> DataFrame:
    """Rows of unknown year stay."""
    return hits.where(F.col("year").isNull() | (F.col("year") == 0) | (F.col("year") >= least))


def first_per_key(df: DataFrame, key: list[Column], order: list[Column]) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def capped(df: DataFrame, by: list[str], order: list[Column], cap: int) -> DataFrame:
    """The first ``cap`` rows of each scan: what a paged source returns."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= cap)


def priority_union(first: DataFrame, second: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """All rows of first, and of second the first row of each key (in lower case) that first does not have."""
    k = F.lower(F.col(key))
    known = first.select(k.alias("_k")).distinct()
    rest = second.withColumn("_k", k).join(known, "_k", "left_anti")
    return first.unionByName(first_per_key(rest, [F.col("_k")], order).drop("_k"))


def year_windows(spark, least: int, current: int, width: int = 5) -> DataFrame:
    """start, end of consecutive windows; the last ends in the current year."""
    starts = spark.range(1).select(F.explode(F.sequence(F.lit(least), F.lit(current), F.lit(width))).alias("start"))
    return starts.select("start", F.least(F.col("start") + width - 1, F.lit(current)).alias("end"))


def tagged(df: DataFrame, source: str, label: Column) -> DataFrame:
    return df.withColumn("sources", F.array(F.lit(source))).withColumn("search_terms", F.array(label))
