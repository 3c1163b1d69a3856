"""How many values lie in each of many ranges: an equi-join over dyadic stretches in place of a comparison of all with all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the largest values; ranges lie within -2**62 .. 2**62.
BITS = 62


def stretches(lo: str, hi: str) -> str:
    """SQL of array<struct<level, at>>: the fewest aligned stretches [at, at + 1) * 2**level that make up lo .. hi, two a level at most."""
    first, stop = f"-shiftright(-{lo}, k)", f"shiftright({hi} + 1, k)"  # rounded up and down to stretches of this level
    odd = lambda x: f"(({x}) & 1) = 1"
    return f"""flatten(transform(sequence(0, {BITS}), k -> CASE WHEN {first} < {stop} THEN
      concat(CASE WHEN {odd(first)} THEN array(struct(k AS level, {first} AS at)) ELSE array() END, CASE WHEN {odd(stop)} THEN array(struct(k AS level, {stop} - 1 AS at)) ELSE array() END)
      ELSE array() END))"""


def counts(values: DataFrame, ranges: DataFrame, value: str, n: str | None = None) -> DataFrame:
    """ranges(id, lo, hi, ...) with ``n``, how many of values (or the sum of their column ``n``) lie in lo .. hi; 0 where none do.

    Each range is cut into aligned stretches, at most two of each level; values are summed up by value, then by stretch, only on
    levels that a range has. Both sums are partial before the shuffle, so no value and no stretch is hot. Null values lie in no
    range; a range with a null end, or with its end before its start, holds nothing. Repeated ranges count alike.
    """
    spark = values.sparkSession
    ranges = ranges.withColumns({"lo": F.col("lo").cast("bigint"), "hi": F.col("hi").cast("bigint")})
    ends = ranges.select("lo", "hi").where("lo <= hi").distinct()
    cut = ends.withColumn("s", F.explode(F.expr(stretches("lo", "hi")))).select("lo", "hi", "s.level", "s.at")
    levels = sorted(r["level"] for r in cut.select("level").distinct().collect())  # BITS + 1 at most
    each = values.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("bigint").alias("v")).agg((F.sum(n) if n else F.count(F.lit(1))).alias("n"))
    if levels:
        per = each.select(F.explode(F.array(*[F.lit(k) for k in levels])).alias("level"), "v", "n").groupBy("level", F.expr("shiftright(v, level)").alias("at")).agg(F.sum("n").alias("n"))
    else:
        per = spark.createDataFrame([], "level int, at bigint, n bigint")
    found = cut.join(per, ["level", "at"]).groupBy("lo", "hi").agg(F.sum("n").alias("n"))
    return ranges.join(found, ["lo", "hi"], "left").select(*ranges.columns, F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
