"""Impact metrics over canonical publications."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import ratio_1, trimmed

# Subjects too general to count.
GENERIC = (
    "animals", "humans", "male", "female", "adult", "geology", "engineering", "environmental science", "computer science", "mathematics", "chemistry", "physics",
    "models, theoretical", "logistic models", "biomass", "tooth", "bone and bones", "compulsive behavior", "ecosystem", "biodiversity", "phylogeny", "oxygen",
    "temperature", "water", "time factors", "reproducibility of results",
)
# Citation ranges and their labels.
BUCKETS = ((0, 0, "0"), (1, 5, "1–5"), (6, 20, "6–20"), (21, 50, "21–50"), (51, 100, "51–100"), (101, 2**62, "100+"))


def summary(pubs: DataFrame) -> DataFrame:
    """One row of totals; exact distinct counts."""
    dated = F.when(F.col("year").isNotNull() & (F.col("year") != 0), F.col("year"))
    n, cited, with_cites = F.count(F.lit(1)), F.coalesce(F.sum("cited"), F.lit(0)), F.count_if(F.col("cited") > 0)
    return pubs.agg(
        n.alias("publications"),
        cited.alias("citations"),
        with_cites.alias("cited_publications"),
        F.count_distinct(F.nullif(F.col("journal"), F.lit(""))).alias("journals"),
        F.count_if(F.coalesce(F.col("subject"), F.lit("")) == "").alias("without_subject"),
        F.min(dated).alias("first_year"),
        F.max(dated).alias("last_year"),
    ).select(
        "*",
        ratio_1(100 * F.col("cited_publications"), F.col("publications")).alias("cited_percent"),
        ratio_1(F.col("citations"), F.col("publications")).alias("average_citations"),
        F.coalesce(F.concat_ws("–", F.col("first_year").cast("string"), F.col("last_year").cast("string")), F.lit("N/A")).alias("_r"),
    ).withColumn("year_range", F.when(F.col("first_year").isNull(), "N/A").otherwise(F.col("_r"))).drop("_r")


def distinct_authors(pubs: DataFrame) -> DataFrame:
    each = pubs.select(F.explode(F.split("authors", ";")).alias("a")).select(F.lower(trimmed(F.col("a"))).alias("a"))
    return each.where("a <> ''").agg(F.count_distinct("a").alias("authors"))


def distinct_items(pubs: DataFrame, column: str, name: str) -> DataFrame:
    return pubs.select(F.explode(column).alias("x")).where(trimmed(F.col("x")) != "").agg(F.count_distinct("x").alias(name))


def by_year(pubs: DataFrame, spine_if_empty: bool = False) -> DataFrame:
    """year, count, cumulative, citations, cumulative_citations for every year from the first to the last.

    The window runs over one row per year. ``spine_if_empty``: an empty input yields a single year 0.
    """
    per = pubs.where("year is not null and year <> 0").groupBy("year").agg(F.count(F.lit(1)).alias("count"), F.sum("cited").alias("citations"))
    ends = per.agg(F.min("year").alias("a"), F.max("year").alias("b"))
    ends = ends.fillna(0, ["a", "b"]) if spine_if_empty else ends.where("a is not null")
    spine = ends.select(F.explode(F.sequence("a", "b")).alias("year"))
    w = Window.orderBy("year").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    full = spine.join(per, "year", "left").select("year", F.coalesce("count", F.lit(0)).alias("count"), F.coalesce("citations", F.lit(0)).alias("citations"))
    return full.select("year", "count", F.sum("count").over(w).alias("cumulative"), "citations", F.sum("citations").over(w).alias("cumulative_citations"))


def top_subjects(pubs: DataFrame, order: list[str], k: int = 15, generic: tuple[str, ...] = GENERIC) -> DataFrame:
    """The k most frequent subjects; ties go to the one seen first."""
    each = pubs.select(*order, F.posexplode(F.split("subject", ";")).alias("pos", "t")).withColumn("topic", trimmed(F.col("t")))
    each = each.where((F.col("topic") != "") & ~F.lower("topic").isin(*generic))
    per = each.groupBy("topic").agg(F.count(F.lit(1)).alias("count"), F.min(F.struct(*order, "pos")).alias("seen"))
    return per.orderBy(F.col("count").desc(), "seen").limit(k).select("topic", "count")


def citation_buckets(pubs: DataFrame) -> DataFrame:
    """label, count for each range, empty ones too; an unknown count is 0, negative ones belong to none."""
    nth = None
    for i, (lo, hi, _) in enumerate(BUCKETS):
        hit = F.coalesce("cited", F.lit(0)).between(lo, hi)
        nth = F.when(hit, i) if nth is None else nth.when(hit, i)
    per = pubs.groupBy(nth.alias("nth")).agg(F.count(F.lit(1)).alias("n"))
    labels = pubs.sparkSession.createDataFrame([(i, b[2]) for i, b in enumerate(BUCKETS)], "nth int, label string")
    return labels.join(per, "nth", "left").select("nth", "label", F.coalesce("n", F.lit(0)).alias("count"))
