"""Mixing sources to target weights: Sainte-Lague apportionment of equal-token blocks.

DataFrame functions only. The size of a document is its number of words (no text: 0). Sources in
code-point order (null last) weigh 1, 2, 3, repeating; their targets share all words by weight, stop
at ``repeats`` times the source's own words, and what is cut off is shared again by weight among the rest.

Blocks of ``block`` words are the seats. Sources get seats by the highest quotients target / (2s + 1); in the same way
groups of shards share a source's seats by their size, and shards those of their group, so a hot source is dealt over as
many shards as it needs, none of them large. A shard has no more seats than ``repeats`` times its blocks; what it cannot
take goes to the next highest quotients. A shard lays its documents out in a seeded order as one stream of words; every
block of the stream is taken floor(quota / blocks) times, and a seeded, evenly spread choice of them once more.

A source's words lie within a block of its target, and for each shard what its last block lacks, as often as that is taken.
Sources are numbered and summed up over range partitions, so many of them need no single task.

Null text, empty text: size 0, taken 0. Null source: a source of its own, the last. Rows are dealt by doc_id and text, so
rows without an id, or that share one, are spread like others; repeated rows lie together. Repeated rows are
documents of their own; equal rows share a place in the order, so the rows as a set never vary. No
document is taken more than ``repeats`` times. An empty table gives an empty result. Further columns of
the input are ignored, or handed on with ``keep``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, free_name, staged

WORD = r"[^\x20\x09-\x0D]+"
BLOCK, REPEATS, SHARD_DOCS, FAN, SEED = 16, 3, 1024, 4096, "mix-1"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def seeded(*parts: Column) -> Column:
    """The first 60 bits of an MD5: the same number in any engine."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("long")


def running(df: DataFrame, order: list[Column], **sums: Column) -> DataFrame:
    """Adds ``nth`` (from 1) and, for each of ``sums``, the sum over all rows before, in an order without ties.

    Range partitions are numbered on their own; only one row for each partition meets in one task. What comes back is staged.
    """
    dealt = df.select("*", *[c.alias(f"_{n}") for n, c in sums.items()])
    dealt = staged(dealt.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()), "mix-ranges")
    part = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    before = dealt.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"), *[F.sum(f"_{n}").alias(f"_{n}") for n in sums])
    before = before.select("_p", *[F.coalesce(F.sum(f"_{n}").over(part), F.lit(0)).alias(f"_0{n}") for n in ("n", *sums)])
    up = Window.partitionBy("_p").orderBy(*order)
    earlier = up.rowsBetween(Window.unboundedPreceding, -1)
    out = dealt.join(F.broadcast(before), "_p")  # a row for each partition
    out = out.select(*df.columns, (F.row_number().over(up) + F.col("_0n")).alias("nth"), *[(F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)) + F.col(f"_0{n}")).alias(n) for n in sums])
    done = staged(out, "mix-running")
    discard(dealt)
    return done


def water_fill(sources: DataFrame, repeats: int) -> DataFrame:
    """(source, source_size, n_docs, target) of sources(source, source_size, n_docs): the level L with sum of min(w * L, cap) = total.

    Sources sorted by cap / w: all before the first whose cap exceeds its share of the rest stop at their cap.
    """
    named = running(sources, [F.col("source")]).withColumn("w", (F.col("nth") - 1) % 3 + 1).withColumn("cap", F.lit(repeats) * F.col("source_size")).withColumnRenamed("nth", "place")
    level = running(named, [F.col("cap") / F.col("w"), F.col("place")], caps=F.col("cap"), weights=F.col("w"))
    total = level.agg(F.sum("source_size").alias("size_all"), F.sum("w").alias("w_all"))
    level = level.crossJoin(F.broadcast(total)).withColumn("rest", F.col("size_all") - F.col("caps")).withColumn("w_rest", F.col("w_all") - F.col("weights"))  # a single row
    stop = level.where(F.col("rest") * F.col("w") <= F.col("cap") * F.col("w_rest")).agg(F.min(F.struct("nth", "rest", "w_rest")).alias("stop"))
    share = F.col("w").cast("double") * F.col("stop.rest").cast("double") / F.col("stop.w_rest").cast("double")
    target = F.when(F.col("nth") < F.col("stop.nth"), F.col("cap").cast("double")).otherwise(share)
    return level.crossJoin(F.broadcast(stop)).select("source", "source_size", "n_docs", target.alias("target"))


def apportion(df: DataFrame, by: list[str], claim: Column, seats: Column, order: list[str], most: Column | None = None) -> DataFrame:
    """Adds ``quota``: within each group of ``by`` (none: over all rows), ``seats`` dealt by the highest quotients claim / (2s + 1), ``most`` to a row.

    With n claimants and M seats the divisor lies within M -+ n/2 of the even one, and limits that leave room for the
    even shares move it by n at most; seats below that are sure, and only the few quotients in between are ranked.
    """
    given = df.withColumn("_c", claim).withColumn("_m", seats)
    if by:
        group = Window.partitionBy(*by)
        given = given.withColumn("_n", F.count(F.lit(1)).over(group)).withColumn("_t", F.sum("_c").over(group))
    else:
        given = given.crossJoin(F.broadcast(given.agg(F.count(F.lit(1)).alias("_n"), F.sum("_c").alias("_t"))))  # a single row
    limit = F.lit(2**62) if most is None else most
    given = (
        given.withColumn("_even", F.when(F.col("_t") > 0, F.col("_c") / F.col("_t")).otherwise(0.0))
        .withColumn("_sure", F.least(limit, F.greatest(F.lit(0), F.ceil(F.col("_even") * (F.col("_m") - F.col("_n") / 2) - 0.5) - 1)).cast("long"))
        .withColumn("_last", F.least(limit - 1, F.floor(F.col("_even") * (F.col("_m") + 2 * F.col("_n")) + 0.5) + 1).cast("long"))
    )
    if by:
        given = given.withColumn("_open", F.col("_m") - F.sum("_sure").over(group))
    else:
        given = staged(given, "mix-claims")
        given = given.crossJoin(F.broadcast(given.agg(F.sum("_sure").alias("_given")))).withColumn("_open", F.col("_m") - F.col("_given"))
    # rows at their limit keep a place, without a quotient
    tries = F.when(F.col("_last") >= F.col("_sure"), F.sequence("_sure", "_last")).otherwise(F.array(F.lit(None).cast("long")))
    each = given.withColumn("_s", F.explode(tries)).withColumn("_q", F.when(F.col("_c") > 0, F.col("_c") / (2 * F.col("_s") + 1)))
    sort = [F.col("_q").desc_nulls_last(), *order, "_s"]
    each = each.withColumn("nth", F.row_number().over(Window.partitionBy(*by).orderBy(*sort))) if by else running(each, sort)
    won = F.coalesce((F.col("nth") <= F.col("_open")) & F.col("_q").isNotNull(), F.lit(False)).cast("long")
    return each.withColumn("_won", won).groupBy(*df.columns).agg((F.max("_sure") + F.sum("_won")).alias("quota"))


def mix(docs: DataFrame, block: int = BLOCK, repeats: int = REPEATS, shard_docs: int = SHARD_DOCS, fan: int = FAN, seed: str = SEED, keep: bool = False) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of docs(doc_id, text, source).

    ``keep``: all columns of docs, followed by the last four (with underscores in front where docs have such a column).
    """
    named = F.coalesce(F.concat(F.lit("a"), F.col("source")), F.lit("b"))  # in code-point order, null last
    row = [F.struct(*docs.columns).alias("row")] if keep else []
    sized = staged(docs.select("doc_id", named.alias("source"), words(F.col("text")).alias("size"), seeded(F.lit(seed), F.col("doc_id").cast("string"), F.col("text")).alias("h"), *row), "mix-sizes")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    filled = water_fill(sources, repeats)
    seats = filled.agg(F.round(F.sum("target") / block).cast("long").alias("seats"))
    shared = apportion(filled.crossJoin(F.broadcast(seats)), [], F.col("target"), F.col("seats"), ["source"])  # a single row
    plan = staged(shared.select("source", "source_size", "target", F.col("quota").alias("source_quota"), F.ceil(F.col("n_docs") / shard_docs).alias("n_shards")), "mix-plan")
    dealt = sized.join(plan, "source").withColumn("shard", F.col("h") % F.col("n_shards"))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("shard_size") / block))
    most = F.when(F.col("shard_size") > 0, repeats * blocks).otherwise(0)
    per_shard = dealt.groupBy("source", "shard").agg(F.sum("size").alias("shard_size"), F.max("source_quota").alias("source_quota"))
    per_shard = staged(per_shard.withColumn("grp", F.floor(F.col("shard") / fan)).withColumn("blocks", blocks).withColumn("most", most), "mix-shards")
    groups = per_shard.groupBy("source", "grp").agg(F.sum("shard_size").alias("grp_size"), F.max("source_quota").alias("source_quota"), F.sum("most").alias("most"))
    groups = apportion(groups, ["source"], F.col("grp_size").cast("double"), F.col("source_quota"), ["grp"], F.col("most")).select("source", "grp", F.col("quota").alias("grp_quota"))
    quotas = apportion(per_shard.join(groups, ["source", "grp"]), ["source", "grp"], F.col("shard_size").cast("double"), F.col("grp_quota"), ["shard"], F.col("most"))
    quotas = staged(quotas.select("source", "shard", "blocks", "quota"), "mix-quotas")

    lane = Window.partitionBy("source", "shard").orderBy("h", "doc_id", "size")
    laid = dealt.withColumn("end", F.sum("size").over(lane.rowsBetween(Window.unboundedPreceding, 0))).withColumn("begin", F.col("end") - F.col("size"))
    chosen = (
        laid.join(quotas, ["source", "shard"])
        .withColumn("whole", F.floor(F.col("quota") / F.col("blocks")).cast("long"))
        .withColumn("more", F.col("quota") % F.col("blocks"))
        .withColumn("phase", seeded(F.lit(seed), F.col("source"), F.col("shard").cast("string")) % F.col("blocks"))
    )
    first, last = F.floor(F.col("begin") / block).cast("long"), F.floor((F.col("end") - 1) / block).cast("long")
    overlap = lambda i: F.least(F.col("end"), (i + 1) * block) - F.greatest(F.col("begin"), i * block)
    once_more = lambda i: (i * F.col("more") + F.col("phase")) % F.col("blocks") < F.col("more")
    extra = F.aggregate(F.sequence(first, last), F.lit(0).cast("long"), lambda acc, i: acc + F.when(once_more(i), overlap(i)).otherwise(F.lit(0)))
    taken = F.when(F.col("size") == 0, F.lit(0)).otherwise(F.col("size") * F.col("whole") + extra).cast("long")
    if keep:
        names = {c: free_name(docs.columns, c) for c in ("size", "source_size", "target", "taken")}
        named = chosen.withColumn("taken", taken).select("row", *[F.col(c).alias(n) for c, n in names.items()])
        return named.select("row.*", *names.values())
    return chosen.select("doc_id", "size", "source_size", "target", taken.alias("taken"))
