"""Exact top-k inner products by columnar branch-and-bound.

Vectors are integers floor(256 * x), kept as doubles in a vertical layout: one row per dimension. Scores of a few
queries accumulate dimension block by block, as matrix products; after each block the remaining mass |q_rest| * |x_rest|
(Cauchy-Schwarz over the dimensions not yet read) bounds what a candidate can still gain. Candidates that cannot reach
the k-th best score of any of the queries are compacted away; once few are left for each, queries go on one by one,
each with its own survivors. Ties stay in, so the smaller id wins them.

Queries go out in blocks of ``query_block`` rows, the only thing broadcast (2 MB for 64 dimensions, whatever the table's
size); candidates stay where they lie, in blocks of ``block`` rows, and each yields k rows per query at most.

Vectors that are null, or hold a null or non-finite component, take no part; nor do rows with a null id.
Vectors of another length than the query's have no score with it. Repeated rows are candidates of their own (their own
id is excluded). Query rows with the same vec_id are one query: of different vectors the least one, component by
component, asks. Scores are exact while every sum of products stays below 2**53; beyond, Python integers are used,
clamped to a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, staged

K, QUERY_BLOCK, BLOCK, DIMS, TOGETHER = 5, 4096, 4096, 16, 64
RESULT = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame) -> DataFrame:
    """vec_id and the integer components, of the rows that take part."""
    sound = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
    finite = F.forall("embedding", lambda v: F.coalesce(~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")), F.lit(False)))
    # floor() gives a long; beyond its range the component is integral already
    whole = F.transform(F.col("embedding"), lambda v: F.when(F.abs(v.cast("double")) < 2.0**50, F.floor(F.lit(256.0) * v.cast("double")).cast("double")).otherwise(F.lit(256.0) * v.cast("double")))
    return vectors.where(sound).where(finite).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("x"))


class Vertical:
    """A block of candidates, dimension-major, with the norms of what is left from each block of dimensions on."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, dims: int = DIMS):
        self.ids, self.x, self.dims = ids, np.ascontiguousarray(rows.T), dims
        self.cuts = list(range(0, self.x.shape[0], dims))
        squares = np.array([np.square(self.x[c : c + dims]).sum(axis=0) for c in self.cuts]).reshape(len(self.cuts), len(ids))
        self.left = np.sqrt(np.cumsum(squares[::-1], axis=0)[::-1])
        self.peak = float(np.abs(self.x).max()) if self.x.size else 0.0

    def best(self, queries: np.ndarray, own: np.ndarray, k: int, floors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query row, ids and scores of the k best candidates with at least its floor; its own id left out."""
        if self.peak * float(np.abs(queries).max(initial=0.0)) * max(1, queries.shape[1]) >= 2.0**53:
            return [self._exactly(q, i, k) for q, i in zip(queries, own)]
        rest = np.sqrt(np.array([np.square(queries[:, c:]).sum(axis=1) for c in [*self.cuts, queries.shape[1]]]))
        alive, sums = np.arange(len(self.ids)), np.zeros((len(queries), len(self.ids)))
        barred = self.ids[None, :] == own[:, None]
        sums[barred] = -np.inf
        for i, c in enumerate(self.cuts):
            sums += queries[:, c : c + self.dims] @ self.x[c : c + self.dims, alive]
            if i + 1 == len(self.cuts):
                break
            slack = rest[i + 1][:, None] * self.left[i + 1][alive][None, :] * (1 + 1e-9) + 1e-6
            if len(alive) > k:
                floors = np.maximum(floors, np.partition(sums - slack, len(alive) - k, axis=1)[:, len(alive) - k])
            may = sums + slack >= floors[:, None]
            if may.sum() * 4 < may.size:  # few for each query: every query on its own
                return [self._rest(queries[j], i + 1, alive[may[j]], sums[j, may[j]], k, floors[j], rest[:, j]) for j in range(len(queries))]
            some = may.any(axis=0)
            alive, sums = alive[some], sums[:, some]
        return [self._top(alive, row, k) for row in sums]

    def _rest(self, query: np.ndarray, first: int, alive: np.ndarray, sums: np.ndarray, k: int, floor: float, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One query from block ``first`` of the dimensions on."""
        for i in range(first, len(self.cuts)):
            c = self.cuts[i]
            sums = sums + query[c : c + self.dims] @ self.x[c : c + self.dims, alive]
            if i + 1 < len(self.cuts):
                slack = rest[i + 1] * self.left[i + 1][alive] * (1 + 1e-9) + 1e-6
                if len(alive) > k:
                    floor = max(floor, float(np.partition(sums - slack, len(alive) - k)[len(alive) - k]))
                keep = sums + slack >= floor
                alive, sums = alive[keep], sums[keep]
        return self._top(alive, sums, k)

    def _top(self, alive: np.ndarray, sums: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        sound = np.isfinite(sums)
        alive, scores = alive[sound], sums[sound].astype(np.int64)
        if len(alive) > 4 * k:  # ties with the k-th stay
            near = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
            alive, scores = alive[near], scores[near]
        order = np.lexsort((self.ids[alive], -scores))[:k]
        return self.ids[alive][order], scores[order]

    def _exactly(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        alive = np.flatnonzero(self.ids != own)
        q = [int(v) for v in query]
        exact = [sum(a * int(b) for a, b in zip(q, self.x[:, i])) for i in alive.tolist()]
        scores = np.array([max(-(2**63), min(2**63 - 1, s)) for s in exact], np.int64)
        order = np.lexsort((self.ids[alive], ~scores))[:k]  # ~s falls as s rises, without overflow
        return self.ids[alive][order], scores[order]


def search(vectors: DataFrame, queries: DataFrame, k: int = K, query_block: int = QUERY_BLOCK, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score for each row of queries against every row of vectors but itself."""
    spark = vectors.sparkSession
    table = staged(quantised(vectors), "topk-vectors")
    each = quantised(queries).groupBy("vec_id").agg(F.min("x").alias("x"))  # repeated rows ask once
    numbered = each.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)))
    asked = staged(numbered.repartitionByRange(F.col("part")).sortWithinPartitions("part"), "topk-queries")
    n = asked.count()
    passes = max(1, -(-n // query_block))
    small_batches(spark)
    found = None
    for p in range(passes):
        rows = asked.where((F.col("part") >= (p << 20) // passes) & (F.col("part") < ((p + 1) << 20) // passes)).collect()  # about query_block rows
        by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in {len(r["x"]) for r in rows}:
            own = [r for r in rows if len(r["x"]) == size]
            by_length[size] = (np.array([r["vec_id"] for r in own], np.int64), np.array([r["x"] for r in own], np.float64).reshape(len(own), size))
        shared = spark.sparkContext.broadcast(by_length)

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            best: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}  # k rows for each broadcast query
            none = np.empty(0, np.int64)
            for t in batches:
                for at in range(0, len(t), block):
                    b = t.iloc[at : at + block]
                    lengths = b["x"].map(len).to_numpy()
                    for size in np.unique(lengths):
                        if size not in shared.value:
                            continue
                        mine = b[lengths == size]
                        v = Vertical(mine["vec_id"].to_numpy(np.int64), np.stack(mine["x"].to_numpy()).reshape(len(mine), size))
                        ids, matrix = shared.value[size]
                        for j in range(0, len(ids), TOGETHER):
                            had = [best.get((size, x), (none, none)) for x in range(j, min(j + TOGETHER, len(ids)))]
                            floors = np.array([float(s[-1]) if len(s) == k else -np.inf for _, s in had])
                            for x, (got_ids, got) in enumerate(v.best(matrix[j : j + TOGETHER], ids[j : j + TOGETHER], k, floors)):
                                if len(got):
                                    every_ids, every = np.concatenate((had[x][0], got_ids)), np.concatenate((had[x][1], got))
                                    order = np.lexsort((every_ids, ~every))[:k]
                                    best[size, j + x] = every_ids[order], every[order]
            for (size, j), (i, s) in best.items():
                yield pd.DataFrame({"query_id": np.full(len(i), shared.value[size][0][j]), "vec_id": i, "score": s})

        part = table.mapInPandas(run, RESULT)
        found = part if found is None else found.unionByName(part)
        if p % 16 == 15:  # no plan grows without bound
            found = staged(found, "topk-found")
    # the best of each task: k rows at most for each query and task
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
