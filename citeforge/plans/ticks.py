"""Round axis ticks: steps of 1, 2 or 5 times a power of ten."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COUNT = 5


def nice_step(top: float, count: int = COUNT) -> float:
    size = 10.0 ** math.floor(math.log10(top / count))
    lead = top / count / size
    return size * next((s for limit, s in ((1.5, 1), (3.5, 2), (7.5, 5)) if lead <= limit), 10)


def nice_ticks(top: float, count: int = COUNT) -> list[float]:
    if top <= 0:
        return [0]
    step = nice_step(top, count)
    return [i * step for i in range(int(top // step) + 1)]


def axis_ticks(df: DataFrame, top: str, count: int = COUNT) -> DataFrame:
    """nth, tick for a one-row frame with the largest value."""
    raw = F.col(top) / count
    size = F.pow(F.lit(10.0), F.floor(F.log10(raw)))
    lead = raw / size
    step = F.when(lead <= 1.5, size).when(lead <= 3.5, 2 * size).when(lead <= 7.5, 5 * size).otherwise(10 * size)
    many = df.where(F.col(top) > 0).select(step.alias("step"), F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col(top) / step).cast("long"))).alias("nth"))
    return many.select("nth", (F.col("nth") * F.col("step")).alias("tick"))
