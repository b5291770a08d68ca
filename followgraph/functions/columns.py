"""Column builders for the rank update and the interest flag."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rank_update(received: Column, dangling_mass: float, n: int, damping: float) -> Column:
    """``(1-d)/N + d * (received + dangling_mass/N)``; a user that receives
    nothing gets the teleport and dangling shares only."""
    base = (1.0 - damping) / n
    return F.lit(base) + F.lit(damping) * (F.coalesce(received, F.lit(0.0)) + F.lit(dangling_mass / n))


def interested(freq: Column, threshold: float) -> Column:
    return freq >= F.lit(threshold)
