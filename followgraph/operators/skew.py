"""Hot keys: spread a key that holds a large share of the rows.

A join of a large table with a table keyed uniquely on the same column
puts every row of one key into one task.  For keys above a threshold the
large side gets a salt in ``[0, n_salt)`` from a hash of another column,
and the keyed side's row is copied once per salt; joining on
``(key, salt)`` then splits the key over ``n_salt`` tasks.

The threshold is ``max(min_rows, ceil(total / max_keys))``, so at most
``max_keys`` keys qualify and the sum of their salts is below
``2 * max_keys``: the hot-key table has a proven size bound and is
broadcast.  Keys below the threshold get salt 0 and are untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_MIN_ROWS = 1 << 20
HOT_MAX_KEYS = 100_000


def hot_threshold(total_rows: int, min_rows: int = HOT_MIN_ROWS, max_keys: int = HOT_MAX_KEYS) -> int:
    return max(int(min_rows), -(-int(total_rows) // int(max_keys)), 1)


def hot_keys(counts: DataFrame, key: str, count: str, threshold: int) -> DataFrame:
    """Keys of ``counts`` with more than ``threshold`` rows and their salt
    count ``ceil(rows / threshold)``: columns ``hot_key, hot_rows, n_salt``."""
    return counts.where(F.col(count) > F.lit(threshold)).select(
        F.col(key).alias("hot_key"),
        F.col(count).cast("long").alias("hot_rows"),
        F.ceil(F.col(count) / F.lit(threshold)).cast("int").alias("n_salt"),
    )


def add_salt(df: DataFrame, key: str, spread: str, hot: DataFrame | None) -> DataFrame:
    """Large side: ``salt = pmod(xxhash64(spread), n_salt)`` on hot keys, else 0.
    ``hot=None`` means no key is hot: every salt is 0 and nothing is joined."""
    if hot is None:
        return df.select(*[F.col(c) for c in df.columns], F.lit(0).alias("salt"))
    joined = df.join(F.broadcast(hot), F.col(key) == F.col("hot_key"), "left")
    salt = F.when(F.col("n_salt").isNull(), F.lit(0)).otherwise(
        F.pmod(F.xxhash64(F.col(spread)), F.col("n_salt")).cast("int")
    )
    return joined.select(*[F.col(c) for c in df.columns], salt.alias("salt"))


def replicate(df: DataFrame, key: str, hot: DataFrame | None) -> DataFrame:
    """Keyed side: one copy per salt of each hot key, salt 0 for the rest."""
    if hot is None:
        return df.select(*[F.col(c) for c in df.columns], F.lit(0).alias("salt"))
    joined = df.join(F.broadcast(hot), F.col(key) == F.col("hot_key"), "left")
    salts = F.sequence(F.lit(0), F.coalesce(F.col("n_salt"), F.lit(1)) - F.lit(1))
    return joined.select(*[F.col(c) for c in df.columns], F.explode(salts).alias("salt"))


def collect_hot(
    counts: DataFrame, key: str, count: str, threshold: int, total: int | None = None, max_keys: int = HOT_MAX_KEYS
) -> DataFrame | None:
    """Materialize the hot keys (a bounded table) and return ``None`` when
    there are none, so callers skip the salting join altogether.  With
    ``total`` (rows over all keys) at or below the threshold no key can be
    hot and no job runs.  More than ``max_keys`` keys are refused: the table
    is broadcast."""
    from followgraph.operators import lineage

    if total is not None and total <= threshold:
        return None

    hot, m = lineage.materialize(hot_keys(counts, key, count, threshold), n=F.count(F.lit(1)))
    if int(m["n"]) > max_keys:
        raise ValueError(f"{m['n']} hot keys; at most {max_keys} can be broadcast")
    return hot if int(m["n"]) > 0 else None
