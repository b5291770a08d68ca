"""A key for whole rows, where ids may be null or repeated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def free(docs: DataFrame, name: str) -> str:
    """``name``, with underscores appended until no column is called so."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _hash(docs: DataFrame, names: list[str], salt: int) -> Column:
    """64 bits of these columns; nulls count, maps by their JSON text."""
    parts = []
    for name in names:
        value = column(name)
        if isinstance(docs.schema[name].dataType, T.MapType):
            value = F.to_json(value)
        parts += [value.isNull(), value]
    return F.xxhash64(F.lit(salt), *parts)


def key(docs: DataFrame, names: list[str] | None = None) -> Column:
    """A 64-bit key that is equal for rows that agree in the columns ``names``
    (all by default) and for no others: a hash, salted anew until a second,
    independent one shows that no two different rows share it."""
    names = names or docs.columns
    salt = 0
    while True:
        own, other = _hash(docs, names, 2 * salt), _hash(docs, names[::-1], 2 * salt + 1)
        pairs = docs.select(own.alias("own"), other.alias("other"))
        clash = pairs.groupBy("own").agg(F.min("other").alias("low"), F.max("other").alias("high")).where("low <> high")
        if clash.isEmpty():
            return own
        salt += 1


def one_each(rows: DataFrame, name: str, count: str) -> DataFrame:
    """One of the equal rows of each key ``name``; ``count`` tells how many
    there are, so only those that do repeat are shuffled.  Drops ``count``."""
    once = rows.where(F.col(count) == 1)
    return once.unionByName(rows.where(F.col(count) > 1).dropDuplicates([name])).drop(count)
