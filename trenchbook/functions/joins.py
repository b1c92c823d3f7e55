"""Joins whose left side may hold one key a third of the time, or no key at all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPREAD = 4096


def join_lookup(rows: DataFrame, table: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join to a table with one row per key, in a way the runtime can split hot keys.

    Adaptive execution splits a skewed join only where both sides come straight
    from a shuffle of their own. A table that was just aggregated by the key does not,
    so it is rebalanced first. That also shows its true size, and a small one is broadcast.
    """
    return rows.join(table.hint("rebalance"), key, how)


def left_join_spread(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Left join on a text key, of a table with one row per key.

    A left join hashes all null keys to one task. Here a row without a key takes
    one of many keys that no record can carry (they start with a zero character),
    chosen by its ``seq``, so these rows spread over the cluster.
    """
    apart = F.concat(F.lit("\0"), F.pmod(F.xxhash64("seq"), F.lit(SPREAD)).cast("string"))
    added = [c for c in table.columns if c != key]
    left = rows.withColumn("join_key", F.coalesce(F.col(key), apart))
    right = table.withColumnRenamed(key, "join_key")
    joined = join_lookup(left, right, "join_key", "left")
    return joined.select(*[f"`{c}`" for c in rows.columns], *[f"`{c}`" for c in added])
