"""Positions of rows within their key, made without gathering a key in one task.

Rows are first sorted over ranges of (key, order) and written; a key with a large share of all rows lies in many ranges. Each
range's part of a key is then counted, and a row's position is its place in that part plus what earlier ranges hold of the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sorted_rows(rows: DataFrame, key: str, order: Column) -> DataFrame:
    """Rows sorted over ranges, with ``part`` and ``place``: which range, and a number that rises within it.

    To be written before ``with_positions``: ranges are cut by a sample, and another run may cut them elsewhere.
    """
    return (
        rows.repartitionByRange(F.col(key), order)
        .sortWithinPartitions(F.col(key), order)
        .withColumns({"part": F.spark_partition_id(), "place": F.monotonically_increasing_id()})
    )


def with_positions(written: DataFrame, key: str) -> DataFrame:
    """The sorted rows with ``n``, their position within the key, from 0 and without gaps.

    The join is by key and range, so a hot key is as many join keys as it has ranges.
    """
    parts = written.groupBy(key, "part").agg(F.min("place").alias("first"), F.count("*").alias("rows"))
    earlier = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select(
        key, "part", (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift")
    )
    placed = written.join(before.hint("rebalance"), [key, "part"])
    kept = [c for c in written.columns if c not in ("part", "place")]
    return placed.select(*kept, (F.col("place") + F.col("shift")).alias("n"))
