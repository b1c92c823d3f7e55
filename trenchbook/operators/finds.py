"""Special finds counted by class."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trenchbook import config
from trenchbook.functions.text import find_class
from trenchbook.operators.chronology import bag_levels, context_level

CLASSES = list(config.FIND_CLASSES)


def find_classes(finds: DataFrame, *keep: str) -> DataFrame:
    """Class of each find."""
    return finds.select(*keep, find_class(F.col("Title")).alias("find_class"))


def _counts(geo: DataFrame, levels: DataFrame) -> DataFrame:
    """Rows of the geo table with a count per class; counting is combined before the shuffle."""
    counts = (
        find_classes(levels, "target")
        .groupBy("target")
        .agg(*[F.count_if(F.col("find_class") == c).alias(c) for c in CLASSES])
        .withColumnRenamed("target", "IdentifierUUID")
    )
    return geo.join(counts, "IdentifierUUID", "left").select(
        *[f"`{c}`" for c in geo.columns],
        *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(c) for c in CLASSES],
    )


def finds_context_asu(geo: DataFrame, finds: DataFrame) -> DataFrame:
    """Finds of every context, its ASUs' finds included, and of every ASU."""
    return _counts(geo, bag_levels(finds))


def finds_context(geo_contexts: DataFrame, finds: DataFrame) -> DataFrame:
    """Finds of every context."""
    return _counts(geo_contexts, context_level(finds))
