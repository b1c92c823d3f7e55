"""Phases of contexts and ASUs from the phases of their bags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trenchbook import config
from trenchbook.functions.text import is_asu, phase_flag, phase_slot
from trenchbook.operators.contexts import contexts_only
from trenchbook.operators.rollup import LEVEL_KEY

SLOTS = [*config.PHASE_SLOTS, "Other"]


def bag_levels(pottery: DataFrame) -> DataFrame:
    """Bags once per level they count for: under their context, and under their ASU.

    The two keys are exploded in place, so a bag is read once and never compared
    with a list of contexts; equal keys count once.
    """
    keys = F.array_distinct(F.array_compact(F.array("Context_UUID", "ASU_UUID")))
    return pottery.withColumn("target", F.explode(keys))


def context_level(pottery: DataFrame) -> DataFrame:
    """Bags under their context only."""
    return pottery.filter(F.col("Context_UUID").isNotNull()).withColumn(
        "target", F.col("Context_UUID")
    )


def phase_map(pottery: DataFrame, *keep: str) -> DataFrame:
    """Slot and flag of each bag's recorded phase."""
    phase = F.col("CoverageTemporal")
    return pottery.select(
        *keep, "CoverageTemporal", phase_slot(phase).alias("slot"), phase_flag(phase).alias("flag")
    )


def period() -> Column:
    """Period named by the first slot flagged 'yes', else what the Other slot says."""
    named = [F.when(F.col(f"`{slot}`") == "yes", name) for slot, name in config.PERIOD_ORDER]
    return F.coalesce(*named, F.col("Other"))


def phase_flags(levels: DataFrame) -> DataFrame:
    """Nine flags and the period of each target; the last bag of a slot decides, 'no' without one.

    The last flag is first found per target and slot, which a hot target shares
    out over its bags' tasks before anything is shuffled.
    """
    last = (
        phase_map(levels, "target", "seq")
        .groupBy("target", "slot")
        .agg(F.max_by("flag", "seq").alias("flag"))
    )
    flags = last.groupBy("target").agg(
        *[
            F.coalesce(F.max(F.when(F.col("slot") == s, F.col("flag"))), F.lit("no")).alias(s)
            for s in SLOTS
        ]
    )
    return flags.withColumn("Period", period())


def bag_notes(levels: DataFrame) -> DataFrame:
    """Notes of each target's bags, one row per bag: (target, seq, …).

    A target has the same form whatever its number of bags. ``functions.ordered`` gives each row its position, the last bag first.
    """
    notes = [F.coalesce(column, F.lit("")).alias(note) for column, note in config.NOTE_COLUMNS.items()]
    return levels.select("target", "seq", *notes)


def phases(geo: DataFrame, levels: DataFrame) -> DataFrame:
    """Rows of the geo table with flags and period; a row without bags has 'no' in each. The notes are in ``bag_notes``."""
    found = phase_flags(levels).withColumnRenamed("target", "IdentifierUUID")
    return (
        geo.join(found, "IdentifierUUID", "left")
        .withColumns({f"{s}": F.coalesce(F.col(f"`{s}`"), F.lit("no")) for s in [*SLOTS, "Period"]})
        .select(*[f"`{c}`" for c in geo.columns], *[f"`{s}`" for s in SLOTS], "Period")
    )


def phases_context_asu(geo: DataFrame, pottery: DataFrame) -> DataFrame:
    """Phases of every context, its ASUs' bags included, and of every ASU."""
    return phases(geo, bag_levels(pottery))


def phases_context(phased: DataFrame) -> DataFrame:
    """Phases of every context, from those of contexts and ASUs: a context has the same bags in both."""
    return contexts_only(phased)


def _count_columns(rolled: DataFrame, key: Column) -> DataFrame:
    """Rollup with its own key, its other columns set apart from those of the phase table."""
    return rolled.select(
        key.alias("IdentifierUUID"),
        *[F.col(c).alias(f"Pottery_{c}" if c in SHARED else c) for c in rolled.columns],
    )


# Rollup columns that the phase table has too; they get the prefix Pottery_.
SHARED = ["Source", "Context_UUID", "ASU_UUID"]


def counts_context_asu(phased: DataFrame, rolled: DataFrame) -> DataFrame:
    """Phases with the rollup row of the same level; rows without pottery are dropped.

    Of a ``keyed`` rollup the rows stay where they are, and those of the phases are moved.
    """
    if set(LEVEL_KEY) <= set(rolled.columns):
        uuid, at_asu = LEVEL_KEY
        own = _count_columns(rolled, F.col(uuid)).drop(uuid)
        return phased.withColumn(at_asu, is_asu()).join(own, ["IdentifierUUID", at_asu]).drop(at_asu)
    own = _count_columns(rolled, F.coalesce("ASU_UUID", "Context_UUID"))
    # Not written as an equality, which would become a join key and move the wide table again.
    same_level = F.when(is_asu(), F.col("Pottery_ASU_UUID").isNotNull()).otherwise(
        F.col("Pottery_ASU_UUID").isNull()
    )
    return phased.join(own, "IdentifierUUID").filter(same_level)


def counts_context(phased: DataFrame, rolled: DataFrame) -> DataFrame:
    """Phases of contexts with their rollup row; contexts without pottery are dropped."""
    return phased.join(_count_columns(rolled, F.col("Context_UUID")), "IdentifierUUID")


def no_counts(phased: DataFrame, rolled: DataFrame, *keep: str) -> DataFrame:
    """Contexts and ASUs without a rollup row of their level."""
    keys = rolled.select(
        F.coalesce("ASU_UUID", "Context_UUID").alias("IdentifierUUID"),
        F.col("ASU_UUID").isNotNull().alias("at_asu"),
    )
    return (
        phased.withColumn("at_asu", is_asu())
        .join(keys, ["IdentifierUUID", "at_asu"], "left_anti")
        .select(*keep)
    )
