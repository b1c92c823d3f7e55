"""The site-wide context table and the keys that hang off it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trenchbook import config
from trenchbook.functions.joins import join_lookup, left_join_spread
from trenchbook.functions.text import is_asu, relation_members


def align_contexts(tables: list[DataFrame], columns: list[str] | None = None) -> DataFrame:
    """One shape for all context types: missing columns become null, then union all."""
    columns = columns or config.CONTEXT_COLUMNS
    shaped = [
        t.select(
            *[
                F.col(f"`{c}`") if c in t.columns else F.lit(None).cast("string").alias(c)
                for c in columns
            ],
            "seq",
        )
        for t in tables
    ]
    return reduce(DataFrame.unionByName, shaped)


def contexts_only(rows: DataFrame) -> DataFrame:
    """Rows that are contexts."""
    return rows.filter(~is_asu())


def asu_parents(contexts: DataFrame) -> DataFrame:
    """Parent context of each relation text met on an ASU: (RelationBelongsToUUID, parent).

    The parent is the first listed key that is a context. It depends on the text
    alone, so each distinct text is resolved once, however many rows carry it. Only the
    position is aggregated; the key itself is read from the text again.
    """
    known = (
        contexts_only(contexts)
        .filter(F.col("IdentifierUUID").isNotNull())
        .select(F.col("IdentifierUUID").alias("parent"))
        .distinct()
    )
    listed = (
        contexts.filter(is_asu())
        .select("RelationBelongsToUUID")
        .distinct()
        .select(
            "RelationBelongsToUUID",
            F.posexplode(relation_members("RelationBelongsToUUID")).alias("pos", "parent"),
        )
    )
    first = (
        join_lookup(listed, known, "parent")
        .groupBy("RelationBelongsToUUID")
        .agg(F.min("pos").alias("pos"))
    )
    members = relation_members("RelationBelongsToUUID")
    return first.select("RelationBelongsToUUID", F.get(members, F.col("pos")).alias("parent"))


def master_context(contexts: DataFrame) -> DataFrame:
    """Contexts and ASUs with Context_UUID and ASU_UUID.

    A context is its own context. An ASU is its own ASU and takes the first
    listed parent that is a context. The two kinds are keyed apart, so context rows
    take no part in the join.
    """
    own = contexts_only(contexts).withColumns(
        {"Context_UUID": F.col("IdentifierUUID"), "ASU_UUID": F.lit(None).cast("string")}
    )
    placed = left_join_spread(
        contexts.filter(is_asu()),
        asu_parents(contexts).withColumnRenamed("parent", "Context_UUID"),
        "RelationBelongsToUUID",
    ).withColumn("ASU_UUID", F.col("IdentifierUUID"))
    return own.unionByName(placed)


def asu_no_parent(master: DataFrame) -> DataFrame:
    """ASUs without a context, and why: (Source, Identifier, IdentifierUUID, reason)."""
    return master.filter(is_asu() & F.col("Context_UUID").isNull()).select(
        "Source",
        "Identifier",
        "IdentifierUUID",
        F.when(F.col("RelationBelongsToUUID").isNull(), "no parent given")
        .otherwise("parent is not a context")
        .alias("reason"),
    )


KINDS = ["context", "asu", "flotation", "pottery"]
#: In ``key_index``: that a key is named, which comes after all kinds.
_NAMED = len(KINDS)


def key_index(
    master: DataFrame,
    flotation: DataFrame | None = None,
    pottery: DataFrame | None = None,
    members: DataFrame | None = None,
) -> DataFrame:
    """Known keys: (uuid, kind), one row per key; kind is a place in KINDS.

    A key of several kinds counts as the first of them. The aggregate carries
    numbers only, so it stays a hash aggregate. With ``members`` of relation texts, only keys among their ``parent``
    are kept; the same aggregate tells which they are, so the others are moved once and never written.
    """
    kinds = [
        master.select(
            F.col("IdentifierUUID").alias("uuid"), F.when(is_asu(), 1).otherwise(0).alias("kind")
        )
    ]
    for kind, table in ((2, flotation), (3, pottery)):
        if table is not None:
            kinds.append(
                table.select(F.col("IdentifierUUID").alias("uuid"), F.lit(kind).alias("kind"))
            )
    if members is None:
        return (
            reduce(DataFrame.unionByName, kinds)
            .filter(F.col("uuid").isNotNull())
            .groupBy("uuid")
            .agg(F.min("kind").alias("kind"))
        )
    kinds.append(members.select(F.col("parent").alias("uuid"), F.lit(_NAMED).alias("kind")))
    return (
        reduce(DataFrame.unionByName, kinds)
        .filter(F.col("uuid").isNotNull())
        .groupBy("uuid")
        .agg(F.min("kind").alias("kind"), F.max("kind").alias("last"))
        .filter((F.col("last") == _NAMED) & (F.col("kind") < _NAMED))
        .select("uuid", "kind")
    )


def asu_contexts(master: DataFrame) -> DataFrame:
    """Context of each ASU: (ASU_UUID, asu_context). An ASU recorded twice keeps its last row."""
    return (
        master.filter(is_asu() & F.col("IdentifierUUID").isNotNull())
        .groupBy(F.col("IdentifierUUID").alias("ASU_UUID"))
        .agg(F.max_by(F.struct("Context_UUID"), "seq").alias("last"))
        .select("ASU_UUID", F.col("last.Context_UUID").alias("asu_context"))
    )


def context_counts(master: DataFrame) -> DataFrame:
    """Numbers of contexts, ASUs and all rows."""
    return master.agg(
        F.count_if(~is_asu()).alias("contexts"),
        F.count_if(is_asu()).alias("asus"),
        F.count("*").alias("total"),
    )
