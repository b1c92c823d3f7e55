"""Relation text turned into foreign keys.

What a record belongs to depends only on its relation text. Each distinct text is
therefore resolved once (so a parent with a third of all children costs one row), and
the answer is joined back to the records. Each join has one row per key on its right, so a
hot key only makes the left side large, and adaptive execution splits that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trenchbook.functions.joins import join_lookup, left_join_spread
from trenchbook.functions.text import relation_members
from trenchbook.operators.contexts import KINDS, asu_contexts

RELATION = "RelationBelongsToUUID"


def explode_relation(rows: DataFrame, column: str, *keep: str) -> DataFrame:
    """One row per listed key, with its position; a row that lists none keeps one row with nulls."""
    return rows.select(
        *keep, F.posexplode_outer(relation_members(column)).alias("pos", "parent")
    )


def distinct_members(rows: DataFrame, column: str = RELATION) -> DataFrame:
    """Each distinct relation text with its members: (column, pos, parent)."""
    return members_of(distinct_texts(rows, column), column)


def distinct_texts(rows: DataFrame, column: str = RELATION) -> DataFrame:
    """Each distinct relation text, of one column."""
    return rows.select(column).filter(F.col(column).isNotNull()).distinct()


def members_of(texts: DataFrame, column: str = RELATION) -> DataFrame:
    """Distinct relation texts with their members: (column, pos, parent)."""
    return texts.select(column, F.posexplode(relation_members(column)).alias("pos", "parent"))


def named_rows(table: DataFrame, members: DataFrame) -> DataFrame:
    """Rows of a table whose key is among the members of relation texts; the others can be nobody's parent.

    Nor can a row without a relation text, which leads to no context. Each named key is there once, so a hot parent is one row.
    """
    named = members.select(F.col("parent").alias("IdentifierUUID")).distinct()
    return table.filter(F.col(RELATION).isNotNull()).join(named, "IdentifierUUID", "left_semi")


def classify_texts(rows: DataFrame, index: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """Last parent of each kind that a relation text names: (text, *KINDS, unknown).

    ``unknown`` is the last key that is of no kind. Positions are aggregated, and
    the keys are read from the text again, so the aggregate carries numbers only. ``texts`` has the rows' distinct texts;
    with it ``index`` is a written table too, whose size is known, and isn't rebalanced.
    """
    last = {
        name: F.max(F.when(F.col("kind") == kind, F.col("pos"))).alias(name)
        for kind, name in enumerate(KINDS)
    }
    last["unknown"] = F.max(F.when(F.col("kind").isNull(), F.col("pos"))).alias("unknown")
    members = relation_members(RELATION)
    keys = index.withColumnRenamed("uuid", "parent")
    if texts is None:
        named = join_lookup(distinct_members(rows), keys, "parent", "left")
    else:
        named = members_of(texts).join(keys, "parent", "left")
    return (
        named.groupBy(RELATION)
        .agg(*last.values())
        .select(RELATION, *[F.get(members, F.col(name)).alias(name) for name in last])
    )


def classify_parents(
    rows: DataFrame, index: DataFrame, master: DataFrame, texts: DataFrame | None = None
) -> DataFrame:
    """Sample bags or special finds with context, ASU, flotation and pottery keys.

    Where a text names an ASU but no context, the context is that of the ASU. ``texts`` is as for ``classify_texts``.
    """
    resolved = classify_texts(rows, index, texts).withColumn(
        "ASU_UUID", F.when(F.col("context").isNull(), F.col("asu"))
    )
    found = join_lookup(
        resolved.filter(F.col("ASU_UUID").isNotNull()), asu_contexts(master), "ASU_UUID", "left"
    )
    placed = found.unionByName(
        resolved.filter(F.col("ASU_UUID").isNull()).withColumn(
            "asu_context", F.lit(None).cast("string")
        )
    ).select(
        RELATION,
        F.coalesce("context", "asu_context").alias("Context_UUID"),
        F.col("asu").alias("ASU_UUID"),
        F.col("flotation").alias("FlotationBag_UUID"),
        F.col("pottery").alias("PotteryBag_UUID"),
    )
    return left_join_spread(rows, placed, RELATION)


def orphans_blank(rows: DataFrame, *keep: str) -> DataFrame:
    """Records that name no parent."""
    return rows.filter(F.col(RELATION).isNull()).select(*keep)


def orphans_unresolved(rows: DataFrame, index: DataFrame, *keep: str) -> DataFrame:
    """Records with neither context nor ASU that name a key nobody has: that key as ``parent``."""
    missing = classify_texts(rows, index).filter(
        F.col("context").isNull() & F.col("asu").isNull() & F.col("unknown").isNotNull()
    )
    return join_lookup(
        rows, missing.select(RELATION, F.col("unknown").alias("parent")), RELATION
    ).select(*keep, "parent")


def bag_candidates(samples: DataFrame, master: DataFrame, finds: DataFrame) -> DataFrame:
    """What each key a bag may name stands for, one row per key: (parent, keys).

    Sample bags come before contexts and ASUs, these before special finds. Only
    candidates that lead to a context count.
    """

    def candidates(table: DataFrame, priority: int, sample: Column) -> DataFrame:
        return table.filter(
            F.col("IdentifierUUID").isNotNull() & F.col("Context_UUID").isNotNull()
        ).select(
            F.col("IdentifierUUID").alias("parent"),
            F.struct(F.lit(priority).alias("priority"), "seq").alias("rank"),
            F.struct("Context_UUID", "ASU_UUID", sample.alias("SampleBag_UUID")).alias("keys"),
        )

    none = F.lit(None).cast("string")
    return (
        candidates(samples, 0, F.col("IdentifierUUID"))
        .unionByName(candidates(master, 1, none))
        .unionByName(candidates(finds, 2, none))
        .groupBy("parent")
        .agg(F.min_by("keys", "rank").alias("keys"))
    )


def pottery_texts(bags: DataFrame | None, candidates: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """Keys each relation text of a bag leads to: those of the first member that is a candidate.

    ``members`` has the members of the bags' texts; without it they are made here.
    """
    return (
        join_lookup(distinct_members(bags) if members is None else members, candidates, "parent")
        .groupBy(RELATION)
        .agg(F.min_by("keys", "pos").alias("keys"))
        .select(RELATION, "keys.*")
    )


def pottery_parents(
    bags: DataFrame,
    samples: DataFrame | None,
    master: DataFrame | None,
    finds: DataFrame | None,
    texts: DataFrame | None = None,
) -> DataFrame:
    """Pottery bags with context, ASU and sample bag keys.

    ``texts`` is the written table of ``pottery_texts``; without it texts are resolved here. With it, several steps
    can each join the few columns of the bags that they read.
    """
    if texts is None:
        return left_join_spread(bags, pottery_texts(bags, bag_candidates(samples, master, finds)), RELATION)
    # A bag that names nothing has no keys; it stays where it is. The files' size is known, so they aren't rebalanced.
    keys = [c for c in texts.columns if c != RELATION]
    named = bags.filter(F.col(RELATION).isNotNull()).join(texts, RELATION, "left")
    blank = bags.filter(F.col(RELATION).isNull()).withColumns({c: F.lit(None).cast("string") for c in keys})
    return named.select(*[f"`{c}`" for c in bags.columns], *keys).unionByName(blank)


def pottery_no_keys(pottery: DataFrame, *keep: str) -> DataFrame:
    """Pottery bags that found no keys; they are in no rollup."""
    return pottery.filter(
        F.col("Context_UUID").isNull() & F.col("ASU_UUID").isNull()
    ).select(*keep)


def explode_photos(photos: DataFrame, original: str = "OriginalIdentifierUUID") -> DataFrame:
    """One row per parent of a photo.

    A photo with several parents becomes several rows, each with a new key made
    from photo and parent, and with the old key kept in ``original``. Other photos stay as they are.
    A parent named twice gives two rows with one key, of which the first loads and the other is a reject.
    """
    several = F.size("members") > 1
    return (
        photos.withColumn("members", relation_members(RELATION))
        .select("*", F.posexplode_outer("members").alias("pos", "parent"))
        .withColumns(
            {
                original: F.when(several, F.col("IdentifierUUID")),
                RELATION: F.when(several, F.col("parent")).otherwise(F.col(RELATION)),
                "IdentifierUUID": F.when(
                    several, F.md5(F.concat_ws("#", "IdentifierUUID", "parent"))
                ).otherwise(F.col("IdentifierUUID")),
                "seq": F.struct("seq", "pos"),
            }
        )
        .drop("members", "pos", "parent")
    )


def join_bag_links(joins: DataFrame, pottery: DataFrame, *keep: str) -> DataFrame:
    """Bags included in a pottery join, each with its context.

    A listed key is looked up as a pottery bag first, then as a sample bag, where
    the last bag of the sample counts. Both lookups go into one table with one row per
    key, so one join serves them.
    """
    bag = F.struct("ContextID", "Context_UUID", "ASU_UUID")
    lookup = (
        pottery.select(
            F.explode(
                F.filter(
                    F.array(
                        F.struct(F.col("IdentifierUUID").alias("key"), F.lit(1).alias("own")),
                        F.struct(F.col("SampleBag_UUID").alias("key"), F.lit(0).alias("own")),
                    ),
                    lambda k: k.key.isNotNull(),
                )
            ).alias("k"),
            bag.alias("bag"),
            "seq",
        )
        .groupBy(F.col("k.key").alias("PotBag_UUID"))
        .agg(F.max_by("bag", F.struct("k.own", "seq")).alias("bag"))
    )
    listed = explode_relation(joins, "RelationIncludesUUID", *keep, "seq").withColumnRenamed(
        "parent", "PotBag_UUID"
    )
    return left_join_spread(listed, lookup, "PotBag_UUID").select(
        *keep,
        "pos",
        "PotBag_UUID",
        "bag.ContextID",
        "bag.Context_UUID",
        "bag.ASU_UUID",
        F.col("bag").isNotNull().alias("found"),
    )
