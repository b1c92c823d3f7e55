"""License notices by diagonal voting, with built-in functions only.

All rolling grams of three words of every text are joined, by hash, to their places in the templates. Each
hit votes for the diagonal (place in the text minus place in the template) it lies on. A phrase stands where
every gram of it votes for one diagonal. Notices that lost, gained or changed a few words leave votes on
neighbouring diagonals; these are merged, and the span is verified by its length and the share of the template
it covers. Grams are compared as text too, so a hash collision counts for nothing.

The templates are a fixed list, so their side is broadcast; texts never move. Only votes are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

GRAM = 3
#: Diagonals this far apart, and no further, belong together.
NEAR = 3
#: Least share of a notice's grams that must be found for its label.
SHARE = 0.6

#: Phrases that must stand word for word.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Notices that may differ in a few words.
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "you may not use this file except in compliance with the license": "apache-2",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "creative commons attribution noncommercial 4 0 international license": "cc-by-nc",
    "this work is licensed under the gnu general public license version 3": "gpl-3",
    "it under the terms of the gnu general public license as published by the free software foundation": "gpl",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2",
}

_PART = "".join(map(chr, [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text) -> F.Column:
    """Words of a text: runs of a-z, 0-9 and characters beyond ASCII, A-Z taken as a-z."""
    plain = F.translate(F.coalesce(text, F.lit("")), _UPPER + _PART, _UPPER.lower() + " " * len(_PART))
    return F.array_remove(F.split(plain, " ", -1), "")


def templates(spark: SparkSession) -> DataFrame:
    """Every gram of the fixed phrases and notices, with its place."""
    rows = []
    for exact, table in ((True, PHRASES), (False, NOTICES)):
        for text, label in table.items():
            w = text.split()
            n = len(w) - GRAM + 1
            rows += [(text, label, exact, n, i, " ".join(w[i : i + GRAM])) for i in range(n)]
    frame = spark.createDataFrame(rows, "template string, label string, exact boolean, n_grams int, place int, gram string")
    return frame.withColumn("hash", F.xxhash64("gram"))


def scan_licenses(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and spans.

    n_base counts the places of the phrases; first_word and last_word are their smallest and largest start. labels
    has the labels of phrases and notices, sorted and joined by commas, base_labels those of phrases. score is
    the largest share of a template that was verified, 0 to 1. spans lists (label, start, words, share).

    A null or empty text, or one of fewer than three words, has no label. Rows that repeat doc_id and text
    get equal results; a null doc_id is allowed. Other columns don't matter; an empty table gives an empty result.
    """
    spark = documents.sparkSession
    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.struct(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)), F.xxhash64("text"), F.length("text")).alias("key"),
        words_of(F.col("text")).alias("words"),
    )
    grams = "transform(sequence(0, size(words) - 3), i -> named_struct('at', i, 'gram', concat_ws(' ', words[i], words[i + 1], words[i + 2])))"
    rolled = (
        texts.where(F.size("words") >= GRAM)
        .select("key", F.explode(F.expr(grams)).alias("g"))
        .select("key", "g.at", "g.gram", F.xxhash64("g.gram").alias("hash"))
    )
    hits = rolled.join(F.broadcast(templates(spark)), ["hash", "gram"])
    # A repeated row votes twice for the same places, which distinct places undo.
    votes = (
        hits.withColumn("diagonal", F.col("at") - F.col("place"))
        .groupBy("key", "template", "label", "exact", "n_grams", "diagonal")
        .agg(F.collect_set("place").alias("places"))
    )
    order = W.partitionBy("key", "template").orderBy("diagonal")
    apart = F.col("exact") | (F.col("diagonal") - F.lag("diagonal").over(order) > NEAR)
    merged = (
        votes.withColumn("run", F.sum(F.coalesce(apart.cast("int"), F.lit(1))).over(order))
        .groupBy("key", "template", "label", "exact", "n_grams", "run")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("found"),
            F.min(F.col("diagonal") + F.array_min("places")).alias("start"),
            F.max(F.col("diagonal") + F.array_max("places") + GRAM).alias("end"),
            F.min("diagonal").alias("diagonal"),
        )
        .withColumn("share", F.col("found") / F.col("n_grams"))
        .withColumn("n", F.col("end") - F.col("start"))
        .where(
            F.when(F.col("exact"), F.col("found") == F.col("n_grams")).otherwise(
                (F.col("share") >= SHARE) & (F.col("n") <= F.col("n_grams") + GRAM + 2 * NEAR)
            )
        )
    )
    base = F.when(F.col("exact"), F.col("diagonal"))
    found = merged.groupBy("key").agg(
        F.count(base).alias("n_base"),
        F.min(base).cast("long").alias("first_word"),
        F.max(base).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("exact"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("share").alias("score"),
        F.array_sort(F.collect_list(F.struct("label", "start", F.col("n").alias("words"), "share"))).alias("spans"),
    )
    counted = texts.select("doc_id", "key", F.size("words").cast("long").alias("n_words"))
    return counted.join(found.hint("rebalance"), "key", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
        "spans",
    )
