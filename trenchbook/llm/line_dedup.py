"""Repeated passages of lines: overlapping windows of three lines, each kept only where it comes first.

Every window's two 64-bit hashes are one row. The first place of each hash is found by an aggregate that combines
before the shuffle, and is joined back to the later places; adaptive execution splits a hot window's rows.
The covered lines of a document are merged by array functions and cut. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LINES = 3
_LAST = 2**63 - 1


def cut_repeated_lines(documents: DataFrame) -> DataFrame:
    """The documents' columns in a struct ``row``, its text cut, and n_lines and n_removed.

    Lines are parted by line feeds. A window of three lines, not all blank, is a repeat when the same three lines
    come earlier: in a document with a smaller doc_id, or further up in the same one. All lines that a repeat
    covers go; overlapping windows count.

    A null text stays null and has no lines. Texts of fewer than three lines stay whole. Documents without doc_id
    come last. Rows that repeat doc_id and text are one document and lose the same lines. Other columns are
    passed on inside ``row``, whatever their names; an empty table gives an empty result.
    """
    columns = documents.columns
    keyed = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("version"),
        F.split(F.coalesce("text", F.lit("")), "\n", -1).alias("lines"),
    )
    window = (
        "transform(sequence(0, size(lines) - 3), i -> named_struct('at', i,"
        " 'blank', trim(lines[i]) = '' and trim(lines[i + 1]) = '' and trim(lines[i + 2]) = '',"
        " 'a', xxhash64(lines[i], lines[i + 1], lines[i + 2]),"
        " 'b', xxhash64('#', lines[i + 2], lines[i], lines[i + 1])))"
    )
    windows = (
        keyed.where(F.size("lines") >= LINES)
        .select("doc", "version", F.explode(F.expr(window)).alias("w"))
        .where("not w.blank")
        .select("w.a", "w.b", F.struct("doc", "version", "w.at").alias("place"))
    )
    first = (
        windows.groupBy("a", "b")
        .agg(F.min("place").alias("first"), F.max("place").alias("last"))
        .where("first < last")
        .select("a", "b", "first")
    )
    covered = (
        windows.join(first.hint("rebalance"), ["a", "b"])
        .where("place > first")
        .groupBy("place.doc", "place.version")
        .agg(F.collect_set("place.at").alias("at"))
    )
    gone = F.expr("array_distinct(flatten(transform(at, i -> sequence(i, i + 2))))")
    cut = (
        keyed.select("row", "doc", "version")
        .join(covered.select("doc", "version", gone.alias("gone")).hint("rebalance"), ["doc", "version"], "left")
        .withColumn("lines", F.split("row.text", "\n", -1))
        .withColumn("n_lines", F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")).cast("long"))
    )
    left = F.expr(
        "array_join(transform(array_except(sequence(0, size(lines) - 1), gone), i -> lines[i]), '\n')"
    )
    text = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(left)
    return cut.select(
        F.struct(*[text.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in columns]).alias("row"),
        "n_lines",
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_removed"),
    )


#: The same for tables whose doc_id are whole and unique.
SQL = """
with lines as (
  select doc_id, text, string_split(text, chr(10)) as lines from documents
), windows as (
  select doc_id, i - 1 as pos, lines[i] || chr(10) || lines[i + 1] || chr(10) || lines[i + 2] as w
  from (select doc_id, lines, unnest(range(1, len(lines) - 1)) as i from lines where len(lines) >= 3)
  where trim(lines[i]) <> '' or trim(lines[i + 1]) <> '' or trim(lines[i + 2]) <> ''
), ranked as (
  select doc_id, pos, row_number() over (partition by w order by doc_id, pos) as n from windows
), gone as (
  select distinct doc_id, pos + k as pos from ranked, (values (0), (1), (2)) o(k) where n > 1
), counted as (
  select doc_id, list(pos) as gone from gone group by doc_id
)
select l.doc_id,
       array_to_string([l.lines[i] for i in range(1, len(l.lines) + 1)
                        if not list_contains(coalesce(g.gone, []), i - 1)], chr(10)) as text,
       cast(len(l.lines) as bigint) as n_lines,
       cast(coalesce(len(g.gone), 0) as bigint) as n_removed
from lines l left join counted g using (doc_id)
"""
