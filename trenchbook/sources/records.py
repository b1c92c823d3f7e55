"""Records of quoted text files, cut apart by many tasks even where a value holds line breaks.

A line alone doesn't tell whether it begins inside a quoted value; only the text before it does. What it does tell is where
it ends in either case. These pairs compose, so a prefix over lines, then over the blocks of a file, settles where each line
begins. Only narrow columns are shuffled for that, and only of files in which a value can go on in the next line; of the texts,
only the lines of such records move.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def decoded(column: str) -> Column:
    """File metadata as plain text: it is URL-encoded, but a plus sign in it is a plus sign."""
    return F.url_decode(F.replace(F.col(column), F.lit("+"), F.lit("%2B")))


def _ends_inside(text: Column, separator: str) -> Column:
    """True where a line that begins a record leaves a quoted value open.

    A quote opens a value at its beginning only, and two of them in a quoted value are one of its text.
    """
    sep = re.escape(separator)
    opened = '"[^"]*+(?:""[^"]*+)*+'
    closed = f'{opened}"[^{sep}]*+|[^"{sep}][^{sep}]*+'
    return text.rlike(f"\\A(?:(?:{closed})?+{sep})*+{opened}\\z")


def read_lines(spark: SparkSession, folder: str, pattern: str = "*.tab", separator: str = "\t") -> DataFrame:
    """All lines of the files under a folder, in one splittable scan: (path, file_name, block, row, text, opens, stays).

    ``opens`` says whether a value is open at the end of the line if the line begins a record, ``stays`` if it begins inside
    a value. ``row`` rises within a block and is not used twice. To be written before it is read: later steps join by
    ``row``. A line ends with a line feed; a carriage return before it is no part of a record.
    """
    return (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .option("lineSep", "\n")
        .text(folder)
        .select(
            decoded("_metadata.file_path").alias("path"),
            decoded("_metadata.file_name").alias("file_name"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
            F.col("value").alias("text"),
            _ends_inside(F.col("value"), separator).alias("opens"),
            _ends_inside(F.concat(F.lit('"'), "value"), separator).alias("stays"),
        )
    )


def _moves(rows: DataFrame, within: list[str], order: str) -> DataFrame:
    """Add what the rows before each one in its group do to the state at the group's beginning.

    A row has ``fixed``, the state after it where that is the same for both states before it, or else ``flip``, whether it turns
    the state round. Added are ``was_fixed`` and ``was_flipped``, the same for all rows before, and ``flips``, turns up to the row.
    """
    window = Window.partitionBy(*within).orderBy(order)
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    turned = F.col("flip").cast("int")
    settled = F.when(F.col("fixed").isNotNull(), F.struct("fixed", "flips"))
    counted = rows.withColumn(
        "flips", F.sum(turned).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ).withColumn("settled", F.last(settled, ignorenulls=True).over(earlier))
    before = F.col("flips") - turned
    return counted.withColumns(
        {
            "was_fixed": F.col("settled.fixed") != ((before - F.col("settled.flips")) % 2 == 1),
            "was_flipped": before % 2 == 1,
        }
    ).drop("settled")


def spanning_lines(lines: DataFrame) -> DataFrame:
    """Lines of records over several lines: (row, start), ``start`` being the row of the record's first line.

    A value that is never closed goes on to the end of its file. Work within a block is one group, which its size
    bounds; work over the blocks of a file has a row per block.
    """
    block = ["path", "block"]
    opening = lines.groupBy(*block).agg(F.max("opens").alias("opens"))
    concerned = opening.withColumn("any", F.max("opens").over(Window.partitionBy("path"))).where("any")
    same = F.col("opens") == F.col("stays")
    moved = _moves(
        lines.select(*block, "row", "opens", "stays")
        .join(concerned.select(*block), block, "left_semi")
        .withColumns({"fixed": F.when(same, F.col("opens")), "flip": F.col("opens") & ~F.col("stays")}),
        block,
        "row",
    )
    after = F.struct(
        F.coalesce("fixed", F.col("was_fixed") != F.col("flip")).alias("fixed"),
        (F.col("flips") % 2 == 1).alias("flip"),
    )
    ends = moved.groupBy(*block).agg(F.max_by(after, F.col("row")).alias("end"))
    starts = _moves(
        ends.select(*block, "end.fixed", (F.col("end.fixed").isNull() & F.col("end.flip")).alias("flip")),
        ["path"],
        "block",
    ).select(*block, F.coalesce("was_fixed", "was_flipped").alias("begun"))
    placed = moved.join(starts.hint("rebalance"), block).withColumn(
        "inside", F.coalesce("was_fixed", F.col("begun") != F.col("was_flipped"))
    )
    begins = F.when(~F.col("inside"), F.col("row"))
    window = Window.partitionBy(*block).orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        placed.groupBy(*block)
        .agg(F.max_by("row", F.when(~F.col("inside"), F.col("row"))).alias("last"))
        .select(*block, F.last("last", ignorenulls=True).over(earlier).alias("carried"))
    )
    return (
        placed.withColumn("start", F.last(begins, ignorenulls=True).over(window))
        .where(F.col("inside") | F.col("opens"))
        .join(carried.hint("rebalance"), block)
        .select("row", F.coalesce("start", "carried").alias("start"))
    )


def whole_records(lines: DataFrame, spanning: DataFrame) -> DataFrame:
    """Records, blank ones left out: (path, file_name, block, row, text), in the place of their first line.

    ``spanning`` is best written before: where it is small, Spark broadcasts it and the other lines stay where they are.
    """
    columns = ["path", "file_name", "block", "row", "text"]
    joined = (
        lines.select(*columns)
        .join(spanning.hint("rebalance"), "row")
        .groupBy("start", "path", "file_name")
        .agg(F.sort_array(F.collect_list(F.struct("block", "row", "text"))).alias("lines"))
        .select("path", "file_name", F.col("lines")[0]["block"].alias("block"), F.col("start").alias("row"),
                F.concat_ws("\n", F.transform("lines", lambda line: line["text"])).alias("text"))
    )
    single = lines.select(*columns).join(spanning.select("row").hint("rebalance"), "row", "left_anti")
    return (
        single.select(*columns)
        .unionByName(joined)
        .withColumn("text", F.rtrim("text", F.lit("\r")))
        .where("text != ''")
    )
