"""Reading exports: one text file per trench and record type, found anywhere under a folder."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trenchbook import config
from trenchbook.functions.text import blank_to_null, by_ending, file_stem
from trenchbook.operators.quality import check_header
from trenchbook.sources.records import decoded
from trenchbook.sources.schema import TableSchema


def list_files(spark: SparkSession, folder: str, pattern: str = "*.tab") -> DataFrame:
    """Files under the folder: (path, file_name). Only the listing is read, no content."""
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select(decoded("_metadata.file_path").alias("path"))
    )
    return listed.withColumn("file_name", F.substring_index("path", "/", -1))


def route_type(
    files: DataFrame, endings: dict[str, str] | None = None, column: str = "target"
) -> DataFrame:
    """Add the schema or type a file name leads to; null when there is none."""
    return files.withColumn(
        column, by_ending(F.col("file_name"), endings or config.EXPORT_SCHEMAS)
    )


def file_coverage(
    routed: DataFrame, surveyed: DataFrame | None = None, column: str = "target"
) -> DataFrame:
    """Each file with what it is routed to and its state: (file_name, column, state).

    "no schema"; "empty", without a header line; "failed", without a column of its schema; or "stripped".
    ``surveyed`` has (path, n_missing) of the files that were looked into.
    """
    known = F.coalesce(F.col(column), F.lit("no schema"))
    if surveyed is None:
        return routed.select("file_name", known.alias(column))
    state = (
        F.when(F.col(column).isNull(), "no schema")
        .when(F.col("n_missing").isNull(), "empty")
        .when(F.col("n_missing") > 0, "failed")
        .otherwise("stripped")
    )
    found = routed.join(surveyed.select("path", "n_missing"), "path", "left")
    return found.select("file_name", known.alias(column), state.alias("state"))


def coverage_counts(coverage: DataFrame, column: str = "target") -> DataFrame:
    """Files of each schema and state: (column, state, n_files)."""
    return coverage.groupBy(column, "state").agg(F.count("*").alias("n_files"))


def source_from_file(files: DataFrame) -> DataFrame:
    """Add Source, the trench the file name says."""
    return files.withColumn("Source", file_stem(F.col("file_name")))


def survey_files(spark: SparkSession, paths: list[str] | str, separator: str = "\t") -> DataFrame:
    """What must be known of each file before it is read: (path, header, spans_lines).

    ``spans_lines`` is true when some line holds an odd number of quotes, so that a
    record may go on in the next line. Only such files have to be read by one task each;
    a file without them is split, however large it is. One scan and one aggregate, which keeps a row
    per task and file: no text is shuffled but the headers.
    """
    lines = (
        spark.read.option("recursiveFileLookup", "true")
        .text(literal_paths(paths))
        .select(
            "value",
            decoded("_metadata.file_path").alias("path"),
            F.when(F.col("_metadata.file_block_start") == 0, F.monotonically_increasing_id()).alias("line"),
        )
    )
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    files = lines.groupBy("path").agg(
        F.min_by("value", "line").alias("first"), (F.max(quotes % 2) == 1).alias("spans_lines")
    )
    clean = F.regexp_replace("first", "[\\uFEFF\\r\"]", "")
    return files.where("first is not null").select(
        "path", F.split(clean, f"\\Q{separator}\\E").alias("header"), "spans_lines"
    )


def literal_paths(paths: str | list[str]) -> list[str]:
    """Paths that readers take as they are, whatever brackets or stars a file name holds."""
    return [re.sub(r"([\\\[\]{}*?])", r"\\\1", p) for p in ([paths] if isinstance(paths, str) else paths)]


def scan_exports(
    spark: SparkSession,
    paths: str | list[str],
    columns: list[str],
    separator: str = "\t",
    multi_line: bool = True,
) -> DataFrame:
    """All rows of files that have these columns, as text, with where they come from.

    ``seq`` is (file name, path, block, row), the recorded order: the row
    number rises within a block whatever the file was packed with. Blank text is null.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    rows = (
        spark.read.options(
            header=True,
            sep=separator,
            multiLine=multi_line,
            quote='"',
            escape='"',
            encoding="UTF-8",
            recursiveFileLookup=True,
            enforceSchema=False,
        )
        .schema(schema)
        .csv(literal_paths(paths))
    )
    return rows.select(
        *[blank_to_null(F.col(f"`{c}`")).alias(c) for c in columns],
        decoded("_metadata.file_name").alias("file_name"),
        F.struct(
            decoded("_metadata.file_name").alias("file"),
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("seq"),
    )


def strip_columns(rows: DataFrame, schema: TableSchema) -> DataFrame:
    """The schema's columns, in its order; ValueError when one is not there."""
    missing = [n for n in schema.names if n not in rows.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    kept = [c for c in ("file_name", "seq") if c in rows.columns]
    return rows.select(*[f"`{n}`" for n in schema.names], *kept)


def concat_type(tables: list[DataFrame]) -> DataFrame:
    """Site-wide table of one type: files united by column name, Source taken from the file name."""
    return reduce(DataFrame.unionByName, tables).withColumn(
        "Source", file_stem(F.col("file_name"))
    )


def type_row_counts(rows: DataFrame, column: str = "Type") -> DataFrame:
    """Rows of each type; types without rows do not show."""
    return rows.groupBy(column).agg(F.count("*").alias("n_rows"))


def record_numbers(found: DataFrame, rows: DataFrame) -> DataFrame:
    """Violations with ``record``, the number of their row's record in its file, the header being record 1.

    A record over several lines counts once. Only one row per block of a file is needed for that,
    whatever the file's size, where a block's row numbers have no gaps; where lines were joined or left out, the
    block's numbers alone are counted. ``rows`` holds every row of the files.
    """
    blocks = rows.groupBy("seq.path", "seq.block").agg(
        F.min("seq.row").alias("first_row"), F.max("seq.row").alias("last_row"), F.count("*").alias("n_rows")
    )
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = blocks.select(
        "path",
        "block",
        "first_row",
        (F.coalesce(F.sum("n_rows").over(earlier), F.lit(0)) + 2).alias("first_record"),
        (F.col("last_row") - F.col("first_row") >= F.col("n_rows")).alias("gaps"),
    )
    within = Window.partitionBy("path", "block").orderBy("at")
    counted = (
        rows.select("seq.path", "seq.block", F.col("seq.row").alias("at"))
        .join(starts.where("gaps").select("path", "block"), ["path", "block"], "left_semi")
        .withColumn("place", F.row_number().over(within) - 1)
    )
    keys = ["path", "block", "at"]
    numbered = (
        found.withColumns({"path": F.col("row.path"), "block": F.col("row.block"), "at": F.col("row.row")})
        .join(starts.hint("rebalance"), ["path", "block"])
        .join(counted.hint("rebalance"), keys, "left")
    )
    place = F.coalesce("place", F.col("at") - F.col("first_row"))
    return numbered.withColumn("record", F.col("first_record") + place).drop(
        *keys, "first_row", "first_record", "gaps", "place"
    )


def missing_columns(surveyed: DataFrame, schema: TableSchema) -> DataFrame:
    """Surveyed files with ``n_missing``, how many columns of the schema their header lacks."""
    names = F.array(*[F.lit(n) for n in schema.names])
    return surveyed.withColumn("n_missing", F.size(F.array_except(names, F.col("header"))))


def survey_records(records: DataFrame, separator: str = "\t") -> DataFrame:
    """Each file's header and the row it stands in: (path, header, head_row)."""
    heads = records.groupBy("path").agg(
        F.min_by(F.struct("text", "row"), F.struct("block", "row")).alias("head")
    )
    clean = F.regexp_replace("head.text", "[\\uFEFF\r\"]", "")
    return heads.select(
        "path", F.split(clean, f"\\Q{separator}\\E").alias("header"), F.col("head.row").alias("head_row")
    )


def read_type(
    records: DataFrame, surveyed: DataFrame, schema: TableSchema, separator: str = "\t"
) -> DataFrame | None:
    """Site-wide table of one type from its records and headers; None when no file has all columns.

    One pass whatever the headers: a record is cut into as many values as the widest header has, and its file's
    header, joined by path, tells the place of each column. The first of two columns with one name counts; a short record
    has nulls at its end. The driver sees the width alone.
    """
    usable = missing_columns(surveyed, schema).where("n_missing = 0")
    width = usable.agg(F.max(F.size("header"))).first()[0]
    if width is None:
        return None
    names = F.array(*[F.lit(n) for n in schema.names])
    heads = usable.select(
        F.col("path"),
        "head_row",
        F.transform(names, lambda n: F.array_position("header", n).cast("int") - 1).alias("places"),
    )
    cells = ", ".join(f"c{i} string" for i in range(width))
    how = {"sep": separator, "quote": '"', "escape": '"', "multiLine": "true", "maxColumns": str(width + 20480)}
    cut = (
        records.join(heads.hint("rebalance"), "path")
        .where("row != head_row")
        .withColumn("cut", F.from_csv("text", cells, how))
        .withColumn("cells", F.array(*[f"cut.c{i}" for i in range(width)]))
    )
    rows = cut.select(
        *[
            blank_to_null(F.get("cells", F.col("places")[i])).alias(n)
            for i, n in enumerate(schema.names)
        ],
        "file_name",
        F.struct(F.col("file_name").alias("file"), "path", "block", "row").alias("seq"),
    )
    return concat_type([rows])


def header_problems(surveyed: DataFrame, schema: TableSchema) -> DataFrame:
    """Header violations of the surveyed files that lack a column and are left out."""
    failed = missing_columns(surveyed, schema).where("n_missing > 0")
    return check_header(failed.select(F.substring_index("path", "/", -1).alias("source_file"), "header"), schema)
