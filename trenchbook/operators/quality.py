"""Checks of a table against its schema; every violation is a row.

Violations have the columns (source_file, row, item, column, code, message,
value, field_type, field_format), where ``item`` holds the first four columns of the row,
and then the columns of the row that the caller wants carried along.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trenchbook.functions.text import blank_to_null, date_time, whole_number
from trenchbook.sources.schema import Field, TableSchema

REQUIRED = "required-constraint"
UNIQUE = "unique-constraint"
ENUM = "enumerable-constraint"
TYPE = "type-or-format-error"
MISSING_HEADER = "missing-header"
EXTRA_HEADER = "extra-header"
PROBLEM = (
    "struct<column:string,code:string,message:string,value:string,field_type:string,field_format:string>"
)


def missing_values(rows: DataFrame, schema: TableSchema) -> DataFrame:
    """Null wherever the schema says a text means missing."""
    present = [n for n in schema.names if n in rows.columns]
    return rows.withColumns(
        {n: blank_to_null(F.col(f"`{n}`"), schema.missing_values) for n in present}
    )


def _problem(f: Field, code: str, message: str) -> Column:
    return F.struct(
        F.lit(f.name).alias("column"),
        F.lit(code).alias("code"),
        F.lit(message).alias("message"),
        F.col(f"`{f.name}`").cast("string").alias("value"),
        F.lit(f.type).alias("field_type"),
        F.lit(f.format).alias("field_format"),
    )


def _value_checks(f: Field) -> list[tuple[Column, Column]]:
    """Checks of one column that need nothing but its own value: when it fails, and the problem."""
    value = F.col(f"`{f.name}`")
    checks = []
    if f.required:
        checks.append((value.isNull(), _problem(f, REQUIRED, f"{f.name} is required")))
    if f.enum:
        checks.append(
            (~value.isin(list(f.enum)), _problem(f, ENUM, f"{f.name} is not one of the listed values"))
        )
    typed = {  # numbers are checked as cells
        "integer": value.try_cast("bigint"),
        "datetime": date_time(value),
    }.get(f.type)
    if typed is not None:
        checks.append(
            (value.isNotNull() & typed.isNull(), _problem(f, TYPE, f"{f.name} is not a {f.type}"))
        )
    return checks


def _first(schema: TableSchema) -> Column:
    """A row's first four columns as texts."""
    return F.array(*[F.coalesce(F.col(f"`{n}`").cast("string"), F.lit("")) for n in schema.names[:4]])


def _identified(schema: TableSchema, source_file: str, row: str) -> list[Column]:
    return [
        F.col(source_file).alias("source_file"),
        F.col(row).alias("row"),
        F.concat_ws(" - ", _first(schema)).alias("item"),
    ]


def check_values(
    rows: DataFrame,
    schema: TableSchema,
    source_file: str = "file_name",
    row: str = "seq",
    carry: tuple[str, ...] = (),
    recorded: bool = False,
) -> DataFrame:
    """Required, enum and type checks of all columns in one pass, without a shuffle.

    Number columns are laid out as cells and the rule is applied to these: written out for each of many columns
    it is a method so long that the JVM interprets it. Rows as ``recorded`` have missing values still as texts; those of
    number columns become nulls in the cells.
    """
    numbers = [f for f in schema.fields if f.type == "number"]
    cell_of = {f.name: f.name for f in numbers}
    if recorded:
        cell_of = {n: f"recorded {n}" for n in cell_of}
        rows = missing_values(rows.withColumns({c: F.col(f"`{n}`") for n, c in cell_of.items()}), schema)
    problems = [F.when(fails, problem) for f in schema.fields for fails, problem in _value_checks(f)]
    none = F.lit(None)
    laid_out = [
        F.struct(
            none.cast("int").alias("place"), none.cast("string").alias("text"), p.cast(PROBLEM).alias("problem")
        )
        for p in problems
    ] + [
        F.struct(
            F.lit(i).alias("place"), F.col(f"`{cell_of[f.name]}`").cast("string").alias("text"),
            none.cast(PROBLEM).alias("problem"),
        )
        for i, f in enumerate(numbers)
    ]
    nothing = F.array().cast(f"array<struct<place:int,text:string,problem:{PROBLEM}>>")
    text, place, problem = (F.col(f"problem.{c}") for c in ("text", "place", "problem"))
    text = blank_to_null(text, schema.missing_values) if recorded else text
    cells = rows.select(
        *_identified(schema, source_file, row),
        *carry,
        F.explode(F.array(*laid_out) if laid_out else nothing).alias("problem"),
    )
    # The whole number is there whenever the number is.
    found = cells.filter(problem.isNotNull() | (text.isNotNull() & whole_number(text).isNull()))
    if not numbers:
        return found.withColumn("problem", problem).select("source_file", "row", "item", "problem.*", *carry)
    name, form = (
        F.get(F.array(*[F.lit(t) for t in texts]), place) for texts in zip(*[(f.name, f.format) for f in numbers])
    )
    bad = F.struct(
        name.alias("column"),
        F.lit(TYPE).alias("code"),
        F.concat(name, F.lit(" is not a number")).alias("message"),
        text.alias("value"),
        F.lit("number").alias("field_type"),
        form.alias("field_format"),
    )
    return found.withColumn("problem", F.coalesce(problem, bad)).select(
        "source_file", "row", "item", "problem.*", *carry
    )


def _unique_cells(schema: TableSchema) -> Column:
    """Columns (column, value) of every unique column, as an array to inline."""
    return F.array(
        *[
            F.struct(F.lit(f.name).alias("column"), F.col(f"`{f.name}`").cast("string").alias("value"))
            for f in schema.fields
            if f.unique
        ]
    )


def _scope(source_file: str, site_wide: bool) -> Column:
    return F.lit("") if site_wide else F.coalesce(F.col(source_file), F.lit(""))


def repeated_values(
    rows: DataFrame, schema: TableSchema, source_file: str = "file_name", site_wide: bool = False
) -> DataFrame:
    """Values that rows share in a unique column, within a file or anywhere: (scope, column, value).

    Counted before the shuffle, on these three columns. Written as a table, its size is known before
    ``check_unique`` is planned: Spark broadcasts a small one, and the rows are not shuffled.
    """
    return (
        rows.select(_scope(source_file, site_wide).alias("scope"), F.inline(_unique_cells(schema)))
        .filter(F.col("value").isNotNull())
        .groupBy("scope", "column", "value")
        .agg(F.count("*").alias("copies"))
        .filter(F.col("copies") > 1)
        .drop("copies")
        .hint("rebalance")
    )


def check_unique(
    rows: DataFrame,
    schema: TableSchema,
    source_file: str = "file_name",
    row: str = "seq",
    site_wide: bool = False,
    carry: tuple[str, ...] = (),
    repeated: DataFrame | None = None,
) -> DataFrame:
    """Rows that share a value of a unique column within their file, or anywhere.

    All unique columns are checked together, and texts are made for rows found only.
    ``repeated`` is the written table of ``repeated_values``; without it they are counted here, and the
    rows are shuffled as well.
    """
    if repeated is None:
        repeated = repeated_values(rows, schema, source_file, site_wide)
    cells = rows.select(
        F.col(source_file).alias("source_file"),
        F.col(row).alias("row"),
        _first(schema).alias("first"),
        *carry,
        _scope(source_file, site_wide).alias("scope"),
        F.inline(_unique_cells(schema)),
    )
    unique = [f for f in schema.fields if f.unique]
    types = F.create_map(*[F.lit(x) for f in unique for x in (f.name, f.type)])
    formats = F.create_map(*[F.lit(x) for f in unique for x in (f.name, f.format)])
    return cells.join(repeated, ["scope", "column", "value"], "left_semi").select(
        "source_file",
        "row",
        F.concat_ws(" - ", "first").alias("item"),
        "column",
        F.lit(UNIQUE).alias("code"),
        F.concat("column", F.lit(" must be unique")).alias("message"),
        "value",
        F.try_element_at(types, F.col("column")).alias("field_type"),
        F.try_element_at(formats, F.col("column")).alias("field_format"),
        *carry,
    )


def check_header(files: DataFrame, schema: TableSchema) -> DataFrame:
    """Columns missing from a file's header, and columns the schema does not know, of files (source_file, header)."""
    names = F.array(*[F.lit(n) for n in schema.names])

    def problems(columns: Column, code: str, message: str) -> Column:
        return F.transform(
            columns,
            lambda c: F.struct(
                c.alias("column"), F.lit(code).alias("code"), F.concat(c, F.lit(message)).alias("message")
            ),
        )

    missing = problems(F.array_except(names, F.col("header")), MISSING_HEADER, " is missing")
    extra = problems(F.array_except(F.col("header"), names), EXTRA_HEADER, " is not in the schema")
    return files.select("source_file", F.inline(F.concat(missing, extra)))


def violations(
    rows: DataFrame,
    schema: TableSchema,
    source_file: str = "file_name",
    row: str = "seq",
    site_wide: bool = False,
    carry: tuple[str, ...] = (),
    repeated: DataFrame | None = None,
) -> DataFrame:
    """All violations of a table, after its missing values became nulls; ``repeated`` as in ``check_unique``."""
    found = check_values(rows, schema, source_file, row, carry, recorded=True)
    if any(f.unique for f in schema.fields):
        rows = missing_values(rows, schema)
        found = found.unionByName(
            check_unique(rows, schema, source_file, row, site_wide, carry, repeated)
        )
    return found


def violation_report(found: DataFrame) -> DataFrame:
    """Violations as a reader wants them: the item, the column, and what is wrong."""
    return found.select("source_file", "row", "item", "column", "code", "message")


def violation_counts(rows: DataFrame, found: DataFrame, source_file: str = "file_name") -> DataFrame:
    """Each file with its rows and violations: (source_file, n_rows, n_violations, failing)."""
    files = rows.groupBy(F.col(source_file).alias("source_file")).agg(
        F.count("*").alias("n_rows")
    )
    counts = found.groupBy("source_file").agg(F.count("*").alias("n_violations"))
    number = F.coalesce("n_violations", F.lit(0))
    return files.join(counts, "source_file", "left").select(
        "source_file", "n_rows", number.alias("n_violations"), (number > 0).alias("failing")
    )


def file_totals(counts: DataFrame) -> DataFrame:
    """Files examined, clean and failing."""
    return counts.agg(
        F.count("*").alias("examined"),
        F.count_if(~F.col("failing")).alias("clean"),
        F.count_if("failing").alias("failing"),
    )


POTTERY_CARRY = (
    "Source", "ShapeCountComment", "PotteryCountDiagnosticsBeforeMending", "Identifier",
)


def pottery_violations(found: DataFrame, site_wide: bool = False) -> DataFrame:
    """Violations of pottery bags: (source_file, code, row, column, message, value, field_type, field_format).

    Site-wide also trench, shape comment, diagnostic count and bag number, which
    the check pass carries along (POTTERY_CARRY), so the bags are not joined again.
    """
    basic = ["source_file", "code", "row", "column", "message", "value", "field_type", "field_format"]
    names = ("trench", "shapecount", "diagcount", "potbag")
    carried = [F.col(c).alias(n) for c, n in zip(POTTERY_CARRY, names)] if site_wide else []
    return found.select(*basic, *carried)


def all_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Violations of several tables in one, each tagged with its table."""
    tagged = [found.withColumn("table", F.lit(name)) for name, found in tables.items()]
    return reduce(DataFrame.unionByName, tagged)
