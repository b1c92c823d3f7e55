"""Publishing: typed tables with rejects, reports, and map layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trenchbook.functions.text import is_bad_number, number_cells
from trenchbook.operators.geo import dedupe_first, repeated_keys, repeated_rows
from trenchbook.sources.schema import TableSchema

KEY = "IdentifierUUID"


#: Number columns of a row as ``number_cells``.
CELLS = "number cells"


def _numbers(schema: TableSchema) -> list[str]:
    return [f.name for f in schema.fields if f.type == "number"]


def with_cells(rows: DataFrame, schema: TableSchema) -> DataFrame:
    """Rows with their number columns read as cells, once, for whoever filters by them and uses them as well.

    A filter on a projected column would read them again below the projection; it stays above the generator.
    """
    texts = F.array(*[F.col(f"`{n}`").cast("string") for n in _numbers(schema)]).cast("array<string>")
    read = rows.withColumn(CELLS, number_cells(texts))
    return read.select(*[f"`{c}`" for c in rows.columns], F.explode(F.array(F.col(f"`{CELLS}`"))).alias(CELLS))


def typed(rows: DataFrame, schema: TableSchema) -> DataFrame:
    """The schema's columns: numbers as doubles, everything else as text; rows as ``with_cells`` returns them.

    Titles and declared types stay with the columns as metadata.
    """
    place = {n: i for i, n in enumerate(_numbers(schema))}
    cells = []
    for f in schema.struct().fields:
        value = F.get(F.col(f"`{CELLS}`"), place[f.name]) if f.name in place else F.col(f"`{f.name}`").cast("string")
        cells.append(value.alias(f.name, metadata=f.metadata))
    return rows.select(*cells)


def bad_cell(schema: TableSchema) -> Column:
    """First number column whose text is not a number, as (column, value); null when all load."""
    return F.coalesce(
        F.lit(None).cast("struct<column:string,value:string>"),
        *[
            F.when(
                is_bad_number(F.col(f"`{f.name}`").cast("string")),
                F.struct(
                    F.lit(f.name).alias("column"), F.col(f"`{f.name}`").cast("string").alias("value")
                ),
            )
            for f in schema.fields
            if f.type == "number"
        ],
    )


def loadable(rows: DataFrame, schema: TableSchema, key: str = KEY) -> DataFrame:
    """Rows with a key and without a bad number, with their cells; of these the first of each key loads."""
    whole = with_cells(rows.filter(F.col(key).isNotNull()), schema)
    return whole.filter(~F.exists(F.col(f"`{CELLS}`"), F.isnan))


def seen_keys(rows: DataFrame, key: str = KEY) -> DataFrame:
    """Keys on several rows, whether these load or not; counted without reading a number."""
    several = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("copies"))
    return several.filter(F.col("copies") > 1).select(key).hint("rebalance")


def load_copies(rows: DataFrame, schema: TableSchema, key: str = KEY, seen: DataFrame | None = None) -> DataFrame:
    """Keys that several loadable rows have. Written as a table first, it keeps the wide rows in place.

    ``seen`` is the written table of ``seen_keys``: with it numbers are read in rows of these keys alone.
    """
    if seen is not None:
        rows = rows.join(seen, key, "left_semi")
    return repeated_keys(loadable(rows, schema, key), key)


def publish_table(
    rows: DataFrame, schema: TableSchema, key: str = KEY, copies: DataFrame | None = None
) -> DataFrame:
    """Rows that load, typed; ``copies`` as from ``load_copies``, where it is written already."""
    return typed(dedupe_first(loadable(rows, schema, key), key, copies), schema)


def publish_rejects(
    rows: DataFrame, schema: TableSchema, keep: list[str], key: str = KEY, copies: DataFrame | None = None
) -> DataFrame:
    """Rows that do not load, and why: (*keep, reason, column, value).

    Every row either loads or is here once. Of several bad numbers the first is named; all are violations.
    """
    none = F.lit(None).cast("string")
    repeated = repeated_rows(loadable(rows, schema, key), key, copies).select(
        *keep, F.lit("key loaded before").alias("reason"), none.alias("column"), none.alias("value")
    )
    no_key = F.col(key).isNull()
    cell = F.when(~no_key, bad_cell(schema))
    refused = rows.select(
        *keep,
        F.when(no_key, "no key").when(cell.isNotNull(), "not a number").alias("reason"),
        cell["column"].alias("column"),
        cell["value"].alias("value"),
    )
    return repeated.unionByName(refused.filter(F.col("reason").isNotNull()))


def load_counts(rows: DataFrame, schema: TableSchema, key: str = KEY) -> DataFrame:
    """Rows that load and fail: (loaded, failed). Counted per key first, so copies cost nothing."""
    loads = F.col(key).isNotNull() & bad_cell(schema).isNull()
    return (
        rows.groupBy(key)
        .agg(F.count("*").alias("n_rows"), F.max(loads).alias("loads"))
        .agg(
            F.count_if("loads").alias("loaded"),
            (F.coalesce(F.sum("n_rows"), F.lit(0)) - F.count_if("loads")).alias("failed"),
        )
    )


def report_rename(rows: DataFrame, schema: TableSchema) -> DataFrame:
    """Columns of a report under their titles."""
    return rows.select(*[F.col(f"`{f.name}`").alias(f.title or f.name) for f in schema.fields])


def write_table(rows: DataFrame, path: str) -> None:
    """Write as parquet, replacing what an earlier run wrote; files of even size."""
    rows.hint("rebalance").write.mode("overwrite").parquet(path)


def write_sorted(rows: DataFrame, path: str, *columns: str) -> None:
    """Write as parquet in the order of the columns, from file to file and within each."""
    rows.repartitionByRange(*columns).sortWithinPartitions(*columns).write.mode("overwrite").parquet(path)


def publish_reports(
    tables: dict[str, DataFrame], schemas: dict[str, TableSchema], folder: str, one_file: bool = False
) -> None:
    """Write each report as comma text with a header.

    ``one_file`` gathers a report into one file, which makes one task write it: for small sites only.
    """
    for name, schema in schemas.items():
        report = report_rename(tables[name], schema)
        if one_file:
            report = report.coalesce(1)
        report.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")


def publish_layers(layers: dict[str, DataFrame], folder: str) -> None:
    """Write each map layer as parquet: geometry as WKT, the reference system in its metadata."""
    for name, rows in layers.items():
        write_table(rows, f"{folder}/{name}")


