"""Positions, opening and closing polygons, and map layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trenchbook import config
from trenchbook.functions import wkt
from trenchbook.functions.text import position_axis
from trenchbook.operators.contexts import contexts_only


def repeated_keys(rows: DataFrame, key: str) -> DataFrame:
    """Keys on more than one row, with the seq of the first: (repeated_key, first_seq).

    Counted before the shuffle, on two narrow columns. Written as a table, its size is known before a join
    with it is planned: Spark broadcasts a small one, and the wide rows are not shuffled. Joined as it is,
    both sides start at once and the wide rows are shuffled before the size is seen.
    """
    return (
        rows.groupBy(F.col(key).alias("repeated_key"))
        .agg(F.count("*").alias("copies"), F.min("seq").alias("first_seq"))
        .filter(F.col("copies") > 1)
        .drop("copies")
        .hint("rebalance")
    )


def _is_later_copy(key: str) -> Column:
    # A row without seq is nobody's later copy; with this branch a key that is a constant null stays a join key.
    own = F.when(F.col("seq").isNull(), F.lit("")).otherwise(F.col(key))
    return own.eqNullSafe(F.col("repeated_key")) & (F.col("seq") > F.col("first_seq"))


def dedupe_first(rows: DataFrame, key: str, repeated: DataFrame | None = None) -> DataFrame:
    """First row of each key, rows without a key counting as one key.

    ``repeated`` is the written table of ``repeated_keys``; without it they are counted here.
    """
    copies = repeated_keys(rows, key) if repeated is None else repeated
    return rows.join(copies, _is_later_copy(key), "left_anti")


def repeated_rows(rows: DataFrame, key: str, repeated: DataFrame | None = None) -> DataFrame:
    """All but the first row of each key; ``repeated`` as in ``dedupe_first``."""
    copies = repeated_keys(rows, key) if repeated is None else repeated
    return rows.join(copies, _is_later_copy(key), "left_semi")


def split_position(rows: DataFrame) -> DataFrame:
    """Add X and Y from CoveragePosition."""
    position = F.col("CoveragePosition")
    return rows.withColumns({"X": position_axis(position, 0), "Y": position_axis(position, 1)})


def split_collection(rows: DataFrame, *keep: str) -> DataFrame:
    """One row per polygon of a geometry collection: (*keep, pos, wkt, area, low)."""
    polygons = wkt.measured_polygons(F.col("CoverageXYZ"))
    return rows.select(*keep, F.inline(polygons)).select(*keep, "pos", "wkt", "area", "low")


def top_polygons(rows: DataFrame, *keep: str) -> DataFrame:
    """The two largest polygons of each row, areas all different: (*keep, place, wkt, area, low)."""
    largest = wkt.largest_two(wkt.measured_polygons(F.col("CoverageXYZ")))
    return (
        rows.select(*keep, F.posexplode(largest).alias("place", "polygon"))
        .select(*keep, "place", "polygon.wkt", "polygon.area", "polygon.low")
    )


def open_close(rows: DataFrame) -> DataFrame:
    """Add opening and closing."""
    largest = wkt.largest_two(wkt.measured_polygons(F.col("CoverageXYZ")))
    return (
        rows.withColumn("largest", largest)
        .withColumn("polygons", wkt.opening_closing(F.col("largest")))
        .select(*[f"`{c}`" for c in rows.columns], "polygons.opening", "polygons.closing")
    )


def geo_contexts(master: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """Contexts and ASUs with X, Y, opening and closing, the first row of each key.

    Copies go first, so no polygon is measured twice.
    """
    return open_close(split_position(dedupe_first(master, "IdentifierUUID", repeated)))


def polygon_issues(master: DataFrame, *keep: str, repeated: DataFrame | None = None) -> DataFrame:
    """Rows with fewer than two polygons, without a collection, or with a key used before."""
    names = wkt.polygon_texts(F.col("CoverageXYZ"))
    largest = wkt.largest_two(wkt.measured_polygons(F.col("CoverageXYZ")))
    shape = F.when(names.isNull(), "not a geometry collection").when(
        F.size(largest) < 2, "fewer than two polygons"
    )
    return (
        master.select(*keep, shape.alias("reason"))
        .filter(F.col("reason").isNotNull())
        .unionByName(
            repeated_rows(master, "IdentifierUUID", repeated).select(
                *keep, F.lit("key used before").alias("reason")
            )
        )
    )


def asu_without_context_row(geo: DataFrame) -> DataFrame:
    """Context keys that no context row has, each with the first row that names it."""
    named = (
        geo.groupBy("Context_UUID")
        .agg(F.min_by(F.struct("Source", "Type", "Identifier"), "seq").alias("first"))
    )
    own = contexts_only(geo).select("Context_UUID")
    return named.join(own, "Context_UUID", "left_anti").select("first.*", "Context_UUID")


def polygon_features(geo: DataFrame) -> DataFrame:
    """One feature per opening and per closing polygon."""
    kinds = F.array(
        F.struct(F.lit("open").alias("kind"), F.col("opening").alias("wkt")),
        F.struct(F.lit("close").alias("kind"), F.col("closing").alias("wkt")),
    )
    return geo.select(
        F.col("Source").alias("Trench"),
        "Type",
        F.col("Sub-Type").alias("SubType"),
        F.col("Identifier").alias("ID"),
        F.col("IdentifierUUID").alias("UUID"),
        F.inline(kinds),
    ).filter(F.col("wkt").isNotNull())


def layer(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Columns of a map layer, its opening polygon as wkt, rows without one dropped.

    The coordinate reference is kept in the metadata of the wkt column.
    """
    return rows.filter(F.col("opening").isNotNull()).select(
        *[f"`{c}`" for c in columns],
        F.col("opening").alias("wkt", metadata={"crs": config.LAYER_CRS}),
    )


def null_geometry_counts(rows: DataFrame) -> DataFrame:
    """Rows a layer keeps and drops: (kept, dropped)."""
    missing = F.col("opening").isNull()
    return rows.agg(F.count_if(~missing).alias("kept"), F.count_if(missing).alias("dropped"))


def layer_phase_pottery(counted: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Layer of contexts with phases and pottery counts."""
    phase_columns = [*config.PHASE_SLOTS, "Other", "Period"]
    return layer(
        counted,
        columns
        or [*config.LAYER_COLUMNS, *phase_columns, "ContextID", *config.SUMMED_COLUMNS, "Context_UUID"],
    )


def layer_find_summary(counted: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Layer of contexts with find counts."""
    return layer(
        counted,
        columns or [*config.LAYER_COLUMNS, "Context_UUID", "ASU_UUID", *config.FIND_CLASSES],
    )


def bad_wkt(rows: DataFrame, column: str, *keep: str) -> DataFrame:
    """Polygons in a WKT column that are not one closed ring of numbers: (*keep, wkt).

    Pieces are found by their parentheses alone, so whatever is written in them is seen. Every polygon
    of a collection is measured or listed here, or both (holes, unclosed rings).
    """
    pieces = F.regexp_extract_all(
        F.col(column), F.lit(config.ANY_POLYGON_PATTERN), F.lit(0)
    )
    return rows.select(*keep, F.explode(pieces).alias("wkt")).filter(
        ~wkt.is_well_formed(F.col("wkt"))
    )


