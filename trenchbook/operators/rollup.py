"""Pottery rolled up to contexts and ASUs, with control totals and exception lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trenchbook import config
from trenchbook.functions.text import is_bad_number, whole_number
from trenchbook.operators.contexts import asu_contexts


def own_level_key() -> Column:
    """What a bag is rolled up to when levels stay apart: its ASU, else its context."""
    return F.coalesce(
        F.when(
            F.col("ASU_UUID").isNotNull(),
            F.struct(F.col("ASU_UUID").alias("uuid"), F.lit(True).alias("at_asu")),
        ),
        F.when(
            F.col("Context_UUID").isNotNull(),
            F.struct(F.col("Context_UUID").alias("uuid"), F.lit(False).alias("at_asu")),
        ),
    )


def context_key() -> Column:
    """What a bag is rolled up to when ASUs count to their context."""
    return F.col("Context_UUID")


def _keyed(pottery: DataFrame, key: Column) -> DataFrame:
    return pottery.withColumn("key", key).filter(F.col("key").isNotNull())


def int_sums(pottery: DataFrame, key: Column, columns: list[str]) -> DataFrame:
    """Whole-number sums per key; blank and bad cells count as nothing.

    One hash aggregate for all columns, combined before the shuffle: a hot key
    sends one row per task. Columns that ``with_numbers`` has read already are summed as they are.
    """
    return _keyed(pottery, key).groupBy("key").agg(*_sums(pottery, columns))


def _sums(pottery: DataFrame, columns: list[str]) -> list[Column]:
    read = {c for c, kind in pottery.dtypes if kind == "bigint"}
    cells = {c: F.col(c) if c in read else whole_number(F.col(c)) for c in columns}
    return [F.coalesce(F.sum(cell), F.lit(0)).alias(c) for c, cell in cells.items()]


#: Cells that one array reads; a step that asks for a single column makes its array alone.
CELLS = 8


def with_numbers(bags: DataFrame, columns: list[str]) -> DataFrame:
    """Bags with summed columns as whole numbers, null where they are none; for ``int_sums``, and narrower to move than texts.

    Numbers are read over arrays of a few cells: a formula a column makes code so long that the JVM doesn't compile it.
    """
    parts = [columns[i : i + CELLS] for i in range(0, len(columns), CELLS)]
    read = bags.withColumns(
        {f"numbers_{i}": F.transform(F.array(*[F.col(c) for c in part]), whole_number) for i, part in enumerate(parts)}
    )
    cells = {c: F.get(F.col(f"numbers_{i}"), at) for i, part in enumerate(parts) for at, c in enumerate(part)}
    return read.select(*[cells[c].alias(c) if c in cells else F.col(f"`{c}`") for c in bags.columns])


def first_labels(pottery: DataFrame, key: Column) -> DataFrame:
    """First Source and ContextID of each key."""
    return _keyed(pottery, key).groupBy("key").agg(_first()).select("key", "first.*")


def _first() -> Column:
    return F.min_by(F.struct("Source", "ContextID"), "seq").alias("first")


def concat_ids(pottery: DataFrame, key: Column) -> DataFrame:
    """Bag identifiers of each key, one row per bag: (key, seq, Identifier).

    A list has the same form whatever its length. ``functions.ordered`` gives each row its position in the order of seq.
    """
    return _keyed(pottery, key).select("key", "seq", F.coalesce("Identifier", F.lit("")).alias("Identifier"))


def _rolled(pottery: DataFrame, keys: dict[str, Column], columns: list[str]) -> DataFrame:
    """Sums of ``int_sums`` and labels of ``first_labels`` in one aggregate, combined before the shuffle.

    With an aggregate each, every bag would be joined with its keys and moved twice. Rows without the first key are left out.
    """
    keyed = pottery.withColumns(keys).filter(F.col(next(iter(keys))).isNotNull())
    both = keyed.groupBy(*keys).agg(_first(), *_sums(pottery, columns))
    return both.select(*keys, "first.*", *columns)


#: What a rollup row is rolled up to: the key, and whether it is an ASU's.
LEVEL_KEY = ["level_uuid", "level_at_asu"]


def rollup_context_asu(
    pottery: DataFrame, master: DataFrame, columns: list[str] | None = None, keyed: bool = False
) -> DataFrame:
    """Bags of an ASU summed to the ASU, other bags to their context.

    The context of an ASU comes from the context table. The bags themselves are in ``concat_ids``. ``keyed`` rows have the columns
    of LEVEL_KEY as well, by which they are dealt to tasks: a join on both doesn't move them again.
    """
    columns = columns or config.SUMMED_COLUMNS
    uuid, at_asu = (F.col(c) for c in LEVEL_KEY)
    context = F.when(at_asu, F.col("asu_context")).otherwise(uuid)
    asus = asu_contexts(master).select(
        F.col("ASU_UUID").alias(LEVEL_KEY[0]),
        # True, but not a constant, which wouldn't stay a join key
        (F.length("ASU_UUID") >= 0).alias(LEVEL_KEY[1]),
        "asu_context",
    )
    level = own_level_key()
    rolled = _rolled(pottery, {LEVEL_KEY[0]: level["uuid"], LEVEL_KEY[1]: level["at_asu"]}, columns)
    return rolled.join(asus, LEVEL_KEY, "left").select(
        "Source",
        "ContextID",
        *columns,
        context.alias("Context_UUID"),
        F.when(at_asu, uuid).alias("ASU_UUID"),
        *(LEVEL_KEY if keyed else []),
    )


def rollup_context(pottery: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """All bags summed to their context, those of its ASUs included."""
    columns = columns or config.SUMMED_COLUMNS
    return _rolled(pottery, {"key": context_key()}, columns).select(
        "Source",
        "ContextID",
        *columns,
        F.col("key").alias("Context_UUID"),
        F.lit(None).cast("string").alias("ASU_UUID"),
    )


def bad_numbers(pottery: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Cells that are not numbers: (Source, ContextID, Identifier, column, value)."""
    cells = F.array(
        *[
            F.when(
                is_bad_number(F.col(c)),
                F.struct(F.lit(c).alias("column"), F.col(c).alias("value")),
            )
            for c in columns or config.SUMMED_COLUMNS
        ]
    )
    return pottery.select(
        "Source", "ContextID", "Identifier", F.explode(F.array_compact(cells)).alias("cell")
    ).select("Source", "ContextID", "Identifier", "cell.*")


def rollup_reconcile(
    pottery: DataFrame, rollups: dict[str, DataFrame], column: str = config.CONTROL_COLUMN
) -> DataFrame:
    """Control total of each rollup: (rollup, before, after, not_rolled_up).

    ``before`` is summed over the bags, ``after`` over the rollup's own rows.
    """
    total = pottery.select(
        F.explode(F.array(*[F.lit(name) for name in rollups])).alias("rollup"),
        whole_number(F.col(column)).alias("before"),
        F.lit(None).cast("bigint").alias("after"),
    )
    for name, rolled in rollups.items():
        total = total.unionByName(
            rolled.select(
                F.lit(name).alias("rollup"),
                F.lit(None).cast("bigint").alias("before"),
                F.col(column).alias("after"),
            )
        )
    return (
        total.groupBy("rollup")
        .agg(
            F.coalesce(F.sum("before"), F.lit(0)).alias("before"),
            F.coalesce(F.sum("after"), F.lit(0)).alias("after"),
        )
        .withColumn("not_rolled_up", F.col("before") - F.col("after"))
    )


def not_rolled_up(pottery: DataFrame, *keep: str) -> DataFrame:
    """Bags outside each rollup: (rollup, *keep)."""
    outside = F.array_compact(
        F.array(
            F.when(own_level_key().isNull(), F.lit("context_asu")),
            F.when(F.col("Context_UUID").isNull(), F.lit("context")),
        )
    )
    return pottery.select(F.explode(outside).alias("rollup"), *keep)


def distinct_keys(pottery: DataFrame) -> DataFrame:
    """Keys seen on bags: (kind, key) for context, asu, and context of bags without ASU."""
    seen = F.array(
        F.struct(F.lit("context").alias("kind"), F.col("Context_UUID").alias("key")),
        F.struct(F.lit("asu").alias("kind"), F.col("ASU_UUID").alias("key")),
        F.struct(
            F.lit("context without asu").alias("kind"),
            F.when(F.col("ASU_UUID").isNull(), F.col("Context_UUID")).alias("key"),
        ),
    )
    return (
        pottery.select(F.inline(seen)).filter(F.col("key").isNotNull()).distinct()
    )
