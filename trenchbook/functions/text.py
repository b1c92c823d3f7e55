"""Column expressions over recorded text: relation lists, numbers, file names, phases, find titles."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from trenchbook import config


def is_asu() -> Column:
    """True for rows that are a part of a context rather than a context."""
    return F.coalesce(F.col("Type").isin(config.ASU_TYPES), F.lit(False))


def relation_members(relation: str | Column) -> Column:
    """Relation text as an array of trimmed, non-empty keys, in order; null for a null text."""
    text = F.col(relation) if isinstance(relation, str) else relation
    parts = F.split(text, re.escape(config.RELATION_SEPARATOR))
    return F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: p != "")


def blank_to_null(column: str | Column, missing: list[str] | tuple[str, ...] = ("",)) -> Column:
    """Null where the text is one of the missing values."""
    text = F.col(column) if isinstance(column, str) else column
    return F.when(~text.isin(list(missing)), text)


def _spoilt(text: Column) -> Column:
    """Text in which Java's own spellings (``1d``, ``0x1p3``, ``Infinity``) are spoilt."""
    return F.translate(text, "dDfFxX", "??????")


def _parsed(text: Column) -> Column:
    """Text as a double, but not in Java's own spellings."""
    return _spoilt(text).try_cast("double")


def whole_number(text: Column) -> Column:
    """Text as a whole number, fractions cut off towards zero; null when it is not a number.

    There is no shortcut through bigint: a failed cast to it is far dearer.
    """
    return _parsed(text).try_cast("bigint")


def number(text: Column) -> Column:
    """Text as a double; null when it is not a number or its whole part needs more than 64 bits.

    The one rule for checks, sums, loading and coordinates: what this reads, ``whole_number`` reads too.
    """
    return F.when(whole_number(text).isNotNull(), _parsed(text))


def _unspelt(texts: Column) -> Column:
    """An array of texts in which Java's own spellings are spoilt.

    Their letters are looked for in all texts of the array together; most arrays have none.
    """
    return F.get(
        F.transform(
            F.array(texts),
            lambda cells: F.when(
                F.array_join(cells, " ").rlike("[dDfFxX]"), F.transform(cells, _spoilt)
            ).otherwise(cells),
        ),
        0,
    )


def number_cells(texts: Column) -> Column:
    """An array of texts by the rule of ``number``, each parsed once: null where there is no text, NaN where it isn't a number."""
    nan = F.lit(float("nan"))
    read = F.transform(_unspelt(texts), lambda t: F.coalesce(t.try_cast("double"), F.when(t != "", nan)))
    return F.transform(
        read,
        # the whole part is read only of what may be too long for 64 bits
        lambda d: F.when((F.abs(d) < 2.0**62) | F.isnan(d), d).when(d.try_cast("bigint").isNotNull(), d).when(d.isNotNull(), nan),
    )


def is_bad_number(text: Column) -> Column:
    """True for text that is there, is not blank, and is not a number."""
    return text.isNotNull() & (text != "") & whole_number(text).isNull()


def date_time(text: Column) -> Column:
    """ISO date and time (``2018-07-10T08:00:00``, seconds and zone may be left out); null for anything else."""
    return F.when(text.rlike(config.DATE_TIME_PATTERN), F.try_to_timestamp(text))


def by_ending(file_name: Column, endings: dict[str, str]) -> Column:
    """Value whose key is an ending of the file name, trying each ending length in turn."""
    table = F.create_map(*[F.lit(x) for pair in endings.items() for x in pair])
    return F.coalesce(
        *[F.try_element_at(table, F.right(file_name, F.lit(n))) for n in config.ENDING_LENGTHS]
    )


def file_stem(file_name: Column) -> Column:
    """File name up to its first dot, without the prefix of stripped files."""
    stem = F.substring_index(file_name, ".", 1)
    return F.regexp_replace(stem, "^" + re.escape(config.STRIPPED_PREFIX), "")


def phase_slot(phase: Column, spellings: dict[str, tuple[str, str]] | None = None) -> Column:
    """Slot a recorded phase belongs to; 'Other' for anything not in the vocabulary."""
    spellings = spellings or config.PHASE_SPELLINGS
    table = F.create_map(*[F.lit(x) for k, (slot, _) in spellings.items() for x in (k, slot)])
    return F.coalesce(F.try_element_at(table, phase), F.lit("Other"))


def phase_flag(phase: Column, spellings: dict[str, tuple[str, str]] | None = None) -> Column:
    """'yes' or '?' for a listed spelling, else the recorded text itself ('' when empty)."""
    spellings = spellings or config.PHASE_SPELLINGS
    table = F.create_map(*[F.lit(x) for k, (_, flag) in spellings.items() for x in (k, flag)])
    return F.coalesce(F.try_element_at(table, phase), phase, F.lit(""))


def find_class(title: Column, classes: dict[str, list[str]] | None = None) -> Column:
    """First class one of whose words is in the title, whatever its case; null for none."""
    lowered = F.lower(title)
    hits = [
        F.when(
            F.greatest(*[F.instr(lowered, w) for w in words], F.lit(0)) > 0, F.lit(name)
        )
        for name, words in (classes or config.FIND_CLASSES).items()
    ]
    return F.coalesce(*hits)


def position_axis(position: Column, axis: int) -> Column:
    """X (axis 0) or Y (axis 1) of an "x,y" text; null when there is no comma."""
    return F.when(F.contains(position, F.lit(",")), F.get(F.split(position, ","), axis))
