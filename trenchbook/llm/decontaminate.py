"""Benchmark passages in training text, found by spaced seeds.

A seed is a fixed mask over neighbouring words: some positions are compared, the others ignored, so a
replaced word spoils only the seeds that look at it. The seeds of every benchmark item are hashed once; the
documents' seeds are joined to them, and around each hit document and item are compared word by word on
the hit's diagonal. An overlap counts where ``WINDOW`` words of the item (all of a shorter one) stand in the
document with at most ``CHANGES`` of them replaced. Among them the masks hit every such window: the tests try
every way of placing the changes.

The benchmark is the stated query set. It is read in blocks of at most ``BLOCK_BYTES`` of text, each small
enough to be sent to every task; documents stay where they are, and nothing is shuffled but the few overlaps.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trenchbook.llm.bytework import BASE, gaps_but, mix, slices, text_bytes, words
from trenchbook.llm.store import blocks_for

WINDOW, CHANGES = 13, 3
#: Fixed masks: 1 is compared, 0 is ignored.
MASKS = ("1111", "11011", "110101")
#: Words that a seed compares; an item of fewer is looked up whole.
WEIGHT = 4
#: An item shorter than a window may have one word replaced if it has this many.
ONE_CHANGE = 8
BLOCK_BYTES = 4 << 20
CHUNK = 1 << 20
#: Hits of seeds held at once.
PAIRS = 1 << 21
GAPS = gaps_but(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


class Items(NamedTuple):
    """A block of benchmark items: words one after the other, and seeds sorted by hash."""

    ids: np.ndarray
    offsets: np.ndarray
    words: np.ndarray
    seeds: np.ndarray
    places: np.ndarray  # of each seed's first word, counted through all items
    short: dict[int, tuple[np.ndarray, np.ndarray]]  # by length: hashes, places


def _seeds(hashes: np.ndarray, text: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a mask at every place where it fits into one text, and the places."""
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.full(n, np.uint64(int(mask, 2)))
    for j, used in enumerate(mask):
        if used == "1":
            total *= BASE
            total += hashes[j : j + n]
    at = np.flatnonzero(text[:n] == text[len(mask) - 1 :])
    return mix(total)[at], at


def prepare(ids: list[int], texts: list[str]) -> Items:
    """Words and seeds of benchmark items; items without words are left out."""
    data, offsets = text_bytes(pa.array(texts, pa.large_string()))
    _, _, text, hashes = words(data, offsets, GAPS)
    n = np.bincount(text, minlength=len(ids))
    found = [_seeds(hashes, text, m) for m in MASKS]
    seeds, places = (np.concatenate([f[i] for f in found]) for i in (0, 1))
    order = np.argsort(seeds, kind="stable")
    short = {}
    for length in range(1, WEIGHT):
        whole, at = _seeds(hashes, text, "1" * length)
        own = n[text[at]] == length
        order_short = np.argsort(whole[own], kind="stable")
        if own.any():
            short[length] = whole[own][order_short], at[own][order_short]
    return Items(np.array(ids, np.int64), np.concatenate(([0], np.cumsum(n))), hashes, seeds[order], places[order], short)


def _pairs(sought: np.ndarray, table: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every match of a value with a sorted table: place of the value, place in the table; about PAIRS at a time."""
    low, high = np.searchsorted(table, sought), np.searchsorted(table, sought, "right")
    met = np.flatnonzero(high > low)
    share = np.cumsum(high[met] - low[met]) // PAIRS
    for part in np.split(met, np.flatnonzero(np.diff(share)) + 1):
        n = high[part] - low[part]
        yield np.repeat(part, n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[part], n)


def _lines(hits: Iterator[tuple[np.ndarray, np.ndarray]], text: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Distinct (text, item, shift) of hits (word in the documents, word in the items).

    Frequent words hit often but on few diagonals, so many hits are reduced to these as they come.
    """
    found, held = [np.zeros((0, 3), np.int64)], 0
    for place, word in hits:
        found.append(np.stack((text[place], np.searchsorted(offsets, word, "right") - 1, place - word), axis=1))
        held += len(place)
        if held > PAIRS:
            found, held = [np.unique(np.concatenate(found), axis=0)], 0
    return np.unique(np.concatenate(found), axis=0)


def overlaps(hashes: np.ndarray, text: np.ndarray, first: np.ndarray, items: Items) -> list[tuple[int, int, int, int, int]]:
    """(text, item, first word, end word, equal words) of every verified overlap, as maximal runs of windows.

    first: number of the first word of each text, and the end.
    """
    tables = [(mask, items.seeds, items.places) for mask in MASKS]
    tables += [("1" * length, *table) for length, table in items.short.items()]

    def hits() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for mask, table, places in tables:
            seed, at = _seeds(hashes, text, mask)
            for i, j in _pairs(seed, table):
                yield at[i], places[j]

    out = []
    for d, k, shift in _lines(hits(), text, items.offsets).tolist():
        a, b = items.offsets[k], items.offsets[k + 1]
        span = min(WINDOW, b - a)
        low, high = max(a, first[d] - shift), min(b, first[d + 1] - shift)
        if high - low < span:
            continue
        equal = hashes[low + shift : high + shift] == items.words[low:high]
        total = np.concatenate(([0], np.cumsum(equal)))
        changes = CHANGES if span == WINDOW else span // ONE_CHANGE
        ok = np.flatnonzero(total[span:] - total[:-span] >= span - changes)
        if not len(ok):
            continue
        for run in np.split(ok, np.flatnonzero(np.diff(ok) > span) + 1):
            s, e = int(run[0]), int(run[-1]) + span
            out.append((d, int(items.ids[k]), int(low + shift - first[d]) + s, int(low + shift - first[d]) + e, int(total[e] - total[s])))
    return out


_HITS = "row long, spans array<struct<item_id:long,start:long,end:long,equal:long>>"


def _scan(items: Items):
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("item_id", "start", "end", "equal")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            spans: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            n_words = np.zeros(batch.num_rows, np.int64)
            for i, j in slices(offsets, CHUNK):
                own = offsets[i : j + 1] - offsets[i]
                _, _, text, hashes = words(data[offsets[i] : offsets[j]], own, GAPS)
                n_words[i:j] = np.bincount(text, minlength=j - i)
                first = np.concatenate(([0], np.cumsum(n_words[i:j])))
                for d, item, s, e, equal in overlaps(hashes, text, first, items):
                    spans[i + d].append({"item_id": item, "start": s, "end": e, "equal": equal})
            kept = batch.select([c for c in batch.schema.names if c not in ("text", "spans")])
            before = batch.column("spans").to_pylist()
            both = [(b or []) + s for b, s in zip(before, spans, strict=True)]
            yield pa.record_batch(
                [*kept.columns, batch.column("text"), pa.array(n_words), pa.array(both, kind)],
                names=[*kept.schema.names, "text", "n_words", "spans"],
            )

    return run


def find_leaks(documents: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: the documents' columns as a struct ``row``, n_words, and spans of benchmark passages.

    A span has item_id, start and end in words of the document, and how many of them equal the item's.
    Words are runs of letters, digits and characters beyond ASCII, A-Z taken as a-z. Items of fewer than
    13 words must stand whole, those of 8 or more with one word replaced at most, shorter ones unchanged.

    Null or empty texts and items have no words and match nothing. Rows that repeat are each judged alike; a repeated
    item, of one item_id and text, counts once. A null doc_id is allowed, items without item_id are left out. Other columns are passed on
    inside ``row``; an empty table, or an empty benchmark, gives no spans.
    """
    named = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    )
    # distinct, so that no item repeats in a block
    asked = named.where("item_id is not null and text is not null").distinct()
    blocks = blocks_for(asked, "text", block_bytes)
    asked = asked.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    kind = "array<struct<item_id:bigint,start:bigint,end:bigint,equal:bigint>>"
    rows = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.expr(f"cast(null as {kind})").alias("spans"),
    )
    schema = rows.schema
    for block in range(blocks):
        # One block of the stated query set, at most about BLOCK_BYTES of text.
        items = asked.where(F.col("block") == block).select("item_id", "text").toArrow()
        ready = prepare(items.column("item_id").to_pylist(), items.column("text").to_pylist())
        rows = rows.drop("n_words").mapInArrow(_scan(ready), schema)
    return rows.select("row", "n_words", "spans")
