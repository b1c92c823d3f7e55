"""Near-duplicate documents by HyperMinHash.

Per document the shingles' hashes go through ``REGISTERS`` buckets, each with a hash of its own. A bucket
keeps the smallest hash as 16 bits: six for the count of leading zeros, ten for the mantissa behind
them. Groups of ``BAND`` registers are banded. A pair that shares a band is first estimated from the
registers, with the share of equal registers corrected for chance collisions, and only then confirmed
on the full shingle sets.

A pair at the threshold misses every band with probability (1 - 0.8**5)**32, or 3 in a million. Nothing
else is approximate: no group, partner or candidate is capped.

* Documents with equal sets are one class. Only the class's smallest document goes on.
* Each band key first links its members to its smallest one, so a group of any size makes one row per
  member. After that only documents of a band key whose members these links left in different components are compared. Pairs of them are
  not listed by band, which would be the square of a group: they are found by their rarest shingles and a bound on what they can share
  (``jaccard_join.links_apart``), then estimated and confirmed like all others.
* Hot keys are split by adaptive execution: every join here is between two plain shuffles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trenchbook.llm.bytework import gaps_but, mix, shingles, slices, text_bytes, words
from trenchbook.llm.components import components
from trenchbook.llm.jaccard_join import in_groups, links_apart, with_rare
from trenchbook.llm.store import Store

BANDS, BAND = 32, 5
REGISTERS = BANDS * BAND
MANTISSA = 10
#: Estimates below the threshold by more than this are not confirmed: over five standard deviations.
MARGIN = 0.18
CHUNK = 1 << 19
GAPS = gaps_but(r"[^\x20\x09-\x0D]")
_rng = np.random.default_rng(7)
_FLIP = _rng.integers(0, 2**63, REGISTERS, dtype=np.uint64)
_SPIN = _rng.integers(0, 2**63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def document_shingles(column, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct shingle hashes and their offsets, for a run of texts at a time."""
    data, offsets = text_bytes(column)
    for i, j in slices(offsets, CHUNK):
        own = offsets[i : j + 1] - offsets[i]
        _, _, text, hashes = words(data[offsets[i] : offsets[j]], own, GAPS)
        yield shingles(hashes, text, j - i, width)


def registers(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Registers (documents x REGISTERS, 16 bits) of shingle sets; an empty set has zeros."""
    out = np.zeros((len(offsets) - 1, REGISTERS), np.uint16)
    full = np.flatnonzero(np.diff(offsets))
    for part in np.array_split(full, max(1, len(values) // 100_000)):
        if not len(part):
            continue
        low, high = offsets[part[0]], offsets[part[-1] + 1]
        own, at = values[low:high], offsets[part] - low
        for r in range(REGISTERS):
            least = np.minimum.reduceat((own ^ _FLIP[r]) * _SPIN[r], at)
            # exponent and leading mantissa bits, read off the floating-point form
            code = (least.astype(np.float64).view(np.uint64) >> np.uint64(52 - MANTISSA)).astype(np.int64)
            exponent = np.clip((code >> MANTISSA) - 1023, 0, 63)
            out[part, r] = ((63 - exponent) << MANTISSA) | (code & ((1 << MANTISSA) - 1))
    return out


def similarity(left: np.ndarray, right: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of register rows of sets with n and m elements."""
    equal = (left == right).mean(axis=1)
    n, m = n.astype(float), m.astype(float)
    chance = 0.169919487159739 * 2.0**-MANTISSA * 4 * n * m / np.maximum(n + m, 1) ** 2
    return (equal - chance) / (1 - chance)


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return np.asarray(batch.column(name).to_numpy(zero_copy_only=False))


def _sketch(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = 0
            for values, offsets in document_shingles(batch.column("text"), width):
                n = np.diff(offsets)
                full = np.flatnonzero(n)
                keys = np.zeros((2, len(n)), np.uint64)
                if len(full):
                    keys[0, full] = np.add.reduceat(mix(values), offsets[full])
                    keys[1, full] = np.add.reduceat(mix(values ^ _FLIP[0]), offsets[full])
                rows = registers(values, offsets)
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_id").slice(low, len(n)),
                        "n_shingles": pa.array(n),
                        "set_a": pa.array(keys[0].view(np.int64)),
                        "set_b": pa.array(keys[1].view(np.int64)),
                        "registers": pa.array([r.tobytes() for r in rows], pa.binary()),
                    }
                )
                low += len(n)

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = 0
            for values, offsets in document_shingles(batch.column("text"), width):
                n = len(offsets) - 1
                blobs = [values[offsets[i] : offsets[i + 1]].tobytes() for i in range(n)]
                yield pa.record_batch(
                    {"doc_id": batch.column("doc_id").slice(low, n), "shingles": pa.array(blobs, pa.binary())}
                )
                low += n

    return run


def _estimated(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                left, right = (
                    np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS)
                    for c in ("regs_a", "regs_b")
                )
                near = similarity(left, right, _column(batch, "n_a"), _column(batch, "n_b")) >= least
                yield batch.select(["a", "b"]).filter(pa.array(near))

    return run


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (a, b) in enumerate(zip(batch.column("set_a"), batch.column("set_b"), strict=True)):
                x, y = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(x, y), len(x) - 1)
                both = int((x[at] == y).sum())
                keep[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def _with_both(pairs: DataFrame, table: DataFrame, *names: tuple[str, str, str]) -> DataFrame:
    """Pairs (a, b) with columns of both documents; names: column, its name for a, and for b."""
    for side, at in (("a", 1), ("b", 2)):
        own = table.select(F.col("doc_id").alias(side), *[F.col(n[0]).alias(n[at]) for n in names])
        pairs = pairs.join(own, side)
    return pairs


def near_duplicates(
    documents: DataFrame, width: int = 5, percent: int = 80, store: Store | None = None
) -> DataFrame:
    """Every row's document, its shingle count, its component and whether it is the one to keep.

    Words are runs of bytes other than white space, A-Z taken as a-z; a shingle is ``width`` of them. Two
    documents are linked when 100 * intersection >= ``percent`` * union of their shingle sets. Columns:
    doc_id, n_shingles, component_id (the smallest doc_id reachable, itself included), kept.

    A null or empty text, or one without words, has no shingles and is linked with nothing. A text with fewer
    words than ``width`` has one shingle. Rows that repeat a doc_id are one node, with a row each in the
    result. A row without doc_id can't be linked: component_id is null and it is kept. Other columns don't
    matter and aren't returned; an empty table gives an empty result.
    """
    spark = documents.sparkSession
    store = store or Store(spark, "near")
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = store.keep(
        texts.mapInArrow(
            _sketch(width), "doc_id long, n_shingles long, set_a long, set_b long, registers binary"
        )
    )
    real = sketch.where("doc_id is not null and n_shingles > 0")
    classes = real.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep"))
    member = store.keep(
        real.select("doc_id", "set_a", "set_b")
        .join(classes.hint("rebalance"), ["set_a", "set_b"])
        .select("doc_id", "rep")
    )
    reps = store.keep(
        real.join(classes.hint("rebalance"), ["set_a", "set_b"])
        .where("doc_id = rep")
        .select("doc_id", "n_shingles", "registers")
    )
    band_key = F.expr(
        f"transform(sequence(0, {BANDS - 1}), i -> xxhash64(i, substring(registers, i * {2 * BAND} + 1, {2 * BAND})))"
    )
    keys = reps.select("doc_id", F.explode(band_key).alias("key"))
    leads = (
        keys.groupBy("key").agg(F.min("doc_id").alias("lead"), F.max("doc_id").alias("last")).where("lead < last")
    )
    buckets = store.keep(
        keys.join(leads.select("key", "lead").hint("rebalance"), "key").select("key", "doc_id", "lead")
    )

    def close(pairs: DataFrame) -> DataFrame:
        least = percent / 100 - MARGIN
        both = _with_both(pairs, reps, ("registers", "regs_a", "regs_b"), ("n_shingles", "n_a", "n_b"))
        return store.keep(both.mapInArrow(_estimated(least), "a long, b long"))

    def linked(pairs: DataFrame) -> DataFrame:
        both = _with_both(pairs, sets, ("shingles", "set_a", "set_b"))
        return store.keep(both.mapInArrow(_confirmed(percent), "a long, b long"))

    met = buckets.select("doc_id").distinct()
    sets = store.keep(
        texts.join(met.hint("rebalance"), "doc_id", "left_semi")
        .dropDuplicates(["doc_id"])
        .mapInArrow(_sets(width), "doc_id long, shingles binary")
    )
    # Each member with the smallest of its bucket.
    tried = close(buckets.where("doc_id > lead").select(F.col("lead").alias("a"), F.col("doc_id").alias("b")).distinct())
    links = linked(tried)
    stars = components(links, store)
    # The rest: documents that share a band with one of another component.
    named = store.keep(
        met.join(stars.select(F.col("node").alias("doc_id"), "root").hint("rebalance"), "doc_id", "left").select(
            "doc_id", F.coalesce("root", "doc_id").alias("root")
        )
    )
    listed = buckets.select("key", "doc_id").join(named.hint("rebalance"), "doc_id")
    split = listed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    open_docs = store.keep(
        listed.join(split.select("key").hint("rebalance"), "key", "left_semi").select("doc_id", "root").distinct()
    )
    open_sets = store.keep(
        sets.join(open_docs.select("doc_id").hint("rebalance"), "doc_id", "left_semi").select("doc_id", F.col("shingles").alias("tokens"))
    )
    crowded = open_docs.groupBy("root").agg(F.count("*").alias("n")).where("n > 1").select("root")
    dealt = in_groups(open_docs.join(crowded.hint("rebalance"), "root", "left_semi").select(F.col("doc_id").alias("node"), "root"))
    placed = store.keep(
        with_rare(open_sets, percent)
        .join(dealt.drop("root").hint("rebalance"), "doc_id", "left")
        .join(open_docs.hint("rebalance"), "doc_id")
        .select("doc_id", "n", "rare", "root", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("groups", "grp")])
    )
    more = links_apart(
        placed,
        lambda ids: open_sets.join(ids.distinct().hint("rebalance"), "doc_id", "left_semi"),
        lambda pairs, _: linked(close(pairs)),
        percent,
        store,
    )
    roots = components(links.unionByName(more), store)
    found = (
        member.distinct()
        .join(roots.select(F.col("node").alias("rep"), "root").hint("rebalance"), "rep", "left")
        .select("doc_id", F.coalesce("root", "rep").alias("root"))
        .groupBy("doc_id")
        .agg(F.min("root").alias("root"))
    )
    component = F.coalesce("root", "doc_id")
    return (
        sketch.select("doc_id", "n_shingles")
        .join(found, "doc_id", "left")
        .select(
            "doc_id",
            "n_shingles",
            component.alias("component_id"),
            F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        )
    )
