"""Bottom-k sketches of a document's shingles.

The sketch is the ``K`` smallest distinct 48-bit hashes of the shingles of three words, sorted. Sketches of parts
merge into the sketch of the whole; two of them estimate resemblance, containment and the number of distinct
shingles. Documents stay where they are: a sketch is made as the text is read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trenchbook.llm.bytework import gaps_but, shingles, slices, text_bytes, words
from trenchbook.llm.store import blocks_for

K, WIDTH, BITS = 128, 3, 48
BLOCK_BYTES, CHUNK = 16 << 20, 1 << 20
GAPS = gaps_but(r"[^\x20\x09-\x0D]")


def sketches(texts: list[str]) -> list[np.ndarray]:
    """The sketch of each text."""
    data, offsets = text_bytes(pa.array(texts, pa.large_string()))
    out = []
    for i, j in slices(offsets, CHUNK):
        _, _, text, hashes = words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], GAPS)
        own, at = shingles(hashes, text, j - i, WIDTH)
        own = own >> np.uint64(64 - BITS)
        # shingle hashes are sorted, and stay so when shortened
        out += [np.unique(own[a : min(b, a + 2 * K)])[:K] for a, b in zip(at[:-1], at[1:], strict=True)]
    return out


def merge(*parts: np.ndarray) -> np.ndarray:
    """Sketch of a whole from those of its parts."""
    return np.unique(np.concatenate(parts))[:K] if parts else np.zeros(0, np.uint64)


def resemblance(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of all shingles that both have; two empty sketches are alike."""
    both = merge(a, b)
    return float(np.isin(both, np.intersect1d(a, b, assume_unique=True)).mean()) if len(both) else 1.0


def distinct(a: np.ndarray) -> float:
    """Estimated number of distinct shingles; exact below ``K``."""
    return float(len(a)) if len(a) < K else (K - 1) / ((float(a[K - 1]) + 1) / 2**BITS)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of a's shingles that b has too."""
    if not len(a):
        return 1.0
    r = resemblance(a, b)
    return min(1.0, r / (1 + r) * (distinct(a) + distinct(b)) / distinct(a))


def to_text(a: np.ndarray) -> str:
    return a.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes().hex()


def from_text(text: str) -> np.ndarray:
    raw = np.frombuffer(bytes.fromhex(text), np.uint8).reshape(-1, BITS // 8)
    return np.pad(raw, ((0, 0), (2, 0))).copy().view(">u8")[:, 0].astype(np.uint64)


def fingerprints(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, fingerprint (hex), n_distinct (estimated). A null text is empty; its sketch is too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = sketches(batch.column("text").to_pylist())
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array([to_text(s) for s in own]), pa.array([distinct(s) for s in own], pa.float64())],
                names=["doc_id", "fingerprint", "n_distinct"],
            )

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, fingerprint string, n_distinct double")


def corpus_fingerprint(prints: DataFrame) -> DataFrame:
    """One row, the merged fingerprint of all documents, from their own: values, sorted.

    Each task keeps its ``K`` smallest values, so what meets at the end doesn't grow with the documents.
    """
    value = F.explode(F.expr(f"regexp_extract_all(fingerprint, '.{{{BITS // 4}}}', 0)")).alias("value")
    least = prints.select(value).distinct().orderBy("value").limit(K)
    return least.agg(F.array_join(F.array_sort(F.collect_list("value")), "").alias("fingerprint"))


def edited(text: str, following: str) -> str:
    """The last third of the characters replaced by as many of the next text's first."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


_NULL_ID = -(2**63)
_OUT = (
    "doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double, n_distinct double, containment_next double"
)


def _compare(table: pa.Table) -> pa.Table:
    table = table.sort_by([("borrowed", "ascending"), ("id", "descending"), ("text", "ascending")])
    n = len(table) - int(np.count_nonzero(table.column("borrowed").to_numpy(zero_copy_only=False)))
    texts = table.column("text").to_pylist()
    own = sketches(texts[: n + 1])
    new = [edited(texts[i], texts[min(i + 1, len(texts) - 1)]) for i in range(n)]
    after = sketches(new)
    follows = [own[min(i + 1, len(own) - 1)] for i in range(n)]
    ids = table.column("id").to_pylist()[:n]
    rows = {
        "doc_id": pa.array([None if i == _NULL_ID else i for i in ids], pa.int64()),
        "n_chars": pa.array([len(t) for t in texts[:n]], pa.int64()),
        "edited": pa.array(new, pa.string()),
        "fingerprint": pa.array([to_text(s) for s in own[:n]], pa.string()),
        "edited_fingerprint": pa.array([to_text(s) for s in after], pa.string()),
        "near_edited": pa.array([resemblance(a, b) for a, b in zip(own, after, strict=False)], pa.float64()),
        "near_next": pa.array([resemblance(a, b) for a, b in zip(own, follows, strict=False)], pa.float64()),
        "n_distinct": pa.array([distinct(s) for s in own[:n]], pa.float64()),
        "containment_next": pa.array([containment(a, b) for a, b in zip(own, follows, strict=False)], pa.float64()),
    }
    return pa.table(rows)


def compare_with_next(documents: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Each document's fingerprint beside those of its edited text and of the next document.

    The next document is that with the next smaller doc_id; the last is followed by the first. Equal doc_id are
    ordered by text, a null doc_id comes last, a null text is empty. A document alone is followed by itself. Other
    columns don't matter; an empty table gives an empty result.

    Documents go to blocks by ranges of doc_id, each with a copy of the first document of the next range, so
    texts are shuffled once and no task sees more than a block. What reaches the driver are a block's bounds, 16
    bytes for each ``block_bytes`` of text.
    """
    spark = documents.sparkSession
    blocks = blocks_for(documents, "text", block_bytes)
    texts = documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    cuts = [i / blocks for i in range(1, blocks)]
    found = texts.agg(F.percentile_approx("id", cuts, 100 * blocks)).first()[0] if cuts else []
    bounds = np.array(sorted(set(found or [])), np.int64)

    @F.pandas_udf("long")
    def block_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.to_numpy(), "left"))

    placed = texts.withColumn("block", block_of("id"))
    tops = sorted((r["block"], r["top"]) for r in placed.groupBy("block").agg(F.max("id").alias("top")).collect())
    # the block that follows, towards smaller ids, lends its first document
    lent = spark.createDataFrame(
        [(top, tops[(i + 1) % len(tops)][0]) for i, (_, top) in enumerate(tops)], "id long, to long"
    )
    borrowed = texts.join(F.broadcast(lent), "id").select("id", "text", F.col("to").alias("block"), F.lit(True).alias("borrowed"))
    every = placed.select("id", "text", "block", F.lit(False).alias("borrowed")).unionByName(borrowed)
    return every.groupBy("block").applyInArrow(_compare, _OUT)
