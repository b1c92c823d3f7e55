"""Packing of tokenized documents into sequences, shortest pack first over the length histogram.

Documents are cut into pieces of at most ``SEQUENCE`` tokens. Pieces differ only by their length for a packing,
so it is made on the histogram: lengths are placed longest first, each on the packs that are shortest so
far, which takes whole counts at a time. The result is a few patterns of lengths and how often each is used. The
pieces then find their place by rank: the r-th piece of a length belongs to the pattern whose range of
ranks has r.

Ranks come from a range sort and the counts of its partitions; no length's pieces meet in one task. The
histogram has at most ``SEQUENCE`` rows, so only its size, not the input's, reaches the driver.
"""

from __future__ import annotations

import base64
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trenchbook.llm.store import Store

SEQUENCE = 1024
#: Written after each document.
END_ID = 0
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_coders: dict[tuple[str, str], object] = {}


def coder(json_path: str, ranks_path: str):
    """A function from texts to ids: the ids of the tokenizer in ``json_path``.

    ``ranks_path`` has the same vocabulary as ranks, which another library reads several times faster. Text it refuses
    goes to the first library; the tests compare the two.
    """
    if (json_path, ranks_path) not in _coders:
        import tiktoken
        from tokenizers import Tokenizer

        exact = Tokenizer.from_file(json_path)
        special = {t.content: i for i, t in exact.get_added_tokens_decoder().items()}
        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        fast = tiktoken.Encoding("ranks", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens=special)

        def encode(text: str) -> list[int]:
            try:
                return fast.encode(text, allowed_special="all")
            except BaseException as error:  # its regex engine gives up on some texts, as a panic
                if isinstance(error, (KeyboardInterrupt, SystemExit)):
                    raise
                return exact.encode(text, add_special_tokens=False).ids

        _coders[json_path, ranks_path] = encode
    return _coders[json_path, ranks_path]


def _pieces(json_path: str, ranks_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = coder(json_path, ranks_path)
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = np.array([*encode(text.as_py() or ""), END_ID], "<u4")
                for start in range(0, len(ids), SEQUENCE):
                    part = ids[start : start + SEQUENCE]
                    rows.append((doc, start, len(part), zlib.crc32(part.tobytes()), len(ids)))
            columns = zip(*rows, strict=True) if rows else [()] * 5
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=names)

    return run


def patterns(histogram: dict[int, int], room: int = SEQUENCE) -> list[tuple[list[int], int]]:
    """Shortest pack first: patterns of lengths, and how many sequences have each."""
    packs: dict[int, list[tuple[list[int], int]]] = defaultdict(list)  # by the space left
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            space = max((s for s, p in packs.items() if p), default=0)
            if space < length:
                for n in (room // length, 1):  # several to a new sequence, then the rest
                    if left >= n:
                        packs[room - length * n].append(([length] * n, left // n))
                        left -= left // n * n
                continue
            pattern, count = packs[space].pop()
            used = min(left, count)
            if count > used:
                packs[space].append((pattern, count - used))
            packs[space - length].append(([*pattern, length], used))
            left -= used
    return [p for group in packs.values() for p in group]


def slots(found: list[tuple[list[int], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length: first rank of each range, sequence of that rank, offset in the sequence."""
    rank: dict[int, int] = defaultdict(int)
    out: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    sequence = 0
    for pattern, count in found:
        at = 0
        for length in pattern:
            out[length].append((rank[length], sequence, at))
            rank[length] += count
            at += length
        sequence += count
    return {k: tuple(np.array(v, np.int64).T) for k, v in out.items()}


def _placed(table: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length):
                own = length == n
                first, seq, at = table[int(n)]
                k = np.searchsorted(first, rank[own], "right") - 1
                sequence[own], offset[own] = seq[k] + rank[own] - first[k], at[k]
            kept = batch.select(["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
            yield pa.record_batch([*kept.columns, pa.array(sequence), pa.array(offset)], names=[*kept.schema.names, "sequence_id", "offset"])

    return run


def pack(documents: DataFrame, json_path: str, ranks_path: str, store: Store | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are those of its text, then ``END_ID``; a null or empty text has that one alone. Pieces of a
    sequence follow each other without gaps. Rows that repeat a doc_id are documents of their own, a null doc_id is
    allowed. Other columns don't matter; an empty table gives an empty result. The paths are files that every
    executor has.
    """
    store = store or Store(documents.sparkSession, "pack")
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    names = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    pieces = store.keep(texts.mapInArrow(_pieces(json_path, ranks_path), names))
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    table = slots(patterns(counts))
    ordered = store.keep(
        pieces.repartitionByRange("length", "doc_id", "start")
        .sortWithinPartitions("length", "doc_id", "start")
        .withColumn("task", F.spark_partition_id())
        .withColumn("line", F.monotonically_increasing_id())
    )
    runs = ordered.groupBy("task", "length").agg(F.min("line").alias("first"), F.count("*").alias("n"))
    before = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    ranked = runs.select("task", "length", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return (
        ordered.join(ranked.hint("rebalance"), ["task", "length"])
        .withColumn("rank", F.col("line") + F.col("shift"))
        .drop("task", "line", "shift")
        .mapInArrow(_placed(table), f"{names}, sequence_id long, offset long")
    )
