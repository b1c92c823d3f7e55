"""Count-min sketches of a whole table, of a size that is a parameter and doesn't grow with the table.

Every task counts its own keys into ``hashes`` rows of cells; the tasks' cells are summed block by block in a stream, and the
finished sketch, ``hashes`` * 2**``bits`` cells, is broadcast. A cell never counts less than any of its keys, and
counts stop at ``top``. With more keys than cells the estimates only grow, so whoever uses them to leave keys out leaves out fewer.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trenchbook.llm.bytework import mix

#: Cells of a block, the piece in which sketches are summed.
BLOCK = 1 << 16
_SALTS = np.random.default_rng(11).integers(0, 2**63, 8, dtype=np.uint64)

#: Makes keys and their counts of a batch, some at a time.
KeysOf = Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray]]]


def bits_for(keys: int, per_key: int = 8, most: int = 24) -> int:
    """Bits that give each key about ``per_key`` cells, but 16 at least and ``most`` at most."""
    return int(np.clip(int(max(1, keys) * per_key - 1).bit_length(), 16, most))


def cell(keys: np.ndarray, row: int, bits: int) -> np.ndarray:
    """Cells of unsigned 64-bit keys in a row of a sketch."""
    return (mix(keys ^ _SALTS[row]) >> np.uint64(64 - bits)).astype(np.int64)


def estimate(sketch: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Upper bounds of the keys' counts; a bound of one is exact, as are all when ``top`` wasn't reached nor cells shared."""
    bits = sketch.shape[1].bit_length() - 1
    return np.minimum.reduce([sketch[r][cell(keys, r, bits)] for r in range(len(sketch))])


def _kind(top: int):
    return np.uint8 if top < 256 else np.uint32


def _local(keys_of: KeysOf, bits: int, hashes: int, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((hashes, 1 << bits), _kind(top))
        for keys, n in (found for batch in batches for found in keys_of(batch)):
            for row in range(hashes):
                at, which = np.unique(cell(keys, row, bits), return_inverse=True)
                total = counts[row][at] + np.bincount(which, np.minimum(n, top), len(at))
                counts[row][at] = np.minimum(total, top)
        for row in range(hashes):
            for low in range(0, 1 << bits, BLOCK):
                part = counts[row, low : low + BLOCK]
                if part.any():
                    block, blob = (row << bits | low) // BLOCK, zlib.compress(part.tobytes(), 1)
                    yield pa.record_batch({"block": pa.array([block], pa.int64()), "cells": pa.array([blob], pa.binary())})

    return run


def _summed(top: int):
    kind = _kind(top)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None

        def done():
            return pa.record_batch({"block": pa.array([now]), "cells": pa.array([zlib.compress(total.astype(kind).tobytes(), 1)], pa.binary())})

        for batch in batches:
            for block, blob in zip(batch.column("block").to_pylist(), batch.column("cells"), strict=True):
                own = np.frombuffer(zlib.decompress(blob.as_buffer()), kind).astype(np.uint64)
                if block == now:
                    total = np.minimum(total + own, top)
                else:
                    if now is not None:
                        yield done()
                    now, total = block, own
        if now is not None:
            yield done()

    return run


def count_sketch(rows: DataFrame, keys_of: KeysOf, bits: int, top: int, hashes: int = 2) -> np.ndarray:
    """Sketch of the keys that ``keys_of`` makes of the rows' batches: unsigned 64-bit keys and how often each counts."""
    schema = "block long, cells binary"
    merged = (
        rows.mapInArrow(_local(keys_of, bits, hashes, top), schema)
        .repartition("block")
        .sortWithinPartitions("block")
        .mapInArrow(_summed(top), schema)
    )
    sketch = np.zeros((hashes << bits) // BLOCK * BLOCK, _kind(top))
    for r in merged.toLocalIterator():
        sketch[r.block * BLOCK : (r.block + 1) * BLOCK] = np.frombuffer(zlib.decompress(r.cells), _kind(top))
    return sketch.reshape(hashes, 1 << bits)
