"""Words, shingles and hashes of many texts at once, on the bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Fixed odd multipliers of the polynomial and of the mixer.
BASE = np.uint64(0x9E3779B97F4A7C15)
STEP = np.uint64(0xD6E8FEB86659FD93)
_rng = np.random.default_rng(20_240)
_LETTERS = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LETTERS[65:91] = _LETTERS[97:123]  # A-Z hash as a-z
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offset of each text; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, most_bytes: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most that many bytes together, or one longer text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most_bytes, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * STEP
    x ^= x >> np.uint64(29)
    x *= BASE
    x ^= x >> np.uint64(32)
    return x


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse
    if len(_powers) < n:
        back = np.uint64(pow(int(BASE), -1, 2**64))
        for name, base in (("_powers", BASE), ("_inverse", back)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            globals()[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers[:n], _inverse[:n]


def words(data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, text number and hash of every word; ``gaps`` tells of each byte whether it parts words.

    Hashes take A-Z as a-z. Words never cross texts.
    """
    inside = ~gaps[data]
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    if len(data):
        before[0] = after[-1] = False
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    before[edges] = False
    after[edges - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    up, down = _powers_to(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTERS[data] * up[: len(data)], out=total[1:])
    hashes = mix((total[end] - total[start]) * down[start])
    return start, end, np.searchsorted(offsets, start, "right") - 1, hashes


def gaps_but(word_bytes: str) -> np.ndarray:
    """Table of the bytes that part words, from a pattern of one word byte."""
    import re

    one = re.compile(word_bytes.encode("latin-1"), re.DOTALL)
    return np.array([one.fullmatch(bytes([b])) is None for b in range(256)])


def shingles(hashes: np.ndarray, text: np.ndarray, n_texts: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``width`` words of each text, sorted within it, and their offsets.

    A text of fewer words has its whole sequence as one shingle; one without words has none.
    """
    counts = np.bincount(text, minlength=n_texts)
    first = np.concatenate(([0], np.cumsum(counts)))
    rolled = np.zeros(0, np.uint64)
    if len(hashes) >= width:
        rolled = hashes[: len(hashes) - width + 1].copy()
        for j in range(1, width):
            rolled *= BASE
            rolled += hashes[j : len(hashes) - width + 1 + j]
        rolled = mix(rolled)
    parts, sizes = [], np.zeros(n_texts, np.int64)
    for i in range(n_texts):
        n = counts[i]
        if n >= width:
            own = np.sort(rolled[first[i] : first[i] + n - width + 1])
            if len(own) > 1:
                own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        elif n:
            whole = np.uint64(n)
            with np.errstate(over="ignore"):
                for h in hashes[first[i] : first[i] + n]:
                    whole = whole * STEP + h
            own = mix(np.array([whole]))
        else:
            continue
        parts.append(own)
        sizes[i] = len(own)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.concatenate(([0], np.cumsum(sizes)))
