"""Removal of repeated passages, by a radix sort of suffixes that stops at a fixed depth.

Tokens are bytes, the depth is ``DEPTH`` of them: two suffixes that agree that far start the same window, so
the groups that are left at full depth are exactly the repeated windows. The digits, most significant first:

1. ``GRAM`` bytes. Of each window only one position is sorted by this digit: where the gram with the smallest
   hash stands (all of them, if several tie). Equal windows choose equal positions, so no repeat is lost, and
   about one position in 16 is shuffled, as four bytes. Grams seen in one document only end here.
2. The gram with the ``SIDE`` bytes on either side. Documents whose surroundings are those of a smaller document
   are settled: every window around the gram is repeated. This is done in each block of documents first,
   so that a gram in a third of all documents is sent on once per block and not once per document.
3. What differs somewhere: eight bytes at a time from the first byte of each window, dropping windows that
   are left alone, until the whole window is sorted.

Documents are dealt to blocks by id. All three shuffles are of packed arrays by block or by bucket of grams,
and the numbers of both grow with the input, so that neither outgrows a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trenchbook.llm.bytework import BASE, mix, slices, text_bytes
from trenchbook.llm.store import blocks_for

DEPTH, GRAM = 50, 20
SIDE = DEPTH - GRAM
WIDE = GRAM + 2 * SIDE
CHUNK = 1 << 18
BLOCK_BYTES = 8 << 20
_rng = np.random.default_rng(50)
_BYTES = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_ODD = _rng.integers(0, 2**63, WIDE // 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _rolled(h: np.ndarray, other: np.ndarray, by: int, width: int) -> np.ndarray:
    """Hashes of strings of which ``other`` has the last ``width`` bytes, ``by`` further on."""
    n = len(other) - by
    out = h[:n] * np.uint64(pow(int(BASE), width, 2**64))
    out += other[by : by + n]
    return out


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """Smallest or largest of every ``width`` neighbours."""
    span = 1
    while 2 * span <= width:
        x = pick(x[: len(x) - span], x[span:])
        span *= 2
    rest = width - span
    return pick(x[: len(x) - rest], x[rest:]) if rest else x


def _anchors_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose gram is the smallest of a window, and the grams' hashes."""
    n = len(data)
    if n < DEPTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h1 = _BYTES[data]
    h2 = _rolled(h1, h1, 1, 1)
    h4 = _rolled(h2, h2, 2, 2)
    h8 = _rolled(h4, h4, 4, 4)
    h16 = _rolled(h8, h8, 8, 8)
    gram = mix(_rolled(h16, h4, 16, 4))
    least = _slide(gram, DEPTH - GRAM + 1, np.minimum)
    ends = np.repeat(offsets[1:], np.diff(offsets))[: len(least)]
    least[np.arange(DEPTH, DEPTH + len(least)) > ends] = 0  # windows that would cross into the next text
    room = np.zeros(SIDE, np.uint64)
    best = _slide(np.concatenate((room, least, room)), SIDE + 1, np.maximum)
    at = np.flatnonzero((best == gram) & (best > 0))
    return at, gram[at]


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for many texts, a bounded run of them at a time."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.uint64))]
    for i, j in slices(offsets, CHUNK):
        at, gram = _anchors_of(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        found.append((at + offsets[i], gram))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _place(gram: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """A gram's bucket, and the 32 bits that tell it from others in there."""
    return ((gram >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64), (gram & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _ordered(table: pa.Table) -> pa.Table:
    """A block's documents in a fixed order, so that byte addresses mean the same each time."""
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def _runs(*columns: np.ndarray) -> np.ndarray:
    """First places of runs of equal rows."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _split(keys: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of a sorted array."""
    if len(keys):
        first = _runs(keys)
        for a, b in zip(first, np.append(first[1:], len(keys)), strict=True):
            yield int(keys[a]), slice(int(a), int(b))


def _merged(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Intervals as few that don't touch, as pairs."""
    if not len(start):
        return np.zeros((0, 2), np.int64)
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    first = np.flatnonzero(np.concatenate(([True], start[1:] > end[:-1])))
    return np.stack((start[first], end[np.append(first[1:], len(start)) - 1]), axis=1)


def _first_digit(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        table = _ordered(table)
        data, offsets = text_bytes(table.column("text"))
        ids = table.column("doc_id").to_numpy()
        at, gram = anchors(data, offsets)
        order = np.argsort(gram, kind="stable")
        gram, doc = gram[order], ids[np.searchsorted(offsets, at[order], "right") - 1]
        first = _runs(gram) if len(gram) else np.zeros(0, np.int64)
        last = np.append(first[1:], len(gram))[: len(first)] - 1
        # a gram of several documents of this block counts twice
        gram = np.repeat(gram[first], 1 + (doc[first] != doc[last]))
        bucket, low = _place(gram, buckets)
        order = np.argsort(bucket, kind="stable")
        rows = [(b, low[order[s]].tobytes()) for b, s in _split(bucket[order])]
        return pa.table(
            {
                "bucket": pa.array([r[0] for r in rows], pa.int64()),
                "block": pa.array([table.column("block")[0].as_py()] * len(rows), pa.int64()),
                "grams": pa.array([r[1] for r in rows], pa.binary()),
            }
        )

    return run


def _repeated(table: pa.Table) -> pa.Table:
    """Grams of each block that come again in the bucket. All blocks are searched at once: there are as many as the
    input has, so that a pass over the bucket for each would be work by the square of the input."""
    column = table.column("grams").combine_chunks().cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    every = np.frombuffer(data, np.uint8)[at[0] : at[-1]].view(np.uint32)
    ends = (at - at[0]) // 4
    ranked = np.sort(every)
    again = ranked[1:][ranked[1:] == ranked[:-1]]
    again = again[_runs(again)] if len(again) else again
    kept = np.zeros(len(every), bool)
    if len(again):
        kept = again[np.minimum(np.searchsorted(again, every), len(again) - 1)] == every
    # a gram that counted twice in its block stands beside itself
    same = np.zeros(len(every), bool)
    same[1:] = every[1:] == every[:-1]
    same[ends[:-1][ends[:-1] < len(every)]] = False
    kept &= ~same
    left = np.concatenate(([0], np.cumsum(kept)))[ends] * 4
    grams = pa.Array.from_buffers(
        pa.large_binary(), len(column), [None, pa.py_buffer(left), pa.py_buffer(every[kept].tobytes())]
    )
    some = pa.array(np.diff(left) > 0)
    return table.select(["block", "bucket"]).append_column("grams", grams.cast(pa.binary())).filter(some)


def _surroundings(data: np.ndarray, at: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The bytes around each gram; zeros beyond the text."""
    padded = np.concatenate((np.zeros(SIDE, np.uint8), data, np.zeros(SIDE, np.uint8)))
    wide = np.lib.stride_tricks.sliding_window_view(padded, WIDE)[at] if len(at) else np.zeros((0, WIDE), np.uint8)
    wide = np.ascontiguousarray(wide)
    place = np.arange(WIDE)
    for i in np.flatnonzero((left < SIDE) | (right < SIDE)):
        wide[i, (place < SIDE - left[i]) | (place >= SIDE + GRAM + right[i])] = 0
    return wide


def _wide_key(wide: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    key = left.astype(np.uint64) * np.uint64(64) + right.astype(np.uint64)
    for j, odd in enumerate(_ODD):
        key = mix(key + wide.view(np.uint64)[:, j] * odd)
    return key


def _settle(wide, left, right, doc) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by surroundings and document; number of the group, and its smallest document, in that order.

    Rows are one group only if their bytes agree. Were two groups' keys ever the same, they would only be
    taken apart too finely, which the last digit mends.
    """
    order = np.lexsort((doc, _wide_key(wide, left, right)))
    w, le, r, d = wide[order], left[order], right[order], doc[order]
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = (w[1:] != w[:-1]).any(axis=1) | (le[1:] != le[:-1]) | (r[1:] != r[:-1]) | (d[1:] < d[:-1])
    group = np.cumsum(new) - 1
    return order, group, d[np.flatnonzero(new)][group] if len(order) else d


_PACKED = "bucket long, block long, wide binary, sides binary, docs binary, owners binary, places binary"


def _second_digit(buckets: int):
    def run(table: pa.Table, known: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if table.num_rows and known.num_rows:
            table = _ordered(table)
            block = table.column("block")[0].as_py()
            data, offsets = text_bytes(table.column("text"))
            ids = table.column("doc_id").to_numpy()
            again = np.sort(
                np.concatenate(
                    [
                        (np.uint64(b) << np.uint64(32)) | np.frombuffer(g, np.uint32).astype(np.uint64)
                        for b, g in zip(known.column("bucket").to_pylist(), known.column("grams").to_pylist(), strict=True)
                    ]
                )
            )
            at, gram = anchors(data, offsets)
            bucket, low = _place(gram, buckets)
            name = (bucket.astype(np.uint64) << np.uint64(32)) | low
            found = again[np.minimum(np.searchsorted(again, name), len(again) - 1)] == name
            at, bucket = at[found], bucket[found]
            doc = np.searchsorted(offsets, at, "right") - 1
            left = np.minimum(SIDE, at - offsets[doc]).astype(np.uint8)
            right = np.minimum(SIDE, offsets[doc + 1] - at - GRAM).astype(np.uint8)
            wide = _surroundings(data, at, left, right)
            order, group, least = _settle(wide, left, right, ids[doc])
            at, bucket, own = at[order], bucket[order], ids[doc][order]
            wide, left, right = wide[order], left[order], right[order]
            later = own > least
            spans = _merged(at[later] - left[later], at[later] + GRAM + right[later])
            rows.append((buckets + block, block, None, None, None, None, spans.tobytes()))
            # the groups with their smallest document, and the places in it, by bucket
            at, bucket, group, own = at[~later], bucket[~later], group[~later], own[~later]
            wide, left, right = wide[~later], left[~later], right[~later]
            order = np.argsort(bucket, kind="stable")
            press = zstandard.ZstdCompressor(level=1)
            for b, s in _split(bucket[order]):
                rows_of = order[s]
                first = _runs(group[rows_of])
                head = rows_of[first]
                owner = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(rows_of)))).astype(np.uint32)
                sides = np.concatenate((left[head], right[head]))
                rows.append(
                    (b, block, press.compress(wide[head].tobytes()), press.compress(sides.tobytes()), own[head].tobytes(), owner.tobytes(), at[rows_of].tobytes())
                )
        names = ["bucket", "block", "wide", "sides", "docs", "owners", "places"]
        kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 5]
        return pa.table({n: pa.array([r[i] for r in rows], k) for i, (n, k) in enumerate(zip(names, kinds, strict=True))})

    return run


def _dense(group: np.ndarray, digit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by group, then digit, and the first places of the new groups in that order."""
    order = np.lexsort((digit, group))
    return order, _runs(group[order], digit[order])


def _word(wide: np.ndarray, at: int) -> np.ndarray:
    return np.ascontiguousarray(wide[:, at : at + 8]).view(np.uint64)[:, 0]


def repeated_windows(wide, left, right, doc) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest start, within each row's bytes, of a window that a smaller document has too.

    All windows of a row overlap in its gram, so those between are covered as well. -1: none.
    """
    low, high = np.full(len(doc), -1), np.full(len(doc), -1)

    def narrow(rows: np.ndarray, group: np.ndarray, places) -> tuple[np.ndarray, np.ndarray]:
        for at in places:
            if not len(rows):
                break
            order, first = _dense(group, _word(wide[rows], at))
            size = np.diff(np.append(first, len(order)))
            group = np.repeat(np.arange(len(first)), size)
            shared = np.repeat(size > 1, size)
            rows, group = rows[order][shared], group[shared]
        return rows, group

    rows, gram = narrow(np.arange(len(doc)), np.zeros(len(doc), np.int64), (SIDE, SIDE + 8, SIDE + GRAM - 8))
    for s in range(SIDE + 1):
        fits = (left[rows] >= SIDE - s) & (right[rows] >= s)
        places = [a for a in (*range(s, s + DEPTH - 8, 8), s + DEPTH - 8) if not SIDE <= a <= SIDE + GRAM - 8]
        r, g = narrow(rows[fits], gram[fits], places)
        if not len(r):
            continue
        order = np.lexsort((doc[r], g))
        r, g = r[order], g[order]
        first = _runs(g)
        least = np.repeat(doc[r][first], np.diff(np.append(first, len(r))))
        hit = r[doc[r] > least]
        low[hit] = np.where(low[hit] < 0, s, low[hit])
        high[hit] = s
    return low, high


def _last_digits(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() >= buckets:
            return table.select(["block", "places"])
        spread = zstandard.ZstdDecompressor()
        parts = table.to_pylist()
        docs = [np.frombuffer(p["docs"], np.int64) for p in parts]
        wide = np.concatenate(
            [np.frombuffer(spread.decompress(p["wide"]), np.uint8).reshape(-1, WIDE) for p in parts]
        )
        sides = [np.frombuffer(spread.decompress(p["sides"]), np.uint8).reshape(2, -1) for p in parts]
        left, right = np.concatenate(sides, axis=1)
        doc = np.concatenate(docs)
        order, _, least = _settle(wide, left, right, doc)
        start, end = np.full(len(doc), -1), np.full(len(doc), -1)
        later = doc[order] > least
        done, rest = order[later], order[~later]
        start[done], end[done] = -left[done].astype(np.int64), GRAM + right[done].astype(np.int64)
        low, high = repeated_windows(wide[rest], left[rest], right[rest], doc[rest])
        hit = low >= 0
        start[rest[hit]], end[rest[hit]] = low[hit] - SIDE, high[hit] + DEPTH - SIDE
        rows, base = [], 0
        for p, own in zip(parts, docs, strict=True):
            owner = np.frombuffer(p["owners"], np.uint32).astype(np.int64) + base
            at = np.frombuffer(p["places"], np.int64)
            cut = end[owner] >= 0
            spans = _merged(at[cut] + start[owner][cut], at[cut] + end[owner][cut])
            rows.append((p["block"], spans.tobytes()))
            base += len(own)
        return pa.table({"block": pa.array([r[0] for r in rows], pa.int64()), "places": pa.array([r[1] for r in rows], pa.binary())})

    return run


def _remove(table: pa.Table, found: pa.Table) -> pa.Table:
    if not table.num_rows:
        return pa.table({"doc_id": pa.array([], pa.int64()), "kept": pa.array([], pa.binary()), "n_bytes": pa.array([], pa.int64()), "spans": pa.array([], _SPANS)})
    table = _ordered(table)
    data, offsets = text_bytes(table.column("text"))
    spans = [np.frombuffer(b, np.int64).reshape(-1, 2) for b in found.column("places").to_pylist()]
    spans = np.concatenate([*spans, np.zeros((0, 2), np.int64)])
    spans = _merged(spans[:, 0], spans[:, 1])
    # runs end where their text does
    owner = np.searchsorted(offsets, spans[:, 0], "right") - 1
    while len(spans) and (over := spans[:, 1] > offsets[owner + 1]).any():
        tail = np.stack((offsets[owner + 1][over], spans[over, 1]), axis=1)
        spans[over, 1] = offsets[owner + 1][over]
        spans = np.concatenate((spans, tail))
        spans = spans[np.argsort(spans[:, 0], kind="stable")]
        owner = np.searchsorted(offsets, spans[:, 0], "right") - 1
    lo, hi = np.searchsorted(owner, np.arange(table.num_rows)), np.searchsorted(owner, np.arange(table.num_rows), "right")
    kept, cuts = [], []
    for i in range(table.num_rows):
        at, parts = offsets[i], []
        for a, b in spans[lo[i] : hi[i]]:
            parts.append(data[at:a])
            at = b
        parts.append(data[at : offsets[i + 1]])
        kept.append(b"".join(p.tobytes() for p in parts))
        cuts.append([{"start": int(a - offsets[i]), "end": int(b - offsets[i])} for a, b in spans[lo[i] : hi[i]]])
    return pa.table(
        {
            "doc_id": table.column("doc_id"),
            "kept": pa.array(kept, pa.binary()),
            "n_bytes": pa.array(np.diff(offsets)),
            "spans": pa.array(cuts, _SPANS),
        }
    )


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def remove_repeats(documents: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Texts without the bytes that a 50-byte string covers which also starts in a document with a smaller doc_id.

    Columns: doc_id, kept (the bytes left, in order; a cut may fall inside a character), n_bytes (of
    the input) and spans (maximal removed runs, as start and end in bytes).

    A null text is empty. Texts shorter than 50 bytes stay whole. Rows with the same doc_id don't touch each
    other; a row without doc_id neither loses nor causes anything. Other columns don't matter and
    aren't returned; an empty table gives an empty result.
    """
    blocks = blocks_for(documents, "text", block_bytes)
    texts = documents.select(
        F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(blocks)), F.lit(0)).alias("block"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    named = texts.where("doc_id is not null")
    grams = named.groupBy("block").applyInArrow(_first_digit(blocks), "bucket long, block long, grams binary")
    again = grams.groupBy("bucket").applyInArrow(_repeated, "block long, bucket long, grams binary")
    packed = named.groupBy("block").cogroup(again.groupBy("block")).applyInArrow(_second_digit(blocks), _PACKED)
    found = packed.groupBy("bucket").applyInArrow(_last_digits(blocks), "block long, places binary")
    out = "doc_id long, kept binary, n_bytes long, spans array<struct<start:long,end:long>>"
    cut = named.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(_remove, out)
    bare = texts.where("doc_id is null").select(
        "doc_id", F.encode("text", "utf-8").alias("kept"), F.octet_length("text").cast("long").alias("n_bytes"),
        F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)").alias("spans"),
    )
    return cut.unionByName(bare)


def brute_force(texts: dict[int, bytes]) -> dict[int, tuple[int, int, str]]:
    """The same by looking up every window, for small inputs: removed bytes, runs, and digest of the rest."""
    first: dict[bytes, int] = {}
    for doc in sorted(texts):
        for p in range(len(texts[doc]) - DEPTH + 1):
            first.setdefault(texts[doc][p : p + DEPTH], doc)
    out = {}
    for doc, text in texts.items():
        cut = np.zeros(len(text) + 2, bool)
        for p in range(len(text) - DEPTH + 1):
            if first[text[p : p + DEPTH]] < doc:
                cut[p + 1 : p + 1 + DEPTH] = True
        rest = bytes(b for b, c in zip(text, cut[1:], strict=False) if not c)
        out[doc] = int(cut.sum()), int((cut[1:] & ~cut[:-1]).sum()), hashlib.sha256(rest).hexdigest()
    return out
