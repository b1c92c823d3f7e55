"""Token counts without token ids: pieces are counted once per distinct pre-token.

No piece of the vocabulary has a word-start mark behind another character, so no merge crosses the place where
a run of blanks begins, and a text's count is the sum over its pre-tokens (blanks and what follows them).
Each part of the documents sends its distinct pre-tokens to buckets by their hash. A bucket counts the pieces of each
distinct pre-token once and answers every part that asked. The part's frequencies, one entry per document and
pre-token, join the answers there and are summed. A pre-token of every document costs a bucket one
entry per part, not one per document, and the rows that move are as many as parts have distinct pre-tokens.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trenchbook.llm.bytework import _LETTERS, _powers_to, mix, slices, text_bytes
from trenchbook.llm.store import blocks_for

PART_BYTES, BUCKET_BYTES = 4 << 20, 32 << 20
_BLANK = "▁"  # the model's own mark of a blank, which means a blank in a text as well
_PRETOKEN = re.compile(" +[^ ]*")
_models: dict[str, object] = {}


def _model(path: str):
    if path not in _models:
        import sentencepiece

        _models[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _models[path]


def pretokens(text: str) -> list[str]:
    """Pre-tokens of a text, each without its first blank."""
    return [t[1:] for t in _PRETOKEN.findall(" " + text.replace(_BLANK, " "))] if text else []


def pieces_of(pretoken_list: list[str], path: str) -> np.ndarray:
    """How many pieces each pre-token has; an empty one is a lone blank."""
    encoded = _model(path).encode(pretoken_list, num_threads=1)
    return np.array([len(e) if t else 1 for e, t in zip(encoded, pretoken_list, strict=True)], np.int64)


def _pretokens_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All pre-tokens of many texts, and how many each has."""
    odd = pc.or_(pc.match_substring_regex(texts, "  |^ | $"), pc.match_substring(texts, _BLANK))
    odd = pc.or_(odd, pc.equal(texts, "")).to_numpy(zero_copy_only=False)
    lists = pc.split_pattern(texts, " ")
    if not odd.any():
        return lists.flatten(), lists.value_lengths().to_numpy().astype(np.int64)
    plain = [p if not o else pretokens(t.as_py()) for p, t, o in zip(lists.to_pylist(), texts, odd, strict=True)]
    sizes = np.array([len(p) for p in plain], np.int64)
    return pa.array([t for p in plain for t in p], pa.large_string()), sizes


def _hash(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    up, down = _powers_to(len(data) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_LETTERS[data] * up[: len(data)], dtype=np.uint64)))
    return mix((total[offsets[1:]] - total[offsets[:-1]]) * down[offsets[:-1]])


_ASKED = (
    "bucket long, part long, words binary, sizes binary,"
    " docs array<long>, n_bytes binary, word binary, row binary, times binary"
)
_ANSWERED = (
    "bucket long, part long, counts binary, docs array<long>, n_bytes binary, word binary, row binary, times binary"
)
_COUNTED = "doc_id long, n_bytes long, n_tokens long"


def _arrow(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in schema.split(","))])


def _squeeze(a: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(a).tobytes(), 1)


def _loose(blob: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(blob), kind)


def _ask(buckets: int):
    def part_rows(texts: pa.Array, docs: list, part: int) -> list[dict]:
        flat, sizes = _pretokens_of(texts)
        coded = flat.dictionary_encode()
        data, at = text_bytes(coded.dictionary)
        home = (_hash(data, at) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(home, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        n = len(docs)
        pair = place[coded.indices.to_numpy()] * n + np.repeat(np.arange(n), sizes)
        pair, times = np.unique(pair, return_counts=True)
        length = np.diff(at)
        rows = []
        for b in np.unique(home):
            own = order[np.searchsorted(home[order], b) : np.searchsorted(home[order], b, "right")]
            text = b"".join(data[at[w] : at[w + 1]].tobytes() for w in own)
            rows.append({"bucket": int(b), "part": part, "words": zstandard.compress(text, 1), "sizes": _squeeze(length[own].astype(np.uint32))})
        _, ends = text_bytes(texts)
        rows.append(
            {
                "bucket": buckets + part, "part": part, "docs": docs, "n_bytes": _squeeze(np.diff(ends)),
                "word": _squeeze((pair // n).astype(np.uint32)), "row": _squeeze((pair % n).astype(np.uint32)),
                "times": _squeeze(times.astype(np.uint32)),
            }
        )
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        for batch in batches:
            column = pc.fill_null(batch.column("text").cast(pa.large_string()), "")
            _, offsets = text_bytes(column)
            for i, j in slices(offsets, PART_BYTES):
                rows = part_rows(column.slice(i, j - i), batch.column("doc_id").slice(i, j - i).to_pylist(), part)
                yield pa.RecordBatch.from_pylist(rows, schema=_arrow(_ASKED))
                part += 1

    return run


def _answer(buckets: int, path: str):
    def run(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() >= buckets:
            empty = pa.nulls(table.num_rows, pa.binary())
            return table.append_column("counts", empty).select(_arrow(_ANSWERED).names)
        rows = table.select(["bucket", "part", "words", "sizes"]).to_pylist()
        asked = []
        for r in rows:
            ends = np.concatenate(([0], np.cumsum(_loose(r["sizes"], np.uint32).astype(np.int64))))
            data = pa.py_buffer(zstandard.decompress(r["words"]))
            asked.append(pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends.tobytes()), data))
        coded = pa.concat_arrays(asked).dictionary_encode()
        pieces = pieces_of(coded.dictionary.to_pylist(), path)[coded.indices.to_numpy()].astype(np.uint32)
        ends = np.cumsum([len(a) for a in asked])
        out = [
            {"bucket": r["bucket"], "part": r["part"], "counts": _squeeze(pieces[e - len(a) : e])}
            for r, a, e in zip(rows, asked, ends, strict=True)
        ]
        return pa.Table.from_pylist(out, schema=_arrow(_ANSWERED))

    return run


def _sum(table: pa.Table) -> pa.Table:
    rows = sorted(table.to_pylist(), key=lambda r: r["bucket"])
    own = rows.pop()
    counts = [_loose(r["counts"], np.uint32) for r in rows]
    counts = np.concatenate([*counts, np.zeros(0, np.uint32)])
    word = _loose(own["word"], np.uint32)
    if len(counts) != (int(word.max()) + 1 if len(word) else 0):
        raise RuntimeError("a part's answers don't belong to its frequencies: the input changed between attempts")
    used = counts[word].astype(np.int64) * _loose(own["times"], np.uint32)
    tokens = np.bincount(_loose(own["row"], np.uint32), weights=used, minlength=len(own["docs"])).astype(np.int64)
    return pa.table(
        {"doc_id": pa.array(own["docs"], pa.int64()), "n_bytes": _loose(own["n_bytes"], np.int64), "n_tokens": tokens}
    )


def count_tokens(documents: DataFrame, model_path: str) -> DataFrame:
    """Per row: doc_id, n_bytes (UTF-8) and n_tokens, as the library counts them without begin or end tokens.

    A null or empty text has no bytes and no tokens. Repeated rows have a row each; a null doc_id is
    allowed. Other columns don't matter and aren't returned; an empty table gives an empty result. ``model_path``
    is a file every executor has.
    """
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    buckets = blocks_for(documents, "text", BUCKET_BYTES)
    asked = texts.mapInArrow(_ask(buckets), _ASKED)
    answered = asked.groupBy("bucket").applyInArrow(_answer(buckets, model_path), _ANSWERED)
    return answered.groupBy("part").applyInArrow(_sum, _COUNTED)
