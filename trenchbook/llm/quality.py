"""Text quality by compression: a text is good if good examples help to compress it more than bad ones.

Two zstandard dictionaries are trained, on good and on bad labelled texts. A text is compressed in pieces with
either, and the difference of the sizes, divided by the text's own, goes through a logistic curve that is fitted on
labelled texts the dictionaries haven't seen. So a text that repeats itself, and needs no example, gains little
from the good ones. A few words say little about a text, so ``PRIOR`` bytes of an average good one are added to each. Pieces are compressed each by itself: within a long text, its own
beginning would soon tell more than the dictionary. The whole text is scored, and nothing but the text.

The model is fitted on a bounded sample of labelled rows: at most ``PER_CLASS`` of either label, chosen by a hash of doc_id, and
of a long text ``DRAWN`` pieces of ``PIECE`` characters, chosen by a hash of their places anywhere in it. The labels are read
whole to choose the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PER_CLASS, DRAWN = 3000, 20
DICTIONARY_BYTES, PIECE, LEVEL = 112 << 10, 1024, 3
PRIOR = 300
FOLDS = 5


class Model(NamedTuple):
    """Two dictionaries, the mean difference of good texts, and the curve from the difference to the score."""

    good: bytes
    bad: bytes
    usual: float
    slope: float
    middle: float


def held_out(doc_id) -> F.Column:
    """Whether a document belongs to the fold that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def _sizes(texts, *dictionaries: bytes) -> np.ndarray:
    """Compressed bytes of each text with each dictionary."""
    presses = []
    for d in dictionaries:
        ready = zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_AUTO)
        ready.precompute_compress(level=LEVEL)
        presses.append(zstandard.ZstdCompressor(dict_data=ready, write_content_size=False, write_dict_id=False))
    out = np.zeros((len(texts), len(presses)))
    for i, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "replace")
        pieces = [raw[at : at + PIECE] for at in range(0, len(raw), PIECE)]
        for j, press in enumerate(presses):
            out[i, j] = sum(len(press.compress(p)) for p in pieces)
    return out


def gains(texts, good: bytes, bad: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Bytes that the good examples save more than the bad ones, and the bytes of each text."""
    sizes = _sizes(texts, good, bad)
    return sizes[:, 1] - sizes[:, 0], np.array([len((t or "").encode("utf-8", "replace")) for t in texts])


def differences(texts, good: bytes, bad: bytes, usual: float) -> np.ndarray:
    """Normalised difference of the sizes; an empty text has the usual one of a good text."""
    saved, size = gains(texts, good, bad)
    return (saved + PRIOR * usual) / (size + PRIOR)


def _dictionary(texts: list[str]) -> bytes:
    """A trained dictionary, or the texts' own beginnings where they are too few to train on."""
    samples = [p for t in texts for p in (t.encode()[i : i + PIECE] for i in range(0, len(t.encode()), PIECE)) if p]
    size = min(DICTIONARY_BYTES, max(1024, sum(map(len, samples)) // 8))
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size] or b" " * 16


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and middle of the logistic curve that fits labels y to differences x, both classes weighing alike."""
    scale = x.std() or 1.0
    z = np.stack((x / scale, np.ones(len(x))), axis=1)
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        slope = z.T @ (weight * (y - p)) - np.array([1e-4, 0]) * beta
        bend = (z * (weight * p * (1 - p))[:, None]).T @ z + np.diag([1e-4, 1e-9])
        step = np.linalg.solve(bend, slope)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(-beta[1] * scale / beta[0]) if beta[0] else 0.0


def fit(texts: list[str], quality: list[int]) -> Model:
    """Model of labelled texts: dictionaries from every second of them, the curve from the others."""
    y = np.array(quality)
    if len(set(quality)) < 2:
        return Model(b" " * 16, b" " * 16, 0.0, 0.0, 0.0)
    order = np.arange(len(texts))
    first = np.zeros(len(texts), bool)
    for label in (0, 1):
        first[order[y == label][::2]] = True
    good, bad = (_dictionary([t for t, q, f in zip(texts, quality, first, strict=True) if f and q == label]) for label in (1, 0))
    rest = [t for t, f in zip(texts, first, strict=True) if not f] or texts
    known = y[~first] if (~first).any() else y
    saved, size = gains(rest, good, bad)
    usual = float(np.median((saved / np.maximum(size, 1))[known == 1])) if (known == 1).any() else 0.0
    slope, middle = _curve(differences(rest, good, bad, usual), known)
    return Model(good, bad, usual, slope, middle)


def drawn_pieces(text: F.Column, draw: F.Column, pieces: int = DRAWN) -> F.Column:
    """The text, or of a longer one that many pieces of ``PIECE`` characters from anywhere in it, in order."""
    n = F.ceil(F.length(text) / PIECE).cast("int")
    places = F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: F.struct(F.xxhash64(draw, i), i.alias("i")))
    chosen = F.array_sort(F.transform(F.slice(F.array_sort(places), 1, pieces), lambda p: p["i"]))
    cut = F.transform(chosen, lambda i: F.substr(text, i * PIECE + 1, F.lit(PIECE)))
    return F.when(n <= pieces, text).otherwise(F.array_join(cut, ""))


def train(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Model of the labelled documents outside the held-out fold, from ``per_class`` of either label at most.

    Rows without doc_id, label or text don't count, nor do documents that repeat under one id or have labels
    that contradict each other. Without both labels every score is 0.5.
    """
    known = (
        labels.where("doc_id is not null and quality in (0, 1)")
        .where(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("high"))
        .where("quality = high")
        .select("doc_id", "quality", F.xxhash64("doc_id").alias("draw"))
    )
    chosen = [known.where(F.col("quality") == q).orderBy("draw", "doc_id").limit(per_class) for q in (0, 1)]
    # at most 2 * per_class rows, whatever the input
    picked = F.broadcast(chosen[0].unionByName(chosen[1]))
    rows = (
        documents.where("text is not null")
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .join(picked, "doc_id")
        .withColumn("text", drawn_pieces(F.col("text"), F.col("draw")))
        # one row for each picked document reaches the driver, however often a doc_id repeats
        .groupBy("doc_id", "quality", "draw")
        .agg(F.count("*").alias("copies"), F.min("text").alias("text"))
        .where("copies = 1")
        .toPandas()
        .sort_values(["draw", "doc_id"])
    )
    return fit(rows["text"].tolist(), [int(q) for q in rows["quality"]])


def score(documents: DataFrame, model: Model) -> DataFrame:
    """The documents' columns in a struct ``row``, and score (0 to 1, higher is better).

    A null or empty text has the score of a usual good one. Repeated rows score alike; other columns are passed on
    inside ``row``; an empty table gives an empty result.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        for texts in parts:
            x = differences(texts.tolist(), m.good, m.bad, m.usual)
            yield pd.Series(1 / (1 + np.exp(-np.clip(m.slope * (x - m.middle), -30, 30))))

    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns])
    return documents.select(row.alias("row"), scored(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("score"))
