"""Phrase collocations: multikey three-way quicksort of suffix pointers, to the depth of the longest phrase.

A suffix is what a word's place begins: the language, then up to ``LONGEST`` words of the piece of text. Suffixes are routed by their
leading words to ranges, and in each range sorted word by word: three-way partitioning by a pivot leaves the
suffixes that share a word in one part, which is sorted on by the next word. The size of such a part is the count of its phrase.
A part of fewer than ``least`` suffixes is abandoned, with all longer phrases in it. Only a phrase that a range begins or ends
with may go on in the next range, so its partial count is kept whatever its size, and added up.

* Ranges are cut where the suffixes are, at any word, so a common leading word is dealt over many ranges. Equal
  suffixes of a few million bytes of text are one row with a count, so a phrase on a third of all lines is a row per block.
* Before anything is routed, sketches of words and of pairs of words tell what is surely rare; a suffix ends before it.
  They have a bounded size (``SKETCH_BITS``): where they fill up, more is routed, and the result is the same.
* Texts are cut into words once. Blocks of word numbers with their own dictionary are written and read again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trenchbook.functions.joins import join_lookup
from trenchbook.llm.bytework import mix, words
from trenchbook.llm.sketch import bits_for, count_sketch, estimate
from trenchbook.llm.store import Store

LONGEST, LEAST, TOP = 4, 30, 2000
SCALE, COVERED = 2_000_000, 80
#: Bytes of text in a block, and of all blocks that a task has open at a time.
BLOCK, OPEN = 4 << 20, 16 << 20
#: At most 2 * 2**23 one-byte cells are broadcast for either sketch.
SKETCH_BITS = 23
#: Words of text for each range; a range holds no more suffix rows than that, and less where suffixes repeat or are rare.
RANGE = 1 << 20
#: Shares that the ranking of a language is dealt to.
SHARES = 64
_SPACE = np.array([b == 32 for b in range(256)])
#: Fixed: A-Z become a-z, a tab a space, and the bytes that end a piece a full stop.
_FOLD = bytes(
    32 if b == 9 else 46 if chr(b) in ".,;:!?\n\v\f\r" else b + 32 if 65 <= b <= 90 else b for b in range(256)
)


def _packed(numbers: np.ndarray) -> bytes:
    """32-bit numbers, all first bytes, then all second ones, and so on, compressed."""
    return zstandard.compress(np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 4).T).tobytes())


def _unpacked(packed: bytes) -> np.ndarray:
    """The numbers of ``_packed``."""
    own = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(own.T).view(np.int32).ravel()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of one language: its words, and their places as numbers from 1 with 0 where a piece ends."""
    open_texts: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}

    def told(lang: str) -> pa.RecordBatch:
        raw = b".".join([*open_texts.pop(lang), b""])
        del sizes[lang]
        number: dict[bytes, int] = {b".": 0}
        found = raw.translate(_FOLD).replace(b".", b" . ").split()
        places = np.fromiter((number.setdefault(w, len(number)) for w in found), np.int32, len(found))
        places = places[np.concatenate(([True], (places[1:] != 0) | (places[:-1] != 0)))]  # one end is enough
        return pa.record_batch(
            {
                "lang": pa.array([lang]),
                "words": pa.array([zstandard.compress(b" ".join(list(number)[1:]))], pa.binary()),
                "places": pa.array([_packed(places)], pa.binary()),
                "n_words": pa.array([int((places > 0).sum())]),
            }
        )

    for batch in (b.slice(low, 500) for b in batches for low in range(0, b.num_rows, 500)):
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            raw = text.encode()
            open_texts.setdefault(lang, []).append(raw)
            sizes[lang] = sizes.get(lang, 0) + len(raw) + 1
            if sizes[lang] >= BLOCK:
                yield told(lang)
            while sum(sizes.values()) >= OPEN:
                yield told(max(sizes, key=sizes.get))
    for lang in list(sizes):
        yield told(lang)


class _Block:
    """A block's words, their hashes, and its places."""

    def __init__(self, row: dict) -> None:
        self.lang, self.blob = row["lang"], zstandard.decompress(row["words"])
        self.places = _unpacked(row["places"])
        data = np.frombuffer(self.blob, np.uint8)
        own = words(data, np.array([0, len(data)]), _SPACE)[3] if len(data) else np.zeros(0, np.uint64)
        salt = mix(np.frombuffer(self.lang.encode().ljust(-(-len(self.lang.encode()) // 8) * 8 or 8, b"\0"), "<u8").astype(np.uint64))
        self.hashes = np.append(np.uint64(0), mix(own + salt.sum()))
        self.counts = np.bincount(self.places, minlength=len(self.hashes))

    def frequent(self, sketch: np.ndarray, least: int) -> np.ndarray:
        """Whether each place holds a word that may be frequent."""
        own = estimate(sketch, self.hashes) >= least
        own[0] = False
        return own[self.places]

    def pairs(self, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs of neighbouring frequent words: their keys, counts, and which one each place begins (or -1)."""
        begins = frequent[:-1] & frequent[1:]
        packed = self.places[:-1][begins].astype(np.int64) << 32 | self.places[1:][begins]
        distinct, which, counts = np.unique(packed, return_inverse=True, return_counts=True)
        keys = mix(self.hashes[distinct >> 32] * np.uint64(3) + mix(self.hashes[distinct & 0xFFFFFFFF]))
        at = np.full(len(self.places), -1)
        at[:-1][begins] = which
        return keys, counts, at


def _opened(batch: pa.RecordBatch) -> Iterator[_Block]:
    """The blocks of a batch, one at a time."""
    for i in range(batch.num_rows):
        yield _Block(batch.slice(i, 1).to_pylist()[0])


def _word_keys(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for b in _opened(batch):
        yield b.hashes[1:], b.counts[1:]


def _pair_keys(word_sketch, least: int):
    def run(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for b in _opened(batch):
            yield b.pairs(b.frequent(word_sketch.value, least))[:2]

    return run


def _suffixes(word_sketch, pair_sketch, least: int):
    """Distinct suffixes of each block and their counts; a suffix ends before what is surely rare."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (b for batch in batches for b in _opened(batch)):
            frequent = b.frequent(word_sketch.value, least)
            keys, _, at = b.pairs(frequent)
            good = np.append(estimate(pair_sketch.value, keys) >= least, False)[at]
            n, key = len(b.places), np.zeros((LONGEST, len(b.places)), np.int32)
            on = frequent.copy()
            for d in range(min(LONGEST, n)):
                key[d, : n - d] = np.where(on[: n - d], b.places[d:], 0)
                on = on & np.append(good[d:], np.zeros(d, bool))
            key = key[:, frequent]
            order = np.lexsort(key[::-1])
            key = key[:, order]
            first = np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0))) if key.shape[1] else np.zeros(0, int)
            counts = np.diff(np.append(first, key.shape[1]))
            text = pa.array([b"", *b.blob.split(b" ")] if b.blob else [b""], pa.binary())
            spaced = pc.binary_join_element_wise(text, pa.scalar(b" ", pa.binary()), pa.scalar(b"", pa.binary()))
            spaced = pa.concat_arrays([pa.array([b""], pa.binary()), spaced.slice(1)])
            for low in range(0, len(first), 100_000):
                part = key[:, first[low : low + 100_000]]
                joined = pc.binary_join_element_wise(*[spaced.take(pa.array(p)) for p in part], pa.scalar(b"", pa.binary()))
                yield pa.record_batch(
                    {
                        "lang": pa.array([b.lang] * part.shape[1]),
                        "suffix": joined.cast(pa.string()),
                        "n": pa.array(counts[low : low + 100_000]),
                    }
                )

    return run


def multikey_quicksort(key: np.ndarray, weight: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """Equal parts of the columns of ``key`` (depth x suffixes, 0 past a suffix's end): (depth, any member, weight).

    Three-way partitioning of pointers, one word at a time. A part lighter than ``least`` is abandoned. Parts wait on a list, so no depth
    of recursion grows with the input.
    """
    waiting = [(np.arange(key.shape[1]), 0)]
    while waiting:
        at, depth = waiting.pop()
        own = key[depth, at]
        if own.max() == own.min():
            if own[0] == 0:
                continue
            total = int(weight[at].sum())
            if total >= least:
                yield depth, int(at[0]), total
                if depth + 1 < len(key):
                    waiting.append((at, depth + 1))
            continue
        a, b, c = own[0], own[len(own) // 2], own[-1]
        pivot = max(min(a, b), min(max(a, b), c))
        for part, here in ((at[own < pivot], depth), (at[own > pivot], depth), (at[own == pivot], depth)):
            if len(part) and (len(part) >= least or weight[part].sum() >= least):
                waiting.append((part, here))


def _counted(least: int):
    """Counts of the phrases of a range; those that its first or last suffix begins with are kept whatever their count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts).combine_chunks()
        n, weight = table.num_rows, table.column("n").to_numpy()
        lists = pc.split_pattern(table.column("suffix").combine_chunks(), " ")
        if isinstance(lists, pa.ChunkedArray):
            lists = lists.combine_chunks()
        sizes = pc.list_value_length(lists).to_numpy() - 1  # what follows the last space is empty
        flat = lists.flatten().dictionary_encode()
        numbers, text = flat.indices.to_numpy().astype(np.int64) + 1, flat.dictionary
        key = np.zeros((LONGEST + 1, n), np.int64)
        langs = table.column("lang").combine_chunks().dictionary_encode()
        langs = langs.combine_chunks() if isinstance(langs, pa.ChunkedArray) else langs
        key[0] = langs.indices.to_numpy() + 1
        start = np.cumsum(sizes + 1) - sizes - 1
        for d in range(LONGEST):
            has = sizes > d
            key[d + 1, has] = numbers[start[has] + d]
        found = {}
        for depth, i, total in multikey_quicksort(key, weight, least):
            if depth:
                found[depth, tuple(key[: depth + 1, i])] = i, total
        for i in (0, n - 1):  # the range is sorted
            same = np.ones(n, bool)
            for depth in range(LONGEST + 1):
                if key[depth, i] == 0:
                    break
                same &= key[depth] == key[depth, i]
                if depth:
                    found[depth, tuple(key[: depth + 1, i])] = i, int(weight[same].sum())
        picked = np.array([i for i, _ in found.values()], np.int64)
        depth = np.array([d for d, _ in found])
        spelt = [text.take(pa.array(np.maximum(key[d + 1, picked] - 1, 0))).to_pylist() for d in range(LONGEST)]
        yield pa.record_batch(
            {
                "lang": langs.dictionary.take(pa.array(key[0, picked] - 1)),
                "phrase": pa.array([" ".join(w[:d]) for d, *w in zip(depth, *spelt, strict=True)], pa.string()),
                "size": pa.array(depth),
                "f": pa.array([t for _, t in found.values()], pa.int64()),
            }
        )

    return run


def frequent_phrases(documents: DataFrame, least: int = LEAST, store: Store | None = None) -> tuple[DataFrame, DataFrame]:
    """Phrases of up to ``LONGEST`` words that occur ``least`` times, and the words of each language.

    (lang, phrase, size, f), and (lang, n). See ``collocations`` for words, pieces and odd rows.
    """
    spark = documents.sparkSession
    store = store or Store(spark, "phrases")
    texts = documents.where("text is not null and text <> ''").select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text")
    )
    blocks = store.keep(texts.mapInArrow(_blocks, "lang string, words binary, places binary, n_words long"))
    totals = blocks.groupBy("lang").agg(F.sum("n_words").alias("n")).where("n > 0")
    size = blocks.agg(F.sum("n_words").alias("n")).first()["n"] or 0
    share, bits = spark.sparkContext.broadcast, bits_for(size, 1, SKETCH_BITS)
    word_sketch = share(count_sketch(blocks, _word_keys, bits, least))
    pair_sketch = share(count_sketch(blocks, _pair_keys(word_sketch, least), bits, least))
    # Not written: the blocks are, and making suffixes of them twice (once for the cuts of the ranges) costs less than the disk.
    suffixes = blocks.mapInArrow(_suffixes(word_sketch, pair_sketch, least), "lang string, suffix string, n long")
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // RANGE + 1)
    routed = suffixes.repartitionByRange(ranges, "lang", "suffix").sortWithinPartitions("lang", "suffix")
    counted = routed.mapInArrow(_counted(least), "lang string, phrase string, size long, f long")
    phrases = counted.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    return store.keep(phrases), totals


def _wide(column) -> F.Column:
    return F.col(column).cast("decimal(38,0)") if isinstance(column, str) else column.cast("decimal(38,0)")


def collocations(
    documents: DataFrame, least: int = LEAST, top: int = TOP, covered: int = COVERED, store: Store | None = None
) -> DataFrame:
    """The strongest phrases of two to four words of each language: (lang, rank, phrase, a, l, r, n, score).

    A-Z are taken as a-z. Texts fall into pieces at ``.,;:!?`` and line ends, pieces into words at spaces and tabs; phrases are
    consecutive words of a piece, all occurrences counted. n is the number of the language's words. A phrase that occurs a times, ``least`` or
    more, is cut in two in every way; l and r are the counts of its parts, and a cut scores 2000000 * a / (l + r), rounded down.
    The lowest cut counts, of equal ones the first. A phrase in a longer one that occurs at least ``covered`` percent as often goes, whether
    or not the longer one stays. The first ``top`` by score, then count, then spelling are returned.

    A null language is ``und``. Null and empty texts, and texts without words, add nothing. Repeated rows count each. Other columns don't
    matter, whatever their names; an empty table gives an empty result.
    """
    store = store or Store(documents.sparkSession, "phrases")
    phrases, totals = frequent_phrases(documents, least, store)
    candidates = phrases.where("size > 1")
    spelt = F.split("phrase", " ")
    cut = candidates.select(
        "lang", "phrase", F.col("f").alias("a"), "size", F.explode(F.sequence(F.lit(1), F.col("size").cast("int") - 1)).alias("k")
    ).withColumns(
        {
            "first": F.array_join(F.slice(spelt, F.lit(1), F.col("k")), " "),
            "rest": F.array_join(F.slice(spelt, F.col("k") + 1, F.lit(LONGEST)), " "),
        }
    )
    counts = phrases.select("lang", F.col("phrase").alias("part"), "f").hint("rebalance")
    cut = cut.join(counts.select("lang", F.col("part").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cut = cut.join(counts.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    score = F.expr(f"(cast(a as decimal(28,0)) * {SCALE}) div (cast(l as decimal(28,0)) + cast(r as decimal(28,0)))")
    scored = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("least"))
    # Phrases inside longer ones.
    inner = F.expr(
        "flatten(transform(sequence(2, cast(size as int) - 1), m -> transform(sequence(1, cast(size as int) - m + 1),"
        " s -> array_join(slice(split(phrase, ' '), s, m), ' '))))"
    )
    longer = (
        candidates.where("size > 2")
        .select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), "f")
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("most"))
    )
    kept = scored.join(longer.hint("rebalance"), ["lang", "phrase"], "left").where(
        F.col("most").isNull() | (100 * _wide("most") < covered * _wide("a"))
    )
    rows = kept.select("lang", "phrase", "a", "least.l", "least.r", "least.score")
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SHARES))).orderBy(*best)
    few = rows.withColumn("place", F.row_number().over(share)).where(F.col("place") <= top)  # SHARES * top a language
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long"))
    return join_lookup(ranked.where(F.col("rank") <= top), totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")
    )


#: The same with the default limits.
SQL = f"""
with texts as (
  select coalesce(lang, 'und') as lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
  from documents
), pieces as (
  select lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) as piece from texts
), worded as (
  select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from pieces
), totals as (
  select lang, cast(sum(len(w)) as bigint) as n from worded group by lang having sum(len(w)) > 0
), grams as (
  select lang, size, array_to_string(w[i:i + size - 1], ' ') as phrase
  from (select lang, w, size, unnest(range(1, len(w) - size + 2)) as i
        from worded, (values (1), (2), (3), (4)) s(size) where len(w) >= size)
), phrases as (
  select lang, phrase, size, count(*) as f from grams group by all having count(*) >= {LEAST}
), cuts as (
  select lang, phrase, f as a, size, string_split(phrase, ' ') as w, unnest(range(1, size)) as k
  from phrases where size > 1
), scored as (
  select c.lang, c.phrase, c.a, c.k, x.f as l, y.f as r,
         (c.a::hugeint * {SCALE}) // (x.f + y.f) as score
  from cuts c join phrases x on x.lang = c.lang and x.phrase = array_to_string(c.w[1:c.k], ' ')
  join phrases y on y.lang = c.lang and y.phrase = array_to_string(c.w[c.k + 1:], ' ')
), lowest as (
  select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1
), longer as (
  select lang, phrase, max(f) as most
  from (select lang, f, array_to_string(w[s:s + m - 1], ' ') as phrase
        from (select lang, f, string_split(phrase, ' ') as w, size, m, unnest(range(1, size - m + 2)) as s
              from phrases, (values (2), (3)) t(m) where size > m))
  group by all
), ranked as (
  select o.*, row_number() over (partition by o.lang order by o.score desc, o.a desc, o.phrase) as rank
  from lowest o left join longer g using (lang, phrase) where g.most is null or 100 * g.most < {COVERED} * o.a
)
select lang, rank, phrase, a, l, r, n, cast(score as bigint) as score from ranked join totals using (lang) where rank <= {TOP}
"""
