"""Similarity groups by an exact join on n-gram sets, with a token-group matrix.

Documents that are similar are put into groups; the matrix says which tokens (shingles) the sets of a group have between
them. A document can only be linked to a member of a group if enough of its own tokens are in the group's union, so a group is
opened only if that overlap allows a link. No link between different texts is lost.

* Documents with equal sets are one class; its smallest document stands for it.
* Each document is compared with the smallest one that shares one of ``MINS`` smallest hashes with it. These links put copies into
  components, however many there are, with a row for each document. A component is dealt to groups of about ``GROUP`` documents.
* A pair of at least the threshold is found from its smaller set, of which 2t/(1+t) must be in the other: the pair shares
  a token among the few that each set keeps when its commonest tokens are left out. Only these are in the matrix that is joined. What is
  common is told by a sketch of bounded size (``SKETCH_BITS``), which only sets the order: the result is the same in any.
* Tokens of a document's own component lead nowhere, as the matrix is joined by component first, and within a large
  component by group.
* For the groups found, the overlap with the whole union is counted; those that qualify are opened and their members confirmed on whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trenchbook.functions.joins import join_lookup
from trenchbook.llm.bytework import gaps_but, mix, shingles, slices, text_bytes, words
from trenchbook.llm.components import components
from trenchbook.llm.sketch import bits_for, count_sketch, estimate
from trenchbook.llm.store import Store

MINS, GROUP = 4, 64
CHUNK = 1 << 19
#: At most 2**22 cells of four bytes are broadcast.
SKETCH_BITS = 22
GAPS = gaps_but(r"[^\x20\x09-\x0D]")
_rng = np.random.default_rng(13)
_FLIP = _rng.integers(0, 2**63, MINS + 1, dtype=np.uint64)
_SPIN = _rng.integers(0, 2**63, MINS + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def token_sets(column, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct shingles (sorted hashes) of a run of texts at a time, and their offsets."""
    data, offsets = text_bytes(column)
    for i, j in slices(offsets, CHUNK):
        own = offsets[i : j + 1] - offsets[i]
        _, _, text, hashes = words(data[offsets[i] : offsets[j]], own, GAPS)
        yield shingles(hashes, text, j - i, width)


def _tokens_of(width: int):
    def run(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for tokens, _ in token_sets(batch.column("text"), width):
            yield tokens, np.ones(len(tokens))

    return run


def _least_overlap(n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of a set of n that a link needs in a set as large or larger, and in any set."""
    return -(-2 * percent * n // (100 + percent)), -(-percent * n // 100)


def _described(width: int, percent: int, sketch):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = 0
            for tokens, offsets in token_sets(batch.column("text"), width):
                n = np.diff(offsets)
                full, text = np.flatnonzero(n), np.repeat(np.arange(len(n)), n)
                keys, mins = np.zeros((2, len(n)), np.uint64), np.zeros((len(n), MINS), np.uint64)
                if len(full):
                    at = offsets[full]
                    keys[0, full] = np.add.reduceat(mix(tokens), at)
                    keys[1, full] = np.add.reduceat(mix(tokens ^ _FLIP[MINS]), at)
                    for r in range(MINS):
                        mins[full, r] = np.minimum.reduceat(mix((tokens ^ _FLIP[r]) * _SPIN[r]), at)
                # the least common tokens of each set, the same order everywhere
                ordered = tokens[np.lexsort((tokens, estimate(sketch.value, tokens), text))]
                _, some = _least_overlap(n, percent)
                kept = np.where(n > 0, n - some + 1, 0)
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_id").slice(low, len(n)),
                        "n": pa.array(n),
                        "set_a": pa.array(keys[0].view(np.int64)),
                        "set_b": pa.array(keys[1].view(np.int64)),
                        "mins": pa.array(list(mins.view(np.int64)), pa.list_(pa.int64())),
                        "rare": pa.array([ordered[o : o + k].tobytes() for o, k in zip(offsets, kept)], pa.binary()),
                    }
                )
                low += len(n)

    return run


def _whole_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = 0
            for tokens, offsets in token_sets(batch.column("text"), width):
                n = len(offsets) - 1
                blobs = [tokens[offsets[i] : offsets[i + 1]].tobytes() for i in range(n)]
                yield pa.record_batch({"doc_id": batch.column("doc_id").slice(low, n), "tokens": pa.array(blobs, pa.binary())})
                low += n

    return run


def _set(blob: pa.Scalar) -> np.ndarray:
    return np.frombuffer(blob.as_buffer(), np.uint64)


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    return int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum()) if len(x) else 0


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (a, b) in enumerate(zip(batch.column("set_a"), batch.column("set_b"), strict=True)):
                x, y = _set(a), _set(b)
                both = _common(x, y)
                keep[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def _qualifying(percent: int):
    """Rows (a, grp) whose document has enough tokens in the group's union for a link with a set as large as its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (a, b) in enumerate(zip(batch.column("tokens"), batch.column("union"), strict=True)):
                x = _set(a)
                keep[i] = (100 + percent) * _common(x, _set(b)) >= 2 * percent * len(x)
            yield batch.select(["a", "grp"]).filter(pa.array(keep))

    return run


def _union(table: pa.Table) -> pa.Table:
    """One row for each group, of at most about ``GROUP`` documents: the union of their tokens."""
    tokens = np.unique(np.concatenate([_set(b) for b in table.column("tokens")]))
    return pa.table({"grp": table.column("grp").slice(0, 1), "union": pa.array([tokens.tobytes()], pa.binary())})


def _matrix_rows(table: pa.Table) -> pa.Table:
    """A row for each token that a group keeps, with its first place in any member's order."""
    sets = [_set(b) for b in table.column("rare")]
    tokens = np.concatenate(sets)
    places = np.concatenate([np.arange(len(s)) for s in sets])
    order = np.lexsort((places, tokens))
    tokens, places = tokens[order], places[order]
    first = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
    same = pa.array(np.zeros(len(first), np.int64))
    return pa.table(
        {"token": pa.array(tokens[first].view(np.int64)), "place": pa.array(places[first])}
        | {c: table.column(c).take(same) for c in ("root", "grp")}
    )


def _id_keys(batch: pa.RecordBatch) -> np.ndarray:
    return mix(np.asarray(batch.column("doc_id").to_numpy()).view(np.uint64))


def _ids(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    yield _id_keys(batch), np.ones(batch.num_rows)


def _some_of(texts: DataFrame, sketch: np.ndarray) -> DataFrame:
    """Texts of the documents in a sketch, and perhaps some others."""
    shared = texts.sparkSession.sparkContext.broadcast(sketch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(estimate(shared.value, _id_keys(batch)) > 0))

    return texts.where("doc_id is not null").mapInArrow(run, "doc_id long, text string")


def _exploded(keep: list[str], percent: int | None = None):
    """A row for each token that a set keeps, with its place there; with ``percent``, only of those that a query asks for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (batch.slice(low, 1000) for batch in batches for low in range(0, batch.num_rows, 1000))
        for batch in parts:
            sets = [_set(b) for b in batch.column("rare")]
            if percent is not None:
                n = np.asarray(batch.column("n").to_numpy())
                asked = n - _least_overlap(n, percent)[0] + 1
                sets = [s[:k] for s, k in zip(sets, asked, strict=True)]
            row = pa.array(np.repeat(np.arange(len(sets)), [len(s) for s in sets]))
            out = {"token": pa.array(np.concatenate(sets).view(np.int64)), "place": pa.array(np.concatenate([np.arange(len(s)) for s in sets]))}
            yield pa.record_batch(out | {c: batch.column(c).take(row) for c in keep})

    return run


def with_rare(sets: DataFrame, percent: int) -> DataFrame:
    """Sets (doc_id, tokens) as (doc_id, n, rare): their sizes, and the least common tokens that ``links_apart`` joins."""
    size = sets.agg(F.sum(F.octet_length("tokens")).alias("n")).first()["n"] or 0

    def tokens(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for blob in batch.column("tokens"):
            yield _set(blob), np.ones(len(blob.as_buffer()) // 8)

    sketch = count_sketch(sets, tokens, bits_for(size // 64, 1, SKETCH_BITS), 2**31 - 1, hashes=1)
    shared = sets.sparkSession.sparkContext.broadcast(sketch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, rare = [], []
            for blob in batch.column("tokens"):
                own = _set(blob)
                kept = len(own) - int(_least_overlap(np.array(len(own)), percent)[1]) + 1 if len(own) else 0
                n.append(len(own))
                rare.append(own[np.lexsort((own, estimate(shared.value, own)))][:kept].tobytes())
            yield pa.record_batch(
                {"doc_id": batch.column("doc_id"), "n": pa.array(n, pa.int64()), "rare": pa.array(rare, pa.binary())}
            )

    return sets.mapInArrow(run, "doc_id long, n long, rare binary")


def _sized(small, large, percent: int):
    return 100 * F.least(small, large) >= percent * F.greatest(small, large)


def in_groups(stars: DataFrame) -> DataFrame:
    """Nodes of components (node, root) dealt to groups of about ``GROUP``: (doc_id, root, groups, grp), grp from 0."""
    sizes = stars.groupBy("root").agg(F.ceil(F.count("*") / GROUP).alias("groups"))
    return join_lookup(stars, sizes, "root").select(
        F.col("node").alias("doc_id"), "root", "groups", F.pmod(F.xxhash64("node"), F.col("groups")).alias("grp")
    )


def links_apart(placed: DataFrame, sets_of, confirmed, percent: int, store: Store) -> DataFrame:
    """All links (a, b) between documents of different components, by the token-group matrix.

    ``placed`` has (doc_id, n, rare, root, groups, grp), 0 groups for a document that is in no component. ``sets_of`` gives the whole
    sets (doc_id, tokens) of documents, ``confirmed`` those of some pairs that are links, given their sets.
    """
    # The matrix: tokens of components, and within components of several groups, of groups.
    single, several = placed.where("groups = 0"), placed.where("groups > 0")
    by_group = store.keep(
        several.select("root", "grp", "rare").groupBy("root", "grp")
        .applyInArrow(_matrix_rows, "token long, place long, root long, grp long")
    )
    low_high = F.min("n").alias("low"), F.max("n").alias("high")
    spans = several.groupBy("root").agg(*low_high)
    at_root = by_group.groupBy("token", "root").agg(F.min("place").alias("place")).join(spans.hint("rebalance"), "root")
    by_root = (
        single.select("rare", "root", "n")
        .mapInArrow(_exploded(["root", "n"]), "token long, place long, root long, n long")
        .select("token", "root", F.col("place").alias("at"), F.col("n").alias("low"), F.col("n").alias("high"))
        .unionByName(at_root.select("token", "root", F.col("place").alias("at"), "low", "high"))
    )
    queries = placed.select("doc_id", "n", "rare", F.col("root").alias("own")).mapInArrow(
        _exploded(["doc_id", "own", "n"], percent), "token long, place long, doc_id long, own long, n long"
    )
    # A pair is found from its smaller set, and by the first token it shares: what comes before that, on either side, isn't shared.
    whole = 100 + percent
    may_link = (
        (F.col("high") >= F.col("n"))
        & (percent * F.col("low") <= 100 * F.col("n"))
        & (whole * (F.col("n") - F.col("place")) >= percent * (F.col("n") + F.greatest("low", "n")))
        & (100 * F.col("high") >= percent * F.col("n") + whole * F.col("at"))
    )
    hits = queries.join(by_root, "token").where((F.col("own") != F.col("root")) & may_link)
    hits = store.keep(hits.select("token", "place", "doc_id", "n", "root").distinct())
    large = several.where("groups > 1").select("root").distinct()
    wide = by_group.join(large.hint("rebalance"), "root", "left_semi").select("token", "root", "grp", F.col("place").alias("at"))
    spans = placed.where("groups > 1").groupBy("root", "grp").agg(*low_high)
    wide = wide.join(spans.hint("rebalance"), ["root", "grp"])
    apart = hits.join(large.hint("rebalance"), "root", "left_anti").select("doc_id", "root", F.lit(0).cast("long").alias("grp"))
    within = hits.join(wide, ["token", "root"]).where(may_link).select("doc_id", "root", "grp")
    candidates = store.keep(
        apart.unionByName(within).distinct().select(F.col("doc_id").alias("a"), F.struct("root", "grp").alias("grp"))
    )
    wanted = candidates.select("grp").distinct()
    members = store.keep(
        placed.select("doc_id", "n", F.struct("root", "grp").alias("grp")).join(wanted.hint("rebalance"), "grp", "left_semi")
    )
    sets = sets_of(candidates.select(F.col("a").alias("doc_id")).unionByName(members.select("doc_id")))
    unions = store.keep(
        members.select("doc_id", "grp").distinct().join(sets, "doc_id").select("grp", "tokens")
        .groupBy("grp").applyInArrow(_union, "grp struct<root:long,grp:long>, union binary")
    )
    bounded = candidates.join(sets.select(F.col("doc_id").alias("a"), "tokens"), "a").join(unions, "grp")
    opened = store.keep(
        bounded.select("a", "grp", "tokens", "union").mapInArrow(_qualifying(percent), "a long, grp struct<root:long,grp:long>")
    )
    pairs = (
        opened.distinct()
        .join(members.select("grp", F.col("doc_id").alias("b"), F.col("n").alias("n_b")), "grp")
        .join(placed.select(F.col("doc_id").alias("a"), F.col("n").alias("n_a")), "a")
        .where(F.col("n_b") >= F.col("n_a"))
        .where(_sized(F.col("n_a"), F.col("n_b"), percent))
        .select("a", "b")
        .distinct()
    )
    return confirmed(pairs, sets)


def jaccard_components(
    documents: DataFrame, width: int = 5, percent: int = 80, store: Store | None = None, bits: int | None = None
) -> DataFrame:
    """Every row's document, the size of its shingle set, and its component: (doc_id, n_shingles, component_id).

    Words are runs of bytes other than white space, A-Z taken as a-z; a shingle is ``width`` of them. Two documents are linked when
    100 * intersection >= ``percent`` * union of their sets. component_id is the smallest doc_id reachable, itself included. Shingles
    are told apart by 64-bit hashes.

    A null or empty text, or one without words, has no shingles and is linked with nothing. A text with fewer words
    than ``width`` has one shingle. Rows that repeat a doc_id are one node, each with a row in the result, and linked by any of
    their texts. A row without doc_id isn't linked, and its component_id is null. Other columns don't matter and aren't
    returned; an empty table gives an empty result.
    """
    spark = documents.sparkSession
    store = store or Store(spark, "jaccard")
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    sketch = count_sketch(texts, _tokens_of(width), bits or bits_for(size // 64, 1, SKETCH_BITS), 2**31 - 1, hashes=1)
    described = store.keep(
        texts.mapInArrow(
            _described(width, percent, spark.sparkContext.broadcast(sketch)),
            "doc_id long, n long, set_a long, set_b long, mins array<long>, rare binary",
        )
    )
    real = described.where("doc_id is not null and n > 0").drop("rare")
    classes = real.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep"))
    in_class = real.join(classes.hint("rebalance"), ["set_a", "set_b"])
    member = store.keep(in_class.select("doc_id", "rep").distinct())
    # one row for each class; a document with several texts may stand for several
    reps = store.keep(
        in_class.where("doc_id = rep").dropDuplicates(["set_a", "set_b"]).select("doc_id", "n", "mins", "set_a", "set_b")
    )

    def sets_of(ids: DataFrame) -> DataFrame:
        """Whole sets of the documents asked for. A sketch of their numbers leaves most others out before texts are moved."""
        ids = store.keep(ids.distinct())
        sketch = count_sketch(ids, _ids, bits_for(ids.count()), 1)
        asked = _some_of(texts, sketch).join(ids.hint("rebalance"), "doc_id", "left_semi")
        return store.keep(asked.mapInArrow(_whole_sets(width), "doc_id long, tokens binary"))

    def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
        for side in "ab":
            pairs = pairs.join(sets.select(F.col("doc_id").alias(side), F.col("tokens").alias(f"set_{side}")), side)
        return store.keep(pairs.mapInArrow(_linked(percent), "a long, b long").distinct())

    # Each document with the smallest that shares a smallest hash.
    keys = reps.select("doc_id", "n", F.posexplode("mins").alias("which", "least"))
    leads = (
        keys.groupBy("which", "least")
        .agg(F.min(F.struct("doc_id", "n")).alias("lead"), F.max("doc_id").alias("last"))
        .where("lead.doc_id < last")
        .select("which", "least", "lead")
    )
    tried = store.keep(
        keys.join(leads.hint("rebalance"), ["which", "least"])
        .where((F.col("doc_id") > F.col("lead.doc_id")) & _sized(F.col("n"), F.col("lead.n"), percent))
        .select(F.col("lead.doc_id").alias("a"), F.col("doc_id").alias("b"))
        .distinct()
    )
    met = tried.select(F.col("a").alias("doc_id")).unionByName(tried.select(F.col("b").alias("doc_id")))
    links = confirmed(tried, sets_of(met))
    stars = store.keep(components(links, store))

    dealt = in_groups(stars)
    whose = reps.select("doc_id", "set_a", "set_b").join(dealt.hint("rebalance"), "doc_id", "left").select(
        "doc_id", "set_a", "set_b", F.coalesce("root", "doc_id").alias("root"),
        F.coalesce("groups", F.lit(0)).alias("groups"), F.coalesce("grp", F.lit(0)).alias("grp"),
    )
    kept = described.where("doc_id is not null").select("doc_id", "set_a", "set_b", "n", "rare")
    placed = store.keep(kept.join(whose.hint("rebalance"), ["doc_id", "set_a", "set_b"]).drop("set_a", "set_b"))
    more = links_apart(placed, sets_of, confirmed, percent, store)
    roots = components(links.unionByName(more).unionByName(_same_document(member)), store)
    found = (
        member.join(roots.select(F.col("node").alias("rep"), "root").hint("rebalance"), "rep", "left")
        .groupBy("doc_id")
        .agg(F.min(F.coalesce("root", "rep")).alias("root"))
    )
    return described.select("doc_id", F.col("n").alias("n_shingles")).join(found, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id")
    )


def _same_document(member: DataFrame) -> DataFrame:
    """Links between the classes that one document belongs to by several texts."""
    several = member.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("last")).where("a < last")
    return member.join(several.select("doc_id", "a").hint("rebalance"), "doc_id").select("a", F.col("rep").alias("b"))
