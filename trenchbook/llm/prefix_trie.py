"""The trie of all conversations: every distinct beginning of a conversation is a node.

A turn is told by 128 bits of its role and text; a beginning by the exclusive or of its turns' bits, each mixed with its place,
so texts are never moved. Running values within a conversation are made over ranges of (conversation, place), so that a
conversation with a large share of all turns is dealt over many tasks; what a range begins with is added from one
row per range.

A count-min sketch of all beginnings screens them: an estimate of one proves that no other conversation shares the
beginning, nor any longer one, and such a tail becomes nodes where it stands. Only possibly shared beginnings are
shuffled, and grouped exactly. The sketch has a bounded size (``SKETCH_BITS``): where there are far more beginnings than cells, more
are grouped than need be, and the result is the same.

Sums over subtrees need no walk through the trie. A node belongs to its smallest conversation, which then
owns all its longer beginnings too. So each leaf counts once for every beginning of the conversation that owns it,
and a conversation saves, from a node on, the words between it and the first beginning it owns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trenchbook.functions.joins import join_lookup
from trenchbook.llm.bytework import mix
from trenchbook.llm.sketch import bits_for, count_sketch, estimate
from trenchbook.llm.store import Store

#: At most 3 * 2**24 one-byte cells are broadcast.
SKETCH_BITS, SKETCH_HASHES = 24, 3
#: Conversations whose numbers are hashed as one text; more of a node are hashed one such text after the other.
IDS = 4096
_PLACES = np.random.default_rng(5).integers(0, 2**63, 2, dtype=np.uint64)
NO_WORD = r"[\x20\x09-\x0D]"


def turn_rows(turns: DataFrame) -> DataFrame:
    """Turns without their texts: (conv_id, turn, digest, words); a null role or text is empty."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(told)).alias("digest"),
        F.regexp_count(text, F.lit(NO_WORD.replace("[", "[^") + "+")).cast("long").alias("words"),
    )


def _longs(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return np.asarray(batch.column(name).to_numpy(zero_copy_only=False)).astype(np.int64)


def _halves(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("digest").to_pylist()), np.uint64).reshape(-1, 2)


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First row of each run of equal keys, and the runs' lengths."""
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return first, np.diff(np.append(first, len(keys)))


def _step(a: np.ndarray, b: np.ndarray, sums: int) -> np.ndarray:
    """The first ``sums`` columns added, the others by exclusive or."""
    return np.concatenate([a[..., :sums] + b[..., :sums], a[..., sums:] ^ b[..., sums:]], axis=-1)


def _running(values_of, names: tuple[str, ...], sums: int):
    """Adds running values of each conversation within a range, whether it goes on there, and the range's first and last row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last_key, carry, begun = None, None, None, False

        def told(batch, values, more, is_first, is_last):
            edge = np.zeros(len(more), np.int32)
            edge[0] += is_first
            edge[-1] += 2 * is_last
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            columns |= {n: pa.array(values[:, j].view(np.int64)) for j, n in enumerate(names)}
            return pa.record_batch(columns | {"more": pa.array(more), "edge": pa.array(edge)})

        for batch in batches:
            if not batch.num_rows:
                continue
            keys, own = _longs(batch, "conv_id"), values_of(batch)
            total = np.concatenate(
                [np.add.accumulate(own[:, :sums]), np.bitwise_xor.accumulate(own[:, sums:])], axis=1
            )
            first, lengths = _runs(keys)
            before = np.repeat(total[first] - own[first], lengths, axis=0)
            before[:, sums:] = np.repeat(total[first, sums:] ^ own[first, sums:], lengths, axis=0)
            before[:, :sums] = -before[:, :sums]
            values = _step(total, before, sums)
            if keys[0] == last_key:
                values[: lengths[0]] = _step(values[: lengths[0]], carry, sums)
            if held:
                held[2][-1] = last_key == keys[0]
                yield told(*held, not begun, False)
                begun = True
            last_key, carry = keys[-1], values[-1].copy()
            held = batch, values, np.append(keys[1:] == keys[:-1], False)
        if held:
            yield told(*held, not begun, True)

    return run


def _carried(names: tuple[str, ...], sums: int):
    """One row per range, in order: what its first conversation has had before, and whether its last one goes on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        key, total = None, [0] * len(names)
        for row in (r for batch in batches for r in batch.to_pylist()):  # two rows a range at most
            if row["edge"] & 1:
                if rows:
                    rows[-1]["goes_on"] = row["conv_id"] == key
                rows.append({"part": row["part"], "begun": key, "goes_on": False} | {f"{n}_0": t for n, t in zip(names, total, strict=True)})
            if row["edge"] & 2:
                own = [row[n] for n in names]
                if row["conv_id"] == key:
                    own = [a + b if i < sums else a ^ b for i, (a, b) in enumerate(zip(total, own, strict=True))]
                key, total = row["conv_id"], own
        if rows:
            kinds = {"part": pa.int32(), "goes_on": pa.bool_()}
            yield pa.record_batch({c: pa.array([r[c] for r in rows], kinds.get(c, pa.int64())) for c in rows[0]})

    return run


def _over_ranges(rows: DataFrame, order: list[str], values_of, names: tuple[str, ...], sums: int, store: Store) -> DataFrame:
    """Rows with running values of their conversation in the given order, right across ranges, and ``more``: whether it goes on.

    The first ``sums`` values are added, the others gathered by exclusive or.
    """
    keys = ["conv_id", *order]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id())
    added = "".join(f", {n} long" for n in names)
    schema = ", ".join(f"{c} {t}" for c, t in ranged.dtypes) + added + ", more boolean, edge int"
    local = store.keep(ranged.mapInArrow(_running(values_of, names, sums), schema))
    edges = local.where("edge > 0").select("part", "edge", "conv_id", *names)
    told = "part int, begun long, goes_on boolean" + "".join(f", {n}_0 long" for n in names)
    begun = store.keep(edges.repartition(1).sortWithinPartitions("part", "edge").mapInArrow(_carried(names, sums), told))
    same = F.col("conv_id") == F.col("begun")
    total = {n: F.col(n) + F.col(f"{n}_0") if i < sums else F.col(n).bitwiseXOR(F.col(f"{n}_0")) for i, n in enumerate(names)}
    # a row for each range, and as many ranges as spark.sql.shuffle.partitions says
    return local.join(F.broadcast(begun), "part").select(
        *rows.columns,
        *[F.when(same, v).otherwise(F.col(n)).alias(n) for n, v in total.items()],
        (F.col("more") | ((F.col("edge") >= 2) & F.col("goes_on"))).alias("more"),
    )


def placed(rows: DataFrame, store: Store) -> DataFrame:
    """Turns with their place in the conversation, from 1: by turn, null first, equal turns by what they say."""
    ones = lambda batch: np.ones((batch.num_rows, 1), np.uint64)
    found = _over_ranges(rows, ["turn", "digest"], ones, ("pos",), 1, store)
    return store.keep(found.select("conv_id", "pos", "digest", "words"))


def borrow_heads(turns: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of another one: placed turns, and the conversations.

    With h = crc32 of the conversation's number as text, modulo ``most``, a conversation c has the first h turns of
    c - c % ``every`` (fewer if it has fewer, none if it isn't there), then its own after its first h. The remainder has the sign
    of c, as in SQL. A conversation may end up without turns, so the conversations are returned as well: (conv_id).
    """
    base = F.col("conv_id") - F.col("conv_id") % every
    h = F.crc32(F.col("conv_id").cast("string")) % most
    counted = turns.groupBy("conv_id").agg(F.max("pos").alias("n")).withColumn("base", base).withColumn("h", h)
    heads = turns.where((F.col("pos") < most) & (F.col("conv_id") % every == 0))
    heads = heads.select(F.col("conv_id").alias("base"), "pos", "digest", "words")
    lent = counted.where("h > 0").join(heads, "base").where("pos <= h").select("conv_id", "pos", "digest", "words")
    lenders = counted.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    shift = counted.join(lenders, "base", "left").select(
        "conv_id", "h", (F.least("h", F.coalesce("base_n", F.lit(0))) - F.col("h")).alias("shift")
    )
    own = join_lookup(turns, shift, "conv_id").where("pos > h")
    moved = own.select("conv_id", (F.col("pos") + F.col("shift")).alias("pos"), "digest", "words")
    return lent.unionByName(moved), counted.select("conv_id")


def _turn_values(batch: pa.RecordBatch) -> np.ndarray:
    return np.concatenate([_longs(batch, "words").astype(np.uint64)[:, None], _turn_bits(batch)], axis=1)


def _turn_bits(batch: pa.RecordBatch) -> np.ndarray:
    place = _longs(batch, "pos").astype(np.uint64)[:, None]
    halves = _halves(batch)
    return mix(mix(halves ^ _PLACES) + mix(place ^ _PLACES[::-1]) + halves[:, ::-1])


def _beginnings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the bits of the beginning before each turn."""
    for batch in batches:
        if batch.num_rows:
            now = np.stack([_longs(batch, c).view(np.uint64) for c in ("qa", "qb")], axis=1)
            before = (now ^ _turn_bits(batch)).view(np.int64)
            kept = {c: batch.column(c) for c in ("conv_id", "pos", "words", "total", "qa", "qb", "more")}
            yield pa.record_batch(kept | {"pa": pa.array(before[:, 0]), "pb": pa.array(before[:, 1])})


def _key(batch: pa.RecordBatch, a: str, b: str) -> np.ndarray:
    return mix(_longs(batch, a).view(np.uint64)) ^ _longs(batch, b).view(np.uint64)


def _keys(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    yield _key(batch, "qa", "qb"), np.ones(batch.num_rows)


def _screened(rows: DataFrame, sketch: np.ndarray) -> DataFrame:
    """Rows with ``alone``, whether the beginning is proven to be one conversation's only, and ``parent_alone``."""
    shared = rows.sparkSession.sparkContext.broadcast(sketch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alone = estimate(shared.value, _key(batch, "qa", "qb")) == 1
            parent = (estimate(shared.value, _key(batch, "pa", "pb")) == 1) & (_longs(batch, "pos") > 1)
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            yield pa.record_batch(columns | {"alone": pa.array(alone), "parent_alone": pa.array(parent)})

    schema = ", ".join(f"{c} {t}" for c, t in rows.dtypes) + ", alone boolean, parent_alone boolean"
    return rows.mapInArrow(run, schema)


def _ends_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of each node's texts of conversation numbers, which come in order; nothing is gathered."""
    now, state = None, None
    for batch in batches:
        out = []
        for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("qa", "qb", "ids")), strict=True):
            if (a, b) == now:
                state.update(b"," + ids.encode())
            else:
                if now:
                    out.append((*now, state.hexdigest()))
                now, state = (a, b), hashlib.sha256(ids.encode())
        yield _hashed(out)
    if now:
        yield _hashed([(*now, state.hexdigest())])


def _hashed(rows: list[tuple]) -> pa.RecordBatch:
    a, b, text = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.record_batch({"qa": pa.array(a, pa.int64()), "qb": pa.array(b, pa.int64()), "ends_sha256": pa.array(text, pa.string())})


def _ends(ends: DataFrame) -> DataFrame:
    """(qa, qb, ends_sha256) of nodes where conversations (qa, qb, conv_id) end; numbers ascending, comma-joined."""
    own = F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string"))
    texts = (
        ends.withColumn("piece", F.expr(f"conv_id div {IDS}"))
        .groupBy("qa", "qb", "piece")  # IDS numbers and texts at most
        .agg(F.array_join(own, ",").alias("ids"))
    )
    ordered = texts.repartition("qa", "qb").sortWithinPartitions("qa", "qb", "piece")
    return ordered.mapInArrow(_ends_text, "qa long, qb long, ends_sha256 string")


def trie_of(turns: DataFrame, conversations: DataFrame, store: Store, bits: int | None = None) -> DataFrame:
    """Nodes of placed turns (conv_id, pos from 1 without gaps, digest, words); see ``prefix_trie``."""
    along = _over_ranges(turns, ["pos"], _turn_values, ("total", "qa", "qb"), 1, store)
    told = "conv_id long, pos long, words long, total long, qa long, qb long, more boolean, pa long, pb long"
    rows = store.keep(along.mapInArrow(_beginnings, told).withColumn("before", F.col("total") - F.col("words")))
    wide = bits or bits_for(rows.count(), most=SKETCH_BITS)
    rows = store.keep(_screened(rows, count_sketch(rows, _keys, wide, 2, SKETCH_HASHES)))
    alone, open_rows = rows.where("alone"), rows.where("not alone")
    digest, parent = ["qa", "qb"], [F.col("qa").alias("pa"), F.col("qb").alias("pb")]

    # Exact grouping of what may be shared; the root is a node of its own.
    grouped = open_rows.groupBy(*digest).agg(
        F.min("conv_id").alias("owner"), F.count("*").alias("n_convs"), F.min("pos").alias("depth"),
        F.min("words").alias("words"), F.min("pa").alias("pa"), F.min("pb").alias("pb"),
    )
    zero = F.lit(0).cast("long")
    root = conversations.agg(F.min("conv_id").alias("owner"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(
        zero.alias("qa"), zero.alias("qb"), "owner", "n_convs", zero.alias("depth"), zero.alias("words"),
        F.lit(None).cast("long").alias("pa"), F.lit(None).cast("long").alias("pb"),
    )
    nodes = store.keep(grouped.unionByName(root))
    frontier = alone.where("not parent_alone")
    children = (
        nodes.where("depth > 0").select("pa", "pb")
        .unionByName(frontier.select("pa", "pb"))
        .groupBy("pa", "pb").agg(F.count("*").alias("n_children"))
        .select(F.col("pa").alias("qa"), F.col("pb").alias("qb"), "n_children")
    )
    nodes = store.keep(nodes.join(children, digest, "left").fillna(0, "n_children"))

    # Of each conversation: where it ends, the words before the first beginning it owns, and whether it owns a leaf.
    owned = join_lookup_on(rows.where("not alone"), nodes.select(*digest, "owner"), digest).where("conv_id = owner")
    first_owned = rows.where("alone").select("conv_id", "before").unionByName(owned.select("conv_id", "before"))
    first_owned = first_owned.groupBy("conv_id").agg(F.min("before").alias("not_owned"))
    ends = rows.where("not more").select(
        "conv_id", "alone", "qa", "qb", "total"
    )
    ends = conversations.join(ends, "conv_id", "left").join(first_owned, "conv_id", "left").select(
        "conv_id",
        F.coalesce("alone", F.lit(False)).alias("alone"),
        F.coalesce("qa", zero).alias("qa"),
        F.coalesce("qb", zero).alias("qb"),
        F.coalesce("not_owned", "total", zero).alias("not_owned"),
    )
    ends = store.keep(ends)
    leaf = F.coalesce((F.col("n_children") == 0) & (F.col("owner") == F.col("conv_id")), F.lit(False))
    shared_ends = join_lookup_on(ends.where("not alone"), nodes.select(*digest, "owner", "n_children"), digest)
    known = store.keep(
        ends.where("alone").select("conv_id", "not_owned", F.lit(1).alias("leaf"))
        .unionByName(shared_ends.select("conv_id", "not_owned", leaf.cast("int").alias("leaf")))
    )
    parts = (
        join_lookup(rows.where("not alone").select("conv_id", *digest, "before"), known, "conv_id")
        .select(*digest, "before", "not_owned", "leaf")
        .unionByName(known.select(zero.alias("qa"), zero.alias("qb"), zero.alias("before"), "not_owned", "leaf"))
    )
    sums = parts.groupBy(*digest).agg(
        F.sum("leaf").alias("n_leaves"),
        F.sum(F.greatest(F.col("not_owned") - F.col("before"), zero)).alias("saved_tokens"),
    )
    none = F.sha2(F.lit(""), 256)
    top = F.lit(nodes.where("depth = 0").agg(F.min("owner")).first()[0]).cast("long")  # one number
    # A beginning whose cells are shared by chance may follow one proven to be its conversation's only: that one is no node of
    # ``nodes``, and belongs to the same conversation.
    parents = nodes.where("depth > 0").select(*parent, F.col("owner").alias("parent_conv_id"))
    shared_nodes = (
        nodes.join(sums, digest)
        .join(_ends(ends.where("not alone").select(*digest, "conv_id")), digest, "left")
        .join(parents.hint("rebalance"), ["pa", "pb"], "left")
        .select(
            F.col("owner").alias("conv_id"), "depth",
            F.when(F.col("depth") == 1, top).when(F.col("depth") > 1, F.coalesce("parent_conv_id", "owner")).alias("parent_conv_id"),
            "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256"),
        )
    )
    # A tail hangs on its own conversation, on the root, or on a shared node.
    own_parent = F.when(F.col("parent_alone"), F.col("conv_id")).otherwise(top)
    tails = alone.where("parent_alone or pos = 1").withColumn("parent_conv_id", own_parent)
    tails = tails.unionByName(join_lookup_on(frontier.where("pos > 1"), parents, ["pa", "pb"]))
    own = F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)
    one = F.lit(1).cast("long")
    single_nodes = tails.select(
        "conv_id", F.col("pos").alias("depth"), "parent_conv_id", one.alias("n_convs"),
        F.col("more").cast("long").alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens"),
        F.when(F.col("more"), none).otherwise(own).alias("ends_sha256"),
    )
    return shared_nodes.unionByName(single_nodes)


def join_lookup_on(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Join to a table with one row per key, which runtime can split where a key is hot."""
    return rows.join(table.hint("rebalance"), keys)


def prefix_trie(turns: DataFrame, store: Store | None = None, bits: int | None = None) -> DataFrame:
    """Nodes of the trie of conversations (conv_id, turn, role, text), the root without text included.

    A node is a distinct sequence of first turns. Columns: conv_id, its smallest member; depth; parent_conv_id, the parent's
    conv_id (null at the root); n_convs, the conversations that begin so; n_children; n_leaves, the nodes without children
    from here on; saved_tokens, the words (runs of bytes other than white space) that need not be stored again from here on;
    ends_sha256, the hash of the numbers of the conversations that end here, in order and comma-joined.

    A null role or text is empty, and an empty text is a turn. Turns come by number, null first; turns with the same number by a
    hash of what they say, and repeated rows are turns of their own. Rows without conv_id belong to no conversation and don't count. Other
    columns don't matter, whatever their names. An empty table has no nodes, not even a root.
    """
    store = store or Store(turns.sparkSession, "trie")
    rows = placed(turn_rows(turns), store)
    return trie_of(rows, rows.select("conv_id").distinct(), store, bits)
