"""The conversation trie against one built turn by turn in plain Python."""

import hashlib
import os
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from trenchbook.llm import prefix_trie as trie
from trenchbook.llm.queries import QUERIES
from trenchbook.llm.store import Store

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_trie(talks: dict[int, list[tuple[str, str]]]) -> list[tuple]:
    """Nodes of conversations: every beginning a dictionary entry, subtrees by trying all nodes."""
    members = defaultdict(list)
    for c in sorted(talks):
        for d in range(len(talks[c]) + 1):
            members[tuple(talks[c][:d])].append(c)
    words = {n: len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0 for n in members}
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for n in members:
        if n:
            children[n[:-1]] += 1
    for n in members:
        for d in range(len(n) + 1):
            leaves[n[:d]] += not children[n]
            saved[n[:d]] += (len(members[n]) - 1) * words[n]
    out = []
    for n, own in members.items():
        ends = ",".join(str(c) for c in own if len(talks[c]) == len(n))
        parent = members[n[:-1]][0] if n else None
        out.append((own[0], len(n), parent, len(own), children[n], leaves[n], saved[n], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def told(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows.select(*COLUMNS).collect()), key=str)


def in_order(rows) -> dict[int, list[tuple[str, str]]]:
    talks = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            talks[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(own)] for c, own in talks.items()}


@pytest.fixture
def turns(spark):
    def make(*rows):
        return spark.createDataFrame(list(rows), "conv_id long, turn long, role string, text string")

    return make


def borrowed(talks: dict) -> dict:
    out = {}
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = talks.get(c - c % 20, [])[:h] + own[h:]
    return out


@pytest.mark.parametrize("sf_dir", [SF_DIR, "/root/testdata/sf0.01"])
def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert told(QUERIES["op11_prefix_trie"](spark, sf_dir)) == plain_trie(borrowed(in_order(rows)))


ROWS = [
    *[(c, t, "user" if t % 2 else "assistant", f"turn {t}") for c in range(1, 9) for t in range(c % 5 + 1)],
    *[(c, t, "user", f"other {t} {c // 2}") for c in range(20, 26) for t in range(3)],
    (30, None, "user", "first"), (30, 0, None, "second"), (30, 1, "user", None), (30, 1, "user", None),
    (31, 0, "user", "first"), (31, 5, "", "second"), (32, 0, "us", "erfirst"), (33, 1, "a", "x y\tz w \n"),
    (None, 0, "user", "nobody's"),
    *[(40, t, "user", "again") for t in range(300)], *[(41, t, "user", "again") for t in range(290)],
]


@pytest.mark.parametrize("bits", [None, 16])
def test_odd_rows(spark, turns, bits):
    rows = turns(*ROWS).selectExpr("*", "'x' AS pos", "1 AS qa", "2 AS part", "3 AS words", "4 AS alone")
    assert told(trie.prefix_trie(rows, bits=bits)) == plain_trie(in_order(ROWS))


@pytest.mark.parametrize("parts", ["1", "7", "40"])
def test_same_in_any_number_of_ranges(spark, turns, parts, monkeypatch):
    monkeypatch.setattr(trie, "IDS", 4)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert told(trie.prefix_trie(turns(*ROWS))) == plain_trie(in_order(ROWS))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_a_full_sketch_changes_nothing_but_the_work(spark, turns, monkeypatch):
    monkeypatch.setattr(trie, "estimate", lambda sketch, keys: (keys * 0 + 2).astype(int))
    assert told(trie.prefix_trie(turns(*ROWS))) == plain_trie(in_order(ROWS))


def test_cells_shared_by_chance_change_nothing(spark, turns, monkeypatch):
    """A beginning may look shared although the one before it is proven to be one conversation's only."""
    bound = trie.estimate
    monkeypatch.setattr(trie, "estimate", lambda sketch, keys: np.maximum(bound(sketch, keys), 1 + (keys & np.uint64(1)).astype(int)))
    rows = [*ROWS, *[(c, t, "user", f"own {c} {t}") for c in range(50, 70) for t in range(9)]]
    assert told(trie.prefix_trie(turns(*rows))) == plain_trie(in_order(rows))


def test_no_conversations_no_nodes(turns):
    assert trie.prefix_trie(turns()).count() == 0
    assert trie.prefix_trie(turns((None, 1, "user", "x"))).count() == 0


def test_a_conversation_may_lose_all_its_turns(spark, turns):
    rows = [(c, 0, "user", f"only {c}") for c in range(1, 20)]  # none is a multiple of 20
    store = Store(spark, "trie-test")
    found = trie.trie_of(*trie.borrow_heads(trie.placed(trie.turn_rows(turns(*rows)), store)), store)
    assert told(found) == plain_trie(borrowed(in_order(rows)))
