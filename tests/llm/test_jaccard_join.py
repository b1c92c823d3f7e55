"""The exact n-gram join against every pair compared in plain Python."""

import os
import random

import pytest

from tests.llm.conftest import ODD
from tests.llm.test_contracts import component_ids, shingle_sets
from trenchbook.llm import jaccard_join
from trenchbook.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def expected(texts: dict, width: int = 5) -> dict:
    sets, roots = shingle_sets(texts, width), component_ids(texts, width)
    return {d: (len(sets[d]), roots[d]) for d in texts}


def answer(rows) -> dict:
    found = rows.collect()
    assert len({r.doc_id for r in found}) == len(found)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in found}


@pytest.mark.parametrize("sf_dir", [SF_DIR, "/root/testdata/sf0.01"])
def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    assert answer(QUERIES["op13_jaccard_join"](spark, sf_dir)) == expected(texts)


def families(n: int) -> dict:
    """Texts at all distances about the threshold: copies with some words changed, chains, templates, shared passages."""
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(400)}"
    passage = " ".join(f"p{i}" for i in range(60))
    texts: dict[int, str] = {}
    for _ in range(6):
        base = [word() for _ in range(rng.randrange(20, 120))]
        for _ in range(n):
            own = list(base)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(len(own))] = rng.choice(["x", "y", word()])
            texts[len(texts) * 7 % 10_007] = " ".join(own)
    chain = [word() for _ in range(60)]
    for i in range(40):  # each is linked with its neighbours, the ends aren't
        texts[20_000 - i] = " ".join(chain[i:] + [f"n{j}" for j in range(i)])
    for i in range(n):
        texts[30_000 + i] = f"your order number x{i} has now been shipped to you"
        texts[40_000 + i] = passage + " " + " ".join(word() for _ in range(rng.randrange(40)))
        texts[50_000 + i] = " ".join(["same"] * rng.randrange(1, 9))
    return texts


@pytest.mark.parametrize("group, bits", [(64, None), (3, 16), (1, 16)])
def test_families(spark, monkeypatch, group, bits):
    monkeypatch.setattr(jaccard_join, "GROUP", group)
    texts = families(30)
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert answer(jaccard_join.jaccard_components(rows, bits=bits)) == expected(texts)


def test_any_order_of_tokens_finds_the_same(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "estimate", lambda sketch, keys: (keys >> 60) + 1)
    texts = families(12)
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert answer(jaccard_join.jaccard_components(rows)) == expected(texts)


def test_links_without_leaders(spark, monkeypatch):
    """What shares no smallest hash with its leader is found by the matrix alone."""
    monkeypatch.setattr(jaccard_join, "MINS", 1)
    texts = families(20)
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert answer(jaccard_join.jaccard_components(rows)) == expected(texts)


def test_odd_rows(docs):
    rows = docs(*ODD, (8, "ONE"), (9, "a b"), (10, "a b"), (11, "a  B\n"), (12, "b a")).selectExpr(
        "*", "1 AS n", "2 AS rare", "3 AS root", "4 AS grp", "5 AS mins", "6 AS component_id", "7 AS n_shingles"
    )
    found = jaccard_join.jaccard_components(rows)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    got = sorted((tuple(r) for r in found.collect()), key=str)
    own = [(None, 13, None), (1, 0, 1), (2, 0, 2), (3, 29_996, 3), (4, 10, 4), (5, 10, 4), (5, 10, 4), (6, 1, 6), (7, 0, 7),
           (8, 1, 6), (9, 1, 9), (10, 1, 9), (11, 1, 9), (12, 1, 12)]
    assert got == sorted(own, key=str)


def test_one_doc_id_with_several_texts(docs):
    a, b = ("eins zwei drei vier fünf sechs", "one two three four five six")
    found = jaccard_join.jaccard_components(docs((1, a), (2, b), (3, a), (3, b), (4, b), (5, "other words")))
    assert sorted((r.doc_id, r.component_id) for r in found.collect()) == [(1, 1), (2, 1), (3, 1), (3, 1), (4, 1), (5, 5)]


def test_empty_table(docs):
    assert jaccard_join.jaccard_components(docs()).collect() == []
