"""Phrase collocations against counts of all phrases in plain Python, and against SQL."""

import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.compare import database, differences
from tests.llm.conftest import ODD
from trenchbook.llm import collocations as phrases
from trenchbook.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain(rows, least: int = 30, top: int = 2000) -> list[tuple]:
    count, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, 5):
                count[lang].update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, f in count.items():
        often = {p: c for p, c in f.items() if c >= least and len(p) > 1}
        covered = set()
        for p, c in often.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    if 100 * c >= 80 * f[p[i : i + size]]:
                        covered.add(p[i : i + size])
        found = []
        for p, a in often.items():
            if p not in covered:
                score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, spelt, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, spelt.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def told(frame) -> list[tuple]:
    return sorted(tuple(r) for r in frame.select(*COLUMNS).collect())


def test_query(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text", "lang").collect()
    assert told(QUERIES["op12_phrase_collocations"](spark, SF_DIR)) == plain([tuple(r) for r in rows])


@pytest.mark.parametrize("sf_dir", [SF_DIR, "/root/testdata/sf0.01"])
def test_same_as_sql(spark, sf_dir):
    assert differences(QUERIES["op12_phrase_collocations"](spark, sf_dir), database(sf_dir), phrases.SQL) is None


def talk() -> list[tuple]:
    """Texts where a phrase holds a third of all rows, words meet rarely, and pieces, cases and spaces vary."""
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "über", "\u001fodd", "a b", "x-y", "I", "THE", "the"]
    rows = []
    for i in range(400):
        own = [rng.choice(vocabulary) for _ in range(rng.randrange(30))]
        if i % 3 == 0:
            own += ["in", "the", "beginning", "was", "the", "word"]
        glue = rng.choice([" ", "  ", "\t", " \t "])
        text = glue.join(w + rng.choice(["", "", "", "", ".", ",", "!\n", "\r\n"]) for w in own)
        rows.append((text, rng.choice(["en", "en", "de", None, ""])))
    return rows + [(None, "en"), ("", "en"), ("... ;;", "xx"), ("la la la la la la " * 200, "fr"), ("one" * 3, "zz")]


@pytest.mark.parametrize("least, top", [(30, 2000), (3, 40), (2, 2000), (1, 7)])
def test_talk(spark, least, top):
    rows = talk()
    frame = spark.createDataFrame(rows, "text string, lang string").selectExpr(
        "*", "1 AS n", "2 AS phrase", "3 AS f", "'x' AS words", "4 AS suffix", "5 AS size"
    )
    assert told(phrases.collocations(frame, least=least, top=top)) == plain(rows, least, top)


@pytest.mark.parametrize("ranges", ["1", "29"])
def test_same_in_any_number_of_blocks_and_ranges(spark, monkeypatch, ranges):
    monkeypatch.setattr(phrases, "BLOCK", 500)
    monkeypatch.setattr(phrases, "OPEN", 900)
    monkeypatch.setattr(phrases, "RANGE", 10**9 if ranges == "1" else 50)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        rows = talk()
        frame = spark.createDataFrame(rows, "text string, lang string").repartition(5)
        assert told(phrases.collocations(frame, least=5)) == plain(rows, 5)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_full_sketches_change_nothing_but_the_work(spark, monkeypatch):
    monkeypatch.setattr(phrases, "estimate", lambda sketch, keys: np.full(len(keys), 255))
    rows = talk()
    frame = spark.createDataFrame(rows, "text string, lang string")
    assert told(phrases.collocations(frame, least=5)) == plain(rows, 5)


def test_quicksort_gives_the_sizes_of_all_parts():
    rng = np.random.default_rng(2)
    key = rng.integers(0, 5, (4, 3000))
    key *= np.cumprod(key > 0, axis=0)  # nothing after a suffix's end
    weight = rng.integers(1, 4, 3000)
    for least in (1, 40):
        got = {(d, tuple(key[: d + 1, i])): t for d, i, t in phrases.multikey_quicksort(key, weight, least)}
        want = Counter()
        for column, w in zip(key.T, weight, strict=True):
            for d in range(4):
                if column[d]:
                    want[d, tuple(column[: d + 1])] += int(w)
        assert got == {k: t for k, t in want.items() if t >= least}


def test_odd_rows_and_empty_tables(docs):
    from pyspark.sql import functions as F

    rows = docs(*ODD).withColumn("lang", F.lit(None).cast("string"))
    assert told(phrases.collocations(rows, least=2)) == plain([(t, None) for _, t in ODD], 2)
    assert phrases.collocations(rows.where("false")).collect() == []
    assert phrases.collocations(docs((1, None), (2, "")).withColumn("lang", F.lit("en"))).collect() == []
