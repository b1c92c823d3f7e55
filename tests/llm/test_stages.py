"""Stages of the pipeline on odd rows, on no rows, and on columns with the names that operators use themselves."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import LONG, ODD
from tests.llm.test_queries import SF_DIR

#: Names of the operators' results and of columns that they make on the way.
NAMES = (
    "row score n_lines n_removed lines gone doc version block key spans n_shingles component_id kept root home lead registers"
    " shingles n rare grp groups token place item_id n_words held_out predicted start length offset sequence_id doc_tokens"
).split()
KEEPING = [(name, stage) for name, stage in corpus_pipeline.STAGES[:-1]]


def odd(docs, names=()):
    plain = docs(*ODD, (8, "a\nb\nc\nd"), (9, "x\na\nb\nc\nd\n")).select("doc_id", "text")
    return plain.select("*", F.length("text").alias("n_chars"), *[F.lit(i).alias(n) for i, n in enumerate(names)])


@pytest.mark.parametrize("name, stage", KEEPING)
def test_odd_rows_and_names(spark, docs, name, stage):
    rows = odd(docs, NAMES)
    kept = stage(spark, rows, SF_DIR)
    assert kept.columns == rows.columns
    texts = [(r.doc_id, r.text, r.n_chars) for r in kept.collect()]
    assert sorted(texts, key=str) == sorted([(r.doc_id, r.text, r.n_chars) for r in stage(spark, odd(docs), SF_DIR).collect()], key=str)
    ids = [d for d, _, _ in texts]
    assert {1, 2, 3, 6} <= set(ids) and (3, LONG, len(LONG)) in texts
    assert (None in ids) and (name != "near_dedup" or (ids.count(4), ids.count(5)) == (1, 0))
    if name == "line_dedup":
        assert (9, "x\n", 2) in texts


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_no_rows(spark, docs, name, stage):
    assert stage(spark, odd(docs).where("false"), SF_DIR).count() == 0


def test_packing_takes_odd_rows(spark, docs):
    pieces = corpus_pipeline.STAGES[-1][1](spark, odd(docs, ["row", "key", "block"]), SF_DIR).collect()
    assert {r.doc_id for r in pieces} == {None, *range(1, 10)}
