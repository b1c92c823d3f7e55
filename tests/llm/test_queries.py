"""Registered queries: against SQL where there is one, and against the guard without the subpackage."""

import os

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tests.compare import database, differences
from trenchbook.llm.queries import ORACLE_SQL, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(contract.queries())
    assert set(ORACLE_SQL) <= set(contract.oracle_sql()) & set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_as_sql(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), database(SF_DIR), ORACLE_SQL[name]) is None


@pytest.mark.parametrize("name", ["op4_line_dedup", "op5_license_scan", "op9_chat_format"])
def test_native_plans_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct"))


def test_pipeline_stages_keep_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = spark.createDataFrame(stage(spark, docs, SF_DIR).toArrow())
        assert docs.columns == columns and 0 < docs.count() <= before, name
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in docs.collect()} <= ids
