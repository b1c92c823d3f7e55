"""A training corpus from raw documents: scored, cleaned, deduplicated, decontaminated and packed.

Every stage takes what its predecessor kept and returns the documents' columns; the last returns the pieces of the
packed sequences.
"""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from trenchbook.llm import quality as scoring  # noqa: E402
from trenchbook.llm.decontaminate import find_leaks  # noqa: E402
from trenchbook.llm.line_dedup import cut_repeated_lines  # noqa: E402
from trenchbook.llm.near_dedup import near_duplicates  # noqa: E402
from trenchbook.llm.packing import pack  # noqa: E402
from trenchbook.llm.queries import GOOD, tokenizer_file  # noqa: E402
from trenchbook.llm.store import Store  # noqa: E402


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of ``GOOD`` or more stay; the model is learned from the labels of this input.

    A null or empty text scores like a usual good one, and stays. Without labels of both kinds all documents stay.
    """
    model = scoring.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scoring.score(docs, model).where(F.col("score") >= GOOD).select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated three-line passages go from the texts; a document that has nothing left goes as well.

    A null text stays. ``n_chars`` is that of the text left, where the input has such a column.
    """
    cut = cut_repeated_lines(docs)
    left = cut.where((F.col("n_removed") == 0) | (F.trim("row.text") != ""))
    kinds = dict(docs.dtypes)
    chars = F.when(F.col("n_removed") > 0, F.length("row.text"))
    columns = [
        F.coalesce(chars.cast(kinds[c]), F.col("row.n_chars")).alias(c) if c == "n_chars" else F.col(f"row.`{c}`")
        for c in docs.columns
    ]
    return left.select(*columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by five-word shingles, stays: the one with the smallest doc_id.

    All rows of a doc_id stay or go together. Rows without doc_id, and texts without words, stay.
    """
    kept = near_duplicates(docs, width=5).where("kept").select("doc_id").distinct()
    named = docs.where("doc_id is not null").join(kept.hint("rebalance"), "doc_id", "left_semi")
    return named.unionByName(docs.where("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go; a null or empty text holds none."""
    leaks = find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return leaks.where(F.size("spans") == 0).select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of 1024 tokens; a null text is empty, and its end token is packed."""
    return pack(docs, tokenizer_file("byte_bpe_50k.json"), tokenizer_file("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Scores, estimates and token ids are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    store = Store(spark, "pipeline")
    for _, stage in STAGES:
        docs = store.keep(stage(spark, docs, sf_dir))
    return docs
