"""Tables written between steps, in the folder that all executors share.

A written table cuts the lineage and outlives lost executors. Each call of an operator gets a
folder of its own, so two calls never meet.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trenchbook.plans.stages import shared_folder


class Store:
    """Tables of one call of an operator."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self._count = 0

    def keep(self, rows: DataFrame) -> DataFrame:
        """The rows, written and read back; the schema is known, so nothing is inferred."""
        self._count += 1
        path = f"{self.folder}/{self._count:03d}"
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)


def blocks_for(rows: DataFrame, column: str, block_bytes: int) -> int:
    """How many blocks of about that many bytes the texts of a column make; grows with the input."""
    total = rows.agg(F.sum(F.octet_length(column)).alias("n")).first()["n"] or 0
    return 1 + total // block_bytes
