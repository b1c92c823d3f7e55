"""Tables that several steps share, each written once per run and read back.

A written table cuts the lineage, is read with column pruning, and is there
for every later step even when executors are lost.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder for this run's stage tables, in the one the cluster names in spark.checkpoint.dir."""
    run = spark.sparkContext.applicationId
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return f"{named.rstrip('/')}/trenchbook-{run}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder all executors share")
    return _own_folders.setdefault(run, tempfile.mkdtemp(prefix="trenchbook-"))


class Stages:
    """Named tables under one folder, made on first use."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str, make: Callable[[], DataFrame], *parts: str) -> DataFrame:
        """The table of that name; the first call writes it, in a folder for each value of ``parts``."""
        if name not in self._tables:
            path = f"{self.folder}/{name}"
            make().write.mode("overwrite").partitionBy(*parts).parquet(path)
            self._tables[name] = self.spark.read.parquet(path)
        return self._tables[name]

    def get(self, name: str) -> DataFrame:
        """A table made before."""
        return self._tables[name]
