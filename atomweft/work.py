"""Intermediate tables of a job: written once, read many times, removed at the end.

A written table cuts the lineage (plans over nested cached tables grow, and so does the time to plan and describe them), survives lost executors
without being computed again, and has statistics.
"""

from __future__ import annotations

import secrets
import shutil
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession


class Workspace:
    """Tables in a new folder under ``spark.checkpoint.dir`` or, where that is unset, under ``beside``, which driver and executors share."""

    def __init__(self, spark: SparkSession, beside: str | Path):
        shared = spark.conf.get("spark.checkpoint.dir", None)
        name = f".work-{secrets.token_hex(6)}"
        self.spark, self.folder, self._tables = spark, f"{shared or Path(beside).absolute()}/{name}", 0
        self._local = self.folder.removeprefix("file://") if "://" not in self.folder or self.folder.startswith("file://") else None

    def keep(self, df: DataFrame, **figures: Column) -> DataFrame | tuple[DataFrame, dict]:
        """``df`` as a written table; with ``figures``, aggregates that are observed while it is written, also their values (None for none)."""
        self._tables += 1
        path, seen = f"{self.folder}/t{self._tables}", Observation()
        if figures:
            df = df.observe(seen, *(c.alias(k) for k, c in figures.items()))
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        return (table, {k: seen.get.get(k) for k in figures}) if figures else table

    def close(self) -> None:
        """Removes the tables; a folder in another file system stays until the checkpoint folder is cleaned."""
        if self._local is not None:
            shutil.rmtree(self._local, ignore_errors=True)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        self.close()
