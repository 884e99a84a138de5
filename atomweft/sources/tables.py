"""Result tables, weights and file digests."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atomweft.config import load_mapping
from atomweft.errors import ConfigError
from atomweft.schema import RESULTS_TYPES


def read_results(spark: SparkSession, path: str | Path) -> DataFrame:
    """A results table by suffix. CSV columns have fixed types: ids are text, ``cs_`` columns and positions are doubles."""
    path = Path(path)
    if not path.exists():
        raise ConfigError(f"the results file does not exist: {path}")
    suffix = path.suffix.lower()
    if suffix == ".parquet":
        return spark.read.parquet(str(path))
    if suffix != ".csv":
        raise ConfigError("results must be a .csv or .parquet file")
    return read_csv(spark, str(path))


def read_csv(spark: SparkSession, *paths: str) -> DataFrame:
    options = {"header": True, "nullValue": "", "positiveInf": "inf", "negativeInf": "-inf", "nanValue": "nan"}
    names = spark.read.options(**options).csv(list(paths)).columns
    schema = ", ".join(f"`{n}` {RESULTS_TYPES.get(n, 'double' if n in ('x', 'y', 'z') or n.startswith('cs_') else 'string')}" for n in names)
    return spark.read.options(**options).schema(schema).csv(list(paths))


def load_weights(path: str | Path) -> dict[str, float]:
    """``<source>#<frame>`` to weight, from JSON or YAML."""
    return {str(k): float(v) for k, v in load_mapping(Path(path), "the weights file", ValueError).items()}


def weights_frame(spark: SparkSession, weights: dict[str, float]) -> DataFrame:
    return spark.createDataFrame(list(weights.items()), "frame_key string, weight double")


def file_digests(spark: SparkSession, paths: list[str]) -> list[dict[str, str]]:
    """Path and SHA-256 of each distinct existing file, sorted by path. The bytes are hashed in the tasks."""
    files = sorted({p for p in map(str, paths) if Path(p).is_file()})
    if not files:
        return []
    rows = spark.read.format("binaryFile").load(files).select(F.regexp_replace("path", "^file:/+", "/").alias("path"), F.sha2("content", 256).alias("sha256"))
    return [r.asDict() for r in rows.orderBy("path").collect()]
