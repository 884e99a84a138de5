"""Our extension: the index log as a stream. New index lines update the latest record of each (cache_key, output_format)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atomweft.operators.cache import compacted
from atomweft.sources.index_log import parse_records


def stream_records(spark: SparkSession, index_dir: str) -> DataFrame:
    """Records of index files as they appear; a file is read once, so each writer publishes a file for each store."""
    whole = spark.readStream.option("wholetext", True).option("pathGlobFilter", "index_*.jsonl").text(index_dir)
    lines = whole.select(F.col("_metadata.file_name").alias("index_path"), F.posexplode(F.split("value", "\r\n|\r|\n")).alias("at", "line"))
    return parse_records(lines.select("index_path", (F.col("at") + 1).alias("line_no"), "line"))


def stream_latest(spark: SparkSession, index_dir: str) -> DataFrame:
    """The running result of compaction, for a query in complete or update mode. State is one record per key and format."""
    return compacted(stream_records(spark, index_dir))
