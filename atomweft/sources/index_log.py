"""The append-only index log of the cache: JSON lines, read tolerantly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from atomweft.functions.columns import parse_utc

REQUIRED = ["cache_key", "chunk_path", "output_format", "seq", "writer_id", "written_at_utc"]
#: Byte ranges of files (about 150 bytes a row) that may be broadcast.
BROADCAST_BLOCKS = 100_000
OPTIONAL = ["model_name", "model_version", "schema_version"]


def read_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(index_path, line_no, line) with lines numbered from 1 in each file.

    Files are read in byte ranges. A range's lines are numbered in the order of its task; the numbers of lines in the ranges before, a row for
    each range, are added up. So no file has to fit into a task.
    """
    at = F.col("_metadata")
    rows = spark.read.text(paths).select(at.file_path.alias("file"), at.file_name.alias("index_path"), at.file_block_start.alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
    blocks = rows.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first")).persist()
    before = blocks.select("file", "block", "first", (F.sum("n").over(W.partitionBy("file").orderBy("block")) - F.col("n")).alias("before"))
    if blocks.count() <= BROADCAST_BLOCKS:
        before = F.broadcast(before)
    return rows.join(before, ["file", "block"]).select("index_path", (F.col("before") + F.col("at") - F.col("first") + 1).alias("line_no"), "line")


def parse_records(lines: DataFrame) -> DataFrame:
    """Records of well-formed lines; a line that is no object, lacks a required field or fails its conversion is left out."""
    value = F.try_parse_json("line")
    get = lambda name, kind: F.try_variant_get(F.col("v"), f"$.{name}", kind)
    text = [get(n, "string").alias(n) for n in REQUIRED if n != "seq"] + [get(n, "string").alias(n) for n in OPTIONAL]
    rows = lines.withColumn("v", value).where(F.col("v").isNotNull()).select("index_path", "line_no", *text, get("seq", "bigint").alias("seq"))
    rows = rows.withColumn("written_at", parse_utc(F.col("written_at_utc")))
    for name in [*REQUIRED, "written_at"]:
        rows = rows.where(F.col(name).isNotNull())
    return rows


def rank() -> Column:
    """Later is greater: time, writer, sequence, line, file."""
    return F.struct("written_at", "writer_id", "seq", "line_no", "index_path")


def read_index(spark: SparkSession, paths: list[str]) -> DataFrame:
    return parse_records(read_lines(spark, paths))


def latest(records: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The record of greatest order for each key: a grouped maximum, combined before the shuffle."""
    others = [c for c in records.columns if c not in keys]
    best = records.groupBy(*keys).agg(F.max_by(F.struct(*others), order).alias("best"))
    return best.select(*keys, "best.*")
