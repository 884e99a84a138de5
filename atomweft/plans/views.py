"""Adapter views: the given tables in the roles that the operators work on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Frames in one structure file.
FILE_FRAMES = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as atoms: the order is the frame, prices in cents are the isotropic value (whole numbers, so sums are exact)."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("src"), (F.col("l_suppkey") % 5).cast("string")).alias("source_file"), F.col("l_orderkey").alias("frame"), (F.col("l_linenumber") - 1).cast("bigint").alias("atom_i"), F.col("l_returnflag").alias("element"),
        F.col("l_discount").alias("x"), F.col("l_tax").alias("y"), F.lit(0.0).alias("z"), F.round(F.col("l_extendedprice") * 100).alias("cs_iso"), F.col("l_quantity").alias("cs_xx"),
    )


RESULTS_SQL = "SELECT 'src' || CAST(l_suppkey % 5 AS VARCHAR) AS source_file, l_orderkey AS frame, CAST(l_linenumber - 1 AS BIGINT) AS atom_i, l_returnflag AS element, l_discount AS x, l_tax AS y, CAST(0.0 AS DOUBLE) AS z, round(l_extendedprice * 100) AS cs_iso, l_quantity AS cs_xx FROM lineitem"


def index_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as index records: the user is the key, the event type the format."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("cache_key"), F.col("event_type").alias("output_format"), F.col("ts").alias("written_at"), (F.col("user_id") % 3).cast("string").alias("writer_id"), F.col("event_id").alias("seq"),
        F.lit(1).alias("line_no"), F.lit("index_a").alias("index_path"), F.col("value"),
    )


def contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as frames: the text's hash is the structure."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("frame_ord"), F.sha2("text", 256).alias("structure_id"), "lang", "n_chars")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as frames of 21 atoms: three numbers a position, elements in turn, a cell where the label is not 0."""
    names = F.array(*(F.lit(e) for e in ("H", "C", "N", "O")))
    point = lambda i, k: F.get("embedding", i * 3 + k).cast("double")
    cell = F.when(F.col("label") == 0, F.array_repeat(F.lit(0.0), 9)).otherwise(F.transform(F.sequence(F.lit(1), F.lit(9)), lambda i: F.when((i % 4) == 1, 8.0).otherwise(0.0)))
    steps = F.sequence(F.lit(0), F.lit(20))
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("frame_ord"), F.concat(F.lit("label"), F.col("label").cast("string")).alias("source_file"), F.col("vec_id").alias("frame"), F.transform(steps, lambda i: F.get(F.array(*(F.lit(z) for z in (1, 6, 7, 8))), i % 4)).alias("numbers"),
        F.transform(steps, lambda i: F.get(names, i % 4)).alias("element"), F.transform(steps, lambda i: F.struct(point(i, 0).alias("x"), point(i, 1).alias("y"), point(i, 2).alias("z"))).alias("positions"),
        cell.alias("cell"), F.when(F.col("label") == 0, F.array_repeat(F.lit(0), 3)).otherwise(F.array_repeat(F.lit(1), 3)).alias("pbc"), "label",
    )


def folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that the session names, or in a temporary one in local mode."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{(shared or tempfile.gettempdir()).removeprefix('file://')}/{name}-{uuid.uuid4().hex}"


def structure_files(spark: SparkSession, sf_dir: str) -> str:
    """The frames as extended XYZ files of FILE_FRAMES frames each, written by the tasks; a pattern that matches them. Frames of label 0 have no cell."""
    atom = F.zip_with("element", "positions", lambda e, p: F.concat_ws(" ", e, p.x.cast("string"), p.y.cast("string"), p.z.cast("string")))
    cell = F.when(F.col("label") == 0, "no cell").otherwise('Lattice="8 0 0 0 8 0 0 0 8" Properties=species:S:1:pos:R:3 pbc="T T T"')
    text = F.concat_ws("\n", F.size("element").cast("string"), cell, F.array_join(atom, "\n"))
    rows = frames(spark, sf_dir).select(F.floor(F.col("frame") / FILE_FRAMES).alias("part"), "frame", text.alias("text"))
    whole = rows.groupBy("part").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("frame", "text"))), lambda x: x.text), "\n").alias("value"))
    path = folder(spark, "frames")
    whole.write.partitionBy("part").text(path)
    return f"{path}/part=*/part-*"


#: embeddings by part and place in it, as ``structure_files`` writes them.
FILES_SQL = f"SELECT *, vec_id // {FILE_FRAMES} AS part, row_number() OVER (PARTITION BY vec_id // {FILE_FRAMES} ORDER BY vec_id) - 1 AS frame FROM embeddings"
