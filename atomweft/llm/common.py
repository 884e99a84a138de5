"""Pieces that several operators share: text rules, materialised intermediates, size-checked joins."""

from __future__ import annotations

import string
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest side that a join may broadcast, in rows of a few dozen bytes; beyond it the join shuffles.
BROADCAST_ROWS = 400_000

ASCII_SPACE = r"[\x20\x09-\x0D]+"


def lower_ascii(col: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(col, string.ascii_uppercase, string.ascii_lowercase)


def words(col: Column, gap: str = ASCII_SPACE) -> Column:
    """The maximal runs of characters outside ``gap``, in order; null and empty texts have none."""
    return F.filter(F.split(F.coalesce(col, F.lit("")), gap), lambda w: w != "")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the session names; a temporary one only in local mode, where driver and tasks share the machine."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and (context.master.startswith("local-cluster") or not context.master.startswith("local")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once, its lineage cut by a checkpoint in the shared folder, so that lost executors lose nothing."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a compressed table in the shared folder and read back."""
    path = f"{checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def sized(df: DataFrame, rows: int | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``limit`` rows. ``df`` must be cheap to count: give ``cut`` or ``stored`` rows.

    Give grouped rows that another side joins by the group's key as ``stored`` rows: read back they have no partitioning, so both sides of
    a shuffled join are plain exchanges and adaptive execution can split the partition of a hot key.
    """
    return F.broadcast(df) if (df.count() if rows is None else rows) <= limit else df


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a long, b long); component is the smallest node it can reach.

    Alternates the large-star and small-star steps until the edges stop changing, however many rounds that takes (about the logarithm of their number). Every step is a grouped minimum, which combines before
    the shuffle, and a join back; a hub with very many neighbours is split by the adaptive skew join. Self links and repeats are allowed.
    """
    edges = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    before = state(edges)
    while before[0]:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = sized(stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = cut(large)
        least = sized(stored(large.groupBy("a").agg(F.min("b").alias("m")), "least"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        edges = cut(small.where("a <> b").distinct())
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
