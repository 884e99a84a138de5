"""The relational algebra of the prediction cache."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from atomweft.functions.columns import number
from atomweft.sources.index_log import latest, rank


def manifest(records: DataFrame, output_format: str) -> DataFrame:
    """The record of each cache_key that a store of this format uses: its own format first, then the latest."""
    return latest(records, ["cache_key"], F.struct((F.col("output_format") == output_format).alias("own"), rank().alias("rank")))


def compacted(records: DataFrame) -> DataFrame:
    """The latest record of each (cache_key, output_format)."""
    return latest(records, ["cache_key", "output_format"], rank())


def canonical(rows: DataFrame, key: str, order: Column) -> DataFrame:
    """Rows with a whole ``atom_i`` as bigint, the last by ``order`` for each (key, atom); keys with any other atom_i are left out.

    Whole means within one part in a hundred thousand of a whole number. The maximum is grouped, so repeats combine before the shuffle.
    """
    value = number(F.col("atom_i"))
    near = F.abs(value - F.floor(value)) <= 1e-8 + 1e-5 * F.abs(F.floor(value))
    others = [c for c in rows.columns if c not in (key, "atom_i")]
    packed = rows.where(F.col(key).isNotNull()).select(key, F.when(near, F.floor(value)).alias("atom_i"), F.struct(*others).alias("row"), order.alias("ord"))
    best = packed.groupBy(key, "atom_i").agg(F.max_by("row", "ord").alias("row"))
    odd = packed.where("atom_i IS NULL").select(key).distinct()
    return best.join(odd, key, "left_anti").select(key, "atom_i", *(F.col("row")[c].alias(c) for c in others))


def complete_keys(rows: DataFrame, key: str, expected: Column | None = None) -> DataFrame:
    """Keys of canonical rows whose atoms are exactly 0 to n - 1; n is their number, or ``expected``."""
    found = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n_atoms"), F.min("atom_i").alias("low"), F.max("atom_i").alias("high"))
    found = found.where((F.col("low") == 0) & (F.col("high") == F.col("n_atoms") - 1))
    return (found if expected is None else found.where(F.col("n_atoms") == expected)).select(key, "n_atoms")


def hits(frames: DataFrame, cached: DataFrame) -> DataFrame:
    """Frames (with frame_cache_key, element) whose key has a complete set of canonical cached rows for just their number of atoms."""
    whole = complete_keys(cached, "frame_cache_key")
    return frames.withColumn("n_atoms", F.size("element").cast("bigint")).join(whole, ["frame_cache_key", "n_atoms"], "left_semi").drop("n_atoms")


def misses(frames: DataFrame, found: DataFrame) -> DataFrame:
    return frames.join(found.select("frame_ord"), "frame_ord", "left_anti")


def materialise(atoms: DataFrame, values: DataFrame) -> DataFrame:
    """Current atoms with the values that their key has; every frame of a key gets its own copy."""
    return atoms.join(values, ["frame_cache_key", "atom_i"])


def pack(sizes: DataFrame, order: str, group: str, limit_rows: int, limit_bytes: int) -> DataFrame:
    """``sizes`` (group, order, bytes, ...) with chunk_no: greedy packing in order within each group, as one stream over sorted rows.

    A chunk closes at ``limit_rows`` rows, or when the next row would take it over ``limit_bytes``; a single larger row has its own chunk.
    """
    rows = sizes.repartition(F.col(group)).sortWithinPartitions(group, order)
    schema = ", ".join(f"`{n}` {t}" for n, t in sizes.dtypes)
    return rows.mapInPandas(pack_stream(limit_rows, limit_bytes, group), f"{schema}, chunk_no bigint, place bigint").drop("place")


def pack_stream(limit_rows: int, limit_bytes: int, group: str | None = None):
    """The same packing over the sorted rows of one task: rows with chunk_no, from 0 in each ``group`` or in the task, and their place in the task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        no, n, held, at, place = 0, 0, 0, None, 0
        for batch in batches:
            nos = []
            for size, own in zip(batch["bytes"], batch[group] if group else itertools.repeat(None)):
                if own != at:
                    no, n, held, at = 0, 0, 0, own
                elif n >= limit_rows or (n and held + size > limit_bytes):
                    no, n, held = no + 1, 0, 0
                n, held = n + 1, held + size
                nos.append(no)
            yield batch.assign(chunk_no=nos, place=range(place, place + len(nos)))
            place += len(nos)

    return run


def chunk_numbers(df: DataFrame, group: str, order: list[str], size: int) -> DataFrame:
    """``df`` with chunk_no: ``size`` consecutive rows each, within each group."""
    return df.withColumn("chunk_no", F.floor((F.row_number().over(W.partitionBy(group).orderBy(*order)) - 1) / size))
