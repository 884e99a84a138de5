"""Greedy packing over all rows of a table, in order, by many tasks.

Where a chunk ends follows from where it starts, so chunks are the orbit of row 0 under a successor function. Rows are cut into blocks of equal
length, no shorter than a chunk can be. Each block tells, for every row at which a chunk could be the first to start in it, where the first chunk of the
next block starts and how many chunks lie between (pointers doubled until they leave the block). One walk over these short lists finds where
the chunks of each block really start; then blocks number their rows side by side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from atomweft.work import Workspace

#: Blocks of a table, and entries of all their lists together: what the walk reads.
BLOCKS = 10_000
LISTED = 20_000_000


def numbered(rows: DataFrame, order: list[str], work: Workspace, tasks: int) -> DataFrame:
    """``rows`` with ``place``, their number from 0 in ``order`` (which leaves no ties): sorted by ranges and numbered in each, the numbers of rows before added."""
    at = F.monotonically_increasing_id()
    stored = work.keep(rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order).withColumn("at", at).withColumn("part", F.shiftright("at", 33)))
    counts = stored.groupBy("part").count()  # a row for each task
    before = counts.select("part", (F.sum("count").over(W.orderBy("part")) - F.col("count")).alias("before"))
    return stored.join(F.broadcast(before), "part").withColumn("place", F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).drop("part", "at", "before")


def successors(sizes: np.ndarray, limit_rows: int, limit_bytes: int) -> np.ndarray:
    """For each row the row after the chunk that starts there: ``limit_rows`` rows, fewer if they exceed ``limit_bytes``, one at least."""
    ends = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    here = np.arange(sizes.size)
    fits = np.searchsorted(ends, ends[:-1] + limit_bytes, side="right") - 1
    return np.maximum(here + 1, np.minimum(here + limit_rows, fits))


def _exits(n: int, limit_rows: int, limit_bytes: int):
    """(block, exits, chunks): for each of the first rows of a block as its first start, the place in the next block of the next start, and the number of chunks."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("place")
        own = int((~pdf["ahead"]).sum())
        to = np.minimum(successors(pdf["bytes"].to_numpy(), limit_rows, limit_bytes)[:own], own + limit_rows)
        jumps = np.ones(own, dtype=np.int64)
        while (inside := to < own).any():
            jumps[inside] += jumps[to[inside]]
            to[inside] = to[to[inside]]
        first = np.arange(min(limit_rows, n))
        exits, chunks = first - own, np.zeros(first.size, dtype=np.int64)
        exits[:own], chunks[:own] = (to - own)[: first.size], jumps[: first.size]
        return pd.DataFrame({"block": [int(pdf["block"].iloc[0])], "exits": [exits.tolist()], "chunks": [chunks.tolist()]})

    return run


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(block, entry, first): where the first chunk that starts in each block starts, and its number. The blocks come in order."""
    entry = number = 0
    for batch in batches:
        out = []
        for block, exits, chunks in zip(batch["block"], batch["exits"], batch["chunks"]):
            out.append((block, entry, number))
            entry, number = int(exits[entry]), number + int(chunks[entry])
        yield pd.DataFrame(out, columns=["block", "entry", "first"])


def _numbers(columns: list[str], limit_rows: int, limit_bytes: int):
    """The rows of a block with the number of their chunk; rows before the entry belong to the chunk that is open there."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("place")
        to, at, starts = successors(pdf["bytes"].to_numpy(), limit_rows, limit_bytes), int(pdf["entry"].iloc[0]), np.zeros(len(pdf), dtype=np.int64)
        while at < len(pdf):
            starts[at] = 1
            at = to[at]
        return pdf.assign(chunk_no=int(pdf["first"].iloc[0]) - 1 + np.cumsum(starts))[[*columns, "place", "chunk_no"]]

    return run


def pack_all(sizes: DataFrame, order: list[str], limit_rows: int, limit_bytes: int, work: Workspace, block_rows: int | None = None) -> DataFrame:
    """``sizes`` (with ``bytes``, not null) with ``place`` and ``chunk_no``, both from 0: one greedy pass over all rows in ``order``, which must leave no ties.

    A chunk closes at ``limit_rows`` rows, or when the next row would take it over ``limit_bytes``; a single larger row has its own chunk. A block has
    ``block_rows`` rows; by default there are as many blocks as give each eight chunks, within BLOCKS and LISTED. Without rows there are no chunks.
    """
    n = sizes.count()
    blocks = max(1, min(-(-n // (8 * limit_rows)), BLOCKS, LISTED // limit_rows))
    length = max(block_rows or -(-n // blocks), limit_rows, 1)
    rows = work.keep(numbered(sizes, order, work, blocks).withColumn("block", F.floor(F.col("place") / length)))
    ahead = (F.col("place") % length < limit_rows) & (F.col("block") > 0)
    seen = rows.select("place", "bytes", F.explode(F.when(ahead, F.array("block", F.col("block") - 1)).otherwise(F.array("block"))).alias("in"), "block")
    seen = seen.select(F.col("in").alias("block"), "place", "bytes", (F.col("in") < F.col("block")).alias("ahead"))
    lists = seen.groupBy("block").applyInPandas(_exits(n, limit_rows, limit_bytes), "block bigint, exits array<bigint>, chunks array<bigint>")
    entries = work.keep(lists.repartition(1).sortWithinPartitions("block").mapInPandas(_walk, "block bigint, entry bigint, first bigint"))
    schema = ", ".join(f"`{name}` {kind}" for name, kind in sizes.dtypes)
    return rows.join(F.broadcast(entries), "block").groupBy("block").applyInPandas(_numbers(sizes.columns, limit_rows, limit_bytes), f"{schema}, place bigint, chunk_no bigint")
