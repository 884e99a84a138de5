"""Mixing sources to target weights by Pfair scheduling.

Each source is cut into blocks of documents. Block i of a source with weight w (a share of one slot per slot) is released at floor(i / w) and
due at ceil((i + 1) / w); the earliest deadline goes first. So at every slot each source has got its weighted share, less or more than one
block. When a source runs out, a new phase starts with the weights of the others.

Weights are exact fractions (0.7 is 7/10). In whole parts without a common factor, their sum is a number of slots after which all sources have
just their shares and the schedule repeats: one such period of each phase is computed, and the slot of any block follows by arithmetic, in
parallel. Only if these periods together are over ``PERIODS`` slots long (weights with many digits) are the blocks walked through in order, in
one task; both give the same slots.
"""

from __future__ import annotations

import bisect
import heapq
import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from atomweft.llm.common import stored

BLOCK_DOCS = 16
#: Weights that follow from the sizes of the sources are whole numbers, at most this.
RESOLUTION = 1000
#: Slots of the periods of all phases that are computed at most.
PERIODS = 1 << 20
#: Rows of a batch of the timetable.
BATCH = 1 << 16
#: Documents that are ranked together in one group: each source has as many groups as its size needs. Sums run over so many groups at a time.
BUCKET_ROWS = 1_000
GROUPS = 1_000
SEED = 20
RESULTS = ("mix_block", "mix_slot", "mix_position")


@dataclass(frozen=True)
class Phase:
    """From slot ``start`` the blocks ``first[s]`` up to ``end[s]`` of each source s go to ``offsets[s]`` of repeated periods."""

    start: int
    period: int
    first: dict[str, int]
    end: dict[str, int]
    offsets: dict[str, list[int]]


def parts_of(weights: dict[str, float]) -> dict[str, int]:
    """The weights as whole numbers without a common factor, in exactly the same proportions."""
    exact = {s: Fraction(str(w)) for s, w in weights.items()}
    if min(exact.values()) <= 0:
        raise ValueError("weights must be positive")
    scale = math.lcm(*(x.denominator for x in exact.values()))
    whole = {s: int(x * scale) for s, x in exact.items()}
    common = math.gcd(*whole.values())
    return {s: x // common for s, x in whole.items()}


def schedule(parts: dict[str, int], slots: int | None = None) -> dict[str, list[int]]:
    """The slots of each source in one period (the sum of the parts), or its first ``slots``: earliest deadline first among released blocks, ties by name."""
    out: dict[str, list[int]] = {s: [] for s in parts}
    for t, s in enumerate(itertools.islice(_endless(parts), sum(parts.values()) if slots is None else slots)):
        out[s].append(t)
    return out


def _endless(parts: dict[str, int]) -> Iterator[str]:
    """The source of each slot, of sources that never run out."""
    whole, done = sum(parts.values()), dict.fromkeys(parts, 0)
    coming = [(0, -(-whole // a), s) for s, a in parts.items()]
    heapq.heapify(coming)
    ready: list[tuple[int, str]] = []
    for t in itertools.count():
        while coming and coming[0][0] <= t:
            _, due, s = heapq.heappop(coming)
            heapq.heappush(ready, (due, s))
        _, s = heapq.heappop(ready)
        yield s
        done[s] += 1
        heapq.heappush(coming, (done[s] * whole // parts[s], -(-(done[s] + 1) * whole // parts[s]), s))


def phases(blocks: dict[str, int], weights: dict[str, float], most: int = PERIODS) -> list[Phase] | None:
    """Phases until all blocks have a slot; each ends when one source at least has run out. None if their periods have over ``most`` slots together."""
    done, start, out = dict.fromkeys(blocks, 0), 0, []
    while active := {s: weights[s] for s, n in blocks.items() if done[s] < n}:
        parts = parts_of(active)
        period = sum(parts.values())
        known = min(period, sum(blocks[s] - done[s] for s in active))  # a phase has no more slots than blocks are left
        if (most := most - known) < 0:
            return None
        offsets = schedule(parts, known)

        def slot(s: str, i: int) -> float:
            if known == period:
                return i // parts[s] * period + offsets[s][i % parts[s]]
            return offsets[s][i] if i < len(offsets[s]) else math.inf

        length = int(min(slot(s, blocks[s] - done[s] - 1) for s in active)) + 1
        end = {s: done[s] + length // period * parts[s] + bisect.bisect_left(offsets[s], length % period) for s in active}
        out.append(Phase(start, period, {s: done[s] for s in active}, end, offsets))
        done, start = done | end, start + length
    return out


def timetable(blocks: dict[str, int], weights: dict[str, float]) -> Iterator[tuple[str, int]]:
    """(source, block) slot by slot until all blocks have one."""
    done = dict.fromkeys(blocks, 0)
    while active := {s: weights[s] for s, n in sorted(blocks.items()) if done[s] < n}:
        for s in _endless(parts_of(active)):
            yield s, done[s]
            done[s] += 1
            if done[s] == blocks[s]:
                break


def _slots(spark: SparkSession, blocks: dict[str, int], weights: dict[str, float]) -> DataFrame:
    """(_aw_s, _aw_block, _aw_slot) of the timetable, walked once in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _ in range(batch.num_rows):
                slots = enumerate(timetable(blocks, weights))
                while part := list(itertools.islice(slots, BATCH)):
                    yield pa.RecordBatch.from_arrays([pa.array([s for _, (s, _) in part], pa.string()), pa.array([i for _, (_, i) in part], pa.int64()), pa.array([t for t, _ in part], pa.int64())], ["_aw_s", "_aw_block", "_aw_slot"])

    return stored(spark.range(0, 1, 1, 1).mapInArrow(run, "_aw_s string, _aw_block bigint, _aw_slot bigint"), "slots")


def _timed(spans: DataFrame, plan: list[Phase]) -> DataFrame:
    """``spans`` with _aw_slot of each _aw_block, from the offsets of its phase's period. The plan has PERIODS slots at most."""
    steps = [(s, [(p.first[s], p.end[s], p.start, p.period, p.offsets[s]) for p in plan if s in p.first]) for s in {s for p in plan for s in p.first}]
    known = spans.sparkSession.createDataFrame(steps, "_aw_s string, _aw_steps array<struct<first: bigint, end: bigint, start: bigint, period: bigint, offsets: array<bigint>>>")
    step = F.filter("_aw_steps", lambda x: (F.col("_aw_block") >= x.first) & (F.col("_aw_block") < x.end))[0]
    rows = spans.join(F.broadcast(known), "_aw_s").withColumn("_aw_step", step)
    local: Column = F.col("_aw_block") - F.col("_aw_step.first")
    size = F.size("_aw_step.offsets").cast("bigint")
    slot = F.col("_aw_step.start") + F.floor(local / size) * F.col("_aw_step.period") + F.get("_aw_step.offsets", F.pmod(local, size).cast("int"))
    return rows.withColumn("_aw_slot", slot).drop("_aw_steps", "_aw_step")


def mix(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = 0.5, block_docs: int = BLOCK_DOCS, bucket_rows: int = BUCKET_ROWS, source: str = "source", periods: int = PERIODS) -> DataFrame:
    """All rows of ``docs`` with mix_block, mix_slot and mix_position (the order to read in, from 0; gaps only after short last blocks).

    ``weights`` gives the target by source (a source without one gets the least given); the default is each source's number of rows to the
    power ``temperature``, as a whole number of thousandths of the largest, one at least. Within a source rows are shuffled by a hash. Nothing
    is dropped or repeated. Rows without a source form a source of their own (an empty name counts as the same); ties and repeated rows keep
    separate places; an empty table gives an empty result. Columns of ``docs`` with the names of the results are replaced.
    """
    spark = docs.sparkSession
    name = F.coalesce(F.col(source), F.lit(""))
    totals = {r[0]: r[1] for r in docs.groupBy(name.alias("s")).count().collect()}  # a row for each source
    most = max(totals.values(), default=1)
    target = {s: max(1, round(RESOLUTION * (n / most) ** temperature)) for s, n in totals.items()} if weights is None else {s: weights.get(s, min(weights.values())) for s in totals}
    blocks = {s: -(-n // block_docs) for s, n in totals.items()}
    groups = spark.createDataFrame([(s, max(1, n // bucket_rows)) for s, n in totals.items()], "_aw_s string, _aw_k bigint")

    hashed = F.xxhash64(F.lit(SEED), *([c for c in ("doc_id", "text") if c in docs.columns] or [source]))
    rows = docs.withColumns({"_aw_s": name, "_aw_h": hashed}).join(F.broadcast(groups), "_aw_s").withColumn("_aw_bucket", F.pmod("_aw_h", "_aw_k")).drop("_aw_k")
    sizes = stored(rows.groupBy("_aw_s", "_aw_bucket").agg(F.count(F.lit(1)).alias("_aw_n")).withColumn("_aw_range", F.floor(F.col("_aw_bucket") / GROUPS)), "groups")
    running = lambda by, order: F.sum("_aw_n").over(W.partitionBy(*by).orderBy(order)) - F.col("_aw_n")
    ranges = sizes.groupBy("_aw_s", "_aw_range").agg(F.sum("_aw_n").alias("_aw_n")).withColumn("_aw_base", running(["_aw_s"], "_aw_range")).drop("_aw_n")
    before = sizes.withColumn("_aw_inner", running(["_aw_s", "_aw_range"], "_aw_bucket")).join(ranges, ["_aw_s", "_aw_range"])
    before = before.select("_aw_s", "_aw_bucket", "_aw_n", (F.col("_aw_base") + F.col("_aw_inner")).alias("_aw_before"))
    # the slots of a group's blocks come with the group, so that rows move no further
    spans = before.withColumn("_aw_block", F.explode(F.sequence(F.floor(F.col("_aw_before") / block_docs), F.floor((F.col("_aw_before") + F.col("_aw_n") - 1) / block_docs))))
    plan = phases(blocks, target, periods)
    spans = _timed(spans, plan) if plan is not None else spans.join(_slots(spark, blocks, target), ["_aw_s", "_aw_block"])
    places = spans.groupBy("_aw_s", "_aw_bucket", "_aw_before").agg(F.array_sort(F.collect_list(F.struct("_aw_block", "_aw_slot"))).alias("_aw_slots"))
    places = stored(places.withColumn("_aw_slots", F.col("_aw_slots._aw_slot")), "places")
    rows = rows.withColumn("_aw_rank", F.row_number().over(W.partitionBy("_aw_s", "_aw_bucket").orderBy("_aw_h")) - 1).join(places, ["_aw_s", "_aw_bucket"])
    rows = rows.withColumn("_aw_at", F.col("_aw_before") + F.col("_aw_rank")).withColumn("mix_block", F.floor(F.col("_aw_at") / block_docs))
    rows = rows.withColumn("mix_slot", F.get("_aw_slots", (F.col("mix_block") - F.floor(F.col("_aw_before") / block_docs)).cast("int")))
    return rows.select(*(c for c in docs.columns if c not in RESULTS), "mix_block", "mix_slot", (F.col("mix_slot") * block_docs + F.pmod("_aw_at", F.lit(block_docs))).alias("mix_position"))
