"""XYZ trajectories of any length: a file is read in byte ranges by many tasks.

Spark deals the lines of a file over tasks by byte ranges (blocks). A line that is a single whole number starts a frame if the line before is
not one; so each task finds the first sure start in its block and reads frame by frame from there. What is left over, the lines before that start
and the frame that the block's end cuts, is less than a frame a block and is put together by file. Running sums of the numbers of frames over the
blocks number the frames; a selector is arithmetic on these numbers.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

Parser = Callable[[str], Iterator[dict]]
_LONE = re.compile(rb"\s*[+-]?\d+\s*$")
BATCH = 500
OUTLINE = "source_file string, block bigint, started boolean, n bigint, head binary, tail binary, error string"
FRAME = "numbers array<int>, element array<string>, positions array<double>, cell array<double>, pbc array<int>"
NUMBERED = f"source_file string, block bigint, ord bigint, {FRAME}, error string"
NO_FRAME = dict.fromkeys(x.split()[0] for x in NUMBERED.split(", ")) | {"ord": 0}


def cut_frames(lines: Iterator[bytes], first: bool) -> Iterator[tuple[str, list[bytes]]]:
    """The lines of a block as ("head", those before the first sure start), ("frame", those of a whole frame) again and again, ("tail", the rest).

    ``first`` says that the block is a file's first. If no start is sure, all lines are the head and there is no tail.
    """
    held: list[bytes] = []
    lone, started = True, first  # of what is before a block nothing is known
    if not first:
        for line in lines:
            before, lone = lone, bool(_LONE.match(line))
            if lone and not before:
                lines, started = itertools.chain([line], lines), True
                break
            held.append(line)
    yield "head", held
    if not started:
        return
    held, need = [], 0
    for line in lines:
        if not held:
            if not line.strip():
                continue
            need = int(line) + 2
            if need < 2:
                raise ValueError(f"{need - 2} atoms are announced")
        held.append(line)
        if len(held) == need:
            yield "frame", held
            held = []
    yield "tail", held


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, int, Iterator[bytes]]]:
    rows = itertools.chain.from_iterable(zip(b["source_file"], b["block"], b["line"]) for b in batches)
    for (path, block), own in itertools.groupby(rows, lambda r: r[:2]):
        yield path, int(block), (r[2] for r in own)


def _text(lines: list[bytes]) -> bytes:
    return b"".join(bytes(x) + b"\n" for x in lines)


def _failed(path: str, e: Exception) -> str:
    return f"structures cannot be read from {path}: {type(e).__name__} {e}"


def _outline(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row for each block: its number of whole frames and what is left over."""
    for path, block, lines in _blocks(batches):
        row = {"source_file": path, "block": block, "started": False, "n": 0, "head": b"", "tail": b"", "error": None}
        try:
            for kind, part in cut_frames(lines, block == 0):
                if kind == "frame":
                    row["n"] += 1
                else:
                    row[kind] = _text(part)
                    row["started"] |= kind == "tail"
        except Exception as e:
            row["error"] = _failed(path, e)
            for _ in lines:
                pass
        yield pd.DataFrame([row])


def _numbered(rows: Iterator[dict]) -> Iterator[pd.DataFrame]:
    while part := list(itertools.islice(rows, BATCH)):
        yield pd.DataFrame(part, columns=[*NO_FRAME])


def _inner(parse: Parser) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[dict]:
        for path, block, lines in _blocks(batches):
            at = 0
            try:
                for kind, part in cut_frames(lines, block == 0):
                    if kind == "frame":
                        (frame,) = parse(_text(part).decode())
                        yield {"source_file": path, "block": block, "ord": at, **frame, "error": None}
                        at += 1
            except Exception as e:
                yield NO_FRAME | {"source_file": path, "block": block, "error": _failed(path, e)}
                for _ in lines:
                    pass

    return lambda batches: _numbered(rows(batches))


def _joined(parse: Parser) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """The frames that blocks have cut, put together; they come before the whole frames of their block, at the end of a file after its last."""

    def rows(pdf: pd.DataFrame) -> Iterator[dict]:
        held = b""
        last = pd.DataFrame([{"source_file": pdf["source_file"].iloc[0], "block": int(pdf["block"].max()) + 1, "started": True, "head": b"", "tail": b""}])
        for r in pd.concat([pdf[last.columns].sort_values("block"), last]).itertuples():
            held += bytes(r.head)
            if r.started:
                try:
                    for at, frame in enumerate(parse(held.decode())):
                        yield {"source_file": r.source_file, "block": r.block, "ord": at, **frame, "error": None}
                except Exception as e:
                    yield NO_FRAME | {"source_file": r.source_file, "block": r.block, "error": _failed(r.source_file, e)}
                held = bytes(r.tail)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(list(rows(pdf)), columns=[*NO_FRAME])

    return run


def place(selector: slice | int, frame: Column, n: Column) -> Column:
    """The place of ``frame`` among the chosen ones of ``n`` frames, null if it is not chosen."""
    if isinstance(selector, int):
        return F.when(frame == (n + selector if selector < 0 else F.lit(selector)), F.lit(0).cast("bigint"))
    step = 1 if selector.step is None else selector.step
    low, high = (F.lit(0), n) if step > 0 else (F.lit(-1), n - 1)

    def bound(value: int | None, default: Column) -> Column:
        if value is None:
            return default
        return F.least(F.lit(value), high) if value >= 0 else F.greatest(n + value, low)

    start, stop = bound(selector.start, low if step > 0 else high), bound(selector.stop, high if step > 0 else low)
    far = (frame - start) * (1 if step > 0 else -1)
    inside = (frame < stop) if step > 0 else (frame > stop)
    return F.when((far >= 0) & inside & (far % abs(step) == 0), F.floor(far / abs(step)))


def scan_xyz(spark: SparkSession, files: list[str], selector: slice | int, parse: Parser) -> DataFrame:
    """(source_file, n_frames, frame, at, numbers, element, positions, cell, pbc, error): the chosen frames, and a row with ``error`` for a file that
    cannot be read, has no frames or lacks the one chosen."""
    path = F.regexp_replace(F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "/"), "%20", " ")
    lines = spark.read.text(files).select(path.alias("source_file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line"))
    outline = lines.mapInPandas(_outline, OUTLINE).persist()  # less than a frame for each block
    joined = outline.where("error IS NULL").groupBy("source_file").applyInPandas(_joined(parse), NUMBERED).persist()
    counts = outline.select("source_file", "block", "n", F.lit(0).cast("bigint").alias("cut")).unionAll(joined.where("error IS NULL").groupBy("source_file", "block").agg(F.lit(0).cast("bigint").alias("n"), F.count(F.lit(1)).alias("cut")))
    counts = counts.groupBy("source_file", "block").agg(F.sum("n").alias("n"), F.sum("cut").alias("cut"))
    file = W.partitionBy("source_file")
    counts = counts.select("source_file", "block", "cut", (F.sum(F.col("n") + F.col("cut")).over(file.orderBy("block")) - F.col("n") - F.col("cut")).alias("before"), F.sum(F.col("n") + F.col("cut")).over(file).alias("n_frames"))
    inner = lines.mapInPandas(_inner(parse), NUMBERED).join(counts, ["source_file", "block"]).withColumn("frame", F.col("before") + F.col("cut") + F.col("ord"))
    outer = joined.join(counts, ["source_file", "block"]).withColumn("frame", F.col("before") + F.col("ord"))
    every = inner.unionAll(outer).withColumn("at", place(selector, F.col("frame"), F.col("n_frames")))
    names = ["source_file", "n_frames", "frame", "at", *(x.split()[0] for x in FRAME.split(", ")), "error"]
    chosen = every.where("error IS NULL AND at IS NOT NULL").select(names)
    given = spark.createDataFrame([(f,) for f in files], "source_file string").join(counts.select("source_file", "n_frames").distinct(), "source_file", "left")
    lacks = F.when(F.coalesce("n_frames", F.lit(0)) == 0, F.concat(F.lit("the file has no frames: "), "source_file"))
    if isinstance(selector, int):
        lacks = lacks.when(~F.lit(selector).between(-F.col("n_frames"), F.col("n_frames") - 1), F.concat(F.lit(f"frame {selector} is out of bounds for "), F.col("n_frames").cast("string"), F.lit(" frames")))
    errors = outline.select("source_file", "error").unionAll(joined.select("source_file", "error")).unionAll(every.select("source_file", "error")).where("error IS NOT NULL")
    errors = errors.unionAll(given.join(errors.select("source_file"), "source_file", "left_anti").select("source_file", lacks.alias("error"))).where("error IS NOT NULL")
    errors = errors.groupBy("source_file").agg(F.min("error").alias("error"))
    kinds = dict(chosen.dtypes)
    return chosen.unionAll(errors.select("source_file", *(F.lit(None).cast(kinds[c]).alias(c) for c in names[1:-1]), "error"))
