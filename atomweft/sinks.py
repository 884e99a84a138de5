"""Single-file tables published in one step, JSON documents, and magres text.

A single file is still written by many tasks: they write sorted parts, running sums of the parts' sizes give each its place in the file, and tasks
copy them there. Only names and sizes of parts reach the driver. Targets lie in a file system that all machines have mounted.
"""

from __future__ import annotations

import csv
import io
import itertools
import os
import secrets
import shutil
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atomweft.errors import ConfigError
from atomweft.schema import TENSOR_COLUMNS

COPY_BYTES = 8 << 20


def concatenate(spark: SparkSession, parts: list[Path], target: Path, head: bytes = b"", cut: int = 0, tail: bytes = b"") -> None:
    """``head``, the bytes of ``parts`` in order but for the last ``cut``, and ``tail`` as one file that appears in one step; tasks copy the parts side by side."""
    sizes = [p.stat().st_size for p in parts]
    places = list(itertools.accumulate(sizes, initial=len(head)))
    staging = target.with_name(f".{target.name}.tmp-{secrets.token_hex(4)}")
    with staging.open("wb") as f:
        f.write(head)
        f.truncate(places[-1])
    at = str(staging)

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, place in zip(batch["part"], batch["place"].tolist()):
                with open(part, "rb") as source, open(at, "r+b") as f:
                    f.seek(place)
                    shutil.copyfileobj(source, f, COPY_BYTES)
                    f.flush()
                    os.fsync(f.fileno())
                    yield pd.DataFrame({"end": [f.tell()]})

    if parts:
        rows = spark.createDataFrame([(str(p), n) for p, n in zip(parts, places)], "part string, place bigint")
        copied = rows.repartitionByRange(len(parts), "place").mapInPandas(copy, "end bigint").agg(F.max("end"), F.count(F.lit(1))).first()
        if tuple(copied) != (places[-1], len(parts)):
            raise OSError(f"the parts of {target} were not copied whole")
    os.truncate(staging, places[-1] - cut if parts else places[-1])
    with staging.open("ab") as f:
        f.write(tail)
    os.replace(staging, target)


def _one_parquet(spark: SparkSession, parts: list[Path], target: Path) -> None:
    """One Parquet file of the row groups of ``parts`` in order, copied as a stream by one task: row groups cannot be moved as bytes, as a file's
    footer has their places. A single part is moved as it is."""
    if len(parts) == 1:
        os.replace(parts[0], target)
        return
    staging, names = str(target.with_name(f".{target.name}.tmp-{secrets.token_hex(4)}")), [str(p) for p in parts]

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq

        for batch in batches:
            with pq.ParquetWriter(staging, pq.read_schema(names[0])) as writer:
                for name in names:
                    with pq.ParquetFile(name) as source:
                        for k in range(source.num_row_groups):
                            writer.write_table(source.read_row_group(k))
            yield batch

    spark.range(1).mapInPandas(copy, "id bigint").count()
    os.replace(staging, target)


def write_table(df: DataFrame, path: str | Path, output_format: str, order: list[str] | None = None, single_file: bool = True) -> Path:
    """Writes ``df`` in order as one file that appears in one step; with ``single_file=False`` as a range-sorted directory, for large tables.

    Rows are sorted and written by many tasks in both cases. CSV has a header, empty cells for null, and ``inf`` as text.
    """
    if output_format not in ("csv", "parquet"):
        raise ValueError(f"not an output format: {output_format}")
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    staging = path.with_name(f".{path.name}.tmp-{secrets.token_hex(4)}")
    ordered = df.orderBy(*order) if order else df
    if output_format == "csv":
        text = lambda c: F.when(F.isnan(c), None).when(F.col(c) == float("inf"), "inf").when(F.col(c) == float("-inf"), "-inf").otherwise(F.col(c).cast("string")).alias(c)
        kinds = dict(df.dtypes)
        ordered = ordered.select(*(text(c) if kinds[c] == "double" else F.col(c) for c in df.columns))
        ordered.write.option("header", not single_file).csv(str(staging))
    else:
        ordered.write.parquet(str(staging))
    if not single_file:
        if path.exists():
            raise ConfigError(f"the output exists: {path}")
        os.replace(staging, path)
        return path
    parts = sorted(p for p in staging.glob("part-*") if p.stat().st_size)
    if output_format == "csv":
        head = io.StringIO()
        csv.writer(head, lineterminator="\n").writerow(df.columns)
        concatenate(df.sparkSession, parts, path, head.getvalue().encode())
    else:
        _one_parquet(df.sparkSession, parts, path)
    shutil.rmtree(staging)
    return path


def write_lines(lines: DataFrame, target: str | Path, cut: int = 0, head: bytes = b"", tail: bytes = b"") -> Path:
    """The one text column of ``lines`` as one file in their order, each with a line feed after it, between ``head`` and ``tail``; of the lines' end ``cut``
    bytes are left out."""
    target = Path(target)
    staging = target.with_name(f".{target.name}.parts-{secrets.token_hex(4)}")
    lines.write.text(str(staging))
    concatenate(lines.sparkSession, sorted(p for p in staging.glob("part-*") if p.stat().st_size), target, head, cut, tail)
    shutil.rmtree(staging)
    return target


def write_text(path: str | Path, text: str) -> None:
    """Writes a text file through a synced temporary file, so that readers see the old or the new one."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    staging = path.with_name(f".{path.name}.tmp-{secrets.token_hex(4)}")
    with staging.open("w", encoding="utf-8") as f:
        f.write(text)
        f.flush()
        os.fsync(f.fileno())
    os.replace(staging, path)


def magres_block(rows: pd.DataFrame, tensor: bool) -> str:
    """One frame's text. ``rows`` are its atoms; cell and pbc are null without metadata. Numbers have eight decimals."""
    rows = rows.sort_values("atom_i", kind="stable")
    f8 = lambda *xs: " ".join(f"{float('nan') if x is None else x:.8f}" for x in xs)
    out = ["#$magres-abinitio-v1.0", "[atoms]"]
    cell, pbc = rows["cell"].iloc[0], rows["pbc"].iloc[0]
    if cell is not None and len(cell) == 9:
        out += ["units lattice Angstrom", f"lattice {f8(*cell)}", f"# pbc {pbc[0]} {pbc[1]} {pbc[2]}"]
    out.append("units atom Angstrom")
    out += [f"atom {e} {e}{i + 1} {i + 1} {f8(x, y, z)}" for i, e, x, y, z in zip(rows["atom_i"], rows["element"], rows["x"], rows["y"], rows["z"])]
    out += ["[/atoms]", "[magres]", "units ms ppm"]
    tensors = zip(*(rows[c] for c in TENSOR_COLUMNS)) if tensor else ((iso, 0.0, 0.0, iso, 0.0, iso) for iso in rows["cs_iso"])
    for i, e, (xx, xy, xz, yy, yz, zz) in zip(rows["atom_i"], rows["element"], tensors):
        out.append(f"ms {e} {i + 1} {f8(xx, xy, xz, xy, yy, yz, xz, yz, zz)}")
    return "\n".join([*out, "[/magres]"]) + "\n"


def magres_blocks(results: DataFrame, frames: DataFrame | None = None) -> DataFrame:
    """(structure_id, frame, text) per frame of the results. The cell comes from ``frames``; of equal frames the last loaded counts."""
    tensor = set(TENSOR_COLUMNS) <= set(results.columns)
    columns = ["structure_id", "frame", "atom_i", "element", "x", "y", "z", "cs_iso", *(TENSOR_COLUMNS if tensor else [])]
    rows = results.select(*columns)
    if frames is None:
        rows = rows.withColumns({"cell": F.lit(None).cast("array<double>"), "pbc": F.lit(None).cast("array<int>")})
    else:
        info = frames.groupBy("structure_id", "frame").agg(F.max_by(F.struct("cell", "pbc"), "frame_ord").alias("m")).select("structure_id", "frame", "m.*")
        rows = rows.join(info, ["structure_id", "frame"], "left")

    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"structure_id": [pdf["structure_id"].iloc[0]], "frame": [pdf["frame"].iloc[0]], "text": [magres_block(pdf, tensor)]})

    return rows.groupBy("structure_id", "frame").applyInPandas(block, "structure_id string, frame bigint, text string")


def write_magres(results: DataFrame, outdir: str | Path, mode: str, frames: DataFrame | None = None) -> list[Path]:
    """``none``; ``per-frame`` files under magres/, written by the tasks; or ``single``, one file of all blocks in order, a blank line between them.
    Gives the file or the folder."""
    if mode == "none":
        return []
    if mode not in ("per-frame", "single"):
        raise ValueError(f"not a magres mode: {mode}")
    outdir = Path(outdir)
    outdir.mkdir(parents=True, exist_ok=True)
    blocks = magres_blocks(results, frames)
    if mode == "single":
        return [write_lines(blocks.orderBy("structure_id", "frame").select("text"), outdir / "predictions.magres", cut=1)]
    folder = outdir / "magres"
    folder.mkdir(parents=True, exist_ok=True)
    at = str(folder)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for structure, frame, text in zip(batch["structure_id"], batch["frame"], batch["text"]):
                write_text(f"{at}/{structure}_f{frame}.magres", text)
            yield pd.DataFrame({"n": [len(batch)]})

    blocks.mapInPandas(write, "n bigint").agg(F.sum("n")).first()
    return [folder]
