"""The cache store: immutable chunks, and one append-only index log per writer."""

from __future__ import annotations

import json
import os
import secrets
import shutil
import socket
from collections.abc import Callable
from datetime import UTC, datetime
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atomweft.functions.columns import index_payload
from atomweft.operators.cache import canonical, compacted, manifest
from atomweft.operators.packing import pack_all
from atomweft.schema import INDEX
from atomweft.sinks import write_lines, write_text
from atomweft.sources.chunks import read_chunks
from atomweft.sources.index_log import parse_records, read_index, read_lines
from atomweft.work import Workspace

FIELDS = [x.split()[0] for x in INDEX.split(", ")]


def now_utc() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def index_files(index_dir: Path) -> list[str]:
    return sorted(str(p) for p in Path(index_dir).glob("index_*.jsonl"))


#: Bytes of index lines outside the snapshot from which a store renews it, if they also are half of those in it: so all renewals together write a
#: small multiple of the log.
SNAPSHOT_BYTES = 64 << 20


def _snapshots(index_dir: Path) -> list[Path]:
    return sorted(Path(index_dir).glob(".snapshot_*"))


def log_parts(index_dir: Path) -> tuple[Path | None, list[str], int]:
    """(newest snapshot that holds, index files to replay after it, bytes that it covers).

    A snapshot names the index files that it was made of, with their sizes. It holds while each of them is there and has not shrunk. Files that it does not
    know or that have grown since are replayed whole: the latest record is a maximum, to which a record may be added twice.
    """
    sizes = {p: os.path.getsize(p) for p in index_files(index_dir)}
    for snapshot in reversed(_snapshots(index_dir)):
        try:
            covered = {str(Path(index_dir) / name): size for name, size in json.loads((snapshot / "files.json").read_text()).items()}
        except (OSError, ValueError):
            continue
        if all(sizes.get(p, -1) >= size for p, size in covered.items()):
            return snapshot, [p for p, size in sizes.items() if covered.get(p) != size], sum(covered.values())
    return None, list(sizes), 0


def log_records(spark: SparkSession, index_dir: Path) -> DataFrame:
    """Records from which the latest ones follow: those of the snapshot and of the files after it."""
    snapshot, files, _ = log_parts(index_dir)
    tail = read_index(spark, files) if files else parse_records(spark.createDataFrame([], "index_path string, line_no bigint, line string"))
    return tail if snapshot is None else spark.read.schema(tail.schema).parquet(str(snapshot / "records")).unionByName(tail)


def snapshot_index(spark: SparkSession, cache_dir: str | Path) -> Path:
    """Writes the latest record of each key and format as a new snapshot, sorted by key, from the one before and the files after it.

    It appears in one step. The snapshot before stays for those who read it; older ones are removed.
    """
    index_dir = Path(cache_dir) / "index"
    index_dir.mkdir(parents=True, exist_ok=True)
    before = _snapshots(index_dir)
    sizes = {os.path.basename(p): os.path.getsize(p) for p in index_files(index_dir)}
    number = int(before[-1].name.split("_")[1]) + 1 if before else 0
    target = index_dir / f".snapshot_{number:08d}_{secrets.token_hex(4)}"
    staging = index_dir / f".staging_{target.name[1:]}"
    compacted(log_records(spark, index_dir)).orderBy("cache_key", "output_format").write.parquet(str(staging / "records"))
    write_text(staging / "files.json", json.dumps(sizes, sort_keys=True))
    os.replace(staging, target)
    for old in before[:-1]:
        shutil.rmtree(old, ignore_errors=True)
    return target


def publish_lines(lines: DataFrame, index_dir: Path, stem: str) -> list[str]:
    """Writes text lines by Spark beside the index and moves each part to ``<stem>[_k].jsonl`` in one step."""
    staging = Path(index_dir) / f".{stem}-{secrets.token_hex(4)}"
    lines.write.text(str(staging))
    out = []
    for k, part in enumerate(sorted(p for p in staging.glob("part-*") if p.stat().st_size)):
        target = Path(index_dir) / f"{stem}{f'_{k}' if k else ''}.jsonl"
        with part.open("rb") as f:
            os.fsync(f.fileno())
        os.replace(part, target)
        out.append(str(target))
    shutil.rmtree(staging)
    return out


class CacheStore:
    """Looks up and stores result rows by ``frame_cache_key`` in a directory that several writers may share."""

    def __init__(self, spark: SparkSession, cache_dir: str | Path, output_format: str = "parquet", model_name: str | None = None, model_version: str | None = None, schema_version: str | None = None):
        self.spark, self.cache_dir, self.output_format = spark, Path(cache_dir), output_format
        self.model = {"model_name": model_name, "model_version": model_version, "schema_version": schema_version}
        self.writer_id = f"{socket.gethostname()}-{os.getpid()}-{secrets.token_hex(3)}"
        self.chunk_dir, self.index_dir = self.cache_dir / "chunks", self.cache_dir / "index"
        self.chunk_dir.mkdir(parents=True, exist_ok=True)
        self.index_dir.mkdir(parents=True, exist_ok=True)
        self._stores = self._lines = 0
        self._manifest: DataFrame | None = None

    def manifest(self) -> DataFrame:
        """One record for each key; kept until the next store."""
        if self._manifest is None:
            self._manifest = manifest(log_records(self.spark, self.index_dir), self.output_format).persist()
        return self._manifest

    def wanted(self, keys: DataFrame) -> DataFrame:
        """(frame_cache_key, chunk_path, output_format) of the keys that the index knows."""
        known = self.manifest().select(F.col("cache_key").alias("frame_cache_key"), "chunk_path", "output_format")
        return keys.select("frame_cache_key").distinct().join(known, "frame_cache_key")

    def lookup(self, keys: DataFrame, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame | None:
        """Cached rows of the keys (frame_cache_key) with their order ``_row``, or None. Only chunks that a key points to are opened, by the tasks.

        A key whose chunk is gone or unreadable has no rows, even if an older record has. ``keep`` may write the wanted keys, which are read twice.
        """
        parts = read_chunks(keep(self.wanted(keys)))
        if not parts:
            return None
        found = parts[0]
        for part in parts[1:]:
            found = found.unionByName(part, allowMissingColumns=True)
        return found

    def store(self, rows: DataFrame, chunk_size: int = 200, max_chunk_mb: float = 100.0, order: list[str] | None = None) -> int:
        """Writes result rows as chunks of whole frames, then their index lines; the number of chunks.

        Frames are packed greedily over all of them, by the least values of the ``order`` columns in each and then by key: ``chunk_size`` frames or
        ``max_chunk_mb`` of row data a chunk. Lines are numbered in that order.
        """
        if "frame_cache_key" not in rows.columns:
            raise ValueError("rows to store need a frame_cache_key")
        with Workspace(self.spark, self.cache_dir) as work:
            rows = work.keep(rows.where(F.col("frame_cache_key").isNotNull()))
            width = sum(F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 8 for c in rows.columns)
            first = [F.min(F.struct(*order)).alias("first")] if order else []
            sizes = rows.groupBy("frame_cache_key").agg(F.sum(width).cast("bigint").alias("bytes"), *first)
            sizes = sizes.select("frame_cache_key", "bytes", *(F.col(f"first.{c}").alias(f"order_{i}") for i, c in enumerate(order or ())))
            packed = pack_all(sizes, [*sizes.columns[2:], "frame_cache_key"], chunk_size, int(max_chunk_mb * (1 << 20)), work)
            packed, seen = work.keep(packed.select("frame_cache_key", "place", "chunk_no"), n=F.count(F.lit(1)), last=F.max("chunk_no"))
            if not seen["n"]:
                return 0
            self._stores += 1
            chunk = F.format_string("%09d", "chunk_no")
            target = self.chunk_dir / f"chunk_{self.writer_id}_{self._stores:06d}"
            staging = target.with_name(f".{target.name}")
            writer = rows.join(packed.select("frame_cache_key", chunk.alias("chunk")), "frame_cache_key").repartition("chunk").sortWithinPartitions("chunk", "frame_cache_key", "atom_i").write.partitionBy("chunk")
            writer.parquet(str(staging)) if self.output_format == "parquet" else writer.option("header", True).csv(str(staging))
            os.replace(staging, target)
            lines = packed.withColumns({
                "cache_key": F.col("frame_cache_key"), "chunk_path": F.concat(F.lit(f"{target}/chunk="), chunk), "output_format": F.lit(self.output_format), "writer_id": F.lit(self.writer_id),
                "seq": F.col("place") + F.lit(self._lines + 1), "written_at_utc": F.lit(now_utc()), **{k: F.lit(v).cast("string") for k, v in self.model.items()},
            }).select(index_payload(*FIELDS).alias("value"))
            publish_lines(lines, self.index_dir, f"index_{self.writer_id}_{self._stores:06d}")
        _, files, covered = log_parts(self.index_dir)
        if sum(os.path.getsize(f) for f in files) >= max(SNAPSHOT_BYTES, covered // 2):
            snapshot_index(self.spark, self.cache_dir)
        self._lines += seen["n"]
        if self._manifest is not None:
            self._manifest.unpersist()
        self._manifest = None
        return seen["last"] + 1


def prepare_rows(rows: DataFrame, order) -> DataFrame:
    """Rows to store: canonical ones for each key; keys with an atom_i that is not whole stay as they are."""
    good = canonical(rows, "frame_cache_key", order)
    rest = rows.join(good.select("frame_cache_key").distinct(), "frame_cache_key", "left_anti").where(F.col("frame_cache_key").isNotNull())
    return good.unionByName(rest.withColumn("atom_i", number_or_null("atom_i")), allowMissingColumns=True)


def number_or_null(name: str):
    return F.col(name).try_cast("bigint")


def compact_index(spark: SparkSession, cache_dir: str | Path, remove_source_indexes: bool = False) -> dict[str, Any]:
    """Writes the latest record of each key and format as a new index file, sorted by many tasks; optionally removes the files it was read from."""
    index_dir = Path(cache_dir) / "index"
    index_dir.mkdir(parents=True, exist_ok=True)
    sources = index_files(index_dir)
    stem = f"index_compacted_{now_utc().replace('-', '').replace(':', '')}_{secrets.token_hex(2)}"
    target, scanned, kept = index_dir / f"{stem}.jsonl", 0, 0
    if sources:
        records = parse_records(read_lines(spark, sources)).persist()
        scanned = records.count()
        best = compacted(records).persist()
        kept = best.count()
        if kept:
            write_lines(best.orderBy("cache_key", "output_format").select(index_payload(*FIELDS).alias("value")), target)
        records.unpersist()
        best.unpersist()
    if not kept:
        target.touch()
    removed = 0
    if remove_source_indexes:
        for path in sources:
            try:
                os.unlink(path)
                removed += 1
            except OSError:
                continue
    return {"cache_dir": str(cache_dir), "index_dir": str(index_dir), "source_index_files": sources, "compacted_index_file": str(target), "scanned_records": scanned, "kept_records": kept, "removed_source_index_files": removed}
