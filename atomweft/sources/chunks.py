"""Rows of cache chunks, read by the tasks that hold the wanted keys: the driver sees neither chunks nor their files.

A chunk is a file, or a folder of files, of bounded size. The index tells the chunk of each key, so only these are opened; within a Parquet file only
row groups whose key range holds a wanted key are read.
"""

from __future__ import annotations

import bisect
import json
import os
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pcsv
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from atomweft.schema import RESULTS_TYPES

KEY, PLACE = "frame_cache_key", "_row"
#: What a file that is missing, cut off or of another format raises; it has no rows then.
BROKEN = (OSError, pa.ArrowInvalid, pa.ArrowNotImplementedError, ValueError)


def chunk_files(path: str) -> list[str]:
    """The data files of a chunk in order; none if it is gone."""
    try:
        return [os.path.join(path, name) for name in sorted(os.listdir(path)) if name[0] not in "._"]
    except NotADirectoryError:
        return [path]
    except OSError:
        return []


def csv_rules() -> pcsv.ParseOptions:
    """How Spark writes cells, and that lines with a wrong number of cells are passed over."""
    return pcsv.ParseOptions(newlines_in_values=True, escape_char="\\", invalid_row_handler=lambda row: "skip")


def csv_header(path: str) -> list[str]:
    with pcsv.open_csv(path, parse_options=csv_rules()) as rows:
        return rows.schema.names


def file_columns(path: str, form: str) -> list[list[str]]:
    """Name and type of the columns of a file; [] if it is broken or has no keys."""
    try:
        if form == "parquet":
            found = [[f.name, str(f.type)] for f in pq.read_schema(path)]
        else:
            found = [[name, "string"] for name in csv_header(path)]
    except BROKEN:
        return []
    return found if any(name == KEY for name, _ in found) else []


def matching_groups(file: pq.ParquetFile, keys: list[str]) -> list[int]:
    """Row groups of a file that can hold one of the sorted ``keys``, by their statistics."""

    def may_hold(group) -> bool:
        stats = next((c.statistics for i in range(group.num_columns) if (c := group.column(i)).path_in_schema == KEY), None)
        if stats is None or not stats.has_min_max:
            return True
        at = bisect.bisect_left(keys, stats.min)
        return at < len(keys) and keys[at] <= stats.max

    return [g for g in range(file.num_row_groups) if may_hold(file.metadata.row_group(g))]


def file_batches(path: str, form: str, keys: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of a file that have one of the sorted ``keys``, in their order; CSV cells are text, empty ones null."""
    if form == "parquet":
        with pq.ParquetFile(path) as file:
            batches = file.iter_batches(row_groups=groups) if (groups := matching_groups(file, keys)) else ()
            for batch in batches:
                yield batch.filter(pc.is_in(batch.column(KEY), pa.array(keys, batch.schema.field(KEY).type)))
        return
    types = pcsv.ConvertOptions(column_types=dict.fromkeys(csv_header(path), pa.string()), strings_can_be_null=True, quoted_strings_can_be_null=True, null_values=[""])
    with pcsv.open_csv(path, parse_options=csv_rules(), convert_options=types) as rows:
        for batch in rows:
            yield batch.filter(pc.is_in(batch.column(KEY), pa.array(keys)))


def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, form in zip(batch.column("chunk_path").to_pylist(), batch.column("output_format").to_pylist()):
            found = [(form, json.dumps(columns), file) for file in chunk_files(path) if (columns := file_columns(file, form))]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*found)], ["output_format", "columns", "file"])


def _reader(schema: pa.Schema, form: str):
    """Turns rows (frame_cache_key, chunk_path) that are sorted by chunk into the rows of these keys, with their place in the chunk."""

    def aligned(batch: pa.RecordBatch, start: int) -> pa.RecordBatch:
        columns = [batch.column(f.name).cast(f.type) if f.name in batch.schema.names else pa.nulls(len(batch), f.type) for f in schema if f.name != PLACE]
        return pa.RecordBatch.from_arrays([*columns, pa.array(range(start, start + len(batch)), pa.int64())], schema=schema)

    def chunk(path: str | None, keys: list[str]) -> Iterator[pa.RecordBatch]:
        place, keys = 0, sorted(keys)
        for file in chunk_files(path) if path is not None else ():
            try:
                for batch in file_batches(file, form, keys) if file_columns(file, form) else ():
                    if len(batch):
                        yield aligned(batch, place)
                        place += len(batch)
            except BROKEN:
                continue

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, keys = None, []
        for batch in batches:
            for key, at in zip(batch.column(KEY).to_pylist(), batch.column("chunk_path").to_pylist()):
                if at != path:
                    yield from chunk(path, keys)
                    path, keys = at, []
                keys.append(key)
        yield from chunk(path, keys)

    return run


def read_chunks(wanted: DataFrame) -> list[DataFrame]:
    """Rows of the ``wanted`` keys (frame_cache_key, chunk_path, output_format), for each format under the merged schema of its files, with ``_row``, the
    order within a chunk.

    Give ``wanted`` as written rows: it is read twice. Tasks first tell the distinct column lists, of which the driver sees one file each, then
    read. Columns that files do not have are null; files that are gone, broken or without keys have no rows. Types that cannot be merged are an error.
    CSV cells get the types of result tables; what is not of the type is null.
    """
    spark, parts = wanted.sparkSession, []
    chunks = wanted.select("chunk_path", "output_format").distinct()
    shapes = chunks.mapInArrow(_shapes, "output_format string, columns string, file string").groupBy("output_format", "columns").agg(F.min("file").alias("file")).collect()
    for form in sorted({s.output_format for s in shapes}):
        found = sorted((s for s in shapes if s.output_format == form), key=lambda s: s.file)
        if form == "parquet":
            fields = list(spark.read.option("mergeSchema", True).parquet(*(s.file for s in found)).schema)
        else:
            fields = [StructField(n, StringType()) for n in dict.fromkeys(n for s in found for n, _ in json.loads(s.columns))]
        schema = StructType([*(f for f in fields if f.name != PLACE), StructField(PLACE, LongType())])
        keys = wanted.where(F.col("output_format") == form).select(KEY, "chunk_path").repartition("chunk_path").sortWithinPartitions("chunk_path")
        rows = keys.mapInArrow(_reader(to_arrow_schema(schema), form), schema)
        if form != "parquet":
            kinds = {n: RESULTS_TYPES.get(n, "double" if n in "xyz" or n.startswith("cs_") else "string") for n in schema.names if n != PLACE}
            rows = rows.select(*(F.col(n).try_cast(kind).alias(n) for n, kind in kinds.items()), PLACE)
        parts.append(rows)
    return parts
