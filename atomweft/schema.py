"""Schemas of frames, results and the index log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA_VERSION = "1"

ID_COLUMNS = ["structure_id", "source_file", "frame", "atom_i", "element", "x", "y", "z"]
AXES = ["xx", "xy", "xz", "yy", "yz", "zz"]
TENSOR_COLUMNS = [f"cs_{a}" for a in AXES]

FRAMES = (
    "frame_ord bigint, source_file string, frame bigint, structure_id string, normalized_cell_pbc boolean, numbers array<int>, "
    "element array<string>, positions array<struct<x: double, y: double, z: double>>, cell array<double>, pbc array<int>"
)
RESULTS_TYPES = {"structure_id": "string", "source_file": "string", "frame": "bigint", "atom_i": "bigint", "element": "string", "frame_cache_key": "string"}
INDEX = "cache_key string, chunk_path string, model_name string, model_version string, output_format string, schema_version string, seq bigint, writer_id string, written_at_utc string"


def measures(property_mode: str, committee: bool) -> list[str]:
    """The prediction columns of a mode, in their fixed order."""
    tensor = TENSOR_COLUMNS if property_mode in ("tensor", "both") else []
    return ["cs_iso", *(["cs_iso_uncertainty"] if committee else []), *tensor, *([f"{c}_uncertainty" for c in tensor] if committee else [])]


def required_columns(property_mode: str, committee: bool) -> list[str]:
    return [*ID_COLUMNS, *measures(property_mode, committee)]


def fill_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with every absent column appended as null doubles, in the given order."""
    return df.withColumns({c: F.lit(None).cast("double") for c in columns if c not in df.columns})


def measure_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("cs_")]
