"""Column functions of the engine. All run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from atomweft.schema import AXES

#: The elements that predictions are defined for.
SUPPORTED_ELEMENTS = ["H", "C", "N", "O", "F", "P", "S", "Cl", "Br", "I"]
TOLERANCE = 1e-8
#: Places of the upper triangle in a row-major 3 x 3 array, from 1.
UPPER = dict(zip(AXES, (1, 2, 3, 5, 6, 9)))


def number(col: Column) -> Column:
    """A double; text that is not a number becomes null."""
    return col.try_cast("double")


def is_finite(col: Column) -> Column:
    """False for null, NaN and both infinities."""
    return F.coalesce(~F.isnan(col) & (F.abs(col) < F.lit(float("inf"))), F.lit(False))


def only_finite(col: Column) -> Column:
    return F.when(is_finite(col), col)


def frame_key(source_file: Column, frame: Column) -> Column:
    return F.concat(source_file, F.lit("#"), frame.cast("string"))


def missing_cell(cell: Column, pbc: Column) -> Column:
    """Neither a cell (all entries within the tolerance) nor a periodic direction."""
    return F.forall(cell, lambda c: F.abs(c) <= TOLERANCE) & ~F.exists(pbc, lambda p: p != 0)


def cache_key(structure_id: Column, model_name: str, model_version: str, schema_version: str, committee: bool, property_mode: str) -> Column:
    """SHA-256 of the canonical JSON (sorted keys, no spaces) of what a prediction depends on."""
    flags = F.struct(F.lit(committee).alias("committee"), F.lit(property_mode).alias("property"))
    parts = F.struct(flags.alias("flags"), F.lit(model_name).alias("model_name"), F.lit(model_version).alias("model_version"), F.lit(schema_version).alias("schema_version"), structure_id.alias("structure_id"))
    return F.sha2(F.to_json(parts), 256)


def unpack_tensor(tensor: Column, suffix: str = "") -> list[Column]:
    """The six upper-triangle components of a row-major array of nine; null for a null array."""
    return [F.element_at(tensor, at).alias(f"cs_{axis}{suffix}") for axis, at in UPPER.items()]


def unsupported(elements: Column) -> Column:
    """The distinct elements outside the supported set, sorted."""
    return F.array_sort(F.array_except(elements, F.array(*(F.lit(e) for e in SUPPORTED_ELEMENTS))))


def committee_std(members: Column) -> Column:
    """Population standard deviation of an array; null for an empty one."""
    n = F.size(members)
    mean = F.aggregate(members, F.lit(0.0), lambda a, x: a + x.cast("double")) / n
    return F.when(n > 0, F.sqrt(F.aggregate(members, F.lit(0.0), lambda a, x: a + (x.cast("double") - mean) * (x.cast("double") - mean)) / n))


def parse_utc(text: Column) -> Column:
    """A timestamp from RFC 3339 text that ends in Z; null for anything else."""
    return F.when(text.endswith("Z"), F.try_to_timestamp(F.regexp_replace(text, "Z", "+00:00")))


def format_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def index_payload(*names: str) -> Column:
    """Compact JSON with sorted keys; null fields are left out."""
    return F.to_json(F.struct(*(F.col(n) for n in sorted(names))))
