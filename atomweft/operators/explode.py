"""Frame rows to atom rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atomweft.functions.columns import unpack_tensor


def explode_atoms(frames: DataFrame, *carried: str) -> DataFrame:
    """A row per atom: ids, element and position, and the ``carried`` columns of the frame."""
    atoms = frames.select("structure_id", "source_file", "frame", *carried, F.posexplode(F.arrays_zip("element", "positions")).alias("at", "a"))
    return atoms.select("structure_id", "source_file", "frame", F.col("at").cast("bigint").alias("atom_i"), F.col("a.element").alias("element"), "a.positions.*", *carried)


def explode_predictions(predicted: DataFrame, tensor: bool, committee: bool) -> DataFrame:
    """(frame_cache_key, atom_i, measures) of rows with arrays per frame: n_atoms, cs_iso, cs_iso_uncertainty, tensor, tensor_uncertainty.

    Arrays longer than the frame are cut; a tensor is nine numbers for each atom, of which the upper triangle is kept.
    """
    rows = predicted.select("frame_cache_key", F.explode(F.sequence(F.lit(0), F.col("n_atoms").cast("int") - 1)).alias("at"), "cs_iso", "cs_iso_uncertainty", "tensor", "tensor_uncertainty")
    out = ["frame_cache_key", F.col("at").cast("bigint").alias("atom_i"), F.get("cs_iso", "at").alias("cs_iso")]
    if committee:
        out.append(F.get("cs_iso_uncertainty", "at").alias("cs_iso_uncertainty"))
    if tensor:
        out += unpack_tensor(F.get("tensor", "at"))
        if committee:
            out += unpack_tensor(F.get("tensor_uncertainty", "at"), "_uncertainty")
    return rows.select(*out)


