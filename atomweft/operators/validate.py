"""Frame checks as columns, with one action for the first failure, and the policy for missing cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atomweft.errors import ValidationError
from atomweft.functions.columns import is_finite, unsupported


def failure() -> Column:
    """What is wrong with a frame, or null: no atoms, then a position that is not finite, then elements outside the supported set."""
    name = F.concat_ws("#", "source_file", "frame")
    bad = F.exists("positions", lambda p: ~(is_finite(p.x) & is_finite(p.y) & is_finite(p.z)))
    odd = unsupported(F.col("element"))
    return (
        F.when(F.size("element") == 0, F.concat(F.lit("the frame has no atoms: "), name))
        .when(bad, F.concat(F.lit("positions are not finite in "), name))
        .when(F.size(odd) > 0, F.concat(F.lit("unsupported elements in "), name, F.lit(": "), F.array_join(odd, ", ")))
    )


#: Frames that a warning lists by name; of more it tells the number.
LISTED = 10_000


def missing_cell_text(frames: DataFrame, listed: int = LISTED) -> str | None:
    """The listing of frames without a cell, ordered by file and frame number; None if there are none."""
    flagged = frames.where("normalized_cell_pbc").select("source_file", "frame").distinct()
    n = flagged.count()
    if not n:
        return None
    names = [f"{r.source_file}#{r.frame}" for r in flagged.orderBy("source_file", "frame").limit(listed).collect()]
    return "Missing cell/PBC normalized to zeros for frames: " + ", ".join(names) + (f" and {n - listed} more" if n > listed else "")


def validate_frames(frames: DataFrame, on_warning: str = "warn") -> tuple[DataFrame, list[str], bool]:
    """(kept frames, warnings, any cell normalised). All frames are checked before any is skipped."""
    first = frames.withColumn("failure", failure()).where("failure IS NOT NULL").orderBy("frame_ord").select("failure").limit(1).collect()
    if first:
        raise ValidationError(first[0].failure)
    warning = missing_cell_text(frames)
    if warning is None:
        return frames, [], False
    if on_warning == "error":
        raise ValidationError(warning)
    if on_warning == "skip":
        frames = frames.where(~F.col("normalized_cell_pbc"))
        if not frames.limit(1).count():
            raise ValidationError("every frame was skipped for its missing cell")
    return frames, [warning], True
