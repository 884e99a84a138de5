"""Weighted per-atom averages over frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atomweft.functions.columns import frame_key, number, only_finite
from atomweft.schema import measure_columns

KEYS = ["atom_i", "element", "x", "y", "z"]
NEEDED = ["source_file", "frame", *KEYS]
#: Bytes of weights (keys and numbers) that are broadcast at most; a larger map is joined by a shuffle.
BROADCAST_WEIGHTS = 64 << 20


def check_columns(df: DataFrame) -> list[str]:
    """The measures of a results table, or a ValueError that lists what is missing."""
    if missing := [c for c in NEEDED if c not in df.columns]:
        raise ValueError(f"columns are missing for averaging: {', '.join(missing)}")
    if "cs_iso" not in (found := measure_columns(df)):
        raise ValueError("results need a cs_iso column")
    return found


def with_weights(df: DataFrame, weights: DataFrame) -> DataFrame:
    """``df`` with the weight of its frame; null where ``weights`` (frame_key, weight) has none. Surplus weights are ignored."""
    side = weights.select(F.col("frame_key").alias("_key"), number(F.col("weight")).alias("_weight"))
    return df.join(side, frame_key(F.col("source_file"), F.col("frame")) == F.col("_key"), "left").drop("_key")


def uncovered(weighted: DataFrame) -> DataFrame:
    """Rows of ``with_weights`` without a usable weight."""
    return weighted.where(F.col("_weight").isNull() | F.isnan("_weight"))


def grouped_mean(weighted: DataFrame, measures: list[str]) -> DataFrame:
    """Per atom the mean of each measure over its finite values, weighted by ``_weight``.

    Groups whose weights sum to zero are dropped; a measure without finite values, or whose weights sum to zero, is null. NaN keys count as null.
    """
    keys = [F.when(~F.isnan(F.col(k).cast("double")), F.col(k)).alias(k) if k in "xyz" else F.col(k) for k in KEYS]
    values = [only_finite(number(F.col(m))).alias(m) for m in measures]
    rows = weighted.select(*keys, *values, "_weight")
    sums = [s for m in measures for s in (F.sum(F.col(m) * F.col("_weight")).alias(f"{m}_n"), F.sum(F.when(F.col(m).isNotNull(), F.col("_weight"))).alias(f"{m}_w"))]
    found = rows.groupBy(*KEYS).agg(F.sum("_weight").alias("_total"), *sums).where("_total <> 0")
    return found.select(*KEYS, *(F.when(F.col(f"{m}_w") != 0, F.col(f"{m}_n") / F.col(f"{m}_w")).alias(m) for m in measures))


def average_per_atom(df: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """Averages in order of atom; ties in order of element and position. Without weights every row counts once.

    Every frame needs a weight, else ValueError; so does every row an ``atom_i``.
    """
    measures = check_columns(df)
    if df.where(F.col("atom_i").isNull()).limit(1).count():
        raise ValueError("a row has no atom_i")
    if weights is None:
        weighted = df.withColumn("_weight", F.lit(1.0))
    else:
        size = weights.agg(F.sum(F.octet_length("frame_key") + 8)).first()[0] or 0
        weighted = with_weights(df, F.broadcast(weights) if size <= BROADCAST_WEIGHTS else weights)
        if uncovered(weighted).limit(1).count():
            raise ValueError("weights do not cover every frame of the results")
    typed = weighted.withColumns({"atom_i": F.col("atom_i").cast("bigint"), **{a: F.col(a).cast("double") for a in "xyz"}})
    return grouped_mean(typed, measures).orderBy(*(F.col(k).asc_nulls_last() for k in KEYS))
