"""Content hash of a structure, as a column: the bytes of numbers are put together as hexadecimal text by the JVM."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

NORMALIZATION_VERSION = "1"


def structure_digest(numbers, positions, cell, pbc) -> str:
    """The hash of one structure, outside of Spark: SHA-256 over the version line, then name, shape, type and bytes of each array in order."""
    out = hashlib.sha256(f"normalization_version={NORMALIZATION_VERSION}\n".encode())
    fields = {"numbers": np.asarray(numbers, "<i4"), "positions": np.asarray(positions, "<f8").reshape(-1, 3), "cell": np.asarray(cell, "<f8").reshape(3, 3), "pbc": np.asarray(pbc, "|u1")}
    for name, array in fields.items():
        out.update(f"{name}:{array.shape}:{array.dtype.str}\n".encode() + array.tobytes())
    return out.hexdigest()


def _static(kind: str, method: str, value: Column) -> Column:
    return F.java_method(F.lit(f"java.lang.{kind}"), F.lit(method), value)


def double_hex(x: Column) -> Column:
    """The eight bytes of a double, lowest first, as 16 hexadecimal digits; -0.0 and 0.0 differ, null is as NaN."""
    bits = _static("Double", "doubleToRawLongBits", F.coalesce(x.cast("double"), F.lit(float("nan")))).cast("bigint")
    return F.lpad(F.hex(_static("Long", "reverseBytes", bits).cast("bigint")), 16, "0")


def int_hex(x: Column) -> Column:
    """The four bytes of an integer, lowest first, as 8 hexadecimal digits."""
    return F.right(F.lpad(F.hex(_static("Integer", "reverseBytes", F.coalesce(x.cast("int"), F.lit(0))).cast("bigint")), 16, "0"), F.lit(8))


def byte_hex(x: Column) -> Column:
    return F.lpad(F.hex(x.cast("bigint")), 2, "0")


def structure_id(numbers: str | Column, positions: str | Column, cell: str | Column, pbc: str | Column) -> Column:
    """``structure_digest`` as a column, null if an array is or if ``numbers`` or ``pbc`` hold a null. ``positions`` is a flat array x0, y0, z0, x1, ...; cell and pbc are normalised before."""
    numbers, positions, cell, pbc = (F.col(c) if isinstance(c, str) else c for c in (numbers, positions, cell, pbc))
    size = lambda c: F.size(c).cast("string")
    text = lambda *parts: F.encode(F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts)), "UTF-8")
    raw = lambda c, digits: F.unhex(F.array_join(F.transform(c, digits), ""))
    whole = ~F.exists(numbers, lambda x: x.isNull()) & ~F.exists(pbc, lambda x: x.isNull())
    hashed = F.sha2(
        F.concat(
            text(f"normalization_version={NORMALIZATION_VERSION}\nnumbers:(", size(numbers), ",):<i4\n"),
            raw(numbers, int_hex),
            text("positions:(", F.floor(F.size(positions) / 3).cast("string"), ", 3):<f8\n"),
            raw(positions, double_hex),
            text("cell:(3, 3):<f8\n"),
            raw(cell, double_hex),
            text("pbc:(", size(pbc), ",):|u1\n"),
            raw(pbc, byte_hex),
        ),
        256,
    )
    return F.when(whole, hashed)
