"""Predictors and small structure files for the tests. Predictors are importable, so that tasks can load them."""

import json
from pathlib import Path

import numpy as np

from atomweft.operators.predict import FramePrediction


class Ramp:
    name = "ramp"

    def __init__(self, device="cpu"):
        self.device = device

    def predict(self, frames, *, device="auto", committee=False, property="iso"):
        out = []
        for f in frames:
            n = len(f)
            tensor = np.arange(9.0 * n).reshape(n, 3, 3) if property in ("tensor", "both") else None
            out.append(FramePrediction(np.linspace(1, n, n), np.full(n, 0.5) if committee else None, tensor, None if tensor is None or not committee else tensor / 10))
        return out


class ByX(Ramp):
    def predict(self, frames, **_):
        return [FramePrediction(f.positions[:, 0].copy()) for f in frames]


class Failing(Ramp):
    def predict(self, frames, **_):
        raise RuntimeError("boom")


XYZ = "3\n{c}\nH 0 0 0\nC 0 0 {z}\nO 0 1 0\n"
CELL = 'Lattice="8 0 0 0 8 0 0 0 8" Properties=species:S:1:pos:R:3 pbc="T T T"'


def write(path: Path, *frames: str) -> str:
    path.write_text("".join(frames))
    return str(path)


def hco(z=1.1, cell=True) -> str:
    return XYZ.format(c=CELL if cell else "no cell", z=z)


def record(key, chunk, form="csv", seq=1, writer="w", at="2024-01-01T00:00:00Z", **more) -> str:
    return json.dumps({"cache_key": key, "chunk_path": str(chunk), "output_format": form, "seq": seq, "writer_id": writer, "written_at_utc": at, **more})
