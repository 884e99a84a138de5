"""Pluggable per-frame prediction, run by Arrow batches inside the tasks."""

from __future__ import annotations

import importlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any, Protocol

import numpy as np
import pandas as pd
from pyspark.resource import ResourceProfile, ResourceProfileBuilder, TaskResourceRequests
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atomweft.errors import ConfigError, MissingDependencyError

PREDICTED = "frame_cache_key string, n_atoms bigint, cs_iso array<double>, cs_iso_uncertainty array<double>, tensor array<array<double>>, tensor_uncertainty array<array<double>>"


@dataclass(frozen=True)
class Structure:
    """What a predictor sees of a frame."""

    numbers: np.ndarray
    symbols: list[str]
    positions: np.ndarray
    cell: np.ndarray
    pbc: np.ndarray

    def __len__(self) -> int:
        return len(self.symbols)

    def get_chemical_symbols(self) -> list[str]:
        return list(self.symbols)


@dataclass(frozen=True)
class FramePrediction:
    """Arrays of one frame: (n,) for the isotropic values, (n, 3, 3) for tensors."""

    cs_iso: np.ndarray
    cs_iso_uncertainty: np.ndarray | None = None
    tensor: np.ndarray | None = None
    tensor_uncertainty: np.ndarray | None = None


class Predictor(Protocol):
    """Predicts each frame on its own, deterministically: a task may run again."""

    name: str

    def predict(self, frames: list[Structure], *, device: str = "auto", committee: bool = False, property: str = "iso") -> list[FramePrediction]: ...


PredictorFactory = Callable[[str], Predictor]


def _std(members: np.ndarray, n: int, tail: int) -> np.ndarray | None:
    """Population deviation over the committee axis: the last if the first counts the atoms, else the first."""
    if members.ndim != 2 + tail:
        return None
    if members.shape[0] == n and (not tail or members.shape[1:3] == (3, 3)):
        return members.std(axis=-1)
    matches = members.shape[1] == n if not tail else members.shape[1:] == (n, 3, 3)
    return members.std(axis=0) if matches else None


@dataclass
class ModelPredictor:
    """Adapts a model object that offers some of get_cs_iso / get_cs, get_cs_tensor / get_tensor, and committee outputs of them.

    ``to_model_input`` turns a Structure into what the model takes.
    """

    make_model: Callable[[str], Any]
    device: str = "auto"
    to_model_input: Callable[[Structure], Any] = staticmethod(lambda s: s)
    name: str = "model"

    def __post_init__(self) -> None:
        self._models: dict[str, Any] = {}

    def predict(self, frames, *, device="auto", committee=False, property="iso"):
        at = runtime_device(device)
        if at not in self._models:
            self._models[at] = self.make_model(at)
        model = self._models[at]
        return [self._one(model, self.to_model_input(f), len(f), committee, property in ("tensor", "both")) for f in frames]

    @staticmethod
    def _outputs(model: Any, given: Any, *names: str) -> Iterator[np.ndarray]:
        return (np.asarray(getattr(model, n)(given), float) for n in names if hasattr(model, n))

    def _one(self, model: Any, given: Any, n: int, committee: bool, tensor: bool) -> FramePrediction:
        iso = next(self._outputs(model, given, "get_cs_iso", "get_cs"), None)
        if iso is None or iso.shape[0] != n:
            raise RuntimeError("the model gives no isotropic values" if iso is None else "the model gives a wrong number of isotropic values")
        spread = tensors = tensor_spread = None
        if committee:
            found = (s for m in self._outputs(model, given, "get_cs_iso_ensemble", "get_cs_committee") if (s := _std(m, n, 0)) is not None)
            spread = next(found, np.zeros(n))
        if tensor:
            tensors = next((t for t in self._outputs(model, given, "get_cs_tensor", "get_tensor") if t.shape == (n, 3, 3)), None)
            if committee and tensors is not None:
                tensor_spread = next((_std(m, n, 2) for m in self._outputs(model, given, "get_cs_tensor_ensemble")), None)
        return FramePrediction(iso, spread, tensors, tensor_spread)


def model_factory(path: str, *args: Any) -> PredictorFactory:
    """A factory from ``package.module:Class``; the module is imported where the predictor is made."""
    module, _, name = path.partition(":")
    return lambda device: ModelPredictor(lambda at: getattr(importlib.import_module(module), name)(*args, device=at), device)


def load_factory(path: str) -> PredictorFactory:
    """What ``package.module:name`` names, called with a device to make a predictor: a class, a function, or a ``model_factory``."""
    module, _, name = path.partition(":")
    try:
        return getattr(importlib.import_module(module), name)
    except ModuleNotFoundError as e:
        raise MissingDependencyError(f"the predictor cannot be imported: {e}") from e
    except (AttributeError, ValueError) as e:
        raise ConfigError(f"no predictor is called {path}, give package.module:name") from e


def cuda_available() -> bool:
    try:
        import torch

        return bool(torch.cuda.is_available())
    except Exception:
        return False


def runtime_device(requested: str) -> str:
    return ("cuda" if cuda_available() else "cpu") if requested == "auto" else requested


def allowed_workers(device: str, workers: int, force: bool) -> tuple[int, list[str]]:
    if device == "cuda" and workers > 1 and not force:
        return 1, ["device=cuda with workers>1 coerced to workers=1"]
    return workers, []


#: The name of GPUs among Spark's resources, and the setting that tells how many each executor has.
GPU, GPUS_SETTING = "gpu", "spark.executor.resource.gpu.amount"


def device_profile(spark: SparkSession, device: str, workers: int) -> ResourceProfile | None:
    """What a task that predicts on GPUs asks for: a GPU of its own, or an equal share if several workers are allowed on one.

    None on processors, in local mode (Spark has no profiles there), and where the executors of the session have no GPUs.
    """
    if device != "cuda" or spark.sparkContext.master.startswith("local") or not int(spark.conf.get(GPUS_SETTING, "0")):
        return None
    return ResourceProfileBuilder().require(TaskResourceRequests().cpus(1).resource(GPU, 1 / max(1, workers))).build


def prediction_tasks(frames: int, chunk_size: int, device: str, workers: int, profile: ResourceProfile | None) -> int:
    """Tasks to predict so many frames in: one a chunk, for Spark to place. On GPUs that Spark does not schedule, no more than may share one."""
    chunks = min(-(-frames // chunk_size), 100_000)
    return min(chunks, workers) if device == "cuda" and profile is None else chunks


def _nested(array: np.ndarray | None) -> list | None:
    return None if array is None else np.asarray(array, float).reshape(len(array), 9).tolist()


def predict_frames(frames: DataFrame, factory: PredictorFactory, *, device: str, committee: bool, property_mode: str, chunk_size: int, tasks: int, profile: ResourceProfile | None = None) -> DataFrame:
    """PREDICTED rows of frames with frame_cache_key; each Python worker makes one predictor and sees ``chunk_size`` frames at a time.

    Only the stage that predicts asks for the resources of ``profile``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predictor = None
        for batch in batches:
            for start in range(0, len(batch), chunk_size):
                part = batch.iloc[start : start + chunk_size]
                predictor = predictor or factory(device)
                given = [Structure(np.asarray(z, int), list(e), np.asarray([[q["x"], q["y"], q["z"]] for q in p], float), np.asarray(c, float).reshape(3, 3), np.asarray(b, bool)) for z, e, p, c, b in zip(part.numbers, part.element, part.positions, part.cell, part.pbc)]
                out = predictor.predict(given, device=device, committee=committee, property=property_mode)
                if len(out) != len(given):
                    raise RuntimeError("the predictor gave a wrong number of frames")
                for g, p in zip(given, out):
                    if len(p.cs_iso) < len(g):
                        raise RuntimeError("the predictor gave too few values for a frame")
                yield pd.DataFrame({
                    "frame_cache_key": part.frame_cache_key.to_numpy(), "n_atoms": [len(g) for g in given], "cs_iso": [np.asarray(p.cs_iso, float) for p in out],
                    "cs_iso_uncertainty": [None if p.cs_iso_uncertainty is None else np.asarray(p.cs_iso_uncertainty, float) for p in out],
                    "tensor": [_nested(p.tensor) for p in out], "tensor_uncertainty": [_nested(p.tensor_uncertainty) for p in out],
                })

    columns = ["frame_cache_key", "numbers", "element", "positions", "cell", "pbc"]
    return frames.select(*columns).repartition(max(1, tasks), F.col("frame_cache_key")).mapInPandas(run, PREDICTED, profile=profile)
