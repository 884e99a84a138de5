"""A prediction run: scan, validate, look up, predict what is missing, store, publish."""

from __future__ import annotations

import importlib.util
import time
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atomweft.config import PredictConfig
from atomweft.errors import BackendRuntimeError, InputError, MissingDependencyError, PipelineError, ValidationError
from atomweft.functions.columns import cache_key
from atomweft.operators.cache import canonical, hits, materialise, misses
from atomweft.operators.explode import explode_atoms, explode_predictions
from atomweft.operators.predict import PredictorFactory, allowed_workers, device_profile, load_factory, predict_frames, prediction_tasks, runtime_device
from atomweft.operators.store import CacheStore, prepare_rows
from atomweft.operators.validate import validate_frames
from atomweft.provenance import Timing, run_record, write_record
from atomweft.schema import SCHEMA_VERSION, fill_missing, required_columns
from atomweft.sinks import write_magres, write_table
from atomweft.sources.structures import load_structures, resolve_inputs
from atomweft.sources.tables import file_digests
from atomweft.work import Workspace

#: Cache keys that the driver holds for the summary. The record of a run has all of them, of larger runs written by tasks.
KEYS_IN_RECORD = 100_000
ORDER = ["source_file", "frame", "atom_i"]


@dataclass
class RunSummary:
    outdir: Path
    output_path: Path
    output_format: str
    frame_count: int
    atom_count: int
    cache_hits: int
    cache_misses: int
    device: str
    workers: int
    property_mode: str
    committee_enabled: bool
    warnings: list[str]
    timings: Timing
    cache_keys: list[str]
    normalized_cell_pbc: bool


def resolve_output_format(requested: str) -> str:
    """Parquet unless CSV is asked for: Spark always writes it, reading it elsewhere needs pyarrow."""
    if requested == "parquet" and importlib.util.find_spec("pyarrow") is None:
        raise MissingDependencyError("parquet output needs pyarrow")
    return "csv" if requested == "csv" or importlib.util.find_spec("pyarrow") is None else "parquet"


def assemble(atoms: DataFrame, values: DataFrame, property_mode: str, committee: bool) -> DataFrame:
    """The results table in its column order: required columns, the cache key after cs_iso, then what else the values carry."""
    needed = required_columns(property_mode, committee)
    rows = fill_missing(materialise(atoms, values), needed)
    at = needed.index("cs_iso") + 1
    lead = [*needed[:at], "frame_cache_key", *needed[at:]]
    return rows.select(*lead, *(c for c in rows.columns if c not in lead))


def run_predict(spark: SparkSession, inputs: list[str], config: PredictConfig, factory: PredictorFactory | None = None, model_name: str = "model", model_version: str = "unknown", single_file: bool = True) -> RunSummary:
    """Runs ``config`` over the inputs. Frames and atoms stay distributed; only counts, warnings and the first failure reach the driver.

    What a run needs more than once is written as tables that are removed at its end: a lost executor costs no prediction. Equal structures are
    predicted once. A record of the run is written on success and failure, but not for a dry run. With
    ``single_file=False`` the results are a range-sorted directory, for runs that one task should not write.
    """
    config.outdir.mkdir(parents=True, exist_ok=True)
    timing, warnings, files, error, keys, listed, summary = Timing(), [], [], None, [], None, None
    device, workers, normalized = config.device, config.workers, False
    began = time.perf_counter()
    work = Workspace(spark, config.outdir)
    keep = work.keep
    try:
        files = resolve_inputs(inputs)
        frames, found, normalized = validate_frames(keep(load_structures(spark, files, config.frames, keep)), config.on_warning)
        warnings += found
        device = runtime_device(config.device)
        workers, found = allowed_workers(device, config.workers, config.force_multi_gpu)
        warnings += found
        mode = config.property_mode or "iso"
        output_format = resolve_output_format(config.output_format)
        key = cache_key(F.col("structure_id"), model_name, model_version, SCHEMA_VERSION, config.committee, mode)
        frames, seen = keep(frames.withColumn("frame_cache_key", key), frames=F.count(F.lit(1)), atoms=F.sum(F.size("element")))
        n_frames, n_atoms = seen["frames"] or 0, seen["atoms"] or 0

        def summed(hit: int, miss: int) -> RunSummary:
            return RunSummary(config.outdir, config.outdir / f"results.{output_format}", output_format, n_frames, n_atoms, hit, miss, device, workers, mode, config.committee, warnings, timing, keys, normalized)

        if config.dry_run:
            timing.setup = time.perf_counter() - began
            summary = summed(0, n_frames)
            return summary
        if n_frames <= KEYS_IN_RECORD:
            keys = [r[0] for r in frames.select("frame_cache_key").orderBy("frame_cache_key").collect()]
        else:
            listed = frames.select("frame_cache_key")
        timing.setup = time.perf_counter() - began
        store, cached, hit = None, None, frames.limit(0)
        if config.cache_dir is not None:
            with timing.part("cache"):
                store = CacheStore(spark, config.cache_dir, output_format, model_name, model_version, SCHEMA_VERSION)
                rows = store.lookup(frames, keep)
                if rows is not None and "atom_i" in rows.columns:
                    dropped = [c for c in ("structure_id", "source_file", "frame", "element", "x", "y", "z", "_row", "chunk") if c in rows.columns]
                    cached = keep(canonical(rows.drop(*(c for c in dropped if c != "_row")), "frame_cache_key", F.col("_row")).drop("_row"))
                    hit = keep(hits(frames, cached))
        miss, seen = keep(misses(frames, hit), frames=F.count(F.lit(1)))
        n_miss = seen["frames"] or 0
        values = cached.join(hit.select("frame_cache_key").distinct(), "frame_cache_key", "left_semi") if cached is not None else None
        with timing.part("predict"):
            if n_miss:
                predicted = _predict(miss, factory, config, device, workers, mode, work)
                if store is not None:
                    store.store(prepare_rows(materialise(explode_atoms(miss.dropDuplicates(["frame_cache_key"]), "frame_cache_key"), predicted), F.struct("source_file", "frame")), config.chunk_size, config.cache_chunk_max_mb, ["source_file", "frame"])
                values = predicted if values is None else values.unionByName(predicted, allowMissingColumns=True)
        if values is None:
            raise ValidationError("the run produced no results")
        results = keep(assemble(explode_atoms(frames, "frame_cache_key"), values, mode, config.committee))
        write_table(results, config.outdir / f"results.{output_format}", output_format, ORDER, single_file)
        if config.magres_mode != "none":
            write_magres(results, config.outdir, config.magres_mode, frames)
        summary = summed(n_frames - n_miss, n_miss)
        return summary
    except InputError as e:
        error = str(e)
        raise ValidationError(error) from e
    except PipelineError as e:
        error = str(e)
        raise
    except Exception as e:
        error = str(e)
        raise PipelineError(error) from e
    finally:
        if not config.dry_run:
            if not timing.setup:
                timing.setup = time.perf_counter() - began
            _write_record(spark, config, summary, timing, error, files or inputs, warnings, listed if listed is not None else keys, device, workers, normalized)
        work.close()


def _predict(miss: DataFrame, factory: PredictorFactory | None, config: PredictConfig, device: str, workers: int, mode: str, work: Workspace) -> DataFrame:
    """(frame_cache_key, atom_i, measures) of one frame for each missing key, computed now so that a failure shows here."""
    if factory is None and config.predictor is None:
        raise MissingDependencyError("no predictor was given")
    factory = factory or load_factory(config.predictor)
    frames = miss.dropDuplicates(["frame_cache_key"])
    profile = device_profile(miss.sparkSession, device, workers)
    tasks = prediction_tasks(frames.count(), config.chunk_size, device, workers, profile)
    made = predict_frames(frames, factory, device=device, committee=config.committee, property_mode=mode, chunk_size=config.chunk_size, tasks=tasks, profile=profile)
    try:
        return work.keep(explode_predictions(made, mode in ("tensor", "both"), config.committee))
    except Exception as e:
        if "ModuleNotFoundError" in str(e):
            raise MissingDependencyError(f"the predictor needs a package that is missing: {e}") from e
        raise BackendRuntimeError(f"prediction failed: {e}") from e


def _write_record(spark, config, summary, timing, error, inputs, warnings, keys, device, workers, normalized) -> None:
    """Provenance must not hide what went wrong, so its own errors are dropped."""
    try:
        runtime = {"device": device, "workers": workers, "chunk_size": config.chunk_size, "cache_chunk_max_mb": config.cache_chunk_max_mb, "committee_enabled": config.committee}
        extra = {"error": error} if error else {}
        record = run_record("success" if summary else "failed", timing, command="predict", args=config.command_args, config=config.as_dict(), input_files=file_digests(spark, inputs), warnings=warnings, cache_keys=sorted(keys) if isinstance(keys, list) else [], runtime=runtime, normalized_cell_pbc=normalized, **extra)
        write_record(config.outdir / "run.json", record, None if isinstance(keys, list) else keys)
    except Exception:
        pass
