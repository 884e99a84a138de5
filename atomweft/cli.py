"""Command line: info, predict, average, cache-compact."""

from __future__ import annotations

import argparse
import json
import subprocess
import sys
from pathlib import Path
from typing import Any

from pyspark.sql import SparkSession

from atomweft import __version__
from atomweft.config import build_config
from atomweft.errors import BackendRuntimeError, ConfigError, MissingDependencyError, PipelineError, ValidationError
from atomweft.schema import SCHEMA_VERSION

LABELS = {ConfigError: "Configuration error", ValidationError: "Validation error", MissingDependencyError: "Missing dependency", BackendRuntimeError: "Backend runtime error", PipelineError: "Pipeline error"}


def show(payload: dict[str, Any]) -> None:
    print(json.dumps(payload, indent=2, sort_keys=True))


def parser() -> argparse.ArgumentParser:
    """Options default to None, so that values of a configuration file are not shadowed."""
    top = argparse.ArgumentParser(prog="atomweft", description="Per-atom predictions as Spark jobs")
    commands = top.add_subparsers(dest="command", required=True)
    commands.add_parser("info", help="versions and settings")
    p = commands.add_parser("predict", help="predict structures")
    p.add_argument("inputs", nargs="+")
    p.add_argument("--out", required=True, type=Path)
    p.add_argument("--predictor", help="package.module:function that makes a predictor for a device")
    for name in ("frames", "device", "on-warning"):
        p.add_argument(f"--{name}")
    p.add_argument("--property", dest="property_mode")
    p.add_argument("--format", dest="output_format")
    p.add_argument("--magres", dest="magres_mode")
    p.add_argument("--workers", type=int)
    p.add_argument("--chunk-size", type=int)
    p.add_argument("--cache-chunk-max-mb", type=float)
    p.add_argument("--cache-dir", type=Path)
    p.add_argument("--config", type=Path)
    for name in ("committee", "dry-run", "strict", "force-multi-gpu"):
        p.add_argument(f"--{name}", action="store_true", default=None)
    p = commands.add_parser("average", help="average a results table over frames")
    p.add_argument("results", type=Path)
    p.add_argument("--out", required=True, type=Path)
    p.add_argument("--weights", type=Path)
    p.add_argument("--format", default="auto")
    p = commands.add_parser("cache-compact", help="merge the index logs of a cache")
    p.add_argument("cache_dir", type=Path)
    p.add_argument("--remove-source-indexes", action="store_true")
    return top


def average_output(path: Path, requested: str) -> tuple[Path, str]:
    """A known suffix stays as it is; ``auto`` follows it, else CSV."""
    requested = requested.strip().lower()
    if requested not in ("auto", "csv", "parquet"):
        raise ConfigError("--format must be one of auto|csv|parquet")
    known = path.suffix.lower() in (".csv", ".parquet")
    target = requested if requested != "auto" else path.suffix.lower()[1:] if known else "csv"
    return (path if known else path.with_suffix(f".{target}")), target


def _session():
    from atomweft.session import get_session

    session = get_session("atomweft", master="local[*]")
    session.sparkContext.setLogLevel("ERROR")
    return session


def info(_: argparse.Namespace, spark: SparkSession | None = None) -> dict[str, Any]:
    return {"tool": "atomweft", "version": __version__, "schema_version": SCHEMA_VERSION, "backend": "pluggable", "notes": ["Elements are checked before prediction.", "Committee runs predict isotropic values unless a property is given.", "Rows are in order of source_file, frame, atom_i."]}


def predict(args: argparse.Namespace, spark: SparkSession | None = None) -> dict[str, Any]:
    from atomweft.run import run_predict

    config = build_config(args.out, {k: v for k, v in vars(args).items() if k not in ("command", "inputs", "out", "config")}, args.config)
    s = run_predict(spark or _session(), args.inputs, config)
    shared = {"device": s.device, "workers": s.workers, "committee_enabled": s.committee_enabled, "warnings": s.warnings}
    if config.dry_run:
        return shared | {"dry_run": True, "outdir": str(s.outdir), "frame_count": s.frame_count, "atom_count": s.atom_count, "property_mode": s.property_mode}
    return shared | {"status": "ok", "output": str(s.output_path), "format": s.output_format, "frames": s.frame_count, "atoms": s.atom_count, "cache_hits": s.cache_hits, "cache_misses": s.cache_misses, "timings": s.timings.as_dict()}


def average(args: argparse.Namespace, spark: SparkSession | None = None) -> dict[str, Any]:
    from atomweft.operators.average import KEYS, average_per_atom
    from atomweft.sinks import write_table
    from atomweft.sources.tables import load_weights, read_results, weights_frame

    path, form = average_output(args.out, args.format)
    spark = spark or _session()
    table = read_results(spark, args.results)
    weights = load_weights(args.weights) if args.weights else None
    averaged = average_per_atom(table, weights_frame(spark, weights) if weights else None).persist()
    write_table(averaged, path, form, KEYS)
    rows = averaged.count()
    averaged.unpersist()
    return {"status": "ok", "input": str(args.results), "output": str(path), "format": form, "rows": rows, "weights_applied": bool(weights)}


def cache_compact(args: argparse.Namespace, spark: SparkSession | None = None) -> dict[str, Any]:
    from atomweft.operators.store import compact_index

    return {"status": "ok", **compact_index(spark or _session(), args.cache_dir, args.remove_source_indexes)}


COMMANDS = {"info": info, "predict": predict, "average": average, "cache-compact": cache_compact}


def run_command(argv: list[str], spark: SparkSession | None = None) -> dict[str, Any]:
    """Runs a command line in ``spark``, or in a session of its own; what the command prints."""
    args = parser().parse_args(argv)
    return COMMANDS[args.command](args, spark)


def main(argv: list[str] | None = None) -> int:
    try:
        show(run_command(sys.argv[1:] if argv is None else argv))
        return 0
    except tuple(LABELS) as e:
        label = next(text for kind, text in LABELS.items() if isinstance(e, kind))
        print(f"{label}: {e}", file=sys.stderr)
        return e.exit_code
    except ValueError as e:
        print(f"Validation error: {e}", file=sys.stderr)
        return 3
    except Exception as e:
        print(f"Pipeline error: {e}", file=sys.stderr)
        return 1


def run_workflow_step(inputs: list[str], outdir: str, extra: list[str] | None = None) -> None:
    """For workflow tools: runs ``predict`` as a process and raises if it fails."""
    subprocess.run([sys.executable, "-m", "atomweft", "predict", *inputs, "--out", outdir, *(extra or [])], check=True)
