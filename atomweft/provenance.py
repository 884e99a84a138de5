"""The record of a run."""

from __future__ import annotations

import importlib.metadata
import json
import platform
import sys
import time
from contextlib import contextmanager
from dataclasses import dataclass
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atomweft import __version__
from atomweft.config import json_safe
from atomweft.functions.digest import NORMALIZATION_VERSION
from atomweft.operators.store import now_utc
from atomweft.schema import SCHEMA_VERSION
from atomweft.sinks import write_lines, write_text


@dataclass
class Timing:
    """Seconds of the parts of a run, measured around actions."""

    setup: float = 0.0
    cache: float = 0.0
    predict: float = 0.0

    @contextmanager
    def part(self, name: str):
        began = time.perf_counter()
        try:
            yield
        finally:
            setattr(self, name, getattr(self, name) + time.perf_counter() - began)

    def as_dict(self) -> dict[str, float]:
        return {f"{k}_time_s": round(getattr(self, k), 6) for k in ("setup", "cache", "predict")}


#: Packages whose versions a record names, and what stands for one that is not installed (a fixed value).
NAMED = ("pyspark", "numpy", "pandas", "pyarrow")
ABSENT = "not-installed"


def installed() -> dict[str, str]:
    """Version by name of the packages in NAMED, from one pass over what is installed."""
    found = {name.lower(): d.version for d in importlib.metadata.distributions() if (name := d.metadata["Name"])}
    return {p: found.get(p, ABSENT) for p in NAMED}


def git_commit(start: Path = Path(__file__)) -> str | None:
    """The commit that is checked out in the repository around this package, read from its files; None outside of one."""
    git = next((p / ".git" for p in start.resolve().parents if (p / ".git").is_dir()), None)
    try:
        head = (git / "HEAD").read_text().strip()
        if not (ref := head.removeprefix("ref: ")) or ref == head:
            return head or None
        if (git / ref).is_file():
            return (git / ref).read_text().strip()
        return next((line.split()[0] for line in (git / "packed-refs").read_text().splitlines() if line.endswith(f" {ref}")), None)
    except (OSError, TypeError):
        return None


def run_record(status: str, timing: Timing, **fields: Any) -> dict[str, Any]:
    versions = {"tool_version": __version__, "schema_version": SCHEMA_VERSION, "normalization_version": NORMALIZATION_VERSION, "git_commit": git_commit()}
    place = {"timestamp": now_utc(), "python_version": sys.version.split()[0], "platform": platform.platform(), "dependencies": installed()}
    return json_safe({**versions, **place, "units": {"length": "angstrom"}, "timings": timing.as_dict(), "status": status, **fields})


def write_record(path: str | Path, record: dict[str, Any], keys: DataFrame | None = None) -> None:
    """The record as JSON. With ``keys``, the one column of hexadecimal cache keys of a large run, these are its ``cache_keys`` in order: they are sorted and
    written by tasks, and never held by the driver."""
    if keys is None:
        write_text(path, json.dumps(record, indent=2, sort_keys=True) + "\n")
        return
    mark = "cache keys go here"
    head, _, tail = json.dumps({**record, "cache_keys": [mark]}, indent=2, sort_keys=True).partition(json.dumps(mark))
    indent = head[len(head.rstrip(" ")) :]
    name = F.col(keys.columns[0])
    lines = keys.orderBy(name).select(F.concat(F.lit(f'{indent}"'), name, F.lit('",')).alias("value"))
    write_lines(lines, path, cut=2, head=head.rstrip(" ").encode(), tail=f"{tail}\n".encode())
