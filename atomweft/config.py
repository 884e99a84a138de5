"""Configuration of a prediction run: command line over file over defaults."""

from __future__ import annotations

import json
from collections import ChainMap
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field
from pathlib import Path
from typing import Any

from atomweft.errors import ConfigError

# Field names, defaults, option values and the words for true and false are those of the command's contract.
CHOICES = {
    "device": ("auto", "cpu", "cuda"),
    "output_format": ("auto", "csv", "parquet"),
    "magres_mode": ("none", "per-frame", "single"),
    "on_warning": ("warn", "error", "skip"),
    "property_mode": ("iso", "tensor", "both"),
}
OPTIONS = {"property_mode": "--property", "output_format": "--format", "magres_mode": "--magres"}
ALIASES = {"property": "property_mode", "format": "output_format", "magres": "magres_mode"}
TRUE, FALSE = ("1", "true", "yes", "on"), ("0", "false", "no", "off")


def json_safe(value: Any) -> Any:
    """What a reader of the value's JSON gets; whatever JSON has no form for, such as a path, is text."""
    return json.loads(json.dumps(value, default=str))


@dataclass(frozen=True)
class PredictConfig:
    outdir: Path
    frames: str = ":"
    device: str = "auto"
    workers: int = 1
    chunk_size: int = 200
    cache_chunk_max_mb: float = 100.0
    committee: bool = False
    property_mode: str | None = None
    output_format: str = "auto"
    magres_mode: str = "none"
    cache_dir: Path | None = None
    config_path: Path | None = None
    dry_run: bool = False
    on_warning: str = "warn"
    force_multi_gpu: bool = False
    predictor: str | None = None
    command_args: dict[str, Any] = field(default_factory=dict)

    def as_dict(self) -> dict[str, Any]:
        return json_safe(asdict(self))

    def validate(self) -> PredictConfig:
        for name, allowed in CHOICES.items():
            value = getattr(self, name)
            if value not in allowed and not (name == "property_mode" and value is None):
                raise ConfigError(f"{OPTIONS.get(name, '--' + name.replace('_', '-'))} must be one of {'|'.join(allowed)}")
        for name, low, text in (("workers", 1, ">= 1"), ("chunk_size", 1, ">= 1"), ("cache_chunk_max_mb", 0, "> 0")):
            if getattr(self, name) < low or (low == 0 and getattr(self, name) <= 0):
                raise ConfigError(f"--{name.replace('_', '-')} must be {text}")
        return self


def layered(*layers: Mapping[str, Any]) -> Mapping[str, Any]:
    """One mapping of several: the first layer that has a value other than None for a name counts."""
    return ChainMap(*({k: v for k, v in layer.items() if v is not None} for layer in layers))


def to_bool(value: Any, name: str) -> bool:
    if isinstance(value, bool):
        return value
    text = str(value).strip().lower() if isinstance(value, (int, str)) else ""
    if text in TRUE or text in FALSE:
        return text in TRUE
    raise ConfigError(f"{name} must be a boolean")


def load_mapping(path: Path, what: str, error: type[ValueError] = ConfigError) -> dict[str, Any]:
    """A JSON object, or a YAML mapping for .yml and .yaml; an empty YAML file is an empty mapping."""
    try:
        text = Path(path).read_text(encoding="utf-8")
        if Path(path).suffix.lower() in (".yml", ".yaml"):
            try:
                import yaml
            except ImportError as e:
                raise error(f"{what} is YAML but PyYAML is not installed") from e
            value = yaml.safe_load(text)
            value = {} if value is None else value
        else:
            value = json.loads(text)
    except error:
        raise
    except OSError as e:
        raise error(f"{what} cannot be read: {path}") from e
    except Exception as e:
        raise error(f"{what} is malformed: {e}") from e
    if not isinstance(value, dict):
        raise error(f"{what} must be a mapping at its top level")
    return value


def build_config(outdir: Path, given: dict[str, Any], config_path: Path | None = None) -> PredictConfig:
    """``given`` are the command-line values; None means not given, so a file's value holds. Unknown keys of a file are ignored."""
    file = load_mapping(config_path, "the configuration file") if config_path else {}
    file = {ALIASES.get(k, k): v for k, v in sorted(file.items(), key=lambda kv: kv[0] not in ALIASES)}

    pick = layered(given, file).get

    def convert(name: str, default: Any, kind: type) -> Any:
        try:
            return kind(pick(name, default))
        except (TypeError, ValueError) as e:
            raise ConfigError(f"{name} must be a number") from e

    word = lambda name, default: None if (v := pick(name, default)) is None else str(v).strip().lower()
    flag = lambda name: to_bool(pick(name, False), name)
    cache = pick("cache_dir", None)
    return PredictConfig(
        outdir=Path(outdir),
        frames=str(pick("frames", ":")),
        device=word("device", "auto"),
        workers=convert("workers", 1, int),
        chunk_size=convert("chunk_size", 200, int),
        cache_chunk_max_mb=convert("cache_chunk_max_mb", 100.0, float),
        committee=flag("committee"),
        property_mode=word("property_mode", None),
        output_format=word("output_format", "auto"),
        magres_mode=word("magres_mode", "none"),
        cache_dir=Path(cache) if cache else None,
        config_path=Path(config_path) if config_path else None,
        dry_run=flag("dry_run"),
        on_warning="error" if flag("strict") else word("on_warning", "warn"),
        force_multi_gpu=flag("force_multi_gpu"),
        predictor=str(path) if (path := pick("predictor", None)) else None,
        command_args={k: v for k, v in given.items() if v is not None},
    ).validate()
