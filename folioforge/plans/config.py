"""Settings of a run, from YAML or JSON text."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields
from typing import Any


@dataclass(frozen=True)
class Bootstrap:
    n_resamples: int = 200
    confidence_level: float = 0.95


@dataclass(frozen=True)
class Corpus:
    """A corpus: the file with its documents, the column of their ids, and how many
    are drawn (all, where it isn't said)."""

    file: str
    id: str = "id"
    n: int | None = None

    @classmethod
    def of(cls, entry: str | dict) -> Corpus:
        return cls(entry) if isinstance(entry, str) else cls(entry["file"], entry.get("id", "id"), entry.get("n"))


@dataclass(frozen=True)
class Settings:
    """What a run does."""

    metrics: tuple[str, ...] = ()
    corpora: dict[str, Corpus] = field(default_factory=dict)
    bootstrap: Bootstrap = Bootstrap()
    seed: int = 42
    parser: str = "grobid"
    content: bool = True


def load(text: str) -> Settings:
    """The settings of a text; names that aren't known are errors."""
    raw: Any = parse(text) or {}
    known = {f.name for f in fields(Settings)}
    if wrong := sorted(set(raw) - known):
        raise ValueError(f"unknown settings: {', '.join(wrong)}")
    out = dict(raw)
    if "metrics" in raw:
        out["metrics"] = tuple(raw["metrics"])
    if "bootstrap" in raw:
        out["bootstrap"] = Bootstrap(**raw["bootstrap"])
    if "corpora" in raw:
        out["corpora"] = {k: Corpus.of(v) for k, v in raw["corpora"].items()}
    return Settings(**out)


def parse(text: str) -> Any:
    """YAML where its library is there, JSON else."""
    try:
        import yaml
    except ImportError:
        return json.loads(text)
    return yaml.safe_load(text)
