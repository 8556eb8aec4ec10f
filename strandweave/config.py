"""Settings as frozen dataclasses; unknown keys are errors."""

from __future__ import annotations

import dataclasses
import json
import os
from pathlib import Path
from typing import Self

from strandweave.functions.text import EXTENSIONS
from strandweave.sources.records import SKIPPED


class Strict:
    """Reads a dataclass from a mapping or a JSON file."""

    @classmethod
    def from_mapping(cls, values: dict) -> Self:
        known = {f.name for f in dataclasses.fields(cls)}
        if unknown := sorted(set(values) - known):
            raise ValueError(f"unknown keys: {', '.join(unknown)}")
        return cls(**values)

    @classmethod
    def from_file(cls, path: str) -> Self:
        return cls.from_mapping(json.loads(Path(path).read_text()))


@dataclasses.dataclass(frozen=True)
class Alignment(Strict):
    anchor: str = "rgb"
    expected: tuple[str, ...] = ()
    tolerance_ms: float = 50.0
    accept: float = 0.85
    shard_bytes: int = 512 * 1024 * 1024
    #: Extensions of each modality, and names that a folder scan skips.
    extensions: dict[str, list[str]] = dataclasses.field(default_factory=lambda: dict(EXTENSIONS))
    skipped: tuple[str, ...] = tuple(SKIPPED)


@dataclasses.dataclass(frozen=True)
class Segmentation(Strict):
    clip_s: float = 30.0
    overlap_s: float = 2.0
    fps: float = 30.0
    below: float = 0.01
    least: int = 5
    most_gap: int = 5


def env_bool(name: str, default: bool = False) -> bool:
    value = os.environ.get(name, "").strip().lower()
    return value in ("1", "true", "yes", "on") if value else default


def env_int(name: str, default: int) -> int:
    try:
        return int(os.environ.get(name, ""))
    except ValueError:
        return default


def dotenv(text: str) -> dict[str, str]:
    """KEY=value lines; comments and blank lines go, quotes around a value too."""
    out = {}
    for line in text.splitlines():
        line = line.strip()
        if line and not line.startswith("#") and "=" in line:
            key, value = line.split("=", 1)
            value = value.strip()
            out[key.strip()] = value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "\"'" else value
    return out


#: The model slots and the group whose setting counts where the slot has none; names a setting may have.
SLOTS = {"geocalib": "HANDPOSE", "moge2": "HANDPOSE", "megasam": "HANDPOSE", "hawor_s1": "HANDPOSE", "hawor_s2": "HANDPOSE", "language": "ANNOTATOR", "actions": "ANNOTATOR", "quality": "ANNOTATOR"}
KNOWN = ["mock", "real", "real_ingest", "rule_based", "remote"]
#: What the model slots take and give, by the names of the columns and the widths of vectors; n is free.
CONTRACTS = {
    "geocalib": ({"frame": "n"}, {"fx": 1, "fy": 1, "cx": 1, "cy": 1}),
    "moge2": ({"frame": "n"}, {"depth": "n"}),
    "megasam": ({"frame": "n", "depth": "n"}, {"rotation": 9, "place": 3}),
    "hawor_s1": ({"frame": "n"}, {"box": 4, "hand": 1, "score": 1}),
    "hawor_s2": ({"frame": "n", "box": 4}, {"points": 63, "pose": 45, "betas": 10, "orient": 3}),
}
PREFIX = "STRANDWEAVE_"


class Backends:
    """Column functions and UDFs by slot and name; an unknown name is an error when the plan is built."""

    def __init__(self) -> None:
        self.known: dict[tuple[str, str], object] = {}

    @staticmethod
    def chosen(slot: str) -> str:
        """The backend that the environment names for a slot or its group, else mock; read anew each time."""
        key, group = f"{PREFIX}{slot.upper()}_BACKEND", f"{PREFIX}{SLOTS.get(slot, 'HANDPOSE')}_BACKEND"
        name = (os.environ.get(key, "").strip() or os.environ.get(group, "").strip() or "mock").lower()
        if name not in KNOWN:
            raise ValueError(f"{key}={name} is none of {', '.join(KNOWN)}")
        return name

    @staticmethod
    def weights(slot: str) -> str | None:
        """Where the environment says that a slot's weights lie."""
        return os.environ.get(f"{PREFIX}{slot.upper()}_WEIGHTS", "").strip() or None

    @staticmethod
    def device(slot: str, default: str = "cpu") -> str:
        return os.environ.get(f"{PREFIX}{slot.upper()}_DEVICE", "").strip() or os.environ.get(f"{PREFIX}DEVICE", "").strip() or default

    def of_environment(self, slot: str) -> object:
        """The backend that the environment chooses; one that is known by name only isn't wired."""
        name = self.chosen(slot)
        if (slot, name) not in self.known:
            raise NotImplementedError(f"backend {name} for {slot} isn't wired; set {PREFIX}{slot.upper()}_BACKEND=mock or register it")
        return self.known[slot, name]

    def register(self, slot: str, name: str, make: object) -> None:
        self.known[slot, name] = make

    @staticmethod
    def check(slot: str, row: dict) -> list[str]:
        """How a row that a slot's backend gives breaks the slot's contract."""
        size = lambda v: len(v) if isinstance(v, (list, tuple)) else 1
        given = CONTRACTS[slot][1]
        lacks = [f"{k} is missing" for k in given if k not in row]
        return lacks + [f"{k} has {size(row[k])} numbers, not {n}" for k, n in given.items() if k in row and n != "n" and size(row[k]) != n]

    def get(self, slot: str, name: str) -> object:
        if (slot, name) not in self.known:
            raise LookupError(f"no backend {name} for {slot}; there are {sorted(n for s, n in self.known if s == slot)}")
        return self.known[slot, name]
