"""Planned outputs of a run and its diagnostics document."""

from __future__ import annotations

import datetime as dt
import json
import os
import re
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from enum import Enum
from pathlib import Path

_SECRET = re.compile(r"(?i)(api[_-]?key|authorization|token|secret|password)(\"?\s*[:=]\s*\"?)(?:bearer\s+)?[^\s\",;]+")
_URL_USER = re.compile(r"(https?://)[^/@\s]+@")


def sanitize(text: str, limit: int = 500) -> str:
    """``text`` on one line without secrets or credentials in addresses."""
    return " ".join(_URL_USER.sub(r"\1", _SECRET.sub(r"\1\2[removed]", text)).split())[:limit]


_HIDDEN = re.compile(r"(?i)authorization|cookie|token|secret|password|api[-_]?key")


def sanitize_url(url: str) -> str:
    """An address without credentials, with the values of its secret parameters removed."""
    return re.sub(r"([?&][^=&#]*(?:key|token|secret|password|signature)[^=&#]*=)[^&#]*", r"\1[removed]", _URL_USER.sub(r"\1", url), flags=re.I)


def sanitize_headers(headers: Mapping[str, str]) -> dict[str, str]:
    """Headers by lower-case name, the secret ones without their value."""
    return {k.lower(): "[removed]" if _HIDDEN.search(k) else sanitize(str(v)) for k, v in sorted(headers.items())}


def stable(value: object) -> object:
    """JSON value with enum members as their values and keys in order."""
    if isinstance(value, Enum):
        return stable(value.value)
    if isinstance(value, Mapping):
        return {str(stable(k)): stable(v) for k, v in sorted(value.items(), key=lambda kv: str(stable(kv[0])))}
    if isinstance(value, (list, tuple)):
        return [stable(v) for v in value]
    return value.isoformat() if isinstance(value, (dt.date, dt.datetime)) else value


@dataclass(frozen=True)
class Outputs:
    dataset: Path
    reasoning: Path | None
    prompts: Path | None
    log: Path
    diagnostics: Path

    @classmethod
    def plan(cls, folder: str | Path, name: str, attributes: Sequence[str], with_model: bool, dataset: str | Path | None = None) -> "Outputs":
        f = Path(folder)
        asked = with_model and bool({"iso", "loc"} & set(attributes))
        return cls(Path(dataset) if dataset else f / f"{name}.tsv", f / f"{name}_reasoning.jsonl" if "iso" in attributes else None, f / f"{name}_prompts.txt" if asked else None, f / f"{name}.log", f / f"{name}_diagnostics.json")

    def paths(self) -> list[Path]:
        return [p for p in (self.dataset, self.reasoning, self.prompts, self.log, self.diagnostics) if p is not None]

    def check(self, inputs: Sequence[str | Path] = (), force: bool = False) -> None:
        """No two outputs may be one file, none may be an input, and none may exist unless ``force``."""
        real = [Path(os.path.realpath(p)) for p in self.paths()]
        if len(set(real)) != len(real):
            raise ValueError("two outputs are the same file")
        if both := set(real) & {Path(os.path.realpath(p)) for p in inputs}:
            raise ValueError(f"an output is an input: {sorted(map(str, both))[0]}")
        if not force and (there := [p for p in self.paths() if p.exists()]):
            raise FileExistsError(f"{there[0]} exists")


class Diagnostics:
    """Document of a run, replaced as a whole after every change."""

    def __init__(self, path: str | Path, **about: object) -> None:
        self.path, self._began, self._mark = Path(path), time.monotonic(), time.monotonic()
        self.document: dict = {"schema_version": 2, "status": "running", "phase": "starting", "phase_seconds": {}, **about}
        self._write()

    def phase(self, name: str) -> None:
        self._elapsed()
        self.document["phase"] = name
        self._write()

    def finish(self, status: str, error: BaseException | None = None, **more: object) -> None:
        self._elapsed()
        self.document |= {"status": status, "total_seconds": round(time.monotonic() - self._began, 6), **more}
        if error is not None:
            self.document["error"] = {"type": type(error).__name__, "message": sanitize(str(error))}
        self._write()

    def _elapsed(self) -> None:
        now = time.monotonic()
        seconds = self.document["phase_seconds"]
        seconds[self.document["phase"]] = round(seconds.get(self.document["phase"], 0) + now - self._mark, 6)
        self._mark = now

    def _write(self) -> None:
        temp = self.path.with_name(self.path.name + ".new")
        temp.write_text(json.dumps(stable(self.document), indent=2, ensure_ascii=False) + "\n", encoding="utf-8")
        os.replace(temp, self.path)


def prompt_snapshot(sections: Sequence[tuple[str, str, str | None, Mapping[str, str]]]) -> str:
    """Text of the prompts in use: ``(pipeline, model, version, role -> text)`` each, with their lengths."""
    out = []
    for pipeline, model, version, texts in sections:
        out.append(f"# {pipeline}\nmodel: {model}" + (f"\nversion: {version}" if version else ""))
        out += [f"## {role} ({len(text)} characters)\n{text}" for role, text in texts.items()]
    return "\n\n".join(out) + "\n"
