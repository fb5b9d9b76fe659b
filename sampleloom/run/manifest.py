"""Source snapshots and derived bundles: strict documents with hashes, checked before anything is read."""

from __future__ import annotations

import datetime as dt
import hashlib
import os
import shutil
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from pathlib import Path

CHUNK = 1 << 20


def sha256_of(path: str | Path) -> str:
    """Hash of a file, or of the names and hashes of all part files of a folder."""
    path, h = Path(path), hashlib.sha256()
    if path.is_dir():
        for p in sorted(x for x in path.rglob("*") if x.is_file() and not x.name.startswith((".", "_"))):
            h.update(f"{p.relative_to(path)}\0{sha256_of(p)}\n".encode())
        return h.hexdigest()
    with path.open("rb") as f:
        while block := f.read(CHUNK):
            h.update(block)
    return h.hexdigest()


def _exact(document: Mapping, fields: Iterable[str], optional: Iterable[str], where: object) -> None:
    need, may = set(fields), set(optional)
    if missing := sorted(need - document.keys()):
        raise ValueError(f"{where}: missing {', '.join(missing)}")
    if more := sorted(document.keys() - need - may):
        raise ValueError(f"{where}: unknown {', '.join(more)}")


@dataclass(frozen=True)
class Snapshot:
    snapshot_id: str
    provider: str
    retrieved_on: dt.date
    reference_date: dt.date
    files: tuple[tuple[str, str], ...]
    as_of: dt.date | None = None

    @classmethod
    def of(cls, doc: Mapping, where: object = "manifest") -> "Snapshot":
        _exact(doc, ("manifest_version", "snapshot_id", "provider", "retrieved_on", "metadata_reference_date", "files"), ("snapshot_as_of", "source_url", "notes"), where)
        day = lambda v: v if isinstance(v, dt.date) else dt.date.fromisoformat(v)
        files = []
        for f in doc["files"]:
            _exact(f, ("name", "sha256"), (), where)
            if len(f["sha256"]) != 64 or Path(f["name"]).name != f["name"]:
                raise ValueError(f"{where}: bad file entry {f['name']!r}")
            files.append((f["name"], f["sha256"].lower()))
        if not files or len({n for n, _ in files}) != len(files) or len({h for _, h in files}) != len(files):
            raise ValueError(f"{where}: files and hashes must be there once each")
        as_of = day(doc["snapshot_as_of"]) if doc.get("snapshot_as_of") else None
        out = cls(doc["snapshot_id"], doc["provider"], day(doc["retrieved_on"]), day(doc["metadata_reference_date"]), tuple(files), as_of)
        if out.reference_date != (as_of or out.retrieved_on):
            raise ValueError(f"{where}: the reference date must be the day of the snapshot")
        return out

    @classmethod
    def load(cls, path: str | Path) -> "Snapshot":
        import yaml

        return cls.of(yaml.safe_load(Path(path).read_text(encoding="utf-8")), path)

    def check_inputs(self, paths: Iterable[str | Path]) -> None:
        """The inputs must be exactly the files of the snapshot, with their hashes."""
        given = {Path(p).name: p for p in paths}
        named = dict(self.files)
        if missing := sorted(named.keys() - given.keys()):
            raise ValueError(f"{self.snapshot_id}: missing inputs {', '.join(missing)}")
        if more := sorted(given.keys() - named.keys()):
            raise ValueError(f"{self.snapshot_id}: unexpected inputs {', '.join(more)}")
        for name, expected in named.items():
            if sha256_of(given[name]) != expected:
                raise ValueError(f"{self.snapshot_id}: {name} has another hash")


def provenance(manifests: Mapping[str, tuple[str, str | Path]], artifacts: Mapping[str, str | Path], digest: Callable[[object], str] = sha256_of) -> dict:
    """Document of a derived bundle: ``manifests`` name -> (snapshot id, path), ``artifacts`` name -> path; ``digest`` hashes a file or folder."""
    return {
        "bundle_version": 1,
        "source_manifests": {k: {"snapshot_id": i, "path": str(p), "sha256": digest(p)} for k, (i, p) in manifests.items()},
        "artifacts": {k: {"path": Path(p).name, "sha256": digest(p)} for k, p in artifacts.items()},
    }


def check_bundle(document: Mapping, folder: str | Path, manifests: Mapping[str, str | Path], digest: Callable[[object], str] = sha256_of) -> None:
    """Every artifact and manifest of the bundle must still be what it was."""
    _exact(document, ("bundle_version", "source_manifests", "artifacts"), (), "bundle")
    for name, entry in document["artifacts"].items():
        path = Path(folder) / entry["path"]
        if not path.exists() or digest(path) != entry["sha256"]:
            raise ValueError(f"bundle: artifact {name} is missing or changed")
    for name, entry in document["source_manifests"].items():
        if name not in manifests or digest(manifests[name]) != entry["sha256"]:
            raise ValueError(f"bundle: manifest {name} is missing or changed")


def publish(staged: Mapping[str, str | Path], folder: str | Path, marker: str) -> None:
    """Move staged files or folders into ``folder``: the old marker goes first, the new one comes last.

    If anything fails the bundle has no marker, so it is never taken for a whole one.
    """
    folder = Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    final = folder / marker
    final.unlink(missing_ok=True)
    if marker not in staged:
        raise ValueError("the marker must be among the staged files")
    try:
        for name in [*(n for n in staged if n != marker), marker]:
            target = folder / name
            if target.is_dir():
                shutil.rmtree(target)
            os.replace(staged[name], target)
    except BaseException:
        final.unlink(missing_ok=True)
        raise
