"""What a run ran with: versions, commit, hashes of its configuration; default places of its files."""

from __future__ import annotations

import platform
import subprocess
from collections.abc import Iterable
from dataclasses import dataclass
from pathlib import Path

from sampleloom import __version__
from sampleloom.run.manifest import sha256_of


@dataclass(frozen=True)
class Places:
    """Default paths under one root."""

    root: Path = Path(".")

    @property
    def config(self) -> Path:
        return self.root / "config"

    @property
    def output(self) -> Path:
        return self.root / "output"

    @property
    def data(self) -> Path:
        return self.root / "data"

    @property
    def samples(self) -> Path:
        return self.data / "samples.xml.gz"

    @property
    def projects(self) -> Path:
        return self.data / "projects.xml.gz"

    @property
    def index(self) -> Path:
        return self.data / "index.tsv"

    @property
    def extracted(self) -> Path:
        return self.data / "extracted_metadata.tsv"

    @property
    def taxonomy(self) -> tuple[Path, Path]:
        return self.data / "names.dmp", self.data / "nodes.dmp"


def commit_of(folder: str | Path) -> str | None:
    """Commit of the working tree at ``folder``, if it is one."""
    try:
        got = subprocess.run(["git", "rev-parse", "HEAD"], cwd=folder, capture_output=True, text=True, timeout=2, check=True).stdout.strip()
    except (OSError, subprocess.SubprocessError):
        return None
    return got if len(got) == 40 else None


def describe(configuration: Iterable[str | Path] = ()) -> dict:
    """Versions of the runtime, and the hash of each configuration file (null if it cannot be read)."""
    import pyarrow
    import pyspark

    hashes = {}
    for p in sorted(set(map(str, configuration))):
        try:
            hashes[p] = sha256_of(p)
        except OSError:
            hashes[p] = None
    return {
        "version": __version__, "commit": commit_of(Path(__file__).resolve().parent), "python": platform.python_version(), "platform": platform.platform(),
        "pyspark": pyspark.__version__, "pyarrow": pyarrow.__version__, "configuration": hashes,
    }
