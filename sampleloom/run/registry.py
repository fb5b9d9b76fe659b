"""Registry of target groups: leaves and containers of leaves, in file order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

COLUMNS = "key string, ordinal int, scientific_name string, rank string, taxid long, taxids array<long>, container string"


@dataclass(frozen=True)
class Leaf:
    key: str
    scientific_name: str
    taxid: int
    rank: str
    container: str | None = None
    also: tuple[int, ...] = ()

    @property
    def taxids(self) -> tuple[int, ...]:
        return (self.taxid, *self.also)


class Registry:
    def __init__(self, config: Mapping[str, Mapping]) -> None:
        self.leaves: dict[str, Leaf] = {}
        self.groups: dict[str, list[str]] = {}
        for name, body in config.items():
            inner = {name: body} if "scientific_name" in body else body
            if inner is body:
                self.groups[name] = list(body)
            for key, x in inner.items():
                if key in self.leaves:
                    raise ValueError(f"key given twice: {key}")
                self.leaves[key] = Leaf(key, x["scientific_name"], int(x["ncbi_taxid"]), x["rank"], name if inner is body else None, tuple(map(int, x.get("also_taxids", ()))))

    @classmethod
    def load(cls, path: str | Path) -> "Registry":
        import yaml

        return cls(yaml.safe_load(Path(path).read_text(encoding="utf-8")))

    def expand(self, names: Sequence[str]) -> list[str]:
        """Leaf keys of the named leaves and containers, in the order given, each once."""
        unknown = [n for n in names if n not in self.leaves and n not in self.groups]
        if unknown:
            raise ValueError(f"unknown names: {', '.join(unknown)}")
        return list(dict.fromkeys(k for n in names for k in self.groups.get(n, [n])))

    def scientific_name(self, key: str) -> str:
        leaf = self.leaves.get(key)
        return leaf.scientific_name if leaf else ""

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(x.key, i, x.scientific_name, x.rank, x.taxid, list(x.taxids), x.container) for i, x in enumerate(self.leaves.values())]
        return spark.createDataFrame(rows, COLUMNS)

    def seeds(self, spark: SparkSession) -> DataFrame:
        """``(taxid, key, ordinal)`` of every subtree root, for the closure."""
        rows = [(t, x.key, i) for i, x in enumerate(self.leaves.values()) for t in x.taxids]
        return spark.createDataFrame(rows, "taxid long, key string, ordinal int")
