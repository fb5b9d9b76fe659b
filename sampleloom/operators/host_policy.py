"""Host policy: curated terms, forced and rejected values, routing keywords, checked alone and against the taxa."""

from __future__ import annotations

import re
import string
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleloom.operators import hosts as H
from sampleloom.operators.ranking import dimension

# Version and sections of the policy, ways in which a curated term counts.
VERSION = 2
SECTIONS = {"normalization": "ignored_substrings", "routing": "isolation_source_keywords", "value_rejections": "exact"}
MODES = ("exact", "subset", "force")
_DROP = str.maketrans("_-", "  ", "".join(c for c in string.punctuation if c not in "_-"))


def host_form(text: str) -> str:
    """The form of :func:`sampleloom.functions.strings.norm_host`, on the driver."""
    return " ".join(text.lower().translate(_DROP).split())


def _section(config: Mapping, name: str, allowed: Iterable[str]) -> Mapping:
    part = config.get(name)
    if not isinstance(part, Mapping):
        raise ValueError(f"host policy: {name} is no mapping")
    if more := sorted(map(str, part.keys() - set(allowed))):
        raise ValueError(f"host policy: {name} has unknown entries {', '.join(more)}")
    return part


def _texts(values: object, where: str) -> tuple[str, ...]:
    if not isinstance(values, (list, tuple)) or not all(isinstance(v, str) and host_form(v) for v in values):
        raise ValueError(f"host policy: {where} must list texts that are not blank")
    return tuple(values)


@dataclass(frozen=True)
class HostPolicy:
    """``terms`` are (taxid, scientific name, mode, term as written)."""

    ignored: tuple[str, ...]
    keywords: tuple[str, ...]
    terms: tuple[tuple[int, str, str, str], ...]
    rejected: tuple[str, ...]
    named: Mapping[int, str]

    @classmethod
    def of(cls, config: Mapping) -> "HostPolicy":
        """A policy from its configuration. Unknown entries, blank terms, taxids that are not canonical, terms in two modes or
        for two taxa, and terms that are also rejected fail."""
        if config.get("schema_version") != VERSION:
            raise ValueError(f"host policy: version {VERSION} is needed")
        if more := sorted(map(str, config.keys() - {"schema_version", "curated_taxa", *SECTIONS})):
            raise ValueError(f"host policy: unknown entries {', '.join(more)}")
        lists = {s: _texts(_section(config, s, {key}).get(key), f"{s}.{key}") for s, key in SECTIONS.items()}
        taxa = config.get("curated_taxa")
        if not isinstance(taxa, Mapping):
            raise ValueError("host policy: curated_taxa is no mapping")
        terms, named = [], {}
        for taxid in taxa:
            if not isinstance(taxid, str) or not re.fullmatch(r"[1-9][0-9]*", taxid):
                raise ValueError(f"host policy: {taxid!r} is no canonical taxid text")
            body = _section(taxa, taxid, ("scientific_name", "match_terms"))
            name = body.get("scientific_name")
            if not isinstance(name, str) or not name.strip():
                raise ValueError(f"host policy: taxid {taxid} has no scientific name")
            named[int(taxid)] = name
            modes = _section(body, "match_terms", MODES)
            terms += [(int(taxid), name, mode, term) for mode in MODES for term in _texts(modes.get(mode, []), f"{taxid}.{mode}")]
        owner: dict[str, tuple[int, str]] = {}
        for taxid, _, mode, term in terms:
            if owner.setdefault(host_form(term), (taxid, mode)) != (taxid, mode):
                raise ValueError(f"host policy: term {term!r} stands in two places")
        rejected = lists["value_rejections"]
        if both := sorted(owner.keys() & set(map(host_form, rejected))):
            raise ValueError(f"host policy: {both[0]!r} is both a term and rejected")
        return cls(lists["normalization"], lists["routing"], tuple(terms), rejected, named)

    def curated(self, spark: SparkSession) -> DataFrame:
        """``(taxid, term, allow_subset)`` for :func:`sampleloom.operators.hosts.term_table`."""
        return spark.createDataFrame([(t, term, mode == "subset") for t, _, mode, term in self.terms if mode != "force"], "taxid long, term string, allow_subset boolean")

    def preempt(self, spark: SparkSession) -> DataFrame:
        """``(norm_value, taxid)`` of forced values, and of rejected ones with a null taxid."""
        rows = {host_form(term): t for t, _, mode, term in self.terms if mode == "force"} | {host_form(v): None for v in self.rejected}
        return spark.createDataFrame(sorted(rows.items()), "norm_value string, taxid long")

    def problems(self, spark: SparkSession, taxa: DataFrame) -> DataFrame:
        """``(taxid, problem, detail)``: curated taxa that ``taxa`` lacks or names otherwise, and terms (but forced ones) that are an
        exact name or synonym of another taxon."""
        named = dimension(spark.createDataFrame(sorted(self.named.items()), "taxid long, __want string"))
        known = taxa.select("taxid", "scientific_name")
        told = named.join(known, "taxid", "left")
        wrong = told.filter("scientific_name is null or scientific_name <> __want").select("taxid", F.when(F.col("scientific_name").isNull(), "absent").otherwise("name").alias("problem"), F.coalesce("scientific_name", F.lit("")).alias("detail"))
        exact = H.exact_terms(H.term_table(taxa).filter("tier <= 2")).select("norm_term", F.col("taxid").alias("__owner"))
        mine = dimension(spark.createDataFrame([(t, host_form(term)) for t, _, mode, term in self.terms if mode != "force"], "taxid long, norm_term string"))
        taken = mine.join(exact, "norm_term").filter("taxid <> __owner").select("taxid", F.lit("term").alias("problem"), F.col("norm_term").alias("detail"))
        return wrong.unionByName(taken)

    def require(self, spark: SparkSession, taxa: DataFrame) -> None:
        if bad := self.problems(spark, taxa).orderBy("taxid", "problem", "detail").limit(1).collect():
            raise ValueError(f"host policy: taxid {bad[0]['taxid']}: {bad[0]['problem']} {bad[0]['detail']!r}")
