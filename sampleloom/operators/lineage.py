"""Trees: ancestor paths by path doubling, subtree closure, retired ids, lineage columns.

A path of length n is joined to the path of its last node, so depth d takes about log2(d) joins, without the level and
row limits of recursive queries; every round is cut, as a plan that joins itself would double.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampleloom.operators.ranking import dimension
from sampleloom.session import cut

# Ranks that a lineage shows.
RANKS = (
    "subspecies", "species", "subgenus", "genus", "tribe", "subfamily", "family", "superfamily", "parvorder", "infraorder",
    "suborder", "order", "superorder", "infraclass", "subclass", "class", "clade", "phylum", "kingdom", "no rank",
)
ROOT = 1


def ancestor_paths(nodes: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """``(taxid, path)`` for ``nodes (taxid, parent)``: the taxon, its parent and so on, without the root.

    A path ends before the root, before a parent that is not in the table, and before a node it already holds. Null ids
    and copies are left out. Any depth: the length at least doubles in each round, and cycles end by the overlap. With
    ``max_rounds`` a tree of more than 2**max_rounds levels fails.
    """
    edges = nodes.filter("taxid is not null").select("taxid", "parent").dropDuplicates(["taxid"])
    known = edges.select(F.col("taxid").alias("parent"), F.lit(True).alias("__known"))
    base = edges.filter(F.col("taxid") != ROOT).join(known, "parent", "left")
    stop = F.col("__known").isNull() | (F.col("parent") == ROOT) | (F.col("parent") == F.col("taxid"))
    paths = cut(base.select("taxid", F.array("taxid").alias("path"), F.when(~stop, F.col("parent")).alias("up")))
    rounds = 0
    while paths.filter("up is not null").limit(1).count():
        if rounds == max_rounds:
            raise ValueError(f"the tree has more than {2**max_rounds} levels")
        rounds += 1
        far = paths.select(F.col("taxid").alias("up"), F.col("path").alias("__p"), F.col("up").alias("__u"))
        more = paths.join(far, "up", "left")
        joined = F.concat("path", F.coalesce("__p", F.array().cast("array<bigint>")))
        loop = F.arrays_overlap("path", "__p")
        paths = cut(more.select("taxid", F.when(F.coalesce(loop, F.lit(False)), F.array_distinct(joined)).otherwise(joined).alias("path"), F.when(~F.coalesce(loop, F.lit(False)), F.col("__u")).alias("up")))
    return paths.select("taxid", "path")


def closure(nodes: DataFrame, seeds: DataFrame) -> DataFrame:
    """``(taxid, key)`` of all nodes below or at ``seeds (taxid, key, ordinal)``; the first seed wins on overlap."""
    up = ancestor_paths(nodes).select("taxid", F.explode("path").alias("__a"))
    s = dimension(seeds.select(F.col("taxid").alias("__a"), "key", "ordinal"))
    return up.join(s, "__a").groupBy("taxid").agg(F.min(F.struct("ordinal", "key"))["key"].alias("key"))


def with_retired(closed: DataFrame, merged: DataFrame) -> DataFrame:
    """Adds retired ids of ``merged (old, new)`` whose new id is in the closure and whose old id is not (one hop)."""
    old = merged.join(closed.withColumnRenamed("taxid", "new"), "new").join(closed.select(F.col("taxid").alias("old")), "old", "left_anti")
    return closed.unionByName(old.groupBy(F.col("old").alias("taxid")).agg(F.min(F.struct("new", "key"))["key"].alias("key")))


def lineages(nodes: DataFrame, names: DataFrame, ranks: tuple[str, ...] = RANKS) -> DataFrame:
    """``(taxid, common_names, lineage_names, lineage_taxids)`` from ``nodes (taxid, parent, rank)``, ``names (taxid, name, common_names)``.

    Ancestors run from the root to the tip, only those of a shown rank; missing names are empty.
    """
    nodes, names = nodes.select("taxid", "parent", "rank"), names.select("taxid", "name", "common_names")
    info = nodes.dropDuplicates(["taxid"]).join(names, "taxid", "left").select(F.col("taxid").alias("__a"), "rank", F.coalesce("name", F.lit("")).alias("name"))
    steps = ancestor_paths(nodes).select("taxid", F.posexplode("path").alias("depth", "__a")).join(info, "__a").filter(F.col("rank").isin(*ranks))
    chain = steps.groupBy("taxid").agg(F.sort_array(F.collect_list(F.struct("depth", F.col("__a").cast("string").alias("id"), "name")), asc=False).alias("c"))
    ids = nodes.select("taxid").distinct().join(names.select("taxid", "common_names"), "taxid", "left").join(chain, "taxid", "left")
    text = lambda f: F.coalesce(F.array_join(f"c.{f}", ","), F.lit(""))
    return ids.select("taxid", F.coalesce(F.array_join("common_names", ","), F.lit("")).alias("common_names"), text("name").alias("lineage_names"), text("id").alias("lineage_taxids"))
