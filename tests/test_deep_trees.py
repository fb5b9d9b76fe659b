"""Trees of any depth keep all ancestors and descendants."""

import pytest

from sampleloom.operators import lineage as L


def test_deep_tree(spark):
    n = 600
    nodes = spark.createDataFrame([(1, 1, "no rank")] + [(i, i - 1, "species") for i in range(2, n + 2)], "taxid long, parent long, rank string")
    paths = {r["taxid"]: r["path"] for r in L.ancestor_paths(nodes).filter("taxid in (2, 601)").collect()}
    assert paths == {2: [2], 601: list(range(601, 1, -1))}
    assert L.closure(nodes, spark.createDataFrame([(2, "k", 0)], "taxid long, key string, ordinal int")).count() == n
    with pytest.raises(ValueError):
        L.ancestor_paths(nodes, 8)
