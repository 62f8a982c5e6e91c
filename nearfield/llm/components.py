"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfield.session import cut_lineage

FOREST_ROWS = 1_000_000


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Replace the links of a task by (node, smallest node it reaches through them)."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent.get(top, top) != top:
            top = parent[top]
        while parent.get(x, x) != top:
            parent[x], x = top, parent[x]
        return top

    def flush() -> pd.DataFrame:
        nodes = [x for x in parent if root(x) != x]
        out = pd.DataFrame({"u": nodes, "v": [root(x) for x in nodes]}, dtype="int64")
        parent.clear()
        return out

    for batch in batches:
        for a, b in zip(batch["a"].tolist(), batch["b"].tolist()):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > FOREST_ROWS:
            yield flush()
    yield flush()


def connected_components(links: DataFrame) -> DataFrame:
    """``(id, component)`` for every node of ``links`` (``a``, ``b`` long); the component is its
    smallest node.

    Links to itself, repeated links and an empty table are allowed. Every round each node hands its
    larger, then its smaller neighbours to the smallest one it knows, so chains shrink
    exponentially; a round is two minimum aggregations and joins, and no group is ever collected.
    """
    edges = cut_lineage(
        links.where("a != b").select("a", "b").mapInPandas(_forest, "u long, v long").distinct(), "links"
    )
    mark = None
    while True:
        both = edges.unionByName(edges.selectExpr("v u", "u v"))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").selectExpr("v u", "m v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").selectExpr("IF(v = m, u, v) u", "m v").where("u != v")
        kept = least.selectExpr("u", "m v")
        edges = cut_lineage(small.unionByName(kept).distinct(), "links")
        state = edges.agg(
            F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))"), F.count_distinct("v")
        ).first()
        if state == mark:
            break
        mark = state
    roots = edges.selectExpr("v id", "v component").distinct()
    return edges.selectExpr("u id", "v component").unionByName(roots)
