"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from landrank.llm.common import attach, dropped, written

#: More rounds than any graph of 2^63 nodes needs.
ROUNDS = 200
#: Nodes that a task holds while it contracts its edges.
HELD = 300_000


def contracted(edges: DataFrame) -> DataFrame:
    """edges (u, v) with the same components: each task ties what hangs together by its own edges to the least of it."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        up: dict[int, int] = {}

        def root(x: int) -> int:
            while (y := up.setdefault(x, x)) != x:
                up[x] = x = up[y]
            return x

        def stars() -> pd.DataFrame:
            out = [(x, root(x)) for x in list(up)]
            up.clear()
            return pd.DataFrame([p for p in out if p[0] != p[1]], columns=["u", "v"], dtype="int64")

        for b in batches:
            for a, c in zip(b["u"].tolist(), b["v"].tolist(), strict=True):
                a, c = root(a), root(c)
                if a != c:
                    up[max(a, c)] = min(a, c)
            if len(up) > HELD:
                yield stars()
        yield stars()

    return edges.mapInPandas(run, "u long, v long")


def _counted(edges: DataFrame, name: str) -> tuple[DataFrame, int]:
    """The edges, written, and their number."""
    seen = Observation()
    out = written(edges.observe(seen, F.count(F.lit(1)).alias("n")), name)
    return out, seen.get["n"]


def components(edges: DataFrame) -> DataFrame:
    """edges (a long, b long) to node, component: the least node that can be reached, for every node with an edge.

    Edges are contracted within tasks, then large stars and small stars follow in turn: each node hands its larger, then
    its smaller neighbours to the least of them, until stars are left.  A node of very many edges is never one task's:
    only the minimum over its edges is taken, partly before the shuffle, and that comes back through attach().  Nulls
    and loops are ignored; repeated edges count once; no edges give no rows.
    """
    e = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    e, held = _counted(contracted(e).distinct(), "edges")
    for _ in range(ROUNDS):
        if not held:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("n"))
        if least.filter("m < u and n > 1").isEmpty():  # only stars, each about its least node
            break
        large = attach(both, least, "u", "v", 2 * held).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large, n = _counted(large.filter("u <> v").distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        small = attach(large, least, "u", "v", n).select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        after, held = _counted(small.filter("u <> v").distinct(), "small")
        dropped(large)
        dropped(e)
        e = after
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
