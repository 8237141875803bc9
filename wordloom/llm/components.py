"""Connected components by randomised contraction.

Each round every node hooks onto the node of lowest random priority among
itself and its neighbours, and links are renamed to the hooks; the expected
number of nodes falls by a constant factor a round, also for long chains and
for hubs.  Neighbour minima are partial aggregates, so a hub is never gathered
in one task.  Rounds are written to the shared folder; the hooks are composed
from the last round back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links (a bigint, b bigint)``; nodes
    share a root exactly when links connect them.  Self links give a node its
    own component; without links the result is empty."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = materialise(both.distinct(), "links0")
    hooks: list[DataFrame] = []
    while not edges.isEmpty():
        k = len(hooks)

        def priority(c: str, k: int = k):
            return F.struct(F.xxhash64(F.col(c), F.lit(k)).alias("p"), F.col(c).alias("id"))

        near = edges.groupBy("a").agg(F.min(priority("b")).alias("m"))
        hook = materialise(near.select(F.col("a").alias("node"), F.least("m", priority("a"))["id"].alias("root")), f"hook{k}")
        hooks.append(hook)
        named = (
            edges.join(hook.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a")
            .join(hook.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b")
            .where("ra <> rb")
            .select(F.col("ra").alias("a"), F.col("rb").alias("b"))
        )
        edges = materialise(named.distinct(), f"links{k + 1}")
    if not hooks:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = hooks[-1]
    for hook in reversed(hooks[:-1]):
        later = roots.select(F.col("node").alias("root"), F.col("root").alias("last"))
        roots = materialise(hook.join(later, "root", "left").select("node", F.coalesce("last", "root").alias("root")), "roots")
    return roots
