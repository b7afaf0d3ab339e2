"""Consolidate pairwise matches into groups by deterministic Borůvka hooking.

With edges ordered by (smaller end, larger end) the smallest edge that leaves a
component leads to its smallest neighbour, so hooking is one map-side combined
minimum per round.  Two components that chose the same edge point at each
other; the smaller one becomes the root, and with it the smallest id of the
tree.  Trees collapse by pointer doubling, edges are relabelled, loops and
repeats go, and every round at least halves the components that still have an
edge.

Defined results: pairs with a null id and pairs of an id with itself link
nothing; repeated pairs and either order of the ids count once; the result has
only ids with a link to another id; an empty input gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.operators.graph import both_ways, contract, flatten_rounds, pointer_jump, undirected
from claimweave.operators.staging import Staged, stage, tidy


def _hook(edges: Staged) -> Staged:
    """(node, parent): the smallest neighbour of each node, mutual choices broken towards the smaller id."""
    chosen = stage(both_ways(edges.df).groupBy("node").agg(F.min("other").alias("parent")), "choice")
    back = chosen.df.select(F.col("node").alias("parent"), F.col("parent").alias("returns"))
    mutual = (F.col("returns") == F.col("node")) & (F.col("node") < F.col("parent"))
    hooked = stage(chosen.df.join(back, "parent").select("node", F.when(mutual, F.col("node")).otherwise(F.col("parent")).alias("parent")), "hook")
    chosen.drop()
    return hooked


@tidy
def group_pairs(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """(id, group_id) for every id that a pair links to another; group_id is the smallest id of its group."""
    current = stage(undirected(pairs, a, b), "edges")
    rounds: list[Staged] = []
    while not current.empty():
        roots = pointer_jump(_hook(current))
        rounds.append(roots)
        following = contract(current, roots)
        current.drop()
        current = following
    if not rounds:
        return current.df.select(F.col("u").alias("id"), F.col("v").alias("group_id"))
    return flatten_rounds(rounds).select(F.col("node").alias("id"), F.col("component").alias("group_id"))
