"""Components of very large graphs, as rounds of joins over staged tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.operators.skew import lookup_join
from claimweave.operators.staging import Staged, stage, tidy


def undirected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct edges (u, v) with u < v; rows with a null end and loops are left out."""
    return (
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v"))
        .distinct()
    )


def both_ways(edges: DataFrame) -> DataFrame:
    """Each undirected edge as two rows (node, other)."""
    return edges.select(
        F.explode(F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("other")), F.struct(F.col("v").alias("node"), F.col("u").alias("other")))).alias("e")
    ).select("e.node", "e.other")


def pointer_jump(parents: Staged) -> Staged:
    """Roots of a forest (node, parent) by pointer doubling.

    A root points at itself.  Each round replaces a parent by the parent's
    parent, so a chain of length n needs log2(n) rounds.  Parents are looked at
    once each, however many nodes point at them, and a round is written only if
    some parent is no root yet; nodes meet the parents that move by a join in
    which those with a large share of all nodes are kept apart.
    """
    while True:
        table = parents.df
        heads = table.select(F.col("parent").alias("node")).distinct()
        moves = stage(heads.join(table, "node").where("parent <> node").select(F.col("node").alias("parent"), F.col("parent").alias("grand")), "moves")
        if moves.empty():
            moves.drop()
            return parents
        after = stage(lookup_join(table, moves.df, "parent").select("node", F.coalesce("grand", "parent").alias("parent")), "jump")
        parents.drop()
        moves.drop()
        parents = after


def contract(edges: Staged, roots: Staged) -> Staged:
    """Edges between roots: both ends replaced, loops and repeats dropped; the edges of a hub are spread."""
    r = roots.df.where("node <> parent")
    left = lookup_join(edges.df, r.select(F.col("node").alias("u"), F.col("parent").alias("ru")), "u")
    both = lookup_join(left, r.select(F.col("node").alias("v"), F.col("parent").alias("rv")), "v")
    ends = both.select(F.coalesce("ru", "u").alias("ru"), F.coalesce("rv", "v").alias("rv"))
    return stage(undirected(ends, "ru", "rv"), "edges")


def flatten_rounds(rounds: list[Staged]) -> DataFrame:
    """node -> component over all rounds: each later table maps roots of the one before."""
    out = rounds[0].df.select("node", F.col("parent").alias("component"))
    for r in rounds[1:]:
        nxt = r.df.select(F.col("node").alias("component"), F.col("parent").alias("__next"))
        out = out.join(nxt, "component", "left").select("node", F.coalesce("__next", "component").alias("component"))
    return out


@tidy
def connected_components(edges: DataFrame, a: str = "src", b: str = "dst") -> DataFrame:
    """(node, component) for every node with an edge; component is its smallest node.

    Each round every node hooks onto its smallest neighbour if that is smaller,
    the trees collapse by pointer doubling and the edges are relabelled.  Nulls
    and loops name no edge; an empty input gives an empty result.
    """
    current = stage(undirected(edges, a, b), "edges")
    rounds: list[Staged] = []
    while not current.empty():
        hooked = both_ways(current.df).groupBy("node").agg(F.least(F.first("node"), F.min("other")).alias("parent"))
        roots = pointer_jump(stage(hooked, "hook"))
        rounds.append(roots)
        following = contract(current, roots)
        current.drop()
        current = following
    if not rounds:
        return current.df.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return flatten_rounds(rounds)
