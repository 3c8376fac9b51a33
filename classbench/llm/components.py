"""Connected components of an undirected graph by repeated contraction.

Each round labels every node with the first node of its closed neighbourhood and
contracts the edges to those labels; the graph shrinks until no edge is left.
First is the smallest in even rounds, which ends stars around their smallest node
at once, and the one of least hash, new in each round, in odd ones, which leave
about a third of a chain whatever its order, so rounds grow with the logarithm of
the longest path.  Labels are followed from the last round to the first, in
tables that shrink as the rounds do; the smallest node of each component is found
at the end.  Minima are aggregated before they are shuffled and joins are plain
equi-joins, which Spark splits when one label holds many nodes; nothing is
collected but edge counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from classbench.llm.common import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b); root is the smallest node of its component.

    Null ends, loops and repeated edges are ignored; no edges give an empty result.
    """
    kind = edges.schema["a"].dataType
    graph = materialize(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    rounds: list[DataFrame] = []
    while not graph.isEmpty():
        n = len(rounds)
        order = lambda x: F.struct(F.xxhash64(F.lit(n), x) if n % 2 else F.lit(0), x)  # noqa: E731, B023
        both = graph.union(graph.select("b", "a"))
        closed = both.select("a", F.explode(F.array("a", "b")).alias("b"))
        label = materialize(closed.groupBy("a").agg(F.min_by("b", order(F.col("b"))).alias("label")).select(
            F.col("a").alias("node"), "label"), "labels")
        rounds.append(label)
        at = lambda end: label.select(F.col("node").alias(end), F.col("label").alias(f"l{end}"))  # noqa: E731, B023
        moved = graph.join(at("a"), "a").join(at("b"), "b").where("la <> lb")
        graph = materialize(moved.select(
            F.greatest("la", "lb").alias("a"), F.least("la", "lb").alias("b")).distinct(), "edges")
    if not rounds:
        return graph.select(F.col("a").alias("node"), F.col("b").alias("root")).where(F.lit(False))
    roots = rounds[-1].select("node", F.col("label").alias("root"))
    for i, label in enumerate(reversed(rounds[:-1]), 1):
        after = roots.select(F.col("node").alias("label"), F.col("root").alias("next"))
        roots = label.join(after, "label", "left").select("node", F.coalesce("next", "label").alias("root"))
        roots = materialize(roots, "roots") if i % 4 == 0 else roots
    roots = materialize(roots, "roots")
    least = roots.groupBy("root").agg(F.min("node").alias("m")).select("root", F.least("root", "m").alias("least"))
    return roots.join(least, "root").select("node", F.col("least").cast(kind).alias("root"))
