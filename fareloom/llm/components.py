"""Connected components of a table of links, as Spark jobs.

Every round each node takes the best of its neighbours and itself as parent, then links are
drawn between parents instead. "Best" is the smallest node in even rounds, which finishes a
star around its smallest node at once, and the smallest hash in odd rounds, which shortens
chains whatever their order. Nodes only ever meet as aggregated minima and in joins of two
tables, whose hot keys adaptive execution splits.

Defined results: a link with a NULL end joins nothing and gives no row; without links there are no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm.tables import Scratch


def _order(node: str, turn: int) -> Column:
    return F.col(node) if turn % 2 == 0 else F.xxhash64(F.col(node), F.lit(turn))


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``links`` has columns ``a`` and ``b``; a row (``node``, ``root``) for every node in it.

    Two nodes have the same root if and only if links lead from one to the other. Links of a
    node to itself don't count; links may repeat and point either way.
    """
    edges = scratch.write(
        links.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "links",
    )
    parents: list[DataFrame] = []
    while not edges.isEmpty():
        turn = len(parents)
        ways = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = ways.groupBy("a").agg(F.min(F.struct(_order("b", turn).alias("o"), F.col("b"))).alias("m"))
        own = _order("a", turn) <= F.col("m.o")
        step = scratch.write(best.select(F.col("a").alias("node"), F.when(own, F.col("a")).otherwise(F.col("m.b")).alias("parent")), "parents")
        parents.append(step)
        moved = (
            edges.join(step.select(F.col("node").alias("a"), F.col("parent").alias("x")), "a")
            .join(step.select(F.col("node").alias("b"), F.col("parent").alias("y")), "b")
            .where(F.col("x") != F.col("y"))
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct()
        )
        after = scratch.write(moved, "links")
        scratch.drop(edges)
        edges = after
    if not parents:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = parents[0].select("node", F.col("parent").alias("root"))
    for step in parents[1:]:
        further = step.select(F.col("node").alias("root"), F.col("parent").alias("_further"))
        found = found.join(further, "root", "left").select("node", F.coalesce("_further", "root").alias("root"))
    return scratch.write(found, "roots")
