"""Connected components by alternating star contraction, all of it as joins and aggregates."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.plans.prefix import cut_lineage

#: Edges that a task starts from; a few edges in many partitions would cost tasks and shuffle files in every round.
TASK_EDGES = 1 << 17


def _joined_to_least(edges: DataFrame) -> DataFrame:
    """(u, v, least): each edge with the least of u and all its neighbours in ``edges``.

    The join stays a sort-merge join: a broadcast in each round, small as it is beside the
    edges, would be built and kept on the driver until it is collected.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("least")).select(F.col("u").alias("_u"), F.least("u", "least").alias("least"))
    return edges.join(least.hint("merge"), F.col("u") == F.col("_u")).drop("_u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _joined_to_least(both).where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    linked = _joined_to_least(down)
    stars = linked.select("v", "least").unionByName(linked.select(F.col("u").alias("v"), "least"))
    return stars.where("v != least").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("sum(cast(xxhash64(u, v) as decimal(38,0)))")).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v, both bigint): root is the least node reachable.

    Runs to convergence, in about log(n) rounds of two joins each. A hot node costs no
    more than its edges: the joins split skewed keys, the minimum is combined before the
    shuffle. Loops and repeated edges are allowed; no edges give no rows.
    """
    edges = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = cut_lineage(edges)
    before = _print(edges)
    while before[0]:
        packed = edges.coalesce(ceil(before[0] / TASK_EDGES))
        edges = cut_lineage(_small_star(_large_star(packed)))
        now = _print(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
