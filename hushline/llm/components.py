"""Connected components of a graph given as pairs, by alternating large and small stars.

Each step replaces the neighbours of a node by edges to the least of them; labels only
shrink, and a component becomes a star around its least node after about as many steps as
its diameter has bits. Steps are aggregations and joins; each result is written to the shared
folder, so lineage stays short and nothing comes to the driver but two numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hushline.llm.storage import discard, written

MAX_STEPS = 60


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The new edges, and the table they are made from."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    # Written, so that the other side of the join can be split where one node has very many edges.
    least = written(least, "least")
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), least


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for all nodes of edges (a, b) but the least ones of their components.

    Loops, repeated and reversed edges do no harm; rows with a null end are left out. No
    edges give no rows.
    """
    edges = written(edges.select("a", "b").where("a != b").distinct(), name)
    before = _state(edges)
    for _ in range(MAX_STEPS):
        large, least = _large_star(edges)
        following = written(_small_star(large), name)
        discard(edges, least)
        edges = following
        now = _state(edges)
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = now
    raise RuntimeError(f"components did not settle in {MAX_STEPS} steps")
