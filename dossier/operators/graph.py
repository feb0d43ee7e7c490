"""Connected components over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.session import materialise


def _stars(edges: DataFrame) -> bool:
    """Whether edges (a, b), b < a, are stars: every a has one b, and no b is an a."""
    ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("b").alias("v"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    ends = ends.groupBy("v").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not ends.where("up > 1 or (up > 0 and down > 0)").agg(F.count(F.lit(1))).first()[0]


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60, written: bool = False) -> DataFrame:
    """Label every vertex of *edges* with the smallest vertex that it can reach.

    Returns (vertex, component). Edges are undirected; loops only introduce their vertex; rows with a null end
    are ignored; repeated edges count once. An empty table gives an empty result. Each round replaces the graph by
    stars around local minima (a large-star step, then a small-star step), so the number of rounds grows with
    the logarithm of the diameter; every step is a grouped minimum, which combines before its shuffle, and an equi-join.
    With *written*, the edges are in the shared folder, without nulls, the smaller end as *dst*: they aren't written again.
    Rounds are written to the shared folder, and end when all that is left are stars; raises RuntimeError if *max_rounds* don't
    get there.
    """
    if written:
        all_edges = edges.select(F.col(src).alias("a"), F.col(dst).alias("b"))
    else:
        pairs = edges.select(F.col(src).alias("x"), F.col(dst).alias("y")).where("x is not null and y is not null")
        all_edges = materialise(pairs.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "cc")
    current, loops = all_edges.where("a <> b"), all_edges.where("a = b")
    for _ in range(max_rounds):
        if _stars(current):
            break
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = materialise(small.unionByName(down.select("a", F.col("m").alias("b"))).distinct(), "cc")
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    # In stars a vertex has one row as a member, or any number as a root or loop, which all name itself.
    members = current.select(F.col("a").alias("vertex"), F.col("b").alias("component"))
    roots = current.select(F.col("b").alias("vertex")).unionByName(loops.select(F.col("b").alias("vertex"))).distinct()
    lonely = roots.join(members.select("vertex"), "vertex", "left_anti")
    return members.unionByName(lonely.select("vertex", F.col("vertex").alias("component")))
