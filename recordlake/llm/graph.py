"""Connected components over an edge table too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.llm.frames import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is its smallest reachable node.

    Alternates two star steps: each node's larger neighbours are hung on its
    smallest neighbour, then its smaller ones are. Both keep connectivity, and
    repeated they leave one star a component, in about log(n) rounds. Every
    round is a written table, so no lineage grows and a lost executor costs one
    round at most. A node with very many edges is aggregated partially before
    the shuffle, and its rows are split by Spark's skew join.
    """
    now = written(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "edges",
    )
    mark = _mark(now)
    while True:
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large star: each larger neighbour b of a points at the least of a and its neighbours
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = both.where("b > a").join(least, "a").select(
            F.least("m", "a").alias("a"), "b"
        )
        large = written(large.where("a <> b").distinct(), "edges")
        # small star: a node b and its smaller neighbours all point at the least of these
        lower = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(lower, "b").select(
            F.explode(
                F.array(
                    F.struct(F.col("m").alias("a"), F.col("b").alias("b")),
                    F.struct(F.col("m").alias("a"), F.col("a").alias("b")),
                )
            ).alias("e")
        )
        now = written(small.select("e.a", "e.b").where("a <> b").distinct(), "edges")
        before, mark = mark, _mark(now)
        if before == mark:
            break
    roots = now.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.union(now.select(F.col("a").alias("node"), F.col("a").alias("root"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    """A row count and a hash of the edges, alike in any order."""
    return tuple(
        edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first()
    )
