"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgrid.llm.common import cut


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component) of each id in edges (a long, b long); a component is named by its smallest id.

    Alternating large-star and small-star steps: each edge is replaced by one to a smaller neighbour, until each
    component is a star around its smallest id. Neighbours are never listed: a group is only its minimum, and the
    join that hands it out is one that Spark splits where an id is hot. Loops and null ends are left out.
    """
    e = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    before = None
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a"), F.col("m").alias("b")))).alias("x")).select("x.*").where("a <> b").distinct()
        e = cut(small)
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.col("b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("a", "b"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"no components after {rounds} rounds")
    roots = e.select(F.col("b").alias("id")).distinct()
    return e.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots.select("id", F.col("id").alias("component")))
