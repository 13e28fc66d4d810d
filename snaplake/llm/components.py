"""Connected components of an edge list, by alternating large and small stars.

Every round is two joins and two aggregations over the edges; a node's label only
falls, and the number of rounds grows with the logarithm of the longest path. No
part of the graph is collected. Edges with a null end, loops and repeats count for
nothing; an empty edge list gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import cut


def _pairs(edges: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """(u, v) for each of the pairs of columns of every edge."""
    each = F.array(*[F.struct(F.col(a).alias("u"), F.col(b).alias("v")) for a, b in pairs])
    return edges.select(F.explode(each).alias("e")).select("e.u", "e.v")


def _star(edges: DataFrame, keep: Column) -> DataFrame:
    """Links the neighbours v of each node u that pass keep to m, the least of u and its
    neighbours. edges(u, v)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u").where(keep).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def components(edges: DataFrame, *, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(id, root): for each node of an edge the smallest node that it reaches."""
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col("u") > F.col("v")).distinct()
    e, before = cut(e), None
    for _ in range(most_rounds):
        n, total = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (n, total) == before:
            return _pairs(e, ("u", "v"), ("v", "v")).distinct().toDF("id", "root")
        before = n, total
        large = _star(_pairs(e, ("u", "v"), ("v", "u")), F.col("v") > F.col("u"))
        e = cut(_star(_pairs(large, ("u", "v"), ("u", "u")), F.col("v") > F.col("m")))
    raise RuntimeError("components did not settle; raise most_rounds")
