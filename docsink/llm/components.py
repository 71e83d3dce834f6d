"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsink.llm.common import written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the links ``(lo, hi)``; the root is the smallest node.

    Every round hangs the larger neighbours of a node, then its smaller ones,
    on the smallest of them; the number of rounds grows with the logarithm of
    the longest chain. Links are kept in the shared folder between rounds,
    and only counts reach the driver.
    """
    edges = edges.select(F.least("lo", "hi").alias("lo"), F.greatest("lo", "hi").alias("hi"))
    edges = written(edges.where("lo < hi").distinct(), "edges")
    before = _state(edges)
    while True:
        both = edges.selectExpr("lo as u", "hi as v").unionAll(edges.selectExpr("hi as u", "lo as v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).distinct()
        down = large.groupBy("hi").agg(F.min("lo").alias("m"))
        hang = F.explode(F.array("lo", "hi")).alias("hi")
        edges = large.join(down, "hi").select(F.col("m").alias("lo"), hang).where("lo < hi").distinct()
        edges = written(edges, "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.selectExpr("lo as node", "lo as root").distinct()
    return edges.selectExpr("hi as node", "lo as root").unionAll(roots)
