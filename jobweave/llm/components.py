"""Connected components of a graph given as an edge table, in rounds of star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobweave.llm.common import written
from jobweave.session import swept


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of the edges ``a, b`` (longs): the label is the least node of its component.

    Each round hangs every node's neighbours on the least of them, first the larger neighbours, then the smaller ones, until every edge leads
    to the least node of its component; the number of rounds grows with the logarithm of the longest path. Rounds only
    aggregate and join edge rows, so a node of any degree is combined before it is shuffled, and each round is
    written to the shared folder. Self edges and repeated edges are allowed.
    """
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seal = _seal(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
        joined = large.join(low, F.col("a") == F.col("u"))
        small = joined.select("a", F.col("m").alias("b")).unionByName(
            joined.where("b <> m").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
        )
        now = written(small.distinct(), "edges")
        before, seal = seal, _seal(now)
        if seal == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )


def _seal(edges: DataFrame) -> tuple:
    """Number of edges and sums over four parts of their hashes: equal for equal edge sets. A part has 16 bits, so no sum of fewer than 2^47 edges overflows."""
    mixed = F.xxhash64("a", "b")
    with swept(edges.sparkSession):
        return tuple(edges.agg(F.count(F.lit(1)), *[F.sum(F.shiftright(mixed, n).bitwiseAND(F.lit(0xFFFF))) for n in (0, 16, 32, 48)]).first())
