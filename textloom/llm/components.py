"""Connected components of a link table by alternating large-star and small-star rounds."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import materialize, sized_lookup


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b) that is not the smallest of its component.

    Each round is two sums with partial aggregation, stored, and two joins with them that split
    off hubs; the link table is stored between rounds. It stops when the links form stars around the
    smallest node. Null ends and self links are ignored, repeated links count once.
    """
    ends = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    proper = links.filter("a IS NOT NULL AND b IS NOT NULL").select(ends.columns)
    proper = proper.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = materialize(proper.filter("a != b").distinct(), "links")
    before = _checksum(edges)
    while before[0]:
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("low"))
        low = materialize(low.select("a", F.least("a", "low").alias("low")), "lowest")
        large = sized_lookup(both.filter("b > a"), low, "a", "inner").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = materialize(large.distinct(), "links")
        least = materialize(large.groupBy("a").agg(F.min("b").alias("low")), "lowest")
        small = sized_lookup(large, least, "a", "inner").select(
            F.explode(
                F.array(
                    F.struct(F.col("a").alias("a"), F.col("low").alias("b")),
                    F.struct(F.col("b").alias("a"), F.col("low").alias("b")),
                )
            ).alias("e")
        )
        edges = materialize(small.select("e.a", "e.b").filter("a != b").distinct(), "links")
        after = _checksum(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
