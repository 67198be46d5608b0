"""Connected components by alternating stars.

Each round is joins and grouped minima over the link table, so no node's links
ever meet in one task, and the round's links are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def connected_components(links: DataFrame, a: str, b: str, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of ``links`` that isn't the smallest of its component.

    Self links and repeated links are ignored; links with a NULL end are dropped.
    """
    ends = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    cur = scratch.keep(ends.distinct())
    mark = _mark(cur)
    while mark[0]:
        both = cur.unionAll(cur.select(F.col("v").alias("u"), F.col("u").alias("v"))).toDF("x", "y")
        low = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.join(low, "x").where("y > x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.keep(large)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        cur = scratch.keep(moved.unionAll(low.toDF("u", "v")).distinct())
        before, mark = mark, _mark(cur)
        if mark == before:
            break
    return cur.toDF("node", "root")


def _mark(links: DataFrame) -> tuple:
    """Count and order-free checksum of a link set."""
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
