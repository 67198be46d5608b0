"""Candidates of the nearest-place join where places are dense.

Cubes with more than ``leaf`` places are split in halves, again and again, until every cube has at most
``leaf`` distinct coordinates; each cube keeps the box that its places fill. A point starts with the cubes
around it and goes down level by level: the nearest place is no farther than the farthest corner
of any box, so boxes whose nearest point is farther than that bound are dropped before they are opened.
What is joined in the end are the places of the few small cubes that may hold the nearest one,
whatever the number of places in the radius. Each level is one table; there are as many levels as the
densest cube needs halvings.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playmart.sources.scratch import Scratch

LEAF = 64
MAX_LEVEL = 40
# Bounds are compared with this much room (meters), so rounding can't drop the nearest place or one as near.
SLACK_M = 1e-4

AXES = ("x", "y", "z")
OWN, PARENT = ("_cx", "_cy", "_cz"), ("_px", "_py", "_pz")
POINT = ("_lat", "_lng")


def _keys(side: float, level: int, names) -> dict[str, Column]:
    scale = F.lit(2.0**level / side)
    return {n: F.floor(F.col(f"_{a}") * scale) for n, a in zip(names, AXES, strict=True)}


def _sum(cols) -> Column:
    return reduce(lambda a, b: a + b, cols)


def cell_tree(places: DataFrame, side: float, leaf: int, scratch: Scratch) -> tuple[list[DataFrame], DataFrame]:
    """The cells of each level (own and parent's keys, n, box), and the places with the level and keys of their leaf.

    ``places`` has _x, _y, _z (meters) and no coordinate twice.
    """
    levels, leaves, rest = [], [], places
    for level in range(MAX_LEVEL + 1):
        keyed = rest.withColumns(_keys(side, level, OWN)).withColumns(_keys(side, max(0, level - 1), PARENT))
        box = [f(f"_{a}").alias(f"_{n}{a}") for a in AXES for n, f in (("lo", F.min), ("hi", F.max))]
        cells = scratch.keep(keyed.groupBy(*PARENT, *OWN).agg(F.count(F.lit(1)).alias("n"), *box))
        if level == MAX_LEVEL:  # closer together than any coordinate can say
            cells = cells.withColumn("n", F.lit(1).cast("long"))
        levels.append(cells)
        small = cells.where(F.col("n") <= leaf).select(*OWN)
        leaves.append(keyed.join(small, list(OWN)).withColumn("_level", F.lit(level)).select("_level", *[c for c in keyed.columns if c not in PARENT]))
        dense = cells.where(F.col("n") > leaf).select(*OWN)
        if dense.isEmpty():
            break
        rest = scratch.keep(keyed.join(dense, list(OWN), "left_semi").select(*places.columns))
    return levels, reduce(DataFrame.unionByName, leaves)


def _bounded(frontier: DataFrame, reach: float) -> DataFrame:
    """The frontier's boxes that may hold the nearest place: ``_min`` and the point's bound ``_ub``."""
    gap = [F.greatest(F.col(f"_lo{a}") - F.col(f"_{a}"), F.col(f"_{a}") - F.col(f"_hi{a}"), F.lit(0.0)) for a in AXES]
    far = [F.greatest(F.abs(F.col(f"_lo{a}") - F.col(f"_{a}")), F.abs(F.col(f"_hi{a}") - F.col(f"_{a}"))) for a in AXES]
    found = frontier.withColumn("_min", F.sqrt(_sum(g * g for g in gap))).withColumn("_max", F.sqrt(_sum(f * f for f in far)))
    found = found.where(F.col("_min") <= F.lit(reach + SLACK_M))
    bound = F.least(F.col("_ub"), F.min("_max").over(Window.partitionBy(*POINT)))
    return found.withColumn("_ub", bound).where(F.col("_min") <= F.col("_ub") + SLACK_M)


def candidates(points: DataFrame, places: DataFrame, side: float, reach: float, leaf: int, scratch: Scratch) -> DataFrame:
    """Each point with the places that may be its nearest within ``reach`` (meters along the chord).

    ``points``: distinct _lat, _lng with _x, _y, _z; ``places``: _x, _y, _z and other columns.
    """
    levels, leaf_places = cell_tree(places, side, leaf, scratch)
    ring = (-1, 0, 1)
    shifts = F.array(*[F.struct(*[F.lit(s).alias(f"d{a}") for s, a in zip(t, AXES)]) for t in ((i, j, k) for i in ring for j in ring for k in ring)])
    probe = points.withColumns(_keys(side, 0, OWN)).select("*", F.inline(shifts))
    probe = probe.withColumns({n: F.col(n) + F.col(f"d{a}") for n, a in zip(OWN, AXES)}).drop(*[f"d{a}" for a in AXES])
    frontier, found = probe.join(levels[0].drop(*PARENT), list(OWN)).withColumn("_ub", F.lit(float("inf"))), []
    state = [*POINT, "_x", "_y", "_z", "_ub"]
    for level, cells in enumerate(levels):
        if level:
            up = frontier.select(*state, *[F.col(o).alias(p) for o, p in zip(OWN, PARENT)])
            frontier = up.join(cells, list(PARENT)).drop(*PARENT)
        near = scratch.keep(_bounded(frontier, reach))
        found.append(near.where(F.col("n") <= leaf).select(*POINT, F.lit(level).alias("_level"), *OWN, "_min", "_ub"))
        frontier = near.where(F.col("n") > leaf)
    every = reduce(DataFrame.unionByName, found)
    best = F.min("_ub").over(Window.partitionBy(*POINT))
    every = every.withColumn("_ub", best).where(F.col("_min") <= F.col("_ub") + SLACK_M).drop("_min", "_ub")
    return every.join(leaf_places, ["_level", *OWN]).drop("_level", *OWN, *[f"_{a}" for a in AXES])
