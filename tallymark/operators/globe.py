"""Points on the globe in a pyramid of cells, for searches that bound what a cell can hold before its points are read.

A cell is a cube of a grid through the unit sphere; each level halves its side. Its bound is a cap round the direction of
its centre that reaches to its farthest point, so angles between caps bound the distances of their points from below and
above. A search starts with the few cells of a coarse level, drops those whose bound can't beat what has been found,
looks at the points of those with few of them, and goes on with the children of the rest.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import EARTH_M, haversine
from ..storage import stored

#: Levels of the finest grid, about a centimetre on the globe, and the level that searches start at: 64 cubes.
FINEST, COARSEST = 30, 2
#: Points of two cells, or of one, whose distances are looked at one by one.
FEW_PAIRS, FEW_POINTS = 256, 24
#: Metres by which rounding may move a bound.
SLACK_M = 1.0


def on_globe(rows: DataFrame, lat: str, lon: str) -> DataFrame:
    """rows with a position, with _at (lat, lon), _p, the point on the unit sphere, and _q, its cube of the finest grid."""
    a, b = F.radians(lat), F.radians(lon)
    p = F.array(F.cos(a) * F.cos(b), F.cos(a) * F.sin(b), F.sin(a))
    out = rows.where(F.col(lat).isNotNull() & F.col(lon).isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)).withColumn("_at", F.struct(F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon"))).withColumn("_p", p)
    return out.withColumn("_q", F.transform("_p", lambda x: F.least(F.lit((1 << FINEST) - 1).cast("long"), F.floor((x + 1) * (1 << (FINEST - 1))).cast("long"))))


def cell_of(level: int) -> list[Column]:
    """The cube of a level that a point of on_globe() lies in, as two numbers: x and y packed, and z."""
    x, y, z = (F.shiftright(F.col("_q")[i], FINEST - level) for i in range(3))
    return [x * (1 << 31) + y, z]


def _chord(p: Column, q: Column) -> Column:
    return F.sqrt(reduce(lambda a, b: a + b, (F.pow(p[i] - q[i], 2) for i in range(3))))


def _angle(p: Column, q: Column) -> Column:
    return 2 * F.asin(F.least(F.lit(1.0), _chord(p, q) / 2))


def _centre(xy: Column, z: Column, level: int) -> Column:
    c = [(i + 0.5) / (1 << (level - 1)) - 1 for i in (F.shiftright(xy, 31), xy.bitwiseAND(F.lit((1 << 31) - 1)), z)]
    n = F.sqrt(c[0] * c[0] + c[1] * c[1] + c[2] * c[2])
    return F.array(*(x / n for x in c))


def cells(points: DataFrame, by: list[str], level: int) -> DataFrame:
    """The cells of points (of on_globe()) by group: by, xy and z, upxy and upz (the cell of the level before), and c, a
    struct of n points, centre, reach (the cap's angle) and one of its points."""
    xy, z = cell_of(level)
    centre = _centre(F.col("xy"), F.col("z"), level)
    out = points.withColumn("xy", xy).withColumn("z", z).groupBy(*by, "xy", "z").agg(F.count("*").alias("n"), F.max(_angle(F.col("_p"), centre)).alias("reach"), F.min("_at").alias("one"))
    up = F.shiftright(F.shiftright("xy", 31), 1) * (1 << 31) + F.shiftright(F.col("xy").bitwiseAND(F.lit((1 << 31) - 1)), 1)
    return out.select(*by, "xy", "z", up.alias("upxy"), F.shiftright("z", 1).alias("upz"), F.struct("n", centre.alias("centre"), "reach", "one").alias("c"))


def _metres(a: Column, b: Column) -> Column:
    return haversine(a["lat"], a["lon"], b["lat"], b["lon"])


def farthest(rows: DataFrame, by: str, lat: str, lon: str) -> DataFrame:
    """by and metres: the largest distance of two of a group's points; groups without a point have no row.

    Branch and bound over pairs of cells: two caps' points are at most their centres' angle and both reaches apart, and
    at least one pair is as far as the two points that stand for the cells. What is below the group's best falls away.
    """
    held: list[str] = []
    # in a struct a null group meets itself
    points = stored(on_globe(rows, lat, lon).select(F.struct(F.col(by).alias("by")).alias("_by"), "_at", "_p", "_q").dropDuplicates(["_by", "_at"]), "points", held)
    best = points.select("_by").distinct().withColumn("least", F.lit(0.0))
    pairs, level = None, COARSEST
    raised = lambda old, new: stored(old.unionByName(new).groupBy("_by").agg(F.max("least").alias("least")), "best", held)
    while True:
        own = cells(points, ["_by"], level)
        a, b = (own.select("_by", *(F.col(c).alias(f"{c}_{x}") for c in ("xy", "z", "upxy", "upz")), F.col("c").alias(x)) for x in "ab")
        if pairs is None:
            both, once = a.join(b, "_by"), (F.col("xy_a") < F.col("xy_b")) | ((F.col("xy_a") == F.col("xy_b")) & (F.col("z_a") <= F.col("z_b")))  # 56 cells at most
        else:
            both = pairs.select("_by", *(F.col(f"{c}_{x}").alias(f"up{c}_{x}") for c in ("xy", "z") for x in "ab")).join(a, ["_by", "upxy_a", "upz_a"]).join(b, ["_by", "upxy_b", "upz_b"])
            # each pair once: a pair of children may be in the other order than their parents
            apart = (F.col("upxy_a") != F.col("upxy_b")) | (F.col("upz_a") != F.col("upz_b"))
            once = apart | (F.col("xy_a") < F.col("xy_b")) | ((F.col("xy_a") == F.col("xy_b")) & (F.col("z_a") <= F.col("z_b")))
        most = EARTH_M * F.least(F.lit(math.pi), _angle(F.col("a.centre"), F.col("b.centre")) + F.col("a.reach") + F.col("b.reach")) + SLACK_M
        both = both.where(once).select("_by", "xy_a", "z_a", "xy_b", "z_b", (F.col("a.n") * F.col("b.n")).alias("work"), most.alias("most"), _metres(F.col("a.one"), F.col("b.one")).alias("some"))
        if level > COARSEST:
            both = both.join(best, "_by").where(F.col("most") >= F.col("least")).drop("least")
        both = stored(both, "pairs", held)
        best = raised(best, both.groupBy("_by").agg(F.max("some").alias("least")))
        open_ = both.join(best, "_by").where(F.col("most") >= F.col("least")).drop("least", "some")
        last = F.lit(level == FINEST)
        few = open_.where((F.col("work") <= FEW_PAIRS) | last).select("_by", "xy_a", "z_a", "xy_b", "z_b")
        xy, z = cell_of(level)
        x, y = (points.select("_by", xy.alias(f"xy_{n}"), z.alias(f"z_{n}"), F.col("_at").alias(f"_at_{n}")) for n in "ab")
        seen = few.join(x, ["_by", "xy_a", "z_a"]).join(y, ["_by", "xy_b", "z_b"])
        best = raised(best, seen.groupBy("_by").agg(F.max(_metres(F.col("_at_a"), F.col("_at_b"))).alias("least")))
        pairs = open_.where((F.col("work") > FEW_PAIRS) & ~last).join(best, "_by").where(F.col("most") >= F.col("least")).drop("least")
        if not pairs.head(1):
            return best.select(F.col("_by.by").alias(by), F.col("least").alias("metres"))
        # from here on only the points of cells that can still win
        alive = pairs.select("_by", F.col("xy_a").alias("xy"), F.col("z_a").alias("z")).unionByName(pairs.select("_by", F.col("xy_b").alias("xy"), F.col("z_b").alias("z"))).distinct()
        points = stored(points.withColumn("xy", xy).withColumn("z", z).join(alive, ["_by", "xy", "z"], "left_semi").drop("xy", "z"), "points", held)
        level += 1


def nearest_metres(left: DataFrame, right: DataFrame, left_at: tuple[str, str], right_at: tuple[str, str], row: str) -> DataFrame:
    """row and metres: the distance of the nearest of right's points for each row of left with a position; no row where
    right has none.

    A row keeps the cells whose nearest possible point is no farther than the nearest point that it knows of, which it
    takes along from level to level.
    """
    points = stored(on_globe(right, *right_at).select("_at", "_p", "_q").dropDuplicates(["_at"]), "points")
    asked = on_globe(left, *left_at).select(F.col(row).alias("_row"), F.col("_at").alias("_la"), F.col("_p").alias("_lp"))
    level, found = COARSEST, []
    look = asked.withColumn("least", F.lit(float("inf"))).crossJoin(F.broadcast(cells(points, [], level)))  # 56 cells at most
    while True:
        nearest = F.greatest(F.lit(0.0), EARTH_M * (_angle(F.col("_lp"), F.col("c.centre")) - F.col("c.reach")) - SLACK_M)
        look = look.select("_row", "_la", "_lp", "xy", "z", F.col("c.n").alias("n"), nearest.alias("from"), "least", _metres(F.col("_la"), F.col("c.one")).alias("some"))
        known = F.least(F.col("least"), F.min("some").over(Window.partitionBy("_row")))  # as many rows as a row has cells
        look = stored(look.withColumn("least", known).where((F.col("from") <= F.col("least"))).drop("some"), "look")
        found.append(look.select("_row", "least"))
        last = F.lit(level == FINEST)
        xy, z = cell_of(level)
        few = look.where((F.col("n") > 1) & ((F.col("n") <= FEW_POINTS) | last)).select("_row", "_la", "xy", "z")
        found.append(few.join(points.select(xy.alias("xy"), z.alias("z"), "_at"), ["xy", "z"]).select("_row", _metres(F.col("_la"), F.col("_at")).alias("least")))
        more = look.where((F.col("n") > FEW_POINTS) & ~last).select("_row", "_la", "_lp", "least", F.col("xy").alias("upxy"), F.col("z").alias("upz"))
        if not more.head(1):
            best = reduce(DataFrame.unionByName, found).groupBy("_row").agg(F.min("least").alias("metres"))
            return best.select(F.col("_row").alias(row), "metres")
        level += 1
        look = more.join(cells(points, [], level), ["upxy", "upz"])
