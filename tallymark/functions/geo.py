"""Distances, boxes and cost estimates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .textkeys import ColumnOrName, _col

EARTH_M = 6_371_000.0


def haversine(lat1: ColumnOrName, lon1: ColumnOrName, lat2: ColumnOrName, lon2: ColumnOrName) -> Column:
    """M1: metres between two points."""
    a, b, c, d = (F.radians(_col(x)) for x in (lat1, lon1, lat2, lon2))
    h = F.pow(F.sin((c - a) / 2), 2) + F.cos(a) * F.cos(c) * F.pow(F.sin((d - b) / 2), 2)
    return 2 * EARTH_M * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def cosine_distance(lat1: ColumnOrName, lon1: ColumnOrName, lat2: ColumnOrName, lon2: ColumnOrName) -> Column:
    """M2: metres by the spherical law of cosines, its argument clamped."""
    a, b, c, d = (F.radians(_col(x)) for x in (lat1, lon1, lat2, lon2))
    x = F.sin(a) * F.sin(c) + F.cos(a) * F.cos(c) * F.cos(d - b)
    return EARTH_M * F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x)))


def half_up(x: Column) -> Column:
    """Rounding half up, towards positive infinity."""
    return F.floor(x + 0.5)


def road_km(metres: Column, factor: float = 1.25) -> Column:
    """M3: whole kilometres by road, from the straight distance."""
    return half_up(metres / 1000 * factor)


def relative_spread(a: ColumnOrName, b: ColumnOrName) -> Column:
    """M4: |a - b| over the larger one; null where either is null or both are 0."""
    x, y = _col(a), _col(b)
    return F.abs(x - y) / F.nullif(F.greatest(x, y), F.lit(0))


def within(a: ColumnOrName, b: ColumnOrName, share: float = 0.05) -> Column:
    return relative_spread(a, b) <= share


def fuel_cost(km: Column, litres: ColumnOrName, price: ColumnOrName, band: float = 0.10) -> Column:
    """M5: struct(low, high) in whole units of the price's currency, rounded half up; null without a price."""
    cost = km * _col(litres) / 100 * _col(price)
    return F.when(cost.isNotNull(), F.struct(half_up(cost * (1 - band)).cast("long").alias("low"), half_up(cost * (1 + band)).cast("long").alias("high")))


def proposed_box(lat: ColumnOrName, lon: ColumnOrName, only: Column | None = None, margin: float = 0.15) -> Column:
    """M6, an aggregate: struct(south, west, north, east) of the points (those where `only` holds), widened."""
    a, b = ((F.when(only, _col(c)) if only is not None else _col(c)) for c in (lat, lon))
    return F.struct((F.min(a) - margin).alias("south"), (F.min(b) - margin).alias("west"), (F.max(a) + margin).alias("north"), (F.max(b) + margin).alias("east"))


def valid_formation(x: ColumnOrName) -> Column:
    """M7: whether the lines of a formation such as 4-3-3 sum to ten outfield players."""
    lines = F.transform(F.split(_col(x), "-"), lambda p: p.try_cast("int"))
    return _col(x).rlike("^[0-9]+(-[0-9]+)+$") & (F.aggregate(lines, F.lit(0), lambda a, p: a + p) == 10)


def in_box(lat: ColumnOrName, lon: ColumnOrName, south: float, west: float, north: float, east: float) -> Column:
    """inclusive."""
    return _col(lat).between(south, north) & _col(lon).between(west, east)


def in_viewport(lat: ColumnOrName, lon: ColumnOrName, south: float, west: float, north: float, east: float, pad: float = 0.5) -> Column:
    """the box with a share of its height and width added on each side."""
    h, w = (north - south) * pad, (east - west) * pad
    return in_box(lat, lon, south - h, west - w, north + h, east + w)


def drawable(*columns: ColumnOrName) -> Column:
    """none of the columns is null."""
    return reduce(lambda a, b: a & b, (_col(c).isNotNull() for c in columns))


def shown_at_zoom(tier: ColumnOrName, zoom: ColumnOrName, first: dict[int, int] | None = None, deeper: int = 9) -> Column:
    """whether the zoom has reached the tier's first one."""
    least = F.lit(deeper)
    for t, z in (first or {1: 0, 2: 7}).items():
        least = F.when(_col(tier) == t, z).otherwise(least)
    return _col(zoom) >= least


def polyline_points(encoded: ColumnOrName, precision: int = 6) -> Column:
    """The (lat, lon) points of an encoded polyline, without a Python worker.

    Each character carries five bits, the sixth says that the number goes on; numbers are differences, the sign in
    the lowest bit, latitude and longitude in turn.
    """
    codes = F.transform(F.filter(F.split(_col(encoded), ""), lambda c: c != ""), lambda c: F.ascii(c) - 63)
    start = F.struct(F.array().cast("array<long>").alias("done"), F.lit(0).cast("long").alias("now"), F.lit(0).alias("bits"))

    def take(a: Column, c: Column) -> Column:
        now = a["now"] + (c.bitwiseAND(F.lit(31))).cast("long") * F.pow(F.lit(2.0), a["bits"]).cast("long")
        value = F.when(now % 2 == 0, F.floor(now / 2)).otherwise(-F.floor((now + 1) / 2)).cast("long")
        more = c >= 32
        return F.struct(F.when(more, a["done"]).otherwise(F.concat(a["done"], F.array(value))).alias("done"), F.when(more, now).otherwise(F.lit(0).cast("long")).alias("now"), F.when(more, a["bits"] + 5).otherwise(F.lit(0)).alias("bits"))

    steps = F.aggregate(codes, start, take)["done"]
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.floor(F.size(steps) / 2).cast("int"))), lambda i: F.struct(F.get(steps, 2 * i - 2).alias("a"), F.get(steps, 2 * i - 1).alias("o")))
    total = F.aggregate(
        F.filter(pairs, lambda p: p["o"].isNotNull()),
        F.array().cast("array<struct<lat:long,lon:long>>"),
        lambda acc, p: F.concat(acc, F.array(_moved(acc, p))),
    )
    return F.transform(total, lambda p: F.struct((p["lat"] / 10**precision).alias("lat"), (p["lon"] / 10**precision).alias("lon")))


def _moved(points: Column, step: Column) -> Column:
    last = F.get(points, F.size(points) - 1)
    return F.struct((F.coalesce(last["lat"], F.lit(0).cast("long")) + step["a"]).alias("lat"), (F.coalesce(last["lon"], F.lit(0).cast("long")) + step["o"]).alias("lon"))
