"""Ranking, shortlists and orders (W1 to W13). Every order ends in a unique column."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import asin, cos, pi, radians, sin, sqrt

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import EARTH_M, drawable, haversine, road_km
from ..storage import stored


def first_of_each(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key, by an aggregation rather than a sort of each group."""
    whole = F.struct(*rows.columns)
    return rows.groupBy(key).agg(F.min_by(whole, F.struct(*order)).alias("_r")).select("_r.*")


def shortlist(rows: DataFrame, key: str, level: str, blocked: Column | None = None) -> DataFrame:
    """The rows of the best (smallest) level, and the key's verdict: confident if there is one, else ambiguous; a row
    that is blocked is never confident."""
    best = rows.groupBy(key).agg(F.min(level).alias("_best"))
    kept = rows.join(best, key).where(F.col(level) == F.col("_best")).drop("_best")
    n = F.count("*").over(Window.partitionBy(key))
    one = (n == 1) & (~blocked if blocked is not None else F.lit(True))
    return kept.withColumn("verdict", F.when(one, "confident").otherwise("ambiguous"))


#: Undecided rows that one task walks through in order.
WALK_ROWS = 50_000


def _cube(p: Column, side: float) -> Column:
    return F.transform(p, lambda x: F.floor((x + 1) / side).cast("long"))


def _around(cube: Column) -> Column:
    """The cube and the 26 round it: at any latitude and longitude, all that lies within a cube's side."""
    return F.explode(F.array(*(F.array(cube[0] + i, cube[1] + j, cube[2] + k) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1))))


def collapsed(rows: DataFrame, key: str, ref: str, lat: str, lon: str, strength: str, order: str, metres: float = 200.0) -> DataFrame:
    """Candidates in order (then by ref); one with the ref of a kept candidate of its key, or within the distance of
    one, joins the first such candidate, and the strongest (smallest) strength wins. A row without a position meets others
    by its ref alone, one without a ref by its position; nulls come last in the order.

    The outcome is that of a walk in order, made in rounds. Rows lie in cubes as wide as the distance. A row that comes
    before all undecided rows of its cube, the cubes around and its ref is kept; then all undecided rows that it takes in
    are decided too. So no pairs of rows are made, kept ones are sparse, and no task holds a key; when WALK_ROWS or fewer
    rows are left, one walk decides them.
    """
    held: list[str] = []
    side = 2 * sin(min(pi / 2, metres / EARTH_M / 2)) * 1.0001 + 1e-12
    a, b = F.radians(F.col(lat)), F.radians(F.col(lon))
    at = F.when(F.col(lat).isNotNull() & F.col(lon).isNotNull() & ~F.isnan(lat) & ~F.isnan(lon), F.array(F.cos(a) * F.cos(b), F.cos(a) * F.sin(b), F.sin(a)))
    place = F.struct(F.col(order).isNull().alias("no"), F.col(order).alias("o"), F.col(ref).isNull().alias("nr"), F.col(ref).alias("r"), F.col("_id").alias("id"))
    base = stored(rows.withColumn("_id", F.monotonically_increasing_id()), "candidates", held)
    own = base.select("_id", F.struct(F.col(key).alias("k")).alias("_key"), F.col(ref).alias("_ref"), place.alias("_o"), _cube(at, side).alias("_cube"), F.col(lat).cast("double").alias("_lat"), F.col(lon).cast("double").alias("_lon"), F.col(strength).alias("_s"))
    own = stored(own, "candidates", held)
    left, rounds = own.drop("_s"), []
    while (n := left.count()) > WALK_ROWS:
        lead = left.where("_cube is not null").groupBy("_key", "_cube").agg(F.min("_o").alias("_o"), F.min_by("_ref", "_o").alias("_ref"))
        beside = lead.select("_key", "_o", "_ref", _around(F.col("_cube")).alias("_cube")).join(lead.select("_key", "_cube", F.col("_o").alias("_other")), ["_key", "_cube"])
        in_cubes = beside.groupBy("_key", "_o").agg(F.min("_other").alias("_other"), F.first("_ref").alias("_ref")).where("_o = _other")
        in_refs = left.where("_ref is not null").groupBy("_key", "_ref").agg(F.min("_o").alias("_o"), F.min_by(F.col("_cube").isNull(), "_o").alias("_placeless"))
        won = in_cubes.where("_ref is null").select("_key", "_o").unionByName(in_refs.where("_placeless").select("_key", "_o"))
        won = won.unionByName(in_cubes.where("_ref is not null").select("_key", "_o").join(in_refs.select("_key", "_o"), ["_key", "_o"]))
        won = won.select(F.col("_o.id").alias("_id")).unionByName(left.where("_cube is null and _ref is null").select("_id"))
        won = stored(left.join(won, "_id", "left_semi"), "kept", held)
        rounds.append(won)
        near = won.where("_cube is not null").select(F.col("_key").alias("_wk"), _around(F.col("_cube")).alias("_wc"), F.col("_lat").alias("_wa"), F.col("_lon").alias("_wo"))
        left = left.join(won.select("_id"), "_id", "left_anti").join(won.where("_ref is not null").select("_key", "_ref"), ["_key", "_ref"], "left_anti")
        close = (F.col("_key") == F.col("_wk")) & (F.col("_cube") == F.col("_wc")) & (haversine("_lat", "_lon", "_wa", "_wo") <= metres)
        left = stored(left.join(near, close, "left_anti"), "left", held)
    if n:
        # at most WALK_ROWS rows; they alone can still take each other in
        walk = left.select(F.to_json("_key").alias("_key"), "_id", "_ref", "_cube", "_lat", "_lon", F.col("_o")).coalesce(1).sortWithinPartitions("_key", "_o").drop("_o")
        rounds.append(own.drop("_s").join(walk.mapInPandas(_walker(metres), "_id long"), "_id", "left_semi"))
    kept = rounds[0] if rounds else own.drop("_s")
    for more in rounds[1:]:
        kept = kept.unionByName(more)
    kept = stored(kept, "kept", held)
    others = own.join(kept.select("_id"), "_id", "left_anti")
    first = kept.select(F.col("_key").alias("_wk"), F.col("_ref").alias("_wr"), F.col("_o").alias("_first"), F.col("_cube").alias("_wc"), F.col("_lat").alias("_wa"), F.col("_lon").alias("_wo"))
    by_ref = others.join(first.where("_wr is not null"), (F.col("_key") == F.col("_wk")) & (F.col("_ref") == F.col("_wr"))).where("_first < _o").select("_id", "_s", "_first")
    around = first.where("_wc is not null").withColumn("_wc", _around(F.col("_wc")))
    by_place = others.join(around, (F.col("_key") == F.col("_wk")) & (F.col("_cube") == F.col("_wc"))).where((F.col("_first") < F.col("_o")) & (haversine("_lat", "_lon", "_wa", "_wo") <= metres)).select("_id", "_s", "_first")
    joined = by_ref.unionByName(by_place).groupBy("_id").agg(F.min("_first").alias("_first"), F.first("_s").alias("_s"))
    best = joined.groupBy(F.col("_first.id").alias("_id")).agg(F.min("_s").alias("_best"))
    out = base.join(kept.select("_id"), "_id", "left_semi").join(best, "_id", "left")
    return out.select(*(F.least(F.col(c), F.col("_best")).alias(c) if c == strength else F.col(c) for c in rows.columns))


def _walker(metres: float) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The walk in order over rows sorted by key and order: the ids of those that no earlier kept one takes in."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, refs, cubes = None, set(), {}
        for frame in frames:
            kept = []
            for key, i, ref, cube, lat, lon in frame.itertuples(index=False):
                if key != now:
                    now, refs, cubes = key, set(), {}
                at = None if cube is None else tuple(int(c) for c in cube)
                if ref is not None and ref == ref and ref in refs:
                    continue
                if at and any(_metres(lat, lon, *p) <= metres for i_ in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1) for p in cubes.get((at[0] + i_, at[1] + j, at[2] + k), ())):
                    continue
                kept.append(i)
                if ref is not None and ref == ref:
                    refs.add(ref)
                if at:
                    cubes.setdefault(at, []).append((lat, lon))
            yield pd.DataFrame({"_id": pd.Series(kept, dtype="int64")})

    return run


def _metres(a: float, b: float, c: float, d: float) -> float:
    a, b, c, d = map(radians, (a, b, c, d))
    return 2 * 6_371_000.0 * asin(min(1.0, sqrt(sin((c - a) / 2) ** 2 + cos(a) * cos(c) * sin((d - b) / 2) ** 2)))


def latest(rows: DataFrame, key: str, number: str) -> DataFrame:
    """The row with the largest number, of equals the last by the other columns."""
    return rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), F.struct(number, *[c for c in rows.columns if c not in (key, number)])).alias("_r")).select("_r.*")


def best_choice(rows: DataFrame, key: str, rank: str, lat: str, order: str, kind: str, kinds: int = 3) -> DataFrame:
    """The choice of the smallest rank, of equals one with a position, then the first; and its key's first kinds."""
    whole = F.struct(*(c for c in rows.columns if c != key))
    first = rows.groupBy(key, kind).agg(F.min(order).alias("_o")).groupBy(key).agg(F.slice(F.transform(F.array_sort(F.collect_list(F.struct("_o", kind))), lambda s: s[kind]), 1, kinds).alias("kinds"))
    best = rows.groupBy(key).agg(F.min_by(whole, F.struct(F.col(rank), F.col(lat).isNull(), F.col(order))).alias("_r")).select(key, "_r.*")
    return best.join(first, key)


def largest_gaps(rows: DataFrame, a: str, b: str, row: str, k: int = 12) -> DataFrame:
    """The k rows whose two figures differ most."""
    return rows.withColumn("gap", F.abs(F.col(a) - F.col(b))).where(F.col("gap").isNotNull()).orderBy(F.desc("gap"), row).limit(k)


def placed(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Rows with their place in the whole order, from 1. Ranges of the order are sorted apart and written to
    the shared folder; a place is the row's in its range after the rows of the ranges before, of which there are as many
    counts as partitions."""
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = stored(ranged.select("*", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_at")), "ranges")
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = ranged.groupBy("_range").agg(F.count("*").alias("_n")).select("_range", before.alias("_before"))
    return ranged.join(counts, "_range").withColumn("place", F.col("_before") + F.col("_at") + 1).drop("_range", "_at", "_before")


def match_order(when: str, row: str, nulls_first: bool) -> list[Column]:
    """By time, matches without one first or last, then by id."""
    return [F.col(when).asc_nulls_first() if nulls_first else F.col(when).asc_nulls_last(), F.col(row).asc()]


def review_order(verdict: str, ranks: list[str], *then: str) -> list[Column]:
    """By the verdict's place in ranks, unknown ones last."""
    at = F.array_position(F.array(*map(F.lit, ranks)), F.col(verdict))
    return [F.when(at == 0, len(ranks) + 1).otherwise(at).asc_nulls_last(), *(F.col(c).asc_nulls_last() for c in then)]


def near_me(rows: DataFrame, lat: str, lon: str, tier: str, name: str, at: tuple[float, float], km: int, tiers: list[int] | None = None, offset: int = 0, rows_shown: int = 50) -> DataFrame:
    """Entities whose road distance in whole kilometres is at most km, nearest first, then by tier and name; a page
    of the list. The sort is a top-k of offset plus page, not of the table."""
    out = rows.where(drawable(lat, lon, tier)).withColumn("km", road_km(haversine(F.lit(at[0]), F.lit(at[1]), lat, lon)).cast("long"))
    if tiers is not None:
        out = out.where(F.col(tier).isin(*tiers))
    out = out.where(F.col("km") <= km).orderBy("km", tier, name)
    return (out.offset(offset) if offset else out).limit(rows_shown)


def nearer_end(a: Column, b: Column) -> Column:
    """The distance of the nearer of two ends; a null end doesn't count."""
    return F.least(a, b)


def typeahead(rows: DataFrame, key: str, tier: str, name: str, query: str, shown: int = 8) -> DataFrame:
    """Rows in whose folded key every word of the folded query occurs: those that start with the query, then those
    with a word that does, then the rest; by tier and name. more counts those beyond the ones shown."""
    q = query.strip()
    hit = F.lit(bool(q))
    for w in q.split():
        hit = hit & F.contains(key, F.lit(w))
    rank = F.when(F.col(key).startswith(q), 0).when(F.contains(F.concat(F.lit(" "), F.col(key)), F.lit(" " + q)), 1).otherwise(2)
    found = rows.where(hit).withColumn("rank", rank)
    total = found.agg(F.greatest(F.lit(0), F.count("*") - shown).alias("more"))
    top = found.orderBy("rank", tier, name).limit(shown)
    return top.crossJoin(F.broadcast(total))  # a single row


def bucket_order(group: str, file_order: str, precision: str, date: str, favourite: str, as_of: Column) -> list[Column]:
    """Favourites, then groups in file order, then days, months, undated, past ones, each by date."""
    past = F.coalesce(F.col(date) < as_of, F.lit(False))
    place = F.when(past, 3).when(F.col(precision) == "day", 0).when(F.col(precision) == "month", 1).otherwise(2)
    return [F.col(favourite).desc_nulls_last(), F.col(group).asc(), place.asc(), F.col(date).asc_nulls_last(), F.col(file_order).asc()]


def fixed_prefix_order(country: str, first: list[str]) -> list[Column]:
    """The named countries in order, then others by name, then those without one."""
    rank = F.lit(len(first))
    for i, c in enumerate(first):
        rank = F.when(F.col(country) == c, i).otherwise(rank)
    return [F.when(F.col(country).isNull(), len(first) + 1).otherwise(rank).asc(), F.col(country).asc_nulls_last()]


def renewals(rows: DataFrame, due: str, row: str, as_of: Column, window: int = 30) -> DataFrame:
    """Overdue rows, then those due within the window, soonest first; days is negative when overdue."""
    days = F.date_diff(F.col(due), as_of)
    return rows.withColumn("days", days).where(F.col("days") <= window).withColumn("status", F.when(F.col("days") < 0, "overdue").otherwise("due")).orderBy("days", row)
