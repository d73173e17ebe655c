"""Entity resolution and spatial joins.

Every join here is an equality join on a computed key with the rest of the rule as a residual: canonical sorted word
sets for names, exploded words for containment, grid cells for distances. So Catalyst can shuffle, broadcast by size, or
split skewed keys as it sees fit.
"""

from __future__ import annotations

from math import cos, radians, sin

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import EARTH_M, haversine
from ..functions.textkeys import name_parts
from ..storage import stored
from .globe import nearest_metres
from .pairs import listed, paired


def lookup(rows: DataFrame, dim: DataFrame, key: str, dim_key: str, fields: dict[str, str]) -> DataFrame:
    """Rows with dim's fields; a field falls back to the row's own column of the given name."""
    d = dim.select(F.col(dim_key).alias("_k"), *(F.col(f).alias(f"_{f}") for f in fields))
    return rows.join(d, rows[key] == d["_k"], "left").select("*", *(F.coalesce(F.col(f"_{f}"), F.col(own)).alias(f) for f, own in fields.items() if f not in rows.columns)).drop("_k", *(f"_{f}" for f in fields))


def with_name_key(rows: DataFrame, key: Column, forms: list[str], markers: list[str], prefix: str) -> DataFrame:
    """rows with _core, the canonical sorted core words and markers, and the parts as struct <prefix>parts."""
    parts = name_parts(key, forms, markers)
    out = rows.withColumn(f"{prefix}parts", parts)
    p = F.col(f"{prefix}parts")
    return out.withColumn(f"{prefix}core", F.when(F.size(p["core"]) > 0, F.concat(F.array_join(p["core"], " "), F.lit("|"), F.array_join(p["markers"], " "))))


def compatible(a: Column, b: Column) -> Column:
    """Legal forms and years: where both sides have some they must share one."""
    both = lambda x, y: (F.size(x) > 0) & (F.size(y) > 0) & ~F.arrays_overlap(x, y)
    return ~both(a["forms"], b["forms"]) & ~both(a["years"], b["years"])


def name_join(left: DataFrame, right: DataFrame, left_key: Column, right_key: Column, forms: list[str], markers: list[str], short: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """Pairs with equal core words and markers and compatible forms and years; rows of left with column `short` true
    need two core words. Rows of one name are judged once, as a class; columns are those of the result, else all."""
    a = with_name_key(left, left_key, forms, markers, "_a").where("_acore is not null")
    b = with_name_key(right, right_key, forms, markers, "_b").where("_bcore is not null")
    ok = compatible(F.col("_aparts"), F.col("_bparts"))
    if short:
        a = a.withColumn("_short", F.coalesce(F.col(short), F.lit(False)))
        ok = ok & (~F.col("_short") | (F.size(F.col("_aparts")["core"]) >= 2))
    kept = lambda rows: F.struct(*(c for c in rows.columns if columns is None or c in columns))
    x = listed(a, ["_acore", "_aparts", *(["_short"] if short else [])], kept(left), "_l")
    y = listed(b, ["_bcore", "_bparts"], kept(right), "_r")
    return paired(x.withColumnRenamed("_acore", "_core"), y.withColumnRenamed("_bcore", "_core"), "_core", "_l", "_r", lambda lists: lists.where(ok).select("_core", "_i", "_j", "_l", "_r"))


def disambiguated(candidates: DataFrame, row: str, agrees: Column) -> DataFrame:
    """Of a row's candidates: the only one; of several the only one that agrees; verdict link or ambiguous."""
    w = Window.partitionBy(row)
    out = candidates.withColumn("_yes", F.coalesce(agrees, F.lit(False))).withColumn("candidates", F.count("*").over(w)).withColumn("agreeing", F.count_if("_yes").over(w))
    keep = (F.col("candidates") == 1) | ((F.col("agreeing") == 1) & F.col("_yes")) | (F.col("agreeing") != 1)
    link = (F.col("candidates") == 1) | (F.col("agreeing") == 1)
    return out.where(keep).withColumn("verdict", F.when(link, "link").otherwise("ambiguous")).drop("_yes")


def disambiguated_alike(rows: DataFrame, others: DataFrame, on: list[str], agrees: Column) -> DataFrame:
    """What disambiguated() gives for rows, once each, whose candidates are the others with equal `on`, where agrees is
    over others alone. Candidates are counted and left out once for all rows of equal `on`, before there are pairs."""
    o = others.withColumn("_yes", F.coalesce(agrees, F.lit(False)))
    counts = o.groupBy(*on).agg(F.count("*").alias("candidates"), F.count_if("_yes").alias("agreeing"))
    keep = (F.col("candidates") == 1) | ((F.col("agreeing") == 1) & F.col("_yes")) | (F.col("agreeing") != 1)
    verdict = F.when((F.col("candidates") == 1) | (F.col("agreeing") == 1), "link").otherwise("ambiguous")
    kept = o.join(counts, on).where(keep).withColumn("verdict", verdict)
    said = ["candidates", "agreeing", "verdict"]
    x = listed(rows.dropna(subset=on), on, F.struct(*(c for c in rows.columns if c not in on)), "_l").withColumn("_on", F.struct(*on))
    y = listed(kept, [*on, *said], F.struct(*(c for c in others.columns if c not in on)), "_r").withColumn("_on", F.struct(*on)).drop(*on)
    return paired(x, y, "_on", "_l", "_r")


def _cells(rows: DataFrame, lat: str, lon: str, metres: float, around: bool) -> DataFrame:
    """rows with _y and _x, grid cells at least as large as the distance; around gives those next to each.

    A row of cells is a band of latitudes; it has as many cells as the distance fits round the globe at the edge nearest
    to a pole of the band and its neighbours, one cell near the poles. So no latitude is out of reach.
    """
    dy = metres / (EARTH_M * radians(1.0)) * 1.0001
    across = sin(min(1.5, metres / EARTH_M))
    y = F.floor((F.col(lat) + 90) / dy)

    def count(band: Column) -> Column:
        edge = F.least(F.lit(90.0), F.greatest(F.abs(band * dy - 90), F.abs((band + 1) * dy - 90)) + dy)
        ratio = F.lit(across) / F.greatest(F.lit(1e-9), F.cos(F.radians(edge)))
        width = F.degrees(F.asin(F.least(F.lit(1.0), ratio))) * 1.0001
        return F.when(ratio >= 1, 1).otherwise(F.greatest(F.lit(1), F.floor(360.0 / width))).cast("long")

    def spot(n: Column) -> Column:
        return F.pmod(F.floor((F.col(lon) + 180) / (360.0 / n)), n)

    if not around:
        return rows.withColumn("_y", y).withColumn("_x", spot(count(F.col("_y"))))
    out = rows.withColumn("_y", F.explode(F.array(y - 1, y, y + 1))).withColumn("_n", count(F.col("_y"))).withColumn("_at", spot(F.col("_n")))
    beside = F.array_distinct(F.array(*(F.pmod(F.col("_at") + i, F.col("_n")) for i in (-1, 0, 1))))
    return out.withColumn("_x", F.explode(beside)).drop("_n", "_at")


def _near(left: DataFrame, right: DataFrame, metres: float, left_at: tuple[str, str], right_at: tuple[str, str], lists: tuple[str, str] | None = None) -> DataFrame:
    """Rows at most that far apart, with metres; with the names of two columns of lists, a row for each pair of their values."""
    a = _cells(left, *left_at, metres, around=True)
    b = _cells(right, *right_at, metres, around=False)
    judged = lambda met: met.withColumn("metres", haversine(*left_at, *right_at)).where(F.col("metres") <= metres).drop(*left_at, *right_at)
    if lists:
        cell = lambda rows: rows.withColumn("_cell", F.struct("_y", "_x")).drop("_y", "_x")
        return paired(cell(a), cell(b), "_cell", *lists, judged)
    return a.join(b, ["_y", "_x"]).drop("_y", "_x").withColumn("metres", haversine(*left_at, *right_at)).where(F.col("metres") <= metres)


def distance_join(left: DataFrame, right: DataFrame, metres: float, left_at: tuple[str, str], right_at: tuple[str, str]) -> DataFrame:
    """Pairs at most that far apart, with column metres. Positions are compared once, however many rows have them."""
    (la, lo), (ra, ro) = left_at, right_at
    a = listed(left.withColumn("_la", F.col(la)).withColumn("_lo", F.col(lo)), ["_la", "_lo"], F.struct(*left.columns), "_l")
    b = listed(right.withColumn("_ra", F.col(ra)).withColumn("_ro", F.col(ro)), ["_ra", "_ro"], F.struct(*right.columns), "_r")
    return _near(a, b, metres, ("_la", "_lo"), ("_ra", "_ro"), ("_l", "_r"))


def nearest_within(left: DataFrame, right: DataFrame, metres: float, left_at: tuple[str, str], right_at: tuple[str, str], row: str, order: str) -> DataFrame:
    """Each left row with the nearest right row within the distance, ties to the smaller `order`, and its distance. Rows
    without one have nulls for it but the distance of the nearest all the same; rows without a position, or with nothing
    on the right, have no distance. A position is searched once, and stands on the right for its smallest `order`; only
    those without a hit search farther, see globe.nearest_metres()."""
    (la, lo), (ra, ro) = left_at, right_at
    asked = left.select(F.col(la).alias("_la"), F.col(lo).alias("_lo")).where("_la is not null and _lo is not null").distinct()
    whole = F.struct(*right.columns)
    there = right.groupBy(F.col(ra).alias("_ra"), F.col(ro).alias("_ro")).agg(F.min_by(whole, F.struct(order)).alias("_r"), F.min(F.struct(order)).alias("_o"))
    pairs = _near(asked, there, metres, ("_la", "_lo"), ("_ra", "_ro"))
    best = pairs.groupBy("_la", "_lo").agg(F.min_by(F.struct("_r", "metres"), F.struct("metres", "_o")).alias("_n"))
    found = stored(asked.join(best, ["_la", "_lo"], "left").withColumn("_spot", F.struct("_la", "_lo")), "nearest")
    far = nearest_metres(found.where("_n is null").select("_spot", "_la", "_lo"), right, ("_la", "_lo"), right_at, "_spot").withColumnRenamed("metres", "_far")
    spots = found.join(far, "_spot", "left").select("_la", "_lo", "_n", "_far")
    out = left.join(spots, (F.col(la) == F.col("_la")) & (F.col(lo) == F.col("_lo")), "left")
    return out.select(*left.columns, *(F.col("_n")["_r"][c].alias(c) for c in right.columns), F.coalesce(F.col("_n")["metres"], "_far").alias("metres"))


def nearest_centres(centres: DataFrame, places: DataFrame, metres: float, centre_at: tuple[str, str], place_at: tuple[str, str], key: str, place: str) -> DataFrame:
    """Of each place with a centre in reach: metres to the nearest, and its key, ties to the smaller."""
    c = centres.groupBy(F.col(centre_at[0]).alias("_la"), F.col(centre_at[1]).alias("_lo")).agg(F.min(key).alias("_k"))
    p = places.select(F.col(place_at[0]).alias("_ra"), F.col(place_at[1]).alias("_ro")).distinct()
    best = _near(c, p, metres, ("_la", "_lo"), ("_ra", "_ro")).groupBy("_ra", "_ro").agg(F.min(F.struct("metres", "_k")).alias("_b"))
    out = places.join(best, (F.col(place_at[0]) == F.col("_ra")) & (F.col(place_at[1]) == F.col("_ro")))
    return out.groupBy(place).agg(F.min("_b").alias("_b")).select(place, F.col("_b.metres").alias("metres"), F.col("_b._k").alias(key))


def containment_join(left: DataFrame, right: DataFrame, left_id: str, right_id: str, left_words: Column, right_words: Column, common: list[str] | None = None) -> DataFrame:
    """Pairs where every word of the right side is one of the left side's; right sides without words match nothing.

    Both sides meet on the right side's rarest word, so a word that every name has is no join key.
    """
    r = right.select(right_id, F.array_distinct(right_words).alias("_rw")).where(F.size("_rw") > 0)
    if common:
        r = r.where(F.size(F.array_except("_rw", F.array(*map(F.lit, common)))) > 0)
    lw = left.select(left_id, F.array_distinct(left_words).alias("_lw"))
    seen = lw.select(F.explode("_lw").alias("_w")).groupBy("_w").count()
    exploded = r.select(right_id, "_rw", F.explode("_rw").alias("_w")).join(seen, "_w")
    full = exploded.groupBy(right_id, "_rw").agg(F.min_by("_w", F.struct("count", "_w")).alias("_w"), F.count("*").alias("_n")).where(F.col("_n") == F.size("_rw"))
    pairs = lw.select(left_id, "_lw", F.explode("_lw").alias("_w")).join(full, "_w").where(F.size(F.array_except("_rw", "_lw")) == 0)
    exact = (F.size("_lw") == F.size("_rw")).alias("exact")
    return pairs.select(left_id, right_id, exact)


def ground_agrees(a: Column, b: Column, common: list[str]) -> Column:
    """True, false, or null where a side has no words of its own: equal, one inside the other, with or without
    spaces, or a shared word of five letters that isn't common. a and b are ascii keys."""
    skip = F.array(*map(F.lit, common))
    aw, bw = (F.filter(F.split(x, " "), lambda w: (w != "") & ~F.array_contains(skip, w)) for x in (a, b))
    ac, bc = F.array_join(aw, " "), F.array_join(bw, " ")
    aj, bj = F.replace(a, F.lit(" "), F.lit("")), F.replace(b, F.lit(" "), F.lit(""))
    inside = lambda x, y: F.contains(x, y) | F.contains(y, x)
    shared = F.exists(F.array_intersect(aw, bw), lambda w: F.length(w) >= 5)
    return F.when((a == "") | (b == "") | a.isNull() | b.isNull(), None).when(a == b, True).when((F.size(aw) == 0) | (F.size(bw) == 0), None).otherwise(inside(ac, bc) | inside(aj, bj) | shared)


def name_strength(a: Column, b: Column, own: Column | None = None) -> Column:
    """Exact, contained or null between two arrays of core words; `own` words are set aside after the exact test."""
    none = F.array().cast("array<string>")
    drop = own if own is not None else none
    x, y = F.array_except(a, drop), F.array_except(b, drop)
    same = lambda p, q: (F.size(F.array_except(p, q)) == 0) & (F.size(F.array_except(q, p)) == 0)
    inside = (F.size(F.array_except(x, y)) == 0) | (F.size(F.array_except(y, x)) == 0)
    return (
        F.when((F.size(a) == 0) | (F.size(b) == 0), None)
        .when(same(a, b) | (F.array_join(a, "") == F.array_join(b, "")), "exact")
        .when((F.size(x) == 0) | (F.size(y) == 0), None)
        .when(same(x, y), "exact")
        .when(inside, "contained")
    )


def best_strength(pairs: DataFrame, row: str, strength: str, value: str, order: str) -> DataFrame:
    """Of a row's pairs the strongest, the first of equals."""
    rank = F.when(F.col(strength) == "exact", 0).when(F.col(strength) == "contained", 1)
    return pairs.where(rank.isNotNull()).groupBy(row).agg(F.min_by(F.struct(strength, value), F.struct(rank, F.col(order))).alias("_b")).select(row, F.col("_b")[strength].alias(strength), F.col("_b")[value].alias(value))


def two_hops(rows: DataFrame, title: str, direct: DataFrame, redirects: DataFrame, refuse: Column | None = None, batch: Column | None = None) -> DataFrame:
    """The id of a title by `direct` (title, id), else by the title that `redirects` (title, target) names; a
    hop for which `refuse` holds (over title and target) isn't taken. Of a title's ids or targets the smallest counts, so
    a row stays one row. route says which: direct, redirect or null for neither.

    With batch, the number of the request that asked for a row's title, a batch none of whose titles has an id is a
    failed request, not a finding about its titles: its rows have the route failed.
    """
    d = direct.groupBy("title").agg(F.min("id").alias("id"))
    d1, d2 = (d.select(F.col("title").alias(f"_t{i}"), F.col("id").alias(f"_id{i}")) for i in (1, 2))
    r = redirects.select(F.col("title").alias("_from"), F.col("target").alias("_target"))
    if refuse is not None:
        r = redirects.where(~F.coalesce(refuse, F.lit(False))).select(F.col("title").alias("_from"), F.col("target").alias("_target"))
    r = r.groupBy("_from").agg(F.min("_target").alias("_target"))
    out = rows.withColumn("_batch", batch if batch is not None else F.lit(None))
    out = out.join(d1, out[title] == F.col("_t1"), "left").join(r, F.col("_id1").isNull() & (out[title] == F.col("_from")), "left").join(d2, F.col("_target") == F.col("_t2"), "left")
    route = F.when(F.col("_id1").isNotNull(), "direct").when(F.col("_id2").isNotNull(), "redirect")
    out = out.withColumn("_id", F.coalesce("_id1", "_id2")).withColumn("_route", route)
    if batch is not None:
        dead = out.where("_batch is not null").groupBy(F.col("_batch").alias("_dead")).agg(F.count("_id").alias("_found")).where("_found = 0").select("_dead")
        out = out.join(dead, F.col("_batch") == F.col("_dead"), "left").withColumn("_route", F.when(F.col("_dead").isNotNull(), "failed").otherwise(F.col("_route")))
    return out.select(*rows.columns, F.col("_id").alias("id"), F.col("_route").alias("route"))


def parent_matches(items: DataFrame, known: DataFrame, same_markers: Column) -> DataFrame:
    """Items (id, parents, markers) one of whose parents is a known row (known_id, known_markers) of equal markers."""
    up = items.withColumn("parent", F.explode("parents"))
    return up.join(known, F.col("parent") == F.col("known_id")).where(same_markers)


def missing(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Rows of left without a partner."""
    return left.join(right.select(*on).distinct(), on, "left_anti")


def present(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Rows of left with a partner, once each."""
    return left.join(right.select(*on).distinct(), on, "left_semi")


def both_ways(edges: DataFrame, a: str, b: str) -> DataFrame:
    """The edges seen from either end, once each."""
    turned = edges.select(*(F.col({a: b, b: a}.get(c, c)).alias(c) for c in edges.columns))
    return edges.unionByName(turned).distinct()


def pair_key(a: str, b: str) -> Column:
    """An undirected pair's key."""
    return F.struct(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))


def next_meeting(pairs: DataFrame, matches: DataFrame, a: str, b: str, home: str, away: str, when: str, as_of: Column) -> DataFrame:
    """Each pair's next match from as_of on, whichever side is home; status meeting, or none where both sides have
    matches, one-sided where one has, no-source where neither has."""
    keyed = matches.where(F.col(when) >= as_of).groupBy(F.least(home, away).alias("_lo"), F.greatest(home, away).alias("_hi")).agg(F.min(when).alias("next"))
    sides = matches.select(F.explode(F.array(home, away)).alias("_s")).distinct()
    out = pairs.join(keyed, (F.least(a, b) == F.col("_lo")) & (F.greatest(a, b) == F.col("_hi")), "left").drop("_lo", "_hi")
    out = out.join(sides.withColumnRenamed("_s", "_sa"), F.col(a) == F.col("_sa"), "left").join(sides.withColumnRenamed("_s", "_sb"), F.col(b) == F.col("_sb"), "left")
    known = F.col("_sa").isNotNull().cast("int") + F.col("_sb").isNotNull().cast("int")
    status = F.when(F.col("next").isNotNull(), "meeting").when(known == 2, "none").when(known == 1, "one-sided").otherwise("no-source")
    return out.withColumn("status", status).drop("_sa", "_sb")


def _grams(text: str, size: int) -> Column:
    """The distinct runs of that many characters."""
    n = F.length(text)
    return F.array_distinct(F.transform(F.when(n >= size, F.sequence(F.lit(1), n - size + 1)).otherwise(F.array().cast("array<int>")), lambda i: F.substring(F.col(text), i, F.lit(size))))


def held_inside(short: DataFrame, long: DataFrame, scope: str = "scope", gram: int = 3) -> DataFrame:
    """Distinct (scope, short, long) of texts of one scope of which the first stands in the second.

    Texts meet on the short one's rarest run of `gram` characters, so a scope's texts aren't paired with each other;
    short ones of fewer characters meet on all they have. Null and empty texts hold nothing and stand in nothing.
    """
    a = short.select(scope, "short").where("short <> ''").distinct()
    b = long.select(scope, "long").where("long <> ''").distinct()
    out = None
    for size in range(1, gram + 1):
        mine = a.where(F.length("short") == size) if size < gram else a.where(F.length("short") >= size)
        held = b.select(scope, "long", F.explode(_grams("long", size)).alias("_g"))
        seen = held.groupBy(scope, "_g").agg(F.count("*").alias("_n"))
        rarest = mine.select(scope, "short", F.explode(_grams("short", size)).alias("_g")).join(seen, [scope, "_g"], "left")
        rarest = rarest.groupBy(scope, "short").agg(F.min_by("_g", F.struct(F.coalesce("_n", F.lit(0)), "_g")).alias("_g"))
        found = rarest.join(held, [scope, "_g"]).where(F.contains("long", "short")).select(scope, "short", "long")
        out = found if out is None else out.unionByName(found)
    return out


def _either_inside(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct (scope, l, r) of texts l of left (scope, l) and r of right (scope, r) of which one stands in the other."""
    a = held_inside(left.select("scope", F.col("l").alias("short")), right.select("scope", F.col("r").alias("long"))).select("scope", F.col("short").alias("l"), F.col("long").alias("r"))
    b = held_inside(right.select("scope", F.col("r").alias("short")), left.select("scope", F.col("l").alias("long"))).select("scope", F.col("long").alias("l"), F.col("short").alias("r"))
    return a.unionByName(b).distinct()


def confirmed_by(rows: DataFrame, others: DataFrame, row: str, scope: str, key: str, other_key: str) -> DataFrame:
    """Rows with column second: confirms where a row of the same scope in others has an equal key or one inside the
    other, silent where there are others but none such, empty where there are none."""
    o = others.select(F.col(scope).alias("scope"), F.col(other_key).alias("r"))
    there = o.select(F.col("scope").alias("_has")).distinct()
    hit = _either_inside(rows.select(F.col(scope).alias("scope"), F.col(key).alias("l")), o).select(F.col("scope").alias("_s"), F.col("l").alias("_k")).distinct()
    out = rows.join(there, F.col(scope) == F.col("_has"), "left").join(hit, (F.col(scope) == F.col("_s")) & (F.col(key) == F.col("_k")), "left")
    said = F.when(F.col("_k").isNotNull(), "confirms").when(F.col("_has").isNotNull(), "silent").otherwise("")
    return out.withColumn("second", said).drop("_has", "_s", "_k")


def name_candidates(rows: DataFrame, lists: list[DataFrame], scope: str, name: str) -> DataFrame:
    """Codes of lists (scope, code, label) whose label and the row's name hold each other, case folded; a later list
    adds only codes that no earlier one gave the row. Rows of any columns, nulls among them, are rows of their own."""
    own = rows.select(F.struct(*rows.columns).alias("_row"), F.col(scope).alias("_scope"), F.lower(name).alias("_l"))
    both = None
    for i, found in enumerate(lists):
        f = found.select(F.col(scope).alias("_s"), F.col("code").alias("_code"), F.col("label").alias("_label"), F.lower("label").alias("_r"), F.lit(i).alias("_source"))
        both = f if both is None else both.unionByName(f)
    pairs = _either_inside(own.select(F.col("_scope").alias("scope"), F.col("_l").alias("l")), both.select(F.col("_s").alias("scope"), F.col("_r").alias("r")))
    pairs = pairs.select(F.col("scope").alias("_ps"), F.col("l").alias("_pl"), F.col("r").alias("_pr"))
    # what a name is given is the same for all rows of that name, so the codes are chosen before the rows are joined
    given = pairs.join(both, (F.col("_ps") == F.col("_s")) & (F.col("_pr") == F.col("_r"))).select("_ps", "_pl", F.struct("_code").alias("_c"), "_label", "_source")
    # the first list that gives a name the code keeps it, with all its labels
    first = given.groupBy("_ps", "_pl", "_c").agg(F.min("_source").alias("_source"))
    kept = given.join(first, ["_ps", "_pl", "_c", "_source"])
    hit = own.join(kept, (F.col("_scope") == F.col("_ps")) & (F.col("_l") == F.col("_pl")))
    return hit.select("_row.*", F.col("_c._code").alias("code"), F.col("_label").alias("label"), F.col("_source").alias("source_order"))


def mirrored(edges: DataFrame, a: str, b: str, name: str, rank: str) -> DataFrame:
    """Each entity's own rows, then rows of others that name it where it has none for them; those lose their rank.
    Rows without a target aren't mirrored. position orders by own first, rank, name."""
    own = edges.withColumn("mirrored", F.lit(False))
    back = edges.where(F.col(b).isNotNull()).select(*(F.col({a: b, b: a}.get(c, c)).alias(c) if c != rank else F.lit(None).cast(edges.schema[rank].dataType).alias(c) for c in edges.columns))
    back = back.join(edges.where(F.col(b).isNotNull()).select(a, b).distinct(), [a, b], "left_anti").select(*edges.columns).withColumn("mirrored", F.lit(True))
    order = Window.partitionBy(a).orderBy("mirrored", F.col(rank).asc_nulls_last(), name, b)
    return own.unionByName(back).withColumn("position", F.row_number().over(order))


def followed(rows: DataFrame, redirects: DataFrame, title: str, hops: int = 3) -> DataFrame:
    """The title after up to so many redirects (title, target), as column final."""
    out = rows.withColumn("final", F.col(title))
    for i in range(hops):
        r = redirects.select(F.col("title").alias(f"_f{i}"), F.col("target").alias(f"_t{i}"))
        out = out.join(r, F.col("final") == F.col(f"_f{i}"), "left").withColumn("final", F.coalesce(f"_t{i}", "final")).drop(f"_f{i}", f"_t{i}")
    return out


def corridor(points: DataFrame, line: list[tuple[float, float]], metres: float, lat: str, lon: str, row: str) -> DataFrame:
    """Points at most that far from a line of (lat, lon), with off_m and along_m, its nearest place's distance from
    the start. Each leg is flat about its middle latitude; the legs are literals, so nothing is joined."""
    legs, run = [], 0.0
    for (a, b), (c, d) in zip(line[:-1], line[1:], strict=True):
        k = cos(radians((a + c) / 2))
        m = EARTH_M * radians(1.0)
        vx, vy = (d - b) * k * m, (c - a) * m
        px, py = (F.col(lon) - b) * k * m, (F.col(lat) - a) * m
        length = (vx * vx + vy * vy) ** 0.5
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (px * vx + py * vy) / (length * length or 1.0)))
        legs.append(F.struct(F.hypot(px - t * vx, py - t * vy).alias("off_m"), (t * length + run).alias("along_m")))
        run += length
    best = F.array_min(F.array(*legs))
    return points.withColumn("_b", best).where(F.col("_b")["off_m"] <= metres).withColumn("off_m", F.col("_b")["off_m"]).withColumn("along_m", F.col("_b")["along_m"]).drop("_b")


def shared_places(rows: DataFrame, lat: str, lon: str) -> DataFrame:
    """The rows that share exactly one place with others, with n, how many are there."""
    groups = rows.groupBy(lat, lon).agg(F.count("*").alias("n")).where("n > 1")
    return rows.join(groups, [lat, lon])
