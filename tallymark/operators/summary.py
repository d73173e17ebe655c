"""Aggregations (A1 to A17). Ties have a rule; nothing depends on the order in which rows arrive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .globe import farthest


def folded(rows: DataFrame, key: str, order: str, first: list[str], last: list[str] = (), lists: list[str] = ()) -> DataFrame:
    """A1: one row for each key: the first value that isn't null, the last one, or the distinct values in order."""
    cols = [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in first]
    cols += [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in last]
    for c in lists:
        pairs = F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct(F.col(order).alias("o"), F.col(c).alias("v")))))
        cols.append(F.array_distinct(_values(pairs)).alias(c))
    return rows.groupBy(key).agg(*cols)


def _values(pairs: Column) -> Column:
    return F.transform(pairs, lambda s: s["v"])


def least_with_flag(rows: DataFrame, key: str, value: str) -> DataFrame:
    """A2: the smallest value, and whether there are several."""
    return rows.groupBy(key).agg(F.min(value).alias("least"), (F.min(value) != F.max(value)).alias("ambiguous"))


def distinct_places(rows: DataFrame, key: str, place: str, label: str) -> DataFrame:
    """A3: the key's distinct places with a label each, and whether there are several."""
    one = rows.where(F.col(place).isNotNull()).groupBy(key, place).agg(F.max(label).alias("label"))
    return one.groupBy(key).agg(F.count("*").alias("places"), F.map_from_entries(F.array_sort(F.collect_list(F.struct(place, "label")))).alias("labels"), (F.count("*") > 1).alias("several"))


def sides(matches: DataFrame, order: str, home: list[str], away: list[str], names: list[str]) -> DataFrame:
    """A4: one row for each side of the matches, the last one in order; names[0] is its id."""
    side = lambda cols: F.struct(*(F.col(c).alias(n) for c, n in zip(cols, names, strict=True)))
    # a task sorts its sides before it sums them up: a number of parts that isn't merged by size keeps that small
    spread = matches.repartition(int(matches.sparkSession.conf.get("spark.sql.shuffle.partitions")), order)
    both = spread.select(order, F.explode(F.array(side(home), side(away))).alias("_s")).select(order, "_s.*")
    return both.groupBy(names[0]).agg(F.max_by(F.struct(*names[1:]), order).alias("_s")).select(names[0], *(F.col("_s")[n].alias(n) for n in names[1:]))


def modes(rows: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """A5: the commonest value, of equals the first seen; counts are summed before they are ranked."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"), F.min(order).alias("_first"))
    return counts.groupBy(key).agg(F.min_by(F.struct(value, "n"), F.struct(-F.col("n"), "_first")).alias("_m")).select(key, F.col("_m")[value].alias(value), F.col("_m")["n"].alias("n"))


def counters(rows: DataFrame, by: list[str], **conditions: Column) -> DataFrame:
    """N, and how many rows meet each condition."""
    return rows.groupBy(*by).agg(F.count("*").alias("n"), *(F.count_if(c).alias(k) for k, c in conditions.items()))


def histogram(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """Values by falling count, then by value."""
    return rows.select(value.alias(name)).where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("n")).orderBy(F.desc("n"), name)


def tally(rows: DataFrame, by: str, verdict: str, verdicts: list[str]) -> DataFrame:
    """A column of counts for each verdict, 0 where there are none."""
    return rows.groupBy(by).agg(*(F.count_if(F.col(verdict) == v).alias(v.replace("-", "_")) for v in verdicts))


def coverage(rows: DataFrame, tier: str, country: str, league: str) -> DataFrame:
    """Entities and distinct leagues by tier, by country, and in all; a league is (country, tier, name), and entities
    without one are counted apart. level: 0 in all, 1 by tier, 2 by country."""
    key = F.when(F.col(league).isNotNull(), F.struct(country, tier, league))
    agg = [F.count("*").alias("entities"), F.count_distinct(key).alias("leagues"), F.count_if(F.col(league).isNull()).alias("without")]
    none = lambda c: F.lit(None).cast(rows.schema[c].dataType).alias(c)
    parts = [rows.groupBy(tier).agg(*agg).select(F.lit(1).alias("level"), tier, none(country), "entities", "leagues", "without"), rows.groupBy(country).agg(*agg).select(F.lit(2).alias("level"), none(tier), country, "entities", "leagues", "without")]
    return rows.agg(*agg).select(F.lit(0).alias("level"), none(tier), none(country), "entities", "leagues", "without").unionByName(parts[0]).unionByName(parts[1])


def by_country_and_kind(rows: DataFrame, country: str, kind: str, blank: str = "international") -> DataFrame:
    """Counts; a null country has the given name."""
    return rows.groupBy(F.coalesce(country, F.lit(blank)).alias(country), kind).agg(F.count("*").alias("n"))


def attended(matches: DataFrame, home: str, away: str, exhibition: str, crowd: str, places: list[str], complete: str, cards: str) -> DataFrame:
    """A10: one row of totals. Goals are those of the score, without exhibitions; cards count where they are complete."""
    counted = ~F.coalesce(F.col(exhibition), F.lit(False))
    return matches.agg(
        F.count("*").alias("matches"),
        F.sum(F.when(counted, F.col(home) + F.col(away))).alias("goals"),
        *(F.count_distinct(p).alias(f"distinct_{p}") for p in places),
        F.sum(F.when(F.col(complete), F.col(cards))).alias("cards"),
        F.max(crowd).alias("largest_crowd"),
        F.min(crowd).alias("smallest_crowd"),
    )


def record(matches: DataFrame, by: list[str], side: str, home: str, away: str) -> DataFrame:
    """Won, drawn, lost of the matches with a supported side (home or away), and counted of total."""
    own, other = F.when(F.col(side) == "home", F.col(home)).when(F.col(side) == "away", F.col(away)), F.when(F.col(side) == "home", F.col(away)).when(F.col(side) == "away", F.col(home))
    return matches.groupBy(*by).agg(F.count_if(own > other).alias("won"), F.count_if(own == other).alias("drawn"), F.count_if(own < other).alias("lost"), F.count_if(own.isNotNull() & other.isNotNull()).alias("counted"), F.count("*").alias("total"))


def maxima(rows: DataFrame, by: list[str], value: str, order: list[str], show: int = 5) -> DataFrame:
    """The rows equal to their group's maximum, oldest first, at most `show`, and how many more there are."""
    top = rows.groupBy(*by).agg(F.max(value).alias("_max"))
    w = Window.partitionBy(*by)
    tied = rows.join(top, by).where(F.col(value) == F.col("_max")).drop("_max")
    return tied.withColumn("place", F.row_number().over(w.orderBy(*order))).withColumn("more", F.greatest(F.lit(0), F.count("*").over(w) - show)).where(F.col("place") <= show)


def distinct_members(rows: DataFrame, by: str, member: str, rough: bool = False) -> DataFrame:
    """Distinct members; rough gives the bounded-memory estimate."""
    return rows.groupBy(by).agg((F.approx_count_distinct(member) if rough else F.count_distinct(member)).alias("members"))


def group_members(rows: DataFrame, row: str, keys: list[Column]) -> DataFrame:
    """The distinct pairs of a key, numbered by its place in keys, and a row that has it."""
    named = F.array(*(F.struct(F.lit(i).alias("rule"), k.cast("string").alias("key")) for i, k in enumerate(keys)))
    return rows.select(row, F.explode(named).alias("_k")).where(F.col("_k.key").isNotNull()).select("_k.rule", "_k.key", row).distinct()


def duplicate_groups(rows: DataFrame, row: str, keys: list[Column]) -> DataFrame:
    """The sets of two or more rows that share one of the keys: first, last and n. A set that several keys give is
    listed once, told by its ends, its size and the sum of its rows' hashes; group_members() has who is in it."""
    members = group_members(rows, row, keys)
    sums = F.sum(F.xxhash64(row).cast("decimal(38,0)")).alias("_sum")
    groups = members.groupBy("rule", "key").agg(F.min(row).alias("first"), F.count("*").cast("int").alias("n"), F.max(row).alias("last"), sums).where("n > 1")
    return groups.select("first", "n", "last", "_sum").distinct().drop("_sum")


def shared_target(rows: DataFrame, row: str, target: str) -> DataFrame:
    """Rows with the first row that proposes their target and how many others do; who they are is in the rows of
    that target, so no row lists its whole group."""
    groups = rows.where(F.col(target).isNotNull()).groupBy(target).agg(F.min(row).alias("first"), (F.count_distinct(row) - 1).cast("int").alias("others"))
    return rows.join(groups, target, "left").withColumn("others", F.coalesce("others", F.lit(0)))


def translation_coverage(rows: DataFrame, by: str, text: str, translated: str, current: Column) -> DataFrame:
    """Done, total, stale, and the share of the characters that are done."""
    done = F.col(translated).isNotNull() & current
    return rows.groupBy(by).agg(F.count_if(done).alias("done"), F.count("*").alias("total"), F.count_if(F.col(translated).isNotNull() & ~current).alias("stale"), (F.sum(F.when(done, F.length(text)).otherwise(0)) / F.sum(F.length(text))).alias("share"))


def largest_spread(rows: DataFrame, by: str, lat: str, lon: str) -> DataFrame:
    """The largest distance between two of a group's hits; 0 for one, or for none with a position. Groups may have any
    number of hits, anywhere on the globe: see globe.farthest()."""
    best = farthest(rows, by, lat, lon).withColumnRenamed("metres", "spread_m")
    groups = rows.select(by).distinct()
    return groups.join(best.withColumnRenamed(by, "_by"), F.col(by).eqNullSafe(F.col("_by")), "left").select(by, F.coalesce("spread_m", F.lit(0.0)).alias("spread_m"))
