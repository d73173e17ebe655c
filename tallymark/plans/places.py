"""Queries with positions. The tables have none, so both engines derive the same from ids, by integer arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import cosine_distance, fuel_cost, haversine, in_box, in_viewport, proposed_box, road_km, shown_at_zoom
from ..operators.ranking import near_me as near_me_list
from ..operators.reconcile import country_report, ranked_position, spread_usable
from ..operators.resolve import corridor as corridor_of
from ..operators.resolve import distance_join, nearest_within, shared_places
from ..operators.summary import coverage as coverage_of
from ..operators.summary import largest_spread

HOME = (47.3, 11.4)
LINE = [(36.0, -8.0), (40.0, 0.0), (44.0, 5.0), (48.0, 12.0), (54.0, 25.0)]


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _at(key: str) -> tuple[Column, Column]:
    lat = F.lit(35) + F.pmod(F.col(key) * 37, F.lit(2000)) / 100.0
    lon = F.lit(-10) + F.pmod(F.col(key) * 53, F.lit(4000)) / 100.0
    return lat, lon


def suppliers(spark: SparkSession, d: str) -> DataFrame:
    lat, lon = _at("s_suppkey")
    return read(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey", lat.alias("lat"), lon.alias("lon"), (F.col("s_suppkey") % 3 + 1).cast("int").alias("tier"))


def customers(spark: SparkSession, d: str) -> DataFrame:
    lat, lon = _at("c_custkey")
    return read(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", (lat + 0.003).alias("c_lat"), (lon - 0.004).alias("c_lon"))


_S = "s AS (SELECT s_suppkey, s_name, s_nationkey, 35 + (s_suppkey*37 % 2000)/100.0 AS lat, -10 + (s_suppkey*53 % 4000)/100.0 AS lon, CAST(s_suppkey % 3 + 1 AS INTEGER) AS tier FROM supplier)"
_C = "c AS (SELECT c_custkey, c_nationkey, c_mktsegment, 35 + (c_custkey*37 % 2000)/100.0 + 0.003 AS c_lat, -10 + (c_custkey*53 % 4000)/100.0 - 0.004 AS c_lon FROM customer)"


def _hav(a: str, b: str, c: str, d: str) -> str:
    return f"(2*6371000.0*asin(sqrt(least(1.0, power(sin((radians({c})-radians({a}))/2),2) + cos(radians({a}))*cos(radians({c}))*power(sin((radians({d})-radians({b}))/2),2)))))"


def near_me(spark: SparkSession, d: str) -> DataFrame:
    rows = suppliers(spark, d).join(read(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(read(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return near_me_list(rows, "lat", "lon", "tier", "s_name", HOME, 3000).select("s_suppkey", "s_name", "n_name", "r_name", "tier", "km")


def near_me_page(spark: SparkSession, d: str) -> DataFrame:
    return near_me_list(suppliers(spark, d), "lat", "lon", "tier", "s_name", HOME, 1500, tiers=[1, 2], offset=10, rows_shown=10).select("s_suppkey", "tier", "km")


def nearest_within_radius(spark: SparkSession, d: str) -> DataFrame:
    s = suppliers(spark, d).select("s_suppkey", "lat", "lon")
    out = nearest_within(customers(spark, d), s, 60_000, ("c_lat", "c_lon"), ("lat", "lon"), "c_custkey", "s_suppkey")
    return out.select("c_custkey", "s_suppkey", F.round("metres", 1).alias("metres"))


def distance_band(spark: SparkSession, d: str) -> DataFrame:
    s, c = suppliers(spark, d).select("s_suppkey", "lat", "lon"), customers(spark, d).select("c_custkey", "c_lat", "c_lon")
    out = distance_join(s, c, 40_000, ("lat", "lon"), ("c_lat", "c_lon"))
    return out.select("s_suppkey", "c_custkey", F.round("metres", 1).alias("metres"))


def viewport_groups(spark: SparkSession, d: str) -> DataFrame:
    shown = customers(spark, d).where(in_viewport("c_lat", "c_lon", 40.0, 0.0, 46.0, 12.0)).withColumn("lat1", F.floor("c_lat")).withColumn("lon1", F.floor("c_lon"))
    return shared_places(shown, "lat1", "lon1").select("lat1", "lon1", "n", "c_custkey")


def visible_at_zoom(spark: SparkSession, d: str) -> DataFrame:
    zooms = spark.range(0, 12).withColumnRenamed("id", "zoom")
    s = suppliers(spark, d).groupBy("tier").count()
    # a dozen zoom levels against one row for each tier
    return zooms.join(F.broadcast(s), shown_at_zoom("tier", "zoom")).groupBy("zoom").agg(F.sum("count").alias("shown"))


def country_boxes(spark: SparkSession, d: str) -> DataFrame:
    b = suppliers(spark, d).groupBy("s_nationkey").agg(proposed_box("lat", "lon", F.col("tier") == 1).alias("b"))
    return b.select("s_nationkey", *(F.round(F.col("b")[x], 3).alias(x) for x in ("south", "west", "north", "east")))


def outside_box(spark: SparkSession, d: str) -> DataFrame:
    rows = country_report(suppliers(spark, d), in_box("lat", "lon", 38.0, -5.0, 52.0, 25.0), F.col("s_nationkey") % 5 == 0)
    return rows.select("s_suppkey", "reasons")


def corridor(spark: SparkSession, d: str) -> DataFrame:
    out = corridor_of(suppliers(spark, d), LINE, 120_000, "lat", "lon", "s_suppkey")
    return out.select("s_suppkey", F.round("off_m", 0).alias("off_m"), F.round("along_m", 0).alias("along_m"))


def _corridor_sql() -> str:
    from math import cos, pi, radians

    m, legs, run = 6_371_000.0 * pi / 180, [], 0.0
    for i, ((a, b), (c, e)) in enumerate(zip(LINE[:-1], LINE[1:], strict=True)):
        k = cos(radians((a + c) / 2))
        vx, vy = (e - b) * k * m, (c - a) * m
        n = (vx * vx + vy * vy) ** 0.5
        legs.append(f"SELECT s_suppkey, {i} AS leg, (lon-({b}))*{k * m!r} AS px, (lat-({a}))*{m!r} AS py, {vx!r} AS vx, {vy!r} AS vy, {n!r} AS n, {run!r} AS run FROM s")
        run += n
    return f"""WITH {_S}, l AS ({' UNION ALL '.join(legs)}), t AS (SELECT *, greatest(0.0, least(1.0, (px*vx+py*vy)/(n*n))) AS t FROM l),
        o AS (SELECT s_suppkey, sqrt(power(px-t*vx,2)+power(py-t*vy,2)) AS off_m, t*n+run AS along_m FROM t),
        b AS (SELECT *, row_number() OVER (PARTITION BY s_suppkey ORDER BY off_m, along_m) AS r FROM o)
        SELECT s_suppkey, round(off_m, 0) AS off_m, round(along_m, 0) AS along_m FROM b WHERE r = 1 AND off_m <= 120000"""


def route_cost(spark: SparkSession, d: str) -> DataFrame:
    n = read(spark, d, "nation").withColumn("price", F.when(F.col("n_nationkey") % 4 > 0, 1.2 + F.col("n_nationkey") * 0.05))
    s = suppliers(spark, d).withColumn("km", road_km(haversine(F.lit(HOME[0]), F.lit(HOME[1]), "lat", "lon")))
    out = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).withColumn("c", fuel_cost(F.col("km"), F.lit(7), "price"))
    return out.select("s_suppkey", F.col("km").cast("long").alias("km"), F.col("c")["low"].alias("low"), F.col("c")["high"].alias("high"))


def great_circle(spark: SparkSession, d: str) -> DataFrame:
    m = cosine_distance(F.lit(HOME[0]), F.lit(HOME[1]), "lat", "lon")
    return suppliers(spark, d).select("s_suppkey", F.round(m / 1000, 2).alias("km"))


def coverage_levels(spark: SparkSession, d: str) -> DataFrame:
    s = suppliers(spark, d).select(F.col("tier"), F.col("s_nationkey").alias("country"), F.when(F.col("s_suppkey") % 7 > 0, F.col("s_suppkey") % 4).alias("league"))
    return coverage_of(s, "tier", "country", "league")


def spread_by_nation(spark: SparkSession, d: str) -> DataFrame:
    return largest_spread(suppliers(spark, d), "s_nationkey", "lat", "lon").select("s_nationkey", F.round("spread_m", 0).alias("spread_m"))


def position_evidence(spark: SparkSession, d: str) -> DataFrame:
    s = suppliers(spark, d).select("s_suppkey", F.when(F.col("s_suppkey") % 4 > 0, F.col("lat")).alias("a1"), F.col("lon").alias("o1"), (F.col("lat") + 0.001 * (F.col("s_suppkey") % 3)).alias("a2"), F.when(F.col("s_suppkey") % 5 > 0, F.col("lon")).alias("o2"))
    p = ranked_position([("first", "a1", "o1"), ("second", "a2", "o2")])
    return s.withColumn("p", p).select("s_suppkey", F.col("p")["source"].alias("source"), F.col("p")["others"].alias("others"), F.col("p")["agree"].alias("agree"))


def usable_hits(spark: SparkSession, d: str) -> DataFrame:
    return spread_usable(suppliers(spark, d).withColumn("g", F.col("s_suppkey") % 40), "g", "lat", "lon", 900_000)


QUERIES = {f.__name__: f for f in (near_me, near_me_page, nearest_within_radius, distance_band, viewport_groups, visible_at_zoom, country_boxes, outside_box, corridor, route_cost, great_circle, coverage_levels, spread_by_nation, position_evidence, usable_hits)}

_KM = f"floor({_hav(str(HOME[0]), str(HOME[1]), 'lat', 'lon')}/1000*1.25 + 0.5)"
ORACLE_SQL = {
    "near_me": f"""WITH {_S} SELECT s_suppkey, s_name, n_name, r_name, tier, CAST({_KM} AS BIGINT) AS km FROM s JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey WHERE {_KM} <= 3000 ORDER BY km, tier, s_name LIMIT 50""",
    "near_me_page": f"WITH {_S} SELECT s_suppkey, tier, CAST({_KM} AS BIGINT) AS km FROM s WHERE tier IN (1,2) AND {_KM} <= 1500 ORDER BY km, tier, s_name LIMIT 10 OFFSET 10",
    "nearest_within_radius": f"""WITH {_S}, {_C}, p AS (SELECT c_custkey, s_suppkey, {_hav('c_lat', 'c_lon', 'lat', 'lon')} AS m FROM c, s),
        r AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY m, s_suppkey) AS k FROM p)
        SELECT c.c_custkey, CASE WHEN r.m <= 60000 THEN r.s_suppkey END AS s_suppkey, round(r.m, 1) AS metres FROM c LEFT JOIN r ON c.c_custkey = r.c_custkey AND k = 1""",
    "distance_band": f"WITH {_S}, {_C}, p AS (SELECT s_suppkey, c_custkey, {_hav('lat', 'lon', 'c_lat', 'c_lon')} AS m FROM c, s) SELECT s_suppkey, c_custkey, round(m, 1) AS metres FROM p WHERE m <= 40000",
    "viewport_groups": f"""WITH {_C} SELECT CAST(floor(c_lat) AS BIGINT) AS lat1, CAST(floor(c_lon) AS BIGINT) AS lon1, count(*) OVER p AS n, c_custkey
        FROM c WHERE c_lat BETWEEN 37.0 AND 49.0 AND c_lon BETWEEN -6.0 AND 18.0 WINDOW p AS (PARTITION BY floor(c_lat), floor(c_lon)) QUALIFY count(*) OVER p > 1""",
    "visible_at_zoom": f"""WITH {_S} SELECT zoom, count(*) AS shown FROM range(12) z(zoom), s WHERE zoom >= CASE tier WHEN 1 THEN 0 WHEN 2 THEN 7 ELSE 9 END GROUP BY zoom""",
    "country_boxes": f"""WITH {_S} SELECT s_nationkey, round(min(CASE WHEN tier=1 THEN lat END)-0.15,3) AS south, round(min(CASE WHEN tier=1 THEN lon END)-0.15,3) AS west,
        round(max(CASE WHEN tier=1 THEN lat END)+0.15,3) AS north, round(max(CASE WHEN tier=1 THEN lon END)+0.15,3) AS east FROM s GROUP BY 1""",
    "outside_box": f"""WITH {_S}, r AS (SELECT s_suppkey, concat_ws('; ', CASE WHEN NOT (lat BETWEEN 38 AND 52 AND lon BETWEEN -5 AND 25) THEN 'outside the box' END,
        CASE WHEN s_nationkey % 5 = 0 THEN 'other country' END) AS reasons FROM s) SELECT * FROM r WHERE reasons <> ''""",
    "corridor": _corridor_sql(),
    "route_cost": f"""WITH {_S}, k AS (SELECT s_suppkey, s_nationkey, {_KM} AS km FROM s), c AS (SELECT s_suppkey, km, km*7/100*(CASE WHEN n_nationkey % 4 > 0 THEN 1.2 + n_nationkey*0.05 END) AS c FROM k JOIN nation ON s_nationkey = n_nationkey)
        SELECT s_suppkey, CAST(km AS BIGINT) AS km, CAST(floor(c*0.9+0.5) AS BIGINT) AS low, CAST(floor(c*1.1+0.5) AS BIGINT) AS high FROM c""",
    "great_circle": f"""WITH {_S} SELECT s_suppkey, round(6371000.0*acos(greatest(-1.0, least(1.0, sin(radians({HOME[0]}))*sin(radians(lat)) + cos(radians({HOME[0]}))*cos(radians(lat))*cos(radians(lon)-radians({HOME[1]})))))/1000, 2) AS km FROM s""",
    "coverage_levels": f"""WITH {_S}, t AS (SELECT tier, s_nationkey AS country, CASE WHEN s_suppkey % 7 > 0 THEN s_suppkey % 4 END AS league FROM s),
        k AS (SELECT *, CASE WHEN league IS NOT NULL THEN concat_ws('|', country, tier, league) END AS l FROM t)
        SELECT 0 AS level, CAST(NULL AS INTEGER) AS tier, CAST(NULL AS INTEGER) AS country, count(*) AS entities, count(DISTINCT l) AS leagues, count(*) FILTER (l IS NULL) AS without FROM k
        UNION ALL SELECT 1, tier, NULL, count(*), count(DISTINCT l), count(*) FILTER (l IS NULL) FROM k GROUP BY tier
        UNION ALL SELECT 2, NULL, country, count(*), count(DISTINCT l), count(*) FILTER (l IS NULL) FROM k GROUP BY country""",
    "spread_by_nation": f"WITH {_S} SELECT a.s_nationkey, round(max({_hav('a.lat', 'a.lon', 'b.lat', 'b.lon')}), 0) AS spread_m FROM s a JOIN s b ON a.s_nationkey = b.s_nationkey GROUP BY 1",
    "position_evidence": """WITH t AS (SELECT s_suppkey, s_suppkey % 4 > 0 AS f, s_suppkey % 5 > 0 AS g, s_suppkey % 3 AS k FROM supplier)
        SELECT s_suppkey, CASE WHEN f THEN 'first' WHEN g THEN 'second' END AS source, CASE WHEN f AND g THEN 1 ELSE 0 END AS others, CASE WHEN f AND g THEN k < 2 END AS agree FROM t""",
    "usable_hits": f"""WITH {_S}, g AS (SELECT *, s_suppkey % 40 AS g FROM s), n AS (SELECT g, count(*) AS n FROM g GROUP BY g),
        f AS (SELECT a.g, max({_hav('a.lat', 'a.lon', 'b.lat', 'b.lon')}) AS m FROM g a JOIN g b ON a.g = b.g GROUP BY 1) SELECT g, n = 1 OR m <= 900000 AS usable FROM f JOIN n USING (g)""",
}
