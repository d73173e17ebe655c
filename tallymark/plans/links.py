"""Queries that a remote engine answered, joins over several hops, and orders, on the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import textkeys as T
from ..operators import ranking as W
from ..operators import reconcile as R
from ..operators import resolve as J
from ..operators import summary as A
from ..sources import files as S
from ..sources import markup as M
from ..sources import remote as N
from .places import _C as _CUSTOMERS
from .places import _S as _SUPPLIERS
from .places import _hav, customers, read, suppliers


def _clubs(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    return read(spark, d, "customer").select(k.alias("id"), (k % 40).alias("league"), (k % 60).alias("venue"), F.when(k % 3 > 0, k / 10.0).alias("lat"), F.when(k % 3 > 0, k / 20.0).alias("lon"))


def _some(spark: SparkSession, d: str, by: int, name: str = "id") -> DataFrame:
    return read(spark, d, "customer").where(F.col("c_custkey") % by == 0).select(F.col("c_custkey").alias(name))


def clubs_in_leagues(spark: SparkSession, d: str) -> DataFrame:
    leagues = read(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("league"))
    venues = read(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.when(F.col("s_suppkey") % 2 == 0, F.col("s_suppkey") / 4.0).alias("lat"), F.when(F.col("s_suppkey") % 2 == 0, F.col("s_suppkey") / 8.0).alias("lon"))
    return N.clubs_in_leagues(_clubs(spark, d), leagues, _some(spark, d, 13), _some(spark, d, 17), venues)


def league_sizes(spark: SparkSession, d: str) -> DataFrame:
    return N.league_sizes(_clubs(spark, d), _some(spark, d, 13), _some(spark, d, 17))


def _statements(spark: SparkSession, d: str) -> DataFrame:
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    rank = F.when(n % 3 == 0, "preferred").when(n % 3 == 1, "normal").otherwise("deprecated")
    return read(spark, d, "lineitem").select(k.alias("id"), (F.col("l_suppkey") % 50).alias("value"), rank.alias("rank"), F.when((k + n) % 4 == 0, "novalue").otherwise("value").alias("snaktype"))


def suppressed(spark: SparkSession, d: str) -> DataFrame:
    visible = read(spark, d, "orders").where("o_orderkey % 4 = 0").select(F.col("o_orderkey").alias("id"))
    leagues = read(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("league"))
    return N.suppressed(_statements(spark, d), visible, leagues)


def stale_preferred(spark: SparkSession, d: str) -> DataFrame:
    s = _statements(spark, d).groupBy("id").agg(F.collect_list(F.struct(F.col("value").cast("string").alias("value"), "snaktype", "rank", F.lit("").alias("start"), F.lit("").alias("end"))).alias("found"))
    return R.stale_preferred(s, "found", [str(i) for i in range(20)]).select("id")


def suppression_shapes(spark: SparkSession, d: str) -> DataFrame:
    s = _statements(spark, d).groupBy("id").agg(F.collect_list(F.struct(F.when(F.col("snaktype") == "value", F.col("value").cast("string")).alias("value"), "snaktype", "rank", F.lit("").alias("start"), F.lit("").alias("end"))).alias("found"))
    shape = R.suppression_shape("found", [str(i) for i in range(10)])
    return s.select("id", shape.alias("shape"), F.size(R.truthy("found")).alias("truthy")).where("shape is not null")


def existence_flags(spark: SparkSession, d: str) -> DataFrame:
    return N.existence_flags(_some(spark, d, 1), "id", person=_some(spark, d, 13), gone=_some(spark, d, 17))


def places_around(spark: SparkSession, d: str) -> DataFrame:
    c = customers(spark, d).select("c_custkey", F.col("c_lat").alias("lat"), F.col("c_lon").alias("lon"))
    out = N.places_around(c, suppliers(spark, d).select("s_suppkey", "lat", "lon"), 30_000, "c_custkey", "s_suppkey")
    return out.select("s_suppkey", "c_custkey", F.round("metres", 1).alias("metres"))


def union_aggregate(spark: SparkSession, d: str) -> DataFrame:
    a = read(spark, d, "orders").select((F.col("o_custkey") % 30).alias("group"), F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("a"), F.lit(None).cast("string").alias("b"))
    b = read(spark, d, "customer").select((F.col("c_custkey") % 40).alias("group"), F.col("c_custkey").alias("id"), F.lit("Z").alias("a"), F.when(F.col("c_custkey") % 40 > 20, F.col("c_mktsegment")).alias("b"))
    return N.trapped([a, b], 5)


def tagged_items(spark: SparkSession, d: str) -> DataFrame:
    leagues = read(spark, d, "nation").where("n_nationkey < 6").select(F.col("n_nationkey").cast("long").alias("league"))
    labels = read(spark, d, "orders").where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("label"))
    return N.tagged(_statements(spark, d), leagues, labels)


def pointers_at(spark: SparkSession, d: str) -> DataFrame:
    edges = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("source"), F.col("l_returnflag").alias("predicate"), F.col("l_partkey").alias("target"))
    targets = read(spark, d, "part").where("p_size < 10").select(F.col("p_partkey").alias("target"))
    return N.pointers(edges, targets, ["A", "R"])


def routes(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders")
    one = o.where("o_orderkey % 3 = 0").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("id"))
    two = o.where("o_orderkey % 3 = 1").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("id"))
    return S.first_found(_some(spark, d, 1, "c_custkey"), {"first": one, "second": two}, "c_custkey")


def redirects(spark: SparkSession, d: str) -> DataFrame:
    n = read(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("t"))
    hops = read(spark, d, "nation").where("n_nationkey % 5 > 0").select(F.col("n_nationkey").cast("string").alias("title"), ((F.col("n_nationkey") * 3 + 1) % 25).cast("string").alias("target"))
    return J.followed(n, hops, "t")


def two_hops(spark: SparkSession, d: str) -> DataFrame:
    n = read(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("t"))
    direct = read(spark, d, "nation").where("n_nationkey % 3 = 0").select(F.col("n_nationkey").cast("string").alias("title"), F.col("n_name").alias("id"))
    hops = read(spark, d, "nation").where("n_nationkey % 3 > 0").select(F.col("n_nationkey").cast("string").alias("title"), (F.col("n_nationkey") - F.col("n_nationkey") % 3).cast("string").alias("target"))
    return J.two_hops(n, "t", direct, hops, refuse=F.col("title") == "7")


def looked_up(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "customer").select("c_custkey", "c_nationkey", F.col("c_mktsegment").alias("raw"))
    dim = read(spark, d, "nation").where("n_nationkey < 20").select("n_nationkey", F.col("n_name").alias("label"))
    return J.lookup(c, dim, "c_nationkey", "n_nationkey", {"label": "raw"}).select("c_custkey", "label")


def parents_known(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    items = read(spark, d, "customer").select(k.alias("id"), F.array(k + 1, k * 2).alias("parents"), (k % 2).alias("markers"))
    known = read(spark, d, "customer").where(k % 7 == 0).select(k.alias("known_id"), (k % 2).alias("known_markers"))
    return J.parent_matches(items, known, F.col("markers") == F.col("known_markers")).select("id", "parent")


def second_source(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "part").select("p_partkey", "p_brand", "p_name")
    o = read(spark, d, "part").where("p_partkey % 9 = 0 and p_size < 30").select("p_brand", F.split("p_name", " ")[1].alias("other"))
    return J.confirmed_by(p, o.where("p_brand < 'Brand#3'"), "p_partkey", "p_brand", "p_name", "other").select("p_partkey", "second")


def best_strength(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "part").where("p_partkey % 3 < 2").select("p_partkey", "p_name")
    o = read(spark, d, "part").where("p_partkey % 3 = 2").groupBy(F.col("p_name").alias("other")).agg(F.min("p_partkey").alias("o"))
    # two thirds of the parts against the others: distinct names by their shared words
    words = lambda df, k, n: df.select("*", F.explode(F.split(n, " ")).alias("w"))
    pairs = words(p.select("p_name").distinct(), "p_name", "p_name").join(words(o, "o", "other"), "w").drop("w").distinct()
    pairs = pairs.withColumn("strength", J.name_strength(F.split("p_name", " "), F.split("other", " "), F.array(F.lit("ring"))))
    return p.join(J.best_strength(pairs, "p_name", "strength", "other", "o"), "p_name").select("p_partkey", "strength", "other")


def table_cells(spark: SparkSession, d: str) -> DataFrame:
    s = read(spark, d, "supplier").select("s_suppkey", F.concat(F.lit("<table><tr><th>x</th></tr><tr><td><a href='/s/"), F.col("s_suppkey").cast("string"), F.lit("'>"), "s_name", F.lit("</a></td><td>a&amp;b</td><td>"), F.col("s_nationkey").cast("string"), F.lit("</td><td>4</td></tr></table>")).alias("html"))
    r = M.table_rows(s, "html", ["s_suppkey"])
    return r.select("s_suppkey", F.col("cells")[0].alias("name"), F.col("cells")[1].alias("mark"), "link")


def flattened_props(spark: SparkSession, d: str) -> DataFrame:
    """The leaves of nested documents, ten levels deep, that are among the allowed paths."""
    e = read(spark, d, "events")
    text = F.concat(F.lit('{"id": '), F.col("event_id").cast("string"), F.lit(', "p": '), F.col("props"), F.lit(', "deep": {"a": [{"b": {"c": [[{"e": {"f": {"g": {"h": "'), F.col("event_type"), F.lit('"}}}}]]}}], "empty": {}}, "none": null, "more": [true, "t {x}", []]}'))
    leaves = T.flattened(e.select("event_id", text.alias("doc")), "doc", ["event_id"])
    return leaves.where(T.path_allowed("path", ["id", "p.", "deep.a[].b.c[][].e.f.g.h", "none", "more[]", "more[][]"]))


def flat_points(spark: SparkSession, d: str) -> DataFrame:
    s = suppliers(spark, d)
    k = F.col("s_suppkey")
    e = s.select("s_suppkey", F.when(k % 2 == 0, F.col("lat")).alias("lat"), F.when(k % 2 == 0, F.col("lon")).alias("lon"), F.when(k % 3 > 0, F.struct("lat", "lon")).alias("center"))
    return N.flat_elements(e, F.when(k % 11 == 0, "excluded"))[1].select("s_suppkey", "reason")


def entities_by_kind(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "part")
    why = N.not_an_entity(F.array("p_type"), F.col("p_name"), ["eco", "promo"], "widget$")
    return p.select("p_partkey", why.alias("why")).where("why is not null")


def sport_filter(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "part")
    why = N.not_that_sport(F.concat_ws(";", F.lower("p_type"), F.split("p_name", " ")[0]), ["small", "red"], F.col("p_name"), "bolt")
    return p.select("p_partkey", why.alias("why"))


def counts_by_kind(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "customer").withColumn("country", F.when(F.col("c_nationkey") % 4 > 0, F.col("c_nationkey").cast("string")))
    return A.by_country_and_kind(c, "country", "c_mktsegment")


def coverage_of_texts(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "part").withColumn("tr", F.when(F.col("p_partkey") % 3 > 0, F.col("p_name")))
    out = A.translation_coverage(o, "p_brand", "p_name", "tr", F.col("p_partkey") % 7 > 0)
    return out.select("p_brand", "done", "total", "stale", F.round("share", 6).alias("share"))


def review_order(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders")
    order = W.review_order("o_orderpriority", ["5-LOW", "1-URGENT"], "o_orderstatus", "o_orderkey")
    return W.placed(o.select("o_orderkey", "o_orderpriority", "o_orderstatus"), order).select("o_orderkey", "place")


def bucket_order(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.when(F.col("o_orderkey") % 3 == 0, "day").when(F.col("o_orderkey") % 3 == 1, "month").alias("precision"), F.when(F.col("o_orderkey") % 3 < 2, F.col("o_orderdate").cast("date")).alias("day"), (F.col("o_orderkey") % 10 == 0).alias("fav"))
    order = W.bucket_order("o_orderstatus", "o_orderkey", "precision", "day", "fav", F.lit("1998-06-30").cast("date"))
    return W.placed(o, order).select("o_orderkey", "place")


def country_order(spark: SparkSession, d: str) -> DataFrame:
    n = read(spark, d, "nation").withColumn("c", F.when(F.col("n_nationkey") % 6 > 0, F.col("n_name")))
    return W.placed(n.select("n_nationkey", "c"), [*W.fixed_prefix_order("c", ["NATION_8", "NATION_3"]), F.col("n_nationkey").asc()]).select("n_nationkey", "place")


def layered_rules(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    by_nation = read(spark, d, "nation").where("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("c_nationkey"), F.concat(F.lit("nation "), "n_name").alias("rule"))
    by_club = read(spark, d, "customer").where("c_custkey % 5 = 0").select("c_custkey", F.lit("club").alias("rule"))
    return R.layered({"country": by_nation, "club": by_club}, c, {"country": "c_nationkey", "club": "c_custkey"}).select("c_custkey", "rule", "layer")


def reviewed_proposals(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "part").select(F.col("p_brand").alias("k"), F.col("p_name").alias("ref"), "p_partkey", F.when(F.col("p_size") > 20, "confident").otherwise("ambiguous").alias("verdict"))
    rv = read(spark, d, "part").where("p_partkey % 40 = 0").groupBy(F.col("p_brand").alias("k"), F.col("p_name").alias("ref")).agg(F.when(F.min("p_partkey") % 80 == 0, "rejected").otherwise("held").alias("decision"))
    return R.reviewed(p, rv, "k", "ref").select("p_partkey", "verdict", "decision")


QUERIES = {k: f for k, f in list(globals().items()) if callable(f) and getattr(f, "__module__", "") == __name__ and not k.startswith("_")}

_C = "c AS (SELECT c_custkey AS id, c_custkey%40 AS league, c_custkey%60 AS venue, CASE WHEN c_custkey%3>0 THEN c_custkey/10.0 END AS lat, CASE WHEN c_custkey%3>0 THEN c_custkey/20.0 END AS lon FROM customer)"
_ST = """s AS (SELECT l_orderkey AS id, l_suppkey%50 AS value, CASE l_linenumber%3 WHEN 0 THEN 'preferred' WHEN 1 THEN 'normal' ELSE 'deprecated' END AS rank, CASE WHEN (l_orderkey+l_linenumber)%4=0 THEN 'novalue' ELSE 'value' END AS snaktype FROM lineitem)"""
_LIVE = "id%13>0 AND id%17>0"
ORACLE_SQL = {
    "clubs_in_leagues": f"""WITH {_C} SELECT id, league, venue, s_name AS venue_name, coalesce(CASE WHEN s_suppkey%2=0 THEN s_suppkey/4.0 END, lat) AS lat, coalesce(CASE WHEN s_suppkey%2=0 THEN s_suppkey/8.0 END, lon) AS lon
        FROM c LEFT JOIN supplier ON venue=s_suppkey WHERE {_LIVE} AND league IN (SELECT n_nationkey FROM nation)""",
    "league_sizes": f"WITH {_C} SELECT league, count(DISTINCT id) AS clubs FROM c WHERE {_LIVE} GROUP BY 1",
    "suppressed": f"""WITH {_ST}, t AS (SELECT * FROM s WHERE value IN (SELECT n_nationkey FROM nation)) SELECT id, 'deprecated' AS pattern FROM t WHERE rank='deprecated' AND id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey%4=0)
        UNION SELECT id, 'no-value' FROM t WHERE id IN (SELECT id FROM s WHERE rank='preferred' AND snaktype<>'value') AND id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey%4=0)""",
    "stale_preferred": f"WITH {_ST} SELECT id FROM s GROUP BY id HAVING count(*) FILTER (rank='preferred')>0 AND count(*) FILTER (rank='preferred' AND value<20)=0 AND count(*) FILTER (rank='normal' AND value<20)>0",
    "suppression_shapes": f"""WITH {_ST}, g AS (SELECT id, count(*) FILTER (snaktype='value' AND value<10) AS n, bool_or(rank='preferred' AND snaktype<>'value') AS b, coalesce(bool_or(rank='preferred' AND snaktype='value' AND value>=10), false) AND coalesce(bool_or(rank='normal' AND snaktype='value' AND value<10), false) AS c,
        coalesce(bool_and(rank='deprecated') FILTER (snaktype='value' AND value<10), false) AS a, bool_or(rank='preferred') AS p, count(*) FILTER (rank='preferred' AND snaktype='value') AS tp, count(*) FILTER (rank='normal' AND snaktype='value') AS tn FROM s GROUP BY id)
        SELECT id, CASE WHEN b THEN 'B' WHEN c THEN 'C' WHEN a THEN 'A' ELSE '?' END AS shape, CAST(CASE WHEN p THEN tp ELSE tn END AS INTEGER) AS truthy FROM g WHERE n>0""",
    "existence_flags": "SELECT c_custkey AS id, c_custkey%13=0 AS person, c_custkey%17=0 AS gone FROM customer",
    "places_around": f"""WITH {_SUPPLIERS}, {_CUSTOMERS}, p AS (SELECT s_suppkey, c_custkey, {_hav("c_lat", "c_lon", "lat", "lon")} AS m FROM s, c),
        r AS (SELECT *, row_number() OVER (PARTITION BY s_suppkey ORDER BY m, c_custkey) AS k FROM p WHERE m <= 30000) SELECT s_suppkey, c_custkey, round(m, 1) AS metres FROM r WHERE k = 1""",
    "union_aggregate": """WITH u AS (SELECT o_custkey%30 AS "group", o_custkey AS id, o_orderstatus AS a, NULL AS b FROM orders UNION ALL SELECT c_custkey%40, c_custkey, 'Z', CASE WHEN c_custkey%40>20 THEN c_mktsegment END FROM customer)
        SELECT "group", count(DISTINCT id) AS ids, min(a) AS a, min(b) AS b FROM u GROUP BY 1 HAVING count(DISTINCT id)>=5 AND min(b) IS NOT NULL""",
    "tagged_items": f"WITH {_ST} SELECT value, s.id, rank, snaktype, o_orderstatus AS label FROM s LEFT JOIN orders ON o_orderkey=s.id AND o_orderkey%2=0 WHERE value<6",
    "pointers_at": "SELECT l_orderkey AS source, l_returnflag AS predicate, l_partkey AS target FROM lineitem WHERE l_returnflag IN ('A','R') AND l_partkey IN (SELECT p_partkey FROM part WHERE p_size<10)",
    "routes": """WITH a AS (SELECT o_custkey AS k, min(o_orderkey) FILTER (o_orderkey%3=0) AS x, min(o_orderkey) FILTER (o_orderkey%3=1) AS y FROM orders GROUP BY 1) SELECT c_custkey, coalesce(x,y) AS id, CASE WHEN x IS NOT NULL THEN 'first' WHEN y IS NOT NULL THEN 'second' END AS route FROM customer LEFT JOIN a ON k=c_custkey""",
    "redirects": """WITH n AS (SELECT n_nationkey AS k FROM nation), a AS (SELECT k, CASE WHEN k%5>0 THEN (k*3+1)%25 ELSE k END AS x FROM n), b AS (SELECT k, CASE WHEN x%5>0 THEN (x*3+1)%25 ELSE x END AS x FROM a), c AS (SELECT k, CASE WHEN x%5>0 THEN (x*3+1)%25 ELSE x END AS x FROM b)
        SELECT CAST(k AS VARCHAR) AS t, CAST(x AS VARCHAR) AS final FROM c""",
    "two_hops": "SELECT CAST(n_nationkey AS VARCHAR) AS t, CASE WHEN n_nationkey=7 THEN NULL ELSE 'NATION_'||(n_nationkey-n_nationkey%3) END AS id, CASE WHEN n_nationkey%3=0 THEN 'direct' WHEN n_nationkey<>7 THEN 'redirect' END AS route FROM nation",
    "looked_up": "SELECT c_custkey, coalesce(n_name, c_mktsegment) AS label FROM customer LEFT JOIN nation ON c_nationkey=n_nationkey AND n_nationkey<20",
    "parents_known": "WITH p AS (SELECT c_custkey AS id, unnest([c_custkey+1, c_custkey*2]) AS parent FROM customer) SELECT id, parent FROM p JOIN customer k ON k.c_custkey=parent AND k.c_custkey%7=0 AND k.c_custkey%2=id%2",
    "second_source": """WITH p AS (SELECT p_partkey, p_brand, p_name FROM part), o AS (SELECT p_brand, split_part(p_name,' ',2) AS other FROM part WHERE p_partkey%9=0 AND p_size<30 AND p_brand<'Brand#3')
        SELECT p_partkey, CASE WHEN EXISTS (SELECT 1 FROM o WHERE o.p_brand=p.p_brand AND (contains(other,p_name) OR contains(p_name,other))) THEN 'confirms' WHEN EXISTS (SELECT 1 FROM o WHERE o.p_brand=p.p_brand) THEN 'silent' ELSE '' END AS second FROM p""",
    "best_strength": """WITH p AS (SELECT p_partkey, p_name, list_distinct(string_split(p_name,' ')) AS a, list_filter(list_distinct(string_split(p_name,' ')), lambda w: w<>'ring') AS x FROM part),
        o AS (SELECT p_name AS other, min(p_partkey) AS o, any_value(a) AS b, any_value(x) AS y FROM p WHERE p_partkey%3=2 GROUP BY 1), m AS (SELECT DISTINCT p_name, a, x FROM p WHERE p_partkey%3<2),
        s AS (SELECT p_name, other, o, CASE WHEN (list_has_all(a,b) AND list_has_all(b,a)) OR replace(p_name,' ','')=replace(other,' ','') THEN 0 WHEN len(x)=0 OR len(y)=0 THEN NULL WHEN list_has_all(x,y) AND list_has_all(y,x) THEN 0 WHEN list_has_all(x,y) OR list_has_all(y,x) THEN 1 END AS r FROM m, o WHERE list_has_any(a,b)),
        k AS (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY r, o) AS n FROM s WHERE r IS NOT NULL) SELECT p_partkey, CASE r WHEN 0 THEN 'exact' ELSE 'contained' END AS strength, other FROM p JOIN k USING (p_name) WHERE n=1 AND p_partkey%3<2""",
    "table_cells": "SELECT s_suppkey, s_name AS name, 'a&b' AS mark, '/s/'||s_suppkey AS link FROM supplier",
    "flattened_props": """WITH l AS (SELECT event_id, unnest([{'path': 'id', 'leaf': event_id::VARCHAR, 'kind': 'number'}, {'path': 'p.k', 'leaf': json_extract_string(props, '$.k'), 'kind': 'number'}, {'path': 'deep.a[0].b.c[0][0].e.f.g.h', 'leaf': event_type, 'kind': 'string'},
        {'path': 'none', 'leaf': NULL, 'kind': 'null'}, {'path': 'more[0]', 'leaf': 'true', 'kind': 'boolean'}, {'path': 'more[1]', 'leaf': 't {x}', 'kind': 'string'}], recursive := true) FROM events) SELECT event_id, path, leaf, kind FROM l""",
    "flat_points": "SELECT s_suppkey, CASE WHEN s_suppkey%11=0 THEN 'excluded' ELSE 'no position' END AS reason FROM supplier WHERE s_suppkey%11=0 OR (s_suppkey%2=1 AND s_suppkey%3=0)",
    "entities_by_kind": "WITH w AS (SELECT p_partkey, CASE WHEN regexp_matches(lower(p_type),'eco|promo') THEN 'kind '||p_type WHEN regexp_matches(p_name,'widget$') THEN 'name' END AS why FROM part) SELECT * FROM w WHERE why IS NOT NULL",
    "sport_filter": "SELECT p_partkey, CASE WHEN NOT (lower(p_type) IN ('small','red') OR split_part(p_name,' ',1) IN ('small','red')) THEN 'sport' WHEN contains(p_name,'bolt') THEN 'name' END AS why FROM part",
    "counts_by_kind": "SELECT coalesce(CASE WHEN c_nationkey%4>0 THEN CAST(c_nationkey AS VARCHAR) END,'international') AS country, c_mktsegment, count(*) AS n FROM customer GROUP BY ALL",
    "coverage_of_texts": """WITH t AS (SELECT p_brand, length(p_name) AS n, p_partkey%3>0 AS tr, p_partkey%7>0 AS cur FROM part) SELECT p_brand, count(*) FILTER (tr AND cur) AS done, count(*) AS total, count(*) FILTER (tr AND NOT cur) AS stale, round(coalesce(sum(n) FILTER (tr AND cur),0)/sum(n), 6) AS share FROM t GROUP BY 1""",
    "review_order": "SELECT o_orderkey, CAST(row_number() OVER (ORDER BY CASE o_orderpriority WHEN '5-LOW' THEN 1 WHEN '1-URGENT' THEN 2 ELSE 3 END, o_orderstatus, o_orderkey) AS BIGINT) AS place FROM orders",
    "bucket_order": """WITH o AS (SELECT *, CASE WHEN o_orderkey%3<2 THEN CAST(o_orderdate AS DATE) END AS day FROM orders) SELECT o_orderkey, CAST(row_number() OVER (ORDER BY (o_orderkey%10=0)::INT DESC, o_orderstatus,
        CASE WHEN coalesce(day < DATE '1998-06-30', false) THEN 3 WHEN o_orderkey%3=0 THEN 0 WHEN o_orderkey%3=1 THEN 1 ELSE 2 END, day NULLS LAST, o_orderkey) AS BIGINT) AS place FROM o""",
    "country_order": "WITH n AS (SELECT n_nationkey, CASE WHEN n_nationkey%6>0 THEN n_name END AS c FROM nation) SELECT n_nationkey, CAST(row_number() OVER (ORDER BY CASE WHEN c IS NULL THEN 3 WHEN c='NATION_8' THEN 0 WHEN c='NATION_3' THEN 1 ELSE 2 END, c NULLS LAST, n_nationkey) AS BIGINT) AS place FROM n",
    "layered_rules": "SELECT c_custkey, 'nation '||n_name AS rule, 'country' AS layer FROM customer JOIN nation ON n_nationkey=c_nationkey WHERE n_nationkey%2=0 UNION ALL SELECT c_custkey, 'club', 'club' FROM customer WHERE c_custkey%5=0",
    "reviewed_proposals": """WITH r AS (SELECT p_brand, p_name, CASE WHEN min(p_partkey)%80=0 THEN 'rejected' ELSE 'held' END AS decision FROM part WHERE p_partkey%40=0 GROUP BY 1,2)
        SELECT p_partkey, coalesce(decision, CASE WHEN p_size>20 THEN 'confident' ELSE 'ambiguous' END) AS verdict, decision FROM part LEFT JOIN r USING (p_brand, p_name)""",
}
