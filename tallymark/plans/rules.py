"""Queries on name forms, labels, statements, verdicts and validation rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import geo as G
from ..functions import textkeys as T
from ..operators import quality as Q
from ..operators import ranking as W
from ..operators import reconcile as R
from ..operators import resolve as J
from ..sources import files as S
from ..sources import remote as N
from .places import _S as _SUPPLIERS
from .places import _hav, read, suppliers

AS_OF = "1998-06-30"


def _as_of() -> Column:
    return F.lit(AS_OF).cast("date")


def _orders(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "orders").withColumn("day", F.col("o_orderdate").cast("date")).withColumn("k", F.col("o_orderkey"))


def _parts(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "part").withColumn("k", F.col("p_partkey"))


def roster_keys(spark: SparkSession, d: str) -> DataFrame:
    x = F.concat(F.lit("F.C. "), "p_name", F.lit(" Ţară ß"))
    return _parts(spark, d).select("p_partkey", T.roster_key(x).alias("roster"), T.romanian_key(x).alias("romanian"))


def name_variants(spark: SparkSession, d: str) -> DataFrame:
    # a small file is one task, and the forms cost far more than reading it
    spread = _parts(spark, d).select("p_partkey", "p_name").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "p_partkey")
    p = spread.withColumn("place", F.element_at(F.split("p_name", " "), -1)).withColumn("name", F.concat("place", F.lit("er SV")))
    forms = T.name_forms("name")
    return p.select("p_partkey", F.array_join(F.transform(forms, lambda f: f["form"]), "|").alias("forms"), T.place_in_name(F.concat("place", F.lit(" am See")), "name", ["am"]).alias("place"), F.array_join(T.place_cuts(F.concat("place", F.lit(" am See")), ["am"]), ",").alias("cuts"))


def parts_of_lists(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey").cast("string")
    names = F.concat("p_name", F.lit(" / "), "p_type", F.lit(", –;"))
    urls = F.concat(F.lit("http://a/"), k, F.lit(";x ; https://b/"), k)
    return _parts(spark, d).select("p_partkey", F.array_join(T.split_names(names), "|").alias("names"), F.array_join(T.split_urls(urls), "|").alias("urls"))


def cleaned_cells(spark: SparkSession, d: str) -> DataFrame:
    x = F.concat(F.lit(" "), "p_name", F.lit(" [a] (C), at "), "p_brand")
    blank = F.when(F.col("k") % 3 == 0, F.lit("  ")).when(F.col("k") % 3 == 1, F.concat(F.lit(" "), "p_brand", F.lit(" ")))
    return _parts(spark, d).select("p_partkey", T.without_marks(x).alias("plain"), T.or_null(blank).alias("or_null"), T.trimmed(blank).alias("trimmed"))


def accent_patterns(spark: SparkSession, d: str) -> DataFrame:
    common = ["ring", "bolt"]
    return _parts(spark, d).select("p_partkey", F.rlike(F.lower("p_name"), T.accent_pattern("p_name", common)).alias("found"), F.length(T.accent_pattern("p_name", common)).alias("n"))


def picked_fields(spark: SparkSession, d: str) -> DataFrame:
    o = _orders(spark, d).withColumn("r", F.struct(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("home"), F.col("o_totalprice").alias("score")))
    results = F.array(F.struct(F.lit("half").alias("name"), F.col("k").alias("goals")), F.struct(F.lit("final").alias("name"), (F.col("k") + 1).alias("goals")))
    p = T.picked("r", ["id", "score"], F.col("o_orderstatus") == "F", ("score",))
    label = F.when(F.col("k") % 5 == 0, "half").when(F.col("k") % 5 == 1, "none").otherwise("final")
    out = o.withColumn("p", p).withColumn("label", label).withColumn("half", T.labelled_result(results, "half")).withColumn("final", T.labelled_result(results, "final"))
    return out.select("p.id", "p.score", F.when(F.col("label") == "half", F.col("half")["goals"]).when(F.col("label") == "final", F.col("final")["goals"]).alias("goals"))


def decoded_lines(spark: SparkSession, d: str) -> DataFrame:
    """Short lines, whose three points an encoder in SQL can't be asked for: what is known is the points."""
    known = F.element_at(F.array(F.lit("_p~iF~ps|U_ulLnnqC_mqNvxq`@"), F.lit("_p~iF~ps|U"), F.lit("")), (F.col("s_suppkey") % 3 + 1).cast("int"))
    pts = G.polyline_points(known, 5)
    return read(spark, d, "supplier").select("s_suppkey", F.size(pts).alias("n"), F.round(F.get(pts, F.size(pts) - 1)["lat"], 5).alias("lat"), F.round(F.get(pts, F.size(pts) - 1)["lon"], 5).alias("lon"))


def labels_chosen(spark: SparkSession, d: str) -> DataFrame:
    p = _parts(spark, d)
    m = F.map_filter(F.create_map(F.lit("de"), F.col("p_brand"), F.lit("en"), F.when(F.col("k") % 2 == 0, F.col("p_name")), F.lit("xx"), F.col("p_type")), lambda _, v: v.isNotNull())
    m2 = F.map_filter(m, lambda lang, _: (lang != "de") | (F.col("k") % 3 > 0))
    return p.select("p_partkey", F.array_join(T.labels_in_order(m, ["de"]), "|").alias("all"), T.best_label(m2, F.col("k").cast("string"), ("en", "de")).alias("best"))


def seasons_read(spark: SparkSession, d: str) -> DataFrame:
    y = F.year("day")
    title = F.concat(y.cast("string"), F.lit("–"), F.lpad(((y + 1) % 100).cast("string"), 2, "0"), F.lit(" Liga "), F.col("k").cast("string"))
    time = F.concat(F.lit("+"), F.date_format("day", "yyyy-MM-dd"), F.lit("T00:00:00Z"))
    return _orders(spark, d).select("o_orderkey", T.season_of(title).alias("season"), T.without_season(title).alias("title"), T.time_at_precision(time, 9 + F.col("k") % 3).alias("time"))


def claims_read(spark: SparkSession, d: str) -> DataFrame:
    # parts of a set number: by their size they would be few, and reading claims costs far more than moving rows
    spread = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "l_orderkey")
    li = spread.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_suppkey"))).alias("l"))
    one = lambda x: F.format_string('{"rank":"%s","mainsnak":{"snaktype":"value","datavalue":{"type":"wikibase-entityid","value":{"id":"Q%s"}}},"qualifiers":{"P580":[{"snaktype":"value","datavalue":{"type":"time","value":{"time":"+2020-0%s-01T00:00:00Z","precision":10}}}]}}', F.when(x["l_linenumber"] % 2 == 0, "preferred").otherwise("normal"), x["l_suppkey"], x["l_linenumber"])
    claims = F.concat(F.lit('{"P118":['), F.array_join(F.transform("l", one), ","), F.lit("]}"))
    found = li.select("l_orderkey", F.posexplode(T.statements(claims, "P118")).alias("place", "s"))
    return found.select("l_orderkey", "place", F.col("s")["value"].alias("value"), F.col("s")["rank"].alias("rank"), F.col("s")["start"].alias("start"))


def first_available(spark: SparkSession, d: str) -> DataFrame:
    a, b, c = (F.when(F.col("k") % n == 0, F.col("k") * n) for n in (5, 3, 2))
    return _orders(spark, d).withColumn("f", T.first_available(five=a, three=b, two=c)).select("o_orderkey", F.col("f")["value"].alias("value"), F.col("f")["label"].alias("label"))


def sentences_picked(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("k").cast("string")
    text = F.concat(F.lit("Opened on St. "), "p_brand", F.lit(". The "), "p_name", F.lit(" was red "), k, F.lit(" times! Then more."))
    return _parts(spark, d).withColumn("s", T.picked_sentence(text, "red", 4)).select("p_partkey", F.col("s")["sentence"].alias("sentence"), F.col("s")["matched"].alias("matched"), F.col("s")["past"].alias("past"), T.first_words("p_name", 1).alias("first"), T.clip_around(text, "red [0-9]", 1).alias("clip"), T.slug("p_brand").alias("slug"))


def in_word_set(spark: SparkSession, d: str) -> DataFrame:
    return _parts(spark, d).where(N.in_word_set(T.words("p_name"), ["red", "ring"])).select("p_partkey")


def dates_banned(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat(F.lit("until "), F.when(F.col("k") % 4 == 0, F.date_format("day", "yyyy-MM-dd")).when(F.col("k") % 4 == 1, F.date_format("day", "d.M.yyyy")).when(F.col("k") % 4 == 2, F.date_format("day", "d/M/yy")).when(F.col("k") % 8 == 3, F.date_format("day", "MMMM d")).when(F.col("k") % 16 == 7, F.date_format("day", "d'th of' MMMM yyyy")).otherwise(F.date_format("day", "MMM. d'rd', yyyy")))
    # slashed years of two digits are of this century, so all of them are to come
    found = D.banned_dates(text, _as_of())
    return _orders(spark, d).select("o_orderkey", F.size(found).alias("n")).where("n > 0")


def consistent_answer(spark: SparkSession, d: str) -> DataFrame:
    """The answer for one nation, and whether the guard refuses one that holds others too."""
    whole = read(spark, d, "customer")
    try:
        refused = N.consistent(whole, c_nationkey="3") is None
    except ValueError:
        refused = True
    return N.consistent(whole.where("c_nationkey = 3"), c_nationkey="3").select("c_custkey", F.lit(refused).alias("whole_refused"))


def ground_names(spark: SparkSession, d: str) -> DataFrame:
    w = F.split("p_name", " ")
    other = F.when(F.col("k") % 5 == 0, F.concat(w[0], w[1])).when(F.col("k") % 5 == 1, w[1]).when(F.col("k") % 5 == 2, F.lit("zzz yyy")).when(F.col("k") % 5 == 3, F.lit("")).otherwise(F.lit("arena"))
    return _parts(spark, d).select("p_partkey", J.ground_agrees(F.col("p_name"), other, ["arena"]).alias("agrees"))


def rows_conditional(spark: SparkSession, d: str) -> DataFrame:
    """Cells that need each other, and cells that are a word or a list of ids; rejected rows with their reasons."""
    k = F.col("c_custkey")
    scope = F.when(k % 4 == 0, "derby").when(k % 4 == 1, "all")
    who = F.when(k % 6 == 0, "Q1").when(k % 6 == 3, "Q2;Q3")
    ids = F.when(k % 5 == 0, "all").when(k % 5 == 1, F.concat(F.lit("Q"), k.cast("string"), F.lit("; Q9"))).when(k % 5 == 2, "unknown").when(k % 5 == 3, "all;Q1").otherwise("")
    rows = read(spark, d, "customer").select(k.cast("string").alias("id"), scope.alias("scope"), who.alias("opponent"), ids.alias("applies"))
    spec = Q.TableSpec(required=["id"], optional=["scope", "opponent", "applies"], rules={"scope and opponent": Q.conditional(F.col("scope") == "derby", F.col("opponent").isNotNull()), "applies to": Q.list_or_word("applies", ["all", "unknown"], "^Q[0-9]+$")})
    return Q.checked(rows, spec)[1].select("id", F.array_join(F.array_sort("reasons"), "; ").alias("reasons"))


def collapsed_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Customers a street apart, some on both sides of 180 degrees, some without a position or a ref."""
    k = F.col("c_custkey")
    lat = F.when(k % 11 > 0, F.lit(40) + F.pmod(k * 37, F.lit(5)) / 100.0 + F.pmod(k * 7, F.lit(5)) * 0.001)
    lon = F.when(k % 13 == 0, 179.9995).when(k % 13 == 1, -179.9995).otherwise(F.lit(5) + F.pmod(k * 53, F.lit(3)) * 0.001)
    ref = F.when(k % 3 > 0, F.concat(F.lit("r"), (k % 101).cast("string")))
    order = (k * 7919 % 1_000_003) * 1_000_000_000 + k
    rows = read(spark, d, "customer").select("c_nationkey", ref.alias("ref"), lat.alias("lat"), lon.alias("lon"), (k % 7).alias("tier"), order.alias("ord"))
    return W.collapsed(rows, "c_nationkey", "ref", "lat", "lon", "tier", "ord", 200.0).select("c_nationkey", "ref", "tier", "ord")


def matches_in_order(spark: SparkSession, d: str) -> DataFrame:
    o = _orders(spark, d).select("o_orderkey", F.when(F.col("k") % 4 > 0, F.col("day")).alias("at"))
    return W.placed(o, W.match_order("at", "o_orderkey", True)).select("o_orderkey", "place")


def nearer_ends(spark: SparkSession, d: str) -> DataFrame:
    home = G.haversine(F.lit(47.3), F.lit(11.4), "lat", "lon")
    back = G.haversine(F.lit(52.5), F.lit(13.4), "lat", "lon")
    return suppliers(spark, d).select("s_suppkey", F.round(W.nearer_end(home, F.when(F.col("s_suppkey") % 3 > 0, back)), 1).alias("metres"))


def spans_read(spark: SparkSession, d: str) -> DataFrame:
    day = F.col("day").cast("string")
    x = F.when(F.col("k") % 4 == 0, day).when(F.col("k") % 4 == 1, F.concat(day, F.lit("/"), F.date_add("day", 3).cast("string"))).when(F.col("k") % 4 == 2, F.concat(day, F.lit("/"), F.date_sub("day", 3).cast("string"))).otherwise("1998-02-30")
    s = D.span(x)
    return _orders(spark, d).select("o_orderkey", s["start"].alias("start"), s["end"].alias("end"), F.size(D.months_of("day", F.date_add("day", 40))).alias("months"), D.alarm_trigger(F.col("k") % 7).alias("trigger"))


def occurrences(spark: SparkSession, d: str) -> DataFrame:
    day = F.col("day").cast("string")
    fixture = lambda src, at: F.struct(at.alias("date"), F.lit(src).alias("dateSource"))
    f = F.when(F.col("k") % 3 == 0, F.array(fixture("confirmed", day), fixture("disputed", day), fixture("inferred", F.date_add("day", 400).cast("string"))))
    n = F.when(F.col("k") % 3 == 1, fixture("confirmed", day))
    own = F.when(F.col("k") % 2 == 0, day)
    o = _orders(spark, d).select("o_orderkey", F.explode(D.occurrences(f, n, F.lit("confirmed"), own, _as_of())).alias("x"))
    return o.select("o_orderkey", F.col("x")["suffix"].alias("suffix"), F.col("x")["start"].alias("start"), F.col("x")["reason"].alias("reason"))


def classified_evidence(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "customer")
    parts = {"debt": c.where("c_acctbal < 0").select("c_custkey", F.col("c_acctbal").alias("detail")), "machinery": c.where("c_mktsegment = 'MACHINERY'").select("c_custkey")}
    return R.classified(parts, ["c_custkey", "detail"]).select("branch", "kind", "c_custkey", F.col("detail").isNotNull().alias("has_detail"))


def evidence_by_rules(spark: SparkSession, d: str) -> DataFrame:
    """Customers as a roster, as entities with tags, and as team items that stand for others."""
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("id"))
    k = F.col("id")
    roster = c.where("id % 3 > 0").select("id", (k % 4).alias("tier")).unionByName(c.where("id % 33 = 1").select("id", F.lit(9).cast("long").alias("tier")))
    infos = c.where("id % 5 > 0").select("id", F.when(k % 2 == 0, k % 4).when(k % 8 == 1, k % 3).alias("tagged"), F.when(k % 7 == 0, "old").alias("shape"), (k % 6 - 2).alias("grounds"), (k % 11 == 0).alias("dissolved"))
    twins = c.where("id % 3 = 2 and id % 5 < 4").select("id", (k + 1).alias("twin"))
    return R.roster_evidence(roster, infos, twins)


def _entities(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    return read(spark, d, "customer").select("c_custkey", F.when(k % 3 > 0, F.array(F.lit("L"))).alias("leagues"), F.when(k % 4 > 0, k / 10.0).alias("lat"), F.when(k % 4 > 1, k / 20.0).alias("lon"), F.when(k % 5 > 0, k / 30.0).alias("ground_lat"), F.when(k % 7 == 0, "1990").alias("dissolved"), F.when(k % 6 > 0, k % 3).alias("tier"))


def diagnosed(spark: SparkSession, d: str) -> DataFrame:
    out = R.diagnosis(_entities(spark, d), "leagues", "lat", "ground_lat", "dissolved", {"person": F.col("c_custkey") % 11 == 0})
    return out.select("c_custkey", "position", F.array_join("stopped_by", ",").alias("stopped_by"))


def unplaced_entities(spark: SparkSession, d: str) -> DataFrame:
    return R.unplaced(_entities(spark, d), "tier", "lat", "lon").select("c_custkey")


def agreement_groups(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    have = {"a": k % 2 > 0, "b": k % 3 > 0, "c": k % 5 > 0}
    g = R.agreement_groups({("a", "b"): k % 7 > 3, ("b", "c"): k % 11 > 4}, have, "a")
    return read(spark, d, "customer").withColumn("g", g).select("c_custkey", F.array_join(F.col("g")["with_lead"], ",").alias("with_lead"), F.col("g")["largest_other"].alias("largest_other"), F.col("g")["odd"].alias("odd"))


def same_places(spark: SparkSession, d: str) -> DataFrame:
    s = suppliers(spark, d).withColumn("a1", F.col("lat") + 0.001 * (F.col("s_suppkey") % 4)).withColumn("a2", F.when(F.col("s_suppkey") % 3 == 0, F.col("lat") + 0.0005)).withColumn("o2", F.col("lon"))
    return s.select("s_suppkey", R.same_by_position("lat", "lon", [("a1", "o2"), ("a2", "o2")]).alias("same"))


def proposal_verdicts(spark: SparkSession, d: str) -> DataFrame:
    e = _entities(spark, d)
    problems = F.array(F.when(F.col("leagues").isNull(), "no league"), F.when(F.col("dissolved").isNotNull(), "dissolved"))
    return e.select("c_custkey", R.proposal_verdict(problems, "lat").alias("verdict"))


def decisions_checked(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("k")
    rows = _orders(spark, d).select("o_orderkey", (k % 997).cast("string").alias("key"), F.when(k % 5 > 0, k.cast("string")).alias("ref"), F.when(k % 3 == 0, "held").when(k % 7 == 0, "maybe").otherwise("rejected").alias("decision"), F.when(k % 11 > 0, "r").otherwise(" ").alias("reason"), F.when(k % 13 > 0, F.col("day").cast("string")).otherwise("soon").alias("decided_on"))
    _, bad = R.review_decisions(rows, "key", "ref")
    return bad.select("o_orderkey", "problem")


def pairs_not_allowed(spark: SparkSession, d: str) -> DataFrame:
    allowed = read(spark, d, "orders").where("o_orderkey % 2 = 0 and o_orderpriority <> '5-LOW'").select("o_orderstatus", "o_orderpriority")
    return Q.agreement(read(spark, d, "orders"), "o_orderstatus", "o_orderpriority", allowed).select("o_orderkey")


def lists_compared(spark: SparkSession, d: str) -> DataFrame:
    li = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_set(F.when(F.col("l_linenumber") % 2 == 0, F.col("l_suppkey") % 9)).alias("a"), F.collect_set(F.when(F.col("l_linenumber") % 3 == 0, F.col("l_suppkey") % 9)).alias("b"))
    x = Q.list_difference(F.col("a"), F.col("b"))
    return li.select("l_orderkey", F.array_join(F.array_sort(x["stray"]), ",").alias("stray"), F.array_join(F.array_sort(x["absent"]), ",").alias("absent"))


def why_statuses(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("k")
    o = _orders(spark, d).select("o_orderkey", F.when(k % 5 > 0, "checked").when(k % 10 == 0, "unverified").alias("st"), F.when(k % 3 > 0, F.col("day").cast("string")).alias("on"), F.when(k % 7 == 0, Q.NO_CLAIM).alias("ba"), F.when(k % 4 > 0, F.array(F.lit("https://a/"))).alias("src"), F.when(k % 9 == 0, "n").alias("note"))
    w = Q.why_status("st", "on", "ba", "src", "note", _as_of())
    return o.select("o_orderkey", F.size(w["errors"]).alias("errors"), F.size(w["warnings"]).alias("warnings"))


def long_quotes(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "documents")
    return c.where(Q.quote_problems("text", 400)).select("doc_id")


def crowded_pages(spark: SparkSession, d: str) -> DataFrame:
    return Q.crowded(read(spark, d, "orders"), "o_custkey", 12)


def sale_notices(spark: SparkSession, d: str) -> DataFrame:
    return Q.sale_notices(_orders(spark, d), "day", _as_of(), 700).select("o_orderkey", "days_past")


def link_lines(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("k")
    rows = _orders(spark, d).select("o_orderkey", (k % 501).cast("string").alias("bucket"), F.when(k % 3 == 0, (k % 50).cast("string")).otherwise("").alias("event"), F.when(k % 3 == 1, (k % 4).cast("string")).otherwise(F.when(k % 15 == 0, "9").otherwise("")).alias("host"), F.when(k % 3 == 1, F.lit("1;2")).otherwise("").alias("others"), (k % 2).cast("string").alias("leg"))
    events = read(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("id"))
    return Q.link_problems(rows, "bucket", "event", "host", "others", "leg", "o_orderkey", events, "id")


def network_first(spark: SparkSession, d: str) -> DataFrame:
    n = read(spark, d, "nation").select("n_nationkey", "n_name")
    kept = S.network_first(None, n, F.lit(60) + F.col("n_nationkey"))
    return S.network_first(n, kept, F.lit(0)).withColumn("from_network", F.lit(True)).unionByName(kept.withColumn("from_network", F.lit(False)))


QUERIES = {k: f for k, f in list(globals().items()) if callable(f) and getattr(f, "__module__", "") == __name__ and not k.startswith("_")}

_D = f"DATE '{AS_OF}'"
_O = "o AS (SELECT *, CAST(o_orderdate AS DATE) AS day, o_orderkey AS k FROM orders)"
_E = "e AS (SELECT c_custkey, c_custkey AS k, c_custkey%3>0 AS league, c_custkey%4>0 AS has_lat, c_custkey%4>1 AS has_lon, c_custkey%5>0 AS ground, c_custkey%7=0 AS dissolved, c_custkey%6>0 AS has_tier FROM customer)"
#: Whether a candidate joins a kept one, in the SQL of collapsed_candidates.
_JOINS = f"coalesce(x.ref = n[1].ref, false) OR coalesce({_hav('x.lat', 'x.lon', 'n[1].lat', 'n[1].lon')} <= 200, false)"

ORACLE_SQL = {
    "roster_keys": "SELECT p_partkey, 'f c ' || p_name || ' tara ss' AS roster, 'f.c. ' || p_name || ' tara ' AS romanian FROM part",
    "name_variants": "WITH p AS (SELECT p_partkey, string_split(p_name, ' ')[-1] AS place FROM part) SELECT p_partkey, place || 'er sv' || CASE WHEN length(place) + 2 >= 6 THEN '|' || place || ' sv' ELSE '' END AS forms, CASE WHEN length(place) + 2 >= 6 AND length(place) >= 3 THEN place END AS place, '3,1' AS cuts FROM p",
    "parts_of_lists": "SELECT p_partkey, p_name || '|' || p_type AS names, 'http://a/' || p_partkey || ';x|https://b/' || p_partkey AS urls FROM part",
    "cleaned_cells": "SELECT p_partkey, p_name AS plain, CASE WHEN p_partkey%3=1 THEN p_brand END AS or_null, CASE WHEN p_partkey%3=1 THEN p_brand ELSE '' END AS trimmed FROM part",
    "accent_patterns": """WITH w AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w, generate_subscripts(string_split(p_name, ' '), 1) AS i FROM part), b AS (SELECT p_partkey, arg_max(w, length(w)*100+i) AS w FROM w WHERE w NOT IN ('ring', 'bolt') GROUP BY 1),
        c AS (SELECT p_partkey, list_sum(list_transform(string_split(w, ''), lambda c: CASE c WHEN 'a' THEN 11 WHEN 'c' THEN 6 WHEN 'e' THEN 9 WHEN 'i' THEN 8 WHEN 'n' THEN 6 WHEN 'o' THEN 10 WHEN 's' THEN 7 WHEN 't' THEN 6 WHEN 'u' THEN 9 WHEN 'z' THEN 6 ELSE 1 END)) AS n FROM b)
        SELECT p.p_partkey, CASE WHEN n IS NOT NULL THEN true END AS found, CAST(n AS INTEGER) AS n FROM part p LEFT JOIN c ON c.p_partkey = p.p_partkey""",
    "picked_fields": "SELECT o_orderkey AS id, CASE WHEN o_orderstatus='F' THEN o_totalprice END AS score, CASE o_orderkey%5 WHEN 0 THEN o_orderkey WHEN 1 THEN NULL ELSE o_orderkey+1 END AS goals FROM orders",
    "decoded_lines": "SELECT s_suppkey, CAST([3,1,0][s_suppkey%3+1] AS INTEGER) AS n, [43.252,38.5,NULL][s_suppkey%3+1]::DOUBLE AS lat, [-126.453,-120.2,NULL][s_suppkey%3+1]::DOUBLE AS lon FROM supplier",
    "labels_chosen": "SELECT p_partkey, CASE WHEN p_partkey%2=0 THEN p_name || '|' ELSE '' END || p_brand || '|' || p_type AS \"all\", CASE WHEN p_partkey%2=0 THEN p_name WHEN p_partkey%3>0 THEN p_brand ELSE CAST(p_partkey AS VARCHAR) END AS best FROM part",
    "seasons_read": f"WITH {_O} SELECT o_orderkey, year(day) || '-' || lpad(CAST((year(day)+1)%100 AS VARCHAR), 2, '0') AS season, 'Liga ' || k AS title, CASE k%3 WHEN 0 THEN strftime(day, '%Y') WHEN 1 THEN strftime(day, '%Y-%m') ELSE strftime(day, '%Y-%m-%d') END AS time FROM o",
    "claims_read": "SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey)-1 AS INTEGER) AS place, 'Q' || l_suppkey AS value, CASE WHEN l_linenumber%2=0 THEN 'preferred' ELSE 'normal' END AS rank, '2020-0' || l_linenumber AS start FROM lineitem",
    "first_available": "SELECT o_orderkey, CASE WHEN o_orderkey%5=0 THEN o_orderkey*5 WHEN o_orderkey%3=0 THEN o_orderkey*3 WHEN o_orderkey%2=0 THEN o_orderkey*2 END AS value, CASE WHEN o_orderkey%5=0 THEN 'five' WHEN o_orderkey%3=0 THEN 'three' WHEN o_orderkey%2=0 THEN 'two' END AS label FROM orders",
    "sentences_picked": r"""WITH t AS (SELECT p_partkey, p_name, p_brand, contains(p_name, 'red ') AND false AS x FROM part)
        SELECT p_partkey, array_to_string(string_split('The ' || p_name || ' was red', ' ')[1:4], ' ') AS sentence, true AS matched, true AS past, split_part(p_name, ' ', 1) AS first, 'was red ' || p_partkey AS clip, lower(regexp_replace(p_brand, '[^A-Za-z0-9]+', '-', 'g')) AS slug FROM t""",
    "in_word_set": "SELECT p_partkey FROM part WHERE list_has_any(string_split(p_name, ' '), ['red', 'ring'])",
    "dates_banned": f"""WITH {_O}, t AS (SELECT k, CASE k%4 WHEN 2 THEN day + INTERVAL 100 YEAR WHEN 3 THEN CASE WHEN k%8=3 THEN try_cast('1998-' || strftime(day, '%m-%d') AS DATE) ELSE day END ELSE day END AS on_ FROM o)
        SELECT k AS o_orderkey, 1 AS n FROM t WHERE on_ IS NULL OR on_ > {_D}""",
    "consistent_answer": "SELECT c_custkey, EXISTS (SELECT 1 FROM customer WHERE c_nationkey <> 3) AS whole_refused FROM customer WHERE c_nationkey = 3",
    "ground_names": "SELECT p_partkey, CASE p_partkey%5 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN false END AS agrees FROM part",
    "rows_conditional": """WITH r AS (SELECT c_custkey::VARCHAR AS id, concat_ws('; ', CASE WHEN c_custkey%5 IN (3, 4) THEN 'applies to' END, CASE WHEN (c_custkey%4 = 0) <> (c_custkey%6 IN (0, 3)) THEN 'scope and opponent' END) AS reasons FROM customer) SELECT id, reasons FROM r WHERE reasons <> ''""",
    "collapsed_candidates": f"""WITH p AS (SELECT c_nationkey, {{'ref': CASE WHEN c_custkey%3>0 THEN 'r' || c_custkey%101 END, 'lat': CASE WHEN c_custkey%11>0 THEN 40 + (c_custkey*37%5)/100.0 + (c_custkey*7%5)*0.001 END,
            'lon': CASE c_custkey%13 WHEN 0 THEN 179.9995 WHEN 1 THEN -179.9995 ELSE 5 + (c_custkey*53%3)*0.001 END, 'tier': c_custkey%7, 'ord': (c_custkey*7919%1000003)*1000000000 + c_custkey}} AS r FROM customer),
        l AS (SELECT c_nationkey, list([r] ORDER BY r.ord) AS rows FROM p GROUP BY 1),
        k AS (SELECT c_nationkey, unnest(list_reduce(rows, lambda kept, n: CASE WHEN list_contains(list_transform(kept, lambda x: {_JOINS}), true)
            THEN list_transform(kept, lambda x, i: CASE WHEN i = list_position(list_transform(kept, lambda x: {_JOINS}), true) THEN {{'ref': x.ref, 'lat': x.lat, 'lon': x.lon, 'tier': least(x.tier, n[1].tier), 'ord': x.ord}} ELSE x END) ELSE list_concat(kept, n) END)) AS k FROM l)
        SELECT c_nationkey, k.ref AS ref, k.tier AS tier, k.ord AS ord FROM k""",
    "matches_in_order": f"WITH {_O} SELECT o_orderkey, row_number() OVER (ORDER BY CASE WHEN k%4>0 THEN day END NULLS FIRST, k) AS place FROM o",
    "nearer_ends": f"WITH {_SUPPLIERS} SELECT s_suppkey, round(CASE WHEN s_suppkey%3>0 THEN least({_hav('47.3', '11.4', 'lat', 'lon')}, {_hav('52.5', '13.4', 'lat', 'lon')}) ELSE {_hav('47.3', '11.4', 'lat', 'lon')} END, 1) AS metres FROM s",
    "spans_read": f"WITH {_O} SELECT o_orderkey, CASE WHEN k%4<2 THEN day END AS start, CASE k%4 WHEN 0 THEN day WHEN 1 THEN day+3 END AS \"end\", CAST(date_diff('month', day, day+40)+1 AS INTEGER) AS months, '-P' || k%7 || 'D' AS trigger FROM o",
    "occurrences": f"""WITH {_O}, x AS (SELECT k, unnest(CASE WHEN k%3=0 THEN ['-0','-1','-2'] ELSE [''] END) AS suffix, day FROM o), y AS (SELECT *, CASE WHEN suffix='-2' THEN day+400 WHEN k%3=2 AND k%2=1 THEN NULL ELSE day END AS d FROM x),
        z AS (SELECT *, CASE WHEN suffix='-1' THEN 'disputed date' WHEN d IS NULL THEN 'no date' WHEN d < {_D} THEN 'in the past' END AS reason FROM y) SELECT k AS o_orderkey, suffix, CASE WHEN reason IS NULL THEN d END AS start, reason FROM z""",
    "classified_evidence": "SELECT 0 AS branch, 'debt' AS kind, CAST(c_custkey AS VARCHAR) AS c_custkey, true AS has_detail FROM customer WHERE c_acctbal < 0 UNION ALL SELECT 1, 'machinery', CAST(c_custkey AS VARCHAR), false FROM customer WHERE c_mktsegment = 'MACHINERY'",
    "evidence_by_rules": """WITH c AS (SELECT c_custkey AS k FROM customer), o AS (SELECT k, min(t) AS tier, count(*) AS times FROM (SELECT k, k%4 AS t FROM c WHERE k%3>0 UNION ALL SELECT k, 9 FROM c WHERE k%33=1) GROUP BY k),
        i AS (SELECT k, CASE WHEN k%2=0 THEN k%4 WHEN k%8=1 THEN k%3 END AS tag, CASE WHEN k%7=0 THEN 'old' END AS shape, k%6-2 AS g, k%11=0 AS gone FROM c WHERE k%5>0), w AS (SELECT k, k+1 AS twin FROM c WHERE k%3=2 AND k%5<4),
        s AS (SELECT o.k, o.tier, times, i.k IS NOT NULL AS there, coalesce(i.tag, t.tag) AS tag, i.tag IS NULL AND t.tag IS NOT NULL AS via, coalesce(i.shape, t.shape) AS shape, CASE WHEN i.tag IS NULL AND t.tag IS NOT NULL THEN t.g ELSE i.g END AS g, i.gone, w.twin
            FROM o LEFT JOIN i ON i.k=o.k LEFT JOIN w ON w.k=o.k LEFT JOIN i t ON t.k=w.twin),
        d AS (SELECT *, concat_ws('; ', 'tagged ' || tag, CASE WHEN via THEN 'via ' || twin END, CASE WHEN times > 1 THEN 'in several tiers' END) AS said FROM s)
        SELECT k AS id, tier, CASE WHEN NOT there THEN 0 WHEN tag=tier THEN 1 WHEN tag IS NOT NULL THEN 2 WHEN shape IS NOT NULL THEN 3 ELSE 4 END AS branch,
            CASE WHEN NOT there THEN 'roster-untagged' WHEN tag=tier THEN 'roster-ok' WHEN tag IS NOT NULL THEN 'roster-wrong-tier' WHEN shape IS NOT NULL THEN 'rank-shape' ELSE 'roster-untagged' END AS kind,
            CASE WHEN NOT there THEN 'no entity' WHEN tag IS NOT NULL THEN said WHEN shape IS NOT NULL THEN shape WHEN gone THEN 'dissolved' ELSE 'no tag' END AS detail FROM d
        UNION ALL SELECT k, tier, 5, 'two-grounds', g::VARCHAR FROM d WHERE there AND g > 1
        UNION ALL SELECT k, tag, CASE WHEN gone THEN 6 ELSE 7 END, CASE WHEN gone THEN 'extra-dissolved' ELSE 'extra' END, NULL FROM i WHERE tag IS NOT NULL AND k NOT IN (SELECT k FROM o) AND k NOT IN (SELECT twin FROM w)""",
    "diagnosed": f"WITH {_E} SELECT c_custkey, CASE WHEN has_lat THEN 'own' WHEN ground THEN 'ground' END AS position, concat_ws(',', CASE WHEN NOT league THEN 'no league' END, CASE WHEN NOT has_lat AND NOT ground THEN 'no position' END, CASE WHEN dissolved THEN 'dissolved' END, CASE WHEN k%11=0 THEN 'person' END) AS stopped_by FROM e",
    "unplaced_entities": f"WITH {_E} SELECT c_custkey FROM e WHERE has_tier AND NOT (has_lat AND has_lon)",
    "agreement_groups": """WITH h AS (SELECT c_custkey, c_custkey%2>0 AS a, c_custkey%3>0 AS b, c_custkey%5>0 AS c, c_custkey%7>3 AS ab, c_custkey%11>4 AS bc FROM customer), l AS (SELECT *, a AND b AND ab AS lb, b AND c AND bc AS mc FROM h)
        SELECT c_custkey, concat_ws(',', CASE WHEN a THEN 'a' END, CASE WHEN lb THEN 'b' END, CASE WHEN lb AND mc THEN 'c' END) AS with_lead, CAST(greatest(0, CASE WHEN b AND NOT lb THEN 1 + mc::INT ELSE 0 END, CASE WHEN c AND NOT (lb AND mc) THEN 1 + mc::INT ELSE 0 END) AS INTEGER) AS largest_other,
        (a::INT + lb::INT + (lb AND mc)::INT) < 2 AND b AND NOT lb AND mc AS odd FROM l""",
    "same_places": "SELECT s_suppkey, s_suppkey%4 < 2 OR s_suppkey%3 = 0 AS same FROM supplier",
    "proposal_verdicts": f"WITH {_E} SELECT c_custkey, CASE WHEN league AND NOT dissolved THEN 'ok' WHEN NOT has_lat THEN 'unplaced' ELSE 'attention' END AS verdict FROM e",
    "decisions_checked": f"""WITH {_O}, r AS (SELECT *, CASE WHEN k%5>0 THEN k END AS ref, CASE WHEN k%3=0 THEN 'held' WHEN k%7=0 THEN 'maybe' ELSE 'rejected' END AS decision FROM o), n AS (SELECT *, count(*) OVER (PARTITION BY k%997, ref) AS n FROM r),
        p AS (SELECT k, CASE WHEN decision='maybe' THEN 'unknown decision' WHEN decision='held' AND ref IS NULL THEN 'held without a ref' WHEN k%11=0 THEN 'no reason' WHEN k%13=0 THEN 'no date' WHEN n>1 THEN 'decided twice' END AS problem FROM n) SELECT k AS o_orderkey, problem FROM p WHERE problem IS NOT NULL""",
    "pairs_not_allowed": "SELECT o_orderkey FROM orders WHERE (o_orderstatus, o_orderpriority) NOT IN (SELECT (o_orderstatus, o_orderpriority) FROM orders WHERE o_orderkey%2=0 AND o_orderpriority<>'5-LOW')",
    "lists_compared": """WITH g AS (SELECT l_orderkey, coalesce(list(DISTINCT l_suppkey%9) FILTER (l_linenumber%2=0), []) AS a, coalesce(list(DISTINCT l_suppkey%9) FILTER (l_linenumber%3=0), []) AS b FROM lineitem GROUP BY 1)
        SELECT l_orderkey, array_to_string(list_sort(list_filter(a, lambda x: NOT list_contains(b, x))), ',') AS stray, array_to_string(list_sort(list_filter(b, lambda x: NOT list_contains(a, x))), ',') AS absent FROM g""",
    "why_statuses": f"""WITH {_O}, s AS (SELECT k, day, k%5>0 AS c, k%3>0 AS has_on, k%7=0 AS nc, k%4>0 AS src, k%9=0 AS note FROM o)
        SELECT k AS o_orderkey, CAST((NOT c AND has_on)::INT + (NOT c AND nc)::INT + (c AND (NOT has_on OR day > {_D}))::INT + (c AND (nc AND src OR NOT nc AND NOT src))::INT AS INTEGER) AS errors, CAST((c AND note)::INT AS INTEGER) AS warnings FROM s""",
    "long_quotes": r"SELECT doc_id FROM documents WHERE len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) > 400",
    "crowded_pages": "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 12",
    "sale_notices": f"WITH {_O} SELECT o_orderkey, CAST(date_diff('day', day, {_D}) AS INTEGER) AS days_past FROM o WHERE date_diff('day', day, {_D}) > 700",
    "link_lines": """WITH r AS (SELECT o_orderkey AS k, o_orderkey%501 AS b, o_orderkey%3=0 AS e, o_orderkey%3=1 OR o_orderkey%15=0 AS h, o_orderkey%3=1 AS o, o_orderkey%2 AS leg, CASE WHEN o_orderkey%3=1 THEN o_orderkey%4 ELSE 9 END AS host FROM orders),
        w AS (SELECT *, count(*) FILTER (e) OVER (PARTITION BY b) AS ne, count(*) FILTER (h) OVER (PARTITION BY b, leg) AS nh FROM r)
        SELECT k AS o_orderkey, 'both kinds of cell' AS problem FROM w WHERE e AND (h OR o) UNION ALL SELECT k, 'neither kind of cell' FROM w WHERE NOT e AND NOT h UNION ALL SELECT k, 'several events' FROM w WHERE e AND ne>1
        UNION ALL SELECT k, 'several hosts for a leg' FROM w WHERE h AND nh>1 UNION ALL SELECT k, 'host among the others' FROM w WHERE h AND o AND host IN (1,2) UNION ALL SELECT k, 'unknown event' FROM w WHERE e AND k%50 NOT IN (SELECT n_nationkey FROM nation)""",
    "network_first": "SELECT n_nationkey, n_name, 0 AS age_s, true AS from_network FROM nation UNION ALL SELECT n_nationkey, n_name, 60 + n_nationkey, false FROM nation",
}
