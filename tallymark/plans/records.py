"""Queries on keyed records: aggregation, reconciliation, validation, dates, change tracking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.geo import valid_formation
from ..operators import quality as Q
from ..operators import ranking as W
from ..operators import reconcile as R
from ..operators import resolve as J
from ..operators import sets as U
from ..operators import summary as A
from ..publish import kept_last_good
from ..storage import shared_path
from ..streaming.flows import sessions, tumbling
from .places import read

AS_OF = "1998-06-30"


def _as_of() -> Column:
    return F.lit(AS_OF).cast("date")


def _orders(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "orders").withColumn("day", F.col("o_orderdate").cast("date"))


def fold_first_wins(spark: SparkSession, d: str) -> DataFrame:
    o = _orders(spark, d).withColumn("status", F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderstatus")))
    out = A.folded(o, "o_custkey", "o_orderkey", ["status"], ["o_orderpriority"], ["o_orderstatus"])
    return out.select("o_custkey", "status", "o_orderpriority", F.array_join("o_orderstatus", ",").alias("seen"))


def first_order(spark: SparkSession, d: str) -> DataFrame:
    return W.first_of_each(_orders(spark, d), "o_custkey", ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


def min_tier_ambiguous(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "part").withColumn("bucket", F.floor(F.col("p_size") / 10))
    return A.least_with_flag(p, "p_name", "bucket")


def distinct_places(spark: SparkSession, d: str) -> DataFrame:
    li = read(spark, d, "lineitem").select("l_partkey", "l_suppkey", F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("label"))
    return A.distinct_places(li, "l_partkey", "l_suppkey", "label").select("l_partkey", "places", "several")


def mode_with_ties(spark: SparkSession, d: str) -> DataFrame:
    return A.modes(read(spark, d, "events"), "user_id", "event_type", "event_id")


def match_sides(spark: SparkSession, d: str) -> DataFrame:
    li = read(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"), "l_partkey", "l_suppkey")
    # dealt as the sides are, so the rows move once
    m = li.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "ord").groupBy("ord").agg(F.min("l_partkey").alias("home"), F.max("l_suppkey").alias("away"))
    m = m.withColumn("hn", F.concat(F.lit("h"), F.col("ord").cast("string"))).withColumn("an", F.concat(F.lit("a"), F.col("ord").cast("string")))
    return A.sides(m, "ord", ["home", "hn"], ["away", "an"], ["team", "name"]).where("team >= 100")


def fixture_counters(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events")
    return A.counters(e, ["event_type"], paid=F.col("value") > 50, small=F.col("value") < 5, no_user=F.col("user_id").isNull())


def members_by_type(spark: SparkSession, d: str) -> DataFrame:
    return A.distinct_members(read(spark, d, "events"), "event_type", "user_id")


def _figures(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    s = read(spark, d, "supplier").withColumn("a", F.when(k % 9 > 0, F.round(F.col("s_acctbal").cast("double") + 1000, 2)))
    return s.withColumn("b", F.when(k % 7 > 0, F.when(k % 3 == 0, F.col("s_acctbal") + 1100).otherwise(F.col("s_acctbal") + 1010)))


def verdict_two_source(spark: SparkSession, d: str) -> DataFrame:
    return _figures(spark, d).select("s_suppkey", R.two_source_verdict("a", "b", F.col("s_suppkey") % 11 > 0).alias("verdict"))


def verdict_tally(spark: SparkSession, d: str) -> DataFrame:
    v = _figures(spark, d).withColumn("verdict", R.two_source_verdict("a", "b"))
    return A.tally(v, "s_nationkey", "verdict", ["agree", "differ", "only-a", "only-b", "neither"])


def largest_gaps(spark: SparkSession, d: str) -> DataFrame:
    return W.largest_gaps(_figures(spark, d), "a", "b", "s_suppkey").select("s_suppkey", F.round("gap", 2).alias("gap"))


def majority_capacity(spark: SparkSession, d: str) -> DataFrame:
    k, n = F.col("p_partkey"), F.col("p_partkey") % 50 * 100 + 5000
    p = read(spark, d, "part").select("p_partkey", F.when(k % 2 == 0, n).alias("t"), F.when(k % 3 > 0, n + k % 5 * 100).alias("w"), F.when(k % 5 > 1, n + k % 7 * 60).alias("o"), F.when(k % 4 > 1, n - k % 6 * 70).alias("s"))
    m = R.majority({"table": "t", "stadiumdb": "s", "wikidata": "w", "osm": "o"}, {"table": "encyclopedia", "stadiumdb": "stadiumdb", "wikidata": "encyclopedia", "osm": "osm"})
    return p.withColumn("m", m).select("p_partkey", F.col("m")["verdict"].alias("verdict"), F.col("m")["proposed"].cast("long").alias("proposed"), F.col("m")["taken_from"].alias("taken_from"))


def three_sources(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    s = _figures(spark, d).withColumn("c", F.when(k % 4 > 0, F.col("s_acctbal") + 1005)).withColumn("n", F.when(k % 13 == 0, 2).when(k % 17 == 0, 0).otherwise(1)).withColumn("same", F.when(k % 5 == 0, F.lit(None)).otherwise(k % 6 > 0))
    return s.select("s_suppkey", R.three_source_verdict("a", "b", "c", "n", F.col("same")).alias("verdict"))


def overlay_sparse(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("tier"), F.col("c_mktsegment").alias("venue"))
    k = F.col("c_custkey")
    h = read(spark, d, "customer").where(k % 10 == 0).select(
        F.when(k % 50 > 0, k.cast("string")).alias("id"), F.when(k % 100 == 0, F.col("c_name")).when(k % 50 == 0, F.concat(F.lit("New "), F.col("c_name"))).otherwise("").alias("name"), F.when(k % 40 == 0, "skip").when(k % 20 == 0, "7").when(k % 50 == 0, "3").otherwise(" ").alias("tier"), F.when(k % 30 == 0, "<clear>").otherwise("").alias("venue")
    )
    rows, _ = R.overlay(c, h, "id", ["name", "tier", "venue"], ["venue"], "tier", ["name", "tier"], "name")
    return rows.select(F.when(F.col("id").startswith("hand:"), F.lit("hand")).otherwise(F.col("id")).alias("id"), "name", "tier", "venue")


def hand_links(spark: SparkSession, d: str) -> DataFrame:
    li = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("team"), (F.col("l_linenumber") % 2).alias("source"), (F.col("l_partkey") % 500).alias("club")).distinct()
    links, _ = R.unambiguous_links(li, "team", "source", "club")
    hand = read(spark, d, "orders").where("o_orderkey % 20 = 0").select(F.col("o_orderkey").alias("team"), F.lit(0).alias("source"), (F.col("o_custkey") % 500).alias("club"), F.when(F.col("o_orderkey") % 40 == 0, "link").otherwise("reject").alias("action"))
    return R.hand_links(links, hand, "team", "source", "club")


def ambiguous_links(spark: SparkSession, d: str) -> DataFrame:
    li = read(spark, d, "lineitem").select("l_orderkey", "l_returnflag", "l_suppkey").distinct()
    _, reviews = R.unambiguous_links(li, "l_orderkey", "l_returnflag", "l_suppkey")
    return reviews


def scoped_pick(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"), (F.col("c_custkey") % 4).alias("part"))
    s = read(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"), (F.col("s_suppkey") % 4).alias("part"))
    return J.disambiguated_alike(c, s, ["nation", "part"], F.col("s_suppkey") % 3 == 0).select("c_custkey", "s_suppkey", "verdict")


def roster_cascade(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    ours = read(spark, d, "customer").where(k % 6 > 0).select(k.alias("item"), (k % 3).alias("tier"), F.when(k % 8 > 0, 1.0).alias("lat"))
    roster = read(spark, d, "customer").where(k % 5 > 0).select(F.when(k % 11 > 0, k).alias("item"), F.when(k % 7 == 0, (k + 1) % 3).otherwise(k % 3).alias("tier"))
    removed = read(spark, d, "customer").where(k % 13 == 0).select(k.alias("item"))
    return R.roster_check(roster, ours, removed, "item", "tier", "lat")


def change_tracking(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders").withColumn("uid", F.col("o_orderkey").cast("string"))
    h = F.substring(F.sha2(F.concat_ws("|", "o_orderstatus", "o_orderpriority"), 256), 1, 16)
    state = o.where("o_orderkey % 5 > 0").select("uid", F.when(F.col("o_orderkey") % 4 == 0, "old").otherwise(h).alias("hash"), F.lit("19980101").alias("dtstamp"), (F.col("o_orderkey") % 3).cast("int").alias("sequence"))
    return R.tracked(o.where("o_orderkey % 6 > 0").select("uid", h.alias("hash")), state, "uid", F.lit("19980630"))


def change_states(spark: SparkSession, d: str) -> DataFrame:
    """change_tracking as a stream of files in three batches or four, the last snapshot as its initial state, state by key in RocksDB."""
    from ..streaming import flows

    o = read(spark, d, "orders").withColumn("uid", F.col("o_orderkey").cast("string"))
    h = F.substring(F.sha2(F.concat_ws("|", "o_orderstatus", "o_orderpriority"), 256), 1, 16)
    at = lambda t: F.lit(t).cast("timestamp")
    snapshot = o.where("o_orderkey % 5 > 0").select("uid", F.when(F.col("o_orderkey") % 4 == 0, "old").otherwise(h).alias("hash"), F.lit("19980101").alias("dtstamp"), (F.col("o_orderkey") % 3).cast("int").alias("sequence"), at("1998-06-29 12:00:00").alias("at"))
    now = o.where("o_orderkey % 6 > 0").select("uid", h.alias("hash"), F.lit("19980630").alias("dtstamp"), at("1998-06-30 00:00:00").alias("at"))
    path = shared_path(spark, "readings")
    end = spark.range(1).select(F.lit(None).cast("string").alias("uid"), F.lit(None).cast("string").alias("hash"), F.lit(None).cast("string").alias("dtstamp"), at("1998-06-30 11:00:00").alias("at"))
    for rows in (now.where("cast(uid as long) % 2 = 0"), now.where("cast(uid as long) % 2 = 1"), end):
        rows.write.mode("append").parquet(path)
    files = len(spark.read.parquet(path).inputFiles())
    with flows.state_store(spark):
        stream = spark.readStream.schema(flows.READ).option("maxFilesPerTrigger", -(-files // 3)).parquet(path)
        out = flows.change_stream(stream, snapshot, "12 hours", "30 minutes", buckets=max(16, o.count() // 2000))
        sink = shared_path(spark, "changes")
        out.writeStream.format("parquet").option("path", sink).option("checkpointLocation", shared_path(spark, "changes-log")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(flows.CHANGE).parquet(sink)


def quarantine_orders(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    o = _orders(spark, d).select(F.when(k % 101 == 0, k - 1).otherwise(k).alias("key"), F.when(k % 17 == 0, " ").otherwise(F.col("o_orderstatus")).alias("status"), F.when(k % 23 == 0, "9-NONE").otherwise(F.col("o_orderpriority")).alias("priority"), "o_totalprice")
    spec = Q.TableSpec(required=["key", "status"], optional=["priority", "o_totalprice"], key=["key"], closed={"priority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]}, rules={"price out of range": ~F.col("o_totalprice").between(1000, 490000)})
    _, bad = Q.checked(o, spec)
    return bad.select("key", "status", "priority", F.array_join("reasons", "; ").alias("reasons"))


def ref_integrity(spark: SparkSession, d: str) -> DataFrame:
    li = read(spark, d, "lineitem").select("l_orderkey", F.array((F.col("l_suppkey") * 2).cast("string"), F.col("l_suppkey").cast("string")).alias("refs"))
    dim = read(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("id"))
    return Q.dangling(li, F.col("refs"), dim, "id", "l_orderkey").distinct()


def unused_dim(spark: SparkSession, d: str) -> DataFrame:
    used = read(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return J.missing(read(spark, d, "customer"), used, ["c_custkey"]).select("c_custkey")


def used_dim(spark: SparkSession, d: str) -> DataFrame:
    used = read(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return J.present(read(spark, d, "customer"), used, ["c_custkey"]).select("c_custkey")


def _edges(spark: SparkSession, d: str, a: int, b: int) -> DataFrame:
    n = read(spark, d, "nation")
    return n.select(F.col("n_nationkey").alias("x"), F.when(F.col("n_nationkey") % 6 > 0, (F.col("n_nationkey") * a + b) % 25).alias("y"), F.col("n_name").alias("name"), (F.col("n_nationkey") % 3).alias("rank"), (F.col("n_nationkey") % 4 == 0).alias("ended"))


def edge_conflict(spark: SparkSession, d: str) -> DataFrame:
    return Q.conflicts(_edges(spark, d, 7, 3), _edges(spark, d, 18, 4), "x", "y", "ended")


def parent_of_parent(spark: SparkSession, d: str) -> DataFrame:
    return Q.parent_problems(_edges(spark, d, 7, 0).where("y is not null and x % 2 = 1"), "x", "y")


def mirrored_edges(spark: SparkSession, d: str) -> DataFrame:
    return J.mirrored(_edges(spark, d, 7, 3).drop("ended"), "x", "y", "name", "rank").select("x", "y", "rank", "mirrored", "position")


def edges_both_ways(spark: SparkSession, d: str) -> DataFrame:
    return J.both_ways(_edges(spark, d, 7, 3).select("x", "y"), "x", "y").where("x is not null and y is not null")


def next_meeting(spark: SparkSession, d: str) -> DataFrame:
    m = _orders(spark, d).select((F.col("o_custkey") % 25).alias("home"), (F.col("o_orderkey") % 24).alias("away"), "day")
    pairs = _edges(spark, d, 7, 3).where("y is not null").select(F.col("x").cast("long"), F.col("y").cast("long"))
    return J.next_meeting(pairs, m, "x", "y", "home", "away", "day", _as_of())


def date_precision(spark: SparkSession, d: str) -> DataFrame:
    o = _orders(spark, d)
    return o.select("o_orderkey", D.shown_precision("day", F.date_add("day", (F.col("o_orderkey") % 40).cast("int")), F.col("o_orderkey") % 2 == 0).alias("shown"))


def explode_days(spark: SparkSession, d: str) -> DataFrame:
    o = _orders(spark, d)
    return o.select("o_orderkey", F.explode(D.days_of("day", F.date_add("day", (F.col("o_orderkey") % 6).cast("int")))).alias("on")).groupBy("on").agg(F.count("*").alias("n"))


def recurrence_next(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    o = _orders(spark, d).select("o_orderkey", F.when(k % 9 == 0, None).when(k % 7 == 0, "disputed").when(k % 5 == 0, "guess").otherwise("confirmed").alias("src"), F.when(k % 4 == 0, "annual").when(k % 11 == 0, "per fixture").alias("rec"), F.col("day").cast("string").alias("d1"), F.when(k % 8 > 0, F.concat_ws("/", F.date_add("day", 365).cast("string"), F.date_add("day", 368).cast("string"))).alias("d2"))
    return D.with_next_occurrence(o, "n", "src", "rec", "d1", F.lit(None).cast("string"), "d2", _as_of()).select("o_orderkey", F.col("n")["start"].alias("start"), F.col("n")["end"].alias("end"), F.col("n")["reason"].alias("reason"))


def aged_rows(spark: SparkSession, d: str) -> DataFrame:
    o = _orders(spark, d)
    note = F.concat(F.when(F.col("o_orderkey") % 3 == 0, "Bestand 01.01.2031, Stand:").when(F.col("o_orderkey") % 3 == 1, "as of 1 Jan 2031, g\u00fcltig ab ").otherwise("gultig ab: "), F.when(F.col("o_orderkey") % 2 == 0, F.date_format("day", "dd.MM.yyyy")).otherwise(F.date_format("day", "MMM yyyy")))
    out = Q.aged_rows(o.withColumn("note", note).withColumn("refs", F.array((F.col("o_custkey") % 7).cast("string"))), F.col("refs"), spark.createDataFrame([("1", "14.10.1997; read 6 Nov 1999"), ("2", "undated, read 1 Jan 1994")], "id string, published string"), "id", "published", "o_orderkey", "note", _as_of())
    return out


def stale_orders(spark: SparkSession, d: str) -> DataFrame:
    o = _orders(spark, d)
    return o.groupBy("o_orderpriority").agg(F.count_if(D.in_past("day", _as_of())).alias("past"), F.count_if(D.in_future("day", _as_of())).alias("future"), F.count_if(D.stale("day", _as_of(), 365)).alias("stale"))


def month_ends(spark: SparkSession, d: str) -> DataFrame:
    o = _orders(spark, d).withColumn("m", F.when(F.col("o_orderkey") % 3 == 0, F.date_format("day", "yyyy")).when(F.col("o_orderkey") % 3 == 1, F.date_format("day", "yyyy-MM")).otherwise(F.col("day").cast("string")))
    return o.groupBy(D.month_end("m").alias("on")).agg(F.count("*").alias("n"))


def year_before(spark: SparkSession, d: str) -> DataFrame:
    return _orders(spark, d).select("o_orderkey", D.year_before("day").alias("before"), D.exclusive_end("day").alias("after"), D.alarm_day("day", F.lit(3)).alias("alarm"))


def holiday_overlaps(spark: SparkSession, d: str) -> DataFrame:
    o = _orders(spark, d).select("o_orderkey", F.col("day").cast("string").alias("s"), F.date_add("day", (F.col("o_orderkey") % 9 - 1).cast("int")).cast("string").alias("e"))
    return Q.interval_problems(o, "s", "e", "o_orderkey")[2]


def holiday_totals(spark: SparkSession, d: str) -> DataFrame:
    """Overlapping spans of one customer or one priority, counted without pairs."""
    o = _orders(spark, d).select("o_custkey", "o_orderpriority", "day", F.date_add("day", (F.col("o_orderkey") % 90 - 1).cast("int")).alias("e"))
    one = Q.overlap_totals(o, "day", "e", ["o_custkey"]).select(F.col("o_custkey").cast("string").alias("scope"), "rows", "overlaps")
    return one.unionByName(Q.overlap_totals(o, "day", "e", ["o_orderpriority"]).select(F.col("o_orderpriority").alias("scope"), "rows", "overlaps"))


def holidays_by_scope(spark: SparkSession, d: str) -> DataFrame:
    """Overlapping spans of one customer, pair by pair."""
    o = _orders(spark, d).select("o_orderkey", "o_custkey", F.col("day").cast("string").alias("s"), F.date_add("day", (F.col("o_orderkey") % 90 - 1).cast("int")).cast("string").alias("e"))
    return Q.interval_problems(o, "s", "e", "o_orderkey", ["o_custkey"])[2]


def local_to_utc(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").withColumn("t", F.col("ts").cast("timestamp")).withColumn("z", F.when(F.col("user_id") % 3 == 0, "Europe/Bucharest")).withColumn("c", F.when(F.col("user_id") % 3 == 1, "GB"))
    u = D.to_utc("t", "z", "c")
    return e.withColumn("u", u).select("event_id", F.col("u")["utc"].cast("timestamp_ntz").alias("utc"), F.col("u")["guessed"].alias("guessed"))


def _matches(spark: SparkSession, d: str) -> DataFrame:
    v = F.floor(F.col("value")).cast("long")
    e = read(spark, d, "events")
    return e.select("event_id", "user_id", "event_type", (v % 5).alias("home"), (v % 4).alias("away"), (F.col("event_id") % 10 == 0).alias("exhibition"), (v * 100).alias("crowd"), (F.col("event_id") % 3 > 0).alias("complete"), (v % 3).alias("cards"), F.when(F.col("event_id") % 4 == 0, "home").when(F.col("event_id") % 4 == 1, "away").when(F.col("event_id") % 4 == 2, "neutral").alias("side"))


def attended_stats(spark: SparkSession, d: str) -> DataFrame:
    return A.attended(_matches(spark, d), "home", "away", "exhibition", "crowd", ["user_id", "event_type"], "complete", "cards")


def win_draw_loss(spark: SparkSession, d: str) -> DataFrame:
    return A.record(_matches(spark, d), ["event_type"], "side", "home", "away")


def biggest_crowds(spark: SparkSession, d: str) -> DataFrame:
    return A.maxima(_matches(spark, d), ["event_type"], "home", ["event_id"]).select("event_type", "event_id", "place", "more")


def renewals(spark: SparkSession, d: str) -> DataFrame:
    return W.renewals(_orders(spark, d).where("day >= '1998-06-01'"), "day", "o_orderkey", _as_of(), 20).select("o_orderkey", "days", "status")


def shortlist(spark: SparkSession, d: str) -> DataFrame:
    li = read(spark, d, "lineitem").withColumn("level", F.floor(F.col("l_quantity") / 20))
    return W.shortlist(li, "l_orderkey", "level", F.col("l_returnflag") == "R").select("l_orderkey", "l_linenumber", "l_partkey", "level", "verdict")


def best_choices(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "part").withColumn("rank", F.col("p_size") % 4).withColumn("lat", F.when(F.col("p_partkey") % 3 > 0, F.col("p_retailprice")))
    out = W.best_choice(p.select("p_brand", "rank", "lat", "p_partkey", "p_type"), "p_brand", "rank", "lat", "p_partkey", "p_type")
    return out.select("p_brand", "p_partkey", "rank", F.array_join("kinds", ",").alias("kinds"))


def latest_rows(spark: SparkSession, d: str) -> DataFrame:
    return W.latest(_orders(spark, d).select("o_custkey", "o_totalprice", "o_orderkey"), "o_custkey", "o_totalprice").select("o_custkey", "o_orderkey")


def sources_united(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"))
    s = read(spark, d, "supplier").select(F.col("s_nationkey").alias("nation"))
    return U.union_of({"customer": c, "supplier": s}).groupBy("source", "nation").agg(F.count("*").alias("n"), F.count("balance").alias("with_balance"))


def rows_compared(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders")
    a = o.where("o_orderkey % 3 > 0").select("o_custkey", "o_orderpriority")
    b = o.where("o_orderkey % 5 > 0").select("o_custkey", "o_orderpriority")
    return U.compared(a, b).groupBy("side").agg(F.count("*").alias("n"))


def rows_common(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders")
    return U.common(o.where("o_orderkey % 2 = 0").select("o_custkey", "o_orderpriority"), o.where("o_orderkey % 2 = 1").select("o_custkey", "o_orderpriority"))


def labels_filled(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "part").select("p_partkey", "p_brand", "p_size", F.when(F.col("p_partkey") % 2 == 0, F.col("p_type")).alias("label"))
    return R.filled_labels(p, "label", "p_brand", "p_size").select("p_partkey", "label")


def divisions(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    side = lambda x: F.struct((x % 3).alias("country"), F.when(x % 5 > 0, x % 2).alias("tier"), F.when(x % 4 > 0, x % 2).alias("group"))
    c = read(spark, d, "customer").withColumn("s", R.same_division(side(k), side(k + 6)))
    return c.select("c_custkey", F.col("s")["same"].alias("same"), F.col("s")["reason"].alias("reason"))


def shared_targets(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "part").select(F.col("p_partkey").cast("string").alias("row"), F.concat_ws("|", "p_brand", "p_size").alias("target"))
    return A.shared_target(p, "row", "target").select("row", "first", "others").where("others > 0")


def pair_sanity(spark: SparkSession, d: str) -> DataFrame:
    e = _edges(spark, d, 24, 0).withColumn("off", F.when(F.col("x") % 12 == 0, "Abroad")).withColumn("kind", F.when(F.col("x") % 5 == 0, "odd").otherwise("derby"))
    return Q.pair_problems(e, "x", "y", "kind", ["derby"], "off", "name")


def price_rules(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    p = read(spark, d, "part").select("p_partkey", F.when(k % 6 == 0, "0").otherwise(F.concat((k % 90 + 1).cast("string"), F.lit(",50"))).alias("low"), (k % 80).cast("string").alias("high"), F.when(k % 5 == 0, "2026").otherwise("2026-27").alias("season"), F.when(k % 4 == 0, "eur").otherwise("EUR").alias("cur"), F.lit("DE").alias("cty"), (k % 3).cast("string").alias("phase"))
    return p.select("p_partkey", F.size(Q.price_problems("low", "high", "season", "cur", "cty", "phase")).alias("problems")).where("problems > 0")


def formations(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_size")
    p = read(spark, d, "part").select("p_partkey", F.concat_ws("-", (k % 5).cast("string"), (k % 4).cast("string"), (k % 6).cast("string")).alias("f"))
    return p.where(valid_formation("f"))


def snapshot_kept(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders").groupBy((F.col("o_custkey") % 40).alias("part")).agg(F.count("*").alias("n"))
    failed = spark.range(0, 40, 7).withColumnRenamed("id", "part")
    return kept_last_good(o.where("part % 7 > 0"), failed, o.withColumn("n", -F.col("n")), "part")


def gated_rows(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    _, held = R.gated(c, [("balance", lambda x: x.where("c_acctbal > 1000")), ("nation", lambda x: x.where("c_nationkey < 20"))], True)
    return held.select("c_custkey", "gate")


def coverage_cube(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders")
    return o.cube("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"), F.grouping_id().cast("long").alias("level"))


def moving_frame(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy("o_custkey").orderBy("o_orderkey").rowsBetween(-2, 0)
    return read(spark, d, "orders").select("o_orderkey", F.round(F.sum("o_totalprice").over(w), 2).alias("moving"))


def events_tumbling(spark: SparkSession, d: str) -> DataFrame:
    out = tumbling(read(spark, d, "events"), "ts", "1 hour", "10 minutes", ["event_type"], F.count("*").alias("n"))
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n")


def user_sessions(spark: SparkSession, d: str) -> DataFrame:
    out = sessions(read(spark, d, "events"), "ts", "30 minutes", "10 minutes", "user_id")
    return out.select("user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"), F.col("session_end").cast("timestamp_ntz").alias("session_end"), "events")


QUERIES = {k: f for k, f in list(globals().items()) if callable(f) and getattr(f, "__module__", "") == __name__ and not k.startswith("_")}
