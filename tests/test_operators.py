import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallymark.operators import quality as Q
from tallymark.operators import ranking as W
from tallymark.operators import reconcile as R
from tallymark.operators import resolve as J
from tallymark.operators import summary as A

SRC = ["https://en.wikipedia.org/wiki/Ruhr"]

WHY = [
    ("checked", "2026-11-15", None, SRC, None, 0, 0),
    ("checked", "2026-11-14", "no factual claim", None, None, 0, 0),
    ("unverified", None, None, SRC, None, 0, 0),
    (None, None, None, None, None, 0, 0),
    ("checked", None, None, SRC, None, 1, 0),
    ("checked", "2026-11-15", None, None, None, 1, 0),
    ("checked", "2026-11-15", None, [], None, 1, 0),
    ("checked", "2026-11-16", None, SRC, None, 1, 0),
    ("checked", "15.11.2026", None, SRC, None, 1, 0),
    ("checked", "2026-02-30", None, SRC, None, 1, 0),
    ("checked", "2026-11-15", "opinion", None, None, 2, 0),
    ("checked", "2026-11-15", "no factual claim", SRC, None, 1, 0),
    ("verified", None, None, None, None, 1, 0),
    ("unverified", "2026-11-15", None, None, None, 1, 0),
    ("checked", "2026-11-15", None, ["Wikipedia"], None, 1, 0),
    ("checked", "2026-11-15", None, SRC, "x", 0, 1),
]


def test_why_status_golden_vectors(spark):
    df = spark.createDataFrame([(i, *w[:5]) for i, w in enumerate(WHY)], "i int, st string, on string, ba string, src array<string>, note string")
    got = df.withColumn("w", Q.why_status("st", "on", "ba", "src", "note", F.lit("2026-11-15").cast("date"))).orderBy("i").collect()
    assert [(len(r["w"]["errors"]), len(r["w"]["warnings"])) for r in got] == [w[5:] for w in WHY]


def test_majority_golden_vectors(spark):
    rows = [(5000, 5600, None, 5000), (7000, 7000, None, None), (None, 12000, 12400, None), (10000, 8000, 5000, 20000), (None, None, None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, t int, w int, o int, s int")
    m = R.majority({"table": "t", "stadiumdb": "s", "wikidata": "w", "osm": "o"}, {"table": "encyclopedia", "stadiumdb": "stadiumdb", "wikidata": "encyclopedia", "osm": "osm"})
    got = [(r["m"]["verdict"], r["m"]["proposed"], r["m"]["taken_from"]) for r in df.withColumn("m", m).orderBy("i").collect()]
    assert got == [("agreed", 5000, "table"), ("single-source", None, None), ("agreed", 12000, "wikidata"), ("contested", None, None), ("none", None, None)]


def test_aged_rows_golden_vectors(spark):
    sources = [("S11", "Stand: 14.12.2025"), ("S13", "Stand 14.10.2025"), ("MON", "Stand: Dezember 2025"), ("UND", "current (read 7 Oct 2026)"), ("NEW", "18.10.2026; read 6 Nov 2026"), ("OLDREAD", "undated, read 1 Jan 2024"), ("KOE", '"Die Stadionordnung gilt ab dem 19.11.2025", read')]
    rows = [(2, ["S11"], ""), (3, ["S13"], ""), (5, ["S13", "NEW"], ""), (6, ["UND"], ""), (7, ["OLDREAD"], ""), (8, ["MON"], ""), (9, ["UND"], "terms (Stand 1 Feb 2023) as quoted"), (10, ["KOE"], "")]
    a, b = spark.createDataFrame(rows, "line int, refs array<string>, note string"), spark.createDataFrame(sources, "id string, published string")
    for day, lines in (("2026-11-14", [3, 9]), ("2026-11-19", [3, 9]), ("2026-11-20", [3, 9, 10]), ("2026-12-31", [2, 3, 9, 10]), ("2027-01-01", [2, 3, 8, 9, 10])):
        got = Q.aged_rows(a, F.col("refs"), b, "id", "published", "line", "note", F.lit(day).cast("date"))
        assert sorted(r["line"] for r in got.collect()) == lines


def test_renewals_golden_vector(spark):
    clock = dt.date(2026, 10, 4)
    df = spark.createDataFrame([("a", clock + dt.timedelta(16)), ("b", clock - dt.timedelta(4)), ("c", clock + dt.timedelta(90))], "id string, due date")
    got = W.renewals(df, "due", "id", F.lit(clock)).collect()
    assert [(r["id"], r["days"], r["status"]) for r in got] == [("b", -4, "overdue"), ("a", 16, "due")]


def test_ground_agreement_has_three_values(spark):
    rows = [("bbbank wildpark", "wildparkstadion"), ("grenzlandstadion", "grenzland stadion"), ("stadionul municipal", "arena nord"), ("volkspark", "millerntor"), ("", "x")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string")
    got = [r["g"] for r in df.withColumn("g", J.ground_agrees(F.col("a"), F.col("b"), ["stadionul", "municipal", "arena", "stadion"])).orderBy("i").collect()]
    assert got == [False, True, None, False, None]


def test_name_strength(spark):
    rows = [(["benfica", "campus"], ["benfica", "stadium"], ["benfica"], None), (["a", "b"], ["b", "a"], [], "exact"), (["ab"], ["a", "b"], [], "exact"), (["x"], ["x", "y"], [], "contained"), ([], ["x"], [], None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a array<string>, b array<string>, own array<string>, want string")
    for r in df.withColumn("s", J.name_strength(F.col("a"), F.col("b"), F.col("own"))).collect():
        assert r["s"] == r["want"]


def test_distance_join_equals_brute_force(spark):
    from tallymark.functions.geo import haversine

    left = spark.range(60).select(F.col("id").alias("a"), (F.rand(1) * 180 - 90).alias("la"), (F.rand(2) * 360 - 180).alias("oa"))
    right = spark.range(900).select(F.col("id").alias("b"), (F.rand(3) * 180 - 90).alias("lb"), (F.rand(4) * 360 - 180).alias("ob"))
    left, right = left.cache(), right.cache()
    near = J.distance_join(left, right, 600_000, ("la", "oa"), ("lb", "ob")).select("a", "b")
    all_pairs = left.crossJoin(right).where(haversine("la", "oa", "lb", "ob") <= 600_000).select("a", "b")
    assert sorted(map(tuple, near.collect())) == sorted(map(tuple, all_pairs.collect())) != []


def test_collapse_walks_in_order(spark):
    rows = [("k", "r1", 50.0, 8.0, 2, 1), ("k", "r2", 50.001, 8.0, 1, 2), ("k", "r3", 51.0, 8.0, 3, 3), ("k", "r1", 60.0, 8.0, 0, 4)]
    df = spark.createDataFrame(rows, "k string, ref string, lat double, lon double, s int, o int")
    got = W.collapsed(df, "k", "ref", "lat", "lon", "s", "o").orderBy("o").collect()
    assert [(r["ref"], r["s"]) for r in got] == [("r1", 0), ("r3", 3)]


def test_agreement_groups(spark):
    df = spark.createDataFrame([(True, True, True, True, False)], "a boolean, b boolean, c boolean, ab boolean, bc boolean")
    have = {x: F.col(x) for x in "abc"}
    g = R.agreement_groups({("a", "b"): F.col("ab"), ("b", "c"): F.col("bc")}, have, "a")
    r = df.select(g.alias("g")).first()["g"]
    assert r["with_lead"] == ["a", "b"] and r["largest_other"] == 1 and not r["odd"]
    r = df.select(R.agreement_groups({("b", "c"): F.lit(True)}, have, "a").alias("g")).first()["g"]
    assert r["odd"] and r["largest_other"] == 2


def test_hand_links_and_reviews(spark):
    p = spark.createDataFrame([("t1", "s", "c1"), ("t2", "s", "c2")], "team string, source string, club string")
    h = spark.createDataFrame([("t2", "s", "c1", "link"), ("t9", "s", "c9", "reject")], "team string, source string, club string, action string")
    assert sorted(map(tuple, R.hand_links(p, h, "team", "source", "club").collect())) == [("t2", "s", "c1", "hand")]
    d = spark.createDataFrame([("q", None, "held", "r", "2026-01-01"), ("q", "g", "held", "r", "2026-01-01"), ("z", None, "open", "", "x")], "k string, ref string, decision string, reason string, decided_on string")
    good, bad = R.review_decisions(d, "k", "ref")
    assert good.count() == 1 and {r["problem"] for r in bad.collect()} == {"held without a ref", "no reason"}


def test_gates_hold_everything_after_a_failed_source(spark):
    df = spark.range(5)
    up, held = R.gated(df, [("even", lambda x: x.where("id % 2 = 0"))], healthy=False)
    assert up.count() == 0 and {r["gate"] for r in held.collect()} == {"source"}


def test_validation_rejects_with_reasons(spark):
    df = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", " "), ("3", "zz")], "id string, kind string")
    good, bad = Q.checked(df, Q.TableSpec(required=["id", "kind"], key=["id"], closed={"kind": ["a", "b"]}))
    assert good.count() == 0 and bad.count() == 4
    with pytest.raises(ValueError, match="missing"):
        Q.checked(df, Q.TableSpec(required=["other"]))


def test_link_lines(spark):
    rows = [(1, "b1", "e1", "", "", ""), (2, "b1", "e2", "", "", ""), (3, "b2", "e9", "h", "", ""), (4, "b3", "", "h", "h;o", ""), (5, "b4", "", "", "", "")]
    df = spark.createDataFrame(rows, "row int, bucket string, event string, host string, others string, leg string")
    ev = spark.createDataFrame([("e1",), ("e2",)], "id string")
    got = sorted((r["row"], r["problem"]) for r in Q.link_problems(df, "bucket", "event", "host", "others", "leg", "row", ev, "id").collect())
    assert got == [(1, "several events"), (2, "several events"), (3, "both kinds of cell"), (3, "unknown event"), (4, "host among the others"), (5, "neither kind of cell")]


def test_redirects_and_routes(spark):
    red = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("d", "e")], "title string, target string")
    df = spark.createDataFrame([("a",), ("x",)], "t string")
    assert sorted(map(tuple, J.followed(df, red, "t").collect())) == [("a", "d"), ("x", "x")]
    direct = spark.createDataFrame([("b", "Q1"), ("x", "Q2")], "title string, id string")
    assert sorted((r["t"], r["id"], r["route"]) for r in J.two_hops(df, "t", direct, red).collect()) == [("a", "Q1", "redirect"), ("x", "Q2", "direct")]


def test_rules_of_a_group_exclude_each_other(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 50)], "k int, v int")
    rules = [R.Rule("small", F.col("v") < 10, F.col("v"), "size"), R.Rule("any", F.col("v").isNotNull(), None, "size"), R.Rule("odd", F.col("k") % 2 == 1)]
    assert sorted(map(tuple, R.by_rules(df, rules).collect()), key=str) == sorted([(1, 5, 0, "small", "5"), (1, 5, 2, "odd", None), (3, 50, 1, "any", None), (3, 50, 2, "odd", None)], key=str)


def test_roster_evidence_reads_each_once(spark):
    roster = spark.createDataFrame([("a", 2), ("a", 1), ("b", 1), ("c", 1)], "id string, tier int")
    infos = spark.createDataFrame([("a", 1, None, 2, False), ("t", 1, None, 3, False), ("b", None, None, 0, False), ("x", 4, None, 0, True)], "id string, tagged int, shape string, grounds int, dissolved boolean")
    twins = spark.createDataFrame([("b", "t")], "id string, twin string")
    got = sorted((r["id"], r["kind"], r["detail"]) for r in R.roster_evidence(roster, infos, twins).collect())
    assert got == [("a", "roster-ok", "tagged 1; in several tiers"), ("a", "two-grounds", "2"), ("b", "roster-ok", "tagged 1; via t"), ("b", "two-grounds", "3"), ("c", "roster-untagged", "no entity"), ("x", "extra-dissolved", None)]


def test_overlaps_keep_rows_off_the_driver(spark):
    df = spark.range(2000).select(F.col("id").alias("row"), F.lit("a").alias("who"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") * 5).cast("int")).alias("s"))
    for scope in ([], ["who"]):
        pairs = Q.overlapping(df.withColumn("e", F.date_add("s", 5)), "s", "e", "row", scope)
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
        assert pairs.count() == 1999


def test_sides_in_parts_of_a_set_number(spark):
    m = spark.range(300).select(F.col("id").alias("o"), (F.col("id") % 7).alias("h"), (F.col("id") % 5).cast("int").alias("a"), F.lit("x").alias("hn"), F.lit("y").alias("an"))
    got = A.sides(m, "o", ["h", "hn"], ["a", "an"], ["team", "name"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    # the matches are read once, and not in as few parts as their size asks for, as each part is sorted
    assert "Union" not in plan and "REPARTITION_BY_NUM" in plan
    last = {i: max([(o, "x") for o in range(300) if o % 7 == i] + [(o, "y") for o in range(300) if o % 5 == i])[1] for i in range(7)}
    tied = {o % 7 for o in range(295, 300) if o % 7 == o % 5}
    assert got.columns == ["team", "name"] and {r["team"]: r["name"] for r in got.collect() if r["team"] not in tied} == {k: v for k, v in last.items() if k not in tied}


def test_name_join_opens_classes_in_lists(spark):
    from tallymark.operators import pairs

    rows = spark.range(3000).select(F.col("id").alias("a"), F.concat(F.lit("red ring"), F.when(F.col("id") % 3 == 0, " small").when(F.col("id") % 3 == 1, " large").otherwise("")).alias("n"))
    other = rows.where("a < 40").union(spark.createDataFrame([(None, "red ring"), (90, None)], "a long, n string")).toDF("b", "m")
    got = J.name_join(rows, other, F.col("n"), F.col("m"), ["small", "large"], [])
    assert got.columns == ["a", "n", "b", "m"]
    pairs_of = lambda a: 14 + 13 + 1 if a % 3 == 0 else 13 + 13 + 1 if a % 3 == 1 else 41
    assert got.count() == sum(map(pairs_of, range(3000))) and got.where("b is null").count() == 3000 and got.distinct().count() == got.count()
    sizes = pairs.listed(rows.select(F.lit(None).cast("string").alias("k"), "a"), ["k"], F.col("a"), "l").select(F.size("l")).collect()
    assert len(sizes) == 3 and sum(r[0] for r in sizes) == 3000 and max(r[0] for r in sizes) < 1300


def compared(monkeypatch):
    """How many positions each call compares."""
    seen, real = [], J._near
    monkeypatch.setattr(J, "_near", lambda a, b, *rest: seen.append((a.count(), b.count())) or real(a, b, *rest))
    return seen


def test_nearest_compares_a_position_once(spark, monkeypatch):
    seen = compared(monkeypatch)
    at = lambda k, n: ((F.col("id") % n) * 0.001).cast("double").alias(k)
    left = spark.range(400).select(F.col("id").alias("a"), at("la", 3), F.lit(0.0).alias("oa")).union(spark.createDataFrame([(400, None, 0.0)], "a long, la double, oa double"))
    right = spark.range(500).select((499 - F.col("id")).alias("b"), at("lb", 2), F.lit(0.0).alias("ob"))
    got = J.nearest_within(left, right, 50, ("la", "oa"), ("lb", "ob"), "a", "b")
    assert {(r["a"] % 3, r["b"], round(r["metres"])) for r in got.where("a < 400").collect()} == {(0, 1, 0), (1, 0, 0), (2, None, 111)} and got.count() == 401
    assert seen == [(3, 2)]


def test_places_around_compare_a_position_once(spark, monkeypatch):
    from tallymark.sources import remote as N

    seen = compared(monkeypatch)
    centres = spark.range(2000).select(F.col("id").alias("c"), ((F.col("id") % 2) * 0.01).cast("double").alias("lat"), F.lit(0.0).alias("lon"))
    places = spark.createDataFrame([(1, 0.011, 0.0), (1, 0.0013, 0.0), (2, 0.011, 0.0), (3, 1.0, 0.0), (4, None, 0.0)], "p long, lat double, lon double")
    out = N.places_around(centres, places, 5_000, "c", "p")
    assert sorted((r["p"], r["c"], round(r["metres"])) for r in out.collect()) == [(1, 1, 111), (2, 1, 111)]
    assert out.columns == ["p", "metres", "c"] and seen == [(2, 4)]


def test_distance_join_compares_a_position_once(spark, monkeypatch):
    seen = compared(monkeypatch)
    left = spark.range(300).select(F.col("id").alias("a"), ((F.col("id") % 2) * 1.0).alias("la"), F.lit(0.0).alias("oa"))
    right = spark.createDataFrame([(1, 0.0, 0.001), (2, 0.0, 0.001), (3, None, 0.0), (3, 1.0, 0.0)], "b long, lb double, ob double")
    got = J.distance_join(left, right, 200, ("la", "oa"), ("lb", "ob")).groupBy("b", F.round("metres").alias("m")).count().collect()
    assert sorted(map(tuple, got)) == [(1, 111.0, 150), (2, 111.0, 150), (3, 0.0, 150)]
    assert seen[0][0] == 2


def test_candidates_of_classes_equal_candidates_of_rows(spark):
    rows = spark.range(300).select(F.col("id").alias("a"), F.when(F.col("id") % 7 > 0, F.col("id") % 7).alias("k"))
    others = spark.createDataFrame([(1, 1, True), (2, 2, True), (3, 2, False), (4, 3, None), (5, 3, False), (6, 4, True), (7, 4, True), (8, None, True)], "b long, k long, ok boolean")
    got = J.disambiguated_alike(rows, others, ["k"], F.col("ok"))
    want = J.disambiguated(rows.join(others, "k"), "a", F.col("ok"))
    columns = ["a", "b", "candidates", "agreeing", "verdict"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect())) != []
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()


def test_name_variants_are_spread(spark):
    from tallymark.plans import rules

    out = rules.name_variants(spark, "/root/testdata/sf0.001")
    assert out.select(F.spark_partition_id().alias("p")).distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_pairs_are_not_shuffled(spark):
    rows = spark.range(3000).select(F.col("id").alias("a"), F.lit("red ring").alias("n"))
    near = spark.range(300).select(F.col("id").alias("a"), F.lit(1.0).alias("la"), F.lit(1.0).alias("oa"))
    for got in (J.name_join(rows, rows.toDF("b", "m"), F.col("n"), F.col("m"), [], []), J.distance_join(near, near.toDF("b", "lb", "ob"), 200, ("la", "oa"), ("lb", "ob")), J.disambiguated_alike(rows, rows.toDF("b", "n"), ["n"], F.col("b") > 0)):
        above = got._jdf.queryExecution().executedPlan().toString().partition("SortMergeJoin")
        assert above[1] and "Exchange" not in above[0]


def test_pairs_of_a_grid_are_all_pairs(spark, monkeypatch):
    from tallymark.operators import pairs

    for k, v in {"LISTED": 20, "CELL": 500, "HELD": 150, "SAMPLED": 2}.items():
        monkeypatch.setattr(pairs, k, v)
    rows = spark.range(1000).select(F.col("id").alias("a"), F.when(F.col("id") < 700, "big").when(F.col("id") < 990, F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"))
    x, y = (pairs.listed(rows.where("k is not null"), ["k"], F.col("a"), name, ordered=name == "l") for name in "lr")
    met = []
    got = pairs.paired(x, y, "k", "l", "r", lambda lists: met.append(lists) or lists)
    assert got.where("l is null or r is null").count() == 0
    assert got.count() == got.distinct().count() == rows.alias("x").join(rows.alias("y"), "k").count()
    cells = met[0].where("k = 'big'").groupBy("_i", "_j").agg(F.sum(F.size("r")).alias("n")).collect()
    assert len({r["_i"] for r in cells}) > 1 and len({r["_j"] for r in cells}) > 1
    assert met[0].where("k <> 'big'").agg(F.max("_i"), F.max("_j")).first() == (0, 0)


def test_overlaps_shuffle_lists(spark, monkeypatch):
    sides, real = [], Q.paired
    monkeypatch.setattr(Q, "paired", lambda x, y, *rest: sides.extend([x.count(), y.count()]) or real(x, y, *rest))
    df = spark.range(3000).select(F.col("id").alias("row"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 2 * 400).cast("int")).alias("s"))
    assert Q.overlapping(df.withColumn("e", F.date_add("s", 5)), "s", "e", "row").count() == 2 * 1500 * 1499 // 2
    # every row in one list of a side, at most, and lists hold hundreds
    assert sum(sides) < 40
