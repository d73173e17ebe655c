"""Rules that were read in part before, case by case."""

import datetime as dt
import html
import json

import pytest
from pyspark.sql import functions as F

from tallymark.functions import dates as D
from tallymark.functions import textkeys as T
from tallymark.operators import quality as Q
from tallymark.operators import resolve as J
from tallymark.sources import markup as M


def values(spark, f, xs, *args):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x string")
    return [r["v"] for r in df.select("i", f("x", *args).alias("v")).orderBy("i").collect()]


@pytest.mark.parametrize(
    ("value", "name", "title"),
    [
        ("Parc 1, [[Town]]", "Parc 1", None),
        ("Old Park, [[Lier]]", "Old Park", None),
        ("[[Old Park|The Park]], [[Lier]]", "The Park", "Old Park"),
        ("[[Old Park#North]]<br/>Lier", "Old Park#North", "Old Park"),
        ("Field<br />[[Lier]]", "Field", None),
        ("<small>Field</small>; other", "Field", None),
        ("Field\nother", "Field", None),
        ("at [[Old Park|the Park]] North", "at the Park North", None),
        ("", "", None),
    ],
)
def test_infobox_names(value, name, title):
    assert M.linked_name(value) == (name, title)


def test_infobox_values_end_to_end():
    assert M.linked_name(M.infobox_value("{{Infobox | ground = {{ill|Parc 1|fr|Parc}}, [[Town]] }}", ("ground",))) == ("Parc 1", None)


def test_markers_of_documents(spark):
    day = dt.date(2025, 6, 1)
    said = ["Stand:01.06.2025", "Stand 01.06.2025", "gültig ab 1. Juni 2025", "gultig ab: 1 June 2025", "GÜLTIG AB 01.06.2025", "gilt ab dem 01.06.2025", "valid from 1 Jun 2025"]
    assert values(spark, D.marked_days, said) == [[day]] * len(said)
    not_said = ["Bestand 01.06.2025", "as of 01.06.2025", "in force from 1 June 2025", "read 01.06.2025", "Abstand: 1 Jun 2025", None, ""]
    assert values(spark, D.marked_days, not_said) == [[]] * len(not_said)


def test_dates_in_any_wording_are_banned(spark):
    as_of = F.lit("2030-01-01").cast("date")
    said = ["3rd of May 2031", "May 3rd, 2031", "on 1st May 2031", "May. 22nd 2031", "3-5th of May 2031", "3rd – 4th May 2031", "2 May 2031", "May 2, 2031"]
    want = [dt.date(2031, 5, d) for d in (3, 3, 1, 22, 3, 3, 2, 2)]
    assert values(spark, D.future_days_in, said, as_of) == [[d] for d in want]
    assert values(spark, D.future_days_in, ["3rd of May 2029", "the 3rd of them", "rounds 1st and 2nd", "May"], as_of) == [[]] * 4


def test_references_as_html_reads_them(spark):
    said = ["&#146;x", "&copy 1", "&amp x", "&ampx;", "&notit;", "&notin;", "&nope; &;", "&#x41&#66;", "&#0;&#1;|", "&#xD800;&#x110000;", "&#99999999999999999999999;", "&#xFFFE;|&#xFDD0;", "a&lt;b&gt;c&quot;", "&AMP;&Amp", "&#128512;", "&#13;x", "& b", "&#;", "&#x;", "&hellip", "&hearts;", "&acE;", "&amp;lt;", "no", "&a" * 40]
    assert values(spark, T.unescaped, said) == [html.unescape(s) for s in said]
    assert values(spark, T.unescaped, [None]) == [None]


def test_two_hops_keep_rows_and_name_failures(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "x"), (4, "y"), (5, None), (6, "b")], "n int, t string")
    direct = spark.createDataFrame([("a", "Q2"), ("a", "Q1"), ("c", "Q3")], "title string, id string")
    hops = spark.createDataFrame([("b", "c"), ("b", "d"), ("x", "nowhere")], "title string, target string")
    got = {r["n"]: (r["id"], r["route"]) for r in J.two_hops(rows, "t", direct, hops, batch=F.floor((F.col("n") - 1) / 2)).collect()}
    assert got == {1: ("Q1", "direct"), 2: ("Q3", "redirect"), 3: (None, "failed"), 4: (None, "failed"), 5: (None, None), 6: ("Q3", "redirect")}
    assert J.two_hops(rows, "t", direct, hops).where("route = 'failed'").count() == 0
    refused = J.two_hops(rows, "t", direct, hops, refuse=F.col("target") == "c")
    assert refused.where("t = 'b' and id is not null").count() == 0


def test_name_candidates_with_nulls_and_clashing_names(spark):
    rows = spark.createDataFrame([("s", "Park Hall", None), ("s", "Park Hall", None), ("s", "Mill", "x"), (None, "Mill", "x"), ("s", None, "x")], "scope string, name string, code string")
    one = spark.createDataFrame([("s", "c1", "park"), ("s", "c1", "Park Hall East")], "scope string, code string, label string")
    two = spark.createDataFrame([("s", "c1", "park"), ("s", "c2", "hall"), (None, "c3", "mill"), ("s", None, "mill"), ("s", "c4", None)], "scope string, code string, label string")
    lists = [x.toDF("scope", "code", "label") for x in (one, two)]
    got = J.name_candidates(rows.toDF("scope", "name", "note"), lists, "scope", "name").collect()
    assert sorted((r["name"], str(r["code"]), r["label"], r["source_order"]) for r in got) == sorted(2 * [("Park Hall", "c1", "park", 0), ("Park Hall", "c1", "Park Hall East", 0), ("Park Hall", "c2", "hall", 1)] + [("Mill", "None", "mill", 1)])


def test_name_candidates_are_chosen_by_name(spark):
    rows = spark.range(200).select(F.lit("s").alias("scope"), F.when(F.col("id") % 2 == 0, "Park Hall").otherwise("Mill").alias("name"), F.col("id").alias("n"))
    one = spark.createDataFrame([("s", None, "park"), ("s", None, "park"), ("s", "c1", "mill")], "scope string, code string, label string")
    two = spark.createDataFrame([("s", None, "hall"), ("s", "c1", "hall"), ("s", "c1", "mill")], "scope string, code string, label string")
    got = J.name_candidates(rows, [one, two], "scope", "name")
    # rows of one name aren't grouped one by one: nothing but the last join grows with the rows
    assert "_id#" not in got._jdf.queryExecution().analyzed().toString()
    want = [(i, *x) for i in range(200) for x in ([("None", "park", 0)] * 2 + [("c1", "hall", 1)] if i % 2 == 0 else [("c1", "mill", 0)])]
    assert sorted((r["n"], str(r["code"]), r["label"], r["source_order"]) for r in got.collect()) == sorted(want)


def leaves(o, path=""):
    if isinstance(o, dict):
        return [x for k, v in o.items() for x in leaves(v, f"{path}.{k}" if path else k)]
    if isinstance(o, list):
        return [x for i, v in enumerate(o) for x in leaves(v, f"{path}[{i}]")]
    kind = "null" if o is None else "boolean" if isinstance(o, bool) else "string" if isinstance(o, str) else "number"
    return [(path, None if o is None else str(o).lower() if kind == "boolean" else str(o), kind)]


def test_leaves_at_any_depth(spark):
    deep = "x"
    for i in range(50):
        deep = [deep] if i % 3 == 0 else {f"k{i}": deep, "n": i}
    docs = [{"a": {"b": ["x", {"c": 1}]}, "d": "y"}, deep, {"e": {}, "l": [], "m": [[], {}], "n": None, "t": True, "s": "{not [open", "q": '"'}, "plain", 5, [], {}, None]
    rows = [(i, json.dumps(d), "clash") for i, d in enumerate(docs)] + [(90, "no json {", "clash"), (91, None, "clash"), (92, "", "clash"), (None, '{"z": "null id"}', "clash")]
    got = T.flattened(spark.createDataFrame(rows, "id int, doc string, key string"), "doc", ["id", "key"]).collect()
    want = [(i, "clash", *x) for i, d in enumerate(docs) for x in leaves(d)] + [(90, "clash", "", "no json {", "text"), (92, "clash", "", "", "text"), (None, "clash", "z", "null id", "string")]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_leaves_of_a_small_file_are_opened_by_all_tasks(spark, monkeypatch):
    parts = []
    monkeypatch.setattr(T, "stored", lambda df, what: parts.append(df.rdd.getNumPartitions()) or df)
    one = spark.createDataFrame([(i, json.dumps({"a": [[i]], "b": "x"})) for i in range(40)], "id int, doc string").coalesce(1)
    got = T.flattened(one, "doc", ["id"])
    assert parts == [int(spark.conf.get("spark.sql.shuffle.partitions"))]
    assert sorted(map(tuple, got.collect())) == sorted(x for i in range(40) for x in ((i, "a[0][0]", str(i), "number"), (i, "b", "x", "string")))


def test_allowed_paths(spark):
    assert values(spark, lambda x: T.path_allowed(x, ["a.b[]", "p."]), ["a.b[12]", "a.c", "p.q[3].r", "p", "px.y"]) == [True, False, True, False, False]

LEAGUE = "<table class=wikitable><tr><th>Pos</th><th>Team</th><th>Pld</th></tr>{}</table>"
SHAPES = {"grounds": {"team": ("team",), "ground": ("stadium", "ground"), "capacity": ("capacit",)}, "league": {"position": ("pos",), "team": ("team",), "played": ("pld",)}}


def league(*teams):
    return LEAGUE.format("".join(f"<tr><td>{i}</td><td><a href='/{t}'>{t}</a></td><td>9</td></tr>" for i, t in enumerate(teams, 1)))


def test_all_league_tables_are_united():
    found = M.rosters(league("a", "b") + "<p>x</p>" + league("c", "b"), SHAPES, "team")
    assert [(r["shape"], r["team"], r["link"], r["ground"]) for r in found] == [("league", "a", "/a", None), ("league", "b", "/b", None), ("league", "c", "/c", None)]


def test_the_better_shape_is_used_alone():
    grounds = "<table><tr><th>Team</th><th>Stadium</th><th>Capacity</th></tr><tr><td>x</td><td rowspan=2>G</td><td>1</td></tr><tr><td>y</td><td>2</td></tr><tr><td colspan=3>note</td></tr><tr><td></td><td>G</td><td>3</td></tr><tr><td>z</td></tr></table>"
    found = M.rosters(league("a") + grounds, SHAPES, "team")
    assert [(r["shape"], r["team"], r["ground"], r["capacity"]) for r in found] == [("grounds", "x", "G", "1"), ("grounds", "y", "G", "2")]
    assert M.rosters("", SHAPES, "team") == M.rosters("<table><tr><td>no head</td></tr></table>", SHAPES, "team") == []


def test_spans_fill_the_grid():
    grid = M.table_grid("<table><tr><td rowspan=3>a</td><td colspan='2'>b</td></tr><tr><td>c</td><td rowspan=2>d</td></tr><tr><td>e</td></tr><tr><td>f</td></tr></table>")
    assert [[c for _, c, _ in r] for r in grid] == [["a", "b", "b"], ["a", "c", "d"], ["a", "e", "d"], ["f"]]


def test_glossary_by_stems(spark):
    glossary = spark.createDataFrame([("away end", "tribuna oaspeților"), ("final", "finală"), ("to", "la"), ("ground", "teren"), (None, "x"), ("final", None), ("final", "finală")], "term string, wanted string")
    rows = [
        (1, "The final at the ground", "Finalei pe TERENUL mare"),
        (2, "The away end", "Tribunei oaspeților"),
        (3, "The away end is full", "Sectorul oaspeților"),
        (4, "Endings away from it", "nimic"),
        (5, "the finals", "nimic"),
        (6, "Final to the ground", "jocul"),
        (7, "final", None),
        (8, None, "x"),
    ]
    got = Q.glossary_problems(spark.createDataFrame(rows, "row int, en string, ro string"), "row", "en", "ro", glossary)
    assert sorted(map(tuple, got.collect())) == [(3, "away end", "tribuna oaspeților"), (6, "final", "finală"), (6, "ground", "teren")]


def test_documents_are_named_by_their_partition(spark, tmp_path):
    from tallymark.sources import files as S
    from tallymark.storage import named_documents

    df = spark.createDataFrame([("AT", '{"a": 1}'), ("notes", '{"a": 2}')], "doc string, value string")
    df.coalesce(1).write.partitionBy("doc").text(str(tmp_path / "d"))
    named_documents(spark, str(tmp_path / "d"), "doc")
    assert [(r["partition"], r["a"]) for r in S.partitions(spark, str(tmp_path / "d"), "a int").collect()] == [("AT", 1)]


def test_conditions_and_lists(spark):
    df = spark.createDataFrame([("d", "x", "Q1;Q2"), ("d", None, "all"), (None, "x", "all;Q1"), (None, None, ""), (None, None, "unknown")], "s string, o string, ids string")
    got = df.select(Q.conditional(F.col("s") == "d", F.col("o").isNotNull()).alias("c"), Q.list_or_word("ids", ["all", "unknown"], "^Q[0-9]+$").alias("l")).collect()
    assert [(r["c"], r["l"]) for r in got] == [(False, False), (True, False), (True, True), (False, True), (False, False)]
