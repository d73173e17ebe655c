import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallymark.functions import dates as D
from tallymark.functions import geo as G
from tallymark.functions import textkeys as T


def values(spark, column, rows, kind="string"):
    """column(F.col('x')) of each value, in order."""
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("x"))).collect()]


FINGERPRINTS = {
    "": "811c9dc5",
    "a": "e40c292c",
    "Hello": "f55c314b",
    "Știința Poli Timișoara": "5d0c392e",
    "  padded ": "b82c29db",
    "\t trimmed \n": "57c0721d",
    "Über Köln — Straße ß": "1e7f657e",
    "⚽ 🏟️ final": "72c38fa1",
    "135,000 seats, 2026-27": "1970052c",
    "https://example.com/x?a=1&b=2": "6fc381c5",
    "Final: 26 May 2027 – Wembley": "944e3131",
    "two  inner  spaces": "4dd9550c",
}


def test_fingerprint_golden_vectors(spark):
    assert values(spark, T.fingerprint, list(FINGERPRINTS)) == list(FINGERPRINTS.values())


def test_folds_differ_where_they_should(spark):
    rows = ["Arsenal F.C.", "P.A.O.K.", "St. Pauli", "1. FC Köln", "Straße", None, "A.F.C. Ajax", "TIMIȘOARA", "ﬁnal №"]
    assert values(spark, T.ascii_key, rows)[:8] == ["arsenal fc", "paok", "st pauli", "1 fc koln", "strasse", "", "afc ajax", "timisoara"]
    assert values(spark, T.german_key, ["Rödinghausen", "Köln ß"]) == ["roedinghausen", "koeln ss"]
    assert values(spark, T.roster_key, ["Arsenal F.C."]) == ["arsenal f c"]
    assert values(spark, T.search_key, ["Łódź", "Ærø", "Динамо Київ", "MÜNCHEN"]) == ["lodz", "aero", "динамо київ".replace("ї", "і"), "munchen"]
    assert values(spark, T.romanian_key, ["Școala Ţară"]) == ["scoala tara"]


def test_name_parts(spark):
    p = values(spark, lambda x: T.name_parts(T.ascii_key(x), ["fc", "1"], ["ii"]), ["1. FC Köln 1948 II"])[0]
    assert (p["core"], p["forms"], p["years"], p["markers"]) == (["koln"], ["1", "fc"], ["1948"], ["ii"])


def test_ngrams_and_places(spark):
    got = values(spark, T.ngrams, ["TSV Steinbach Haiger", "Torgelower FC 1919"])
    assert {"Steinbach", "Haiger", "Steinbach Haiger", "TSV Steinbach Haiger"} <= set(got[0])
    assert "Torgelow" in got[1] and "1919" not in got[1] and "FC" not in got[1]
    place = lambda x: T.place_in_name(F.lit("Garching bei München"), x, ["bei", "am"])
    assert values(spark, place, ["VfR Garching", "Garchinger SV", "SV Heimstetten"]) == ["garching", "garching", None]
    assert values(spark, lambda x: T.phrase_in(F.lit("sand"), x), ["sandhausen", "sc sand", None]) == [False, True, False]


def test_numbers_marks_and_parts(spark):
    assert values(spark, T.number_in, ["81,365", "15.000", "99", "ca 5", None]) == [81365, 15000, None, None, None]
    assert values(spark, T.split_names, ["A, B / C; –"]) == [["A", "B", "C"]]
    assert values(spark, T.split_urls, ["http://a/x;y ; https://b"]) == [["http://a/x;y", "https://b"]]
    assert values(spark, T.html_text, ["<p>a&amp;b <b>c</b>\n</p>"]) == ["a&b c"]
    assert values(spark, T.html_text, ["<b>K&ouml;ln</b>&nbsp;&#8211;&#x20AC; &amp;lt; a & b &nope;"]) == ["Köln –€ &lt; a & b &nope;"]
    assert values(spark, T.without_marks, ["Inter [a] (C), at Milan"]) == ["Inter"]
    assert values(spark, T.or_null, [" a ", " ", None]) == ["a", None, None]
    assert values(spark, T.host, ["https://U@WWW.Ex.com:80/a", "x"]) == ["www.ex.com", None]
    assert values(spark, T.slug, ["FC Bayern München"]) == ["fc-bayern-munchen"]


def test_points_ids_and_paths(spark):
    p = values(spark, T.wkt_point, ["Point(11.5 48.25)", "Point(a b)"])
    assert (p[0]["lat"], p[0]["lon"], p[1]["lat"]) == (48.25, 11.5, None)
    assert values(spark, lambda x: T.path_allowed(x, ["a.b[]"]), ["a.b[12]", "a.c"]) == [True, False]
    assert values(spark, T.numbers_in, ["1,234 and 56"]) == [["1234", "56"]]
    assert values(spark, T.urls_in, ["see https://a.b/c). end"]) == [["https://a.b/c"]]


@pytest.mark.parametrize(("text", "held"), [("4111 1111 1111 1111", True), ("4111 1111 1111 1112", False), ("1234", False)])
def test_luhn_gate(spark, text, held):
    assert values(spark, T.holds_card_number, [text]) == [held]


def test_labels_seasons_times(spark):
    m = F.create_map(F.lit("de"), F.lit("Köln"), F.lit("en"), F.lit("Cologne"), F.lit("fr"), F.lit("Cologne"))
    assert values(spark, lambda x: T.labels_in_order(m, ["de"]), ["q"]) == [["Cologne", "Köln"]]
    assert values(spark, lambda x: T.best_label(F.create_map(F.lit("xx"), F.lit("y")), x), ["Q1"]) == ["Q1"]
    assert values(spark, T.season_of, ["2026–27 Liga", "Liga"]) == ["2026-27", None]
    assert values(spark, T.without_season, ["2026–27 Liga 1"]) == ["Liga 1"]
    t = lambda p: values(spark, lambda x: T.time_at_precision(x, F.lit(p)), ["+1904-05-00T00:00:00Z"])[0]
    assert (t(9), t(10), t(11)) == ("1904", "1904-05", "1904-05-00")
    assert "[uùúûüűů]" in values(spark, lambda x: T.accent_pattern(x, ["stadion"]), ["Stadion Rueu"])[0]


CLAIMS = """{"P118":[{"rank":"deprecated","mainsnak":{"snaktype":"value","datavalue":{"type":"wikibase-entityid","value":{"id":"Q1"}}}},
 {"rank":"preferred","mainsnak":{"snaktype":"novalue"},"qualifiers":{"P580":[{"snaktype":"value","datavalue":{"type":"time","value":{"time":"+2020-07-01T00:00:00Z","precision":9}}}]}},
 {"rank":"normal","mainsnak":{"snaktype":"value","datavalue":{"type":"wikibase-entityid","value":{"id":"Q2"}}}}]}"""


def test_statements_and_suppression(spark):
    s = values(spark, lambda x: T.statements(x, "P118"), [CLAIMS])[0]
    assert [(r["value"], r["rank"], r["start"]) for r in s] == [("Q1", "deprecated", None), (None, "preferred", "2020"), ("Q2", "normal", None)]
    assert values(spark, lambda x: F.size(T.truthy(T.statements(x, "P118"))), [CLAIMS]) == [0]
    shape = lambda tracked, text=CLAIMS: values(spark, lambda x: T.suppression_shape(T.statements(x, "P118"), tracked), [text])[0]
    assert (shape(["Q2"]), shape(["Q9"])) == ("B", None)
    assert shape(["Q1"], CLAIMS.replace("preferred", "normal")) == "A"


def test_statements_read_each_value_once(spark):
    claims = spark.createDataFrame([(CLAIMS,)], "c string").select(T.statements("c", "P118").alias("s"))
    plan = claims._jdf.queryExecution().analyzed().toString()
    # once for the value, the start and the end
    assert plan.count("$.time)") == plan.count("$.precision)") == 3
    times = ["-0044-03-15T00:00:00Z", "+0000-01-02", "1904-05-06\nx", "+00012-01-02T", "1904", "x1904-05-06", "", None]
    read = [values(spark, lambda x, p=p: T.time_at_precision(x, F.lit(p).cast("int")), times) for p in (9, 10, None)]
    assert read == [["-44", "0", "1904", "12", None, None, None, None], ["-44-03", "0-01", "1904-05", "12-01", None, None, None, None], ["-44-03-15", "0-01-02", "1904-05-06", "12-01-02", None, None, None, None]]


def test_haversine_and_roads(spark):
    d = values(spark, lambda x: G.haversine(F.lit(50.0), F.lit(8.0), x, F.lit(8.0)), [50.0, 51.0], "double")
    assert d[0] == 0 and 110_000 < d[1] < 112_500
    c = values(spark, lambda x: G.cosine_distance(F.lit(50.0), F.lit(8.0), x, F.lit(8.0)), [51.0], "double")[0]
    assert abs(c - d[1]) < 1
    assert values(spark, lambda x: G.within(F.lit(1000), x), [1050, 1060, None], "int") == [True, False, None]
    cost = values(spark, lambda x: G.fuel_cost(F.lit(268.4), F.lit(7.0), x), [2.0, 1.5, None], "double")
    assert [(r["low"], r["high"]) for r in cost[:2]] == [(34, 41), (25, 31)] and cost[2] is None
    assert values(spark, G.valid_formation, ["4-3-3", "4-4-3", "x"]) == [True, False, False]


def test_polyline(spark):
    pts = values(spark, lambda x: G.polyline_points(x, 5), ["_p~iF~ps|U_ulLnnqC_mqNvxq`@"])[0]
    assert [(round(p["lat"], 5), round(p["lon"], 5)) for p in pts] == [(38.5, -120.2), (40.7, -120.95), (43.252, -126.453)]


def test_spans_and_partial_dates(spark):
    got = values(spark, D.span, ["2026-11-14", "2026-11-14/2026-11-20", "2026-11-20/2026-11-14", "14.11.2026", "2026-02-30", None])
    day = dt.date
    assert [(r["start"], r["end"]) if r else None for r in got] == [(day(2026, 11, 14),) * 2, (day(2026, 11, 14), day(2026, 11, 20)), None, None, None, None]
    assert values(spark, D.month_end, ["2025-12", "2024-02", "2026", "2026-01-05", "x"]) == [day(2025, 12, 31), day(2024, 2, 29), day(2026, 12, 31), day(2026, 1, 5), None]
    assert values(spark, D.partial_bounds, ["2024-02"])[0]["precision"] == "month"
    assert values(spark, D.year_before, [day(2028, 2, 29)], "date") == [day(2027, 2, 28)]
    assert values(spark, D.kickoff, ["2026-05-01T18:00:00Z", "1970-01-01T00:00:00Z"])[1] is None


def test_document_dates(spark):
    got = values(spark, D.marked_days, ["Stand: Juni 2025; read 7 Oct 2026", "current (read 7 Oct 2026)", '"gilt ab dem 19.11.2025", read', "terms (Stand 1 Feb 2023)"])
    assert got == [[dt.date(2025, 6, 30)], [], [dt.date(2025, 11, 19)], [dt.date(2023, 2, 1)]]
    assert values(spark, D.opening_day, ["18.10.2026; read", "undated, read 1 Jan 2024"]) == [dt.date(2026, 10, 18), None]
    assert values(spark, lambda x: D.future_days_in(x, F.lit("2026-11-14").cast("date")), ["on 2026-11-13, 15.11.2026 and May 3, 2027"]) == [[dt.date(2026, 11, 15), dt.date(2027, 5, 3)]]


def test_dates_that_a_rule_may_not_name(spark):
    at = F.lit("2026-11-14").cast("date")
    texts = ["by 30 June", "late June", "until 30.12.2026", "30/12/26 or 1/2/2026", "31 Feb 2026", "December 24", "24. Dezember 2025", "3. Jänner 2027", "2026-13-40"]
    got = values(spark, lambda x: D.banned_dates(x, at), texts)
    assert got == [[], [], ["30.12.2026"], ["30/12/26"], ["31 Feb 2026"], ["December 24"], [], ["3. Jänner 2027"], ["2026-13-40"]]
    assert values(spark, D.marked_days, ["Stand: Jänner 2025", "Stand: 3. Maerz 2025"]) == [[dt.date(2025, 1, 31)], [dt.date(2025, 3, 3)]]


def test_occurrences(spark):
    kind = "array<struct<date:string,dateSource:string>>"
    df = spark.createDataFrame(
        [(1, [("2027-01-01", "confirmed"), ("2020-01-01", "confirmed"), ("2027-01-02", None)], None, None, None), (2, None, ("2027-05-01", "inferred"), None, None), (3, None, None, "confirmed", "2027-03-03"), (4, [], None, None, None)],
        f"i int, f {kind}, n struct<date:string,dateSource:string>, s string, d string",
    )
    rows = {r["i"]: r["o"] for r in df.select("i", D.occurrences("f", "n", "s", "d", F.lit("2026-11-14").cast("date")).alias("o")).collect()}
    assert [(o["suffix"], o["reason"]) for o in rows[1]] == [("-0", None), ("-1", "in the past"), ("-2", "no source for the date")]
    assert rows[2][0]["start"] == dt.date(2027, 5, 1) and rows[3][0]["source"] == "confirmed" and rows[4][0]["reason"] == "no date"
