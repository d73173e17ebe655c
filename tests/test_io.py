import io
import json
import zipfile
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallymark import publish as K
from tallymark.operators.quality import TableSpec
from tallymark.sources import files as S
from tallymark.sources import markup as M
from tallymark.sources import remote as N
from tallymark.streaming import flows


def test_envelopes_and_partitions(spark, tmp_path):
    for name, n in (("AT.json", 2), ("DE.json", 1), ("index.json", 5)):
        (tmp_path / name).write_text(json.dumps({"country": name[:2], "clubs": [{"id": f"{name}{i}"} for i in range(n)]}))
    (tmp_path / "FR.json").write_text("{broken")
    docs = S.partitions(spark, str(tmp_path), "country string, clubs array<struct<id:string>>")
    assert {(r["partition"], r["country"]) for r in docs.collect()} == {("AT", "AT"), ("DE", "DE"), ("FR", None)}
    assert [r["ord"] for r in S.rows_of(docs.where("partition = 'AT'"), "clubs", ["country"]).orderBy("ord").collect()] == [0, 1]


def test_csv_by_header(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text('﻿b,a,extra\n1,"x, y",\n\n2,z,q,too,many\n')
    rows, rejected, unknown = S.csv_rows(spark, str(p), TableSpec(required=["a", "b"]))
    assert [(r["a"], r["b"]) for r in rows.collect()] == [("x, y", "1")] and unknown == ["extra"]
    assert [r["lost"] for r in rejected.collect()] == ["2,z,q,too,many"]
    p.write_text('a,b\n"two\nlines",1\n\nlast,2\nshort\n')
    assert [tuple(r) for r in S.csv_rows(spark, str(p), TableSpec(required=["a", "b"]))[0].orderBy("line").collect()] == [(2, "two\nlines", "1"), (5, "last", "2"), (6, "short", None)]
    with pytest.raises(ValueError, match="missing"):
        S.csv_rows(spark, str(p), TableSpec(required=["c"]))
    (tmp_path / "f.csv").write_text("date,home,away,feed,leadTimeDays\n2026-01-01, A ,B,My Feed,7\n")
    r = S.manual_fixtures(spark, str(tmp_path / "f.csv"))[0].first()
    assert (r["feed"], r["home"], r["leadTimeDays"]) == ("my-feed", "A", 7)
    (tmp_path / "t.tsv").write_text("a\tb\tc\td\nshort\tx\n")
    assert [tuple(r) for r in S.tsv_rows(spark, str(tmp_path / "t.tsv"), ["w", "x", "y", "z"]).collect()] == [("a", "b", "c", "d")]


def test_xlsx(spark, tmp_path):
    buf = io.BytesIO()
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>Country</t></si><si><t>Price EUR</t></si><si><t>AT</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c></row><row r="2"><c r="A2" t="s"><v>2</v></c><c r="B2"><v>1.5</v></c></row></sheetData></worksheet>')
    (tmp_path / "a.xlsx").write_bytes(buf.getvalue())
    cells = S.xlsx_cells(spark, str(tmp_path / "a.xlsx"))
    assert [(r["c"], r["p"]) for r in S.sheet_columns(cells, 1, {"c": "Country", "p": "Price"}).collect()] == [("AT", "1.5")]
    with pytest.raises(ValueError, match="heads 0"):
        S.sheet_columns(cells, 1, {"x": "Nothing"})
    assert str(spark.range(1).select(S.excel_day(F.lit(45000))).first()[0]) == "2023-03-15"


def test_a_large_sheet_is_handed_on_in_parts(spark, monkeypatch):
    from tallymark.plans.stores import _workbook

    book = _workbook((i, "x", i + 1) for i in range(50))
    monkeypatch.setattr(S, "CELLS", 7)
    run = []

    class Files:
        def mapInArrow(self, f, kind):  # noqa: N802  Spark's name
            run.append(f)

    S.cells_of(Files())
    parts = list(run[0]([pa.RecordBatch.from_pydict({"path": ["a", "b"], "content": [book, book]})]))
    assert max(p.num_rows for p in parts) == 7 and sum(p.num_rows for p in parts) == 300
    assert parts[0].slice(3, 1).to_pylist() == [{"file": "a", "row": 2, "col": "A", "text": "1"}]


def test_markup(spark):
    html = '<h3>Team changes</h3><table><caption>In</caption><tr><td><a href="/x">X</a> up</td></tr></table><table><tr><th>Team</th><th>Ground</th></tr><tr><td><a href="/t1">T &amp; 1</a></td><td>G1</td></tr><tr><td>only</td></tr></table>'
    assert M.roster(html, {"team": ("team", "club"), "ground": ("ground",)}, "team") == [{"team": "T & 1", "ground": "G1", "link": "/t1"}]
    assert M.change_links(html) == [("/x", "In: X up"), ("/t1", "T & 1 G1")]
    wiki = "{{Infobox\n| ground = <!-- c -->[[Old Park|The {{nowrap|x}} Park]]<ref>r</ref>\n| capacity = {{n|1|2}} 5\n}}"
    assert M.linked_name(M.infobox_value(wiki, ("stadium", "ground"))) == ("The Park", "Old Park")
    assert M.infobox_value("{{Infobox|ground={{ill|Parc A|fr|Parc B}}, [[Town#East|Town]]<br/>x|a=1}}", ("ground",)) == "Parc A, [[Town#East|Town]]<br/>x"
    assert M.linked_name("Parc A, [[Town#East|Town]]<br/>x") == ("Parc A", None) and M.infobox_value("{{Box | ground = X ]] y", ("ground",)) == "X ]] y"
    assert M.roster("<table><tr><th>Team</th></tr><tr><td>K&ouml;ln &#8211; 1</td></tr></table>", {"team": ("team",)}, "team")[0]["team"] == "Köln – 1"
    assert M.infobox_value(wiki, ("capacity",)) == "5"
    pages = spark.createDataFrame([(1, html), (2, None)], "k int, html string")
    got = M.scanned(pages, "k", "html", "struct<link:string,text:string>", M.change_links).collect()
    assert [(r["k"], r["ord"], r["link"]) for r in got] == [(1, 0, "/x"), (1, 1, "/t1")]
    four = spark.createDataFrame([(1, "<tr><td><a href='u'>a</a></td><td>b</td><td>c</td><td>d&amp;e</td></tr><tr><td>1</td></tr>")], "k int, html string")
    r = M.table_rows(four, "html", ["k"]).collect()
    assert len(r) == 1 and r[0]["cells"] == ["a", "b", "c", "d&e"] and r[0]["link"] == "u"


def test_retries_and_consistency(spark):
    answers, waits = iter([(429, b"", "7"), (503, b"", None), (0, b"", None), (200, b"ok", None)]), []
    assert N.retried(lambda: next(answers), sleep=waits.append) == b"ok" and waits == [7.0, 2.0, 4.0]
    with pytest.raises(OSError, match="404"):
        N.retried(lambda: (404, b"", None), sleep=waits.append)
    with pytest.raises(OSError, match="network error after 4"):
        N.retried(lambda: (0, b"", None), sleep=waits.append)
    df = spark.createDataFrame([("bl1", "2026")], "league string, season string")
    assert N.consistent(df, league="bl1").count() == 1
    with pytest.raises(ValueError):
        N.consistent(df, league="bl2")


def test_rest_source(spark):
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            self.send_response(200)
            self.end_headers()
            self.wfile.write(f"{self.path} {self.headers['X-Auth-Token']}".encode())

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    spark.dataSource.register(N.RestSource)
    url = f"http://127.0.0.1:{server.server_port}/q?ids={{id}}"
    rows = spark.read.format("tallymark_rest").option("url", url).option("ids", "a,b,c").option("batch", "2").option("gap", "0").option("headers", '{"X-Auth-Token": "t"}').load().collect()
    server.shutdown()
    assert [(r["id"], r["body"]) for r in rows] == [("a|b", "/q?ids=a|b t"), ("c", "/q?ids=c t")]


def test_kept_and_partial_writes(spark, tmp_path):
    path = str(tmp_path / "p")
    first = spark.createDataFrame([("AT", 1), ("DE", 1)], "c string, n int")
    none = spark.createDataFrame([], "c string")
    K.partial_overwrite(first, none, path, "c")
    K.partial_overwrite(first.withColumn("n", F.lit(2)), spark.createDataFrame([("AT",)], "c string"), path, "c")
    assert {(r["c"], r["n"]) for r in spark.read.parquet(path).collect()} == {("AT", 2), ("DE", 1)}
    path = str(tmp_path / "q")
    wanted = spark.createDataFrame([("AT",), ("DE",), ("FR",)], "c string")
    assert K.all_or_nothing(first, wanted, "c", path) and not K.all_or_nothing(first, wanted, "c", path)
    path = str(tmp_path / "r")
    assert [K.write_if_changed(df, path, ["c", "n"]) for df in (first, first.orderBy(F.desc("c")), first.limit(1))] == [True, False, True]


def test_envelope_bytes_are_stable(spark, tmp_path):
    df = spark.createDataFrame([("b", None), ("a", 2)], "id string, n int")
    texts = []
    for i, rows in enumerate((df, df.orderBy("id"))):
        K.envelope_json(rows, str(tmp_path / str(i)), ["id"], "rows", source="x")
        texts.append(next(Path(tmp_path / str(i)).glob("part-*")).read_text())
    assert texts[0] == texts[1] == '{"rows":[{"id":"a","n":2},{"id":"b","n":null}],"source":"x"}\n'


def test_calendars(spark, tmp_path):
    feeds = spark.createDataFrame([("f", "Feed, one"), ("g", "Empty")], "feed string, name string")
    ev = spark.createDataFrame([("f", "u1", "20260101T000000Z", 0, "2026-05-01", "2026-05-02", "ä" * 60, None, "a;b,c\nd", 3)], "feed string, uid string, dtstamp string, sequence int, start string, end string, summary string, location string, description string, lead_days int")
    pieces = K.calendars(feeds, ev.withColumn("start", F.col("start").cast("date")).withColumn("end", F.col("end").cast("date")))
    out = {}
    for r in pieces.orderBy("feed", "part", "start", "uid").collect():
        out[r["feed"]] = out.get(r["feed"], "") + r["text"] + "\r\n"
    assert "DTEND;VALUE=DATE:20260503\r\n" in out["f"] and "TRIGGER;RELATED=START:-P3D" in out["f"] and "DESCRIPTION:a\\;b\\,c\\nd" in out["f"]
    assert all(len(line.encode()) <= 75 for line in out["f"].split("\r\n")) and out["f"].replace("\r\n ", "").count("ä") == 120
    assert out["g"].startswith("BEGIN:VCALENDAR\r\n") and out["g"].endswith("END:VCALENDAR\r\n") and "VEVENT" not in out["g"]
    K.split_by_feed(pieces, str(tmp_path / "c"))
    for feed, text in out.items():
        assert b"".join(f.read_bytes() for f in sorted((tmp_path / "c" / f"feed={feed}").glob("part-*"))).decode() == text
    good, skipped = K.skip_report(ev, "uid", F.when(F.col("sequence") == 0, "why"))
    assert good.count() == 0 and [tuple(r) for r in skipped.collect()] == [("u1", "why")]


def test_proposals(spark, tmp_path):
    row = spark.createDataFrame([("k", "1", "Q1", "a|b", "http://x", "t", "d")], ", ".join(f"{c} string" for c in K.EVIDENCE))
    K.write_proposals(row, str(tmp_path / "e"))
    assert spark.read.option("header", True).csv(str(tmp_path / "e")).first()["label"] == "a|b"
    assert [r["line"] for r in K.proposals_markdown(row).orderBy("kind", "position").collect()] == ["## k", "| 1 | Q1 | a\\|b | http://x | t | d |"]


def test_streams(spark, tmp_path):
    events = flows.read(spark, "/root/testdata/sf0.001", "events")
    out = flows.tumbling(events, "ts", "1 hour", "10 minutes", ["event_type"], F.count("*").alias("n"))
    q = out.writeStream.format("memory").queryName("tumbled").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    batch = flows.tumbling(spark.read.parquet("/root/testdata/sf0.001/events.parquet"), "ts", "1 hour", "10 minutes", ["event_type"], F.count("*").alias("n"))
    assert sorted(map(tuple, spark.table("tumbled").collect())) == sorted(map(tuple, batch.collect()))
