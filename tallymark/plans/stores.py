"""Queries that write files and read them back, and scans of marked-up pages. What is written lies in the shared folder."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import publish as K
from ..operators.quality import TableSpec
from ..sources import files as S
from ..sources import markup as M
from ..storage import named_documents, shared_path
from .places import read


def _orders(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", F.col("o_orderdate").cast("date").alias("day"))


def documents_read(spark: SparkSession, d: str) -> DataFrame:
    """A document of customers for each nation, read as partitions, then as rows."""
    path = shared_path(spark, "documents")
    c = read(spark, d, "customer").select("c_nationkey", "c_custkey", "c_name")
    docs = c.groupBy("c_nationkey").agg(F.array_sort(F.collect_list(F.struct("c_custkey", "c_name"))).alias("rows"))
    docs.write.partitionBy("c_nationkey").json(path)
    found = S.envelopes(spark, path, "c_nationkey int, rows array<struct<c_custkey:long,c_name:string>>")
    return S.rows_of(found, "rows", ["c_nationkey"])


def partitions_read(spark: SparkSession, d: str) -> DataFrame:
    """Documents named by two capital letters among others; only those are partitions."""
    path = shared_path(spark, "partitions")
    n = read(spark, d, "nation")
    name = F.concat(F.lit("N"), F.char(F.lit(65) + F.col("n_nationkey")))
    docs = n.select(F.when(F.col("n_nationkey") % 5 > 0, name).otherwise(F.concat(F.lower(name), F.lit("-notes"))).alias("doc"), F.to_json(F.struct(F.lit("table").alias("source"), F.array(F.struct("n_name", "n_regionkey")).alias("rows"))).alias("value"))
    docs.write.partitionBy("doc").text(path)
    named_documents(spark, path, "doc")
    found = S.partitions(spark, path, "source string, rows array<struct<n_name:string,n_regionkey:long>>")
    return S.rows_of(found, "rows", ["partition", "source"]).select("partition", "source", "n_name", "n_regionkey")


def csv_read(spark: SparkSession, d: str) -> DataFrame:
    """Cells with commas, quotes and line ends in columns of another order, one of them unknown."""
    path = shared_path(spark, "csv")
    p = read(spark, d, "part").select(F.col("p_brand").alias("extra"), F.concat("p_name", F.lit(', "x"\nline '), F.col("p_partkey").cast("string")).alias("name"), "p_partkey")
    p.write.option("header", True).option("escape", '"').csv(path)
    rows, rejected, unknown = S.csv_rows(spark, f"{path}/*.csv", TableSpec(required=["p_partkey", "name"]))
    return rows.select(F.col("p_partkey").cast("long").alias("p_partkey"), "name", F.size(F.array(*map(F.lit, unknown))).alias("unknown")).join(rejected.agg(F.count("*").alias("rejected")))


def fixtures_read(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "fixtures")
    k = F.col("o_orderkey")
    o = _orders(spark, d).select(k.cast("string").alias("notes"), F.concat(F.lit(" H "), F.col("o_custkey").cast("string")).alias("home"), F.lit("A").alias("away"), F.concat(F.lit("My Feed "), (k % 3).cast("string")).alias("feed"), F.col("day").cast("string").alias("date"), F.when(k % 2 == 0, (k % 30).cast("string")).otherwise("x").alias("leadTimeDays"))
    o.write.option("header", True).csv(path)
    rows, _, _ = S.manual_fixtures(spark, f"{path}/*.csv")
    return rows.select(F.col("notes").cast("long").alias("o_orderkey"), "date", "home", "feed", "leadTimeDays")


def tsv_read(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "tsv")
    k = F.col("p_partkey")
    line = F.when(k % 5 == 0, k.cast("string")).otherwise(F.concat_ws("\t", k.cast("string"), F.concat(F.lit(" "), "p_name", F.lit(" ")), "p_type", F.lit("more")))
    read(spark, d, "part").select(line.alias("value")).write.text(path)
    return S.tsv_rows(spark, path, ["p_partkey", "p_name", "p_type"]).withColumn("p_partkey", F.col("p_partkey").cast("long"))


_SHEET = '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{}</sheetData></worksheet>'


def _workbook(rows: Iterable[tuple]) -> bytes:
    cell = lambda c, r, v: f'<c r="{c}{r}" t="inlineStr"><is><t>{v}</t></is></c>' if isinstance(v, str) else f'<c r="{c}{r}"><v>{v}</v></c>'
    before, after = _SHEET.split("{}")
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z, z.open("xl/worksheets/sheet1.xml", "w", force_zip64=True) as part:
        part.write(before.encode())
        for i, row in enumerate(rows, 1):
            part.write(f'<row r="{i}">{"".join(cell(c, i, v) for c, v in zip("ABC", row, strict=True))}</row>'.encode())
        part.write(after.encode())
    return out.getvalue()


def sheets_read(spark: SparkSession, d: str) -> DataFrame:
    """A workbook for each brand: what a sheet's columns hold under its header."""
    p = read(spark, d, "part").groupBy("p_brand").agg(F.array_sort(F.collect_list(F.struct("p_partkey", "p_size"))).alias("rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # one workbook at a time
                rows = ((r["p_partkey"].as_py(), r["p_size"].as_py()) for r in batch.column("rows")[i])
                book = _workbook(chain([("Part no", "Size cm", "Serial")], ((k, n, 45_000 + n) for k, n in rows)))
                yield pa.RecordBatch.from_arrays([batch.column("p_brand").slice(i, 1), pa.array([book], pa.binary())], names=["path", "content"])

    cells = S.cells_of(p.mapInArrow(run, "path string, content binary"))
    rows = S.sheet_columns(cells, 1, {"part": "Part", "size": "Size", "serial": "Serial"})
    return rows.select(F.col("file").alias("p_brand"), F.col("part").cast("long").alias("p_partkey"), F.col("size").cast("int").alias("p_size"), S.excel_day(F.col("serial")).alias("day"))


def rosters_read(spark: SparkSession, d: str) -> DataFrame:
    """Pages with one table of grounds beside league tables, or with two league tables that share a team; a place that
    spans two rows, a note across the table."""
    k = F.col("s_suppkey").cast("string")
    link = lambda who: F.concat(F.lit("<a href='/s/"), k, F.lit(f"{who}'>K&ouml;ln "), k, F.lit(f"{who}</a>"))
    grounds = F.concat(F.lit("<table><tr><th>Team name</th><th>Ground</th><th>Capacity</th></tr><tr><td>"), link("a"), F.lit("</td><td rowspan='2'>"), "s_name", F.lit(" &amp; Co</td><td>5</td></tr><tr><td>"), link("b"), F.lit("</td><td>6</td></tr><tr><td colspan=3>note</td></tr></table>"))
    league = lambda who: F.concat(F.lit("<table><tr><th>Pos</th><th>Team</th><th>Pld</th></tr><tr><td>1</td><td>"), link(who), F.lit("</td><td>9</td></tr><tr><td>2</td><td>"), link("z"), F.lit("</td><td>9</td></tr></table>"))
    html = F.concat(F.lit("<table><tr><td>x</td></tr></table>"), F.when(F.col("s_suppkey") % 2 == 0, F.concat(league("c"), grounds)).otherwise(F.concat(league("c"), league("d"))))
    s = read(spark, d, "supplier").select("s_suppkey", html.alias("html"))
    shapes = {"grounds": {"team": ("team", "club"), "ground": ("ground", "stadium"), "capacity": ("capacit",)}, "league": {"position": ("pos",), "team": ("team", "club"), "played": ("pld",)}}
    scan = lambda t: M.rosters(t, shapes, "team")
    kind = "struct<shape:string,team:string,ground:string,capacity:string,position:string,played:string,link:string>"
    return M.scanned(s, "s_suppkey", "html", kind, scan).select("s_suppkey", "shape", "team", "ground", "capacity", "link")


def infoboxes_read(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    ground = F.when(k % 3 == 0, F.concat(F.lit("[[Park "), k.cast("string"), F.lit("|The {{nowrap|x}} Park]]<ref>r|s</ref>"))).when(k % 3 == 1, F.concat(F.lit("{{ill|Parc "), k.cast("string"), F.lit("|fr|Parc}}, [[Town]]"))).when(k % 2 == 0, F.concat(F.lit("Old Field "), k.cast("string"), F.lit("<br/>[[Lier]]; x"))).otherwise("{{cite|a=b}}")
    wiki = F.concat(F.lit("{{Infobox\n| name = n\n| ground = "), ground, F.lit("\n| capacity = 5\n}}"))

    def scan(text: str) -> list[dict]:
        value = M.infobox_value(text, ("stadium", "ground"))
        return [] if value is None else [dict(zip(("name", "title"), M.linked_name(value), strict=True))]

    return M.scanned(read(spark, d, "supplier").select("s_suppkey", wiki.alias("wiki")), "s_suppkey", "wiki", "struct<name:string,title:string>", scan).select("s_suppkey", "name", "title")


def changes_read(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey").cast("string")
    html = F.concat(F.lit("<h2>Other</h2><table><tr><td><a href='/no'>n</a></td></tr></table><h3>Team changes</h3><table><caption>In</caption><tr><td><a href='/s/"), k, F.lit("'>"), "s_name", F.lit("</a> up</td></tr></table>"))
    return M.scanned(read(spark, d, "supplier").select("s_suppkey", html.alias("html")), "s_suppkey", "html", "struct<link:string,text:string>", M.change_links).select("s_suppkey", "link", "text")


def envelope_written(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "envelope")
    K.envelope_json(read(spark, d, "nation").select("n_name", "n_nationkey", "n_regionkey"), path, ["n_nationkey"], "nations", source="table")
    return spark.read.text(path).select(F.md5("value").alias("document"), F.length("value").alias("n"))


def partial_written(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "partial")
    n = read(spark, d, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count("*").alias("n"))
    none = n.where("false").select("nation")
    K.partial_overwrite(n, none, path, "nation")
    K.partial_overwrite(n.withColumn("n", -F.col("n")), n.where("nation % 3 = 0").select("nation"), path, "nation")
    return spark.read.parquet(path).select(F.col("nation").cast("int").alias("nation"), "n")


def all_written(spark: SparkSession, d: str) -> DataFrame:
    """What is there after a whole write, one that lacks a nation, and another whole one."""
    path = shared_path(spark, "all")
    n = read(spark, d, "nation").select("n_nationkey")
    said = [K.all_or_nothing(rows.withColumn("version", F.lit(v)), n, "n_nationkey", path) for v, rows in ((1, n), (2, n.where("n_nationkey > 0")), (3, n), (4, n.where("n_nationkey > 0")))]
    return spark.read.parquet(path).withColumn("wrote", F.lit(",".join(str(int(x)) for x in said)))


def written_if_changed(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "changed")
    o = read(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    said = [K.write_if_changed(df, path, ["o_orderkey", "o_orderstatus"]) for df in (o, o.repartition(3), o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 2 = 0"))]
    return spark.read.parquet(path).agg(F.count("*").alias("n")).withColumn("wrote", F.lit(",".join(str(int(x)) for x in said)))


def _calendars(spark: SparkSession, d: str) -> DataFrame:
    feeds = read(spark, d, "nation").select(F.concat(F.lit("f"), F.col("n_nationkey").cast("string")).alias("feed"), F.col("n_name").alias("name"))
    k = F.col("o_orderkey")
    o = _orders(spark, d).select(F.concat(F.lit("f"), (F.col("o_custkey") % 40).cast("string")).alias("feed"), F.concat(F.lit("u"), k.cast("string")).alias("uid"), F.lit("19980630T000000Z").alias("dtstamp"), (k % 3).cast("int").alias("sequence"), F.col("day").alias("start"), F.date_add("day", 1).alias("end"), F.concat(F.lit("Order "), k.cast("string"), F.lit(", "), F.repeat(F.lit("ä"), 40)).alias("summary"), F.when(k % 2 == 0, "hall; east").alias("location"), F.lit("d").alias("description"), F.when(k % 4 == 0, 3).alias("lead_days"))
    return K.calendars(feeds, o)


def calendar_counts(spark: SparkSession, d: str) -> DataFrame:
    """Of each calendar: events, alarms, places, the longest line, and lines that a fold has broken off."""
    lines = _calendars(spark, d).select("feed", F.explode(F.split("text", "\r\n")).alias("line"))
    return lines.groupBy("feed").agg(F.count_if(F.col("line") == "BEGIN:VEVENT").alias("events"), F.count_if(F.col("line") == "TRIGGER;RELATED=START:-P3D").alias("alarms"), F.count_if(F.col("line") == "LOCATION:hall\\; east").alias("places"), (F.max(F.octet_length("line")) <= 75).alias("short"), F.count_if(F.col("line").startswith(" ")).alias("folds"))


def feeds_written(spark: SparkSession, d: str) -> DataFrame:
    """Each feed's files as written: events and ends, and whether the manifest agrees with them."""
    path = shared_path(spark, "feeds")
    manifest = K.split_by_feed(_calendars(spark, d), path).groupBy("feed").agg(F.sum("events").alias("listed"), (F.max("place") == F.count("*")).alias("whole"))
    lines = spark.read.option("lineSep", "\r\n").text(path)
    found = lines.groupBy("feed").agg(F.count_if(F.col("value").startswith("UID:")).alias("events"), F.count_if(F.col("value") == "END:VCALENDAR").alias("ends"))
    return found.join(manifest, "feed").select("feed", "events", "ends", "listed", "whole")


def events_skipped(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    feeds = read(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("_feed"))
    o = _orders(spark, d).join(feeds, F.col("o_custkey") % 40 == F.col("_feed"), "left")
    return K.skip_report(o, "o_orderkey", F.when(F.col("_feed").isNull(), "no feed").when(k % 5 == 0, "no date").when(k % 7 == 0, "disputed"))[1]


def proposals_written(spark: SparkSession, d: str) -> DataFrame:
    path = shared_path(spark, "proposals")
    k = F.col("c_custkey").cast("string")
    c = read(spark, d, "customer").select(F.col("c_mktsegment").alias("kind"), F.col("c_nationkey").cast("string").alias("tier"), k.alias("id"), F.concat("c_name", F.lit("|x")).alias("label"), F.lit("http://x").alias("evidence_url"), F.lit('says "a, b"').alias("evidence_text"), F.lit(None).cast("string").alias("detail"))
    K.write_proposals(c, path)
    back = spark.read.option("header", True).option("escape", '"').csv(path)
    text = K.proposals_markdown(back).where("position > 0").select(F.col("kind"), F.split("line", r" \| ")[1].alias("id"), "line")
    return back.join(text, ["kind", "id"]).select("kind", "id", "label", "evidence_text", "line")


QUERIES = {k: f for k, f in list(globals().items()) if callable(f) and getattr(f, "__module__", "") == __name__ and not k.startswith("_")}

_CAL = "o AS (SELECT o_custkey%40 AS f, o_orderkey AS k FROM orders), n AS (SELECT 'f' || n_nationkey AS feed, n_nationkey AS f FROM nation)"
ORACLE_SQL = {
    "documents_read": "SELECT c_nationkey, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey)-1 AS INTEGER) AS ord, c_custkey, c_name FROM customer",
    "partitions_read": "SELECT 'N' || chr(65 + n_nationkey::INT) AS partition, 'table' AS source, n_name, n_regionkey FROM nation WHERE n_nationkey%5 > 0",
    "csv_read": "SELECT p_partkey, p_name || ', \"x\"' || chr(10) || 'line ' || p_partkey AS name, 1 AS unknown, 0 AS rejected FROM part",
    "fixtures_read": "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, 'H ' || o_custkey AS home, 'my-feed-' || o_orderkey%3 AS feed, CASE WHEN o_orderkey%2=0 THEN CAST(o_orderkey%30 AS INTEGER) END AS \"leadTimeDays\" FROM orders",
    "tsv_read": "SELECT p_partkey, p_name, p_type FROM part WHERE p_partkey%5 > 0",
    "sheets_read": "SELECT p_brand, p_partkey, p_size, DATE '1899-12-30' + (45000 + p_size)::INT AS day FROM part",
    "rosters_read": """WITH r AS (SELECT s_suppkey AS k, s_name, unnest(CASE WHEN s_suppkey%2=0 THEN ['a', 'b'] ELSE ['c', 'z', 'd'] END) AS w FROM supplier)
        SELECT k AS s_suppkey, CASE WHEN k%2=0 THEN 'grounds' ELSE 'league' END AS shape, 'Köln ' || k || w AS team, CASE WHEN k%2=0 THEN s_name || ' & Co' END AS ground, CASE w WHEN 'a' THEN '5' WHEN 'b' THEN '6' END AS capacity, '/s/' || k || w AS link FROM r""",
    "infoboxes_read": "SELECT s_suppkey, CASE s_suppkey%3 WHEN 0 THEN 'The Park' WHEN 1 THEN 'Parc ' || s_suppkey ELSE 'Old Field ' || s_suppkey END AS name, CASE WHEN s_suppkey%3=0 THEN 'Park ' || s_suppkey END AS title FROM supplier WHERE s_suppkey%3 < 2 OR s_suppkey%2 = 0",
    "changes_read": "SELECT s_suppkey, '/s/' || s_suppkey AS link, 'In: ' || s_name || ' up' AS text FROM supplier",
    "envelope_written": """WITH t AS (SELECT '{"nations":[' || string_agg('{"n_name":"' || n_name || '","n_nationkey":' || n_nationkey || ',"n_regionkey":' || n_regionkey || '}', ',' ORDER BY n_nationkey) || '],"source":"table"}' AS t FROM nation) SELECT md5(t) AS document, CAST(length(t) AS INTEGER) AS n FROM t""",
    "partial_written": "SELECT c_nationkey AS nation, count(*) * CASE WHEN c_nationkey%3=0 THEN -1 ELSE 1 END AS n FROM customer GROUP BY 1",
    "all_written": "SELECT n_nationkey, 3 AS version, '1,0,1,0' AS wrote FROM nation",
    "written_if_changed": "SELECT count(*) AS n, '1,0,1,0' AS wrote FROM orders WHERE o_orderkey%2=0",
    "calendar_counts": f"WITH {_CAL} SELECT feed, count(k) AS events, count(*) FILTER (k%4=0) AS alarms, count(*) FILTER (k%2=0) AS places, true AS short, count(k) + count(*) FILTER (k%4=0) AS folds FROM n LEFT JOIN o USING (f) GROUP BY 1",
    "feeds_written": f"WITH {_CAL} SELECT feed, count(k) AS events, 1 AS ends, count(k) AS listed, true AS whole FROM n LEFT JOIN o USING (f) GROUP BY 1",
    "events_skipped": "SELECT o_orderkey, CASE WHEN o_custkey%40 >= 25 THEN 'no feed' WHEN o_orderkey%5=0 THEN 'no date' ELSE 'disputed' END AS reason FROM orders WHERE o_custkey%40 >= 25 OR o_orderkey%5=0 OR o_orderkey%7=0",
    "proposals_written": r"""SELECT c_mktsegment AS kind, CAST(c_custkey AS VARCHAR) AS id, c_name || '|x' AS label, 'says "a, b"' AS evidence_text, '| ' || c_nationkey || ' | ' || c_custkey || ' | ' || c_name || '\|x | http://x | says "a, b" |  |' AS line FROM customer""",
}
