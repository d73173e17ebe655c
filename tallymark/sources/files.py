"""File scans."""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator
from itertools import chain, groupby, islice
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.textkeys import or_null, slug
from ..operators.quality import TableSpec, column_problems
from ..storage import stored


def envelopes(spark: SparkSession, path: str, schema: str | StructType, pattern: str = "*.json") -> DataFrame:
    """One row for each JSON document whose file name fits the pattern, with its name; a document that can't be
    parsed has nulls, so the caller can keep the last good one."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").option("pathGlobFilter", pattern).json(path).withColumn("file", F.element_at(F.split(F.input_file_name(), "/"), -1))


def partitions(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The documents named by two capital letters, which are the partition."""
    return envelopes(spark, path, schema, "[A-Z][A-Z].json").withColumn("partition", F.substring("file", 1, 2))


def rows_of(docs: DataFrame, field: str, keep: list[str] = ()) -> DataFrame:
    """The elements of an envelope's array as rows, with their place and the envelope's own fields."""
    return docs.select(*keep, F.posexplode(field).alias("ord", "_r")).select(*keep, "ord", "_r.*")


#: The longest cell, in characters.
LONGEST_CELL = 1 << 30


def _lines(value: str) -> list[str]:
    """What the text reader takes for one line, with its end and parted at lone carriage returns too."""
    return [value + "\n"] if "\r" not in value else list(io.StringIO(value + "\n", newline=""))


def _quoted_after(line: str, quoted: bool, sep: str) -> bool:
    """Whether a quoted cell is open at a line's end, given whether one is at its start."""
    if '"' not in line:
        return quoted
    reader = csv.reader(iter(['"' + line if quoted else line, "\n"]), delimiter=sep)
    next(reader)
    return reader.line_num == 2


def _by_chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, Iterator[str]]]:
    """The lines of each chunk of a file: (file, place in the file, lines). A chunk's lines come together, in order."""
    rows = ((f, at, v) for b in batches for f, at, v in zip(b.column("file").to_pylist(), b.column("at").to_pylist(), b.column("value").to_pylist(), strict=True))
    for (f, at), found in groupby(rows, key=lambda r: r[:2]):
        lines = (line for _, _, v in found for line in _lines(v))
        if at == 0:
            lines = chain([next(lines).removeprefix("\ufeff")], lines)
        yield f, at, lines


def csv_records(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """file, line (the one a record starts at) and cells of the records of CSV files that aren't blank, as csv.reader reads
    them, with quoted line ends. A large file is read by many tasks.

    Spark's text reader cuts files into chunks at line ends. Whether a chunk starts inside a quoted cell depends on all
    before it: a first pass finds for each chunk, for either start, how it ends, and its number of lines; running over a
    file's chunks that gives each one's start and first line. The second pass parses the chunks side by side. A record
    over several chunks comes as pieces, which are put together and parsed last.
    """
    csv.field_size_limit(LONGEST_CELL)
    text = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value")

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(LONGEST_CELL)
        for f, at, lines in _by_chunk(batches):
            n, plain, quoted = 0, False, True
            for line in lines:
                n += 1
                if '"' in line:
                    plain, quoted = _quoted_after(line, plain, sep), _quoted_after(line, quoted, sep)
            yield pa.RecordBatch.from_pydict({"file": [f], "at": [at], "lines": [n], "plain": [plain], "quoted": [quoted]}, pa.schema([("file", pa.string()), ("at", pa.int64()), ("lines", pa.int64()), ("plain", pa.bool_()), ("quoted", pa.bool_())]))

    chunks = stored(text.mapInArrow(ends, "file string, at long, lines long, plain boolean, quoted boolean"), "chunks")
    # a row for each chunk of a file, in order. A chunk keeps what it starts with, or turns it round, or ends in one way
    # whatever its start; so a start is that of the last chunk of the third kind, turned round as often as since then
    order = Window.partitionBy("file").orderBy("at")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    turns = F.sum((F.col("plain") & ~F.col("quoted")).cast("int"))
    fixed = F.when(F.col("plain") == F.col("quoted"), F.struct(F.col("plain").alias("ends"), F.col("_turns").alias("turns")))
    chunks = chunks.withColumn("_turns", turns.over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_last", F.last(fixed, ignorenulls=True).over(before))
    since = F.coalesce(turns.over(before), F.lit(0)) - F.coalesce(F.col("_last")["turns"], F.lit(0))
    start = (since % 2 == 1) != F.coalesce(F.col("_last")["ends"], F.lit(False))
    starts = stored(chunks.select("file", "at", F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("before"), start.alias("start")), "starts")
    # at most a name and a number for each chunk of the text reader (128 MB of input unless set otherwise)
    inside = {(r[0], r[1]) for r in starts.where("start").select("file", "at").toLocalIterator()}
    shape = pa.schema([("file", pa.string()), ("at", pa.int64()), ("line", pa.int64()), ("cells", pa.list_(pa.string())), ("piece", pa.string()), ("opens", pa.bool_())])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(LONGEST_CELL)
        for f, at, lines in _by_chunk(batches):
            rows: list[tuple] = []
            n, held, quoted = 0, [], (f, at) in inside
            if quoted:  # the end of a record that an earlier chunk began
                head = []
                for line in lines:
                    head.append(line)
                    quoted = _quoted_after(line, quoted, sep)
                    if not quoted:
                        break
                rows.append((f, at, 0, None, "".join(head), False))
                n = len(head)
            for line in lines:
                held.append(line)
                quoted = _quoted_after(line, quoted, sep)
                if quoted:
                    continue
                if len(held) == 1 and not line.strip():
                    n, held = n + 1, []
                    continue
                cells = next(csv.reader(iter(held), delimiter=sep))
                if any(c.strip() for c in cells):
                    rows.append((f, at, n, cells, None, None))
                n, held = n + len(held), []
                if len(rows) >= 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), shape.types, strict=True)], schema=shape)
                    rows = []
            if held:
                rows.append((f, at, n, None, "".join(held), True))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), shape.types, strict=True)], schema=shape)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(LONGEST_CELL)
        for batch in batches:
            for f, at, line, pieces in zip(*(batch.column(c).to_pylist() for c in ("file", "at", "line", "pieces")), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(([f], [at], [line], [next(csv.reader(io.StringIO("".join(pieces), newline=""), delimiter=sep))]), list(shape.types)[:4], strict=True)], names=["file", "at", "line", "cells"])

    parsed = stored(text.mapInArrow(parse, "file string, at long, line long, cells array<string>, piece string, opens boolean"), "records")
    pieces = parsed.where("piece is not null")
    opened = F.max(F.when(F.col("opens"), F.struct("at", "line"))).over(Window.partitionBy("file").orderBy("at", "line").rowsBetween(Window.unboundedPreceding, 0))
    joined = pieces.withColumn("_of", opened).groupBy("file", F.col("_of.at").alias("at"), F.col("_of.line").alias("line")).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col("at").alias("a"), F.col("line").alias("l"), "piece"))), lambda s: s["piece"]).alias("pieces"))
    records = parsed.where("piece is null").select("file", "at", "line", "cells").unionByName(joined.mapInArrow(whole, "file string, at long, line long, cells array<string>"))
    return records.join(starts.select("file", "at", "before"), ["file", "at"]).select("file", (F.col("line") + F.col("before") + 1).alias("line"), "cells")


def csv_rows(spark: SparkSession, path: str, spec: TableSpec, sep: str = ",") -> tuple[DataFrame, DataFrame, list[str]]:
    """S3: (rows, rejected, unknown columns) of CSV tables with a header, read by the header's names in any order. Rows
    have their line, the one they start at; cells may hold quoted line ends; a row with more values than the header is
    rejected with the whole row; blank lines are skipped.

    Each file's first record is its header; all files have the first one's columns. Only that header comes to the driver.
    """
    records = csv_records(spark, path, sep)
    heads = stored(records.groupBy("file").agg(F.min_by("cells", "line").alias("head"), F.min("line").alias("first")), "headers")
    heads = heads.select("file", "first", F.transform("head", F.trim).alias("head"))
    lead = heads.orderBy("file").first()
    if lead is None:
        raise ValueError(f"{path} is empty")
    names = list(lead["head"])
    lacking, unknown = column_problems(names, spec)
    if lacking:
        raise ValueError(f"columns missing: {', '.join(lacking)}")
    rows = records.join(heads, "file").where("line > first")
    long = F.size("cells") > F.size("head")
    cell = lambda n: F.get("cells", F.size("head") - F.array_position(F.reverse("head"), F.lit(n)).cast("int"))  # noqa: E731  of equal names the last
    good = rows.where(~long).select("line", *(F.nullif(F.when(F.array_contains("head", n), cell(n)), F.lit("")).alias(n) for n in names))
    return good, rows.where(long).select("line", F.array_join("cells", sep).alias("lost"), F.lit("more values than the header").alias("reason")), unknown


#: The columns of hand-written fixtures.
FIXTURES = TableSpec(required=["date", "home", "away", "feed"], optional=["time", "competition", "venue", "leadTimeDays", "dateSource", "notes", "tz"])


def manual_fixtures(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """(rows, rejected, unknown columns): cells trimmed, empty ones null, the feed as a slug, lead days as a number."""
    rows, rejected, unknown = csv_rows(spark, path, FIXTURES)
    have = [c for c in (*FIXTURES.required, *FIXTURES.optional) if c in rows.columns]
    out = rows.select("line", *(slug(c).alias(c) if c == "feed" else or_null(c).try_cast("int").alias(c) if c == "leadTimeDays" else or_null(c).alias(c) for c in have))
    return out, rejected, unknown


def tsv_rows(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Lines with as many tab-separated cells or more as there are names; the others are skipped."""
    cells = F.split("value", "\t")
    return spark.read.text(path).select(cells.alias("c")).where(F.size("c") >= len(names)).select(*(F.trim(F.col("c")[i]).alias(n) for i, n in enumerate(names)))


_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def sheet_cells(content: bytes, sheet: int = 1) -> Iterator[tuple[int, str, str]]:
    """(row, column letters, text) of the cells of an XLSX sheet that hold something."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{_MAIN}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_MAIN}si")]
        with z.open(f"xl/worksheets/sheet{sheet}.xml") as part:
            above = []
            for event, cell in ElementTree.iterparse(part, ("start", "end")):
                if event == "start":
                    above.append(cell)
                    continue
                above.pop()
                if cell.tag == f"{_MAIN}row":
                    above[-1].remove(cell)  # what has been read isn't held
                if cell.tag != f"{_MAIN}c":
                    continue
                place = cell.get("r", "")
                letters = place.rstrip("0123456789")
                value = cell.find(f"{_MAIN}v")
                text = "".join(t.text or "" for t in cell.iter(f"{_MAIN}t")) if cell.get("t") == "inlineStr" else value.text if value is not None else None
                if text is not None and place:
                    yield int(place[len(letters) :]), letters, shared[int(text)] if cell.get("t") == "s" else text


#: Cells of a sheet that are handed on at once.
CELLS = 10_000


def xlsx_cells(spark: SparkSession, path: str, sheet: int = 1) -> DataFrame:
    """File, row, col and text of the cells of XLSX files; one file is read in one Python task."""
    return cells_of(spark.read.format("binaryFile").load(path).select("path", "content"), sheet)


def cells_of(files: DataFrame, sheet: int = 1) -> DataFrame:
    """The cells of files that are rows (path, content)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("file", pa.string()), ("row", pa.int32()), ("col", pa.string()), ("text", pa.string())])
        for batch in batches:
            for i in range(batch.num_rows):
                name = batch.column("path")[i].as_py()
                cells = sheet_cells(batch.column("content")[i].as_py(), sheet)
                while some := list(islice(cells, CELLS)):
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(some)), *map(pa.array, zip(*some, strict=True))], names=kind.names).cast(kind)

    return files.mapInArrow(run, "file string, row int, col string, text string")


def sheet_columns(cells: DataFrame, header_row: int, wanted: dict[str, str]) -> DataFrame:
    """Rows under a header, by the columns whose header text holds the wanted one; each must hold in exactly one
    column, else an error. Only the header comes to the driver."""
    heads = cells.where(F.col("row") == header_row).select("col", "text").distinct().collect()
    at = {}
    for name, text in wanted.items():
        hits = [h["col"] for h in heads if text in h["text"]]
        if len(hits) != 1:
            raise ValueError(f"{text!r} heads {len(hits)} columns")
        at[name] = hits[0]
    return cells.where(F.col("row") > header_row).groupBy("file", "row").agg(*(F.max(F.when(F.col("col") == c, F.col("text"))).alias(n) for n, c in at.items()))


def excel_day(serial: Column) -> Column:
    """The day of a serial date number."""
    return F.date_add(F.lit("1899-12-30").cast("date"), serial.cast("int"))


def network_first(fresh: DataFrame | None, kept: DataFrame, age: Column) -> DataFrame:
    """The fresh answer, or where fetching failed (None) the kept one, tagged with its age."""
    if fresh is not None:
        return fresh.withColumn("age_s", F.lit(0).cast("long"))
    return kept.withColumn("age_s", age.cast("long"))


def first_found(rows: DataFrame, routes: dict[str, DataFrame], key: str) -> DataFrame:
    """The id that the first route with one gives (each (key, id)), and the route's name."""
    out = rows
    for name, df in routes.items():
        out = out.join(df.groupBy(key).agg(F.min("id").alias(f"_{name}")), key, "left")
    return out.select(*rows.columns, F.coalesce(*(f"_{n}" for n in routes)).alias("id"), F.coalesce(*(F.when(F.col(f"_{n}").isNotNull(), F.lit(n)) for n in routes)).alias("route"))
