"""Sinks (K1 to K9): deterministic files, kept snapshots, partial overwrites, calendars.

Everything is written by Spark's writers under paths that Spark can reach; what replaces a good snapshot is written
whole before it is read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .functions.dates import exclusive_end
from .functions.textkeys import row_hash
from .storage import exists, moved_into_place

#: What one published JSON document may hold of rows, in characters.
MOST_BYTES = 256 << 20


def envelope_json(rows: DataFrame, path: str, order: list[str], field: str, **head: str) -> None:
    """K1: a JSON document with the head's fields and the rows in order, keys sorted, no time of writing, so equal input
    gives equal bytes. The rows end in one document, so more than MOST_BYTES of them are refused."""
    item = F.struct(*(F.col(c) for c in sorted(rows.columns)))
    size = rows.agg(F.sum(F.length(F.to_json(item)))).first()[0] or 0
    if size > MOST_BYTES:
        raise ValueError(f"{size} characters of rows are too many for one document")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(F.struct(*order).alias("k"), item.alias("v")))), lambda s: s["v"])
    fields = {**{k: F.lit(v) for k, v in head.items()}, field: ordered}
    rows.agg(F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields))), {"ignoreNullFields": "false"}).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def kept_last_good(fresh: DataFrame, failed: DataFrame, previous: DataFrame, key: str) -> DataFrame:
    """K2: fresh rows; for keys whose fetch failed the previous rows, tagged last_fetch_failed."""
    old = previous.join(failed.select(key).distinct(), key, "left_semi").join(fresh.select(key).distinct(), key, "left_anti")
    return fresh.withColumn("last_fetch_failed", F.lit(False)).unionByName(old.withColumn("last_fetch_failed", F.lit(True)))


def partial_overwrite(rows: DataFrame, complete: DataFrame, path: str, partition: str) -> None:
    """K3: replaces the partitions that complete lists and leaves every other one as it is; where nothing is written yet
    all rows are, partial or not."""
    if exists(rows.sparkSession, path):
        rows = rows.join(complete.select(partition).distinct(), partition, "left_semi")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def replaced(rows: DataFrame, path: str) -> None:
    """The table at path with these rows instead: written beside it, then moved into its place, so a write that fails
    leaves the last good one. rows may read what is at path."""
    fresh = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
    rows.write.parquet(fresh)
    moved_into_place(rows.sparkSession, fresh, path)


def all_or_nothing(rows: DataFrame, wanted: DataFrame, key: str, path: str) -> bool:
    """K4: replaces the table only if rows has every wanted key, or nothing is there yet; says whether it wrote."""
    lacking = wanted.select(key).distinct().join(rows.select(key).distinct(), key, "left_anti").limit(1).count()
    if lacking and exists(rows.sparkSession, path):
        return False
    replaced(rows, path)
    return True


def table_digest(rows: DataFrame, columns: list[str]) -> str:
    """An order-free digest of the columns, from sums of row hashes."""
    h = row_hash(columns, 16)
    got = rows.agg(F.count("*").alias("n"), F.sum(F.conv(h, 16, 10).cast("decimal(38,0)")).alias("s")).first()
    return f"{got['n']}:{got['s']}"


def write_if_changed(rows: DataFrame, path: str, columns: list[str]) -> bool:
    """K5: replaces the table unless its columns hold the same rows; says whether it wrote."""
    spark = rows.sparkSession
    if exists(spark, path) and table_digest(spark.read.parquet(path), columns) == table_digest(rows, columns):
        return False
    replaced(rows, path)
    return True


def escaped(x: Column) -> Column:
    """K6: a text as an iCalendar value."""
    out = F.coalesce(x.cast("string"), F.lit(""))
    for a, b in (("\\", "\\\\"), (";", "\\;"), (",", "\\,"), ("\r\n", "\\n"), ("\n", "\\n"), ("\r", "\\n")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def folded_line(line: str, octets: int = 75) -> str:
    """K6: a line broken before it exceeds the octets, never inside a character; further lines start with a space."""
    out, now, left = [], "", octets
    for c in line:
        n = len(c.encode())
        if n > left:
            out.append(now)
            now, left = "", octets - 1
        now += c
        left -= n
    return "\r\n ".join([*out, now])


def event_lines(events: DataFrame) -> DataFrame:
    """K6: events with lines, an array. Columns: uid, dtstamp, sequence, start, end (days), summary, location,
    description, lead_days; an end is written exclusively, an alarm where there are lead days."""
    ymd = lambda d: F.date_format(d, "yyyyMMdd")
    alarm = F.array(F.lit("BEGIN:VALARM"), F.lit("ACTION:DISPLAY"), F.concat(F.lit("TRIGGER;RELATED=START:-P"), F.col("lead_days").cast("string"), F.lit("D")), F.concat(F.lit("DESCRIPTION:"), escaped(F.col("summary"))), F.lit("END:VALARM"))
    lines = F.concat(
        F.array(
            F.lit("BEGIN:VEVENT"),
            F.concat(F.lit("UID:"), F.col("uid")),
            F.concat(F.lit("DTSTAMP:"), F.col("dtstamp")),
            F.concat(F.lit("SEQUENCE:"), F.col("sequence").cast("string")),
            F.concat(F.lit("DTSTART;VALUE=DATE:"), ymd("start")),
            F.concat(F.lit("DTEND;VALUE=DATE:"), ymd(exclusive_end("end"))),
            F.lit("TRANSP:TRANSPARENT"),
            F.concat(F.lit("SUMMARY:"), escaped(F.col("summary"))),
        ),
        F.when(F.coalesce("location", F.lit("")) != "", F.array(F.concat(F.lit("LOCATION:"), escaped(F.col("location"))))).otherwise(F.array().cast("array<string>")),
        F.array(F.concat(F.lit("DESCRIPTION:"), escaped(F.col("description")))),
        F.when(F.col("lead_days").isNotNull(), alarm).otherwise(F.array().cast("array<string>")),
        F.array(F.lit("END:VEVENT")),
    )
    return events.withColumn("lines", lines)


def calendars(feeds: DataFrame, events: DataFrame, feed: str = "feed", name: str = "name") -> DataFrame:
    """K6 and K7: the calendars of feeds, in pieces: a head, a piece for each event and a foot, lines folded and parted by
    CR LF. Columns: feed, part (0 head, 1 event, 2 foot), start, uid, text; a calendar is its feed's texts in the order of
    part, start and uid, each with a line end. No row or task holds a calendar. Feeds without events have calendars too;
    events of other feeds are left out, see skip_report()."""
    head = F.array(F.lit("BEGIN:VCALENDAR"), F.lit("VERSION:2.0"), F.lit("PRODID:-//tallymark//calendar//EN"), F.lit("CALSCALE:GREGORIAN"), F.lit("METHOD:PUBLISH"), F.concat(F.lit("X-WR-CALNAME:"), escaped(F.col(name))))
    none = [F.lit(None).cast("date").alias("start"), F.lit(None).cast("string").alias("uid")]
    tops = feeds.select(feed, F.lit(0).alias("part"), *none, head.alias("lines"))
    feet = feeds.select(feed, F.lit(2).alias("part"), *none, F.array(F.lit("END:VCALENDAR")).alias("lines"))
    bodies = event_lines(events.join(feeds.select(feed).distinct(), feed, "left_semi")).select(feed, F.lit(1).alias("part"), "start", F.col("uid").cast("string").alias("uid"), "lines")
    kind = feeds.schema[feed].dataType.simpleString()

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = ["\r\n".join(map(folded_line, lines)) for lines in batch.column("lines").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(text, pa.string())], names=[*batch.schema.names[:-1], "text"])

    return tops.unionByName(bodies).unionByName(feet).mapInArrow(fold, f"{feed} {kind}, part int, start date, uid string, text string")


def split_by_feed(pieces: DataFrame, path: str, feed: str = "feed") -> DataFrame:
    """K7: a folder for each feed with its calendar: files whose texts, in the order of their names, are the document. The
    pieces are dealt by ranges of feed and place, so a large feed is several files of many tasks. Returns the manifest:
    feed, place (from 1), file, bytes, and events."""
    order = [feed, "part", "start", "uid"]
    ranged = pieces.repartitionByRange(*order).sortWithinPartitions(*order).select(feed, "text")
    ranged.write.mode("overwrite").option("lineSep", "\r\n").partitionBy(feed).text(path)
    lines = pieces.sparkSession.read.option("lineSep", "\r\n").text(path).select(feed, F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("bytes"), "value")
    files = lines.groupBy(feed, "file").agg(F.first("bytes").alias("bytes"), F.count_if(F.col("value") == "BEGIN:VEVENT").alias("events"))
    return files.withColumn("place", F.row_number().over(Window.partitionBy(feed).orderBy("file"))).select(feed, "place", "file", "bytes", "events")


def skip_report(events: DataFrame, key: str, reason: Column) -> tuple[DataFrame, DataFrame]:
    """K8: (emitted, skipped): every entity that isn't emitted, with its reason; sorted by key when shown."""
    out = events.withColumn("reason", reason)
    return out.where("reason is null").drop("reason"), out.where("reason is not null").select(key, "reason").orderBy(key)


EVIDENCE = ["kind", "tier", "id", "label", "evidence_url", "evidence_text", "detail"]


def write_proposals(evidence: DataFrame, path: str) -> None:
    """K9: evidence rows as CSV with a header, in order of kind, tier and id."""
    evidence.select(*EVIDENCE).orderBy("kind", "tier", "id", "evidence_url").write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def proposals_markdown(evidence: DataFrame) -> DataFrame:
    """K9: one line of text for each row, under a heading line for each kind; position orders them."""
    cell = lambda c: F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("|"), F.lit("\\|"))
    rows = evidence.select("kind", F.row_number().over(Window.partitionBy("kind").orderBy("tier", "id", "evidence_url")).alias("position"), F.concat(F.lit("| "), F.concat_ws(" | ", *(cell(c) for c in EVIDENCE[1:])), F.lit(" |")).alias("line"))
    heads = evidence.select("kind").distinct().select("kind", F.lit(0).alias("position"), F.concat(F.lit("## "), F.col("kind")).alias("line"))
    return heads.unionByName(rows)
