"""Remote scans (S5, S16) and the queries that a remote engine would answer, over local tables."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.geo import drawable
from ..operators.resolve import nearest_centres
from ..storage import exists


def retried(call: Callable[[], tuple[int, bytes, str | None]], tries: int = 4, gap: float = 1.0, sleep: Callable[[float], None] = time.sleep, most: float = 300.0) -> bytes:
    """The body of the first answer with status 200. After 429, 5xx and network errors (status 0) it waits and tries
    again: as long as the answer's Retry-After says (seconds, `most` at most), else longer each time. Any other status, such
    as 403 for a token that doesn't cover what is asked for, or too many tries, raises."""
    for n in range(tries):
        status, body, after = call()
        if status == 200:
            return body
        if status not in (0, 429) and status < 500:
            break
        if n < tries - 1:
            sleep(min(most, float(after)) if after and after.strip().isdigit() else gap * 2**n)
    said = "a network error" if status == 0 else f"status {status}"
    raise OSError(f"{said} after {n + 1} tries")


class _Part(InputPartition):
    def __init__(self, ids: list[str]):
        self.ids = ids


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.url, self.batch, self.gap = options["url"], int(options.get("batch", 1)), float(options.get("gap", 1.0))
        self.ids = [x for x in options["ids"].split(",") if x]
        self.headers = json.loads(options.get("headers", "{}"))

    def partitions(self) -> list[InputPartition]:
        # one partition: the provider's rate limit is for all requests together
        return [_Part(self.ids)]

    def read(self, partition: _Part) -> Iterator[tuple]:
        for i in range(0, len(partition.ids), self.batch):
            some = "|".join(partition.ids[i : i + self.batch])
            if i:
                time.sleep(self.gap)
            yield some, retried(lambda: _got(self.url.replace("{id}", some), self.headers), gap=self.gap).decode()


def _got(url: str, headers: dict[str, str]) -> tuple[int, bytes, str | None]:
    """Status (0 for a network error), body and Retry-After of one request."""
    from urllib.error import HTTPError
    from urllib.request import Request, urlopen

    try:
        with urlopen(Request(url, headers=headers), timeout=60) as r:  # noqa: S310  the caller's address
            return r.status, r.read(), None
    except HTTPError as e:
        return e.code, b"", e.headers.get("Retry-After")
    except OSError:  # no connection, or one that broke off
        return 0, b"", None


def fetched(ids: DataFrame, key: str, url: str, path: str, batch: int = 1, gap: float = 1.0, lanes: int = 1, headers: dict[str, str] | None = None, tries: int = 4) -> DataFrame:
    """S5 and S16 with ids as rows: ids (an array) and body of every answer at path, which the call adds to.

    The ids are dealt over lanes, tasks that ask side by side; each waits gap times lanes between its requests, so
    together they keep the provider's rate. Answers are kept even if other requests fail for good: then the call raises
    after it has written, and the next one asks for what has no answer yet. Null ids are not asked for, repeated ones once.
    """
    spark, head = ids.sparkSession, headers or {}
    asked = ids.select(F.col(key).cast("string").alias("id")).where("id is not null").distinct()
    if exists(spark, path):
        asked = asked.join(spark.read.parquet(path).where("body is not null").select(F.explode("ids").alias("id")), "id", "left_anti")
    run_id = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []
        first = True

        def ask(some: list[str]) -> pa.RecordBatch:
            nonlocal first
            if not first:
                time.sleep(gap * lanes)
            first, body, error = False, None, None
            try:
                body = retried(lambda: _got(url.replace("{id}", "|".join(some)), head), tries=tries, gap=gap * lanes).decode()
            except OSError as e:
                error = str(e)
            return pa.RecordBatch.from_arrays([pa.array([some]), pa.array([body], pa.string()), pa.array([error], pa.string()), pa.array([run_id])], names=["ids", "body", "error", "run"])

        for found in batches:
            held += found.column("id").to_pylist()
            while len(held) >= batch:
                yield ask(held[:batch])
                held = held[batch:]
        if held:
            yield ask(held)

    asked.repartition(lanes, "id").mapInArrow(run, "ids array<string>, body string, error string, run string").write.mode("append").parquet(path)
    rows = spark.read.parquet(path)
    failed = rows.where((F.col("run") == run_id) & F.col("error").isNotNull()).agg(F.count("*").alias("n"), F.min("error").alias("error")).head()
    if failed["n"]:
        raise OSError(f"{failed['n']} requests failed ({failed['error']}); the other answers are kept")
    return rows.where("body is not null").select("ids", "body")


class RestSource(DataSource):
    """Format "tallymark_rest". Options url with {id}, ids by commas, batch (ids in one request), gap seconds,
    headers (a JSON object, such as one with a token).
    Rows are (id, body); a request that fails for good fails the read, so an absent answer is never an empty one."""

    @classmethod
    def name(cls) -> str:
        return "tallymark_rest"

    def schema(self) -> str:
        return "id string, body string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def consistent(rows: DataFrame, **asked: str) -> DataFrame:
    """the rows, if all carry the league, season or whatever was asked for; else the whole answer is refused."""
    wrong = rows.where(~_all(asked)).limit(1).count()
    if wrong:
        raise ValueError(f"the answer holds rows of something else than {json.dumps(asked)}")
    return rows


def _all(asked: dict[str, str]) -> Column:
    out = F.lit(True)
    for c, v in asked.items():
        out = out & F.coalesce(F.col(c).cast("string") == str(v), F.lit(False))
    return out


def clubs_in_leagues(clubs: DataFrame, leagues: DataFrame, people: DataFrame, dissolved: DataFrame, venues: DataFrame) -> DataFrame:
    """Clubs (id, league, venue, lat, lon) of the leagues listed, neither persons nor dissolved; the position is the
    venue's, else the club's own."""
    v = venues.select(F.col("id").alias("_v"), F.col("name").alias("venue_name"), F.col("lat").alias("_vlat"), F.col("lon").alias("_vlon"))
    out = clubs.join(leagues.select("league"), "league", "left_semi").join(people.select("id"), "id", "left_anti").join(dissolved.select("id"), "id", "left_anti")
    return out.join(v, F.col("venue") == F.col("_v"), "left").select("id", "league", "venue", "venue_name", F.coalesce("_vlat", "lat").alias("lat"), F.coalesce("_vlon", "lon").alias("lon"))


def league_sizes(clubs: DataFrame, people: DataFrame, dissolved: DataFrame) -> DataFrame:
    """Distinct clubs of each league, neither persons nor dissolved."""
    live = clubs.join(people.select("id"), "id", "left_anti").join(dissolved.select("id"), "id", "left_anti")
    return live.groupBy("league").agg(F.count_distinct("id").alias("clubs"))


def suppressed(statements: DataFrame, visible: DataFrame, leagues: DataFrame) -> DataFrame:
    """Ids whose league shows only at deprecated rank, or beside a preferred statement without value, and that the
    plain query doesn't show. statements: id, value, rank, snaktype."""
    tracked = statements.join(leagues.select(F.col("league").alias("value")), "value", "left_semi")
    valueless = statements.where("rank = 'preferred' and snaktype <> 'value'").select("id").distinct()
    both = tracked.where("rank = 'deprecated'").select("id", F.lit("deprecated").alias("pattern")).unionByName(tracked.join(valueless, "id", "left_semi").select("id", F.lit("no-value").alias("pattern")))
    return both.distinct().join(visible.select("id"), "id", "left_anti")


def existence_flags(rows: DataFrame, key: str, **tables: DataFrame) -> DataFrame:
    """For each table whether it has the row's key."""
    out = rows
    for name, df in tables.items():
        k = df.select(F.col(key).alias(f"_{name}")).distinct()
        out = out.join(k, F.col(key) == F.col(f"_{name}"), "left").withColumn(name, F.col(f"_{name}").isNotNull()).drop(f"_{name}")
    return out


def places_around(centres: DataFrame, places: DataFrame, metres: float, key: str, place: str) -> DataFrame:
    """The union of the places around each centre, with the nearest centre's distance; both have lat and lon."""
    return nearest_centres(centres, places, metres, ("lat", "lon"), ("lat", "lon"), key, place)


def trapped(parts: list[DataFrame], least: int = 2) -> DataFrame:
    """Over the union of parts (group, id, a, b): distinct ids, any a and any b; only groups with so many ids and a b."""
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return both.groupBy("group").agg(F.count_distinct("id").alias("ids"), F.min("a").alias("a"), F.min("b").alias("b")).where((F.col("ids") >= least) & F.col("b").isNotNull())


def tagged(statements: DataFrame, leagues: DataFrame, labels: DataFrame) -> DataFrame:
    """Statements of any rank naming a league, with start, end and label where there are."""
    return statements.join(leagues.select(F.col("league").alias("value")), "value", "left_semi").join(labels.select("id", "label"), "id", "left")


def pointers(edges: DataFrame, targets: DataFrame, predicates: list[str]) -> DataFrame:
    """The edges (source, predicate, target) by one of the predicates at one of the targets."""
    return edges.where(F.col("predicate").isin(*predicates)).join(targets.select("target").distinct(), "target", "left_semi")


def flat_elements(elements: DataFrame, excluded: Column) -> tuple[DataFrame, DataFrame]:
    """(points, dropped) of elements (lat, lon, center struct): its own position, else its centre's; excluded holds
    the reason to drop one, or null."""
    out = elements.select("*", F.coalesce("lat", F.col("center")["lat"]).alias("_lat"), F.coalesce("lon", F.col("center")["lon"]).alias("_lon"), excluded.alias("reason"))
    out = out.drop("lat", "lon", "center").withColumnsRenamed({"_lat": "lat", "_lon": "lon"})
    out = out.withColumn("reason", F.coalesce("reason", F.when(~drawable("lat", "lon"), F.lit("no position"))))
    return out.where("reason is null").drop("reason"), out.where("reason is not null")


def not_an_entity(kinds: Column, name: Column, bad_kinds: list[str], bad_name: str) -> Column:
    """why a row is no entity: a kind that holds one of the words, or its name; else null."""
    hit = F.get(F.filter(kinds, lambda k: F.lower(k).rlike("|".join(bad_kinds))), F.lit(0))
    return F.when(hit.isNotNull(), F.concat(F.lit("kind "), hit)).when(name.rlike(bad_name), F.lit("name"))


def in_word_set(key_words: Column, words: list[str]) -> Column:
    """whether one of the words is in the set."""
    return F.arrays_overlap(key_words, F.array(*map(F.lit, words)))


def not_that_sport(sports: Column, wanted: list[str], name_key: Column, bad_name: str) -> Column:
    """why a place is none of the sport's: its sport cell (parts at ; or ,) has others only, or its name; else null."""
    parts = F.filter(F.transform(F.split(F.coalesce(sports, F.lit("")), "[;,]"), lambda s: F.lower(F.trim(s))), lambda s: s != "")
    return F.when((F.size(parts) > 0) & ~F.arrays_overlap(parts, F.array(*map(F.lit, wanted))), F.lit("sport")).when(F.coalesce(name_key, F.lit("")).rlike(bad_name), F.lit("name"))
