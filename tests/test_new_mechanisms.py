"""Searches over cells, overlaps, collapsing and chunked files against plain versions."""

import csv
import io
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallymark.operators import globe
from tallymark.operators import quality as Q
from tallymark.operators import ranking as W
from tallymark.operators import resolve as J
from tallymark.operators.quality import TableSpec
from tallymark.operators.summary import largest_spread
from tallymark.sources import files as S


def metres(a, b, c, d):
    a, b, c, d = map(math.radians, (a, b, c, d))
    return 2 * 6_371_000.0 * math.asin(math.sqrt(min(1.0, math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2)))


def scattered(rng, n, lat=(-90, 90), lon=(-180, 180)):
    return [(rng.uniform(*lat), rng.uniform(*lon)) for _ in range(n)]


def test_largest_spread_equals_brute_force(spark):
    rng = random.Random(1)
    groups = {
        "globe": scattered(rng, 1500),
        "country": scattered(rng, 400, (45, 48), (5, 15)),
        "across": scattered(rng, 200, (-1, 1), (179, 180)) + scattered(rng, 200, (-1, 1), (-180, -179)),
        "circle": [(60.0, x * 1.5) for x in range(240)],
        "pole": [(90.0, 5.0), (89.9, 100.0), (89.9, -80.0)],
        "one": [(1.0, 1.0)],
        "same": [(1.0, 1.0)] * 50,
        "none": [(None, 3.0), (float("nan"), 1.0)],
        None: [(0.0, 0.0), (0.0, 1.0)],
    }
    rows = [(g, a, o, "x") for g, pts in groups.items() for a, o in pts]
    got = dict(map(tuple, largest_spread(spark.createDataFrame(rows, "g string, lat double, lon double, cell string"), "g", "lat", "lon").collect()))
    for g, pts in groups.items():
        pts = sorted({p for p in pts if p[0] is not None and p[0] == p[0]})
        want = max((metres(*p, *q) for i, p in enumerate(pts) for q in pts[:i]), default=0.0)
        assert got[g] == pytest.approx(want, abs=0.5), g


def test_nearest_reaches_any_distance(spark):
    rng = random.Random(2)
    left = [(i, *p) for i, p in enumerate(scattered(rng, 150) + [(89.99, 10.0), (-90.0, 0.0), (0.0, 180.0), (0.0, -180.0)])] + [(900, None, 1.0), (901, 2.0, None)]
    right = [(i, *p) for i, p in enumerate(scattered(rng, 700, (40, 60), (-10, 30)) + [(-33.0, 151.0)] + [(50.0, 8.0)] * 60)] + [(5000, None, None)]
    a, b = spark.createDataFrame(left, "a long, la double, oa double"), spark.createDataFrame(right, "b long, lb double, ob double")
    got = {r["a"]: r for r in J.nearest_within(a, b, 100_000, ("la", "oa"), ("lb", "ob"), "a", "b").collect()}
    for i, la, oa in left:
        if la is None or oa is None:
            assert got[i]["metres"] is None and got[i]["b"] is None
            continue
        want, who = min((metres(la, oa, lb, ob), j) for j, lb, ob in right if lb is not None)
        assert got[i]["metres"] == pytest.approx(want, abs=0.01)
        assert (got[i]["b"] is not None) == (want <= 100_000) and (got[i]["b"] in (None, who) or want == pytest.approx(metres(la, oa, got[i]["lb"], got[i]["ob"])))
    assert J.nearest_within(a, b.limit(0), 1000, ("la", "oa"), ("lb", "ob"), "a", "b").where("metres is not null").count() == 0


def test_cells_bound_their_points(spark):
    rng = random.Random(3)
    pts = spark.createDataFrame(scattered(rng, 500), "lat double, lon double")
    on = globe.on_globe(pts, "lat", "lon")
    for level in (2, 5, 9):
        cells = globe.cells(on, [], level)
        assert cells.agg(F.sum("c.n")).first()[0] == 500
        xy, z = globe.cell_of(level)
        out = on.withColumn("xy", xy).withColumn("z", z).join(cells, ["xy", "z"]).where(globe._angle(F.col("_p"), F.col("c.centre")) > F.col("c.reach") + 1e-9)
        assert out.count() == 0


def test_overlaps_equal_all_pairs(spark):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        s = rng.randint(-400, 3000)
        rows.append((i, rng.choice(["AT", "DE", None]), s, s + rng.choice([0, 0, 1, 5, 30, 400, 2500])))
    rows += [(301, "AT", 5, 4), (302, "AT", None, 4), (303, "DE", 1023, 1024), (304, "DE", 1024, 1024)]
    df = spark.createDataFrame(rows, "row long, country string, s int, e int").select("row", "country", F.date_add(F.lit("1970-01-01").cast("date"), F.col("s")).alias("s"), F.date_add(F.lit("1970-01-01").cast("date"), F.col("e")).alias("e"))
    ok = [r for r in rows if r[2] is not None and r[3] >= r[2]]
    for scope in ([], ["country"]):
        want = sorted((a[0], b[0]) for a in ok for b in ok if a[0] < b[0] and a[2] <= b[3] and b[2] <= a[3] and (not scope or a[1] == b[1]))
        got = sorted(map(tuple, Q.overlapping(df, "s", "e", "row", scope).collect()))
        assert got == want
        totals = Q.overlap_totals(df, "s", "e", scope).collect()
        assert sum(r["overlaps"] for r in totals) == len(want) and sum(r["rows"] for r in totals) == len(ok)
    per = Counter(next(r[1] for r in rows if r[0] == a) for a, _ in want)
    assert {r["country"]: r["overlaps"] for r in totals} == dict(per)


def walked(rows, m):
    """Each kept row's id with the strongest strength of what joined it: the plain walk."""
    kept = []
    for key, ref, lat, lon, s, order in sorted(rows, key=lambda r: (r[5] is None, r[5], r[1] is None, r[1] or "")):
        for k in kept:
            near = None not in (lat, lon, k[2], k[3]) and metres(lat, lon, k[2], k[3]) <= m
            if k[0] == key and ((ref is not None and ref == k[1]) or near):
                k[4] = min(k[4], s)
                break
        else:
            kept.append([key, ref, lat, lon, s, order])
    return sorted(map(tuple, kept), key=str)


@pytest.mark.parametrize("walk_rows", [50_000, 0])
def test_collapse_equals_the_walk(spark, monkeypatch, walk_rows):
    monkeypatch.setattr(W, "WALK_ROWS", walk_rows)
    rng = random.Random(5)
    order = list(range(460))
    rng.shuffle(order)
    rows = []
    for n in order:
        spot = rng.choice([(50.0, 8.0), (89.9995, 20.0), (0.0, 179.9995), (0.0, -179.9995), (-90.0, 3.0)])
        lat, lon = max(-90.0, min(90.0, spot[0] + rng.uniform(-0.004, 0.004))), spot[1] + rng.uniform(-0.004, 0.004)
        lon = lon - 360 if lon > 180 else lon + 360 if lon < -180 else lon
        if n % 11 == 0:
            lat = None
        rows.append((rng.choice(["k1", "k2", None]), rng.choice([None, None, f"r{rng.randint(1, 90)}"]), lat, lon, rng.randint(0, 9), n))
    rows += [("line", None, 50.0, 8.0 + i * 0.001, 9 - i % 5, 1000 + i) for i in range(40)] + [("line", "far", 50.2, 8.0, 4, 3000), ("line", "far", None, None, 1, 3001), ("line", None, None, None, 1, 3002)]
    df = spark.createDataFrame(rows, "k string, ref string, lat double, lon double, s int, o int")
    got = sorted(map(tuple, W.collapsed(df, "k", "ref", "lat", "lon", "s", "o", 200.0).collect()), key=str)
    assert got == walked(rows, 200.0)
    assert W.collapsed(df.limit(0), "k", "ref", "lat", "lon", "s", "o").count() == 0


def test_collapse_across_the_date_line_and_poles(spark):
    rows = [("k", "a", 10.0, 179.9999, 2, 1), ("k", "b", 10.0, -179.9999, 1, 2), ("k", "c", 89.9999, 0.0, 3, 3), ("k", "d", 89.9999, 180.0, 0, 4), ("k", "e", None, None, 5, 5)]
    got = W.collapsed(spark.createDataFrame(rows, "k string, ref string, lat double, lon double, s int, o int"), "k", "ref", "lat", "lon", "s", "o")
    assert sorted((r["ref"], r["s"]) for r in got.collect()) == [("a", 1), ("c", 0), ("e", 5)]


def plain_csv(text):
    reader, out, line = csv.reader(io.StringIO(text, newline="")), [], 1
    for cells in reader:
        if any(c.strip() for c in cells):
            out.append((line, cells))
        line = reader.line_num + 1
    return out


def test_csv_in_chunks_equals_the_reader(spark, tmp_path):
    rng = random.Random(6)
    texts = {}
    for k in range(6):
        rows = ["a,b,c"]
        for i in range(120):
            cell = lambda: rng.choice(["plain", "", '"quoted, one"', '"line\nend"', '"two ""marks"""', 'stray "mark" inside', '"end\r\nother"', '"' + "long\n" * rng.randint(1, 60) + '"', 'é']) + ""
            rows.append(rng.choice(["", "   ", ",".join(cell() for _ in range(3)), ",".join(cell() for _ in range(3)), f"{i},x,y"]))
        texts[f"f{k}.csv"] = rng.choice(["\n", "\r\n"]).join(rows) + rng.choice(["", "\n"])
    texts["bom.csv"] = '﻿"a, b",c\n1,2\n'
    texts["lone.csv"] = "a,b\r1,2\r\r3,4"
    texts["open.csv"] = 'a,b\n1,"never\nclosed'
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    small = {"spark.sql.files.maxPartitionBytes": "200", "spark.sql.files.openCostInBytes": "1"}
    was = {c: spark.conf.get(c) for c in small}
    for c, v in small.items():
        spark.conf.set(c, v)
    try:
        got = {}
        for r in S.csv_records(spark, str(tmp_path)).collect():
            got.setdefault(r["file"].rsplit("/", 1)[1], []).append((r["line"], r["cells"]))
    finally:
        for c, v in was.items():
            spark.conf.set(c, v)
    for name, text in texts.items():
        want = plain_csv(text.removeprefix("﻿"))
        if name == "open.csv":  # the reader cannot tell whether the last line had an end
            want[-1][1][-1] += "\n"
        assert sorted(got[name]) == want, name


def test_csv_of_files_with_other_orders(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n1,2\n3\n4,5,6\n")
    (tmp_path / "2.csv").write_text("\n\nb,a\nx,y\n")
    rows, rejected, unknown = S.csv_rows(spark, str(tmp_path), TableSpec(required=["a"]))
    assert sorted((r["line"], r["a"], r["b"]) for r in rows.collect()) == [(2, "1", "2"), (3, "3", None), (4, "y", "x")]
    assert [tuple(r) for r in rejected.collect()] == [(4, "4,5,6", "more values than the header")] and unknown == ["b"]


def test_change_states(spark, tmp_path):
    from tallymark.streaming import flows

    ts = lambda s: F.lit(s).cast("timestamp")
    src = str(tmp_path / "in")
    frame = lambda rows, at: spark.createDataFrame(rows, "uid string, hash string, dtstamp string").withColumn("at", ts(at)).coalesce(1)
    snapshot = spark.createDataFrame([("a", "1", "t0", 4), ("b", "1", "t0", 0), ("c", "1", "t0", 2)], "uid string, hash string, dtstamp string, sequence int").withColumn("at", ts("2030-01-01 00:00:00"))

    def run() -> list[tuple]:
        with flows.state_store(spark):
            stream = spark.readStream.schema(flows.READ).option("maxFilesPerTrigger", 1).parquet(src)
            flows.change_stream(stream, snapshot, "1 day", "1 hour", 10).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True).start().awaitTermination()
        return sorted((r["uid"], r["sequence"], r["hash"], r["change"]) for r in spark.read.schema(flows.CHANGE).parquet(str(tmp_path / "out")).collect())

    frame([("a", "1", "t1"), ("b", "2", "t1"), ("d", "1", "t1")], "2030-01-01 12:00:00").write.parquet(src)
    first = run()
    assert first == [("a", 4, "1", "same"), ("b", 1, "2", "changed"), ("d", 0, "1", "new")]  # it is too early to say that c is gone
    frame([("a", "3", "t2"), ("b", "2", "t2"), (None, None, None)], "2030-01-02 09:00:00").write.mode("append").parquet(src)
    second = run()
    assert [x for x in second if x not in first] == [("a", 5, "3", "changed"), ("b", 1, "2", "same"), ("c", 2, "1", "gone")]
    frame([("c", "1", "t3"), (None, None, None)], "2030-01-03 20:00:00").write.mode("append").parquet(src)
    third = run()
    assert sorted(x for x in third if x not in second) == [("a", 5, "3", "gone"), ("b", 1, "2", "gone"), ("c", 2, "1", "same"), ("d", 0, "1", "gone")]
    frame([("a", "3", "t4"), (None, None, None)], "2030-02-20 00:00:00").write.mode("append").parquet(src)
    assert ("a", 0, "3", "new") not in run()  # its row came before the watermark took the state away
    frame([("b", "9", "t5")], "2030-02-21 00:00:00").write.mode("append").parquet(src)
    assert ("b", 0, "9", "new") in run()  # forgotten, so it starts anew


def test_change_states_share_buckets(spark, tmp_path):
    from tallymark.streaming import flows

    k, at = F.col("id"), F.lit("2030-01-01 00:00:00").cast("timestamp")
    uid, seen = k.cast("string").alias("uid"), at.alias("at")
    snapshot = spark.range(900).select(uid, F.lit("1").alias("hash"), F.lit("t0").alias("dtstamp"), F.lit(3).alias("sequence"), seen)
    new = spark.range(600, 1000).select(uid, F.when(k % 2 == 0, "1").otherwise("2").alias("hash"), F.lit("t1").alias("dtstamp"), (at + F.expr("interval 12 hours")).alias("at"))
    end = spark.range(1).select(F.lit(None).cast("string").alias("uid"), F.lit(None).cast("string").alias("hash"), F.lit(None).cast("string").alias("dtstamp"), (at + F.expr("interval 26 hours")).alias("at"))
    new.union(end).coalesce(1).write.parquet(str(tmp_path / "in"))
    with flows.state_store(spark):
        stream = spark.readStream.schema(flows.READ).parquet(str(tmp_path / "in"))
        out = flows.change_stream(stream, snapshot, "1 day", "1 hour", 10, buckets=5)
        out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True).start().awaitTermination()
    got = spark.read.schema(flows.CHANGE).parquet(str(tmp_path / "out")).groupBy("change", "sequence").count().collect()
    assert sorted(map(tuple, got)) == [("changed", 4, 150), ("gone", 3, 600), ("new", 0, 100), ("same", 3, 150)]


def test_overwrites_keep_what_the_run_wrote(spark, tmp_path):
    from tallymark.streaming import flows

    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("old", "p1"), ("stays", "p2")], "x string, p string").write.partitionBy("p").parquet(out)
    for rows in ([("a", "p1")], [("b", "p1"), ("c", "p3")], [("d", "p3")]):
        spark.createDataFrame(rows, "x string, p string").coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema("x string, p string").option("maxFilesPerTrigger", 1).parquet(src)
    flows.overwrite_partitions(stream, out, "p", str(tmp_path / "log")).awaitTermination(120)
    assert sorted(map(tuple, spark.read.parquet(out).select("x", "p").collect())) == [("a", "p1"), ("b", "p1"), ("c", "p3"), ("d", "p3"), ("stays", "p2")]


def test_a_large_calendar_is_written_by_many_tasks(spark, tmp_path):
    from tallymark import publish as K

    feeds = spark.createDataFrame([("big", "Big"), ("none", "None"), ("quoted/feed", "x")], "feed string, name string")
    k = F.col("id")
    ev = spark.range(20_000, numPartitions=8).select(F.when(k % 500 == 0, "quoted/feed").when(k % 501 == 0, "unknown").otherwise("big").alias("feed"), F.concat(F.lit("u"), k.cast("string")).alias("uid"), F.lit("t").alias("dtstamp"), F.lit(0).alias("sequence"), F.date_add(F.lit("2030-01-01").cast("date"), (k * 7919 % 300).cast("int")).alias("start"), F.lit("2031-01-01").cast("date").alias("end"), F.lit("ä" * 50).alias("summary"), F.lit(None).cast("string").alias("location"), F.lit("d").alias("description"), F.lit(None).cast("int").alias("lead_days"))
    pieces = K.calendars(feeds, ev)
    key, was = "spark.sql.adaptive.coalescePartitions.enabled", spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set(key, "false")
    try:
        manifest = K.split_by_feed(pieces, str(tmp_path / "c")).collect()
    finally:
        spark.conf.set(key, was)
    big = sorted((r["place"], r["file"], r["bytes"], r["events"]) for r in manifest if r["feed"] == "big")
    assert len(big) > 1 and [p for p, *_ in big] == list(range(1, len(big) + 1))
    written = b"".join((tmp_path / "c" / "feed=big" / f).read_bytes() for _, f, _, _ in big)
    assert sum(b for _, _, b, _ in big) == len(written)
    small = "".join(r["text"] + "\r\n" for r in pieces.where("feed = 'big'").coalesce(1).sortWithinPartitions("part", "start", "uid").collect())
    assert written.decode() == small and sum(e for *_, e in big) == small.count("BEGIN:VEVENT") == pieces.where("feed = 'big' and part = 1").count()
    assert {r["feed"] for r in manifest} == {"big", "none", "quoted/feed"}


def test_tables_are_replaced_whole(spark, tmp_path):
    from tallymark import publish as K
    from tallymark.storage import exists

    path = str(tmp_path / "t")
    assert not exists(spark, path)
    one = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert K.write_if_changed(one, path, ["k", "v"]) and not K.write_if_changed(one.orderBy(F.desc("k")), path, ["k", "v"])
    assert K.write_if_changed(spark.read.parquet(path).withColumn("v", F.lit("c")), path, ["k", "v"])  # rows that read what they replace
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "c"), (2, "c")]
    bad = one.withColumn("v", F.raise_error(F.lit("no")))
    with pytest.raises(Exception, match="no"):
        K.replaced(bad, path)
    assert spark.read.parquet(path).count() == 2
    assert not K.all_or_nothing(one.where("k = 1"), one, "k", path) and K.all_or_nothing(one, one, "k", path)
    assert sorted(f.name for f in tmp_path.iterdir() if "before" in f.name) == []
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "_SUCCESS").touch()
    assert not exists(spark, str(tmp_path / "empty")) and K.all_or_nothing(one.where("k = 1"), one, "k", str(tmp_path / "empty"))
