"""Round trips, brute force and defined cases of the other operators, and the pipeline."""

import base64
import hashlib
import io
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymark.llm import archive, bitplanes, mixing, neighbours, packing, tokens
from tallymark.llm.graph import components

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes_round_trip(kind):
    for ids in (np.array([0, 1, 65535, 1 << 20, (1 << 32) - 1], "<u4"), np.zeros(7, "<u4"), np.arange(3000, dtype="<u4")):
        assert np.array_equal(bitplanes.unplaned(bitplanes.planes(ids, kind), ids.size, kind), ids)


def ids_of(text):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokens.public("word_bpe_49k.json"))
    return [*tok.encode(text or "", add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_id_files_round_trip(spark, tmp_path, monkeypatch, kind):
    monkeypatch.setattr(bitplanes, "SEGMENT_IDS", 500)
    monkeypatch.setattr(bitplanes, "BLOCK", 128)
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(40).collect()] + [(None, "no id"), (-5, None), (-4, ""), (-3, "same"), (-3, "same")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, part int")
    bitplanes.write_ids(df, tokens.public("word_bpe_49k.json"), str(tmp_path / "x"), kind=kind)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] or ""))
    want = [(i, ids_of(t)) for i, t in order]
    got = sorted(bitplanes.read_ids(spark, str(tmp_path / "x")).collect(), key=lambda r: (r["part"], r["seg"]))
    assert [(r["doc_id"], r["ids"]) for r in got] == want
    index = sorted(bitplanes.with_starts(bitplanes.read_index(spark, str(tmp_path / "x"))).collect(), key=lambda r: r["start"])
    at = 0
    for r, (i, ids) in zip(index, want, strict=True):
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_id_files_of_nothing(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    bitplanes.write_ids(df, tokens.public("word_bpe_49k.json"), str(tmp_path / "x"))
    assert bitplanes.with_starts(bitplanes.read_index(spark, str(tmp_path / "x"))).count() == 0


def test_cuts():
    assert packing.cuts(1024) == [(0, 1024)] and packing.cuts(1025) == [(0, 1), (1, 1024)] and packing.cuts(2048) == [(0, 1024), (1024, 1024)]


def test_best_fit_takes_the_fullest_bin():
    bins = packing.best_fit(np.array([6, 5, 4, 3, 2]), 10)
    assert [sorted(b) for b in bins] == [[0, 2], [1, 3, 4]]


def test_packing_is_whole_and_tight(spark, monkeypatch):
    monkeypatch.setattr(packing, "LEAF", 40)
    monkeypatch.setattr(packing, "FAN", 2)
    g = np.random.default_rng(1)
    rows = [(i, 0, 0, int(n), i) for i, n in enumerate(g.integers(1, 1025, 600))] + [(None, 0, 0, 5, 1)]
    df = spark.createDataFrame(rows, packing._PIECE)
    got = packing.pack(df).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"], r["length"]) for r in got) == sorted((i is not None, i, n) for i, _, _, n, _ in rows)
    bins = {}
    for r in sorted(got, key=lambda r: r["offset"]):
        assert r["offset"] == bins.get(r["sequence_id"], 0)
        bins[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(bins.values()) <= 1024
    at_once = len(packing.best_fit(np.array([r[3] for r in rows if r[3] < 1024]), 1024)) + sum(r[3] == 1024 for r in rows)
    assert len(bins) <= 1.06 * at_once  # leaves of 40 pieces against all at once


def test_packing_defined_cases(spark):
    df = spark.createDataFrame([(1, None, 1), (2, "", 1), (2, "", 1), (None, "a b", 1), (3, "word " * 3000, 1)], "doc_id long, text string, node int")
    rows = packing.packed(df, tokens.public("byte_bpe_50k.json")).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] in (1, 2)) == 3 and len([r for r in rows if r["doc_id"] == 3]) >= 3
    assert packing.packed(df.where("false"), tokens.public("byte_bpe_50k.json")).count() == 0


def arc_of(version, *records):
    return archive.arc_file(version, "a.arc", list(records))


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions_convert(version):
    body = b"HTTP/1.1 200 OK\r\n\r\nhello\nworld"
    arc = arc_of(version, ("http://a b/", "1.2.3.4", archive.CRAWLED, "text/html", body), ("http://c/", "1.2.3.4", archive.CRAWLED, "text/html", b""))
    (info, block), (f, b), (_, e) = archive.arc_records(arc)
    assert f["URL"] == "http://a%20b/" and b == body and e == b"" and info["URL"] == "filedesc://a.arc" and block.startswith(b"%d 0" % version)
    ((h, block),) = archive.warc_records(io.BytesIO(archive.to_warc(f, b)))
    assert h["warc-date"] == "2005-01-01T00:00:00Z" and block == body
    assert h["warc-payload-digest"] == "sha1:" + base64.b32encode(hashlib.sha1(b"hello\nworld").digest()).decode()
    with pytest.raises(ValueError, match="cut short|fields"):
        list(archive.arc_records(arc[:-20]))


def test_short_arc_dates():
    assert [archive.iso_date(x) for x in ("2005", "200503", "20050314", "2005031415", "20050314150926")] == ["2005-01-01T00:00:00Z", "2005-03-01T00:00:00Z", "2005-03-14T00:00:00Z", "2005-03-14T15:00:00Z", "2005-03-14T15:09:26Z"]


def test_arc_files_are_read_and_converted(spark, tmp_path):
    import gzip

    page = b"HTTP/1.1 200 OK\r\n\r\nhello"
    one = arc_of(1, ("http://a/", "1.2.3.4", archive.CRAWLED, "text/html", page), ("dns:a", "1.2.3.4", archive.CRAWLED, "text/dns", b"a. 1 IN A 1.2.3.4"))
    two = arc_of(2, ("https://b/\u00e9", "1.2.3.5", archive.CRAWLED, "text/html", page * 5000), ("ftp://c/x", "1.2.3.5", archive.CRAWLED, "text/plain", b""))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.arc").write_bytes(one)
    (tmp_path / "in" / "two.arc.gz").write_bytes(gzip.compress(two))
    rows = archive.read_arc(spark, str(tmp_path / "in")).collect()
    assert sorted((r["record_type"], r["url"]) for r in rows) == [("resource", "dns:a"), ("resource", "ftp://c/x"), ("response", "http://a/"), ("response", "https://b/\u00e9"), ("warcinfo", "filedesc://a.arc"), ("warcinfo", "filedesc://a.arc")]
    archive.convert_arc(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    got = {(r["record_type"], r["url"]): r for r in archive.read_warc(spark, str(tmp_path / "out")).collect()}
    assert len(got) == 5 and got["response", "http://a/"]["payload_bytes"] == 5 and got["warcinfo", None]["payload_bytes"] > 0
    assert got["response", "http://a/"]["payload_digest"] == archive.digest(b"hello")
    # each record can be unpacked alone, from where its member starts
    data = next((tmp_path / "out").glob("part-*")).read_bytes()
    starts = [i for i in range(len(data)) if data[i : i + 4] == b"\x1f\x8b\x08\x00"]
    alone = [zlib.decompressobj(31).decompress(data[i:]) for i in starts]
    assert sum(x.startswith(b"WARC/1.0") for x in alone) == len([x for x in alone if x]) >= 3


def _record(url, body, length=None, date="20050101000000", kind="text/html"):
    return f"{url} 1.2.3.4 {date} {kind} {len(body) if length is None else length}\n".encode() + body + b"\n"


def test_bad_arc_lines_cost_only_their_record():
    head = arc_of(1)
    good = lambda n: _record(f"http://{n}/", b"body %d\nof lines" % n)
    bad = {
        "blank in URL": (_record("http://x/a b c", b"abc"), ["http://x/a b c"]),
        "blanks in content type": (_record("http://x/", b"abc", kind="text/html; charset=x y"), ["http://x/"]),
        "no content type": (_record("http://x/", b"abc", kind=""), ["http://x/"]),
        "no length": (_record("http://x/", b"abc\nhttp: not a line\n", length="?"), []),
        "length too short": (_record("http://x/", b"abcdefgh\nijk", length=4), []),
        "length into the next line": (_record("http://x/", b"abc", length=7), []),
        "length over the next record": (_record("http://x/", b"abc", length=60), []),
        "length over the end": (_record("http://x/", b"abc", length=10**7), []),
        "length over what a row holds": (_record("http://x/", b"abc", length=10**12), []),
        "no such day": (_record("http://x/", b"abc", date="20051399000000"), []),
        "binary without a line end": (b"\x00\xff" * 100_000 + b"\n", []),
        "no line end between": (_record("http://x/", b"abc")[:-1], ["http://x/"]),
    }
    for name, (record, urls) in bad.items():
        got = list(archive.arc_scan(head + good(1) + record + good(2) + good(3)))
        assert [(f["URL"], b) for _, f, b, problem in got[1:] if not problem] == [("http://1/", b"body 1\nof lines"), *((u, b"abc") for u in urls), ("http://2/", b"body 2\nof lines"), ("http://3/", b"body 3\nof lines")], name
        lost = [at for at, _, _, problem in got if problem]
        assert lost == ([] if urls else [len(head + good(1))]), name


@pytest.mark.parametrize("content", [b"", b"\n", b"<html>", b"filedesc://a 0.0.0.0 2005 text/plain x\n", b"filedesc://a 0.0.0.0 2005 text/plain 9\n3 0 x\nURL\n\n"])
def test_other_files_are_one_problem(content):
    ((at, fields, body, problem),) = archive.arc_scan(content)
    assert at == 0 and fields is None and body == b"" and problem.startswith(("not an ARC file", "ARC version"))


def test_broken_arc_files_are_read_and_converted(spark, tmp_path):
    import gzip

    records = [f"http://{n}/p q 1.2.3.4 20050101000000 text/html 200 - - 0 a.arc {len(b)}\n".encode() + b + b"\n" for n, b in enumerate([b"x" * 50, bytes(range(256)) * 300, b"z"])]
    members = [gzip.compress(x) for x in [arc_of(2), *records]]
    members[2] = members[2][:100] + b"\xff" * 40 + members[2][140:]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "broken.arc.gz").write_bytes(b"".join(members))
    (tmp_path / "in" / "latin.arc").write_bytes(arc_of(1) + b"http://b/\xe9 1.2.3.4 20050101000000 text/html 1\n!\n")
    (tmp_path / "in" / "none.arc").write_bytes(b"nothing of the kind")
    rows = archive.read_arc(spark, str(tmp_path / "in")).collect()
    assert {r["url"] for r in rows if not r["problem"]} == {"filedesc://a.arc", "http://0/p q", "http://2/p q", "http://b/%E9"}
    told = {(r["file"].rpartition("/")[2], r["problem"].split(" ")[0]) for r in rows if r["problem"]}
    assert ("none.arc", "not") in told and ("broken.arc.gz", "broken") in told
    archive.convert_arc(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    got = archive.read_warc(spark, str(tmp_path / "out")).collect()
    assert sorted(r["url"] for r in got if r["url"]) == ["http://0/p%20q", "http://2/p%20q", "http://b/%E9"]


def test_gzip_members_are_read_as_they_come():
    import gzip

    data = [bytes([i]) * 100_000 for i in range(3)]
    packed = b"".join(map(gzip.compress, data))
    assert io.BufferedReader(archive.Unzipped(memoryview(packed))).read() == b"".join(data)


def test_warc_round_trip_and_defined_cases(spark, tmp_path):
    rows = [(1, "http://a/", "same"), (2, "http://b/", "same"), (3, None, None), (4, "u v\n", ""), (5, "http://c/", "é" * 9), (None, "http://n/", "same"), (5, "http://c/", "é" * 9), (6, "http://d/", "x\r\n\r\ny")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, refers_to string")
    archive.write_warc(df, str(tmp_path / "w"))
    got = archive.read_warc(spark, str(tmp_path / "w")).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got}
    assert (by[1]["record_type"], by[1]["refers_to"], by[2]["record_type"]) == ("revisit", 2, "response")
    assert (by[3]["record_type"], by[3]["refers_to"], by[4]["record_type"]) == ("revisit", 4, "response") and by[3]["payload_bytes"] == 0
    assert by[1]["refers_to_record"] == by[2]["record_id"] and by[3]["refers_to_record"] == by[4]["record_id"] and by[2]["refers_to_record"] is None
    assert by[None]["record_type"] == "response" and by[5]["payload_bytes"] == 18 and by[6]["payload_bytes"] == 6
    archive.write_warc(df.where("false"), str(tmp_path / "e"))
    assert archive.read_warc(spark, str(tmp_path / "e")).count() == 0


def recall_of(got, ids, x):
    hits = n = 0
    for q, rows in got.items():
        d = np.sqrt(((x - x[ids.tolist().index(q)]) ** 2).sum(1))
        d[ids == q] = np.inf
        by = dict(zip(ids.tolist(), d.tolist(), strict=True))
        rows = sorted(rows, key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, 11)) and [(r["score"], r["vec_id"]) for r in rows] == sorted((r["score"], r["vec_id"]) for r in rows)
        assert all(abs(r["score"] - by[r["vec_id"]]) < 1e-12 for r in rows)
        hits += sum(r["score"] <= np.sort(d)[9] + 1e-12 for r in rows)
        n += 10
    return hits / n


def answers(df):
    got = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r["query_id"], []).append(r)
    return got


def test_neighbours_reach_the_recall(spark, monkeypatch):
    """Vectors without structure over several shards, then the given ones."""
    monkeypatch.setattr(neighbours, "SHARD", 1500)
    x = np.random.default_rng(2).standard_normal((5000, 64)).astype(np.float32)
    got = answers(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>"))
    assert len(got) == 50 and recall_of(got, np.arange(5000), x.astype(float)) >= 0.85
    monkeypatch.undo()
    given = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = given.select("vec_id", "embedding").collect()
    got = answers(given)
    assert len(got) == len([r for r in rows if r["vec_id"] % 100 == 0])
    assert recall_of(got, np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)) >= 0.9


def test_neighbours_compare_a_share(monkeypatch):
    """What is compared by exact distances, and that clustered vectors need less of it."""
    g = np.random.default_rng(4)
    centres = g.standard_normal((40, 64))
    x = np.concatenate([c + 0.3 * g.standard_normal((100, 64)) for c in centres])
    forest = neighbours.Forest(np.arange(4000), x)
    for share, least in ((neighbours.CANDIDATES, 0.99), (0.05, 0.95)):
        hits = 0
        for q, near in zip(range(0, 4000, 100), forest.candidates(x[::100], share, 40), strict=True):
            assert near.size <= share * 4000
            d = ((x - x[q]) ** 2).sum(1)
            hits += np.isin(np.argsort(d)[:11], near).sum()
        assert hits >= least * 11 * 40
    router = neighbours.Router(64, {int(c): int(n) for c, n in zip(*np.unique(neighbours_cells(x), return_counts=True), strict=True)}, 0, 0.3)
    assert all(len(v) <= router.end for v in router.visits(x[:50]))


def neighbours_cells(x):
    return ((x @ neighbours.projections(neighbours.CELL_BITS, x.shape[1], neighbours._SEED).T > 0) << np.arange(neighbours.CELL_BITS - 1, -1, -1)).sum(axis=1)


def test_leaves_hold_every_cell():
    counts = {0: 5, 1: 5, 4: 1, 2048: 30, 4095: 2}
    found = neighbours.leaves_of(counts, 6)
    assert sum(n for *_, n in found) == 43 and (2048, 12, 30) in found
    spans = sorted((p << (12 - n), (p + 1) << (12 - n)) for p, n, _ in found)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_neighbours_of_a_common_vector(spark, monkeypatch):
    """More equal vectors than a shard holds; of equals the smaller vec_id."""
    monkeypatch.setattr(neighbours, "SHARD", 50)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(300)] + [(1000, [3.0, -1.0, 0.5])]
    got = answers(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert all(r["score"] == 0 for q in (0, 100, 200) for r in got[q]) and len(got[1000]) == 10


def test_neighbours_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (2, [0.0, 1.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0, 2.0, 3.0]), (9, []), (None, [1.0, 1.0])]
    df = spark.createDataFrame([(*r, 5) for r in rows], "vec_id long, embedding array<double>, rank int")
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in neighbours.nearest(df, F.col("vec_id") % 100 == 0).orderBy("rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 2)]
    twice = spark.createDataFrame([(0, [1.0, 0.0]), (0, [0.0, 2.0]), (1, [0.0, 1.0]), (2, [1.5, 0.0]), (2, [9.0, 0.0])], "vec_id long, embedding array<double>")
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in neighbours.nearest(twice, F.col("vec_id") % 100 == 0).orderBy("rank").collect()] == [(0, 1, 2, 0.5), (0, 2, 1, 1.0)]
    assert neighbours.nearest(df.where("false"), F.col("vec_id") % 100 == 0).count() == 0


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 150)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in range(100, 150)} == {100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_mixing_meets_the_targets(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    out = mixing.mixed(docs, labels).collect()
    total = sum(r["words"] for r in out)
    for d, w in mixing.WEIGHTS.items():
        assert abs(sum(r["rate"] * r["words"] * r[f"p_{d}"] for r in out) - w * total) < 1e-3 * total
    assert all(r["rate"] >= 0 for r in out) and sum(max(mixing.WEIGHTS, key=lambda d: r[f"p_{d}"]) == r["lang"] for r in out) > 0.8 * len(out)


def test_mixing_projects_rates_at_zero(spark):
    """One document of a domain that should vanish."""
    rows = [(10, 1.0, 0.0), (10, 0.5, 0.5), (10, 0.0, 1.0)]
    df = spark.createDataFrame(rows, "words long, p_a double, p_b double")
    steps = mixing.fit(df, ["p_a", "p_b"], [1.0, 0.0])
    rates = [r["r"] for r in df.select("p_a", mixing.rate(["p_a", "p_b"], steps).alias("r")).orderBy("p_a").collect()]
    assert rates[0] == 0 and rates[1] < 0.2 and rates[2] > 2.5


def test_mixing_uses_no_python(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    plan = mixing.repeated(docs, labels)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


def test_mixing_defined_cases(spark):
    df = spark.createDataFrame([(1, None, "en"), (2, "", "de"), (None, "a b", None), (3, "a b", "xx"), (3, "a b", "xx")], "doc_id long, text string, lang string")
    none = spark.createDataFrame([], "doc_id long")
    out = mixing.mixed(df, none).collect()
    assert len(out) == 5 and all(abs(r["p_en"] - 0.25) < 1e-9 for r in out)
    assert mixing.repeated(df, none).count() >= 5
    assert mixing.mixed(df.where("false"), none).count() == 0


def test_rates_equal_a_plain_solver(spark):
    """Posteriors from the model by hand, and the rates of projected steps in numpy."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    domains, weights = list(mixing.WEIGHTS), np.array(list(mixing.WEIGHTS.values()))
    rows = mixing.mixed(docs, labels).collect()
    model = np.array(mixing.train(docs, labels, domains, "lang"))
    few = docs.limit(30).select("doc_id", "text", F.expr("transform(filter(split(lower(coalesce(text, '')), r'[\\x20\\x09-\\x0D]+'), w -> w != ''), w -> int(pmod(xxhash64(w), 1024)))").alias("b")).collect()
    by = {r["doc_id"]: r for r in rows}
    for r in few:
        z = model[:, r["b"]].sum(axis=1) * min(1.0, mixing.CALIBRATED / max(1, len(r["b"])))
        p = np.exp(z - z.max())
        assert np.allclose([by[r["doc_id"]][f"p_{d}"] for d in domains], p / p.sum(), atol=1e-9)
    p, t = np.array([[r[f"p_{d}"] for d in domains] for r in rows]), np.array([r["words"] for r in rows], float)
    g, target, rate = (p * t[:, None]).T @ p, weights * t.sum(), np.ones(len(t))
    for _ in range(60):
        rate = np.maximum(0, rate + p @ np.linalg.solve(g, target - (rate * t) @ p))
    assert np.allclose([r["rate"] for r in rows], rate, atol=1e-4)


def test_mixing_keeps_or_replaces_clashing_columns(spark):
    df = spark.createDataFrame([(i, "a b c", lang, "w", i, 0.5, i, [i]) for i, lang in enumerate(["en", "de", "fr", "es"] * 5)], "doc_id long, text string, lang string, words string, rate int, p_en double, row int, _buckets array<int>")
    out = mixing.mixed(df, df.select("doc_id"))
    assert dict(out.dtypes)["words"] == "bigint" and dict(out.dtypes)["rate"] == "double" and "row" in out.columns and "_buckets" in out.columns
    back = mixing.repeated(df, df.select("doc_id"))
    assert back.schema.names == df.schema.names and set(map(str, back.distinct().collect())) == set(map(str, df.collect()))


def test_repeated_documents_meet_the_weights(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = mixing.repeated(docs, labels)
    assert out.select("doc_id").distinct().count() == docs.count()
    posterior = mixing.mixed(docs, labels).select("doc_id", "words", *(f"p_{d}" for d in mixing.WEIGHTS))
    total = out.select("doc_id").join(posterior, "doc_id").agg(F.sum("words").alias("n"), *(F.sum(F.col("words") * F.col(f"p_{d}")).alias(d) for d in mixing.WEIGHTS)).first()
    for d, w in mixing.WEIGHTS.items():  # whole rows are drawn, so the shares come near the weights, not to them
        assert abs(total[d] / total["n"] - w) < 0.03


def test_pieces_hold_the_librarys_ids(spark):
    from tokenizers import Tokenizer

    path = tokens.public("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()] + [(-1, None), (-2, "word " * 20_000), (-3, "<|endoftext|>")]
    rows = packing.packed(spark.createDataFrame(docs, "doc_id long, text string"), path).collect()
    ids = {i: [*tok.encode(t or "", add_special_tokens=False).ids, 2] for i, t in docs}
    for i, want in ids.items():
        mine = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["piece"])
        assert [r["piece"] for r in mine] == list(range(len(mine))) and sum(r["length"] for r in mine) == len(want)
        at = 0
        for r in mine:
            assert r["start"] == at and r["length"] <= 1024 and (r["piece"] == 0 or r["length"] == 1024)
            assert r["ids_crc32"] == zlib.crc32(np.array(want[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]


def test_equal_rows_dont_share_a_leaf(spark, monkeypatch):
    monkeypatch.setattr(packing, "LEAF", 50)
    seen = []
    node = packing._node
    monkeypatch.setattr(packing, "_node", lambda level, *a: seen.append(level) or node(level, *a))
    got = packing.pack(spark.createDataFrame([(None, 0, 0, 600, 7)] * 400, packing._PIECE).repartition(4)).collect()
    assert len({r["sequence_id"] for r in got}) == 400 and max(seen) > 0


def test_pipeline_equals_plain_python(spark, tmp_path):
    """Every stage on its own input against a plain version of it."""
    import corpus_pipeline as p
    from tallymark.llm import pii, toxicity
    from tests_plain import components as plain_components
    from tests_plain import shingle_set

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(10**6, "x y z", "en", "s", 5), (10**6, "x y z", "en", "s", 5), (10**6, "other", "en", "s", 5), (None, None, None, None, None), (None, "a b c d e f", "en", "s", 1)], docs.schema)
    rows = docs.unionByName(extra)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    names = [n for n, _ in p.STAGES]
    assert names == ["toxicity", "near_duplicates", "personal_data", "mixing", "packing"]
    stage = dict(p.STAGES)

    def kept(df, name):
        path = str(tmp_path / name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    clean = kept(stage["toxicity"](spark, rows, SF), "clean")
    w, b = toxicity.train(rows, labels)
    toxic = {i for i, r in enumerate(rows.collect()) if w[toxicity.features(r["text"] or "")].sum() + b >= 0}
    plain = [tuple(r) for i, r in enumerate(rows.collect()) if i not in toxic]
    assert sorted(map(str, map(tuple, clean.collect()))) == sorted(map(str, plain)) and len(plain) < rows.count()

    one = kept(stage["near_duplicates"](spark, clean, SF), "one")
    sets = {}
    for r in clean.collect():
        sets.setdefault(r["doc_id"], []).append(shingle_set(r["text"], 5))
    whole = {(i, k): s for i, ss in sets.items() if i is not None for k, s in enumerate(ss)}
    for i, ss in sets.items():  # rows of one doc_id are one node
        for k in range(1, len(ss)) if i is not None else ():
            whole[i, k] = whole[i, k] or whole[i, 0]
    group = plain_components(whole, 80)
    want = {i for (i, k), (least, _) in group.items() if least == i and k == 0}
    assert {r["doc_id"] for r in one.collect()} == want | {None} and one.where("doc_id is null").count() == 2
    assert one.where("doc_id is not null").count() == len(want)

    safe = kept(stage["personal_data"](spark, one, SF), "safe")
    assert sorted(str((r["doc_id"], r["text"] and pii.redacted(r["text"]))) for r in one.collect()) == sorted(str((r["doc_id"], r["text"])) for r in safe.collect())

    mixed_rows = kept(stage["mixing"](spark, safe, SF), "mixed")
    assert mixed_rows.columns == docs.columns
    assert mixed_rows.where("doc_id is not null").distinct().count() == safe.where("doc_id is not null").distinct().count()

    sequences = stage["packing"](spark, mixed_rows, SF).collect()
    bins = {}
    for r in sorted(sequences, key=lambda r: r["offset"]):
        assert r["offset"] == bins.get(r["sequence_id"], 0)
        bins[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(bins.values()) <= 1024
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokens.public("byte_bpe_50k.json"))
    assert sum(bins.values()) == sum(len(tok.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in mixed_rows.collect())
    for name in names:
        assert stage[name](spark, docs.where("false"), SF).count() == 0


def test_mixing_parts_words_at_any_white_space(spark):
    df = spark.createDataFrame([(1, "A\nb\tc d", "en"), (2, " a  b\r\nc\x0b\x0cd\n", "en"), (3, "a b c d", "en"), (4, "\n\t", "de"), (5, "e\u00a0f", "de")], "doc_id long, text string, lang string")
    model = mixing.train(df, df.select("doc_id"), ["en", "de"], "lang")
    out = {r["doc_id"]: r for r in mixing.with_posteriors(df, model, ["p_en", "p_de"]).collect()}
    assert [out[i]["words"] for i in range(1, 6)] == [4, 4, 4, 0, 1]
    assert out[1]["p_en"] == out[2]["p_en"] == out[3]["p_en"] > 0.5


def test_mixing_tells_of_missed_targets(spark, monkeypatch):
    import warnings

    monkeypatch.setattr(mixing, "STEPS", 2)
    mixed = spark.createDataFrame([(10, 1.0, 0.0), (10, 0.5, 0.5), (10, 0.0, 1.0)], "words long, p_a double, p_b double")
    with pytest.warns(UserWarning, match=r"miss the targets by 0\.[0-9]+ of all words after 2 steps"):
        mixing.fit(mixed, ["p_a", "p_b"], [1.0, 0.0])
    apart = spark.createDataFrame([(10, 1.0, 0.0), (10, 0.0, 1.0)], "words long, p_a double, p_b double")
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        mixing.fit(apart, ["p_a", "p_b"], [0.8, 0.2])
