"""Brute-force versions and defined cases of the operators on texts."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests_plain import components, shingle_set

from tallymark.llm import bitplanes, minhash, packing, pii, repetition, substrings, tokens, toxicity
from tallymark.llm.common import windows

SF = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (4, "one two"), (5, "one two"), (None, "one two"), (6, "x " * 30_000), (7, "Zz zZ ZZ zz")]


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, wordless, repeated and very long texts, a null id, and columns whose names clash with the operators'."""
    rows = [(i, t, "a", "b", 1.0, True) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, kept_sha256 string, spans string, score double, row boolean")


def texts_of(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def test_near_duplicates_equal_brute_force(spark):
    random.seed(4)
    docs = texts_of(spark)[:80]
    vocabulary = [f"w{i}" for i in range(400)]
    base = [random.choice(vocabulary) for _ in range(120)]
    for n in range(120):  # a group of near copies whose members aren't all near each other
        copy = [random.choice(vocabulary) if random.random() < 0.035 else w for w in base]
        docs.append((10_000 + n, " ".join(copy)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = components({i: shingle_set(t, 4) for i, t in docs}, 80)
    got = {r["doc_id"]: r for r in minhash.near_duplicates(df, k=4).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(r["kept"] == (r["component_id"] == i) and r["n_shingles"] == len(shingle_set(dict(docs)[i], 4)) for i, r in got.items())


def same_first_band(sizes):
    """Texts of nested word sets whose signatures agree in the first band, so that they surely share that bucket."""
    for n in range(10_000):
        words = [f"{n}w{i}" for i in range(max(sizes))]
        sigs = [minhash.signature(minhash.shingles(" ".join(words[:k]), 1))[: minhash.ROWS].tolist() for k in sizes]
        if all(x == sigs[0] for x in sigs):
            return [" ".join(words[:k]) for k in sizes]
    raise AssertionError("no such words")


def test_outsiders_of_a_bucket_are_compared(spark, monkeypatch):
    """One bucket whose smallest id has no link: the others' links come from the outsiders' blocks, or not at all."""
    calls = []
    monkeypatch.setattr(minhash, "BANDS", 1)
    monkeypatch.setattr(minhash, "BLOCK", 2)
    across = minhash._across
    monkeypatch.setattr(minhash, "_across", lambda *a: calls.append(a) or across(*a))
    docs = list(enumerate(same_first_band([40, 54, 57, 60, 85, 90]), 1))
    sets = {i: shingle_set(t, 1) for i, t in docs}
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), k=1).collect()}
    assert got == components(sets, 80) == {1: 1, 2: 2, 3: 2, 4: 2, 5: 5, 6: 5} and len(calls) == 1


def test_one_hub_with_many_near_copies(spark, monkeypatch):
    """A text with many different near copies, all linked through it: its rows are dealt over parts."""
    random.seed(12)
    base = [f"h{i}" for i in range(150)]
    docs = [(0, " ".join(base))]
    for n in range(1, 150):
        copy = list(base)
        copy[random.randrange(150)] = f"x{n}"
        docs.append((n, " ".join(copy)))
    got = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), k=5).collect()
    assert {r["component_id"] for r in got} == {0} and sum(r["kept"] for r in got) == 1


def test_near_duplicates_defined_cases(spark, odd):
    rows = sorted(minhash.near_duplicates(odd, k=4).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"]))
    assert len(rows) == len(ODD)
    by = {r["doc_id"]: r for r in rows}
    assert [by[i]["n_shingles"] for i in (1, 2, 3, 4, 6, 7)] == [0, 0, 0, 1, 1, 1]
    assert by[5]["component_id"] == 4 and not by[5]["kept"] and by[2]["component_id"] == 2
    assert by[None]["component_id"] is None and by[None]["kept"]
    assert minhash.near_duplicates(odd.where("false"), k=4).count() == 0


def test_bayesian_bounds():
    need = minhash.least_matches(0.8)
    assert need[-1][0] == minhash.SIZE and all(0 < m < 0.8 * n for n, m in need)
    g = np.random.default_rng(0)
    a = g.integers(0, 1 << 32, (2000, minhash.SIZE), dtype=np.uint32)
    b = np.where(g.random(a.shape) < 0.8, a, a ^ np.uint32(1))
    assert minhash.survives(a, b, need).all()
    c = np.where(g.random(a.shape) < 0.3, a, a ^ np.uint32(1))
    assert not minhash.survives(a, c, need).any()


def cut_brute(docs, window):
    first, out = {}, {}
    for i, t in sorted(docs, key=lambda x: x[0]):
        w = (t or "").encode().split()
        for j in range(len(w) - window + 1):
            k = tuple(w[j : j + window])
            first[k] = min(first.get(k, i), i)
    for i, t in docs:
        w = (t or "").encode().split()
        off = [False] * len(w)
        for j in range(len(w) - window + 1):
            if first[tuple(w[j : j + window])] < i:
                off[j : j + window] = [True] * window
        out[i] = (len(w), sum(off), hashlib.sha256(b" ".join(x for x, o in zip(w, off) if not o)).hexdigest())
    return out


@pytest.mark.parametrize("large", [3, 8192])
def test_substrings_equal_brute_force(spark, monkeypatch, large):
    monkeypatch.setattr(substrings, "LARGE", large)
    random.seed(7)
    passage = [f"p{i}" for i in range(70)]
    docs = texts_of(spark)[:120]
    for n in range(30):
        own = [f"d{n}.{i}" for i in range(random.randint(0, 90))]
        at = random.randint(0, len(own))
        docs.append((5000 + n, " ".join(own[:at] + passage[random.randint(0, 25) :][: random.randint(40, 70)] + own[at:])))
    docs.append((6000, " ".join(passage + passage)))
    got = {r["doc_id"]: tuple(r)[1:4] for r in substrings.without_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == cut_brute(docs, 50)


def test_substrings_defined_cases(spark, odd):
    rows = substrings.without_repeats(odd).collect()
    assert len(rows) == len(ODD) and all(r["n_removed"] == 0 for r in rows)
    assert {r["n_words"] for r in rows if r["doc_id"] in (1, 2, 3)} == {0}
    assert substrings.without_repeats(odd.where("false")).count() == 0


def test_window_hashes_tell_windows_apart():
    h = np.arange(40, dtype=np.uint64) % np.uint64(10)
    for k in (1, 2, 3, 5, 8, 13):
        w = windows(h, k)
        assert w.size == 41 - k and len(set(w.tolist())) == 10 and w[0] == w[10]
    assert windows(h, 41).size == 0


def covered_brute(words, k):
    grams = [tuple(words[i : i + k]) for i in range(len(words) - k + 1)]
    mark = [False] * len(words)
    for i, g in enumerate(grams):
        if grams.count(g) > 1:
            mark[i : i + k] = [True] * k
    return mark


def test_repetition_equals_brute_force(spark):
    random.seed(3)
    lists = [[random.choice("abc") for _ in range(random.randint(0, 60))] for _ in range(40)]
    for w in lists:
        for k in repetition.MOST_COVERED:
            h = np.array([ord(x) for x in w], np.uint64)
            assert repetition.covered(h, k).tolist() == covered_brute(w, k)
    text = "a é#\n\na é#\n  \nb|"
    n, chars, symbols, dup, *_ = repetition.measure(text)
    assert (n, chars, symbols, dup) == (5, 8, 3, 1)
    accents, plain = "é1 é2 é3 é4 é5 " * 2 + "x " * 10, "e1 e2 e3 e4 e5 " * 2 + "x " * 10
    assert repetition.measure(accents)[7:] == repetition.measure(plain)[7:]  # characters, not bytes


def test_repetition_defined_cases(spark, odd):
    rows = repetition.repetition_rules(odd).collect()
    assert len(rows) == len(ODD) and not any(r["kept"] for r in rows)
    assert repetition.measure("")[:6] == (0, 0, 0, 0, 0, True)
    long = next(r for r in rows if r["doc_id"] == 6)
    assert long["n_repeat_words"] == 30_000
    assert repetition.repetition_rules(odd.where("false")).count() == 0


def test_base_spans():
    text = "mail a.b@c.de, b@x, c@d.e.f; 1.2.3.4 999.1.1.1 1.2.3.4.5, 4111 1111-1111 1111, 4111111111111112 +49 (30) 1234-5678 +1"
    got = [(pii.KINDS[k], text[s:e]) for s, k, e in pii.base_spans(text)]
    assert got == [("email", "a.b@c.de"), ("email", "c@d.e.f"), ("ip", "1.2.3.4"), ("ip", "1.2.3.4"), ("card", "4111 1111-1111 1111"), ("phone", "+49 (30) 1234-5678")]
    # the leftmost match starts at the 5 and takes both numbers in; it has too many digits, and nothing is tried again
    run_on = "1.2.3.4.5 4111 1111-1111 1111 4111111111111112"
    assert [(pii.KINDS[k], run_on[s:e]) for s, k, e in pii.base_spans(run_on)] == [("ip", "1.2.3.4")]


def base_brute(text):
    """The contract's patterns, as they stand."""
    digits = lambda t: "".join(c for c in t if c in "0123456789")

    def luhn(t):
        d = [int(c) for c in digits(t)][::-1]
        return (sum(d[0::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0

    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda t: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda t: all(int(x) <= 255 for x in t.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda t: 12 <= len(digits(t)) <= 19 and luhn(t)),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: 9 <= len(digits(t)) <= 15),
    ]
    return [(m.start(), k, m.end()) for k, (_, p, ok) in enumerate(rules) for m in re.finditer(p, text) if ok(m[0])]


def test_query_of_personal_data_equals_the_patterns(spark, tmp_path):
    random.seed(9)
    pieces = ["a@b.cc", "10.0.0.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+49 30 1234567", "+1 (2) 3", "x", " ", ".", "7", "@", "é", "password=abc12345", "iban DE89 3704 0044 0532 0130 00", "555.1.1.1"]
    docs = [(i, "".join(random.choice(pieces) + random.choice(["", " "]) for _ in range(random.randint(0, 12)))) for i in range(400)] + [(400, None)]
    docs += [(1000 + i, t) for i, t in texts_of(spark)[:100]]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    for r in pii.op6_pii(spark, str(tmp_path)).collect():
        text = dict(docs)[r["doc_id"]] or ""
        want = sorted(base_brute(text))
        said = lambda spans: ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        assert [r[f"n_{k}"] for k in pii.KINDS[:4]] == [sum(k == x for _, x, _ in want) for k in range(4)], text
        assert r["base_sha256"] == hashlib.sha256(said(want).encode()).hexdigest(), text
        assert r["spans"] == said(pii.spans_of(text)[1]) and set(filter(None, said(want).split(","))) <= set(r["spans"].split(","))


def test_context_decides_on_added_kinds():
    added = lambda t: [(pii.KINDS[k], t[s:e]) for s, k, e in pii.spans_of(t)[1] if k > 3]
    key = "Zx81kQ02mmPL77aaB3cD"
    assert added(f"hmm {key} so") == [] and added(f"the bearer is {key} so") == [("key", key)]
    assert added("no 12345678 here") == [] and added("bank account 12345678 here") == [("account", "12345678")]
    assert added("password=abc12345") == [("secret", "abc12345")] and added("for example password=abc12345") == []
    assert added("DE89 3704 0044 0532 0130 00") != [] and added("an example DE89 3704 0044 0532 0130 00") == []
    assert added("for example, my bank iban is DE89 3704 0044 0532 0130 00") != []


def test_emails_equal_the_pattern():
    pattern = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    random.seed(5)
    for _ in range(3000):
        t = "".join(random.choice("ab@@..- ") for _ in range(random.randint(0, 24)))
        assert list(pii.emails(t)) == [m.span() for m in pattern.finditer(t)], t


def test_ips_equal_the_pattern():
    pattern = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    random.seed(6)
    for _ in range(3000):
        t = "".join(random.choice("0129.. ") for _ in range(random.randint(0, 24)))
        assert [m.span() for m in pii._IP.finditer(t)] == [m.span() for m in pattern.finditer(t)], t


def test_checksums_and_context():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("DE89 3704 0044 0532 0130 00") and not pii.mod97("DE88370400440532013000")
    text = "iban DE89 3704 0044 0532 0130 00 AND password=abc12345 token zz"
    assert [(pii.KINDS[k], text[s:e]) for s, k, e in pii.spans_of(text)[1] if k > 3] == [("iban", "DE89 3704 0044 0532 0130 00"), ("secret", "abc12345")]
    assert pii.score("card 4111111111111111", 5, "card", 21) > pii.score("xxxx 4111111111111111", 5, "card", 21)
    assert pii.redacted("x a@b.cc y") == "x [email] y"


def test_pii_is_linear_in_long_runs():
    import time

    t = time.process_time()
    pii.spans_of("1" * 400_000 + "a" * 400_000 + "@" * 1000 + "+" * 100_000)
    pii.spans_of("1.2.3.4 password=abc12345 DE89 3704 0044 0532 0130 00 " * 8000)
    assert time.process_time() - t < 20


def test_pii_defined_cases(spark, odd):
    rows = pii.find_pii(odd).collect()
    assert len(rows) == len(ODD) and all(r["spans"] == [] for r in rows)
    kept = pii.redact(odd)
    assert kept.columns == odd.columns and kept.where("text is null").count() == 1
    assert pii.find_pii(odd.where("false")).count() == 0


def test_toxicity_learns_and_holds_out(spark):
    random.seed(2)
    words = [f"w{i}" for i in range(500)]
    docs, labels = [], []
    for i in range(1500):
        toxic = i % 8 == 0
        w = [random.choice(words) for _ in range(40)] + (["vile"] * 2 + [random.choice(["scumly", "scumish", "scumo"])] if toxic else [])
        random.shuffle(w)
        docs.append((i, " ".join(w), "en"))
        if i % 2 == 0:
            labels.append((i, int(toxic), 1))
    d, lab = spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    rows = toxicity.score(d, toxicity.train(d, lab)).collect()
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i, *_ in docs if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r["predicted"] == (r["doc_id"] % 8 == 0) for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_risk_is_that_of_the_class_prior(monkeypatch):
    """A plain risk, the positives' part taken off the unlabelled one and held at 0 or more, falls as the model is fitted."""
    g = np.random.default_rng(5)
    word = lambda p: [np.flatnonzero(g.random(40) < q).astype(np.int32) for q in p]
    common, toxic = np.full(40, 0.2), np.r_[np.full(5, 0.7), np.full(35, 0.2)]
    positive, free = word([toxic] * 200), word([toxic] * 100 + [common] * 900)

    def risk(w, b, prior=0.1):
        z = lambda rows: np.array([w[r].sum() + b for r in rows])
        loss = lambda x: np.log1p(np.exp(-x)).mean()
        return prior * loss(z(positive)) + max(0.0, loss(-z(free)) - prior * loss(-z(positive)))

    w, b = toxicity.nnpu(positive, free, 0.1, least_lift=1.1)
    assert risk(w, b) < 0.8 * risk(np.zeros(toxicity.DIM), float(np.log(0.1 / 0.9)))
    assert w[:5].min() > 0 and np.count_nonzero(w) <= 40
    few = toxicity.nnpu(positive[:3], free, 0.1, least_lift=1.1)  # overfits: the step goes the other way, weights stay small
    assert np.abs(few[0]).max() < 12


def test_toxicity_reads_all_labelled_rows_on_demand(spark):
    d = spark.createDataFrame([(i, f"word{i % 7} " + ("fine" if i % 8 else f"vile{i % 3}")) for i in range(400)], "doc_id long, text string")
    lab = spark.createDataFrame([(i, int(i % 8 == 0)) for i in range(400)], "doc_id long, toxic int")
    a, b = toxicity.train(d, lab), toxicity.train(d, lab, positives=None, unlabelled=None)
    assert np.allclose(a[0], b[0]) and a[0].any()


def test_toxicity_ignores_held_out_labels(spark):
    d = spark.createDataFrame([(i, f"word{i % 7} vile" if i % 3 else "fine") for i in range(60)], "doc_id long, text string")
    lab = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(60)], "doc_id long, toxic int")
    other = lab.withColumn("toxic", F.when(toxicity.fold() == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.train(d, lab), toxicity.train(d, other)
    assert np.array_equal(a[0], b[0]) and a[1] == b[1]


def test_toxicity_defined_cases(spark, odd):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    rows = toxicity.score(odd, toxicity.train(odd, none)).collect()
    assert len(rows) == len(ODD) and all(r["predicted"] == 0 for r in rows)
    assert toxicity.without_toxic(odd, toxicity.train(odd, none)).columns == odd.columns
    assert toxicity.score(odd.where("false"), toxicity.train(odd.where("false"), none)).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_cached_ids_equal_the_library(spark, name):
    from tokenizers import Tokenizer

    path = tokens.public(name)
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    odd_texts = ["", "  a  b", "a\n\nb", "a\n \nb", "x's don't I'LL 12,3 é̃ <|endoftext|>", " lead", "trail ", "a b", "a\x1cb", "İSTANBUL ΣΑΣ ς", "tab\tx", "ªº µ Ünïcode", "a.\nB."]
    for t in odd_texts + [t for _, t in texts_of(spark)[:60]]:
        assert tokens.coder(path).encode(t) == np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_uneven_gaps_are_encoded_as_the_library_does(name):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokens.public(name))
    random.seed(8)
    odd_texts = ["x \ny\tz", "a \nb\u00a0c", "a\n\n\nb\tc\td", "\x85a  b", " a\tb", "a\x1cb  c"]
    odd_texts += ["".join(random.choice("aé1. \n\n\t\u00a0\u2003\x1c\x85\r") for _ in range(random.randint(0, 12))) for _ in range(2000)]
    for t in odd_texts:
        assert tokens.coder(tokens.public(name)).encode(t) == np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_special_tokens_are_as_the_library_has_them(spark, tmp_path, name):
    from tokenizers import Tokenizer

    path = tokens.public(name)
    tok = Tokenizer.from_file(path)
    docs = [(i, t) for i, t in enumerate(["a <|endoftext|> b", "x<|endoftext|>", "<|startoftext|>\n<|ENDOFTEXT|>", "<|endoftext |>", "plain words, as ever."])]
    want = {i: [*tok.encode(t, add_special_tokens=False).ids, 2] for i, t in docs}
    for i, t in docs:
        assert tokens.coder(path, special=True).encode(t) == np.array(want[i][:-1], "<u4").tobytes()
    df = spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, part int")
    bitplanes.write_ids(df, path, str(tmp_path / "x"))
    assert {r["doc_id"]: r["ids"] for r in bitplanes.read_ids(spark, str(tmp_path / "x")).collect()} == want
    rows = packing.pieces(df, path).collect()
    assert {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in rows} == {i: (len(w), zlib.crc32(np.array(w, "<u4").tobytes())) for i, w in want.items()}


def test_added_kinds_are_found_whole():
    added = lambda t: [(pii.KINDS[k], t[s:e]) for s, k, e in pii.spans_of(t)[1] if k > 3]
    key = "a1B2" * 60
    assert added(f"api_key={key}, next") == [("secret", key)] and pii.redacted(f"api_key={key}") == "api_key=[secret]"
    assert added("token: eyJhbGci1.eyJzdWIi2.c2ln-_. End") == [("secret", "eyJhbGci1.eyJzdWIi2.c2ln-_")]
    assert added("secret=SG.ab1/cd+ef== x") == [("secret", "SG.ab1/cd+ef==")]
    assert added("password: abc.de1") == [] and added("secret: token: abcdefgh1") == [("secret", "abcdefgh1")]
    two = "DE89 3704 0044 0532 0130 00 GB82 WEST 1234 5698 7654 32"
    assert added(two) == [("iban", two[:27]), ("iban", two[28:])]
    assert added("AB12 CDEF DE89 3704 0044 0532 0130 00") == [("iban", two[:27])]
    assert pii.redacted("token=abcdefgh1.x@y.de.zz") == "token=[email]"
    assert pii.redacted("token=abcdefghx-10.0.0.1-tail and") == "token=[secret][ip][secret] and"
    assert pii.redacted("token=abcdefg-DE89 3704 0044 0532 0130 00 x") == "token=[secret][iban] x"
