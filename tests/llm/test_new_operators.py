"""Ranked search, byte-pair encoding and the prefix trie against plain versions, with their defined cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallymark.llm import bpe, ranked, tokens, tries

NOTHING = hashlib.sha256().hexdigest()


# ranked search


def plain_ranked(docs, items, k=20):
    def terms(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(ranked.TERM, low)

    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for i, b, n in bags:
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * b[t] // (1000 * b[t] + 12 * m)) for t in terms(text) if t in b)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        for rank, (s, null, i) in enumerate(sorted(scores)[:k], 1):
            out.append((item, rank, None if null else i, -s))
    return sorted(out, key=str)


def corpus(n, seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{int(rng.paretovariate(0.7))}" for _ in range(400)] + ["Été", "été", "naïve", "A-b", "x_y", "数 据", "tab\there"]
    return [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 60)))) for i in range(n)]


def test_ranked_equals_plain(spark):
    docs = corpus(700) + [(None, "w1 w2 lonely"), (None, None), (900, ""), (901, "--- ... \x00"), (902, "w1"), (902, "w1"), (903, "w1 " * 5000)]
    items = [(1, "w1 w2 w3"), (2, "W1 w1 w1"), (3, "été naïve unheard"), (4, ""), (5, None), (6, "w1 w5 w9 tab x y 数 lonely"), (7, "unheard"), (1, "w4 w4 w7"), (None, "w2"), (8, " ".join(f"w{i}" for i in range(1, 60)))]
    d = spark.createDataFrame([(i, t, 7) for i, t in docs], "doc_id long, text string, score int").repartition(5)
    q = spark.createDataFrame([(i, t, 7) for i, t in items], "item_id long, text string, rank int")
    proven = []
    got = sorted(map(tuple, ranked.ranked(d, q, 20, proven).collect()), key=str)
    assert got == plain_ranked(docs, items)
    assert sum(proven) == 9 and proven[0] and any(proven[1:])  # some on the first tier, some further down


def test_ranked_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ranked, "BLOCK_WORDS", 4)
    docs, items = corpus(120, 2), [(i, f"w{i} w1 w{i + 1}") for i in range(1, 9)]
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert sorted(map(tuple, ranked.ranked(d, q, 3).collect()), key=str) == plain_ranked(docs, items, 3)


def test_tiers_bound_what_is_below(monkeypatch):
    monkeypatch.setattr(ranked, "TIERS", ((0.1, 1), (0.4, 2)))
    docs = corpus(200, 3)
    words = [ranked.terms_of(t) for _, t in docs]
    vocabulary = ranked._Vocabulary(None)
    numbers = [np.array([vocabulary[w] for w in ws], np.int64) for ws in words]
    n_docs, n_terms = len(words), sum(map(len, words))
    row = dict(zip(["docs", "terms", "df", "tier0", "tier1", "tier2"], ranked._segment([i for i, _ in docs], [len(w) for w in words], numbers, vocabulary.terms, n_docs, n_terms), strict=True))
    items = [{"w1": 3, "w2": 5, "w7": 9}, {"w1": 1}]
    exact = ranked._Found(200, [1, 1])
    ranked.scored(row, items, 3, exact)
    assert not exact.open.any()
    for tiers in (1, 2):
        part = ranked._Found(200, [1, 1])
        ranked.scored(row, items, tiers, part)
        for i in range(2):
            low = dict(zip(part.best[i][1], part.best[i][0].tolist(), strict=True))
            true = dict(zip(exact.best[i][1], exact.best[i][0].tolist(), strict=True))
            assert all(low[d] <= true[d] for d in low)
            assert max(s for d, s in true.items() if low.get(d, 0) < s) <= part.open[i]


def test_terms_are_counted():
    import pyarrow as pa

    texts = ["", "a", " a", "a b", "é-数x", None, "  ", "A1_b2 ", "", "ends", "starts", "\x00a\x00"]
    for part in (pa.array(texts), pa.array(["skipped", *texts])[1:], pa.array(texts)[2:5], pa.array([], pa.string())):
        assert ranked.counted(part).tolist() == [len(ranked.terms_of(t or "")) for t in part.to_pylist()]


def test_ranked_of_nothing(spark):
    none, one = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    q, empty = spark.createDataFrame([(1, "a")], "item_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert ranked.ranked(none, q).count() == ranked.ranked(one, empty).count() == ranked.ranked(none, empty).count() == 0
    assert [tuple(r) for r in ranked.ranked(one, q).collect()] == plain_ranked([(1, "a b")], [(1, "a")])


# byte-pair encoding

ODD = ["", " ", "Hello, WORLD's  it's 12 ab_c", "a\xa0b\x1cc\x85d İ 힣 é", "ΣΑΣ Å ﬁ ½ ² ª", "<|endoftext|> hi <|startoftext|>x<|", "x" * 47, "ab" * 24, "ab" * 25, "abc" * 400, "\x00 ​ ​ 数据 😀😀", "'s''s don't I'LL", " leading and trailing \n"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_codec_equals_library(name):
    tok, codec = Tokenizer.from_file(tokens.public(name)), bpe.Codec(tokens.public(name))
    rng = random.Random(5)
    pool = [*"abcdeé ,.'\n\t  ", "th", "ing ", "Ω", "é", "数", "7"]
    texts = ODD + ["".join(rng.choice(pool) for _ in range(rng.randint(0, 90))) for _ in range(400)]
    for text, raw in zip(texts, codec.encode(texts), strict=True):
        ids = np.frombuffer(raw, "<u4")
        want = tok.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want, text
        assert codec.decode(ids) == tok.decode(want, skip_special_tokens=False), text


def test_scan_and_heap_agree():
    with open(tokens.public("word_bpe_49k.json"), encoding="utf-8") as f:
        import json

        merges = bpe.Merges(json.load(f)["model"])
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdething") for _ in range(rng.randint(1, bpe.SHORT))).encode() for _ in range(500)]
    for word, raw in zip(words, merges.encoded(words), strict=True):
        ids = merges.first[np.frombuffer(word, np.uint8)]
        ids[-1] = merges.last[word[-1]]
        assert np.frombuffer(raw, "<u4").tolist() == merges.long(ids.tolist())


def test_memory_may_be_small(monkeypatch):
    texts = [f"word{i} and other{i % 7} words, {i}" for i in range(300)]
    codec = bpe.Codec(tokens.public("word_bpe_49k.json"))
    whole = codec.encode(texts)
    monkeypatch.setattr(bpe, "CACHED", 20)
    small = bpe.Codec(tokens.public("word_bpe_49k.json"))
    assert [x for t in texts for x in small.encode([t])] == whole


def test_op12_rows(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "null id"), (90, None), (91, "same same"), (91, "same same"), (92, "long text. " * 20_000)]
    path = tokens.public("word_bpe_49k.json")
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, ids string")
    tok = Tokenizer.from_file(path)
    want = []
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, bpe.digests(df, path).collect()), key=str) == sorted(want, key=str)
    back = bpe.decoded(bpe.encoded(df, path), path).collect()
    assert sorted((str(r[0]), r[1]) for r in back) == sorted((str(i), tok.decode(tok.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False)) for i, t in rows)
    assert bpe.digests(df.limit(0), path).count() == 0


def test_other_models_are_refused(tmp_path):
    (tmp_path / "t.json").write_text('{"model": {"type": "Unigram"}}')
    with pytest.raises(ValueError, match="Unigram"):
        bpe.Codec(str(tmp_path / "t.json"))


# prefix trie


def plain_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            turns[conv].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in turns.items()}
    whole = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(math.fmod(c, 100))
        whole[c] = own.get(base, [])[:h] + ts[h:]
    nodes = defaultdict(list)
    for c, ts in whole.items():
        for d in range(len(ts) + 1):
            nodes[tuple(ts[:d])].append(c)
    kids, leaves, saved = Counter(), Counter(), Counter()
    for path in nodes:
        if path:
            kids[path[:-1]] += 1
    for path, members in nodes.items():
        own_saved = (len(members) - 1) * len(path[-1][1]) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += not kids[path]
            saved[path[:d]] += own_saved
    out = []
    for path, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(whole[c]) == len(path))
        out.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), kids[path], leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def talks(seed=4):
    rng = random.Random(seed)
    rows = []
    for c in [*range(0, 60), *range(100, 130), *range(205, 215), -3, -100, -101, 10**12]:
        for t in range(rng.randint(1, 9)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["yes", "no", "why?", "été", ""])))
    rows += [(70, t, "user", "a") for t in range(40)] + [(71, t, "user", "a") for t in range(30)]
    return rows + [(72, None, None, None), (72, None, None, None), (72, 3, "user", None), (None, 1, "user", "lost"), (73, 1, "user", "tie"), (73, 1, "user", "tie"), (73, 1, "bot", "other"), (10**12, 5, "user", "x" * 100_000)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, n_convs int").repartition(3)


@pytest.mark.parametrize("rows_of_shard", [100_000, 40])
def test_trie_equals_plain(spark, monkeypatch, rows_of_shard):
    monkeypatch.setattr(tries, "SHARD_ROWS", rows_of_shard)
    rows = talks()
    head = F.crc32(F.col("conv_id").cast("string")) % 6
    turns, convs = tries.with_shared_heads(tries.turns_of(frame(spark, rows)), head, F.col("conv_id") - F.col("conv_id") % 100, 5, [])
    got = sorted(map(tuple, tries.prefix_trie(turns, convs).drop("key").collect()), key=str)
    assert got == plain_trie(rows)


def test_trie_of_nothing(spark):
    empty = frame(spark, [(None, 1, "user", "x")])
    turns, convs = tries.with_shared_heads(tries.turns_of(empty), F.lit(0), F.col("conv_id"), 5, [])
    assert tries.prefix_trie(turns, convs).count() == 0


def test_louds_bits():
    # root with two children, the first of which has three
    bits = tries.louds([np.array([0, 0]), np.array([1, 1, 1])])
    assert bits.astype(int).tolist() == [1, 1, 0, 1, 1, 1, 0, 0, 0, 0, 0]
    assert tries.parents(bits).tolist() == [0, 0, 1, 1, 1] and tries.children(bits).tolist() == [2, 3, 0, 0, 0, 0]


def test_digests_come_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(tries, "CHUNK_IDS", 7)
    ends = [("a", i) for i in range(100)] + [("b", -5), ("b", 3), ("c", 9)]
    got = {r[0]: r[1] for r in tries.end_digests(spark.createDataFrame(ends, "key string, conv_id long").repartition(4)).collect()}
    assert got == {k: hashlib.sha256(",".join(str(i) for x, i in sorted(ends) if x == k).encode()).hexdigest() for k in "abc"}
