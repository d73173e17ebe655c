"""Repeated passages, by suffix trees over partitions of suffixes that share a prefix of variable length.

Words are symbols. A window is WINDOW consecutive words of a document; a word goes if a window over it also starts in
a document with a smaller doc_id.

1. Of the suffixes of a text only those are kept that start at an anchor: the ANCHOR-word sequence with the smallest
   hash (the leftmost of equals) in some window. Equal windows have the same anchor at the same place, so two equal
   windows always show as two kept suffixes with a common prefix, each with the words before it. A suffix's context is
   all the words of the windows that its anchor stands for.
2. Prefixes of ANCHOR words are counted; a bitmap of fixed size, which lets too many through rather than too few, keeps
   most suffixes out whose prefix is in one document only. Suffixes with equal contexts are one: all of them but those
   of the smallest doc_id go whole. So copies of a text or a passage weigh no more than one from here on, and only
   for contexts that differ under a prefix that several documents share are the words fetched.
3. A prefix with more than LARGE contexts is extended. A window with e words before the anchor needs e words to the left
   and WINDOW - e to the right; a partition for the windows with lo <= e <= hi shares the words from lo before the anchor
   to WINDOW - hi after its start. Halving the range lo to hi gives two longer prefixes, one for each half, and so on
   until a partition is small enough, or its prefix is one whole window: a node as deep as WINDOW, of which only the
   smallest doc_id is needed.
4. A partition fits in memory: its subtree is laid out as the sorted suffixes with the lengths of their common prefixes,
   and so are the reversed words before them. A node of depth d on the right and one of depth e on the left with
   d + e = WINDOW are the deep nodes; below each, the smallest doc_id stays and the others' words go. Adjacent windows
   join into maximal repeats.

Rows that share a prefix, a context or a text are never dealt by that alone where there may be many (by_parts).

Defined cases: a null text has no words; texts shorter than a window lose nothing; equal doc_ids never remove from each
other; rows with one doc_id and different texts are judged each by its own text; rows with a null doc_id lose nothing
and remove nothing; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bitmap, by_key, by_parts, in_bitmap, mixed, removed, sliced, table, texts, windows, word_hashes, written

WINDOW = 50
ANCHOR = 8
#: Contexts of a partition that are laid out as one subtree.
LARGE = 4096
#: Contexts that a worker lays out at a time.
AT_ONCE = 16384


def anchors(grams: np.ndarray, span: int) -> np.ndarray:
    """For each window of span grams, the place of its smallest gram, the leftmost of equals."""
    n = grams.size - span + 1
    at, size = np.arange(grams.size), 1
    while 2 * size <= span:
        a, b = at[:-size], at[size:]
        at, size = np.where(grams[b] < grams[a], b, a), 2 * size
    a, b = at[:n], at[span - size : span - size + n]
    return np.where(grams[b] < grams[a], b, a)


def kept_suffixes(h: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Of word hashes: each anchor's hash and place, and the first and last window it stands for."""
    if h.size < window:
        return (np.empty(0, np.int64),) * 4
    grams = windows(h, anchor)
    at = anchors(grams, window - anchor + 1)
    first = np.concatenate([[0], (at[1:] != at[:-1]).nonzero()[0] + 1])
    last = np.concatenate([first[1:], [at.size]]) - 1
    return grams[at[first]].view(np.int64), at[first], first, last


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        found = [np.unique(kept_suffixes(word_hashes(t.encode().split()))[0]) for t in texts(batch)]
        ids = np.repeat(batch.column("doc_id").to_numpy(), [f.size for f in found])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*found, np.empty(0, np.int64)])), pa.array(ids, pa.int64())], names=["prefix", "doc_id"])


_SUFFIX = "prefix long, context long, doc_id long, row long, firsts array<int>, at int, n int"


def _suffixes(repeated):
    """_SUFFIX: a text's suffixes under repeated prefixes: the prefix, a hash of the context, the places of the first
    window (of several equal contexts), the anchor's place after it, and the number of windows."""
    names = [x.split()[0] for x in _SUFFIX.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            out: list[tuple] = []
            for doc, row, text in zip(batch.column("doc_id").to_pylist(), batch.column("row").to_pylist(), texts(batch), strict=True):
                h = word_hashes(text.encode().split())
                prefix, at, first, last = kept_suffixes(h)
                own = in_bitmap(repeated.value, prefix).nonzero()[0]
                if not own.size:
                    continue
                prefix, at, first, last = prefix[own], at[own], first[own], last[own]
                # two windows cover the whole context, as it is shorter than both together
                w = windows(h, WINDOW)
                context = mixed(mixed(w[first] * np.uint64(0x9E3779B97F4A7C15) + w[last]) + (last - first).astype(np.uint64)).view(np.int64)
                order = np.lexsort((context, prefix))
                p, c = prefix[order], context[order]
                starts = np.concatenate([[0], ((p[1:] != p[:-1]) | (c[1:] != c[:-1])).nonzero()[0] + 1])
                one = order[starts]
                out.append((prefix[one], context[one], np.full(one.size, doc), np.full(one.size, row), first[order].astype(np.int32), np.diff(np.append(starts, order.size)), (at - first)[one].astype(np.int32), (last - first + 1)[one].astype(np.int32)))
            if out:
                cols = [np.concatenate(c) for c in zip(*out, strict=True)]
                firsts = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(cols[5])]), pa.int32()), pa.array(cols[4]))
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:4]), firsts, pa.array(cols[6]), pa.array(cols[7])], names=names)

    return run


_ROW = "key long, lo int, hi int, prefix long, context long, doc_id long, at int, n int, words binary"
_ROW_NAMES = [x.split()[0] for x in _ROW.split(", ")]
_ROW_KINDS = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]


def _rows(out: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*out, strict=True)) or [()] * len(_ROW_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, _ROW_KINDS, strict=True)], names=_ROW_NAMES)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """_ROW for each place: the whole context of a suffix, to be partitioned by its prefix of ANCHOR words."""
    for batch in sliced(batches):
        out = []
        for doc, text, places in zip(batch.column("doc_id").to_pylist(), texts(batch), batch.column("places").to_pylist(), strict=True):
            words = text.encode().split()
            for x in places:
                f = x["first"]
                out.append((x["prefix"], 0, WINDOW - ANCHOR, x["prefix"], x["context"], doc, x["at"], x["n"], b" ".join(words[f : f + x["n"] + WINDOW - 1])))
        yield _rows(out)


def _extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row under the longer prefixes of the two halves of its range of windows, as far as it has windows there."""
    for batch in sliced(batches, 4096):
        out = []
        for _, lo, hi, prefix, context, doc, at, n, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words = text.split(b" ")
            half = (lo + hi) // 2
            for a, b in ((lo, half), (half + 1, hi)):
                low, high = max(a, at - n + 1), min(b, at)
                if low <= high:
                    key = xxhash.xxh3_64_intdigest(b" ".join(words[at - a : at - b + WINDOW]), a * 64 + b) - (1 << 63)
                    out.append((key, a, b, prefix, context, doc, high, high - low + 1, b" ".join(words[at - high : at - low + WINDOW])))
        yield _rows(out)


def _nodes(part: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows in the order of (part, symbols), and the common prefix of each with the one before (-1 in a new part)."""
    order = np.lexsort((*symbols.T[::-1], part))
    s, p = symbols[order], part[order]
    differ = s[1:] != s[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), symbols.shape[1])
    common[p[1:] != p[:-1]] = -1
    return order, np.concatenate([[-1], common])


def _depth(order: np.ndarray, common: np.ndarray, d: int) -> np.ndarray:
    """Each row's node of depth d."""
    out = np.empty(order.size, np.int64)
    out[order] = np.cumsum(common < d)
    return out


def repeats(part: np.ndarray, doc: np.ndarray, at: np.ndarray, count: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    """Of suffixes with the words around them, which windows stay below a deep node that a smaller doc_id shares.

    rows holds word hashes; the anchor is at place at, and the windows start at places 0 to count - 1. The result has
    a row for each suffix and a column for each number of words before the anchor.
    """
    n, left = len(rows), WINDOW - ANCHOR
    near = np.zeros((n, left + WINDOW), np.uint64)
    size = np.fromiter(map(len, rows), np.int64, n)
    row = np.repeat(np.arange(n), size)
    place = np.arange(row.size) - np.repeat(np.cumsum(size) - size, size)
    near[row, place + (left - at)[row]] = np.concatenate(rows)
    right = _nodes(part, near[:, left:])
    back = _nodes(part, near[:, left - 1 :: -1])
    out = np.zeros((n, left + 1), bool)
    for e in range(left + 1):
        own = ((at >= e) & (at - e < count)).nonzero()[0]
        if own.size < 2:
            continue
        deep = _depth(*right, WINDOW - e)[own] * np.int64(n + 1) + _depth(*back, e)[own]
        order = np.lexsort((doc[own], deep))
        k, d = deep[order], doc[own][order]
        new = np.concatenate([[True], k[1:] != k[:-1]])
        least = d[new][np.cumsum(new) - 1]
        out[own[order[d > least]], e] = True
    return out


_FOUND = "prefix long, context long, low int, high int"


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """_FOUND: of each context the runs of windows that go, by the words before the anchor."""
    for rows in by_key(batches, ["key"], AT_ONCE):
        key, doc, at, n, prefix, context = (rows.column(c).to_numpy() for c in ("key", "doc_id", "at", "n", "prefix", "context"))
        words = [word_hashes(w.split(b" ")) for w in rows.column("words").to_pylist()]
        hit = repeats(np.cumsum(np.concatenate([[0], key[1:] != key[:-1]])), doc, at, n, words)
        edge = np.diff(np.pad(hit, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        r, low = (edge == 1).nonzero()
        high = (edge == -1).nonzero()[1] - 1
        yield pa.RecordBatch.from_arrays([pa.array(prefix[r]), pa.array(context[r]), pa.array(low, pa.int32()), pa.array(high, pa.int32())], names=["prefix", "context", "low", "high"])


def _below(rows: DataFrame, held: list[str]) -> DataFrame:
    """_FOUND of the contexts in rows (_ROW): small partitions as subtrees, large ones under longer prefixes."""
    found = None
    for _ in range(WINDOW):
        some = {"first": F.min("doc_id"), "last": F.max("doc_id"), "some": F.count("*")}
        dealt, sizes = by_parts(rows, ["key", "lo", "hi"], "context", some, {"first": F.min("first"), "last": F.max("last"), "rows": F.sum("some")}, "first < last")
        rows = written(dealt.join(sizes, ["key", "lo", "hi", "_part"]).select(*_ROW_NAMES, "first", "rows"), "partitions", held=held)
        small = rows.where((F.col("rows") <= LARGE) & (F.col("lo") < F.col("hi"))).select(*_ROW_NAMES)
        trees = small.repartition("key").sortWithinPartitions("key").mapInArrow(_subtrees, _FOUND)
        whole = rows.where("lo = hi and doc_id > first").select("prefix", "context", F.col("lo").alias("low"), F.col("hi").alias("high"))
        now = written(trees.unionByName(whole), "found", held=held)
        found = now if found is None else found.unionByName(now)
        large = rows.where((F.col("rows") > LARGE) & (F.col("lo") < F.col("hi"))).select(*_ROW_NAMES)
        if not large.head(1):
            return found
        rows = written(large.mapInArrow(_extended, _ROW), "longer", held=held)
    raise AssertionError("the range of windows is halved until it is one")


def repeated_passages(docs: DataFrame) -> DataFrame:
    """doc_id, row (a hash of the text) and the runs of words that go, starts and the length of each; they may overlap."""
    spark, held = docs.sparkSession, []
    docs = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("row"))
    counts = docs.select("doc_id", "text").mapInArrow(_count, "prefix long, doc_id long").groupBy("prefix").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    counts = written(counts.where("lo < hi").select("prefix"), "prefixes", held=held)
    repeated = spark.sparkContext.broadcast(bitmap(counts, "prefix"))
    suffixes = written(docs.mapInArrow(_suffixes(repeated), _SUFFIX), "suffixes", held=held)

    # equal contexts: the smallest doc_id stands for them
    key = ["prefix", "context"]
    dealt, least = by_parts(suffixes, key, "doc_id", {"least": F.min("doc_id")}, {"least": F.min("least")})
    placed = written(dealt.join(least, [*key, "_part"]).drop("_part"), "placed")
    own = placed.where("doc_id = least")
    one = own.groupBy(*key).agg(F.min("doc_id").alias("doc_id"), F.min(F.struct("row", F.element_at("firsts", 1).alias("first"), "at", "n")).alias("x"))
    dealt, shared = by_parts(written(one, "contexts", held=held), ["prefix"], "context", {"lo": F.min("doc_id"), "hi": F.max("doc_id")}, {"lo": F.min("lo"), "hi": F.max("hi")}, "lo < hi")
    one = dealt.join(shared.select("prefix", "_part"), ["prefix", "_part"]).select("doc_id", "x.row", F.struct(*key, "x.first", "x.at", "x.n").alias("place"))
    places = written(one.groupBy("doc_id", "row").agg(F.collect_list("place").alias("places")), "places", held=held)
    wanted = spark.sparkContext.broadcast(bitmap(places, "doc_id"))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_bitmap(wanted.value, batch.column("doc_id").to_numpy())))

    named = docs.mapInArrow(chosen, "doc_id long, text string, row long")
    rows = written(named.join(places, ["doc_id", "row"]).select("doc_id", "text", "places").mapInArrow(_contexts, _ROW), "rows", held=held)
    found = _below(rows, held)

    later = placed.where("doc_id > least").select("doc_id", "row", F.col("firsts").alias("starts"), (F.col("n") + WINDOW - 1).alias("length"))
    starts = F.expr("transform(firsts, f -> f + at - high)")
    deep = own.join(found, key).select("doc_id", "row", starts.alias("starts"), (F.col("high") - F.col("low") + WINDOW).alias("length"))
    out = written(later.unionByName(deep), "passages")
    removed(spark, held)
    return out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        n, gone, sha = [], [], []
        for text, spans in zip(texts(batch), batch.column("spans").to_pylist(), strict=True):
            words = text.encode().split()
            edge = np.zeros(len(words) + 1, np.int64)
            for s in spans or ():
                at = np.array(s["starts"])
                np.add.at(edge, at, 1)
                np.add.at(edge, at + s["length"], -1)
            off = np.cumsum(edge[:-1]) > 0
            n.append(len(words))
            gone.append(int(off.sum()))
            sha.append(hashlib.sha256(b" ".join([w for w, x in zip(words, off.tolist(), strict=True) if not x] if gone[-1] else words)).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 for each row of docs (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    spans = repeated_passages(docs).groupBy("doc_id", "row").agg(F.collect_set(F.struct("starts", "length")).alias("spans"))
    keyed = docs.withColumn("row", F.xxhash64("text")).join(spans, ["doc_id", "row"], "left")
    return keyed.select("doc_id", "text", "spans").mapInArrow(_cut, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"))
