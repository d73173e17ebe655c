"""Ranked lexical search over a tiered index.

The index is a table of segments, each some thousand documents as they lie in the input, so building it shuffles
nothing. A segment holds its terms and, for each term, its postings by falling impact, parted into tiers: the TIERS[0]
share with the highest impacts, the next, the rest. Every tier is a column of its own and states for each term the
highest impact that is left below it, the residual bound; a search that needs the first tier reads that column alone.

A search goes tier by tier. With the tiers read so far each document has a lower bound, its score so far, and an upper
bound, which adds the residual bound of every term it wasn't found under. An item is proven when no document with a
bound still open can reach its k-th best lower bound; items without that proof, and only those, go on to the next tier.
After the last one nothing is open. Items come in blocks of a bounded number of words, which are broadcast.

Scores are integers: a term's weight times the whole impact of its occurrences, see impacts() and weight().

Defined cases: a null or termless text has no terms and is never found, nor does it count; a null or termless item finds
nothing; repeated rows are documents or items of their own; a null doc_id is returned as null, behind equal scores; other
columns are ignored; of empty tables the result is empty; texts are read whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import in_bitmap, removed, sliced_by_bytes, table, written

#: Shares of a term's postings in a segment that the first tiers hold, and how many postings they hold at least.
TIERS = ((1 / 16, 16), (1 / 4, 64))
#: Words, and bytes of text, after which a segment ends; a single document may have more.
SEGMENT_WORDS = 1 << 20
SEGMENT_BYTES = 16 << 20
#: Words of the items that are searched for together.
BLOCK_WORDS = 200_000
#: Bits of the filter for the terms to index.
WANTED_BITS = 1 << 23
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Letters and digits stay, A-Z lower-cased, other ASCII characters part terms; bytes from 128 on are letters.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256))
_IS_TERM = np.frombuffer(_FOLD, np.uint8) != 32

_TIER = "struct<starts: binary, docs: binary, impacts: binary, rest: binary>"
_INDEX = "docs array<long>, terms array<string>, df array<int>, " + ", ".join(f"tier{k} {_TIER}" for k in range(len(TIERS) + 1))


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The whole impact of tf occurrences in a document of n terms, among n_docs documents with n_terms terms in all."""
    return 1_000_000_000 * tf // (1000 * tf + 12 * (75 + 25 * n * n_docs // n_terms))


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def counted(texts: pa.Array) -> np.ndarray:
    """How many terms each text has: the places where a term's bytes begin."""
    texts = texts.cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    letters = _IS_TERM[np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]]
    begins = letters.copy()
    begins[1:] &= ~letters[:-1]
    first = (ends[:-1] - ends[0])[ends[1:] > ends[:-1]]
    begins[first] = letters[first]
    return np.diff(np.concatenate([[0], np.cumsum(begins, dtype=np.int64)])[ends - ends[0]])


def statistics(docs: DataFrame) -> tuple[int, int]:
    """Documents with a term, and their terms with repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = terms = 0
        for batch in sliced_by_bytes(batches, "text", SEGMENT_BYTES // 4):
            n = counted(batch.column("text"))
            found, terms = found + int((n > 0).sum()), terms + int(n.sum())
        yield pa.RecordBatch.from_pydict({"found": [found], "terms": [terms]}, pa.schema([("found", pa.int64()), ("terms", pa.int64())]))

    row = docs.select("text").mapInArrow(run, "found long, terms long").agg(F.coalesce(F.sum("found"), F.lit(0)), F.coalesce(F.sum("terms"), F.lit(0))).head()
    return int(row[0]), int(row[1])


class _Vocabulary(dict):
    """Numbers of a segment's terms; -1 for one that isn't wanted."""

    def __init__(self, wanted: np.ndarray | None):
        super().__init__()
        self.wanted, self.terms = wanted, []

    def __missing__(self, term: bytes) -> int:
        spot = np.array([xxhash.xxh3_64_intdigest(term)], np.uint64).view(np.int64)
        i = -1
        if self.wanted is None or in_bitmap(self.wanted, spot)[0]:
            i = len(self.terms)
            self.terms.append(term)
        self[term] = i
        return i


def _segment(doc_ids: list, sizes: list[int], words: list[np.ndarray], terms: list[bytes], n_docs: int, n_terms: int) -> tuple:
    """A row of the index from each document's term numbers."""
    doc = np.repeat(np.arange(len(words)), [w.size for w in words])
    term = np.concatenate([*words, np.empty(0, np.int64)])
    pair, tf = np.unique(term * max(1, len(words)) + doc, return_counts=True)
    term, doc = np.divmod(pair, max(1, len(words)))
    impact = impacts(tf, np.array(sizes, np.int64)[doc], n_docs, n_terms)
    order = np.lexsort((-impact, term))
    term, doc, impact = term[order], doc[order], impact[order]
    df = np.bincount(term, minlength=len(terms))
    first = np.concatenate([[0], np.cumsum(df)])
    place = np.arange(term.size) - first[term]  # in its term's list
    ends = [np.minimum(df, np.maximum(least, np.ceil(df * share).astype(np.int64))) for share, least in TIERS] + [df]
    tiers, start = [], np.zeros(len(terms), np.int64)
    for end in ends:
        here = (place >= start[term]) & (place < end[term])
        left = np.append(impact, 0)[np.where(end < df, first[:-1] + end, impact.size)]
        tiers.append({"starts": np.concatenate([[0], np.cumsum(end - start)]).astype("<i4").tobytes(), "docs": doc[here].astype("<i4").tobytes(), "impacts": impact[here].astype("<i4").tobytes(), "rest": left.astype("<i4").tobytes()})
        start = end
    return doc_ids, [t.decode() for t in terms], df.tolist(), *tiers


def index(docs: DataFrame, n_docs: int, n_terms: int, wanted: np.ndarray | None = None) -> DataFrame:
    """The segments of docs (doc_id, text): of all terms, or of those in the bitmap wanted."""
    shape = pa.struct([(x, pa.binary()) for x in ("starts", "docs", "impacts", "rest")])
    kinds = [pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int32())] + [shape] * (len(TIERS) + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sizes, words, vocabulary, held, read = [], [], [], _Vocabulary(wanted), 0, 0

        def row() -> pa.RecordBatch:
            cols = _segment(ids, sizes, words, vocabulary.terms, n_docs, n_terms)
            return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cols, kinds, strict=True)], names=["docs", "terms", "df"] + [f"tier{k}" for k in range(len(TIERS) + 1)])

        for batch in sliced_by_bytes(batches, "text", SEGMENT_BYTES // 4):
            for i, text in zip(batch.column("doc_id").cast(pa.int64()).to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = terms_of(text or "")
                if not found:
                    continue
                if words and (held + len(found) > SEGMENT_WORDS or read > SEGMENT_BYTES):
                    yield row()
                    ids, sizes, words, vocabulary, held, read = [], [], [], _Vocabulary(wanted), 0, 0
                numbers = np.fromiter(map(vocabulary.__getitem__, found), np.int64, len(found))
                ids.append(i)
                sizes.append(len(found))
                words.append(numbers[numbers >= 0])
                held += words[-1].size
                read += len(text)
        if words:
            yield row()

    return docs.select("doc_id", "text").mapInArrow(run, _INDEX)


class _Found:
    """Of each item: its k best lower bounds so far with their documents, and the highest bound that is still open."""

    def __init__(self, k: int, floors: list[int]):
        self.k, self.floors = k, floors
        self.best: list[tuple[np.ndarray, list]] = [(np.empty(0, np.int64), [])] * len(floors)
        self.open = np.zeros(len(floors), np.int64)

    def add(self, item: int, scores: np.ndarray, docs: list) -> None:
        """Keeps the best k scores, equal ones by document; what is below the item's floor can't be among them."""
        hit = np.flatnonzero(scores >= max(1, self.floors[item]))
        if not hit.size:
            return
        if hit.size > self.k:
            cut = np.partition(scores[hit], hit.size - self.k)[hit.size - self.k]
            hit = hit[scores[hit] >= cut]
        held, names = self.best[item]
        s, d = np.concatenate([held, scores[hit]]), names + [docs[i] for i in hit.tolist()]
        order = sorted(range(s.size), key=lambda i: (-s[i], d[i] is None, d[i] or 0))[: self.k]
        self.best[item] = (s[order], [d[i] for i in order])


def scored(segment: dict, items: list[dict[str, int]], tiers: int, found: _Found) -> None:
    """Scores a segment's documents for items (term -> weight, repeats counted in) from so many of its tiers."""
    number = {t: i for i, t in enumerate(segment["terms"])}
    docs = segment["docs"]
    read = []
    for k in range(tiers):
        t = segment[f"tier{k}"]
        read.append((np.frombuffer(t["starts"], "<i4").tolist(), np.frombuffer(t["docs"], "<i4"), np.frombuffer(t["impacts"], "<i4").astype(np.int64)))
    rest = np.frombuffer(segment[f"tier{tiers - 1}"]["rest"], "<i4").tolist()
    low, gap = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
    for item, weights in enumerate(items):
        low[:], gap[:], unseen = 0, 0, 0
        for term, w in weights.items():
            i = number.get(term)
            if i is None:
                continue
            left = w * rest[i]
            unseen += left
            for starts, where, impact in read:
                a, b = starts[i], starts[i + 1]
                low[where[a:b]] += w * impact[a:b]
                if left:
                    gap[where[a:b]] -= left
        found.add(item, low, docs)
        if unseen:
            up = gap + unseen  # what a document can still gain
            still = up > 0
            if still.any():
                found.open[item] = max(found.open[item], int((low + up)[still].max()))


def _round(segments: DataFrame, items: list[dict[str, int]], floors: list[int], tiers: int, k: int) -> DataFrame:
    """item, doc_id, score of each task's k best, and a row without a document that has the highest open bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _Found(k, floors)
        for batch in batches:
            for i in range(batch.num_rows):
                scored(batch.slice(i, 1).to_pylist()[0], items, tiers, found)
        rows = [(i, d, int(s), False) for i, (scores, docs) in enumerate(found.best) for s, d in zip(scores, docs, strict=True)]
        rows += [(i, None, int(s), True) for i, s in enumerate(found.open.tolist()) if s]
        cols = list(zip(*rows, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int64(), pa.bool_()), strict=True)], names=["item", "doc_id", "score", "open"])

    cols = ["docs", "terms"] + [f"tier{i}" for i in range(tiers)]
    return segments.select(cols).mapInArrow(run, "item int, doc_id long, score long, open boolean")


def _block(segments: DataFrame, items: list[dict[str, int]], k: int, held: list[str], proven: list[int]) -> list[DataFrame]:
    """The best documents of a block of items (term -> weight), round by round; proven counts the items by round."""
    spark, out = segments.sparkSession, []
    left, floors = list(range(len(items))), [1] * len(items)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    for tiers in range(1, len(TIERS) + 2):
        rows = written(_round(segments, [items[i] for i in left], [floors[i] for i in left], tiers, k), "round", held=held)
        best = rows.where("not open").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        # two numbers of each item of the block: its k-th best lower bound and its highest open bound
        kth = {r[0]: r[1] for r in best.where(F.col("rank") == k).select("item", "score").collect()}
        open_ = {r[0]: r[1] for r in rows.where("open").groupBy("item").agg(F.max("score")).collect()}
        done = [i for i in range(len(left)) if open_.get(i, 0) < kth.get(i, 1)]
        proven.append(len(done))
        names = spark.createDataFrame([(i, left[i]) for i in done], "item int, number int")
        out.append(best.join(F.broadcast(names), "item").select("number", "rank", "doc_id", "score"))
        for i in range(len(left)):
            floors[left[i]] = max(floors[left[i]], kth.get(i, 1))
        left = [left[i] for i in range(len(left)) if i not in set(done)]
        if not left:
            break
    return out


def ranked(docs: DataFrame, items: DataFrame, k: int = 20, proven: list[int] | None = None) -> DataFrame:
    """item_id, rank, doc_id and score of the k best of docs (doc_id, text) for each row of items (item_id, text).

    proven, if given, gets the number of items that each round of each block could close.
    """
    spark, held = docs.sparkSession, []
    n_docs, n_terms = statistics(docs)
    asked = items.select("item_id", "text").where("text is not null")
    words = asked.select(F.explode(F.regexp_extract_all(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(TERM), F.lit(0))).alias("term")).distinct()
    segments = written(index(docs, n_docs, n_terms, wanted_terms(words)), "index", held=held)
    counts = segments.select(F.explode(F.arrays_zip("terms", "df")).alias("t")).groupBy(F.col("t.terms").alias("term")).agg(F.sum("t.df").alias("df"))
    counts = written(counts.join(words, "term", "left_semi"), "counts", held=held)
    out: list[DataFrame] = []
    for block in blocks(asked):
        terms = [terms_of(t) for _, t in block]
        seen = sorted({w.decode() for ws in terms for w in ws})
        df = {r[0]: r[1] for r in counts.join(F.broadcast(spark.createDataFrame([(t,) for t in seen], "term string")), "term").collect()} if seen else {}
        weighted = []
        for ws in terms:
            by: dict[str, int] = {}
            for w in map(bytes.decode, ws):
                if w in df:
                    by[w] = by.get(w, 0) + weight(n_docs, df[w])
            weighted.append(by)
        names = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(block)], "number int, item_id long")
        for rows in _block(segments, weighted, k, held, proven if proven is not None else []):
            out.append(rows.join(F.broadcast(names), "number").select("item_id", "rank", "doc_id", "score"))
    if not out:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    whole = out[0]
    for rows in out[1:]:
        whole = whole.unionByName(rows)
    whole = written(whole, "ranked")
    removed(spark, held)
    return whole


def wanted_terms(words: DataFrame) -> np.ndarray:
    """A bitmap of the terms in the column term; its size is fixed, and it only lets too much through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [xxhash.xxh3_64_intdigest(t.encode()) & (WANTED_BITS - 1) for t in batch.column("term").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], names=["spot"])

    spots = words.mapInArrow(run, "spot long").groupBy(F.shiftright("spot", 5).alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("spot") % 32).cast("int"))).alias("bits")).toArrow()
    out = np.zeros(WANTED_BITS // 32, "<u4")
    out[spots.column("word").to_numpy()] = spots.column("bits").to_numpy()
    return out.view(np.uint64)


def blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """The items in lists of BLOCK_WORDS words; the driver holds one list, and a partition of items, at a time."""
    held, size = [], 0
    for row in items.toLocalIterator():
        n = len(terms_of(row[1]))
        if held and size + n > BLOCK_WORDS:
            yield held
            held, size = [], 0
        held.append((row[0], row[1]))
        size += n
    if held:
        yield held


def op11_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
