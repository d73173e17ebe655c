"""Near-duplicate documents: MinHash bands propose pairs, sequential Bayesian tests prune them, full sets decide.

1. A worker turns each text into its set of k-word shingles (64-bit hashes), a digest of the whole set and a signature
   of BANDS x ROWS minima. Documents with equal sets become one, the smallest doc_id standing for them.
2. Rows of a band with equal minima form a bucket. Every member is paired with the bucket's smallest doc_id, so a bucket
   of n gives n - 1 pairs.
3. The signatures of a pair are compared in batches of BATCH. With a uniform prior, the posterior probability that the
   similarity reaches the threshold is a binomial tail of the matches so far; below MISS the pair is dropped.
4. Survivors are verified on their full shingle sets, and the links' connected components taken.
5. A bucket whose members are then still in different components has pairs that step 2 didn't compare. In it the
   outsiders, members of another component than its smallest doc_id's, meet all members in blocks of BLOCK by BLOCK
   inside workers, each pair in the first band that it shares, by the test of step 3 on the signatures. Only for those that pass with somebody of their block are
   the full sets fetched, to the blocks where they passed; what leaves a worker there is one link for each outsider and
   component. So no candidate pair of different components is left out, and no bucket is held whole or written out
   pair by pair.

Rows that share a bucket, a smallest doc_id or a component are dealt over parts where they are joined by it (by_parts,
joined_by_parts): one such key may have a third of all rows.

A pair at the threshold 0.8 shares no band with probability (1 - 0.8^ROWS)^BANDS = 3e-6.

Defined cases: null, empty and wordless texts have empty sets and link with nothing; a text of fewer than k words has
one shingle, the whole sequence; rows with one doc_id are one node of the graph, so they get one component; a null doc_id
has a null component and is kept; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bitmap, by_key, by_parts, in_bitmap, joined_by_parts, mixed, removed, sliced, table, texts, word_hashes, written
from .graph import components

BANDS, ROWS = 32, 5
BATCH = 32
MISS = 1e-6
BLOCK = 256
SIZE = BANDS * ROWS
BAND_BITS = 5  # of a bucket's key

_SEED = np.random.Generator(np.random.PCG64(20240229))
_XOR = _SEED.integers(0, 1 << 32, SIZE, dtype=np.uint32)
_MUL = _SEED.integers(0, 1 << 32, SIZE, dtype=np.uint32) | np.uint32(1)
_STEP = [np.uint64(x | 1) for x in _SEED.integers(0, 1 << 63, 64, dtype=np.uint64).tolist()]


def shingles(text: str, k: int) -> np.ndarray:
    """Distinct hashes of the k-word shingles, ascending. Lower case is that of A-Z; words part at ASCII white space."""
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < k:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), len(words))], np.uint64)
    h = word_hashes(words)
    n = h.size - k + 1
    out = h[:n] * _STEP[0]
    for i in range(1, k):
        out = out + h[i : i + n] * _STEP[i]
    return np.unique(mixed(out))


def signature(found: np.ndarray) -> np.ndarray:
    x = (found >> np.uint64(32)).astype(np.uint32)
    out = np.full(SIZE, 0xFFFFFFFF, np.uint32)
    for at in range(0, x.size, 256):
        np.minimum(out, ((x[at : at + 256, None] ^ _XOR) * _MUL).min(axis=0), out=out)
    return out


def least_matches(threshold: float, miss: float = MISS, size: int = SIZE, batch: int = BATCH) -> list[tuple[int, int]]:
    """(compared, matches needed) after each batch.

    The posterior of the similarity after m matches of n is Beta(m + 1, n - m + 1); it reaches the threshold with
    probability P(Binomial(n + 1, threshold) <= m).
    """
    out = []
    for n in range(batch, size + 1, batch):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append((n, m))
    return out


def survives(a: np.ndarray, b: np.ndarray, need: list[tuple[int, int]]) -> np.ndarray:
    """Which rows of two signature matrices pass every batch."""
    left = np.arange(len(a))
    got = np.zeros(len(a), np.int32)
    at = 0
    for n, m in need:
        got = got + (a[left, at:n] == b[left, at:n]).sum(axis=1)
        keep = got >= m
        left, got, at = left[keep], got[keep], n
    out = np.zeros(len(a), bool)
    out[left] = True
    return out


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, SIZE)


def _sketch(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            n, digest, sig = [], [], []
            for text in texts(batch):
                s = shingles(text, k)
                n.append(s.size)
                digest.append(xxhash.xxh3_128_digest(s.tobytes()) if s.size else None)
                sig.append(signature(s).tobytes() if s.size else None)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.binary())], names=["doc_id", "n_shingles", "digest", "sig"])

    return run


def _sets(k: int, wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            batch = batch.filter(pa.array(in_bitmap(wanted.value, batch.column("doc_id").to_numpy())))
            rows = [shingles(t, k).view(np.int64) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.list_(pa.int64()))], names=["id", "set"])

    return run


def _pruned(need: list[tuple[int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 4096):
            keep = survives(_matrix(batch.column("sig_a")), _matrix(batch.column("sig_b")), need)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _bucket_key(band: str, minima: Column) -> Column:
    """A hash of the band's minima, with the band in the lowest bits."""
    return F.shiftleft(F.xxhash64(minima), BAND_BITS).bitwiseOR(F.col(band).cast("long"))


def first_shared(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Of a signature and others: the first band whose minima are equal (0 where none is)."""
    return (one.reshape(-1, ROWS) == others.reshape(len(others), SIZE // ROWS, ROWS)).all(axis=2).argmax(axis=1)


_BLOCK_KEY = ["key", "lb", "rb"]


def _blocks(rows: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of rows sorted by block: the outsiders' and the members' places, block by block."""
    left = rows.column("is_left").to_numpy()
    cut = np.zeros(rows.num_rows, bool)
    for c in _BLOCK_KEY:
        v = rows.column(c).to_numpy()
        cut[1:] |= v[1:] != v[:-1]
    starts = [0, *cut.nonzero()[0].tolist()]
    for s, e in zip(starts, [*starts[1:], rows.num_rows], strict=True):
        yield s + left[s:e].nonzero()[0], s + (~left[s:e]).nonzero()[0]


def _near(need: list[tuple[int, int]]):
    """Of blocks: the rows whose signature passes the test with one of another component in their block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_key(batches, _BLOCK_KEY, 4096):
            sig, label = _matrix(rows.column("sig")), rows.column("label").to_numpy()
            band = rows.column("key").to_numpy() & ((1 << BAND_BITS) - 1)
            hit = np.zeros(rows.num_rows, bool)
            for outsiders, members in _blocks(rows):
                for i in outsiders.tolist():
                    near = members[label[members] != label[i]]
                    near = near[survives(np.broadcast_to(sig[i], (near.size, SIZE)), sig[near], need)]
                    near = near[first_shared(sig[i], sig[near]) == band[i]]
                    hit[i] |= near.size > 0
                    hit[near] = True
            yield from rows.select([*_BLOCK_KEY, "id", "label", "is_left"]).filter(pa.array(hit)).to_batches()

    return run


def _across(need: list[tuple[int, int]], percent: int):
    """Of blocks of rows with their sets: for each outsider one link to every other component that it has one to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_key(batches, _BLOCK_KEY, 512):
            ids, label = rows.column("id").to_numpy(), rows.column("label").to_numpy()
            band = rows.column("key").to_numpy() & ((1 << BAND_BITS) - 1)
            sets = [np.array(s, np.int64).view(np.uint64) for s in rows.column("set").to_pylist()]
            sig = np.stack([signature(s) for s in sets])
            links = []
            for outsiders, members in _blocks(rows):
                for i in outsiders.tolist():
                    near = members[label[members] != label[i]]
                    near = near[survives(np.broadcast_to(sig[i], (near.size, SIZE)), sig[near], need)]
                    near = near[first_shared(sig[i], sig[near]) == band[i]]
                    if near.size:
                        near = near[linked(sets[i], [sets[j] for j in near], percent)]
                        links += [(ids[i], ids[near[j]]) for j in np.unique(label[near], return_index=True)[1]]
            if links:
                x = np.sort(np.array(links), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1])], names=["a", "b"])

    return run


def linked(one: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of the other sets reach the similarity with this one, all of each read."""
    size = np.fromiter(map(len, others), np.int64, len(others))
    flat = np.concatenate(others)
    hit = one[np.minimum(np.searchsorted(one, flat), one.size - 1)] == flat
    both = np.add.reduceat(hit, np.cumsum(size) - size, dtype=np.int64)
    return 100 * both >= percent * (one.size + size - both)


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of docs (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    need, held = least_matches(percent / 100), []
    sketches = written(docs.mapInArrow(_sketch(k), "doc_id long, n_shingles long, digest binary, sig binary"), "sketches")

    # equal sets: linked through the smallest id; rows of one doc_id with different sets are linked by being one node
    real = sketches.where("doc_id is not null and digest is not null")
    copies = written(real.groupBy("digest").agg(F.min("doc_id").alias("id"), F.count("*").alias("n")).where("n > 1").select("digest", "id"), "copies", held=held)
    # copies is written, so that the join with a common digest can be split or, where there are few, broadcast
    same = written(real.select("doc_id", "digest").join(copies, "digest").where("doc_id <> id").select(F.col("id").alias("a"), F.col("doc_id").alias("b")), "same", held=held)
    one = real.join(copies, "digest", "left").where("id is null or doc_id = id")
    sigs = written(one.select(F.col("doc_id").alias("id"), "sig"), "signatures", held=held)

    # a node that has several different sets takes part with each of them
    band = F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band")
    bands = sigs.select("id", "sig", band).select("id", _bucket_key("band", F.expr(f"substring(sig, band * {4 * ROWS} + 1, {4 * ROWS})")).alias("key"))
    buckets = written(bands.groupBy("key").agg(F.min("id").alias("pivot"), F.count("*").alias("n")).where("n > 1"), "keys", held=held)
    members = written(bands.join(buckets, "key").select("key", "id", "pivot", "n"), "buckets", held=held)

    def full_sets(ids: DataFrame) -> DataFrame:
        """id and whole set of the documents with these ids (id)."""
        wanted = docs.sparkSession.sparkContext.broadcast(bitmap(ids, "id"))
        full = docs.where("doc_id is not null").mapInArrow(_sets(k, wanted), "id long, set array<long>")
        return written(full.join(ids.distinct(), "id", "left_semi"), "sets", held=held)

    def verified(pairs: DataFrame) -> DataFrame:
        """Links among pairs (a, b), by their full sets."""
        full = full_sets(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))))
        both = F.size(F.array_intersect("sa", "sb")).cast("long")
        right = pairs.join(full.toDF("b", "sb"), "b")
        paired = joined_by_parts(right, "a", "b", pairs, full.toDF("a", "sa")).withColumn("both", both)
        return written(paired.where(100 * F.col("both") >= percent * (F.size("sa") + F.size("sb") - F.col("both"))).select("a", "b"), "verified", held=held)

    star = written(members.where("id <> pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct(), "star", held=held)
    signed = joined_by_parts(star.join(sigs.toDF("b", "sig_b"), "b"), "a", "b", star, sigs.toDF("a", "sig_a"))
    tested = written(signed.mapInArrow(_pruned(need), "a long, b long").distinct(), "tested", held=held)
    links = same.unionByName(verified(tested))
    found = written(components(links), "components")

    # buckets whose members are still apart
    placed = members.where("n > 2").join(found.withColumnRenamed("node", "id"), "id", "left").select("key", "id", F.coalesce("component", "id").alias("label"))
    placed = written(placed, "placed", held=held)
    dealt, apart = by_parts(placed, ["key"], "id", {"p": F.min(F.struct("id", "label")), "l": F.min("label"), "h": F.max("label")}, {"home": F.min("p")["label"], "lo": F.min("l"), "hi": F.max("h")}, "lo < hi")
    rest = written(dealt.join(apart.select("key", "_part", "home"), ["key", "_part"]).select("key", "home", "id", "label").distinct(), "apart", held=held)
    if rest.head(1):
        dealt, sizes = by_parts(rest, ["key"], "id", {"a": F.count("*"), "o": F.count_if(F.col("label") != F.col("home"))}, {"all": F.sum("a"), "out": F.sum("o")})
        rest = written(dealt.join(sizes.select("key", "_part", "all", "out"), ["key", "_part"]).join(sigs, "id"), "sized", held=held)
        blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
        spot = lambda n: F.pmod(F.xxhash64("id"), blocks(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), blocks(n) - 1))
        left = rest.where("label <> home").select("key", "id", "label", "sig", F.lit(True).alias("is_left"), spot("out").alias("lb"), every("all").alias("rb"))
        right = rest.select("key", "id", "label", "sig", F.lit(False).alias("is_left"), spot("all").alias("rb"), every("out").alias("lb"))
        sorted_blocks = lambda df: df.repartition(*_BLOCK_KEY).sortWithinPartitions(*_BLOCK_KEY)
        near = sorted_blocks(left.unionByName(right)).mapInArrow(_near(need), "key long, lb int, rb int, id long, label long, is_left boolean")
        near = written(near, "near", held=held)
        both = near.join(full_sets(near.select("id")), "id").select(*_BLOCK_KEY, "id", "label", "is_left", "set")
        more = written(sorted_blocks(both).mapInArrow(_across(need, percent), "a long, b long").distinct(), "across", held=held)
        if more.head(1):
            found = written(components(links.unionByName(more)), "components")

    removed(docs.sparkSession, held)
    out = sketches.select("doc_id", "n_shingles").join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=4)
