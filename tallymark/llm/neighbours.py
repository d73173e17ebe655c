"""Nearest neighbours by a forest of hash-prefix trees.

1. Cells: the signs of CELL_BITS projections. Counts by cell give leaves, variable-length prefixes of the cells with at
   most SHARD vectors where the bits allow it; a larger leaf (a common vector, say) is dealt to several shards by vec_id.
   A vector goes to one shard. A query goes to the leaves in the order of the least squared projections that would have to
   change sign, until they hold a share VISITED of all vectors.
2. Of a shard's vectors each of TREES trees keeps a sorted array of strings of DEPTH bits, the signs of its own
   projections. A query descends in every tree to its longest prefix match, then ascends in all trees together, a level
   at a time, until a share TOGETHER of the shard has come in. What shares long prefixes in many trees comes in early and
   often: the share CANDIDATES that came in most often are compared, by exact distances.
3. Each shard's k nearest are merged to each query's.

Vectors and queries of a shard reach one task sorted, the vectors first; the queries are answered as they stream by.
Projections are orthogonal and seeded, the same on every worker.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take no part; vectors of
another dimension than the query's aren't its candidates; rows with the query's own vec_id aren't either, and rows that
repeat a vec_id and its vector count once; where rows of one vec_id have different vectors, the smallest of their
distances is the vec_id's; null vec_ids take no part; with fewer than k candidates all are returned; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import removed, sliced, table, written

CELL_BITS = 12
SHARD = 4096
VISITED = 0.9
TREES = 64
DEPTH = 16
TOGETHER = 0.95
CANDIDATES = 0.25

_SEED = 7919


def projections(n: int, dim: int, seed: int) -> np.ndarray:
    """n directions, in orthogonal groups of as many as there are dimensions."""
    g = np.random.Generator(np.random.PCG64(seed + dim))
    return np.concatenate([np.linalg.qr(g.standard_normal((dim, dim)))[0].T for _ in range(-(-n // dim))])[:n]


def leaves_of(counts: dict[int, int], most: int, bits: int = CELL_BITS) -> list[tuple[int, int, int]]:
    """(prefix, its length, vectors) of the leaves over cells, empty ones left out."""
    out, level = [], {0: counts}
    for length in range(bits + 1):
        below: dict[int, dict[int, int]] = {}
        for prefix, cells in level.items():
            n = sum(cells.values())
            if n <= most or length == bits:
                out.append((prefix, length, n))
            else:
                for cell, m in cells.items():
                    below.setdefault(cell >> (bits - length - 1), {})[cell] = m
        level = below
    return out


class Router:
    """Which shards the vectors of a dimension are in, and which ones a query visits."""

    def __init__(self, dim: int, counts: dict[int, int], first: int, visited: float):
        self.planes = projections(CELL_BITS, dim, _SEED)
        found = leaves_of(counts, SHARD)
        prefix, length, self.size = (np.array(c, np.int64) for c in zip(*found, strict=True))
        self.shards = -(-self.size // SHARD)
        self.first = first + np.cumsum(self.shards) - self.shards
        self.end = int(first + self.shards.sum())
        bits = np.arange(CELL_BITS)
        self.fixed = bits < length[:, None]
        self.sign = (prefix[:, None] >> np.maximum(length[:, None] - 1 - bits, 0)) & 1 > 0
        self.leaf = np.zeros(1 << CELL_BITS, np.int64)
        for i, (p, n, _) in enumerate(found):
            self.leaf[p << (CELL_BITS - n) : (p + 1) << (CELL_BITS - n)] = i
        self.visited = visited * self.size.sum()

    def cells(self, x: np.ndarray) -> np.ndarray:
        return ((x @ self.planes.T > 0) << np.arange(CELL_BITS - 1, -1, -1)).sum(axis=1)

    def own(self, ids: np.ndarray, x: np.ndarray) -> np.ndarray:
        leaf = self.leaf[self.cells(x)]
        spread = np.fromiter((xxhash.xxh3_64_intdigest(i.to_bytes(8, "little", signed=True)) >> 1 for i in ids.tolist()), np.int64, len(ids))
        return self.first[leaf] + spread % self.shards[leaf]

    def visits(self, q: np.ndarray) -> Iterator[np.ndarray]:
        """For each query the shards of its leaves, the likeliest leaves until they hold enough."""
        y = q @ self.planes.T
        for row in y:
            cost = ((self.sign != (row > 0)) & self.fixed) @ (row * row)
            order = np.argsort(cost, kind="stable")
            n = int(np.searchsorted(np.cumsum(self.size[order]), self.visited)) + 1
            yield np.concatenate([np.arange(self.first[i], self.first[i] + self.shards[i]) for i in order[:n]])


class Forest:
    def __init__(self, ids: np.ndarray, x: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], x[order]
        self.planes = projections(TREES * DEPTH, x.shape[1], _SEED + 1)
        hashed = self.strings(self.x)
        self.order = np.argsort(hashed, axis=1, kind="stable")
        self.sorted = np.take_along_axis(hashed, self.order, axis=1)

    def strings(self, x: np.ndarray) -> np.ndarray:
        """A row of hash strings for each tree, the first bit the highest."""
        bits = (x @ self.planes.T > 0).reshape(len(x), TREES, DEPTH)
        return (bits << np.arange(DEPTH - 1, -1, -1)).sum(axis=2).T.copy()

    def candidates(self, q: np.ndarray, share: float, least: int) -> Iterator[np.ndarray]:
        """For each query the places of the members that came in most often on the way up, of equals the smaller vec_id."""
        n, hashed = len(self.ids), self.strings(q)
        together, most = TOGETHER * n, min(n, max(least, int(np.ceil(share * n))))
        # the ranges of the sorted arrays that share the prefix of each level, for all queries at once
        ranges = np.empty((DEPTH + 1, TREES, len(q), 2), np.int64)
        for level in range(DEPTH + 1):
            low = hashed >> (DEPTH - level) << (DEPTH - level)
            for t in range(TREES):
                ranges[level, t, :, 0] = np.searchsorted(self.sorted[t], low[t])
                ranges[level, t, :, 1] = np.searchsorted(self.sorted[t], low[t] + (1 << (DEPTH - level)))
        for i in range(len(q)):
            times = np.zeros(n, np.int16)
            for level in range(DEPTH, -1, -1):
                for t, (a, b) in enumerate(ranges[level, :, i].tolist()):
                    if a < b:
                        times[self.order[t, a:b]] += 1
                if np.count_nonzero(times) >= together:
                    break
            near = np.argsort(-times, kind="stable")[:most]
            yield near[times[near] > 0]


def nearest_of(forest: Forest, qid: np.ndarray, q: np.ndarray, k: int, share: float) -> list[np.ndarray]:
    """query ids, vec_ids and distances of each query's k nearest among its candidates."""
    out: list[list[np.ndarray]] = [[], [], []]
    for i, near in enumerate(forest.candidates(q, share, 4 * k)):
        near = near[forest.ids[near] != qid[i]]
        d = np.sqrt(((forest.x[near] - q[i]) ** 2).sum(axis=1))
        order = np.lexsort((forest.ids[near], d))
        ids, d = forest.ids[near][order], d[order]
        first = np.sort(np.unique(ids, return_index=True)[1])[:k]
        for col, v in zip(out, (np.full(first.size, qid[i]), ids[first], d[first]), strict=True):
            col.append(v)
    return [np.concatenate(c) for c in out]


def _vectors(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column("vec_id").to_numpy(), batch.column("v").flatten().to_numpy().reshape(batch.num_rows, -1)


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        yield dim, batch.filter(pa.array(dims == dim))


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, 4096):
        for dim, rows in _by_dim(batch):
            cells = ((_vectors(rows)[1] @ projections(CELL_BITS, dim, _SEED).T > 0) << np.arange(CELL_BITS - 1, -1, -1)).sum(axis=1)
            yield pa.RecordBatch.from_arrays([rows.column("dim"), pa.array(cells, pa.int32())], names=["dim", "cell"])


_ROUTED = "shard long, is_query boolean, vec_id long, v array<double>"


def _routed(routers):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 256):
            for dim, rows in _by_dim(batch):
                router = routers.value[dim]
                ids, x = _vectors(rows)
                yield pa.RecordBatch.from_arrays([pa.array(router.own(ids, x)), pa.array(np.zeros(len(ids), bool)), rows.column("vec_id"), rows.column("v")], names=[c.split()[0] for c in _ROUTED.split(", ")])
                asked = rows.filter(rows.column("asked"))
                for i, shards in enumerate(router.visits(_vectors(asked)[1]) if asked.num_rows else ()):
                    one = pa.array(np.full(shards.size, i))
                    yield pa.RecordBatch.from_arrays([pa.array(shards), pa.array(np.ones(shards.size, bool)), asked.column("vec_id").take(one), asked.column("v").take(one)], names=[c.split()[0] for c in _ROUTED.split(", ")])

    return run


def _search(k: int, share: float):
    """Of rows sorted by shard, vectors before queries: each query's nearest in its shard. A shard's vectors are held,
    its queries aren't."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, forest = None, [], None
        for batch in sliced(batches, 256):
            keys, asked = batch.column("shard").to_numpy(), batch.column("is_query").to_numpy(zero_copy_only=False)
            cuts = [0, *(((keys[1:] != keys[:-1]) | (asked[1:] != asked[:-1])).nonzero()[0] + 1).tolist(), len(keys)]
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                if keys[s] != shard:
                    shard, held, forest = keys[s], [], None
                some = _vectors(batch.slice(s, e - s))
                if not asked[s]:
                    held.append(some)
                elif held:
                    forest = forest or Forest(*(np.concatenate(c) for c in zip(*held, strict=True)))
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in nearest_of(forest, *some, k, share)], names=["query_id", "vec_id", "score"])

    return run


def sound(vectors: DataFrame) -> DataFrame:
    """vec_id, v and dim of the rows that take part, repeated ones once."""
    v = F.col("embedding").cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = vectors.select(F.col("vec_id").cast("long"), v.alias("v")).where("vec_id is not null and v is not null")
    return rows.where(~F.exists("v", bad) & F.exists("v", lambda x: x != 0)).withColumn("dim", F.size("v")).distinct()


def nearest(vectors: DataFrame, queries, k: int = 10, share: float = CANDIDATES, visited: float = VISITED) -> DataFrame:
    """query_id, rank, vec_id and score for the rows of vectors (vec_id, embedding) that the condition queries selects."""
    spark, held = vectors.sparkSession, []
    rows = written(sound(vectors), "vectors", held=held)
    # a row for each dimension and cell at most
    counts: dict[int, dict[int, int]] = {}
    for r in rows.select("dim", "v", "vec_id").mapInArrow(_cells, "dim int, cell int").groupBy("dim", "cell").count().collect():
        counts.setdefault(r["dim"], {})[r["cell"]] = r["count"]
    routers, first = {}, 0
    for dim in sorted(counts):
        routers[dim] = Router(dim, counts[dim], first, visited)
        first = routers[dim].end
    asked = F.coalesce(queries, F.lit(False)).alias("asked")
    routed = rows.select("vec_id", "v", "dim", asked).mapInArrow(_routed(spark.sparkContext.broadcast(routers)), _ROUTED)
    dealt = routed.repartition("shard").sortWithinPartitions("shard", "is_query")
    found = written(dealt.mapInArrow(_search(k, share), "query_id long, vec_id long, score double"), "found")
    removed(spark, held)
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
