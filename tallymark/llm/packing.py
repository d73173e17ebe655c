"""Best-fit packing in a tree.

Documents become pieces of at most `capacity` tokens; only longer ones are cut, and their first piece takes the rest.
Each leaf of the tree packs a bounded share of the pieces best-fit (largest first, into the fullest sequence with room).
Sequences that are full but for `slack` tokens are done; the others go up as items, and each node above packs those of
FAN nodes again, up to the root.

A node sends up CARRY sequences at most, the emptiest, so no task's input grows with the corpus. That loses none: best fit
leaves one sequence of a node half full or less at most (two would have been one), and two that are more than half full
never join. So what a node above can still join are its FAN small sequences at most with one each of the others, and
for that the emptiest CARRY of each node below are more than enough.

Defined cases: a null or empty text is the end id alone; null doc_ids are packed like others; repeated rows are packed
once for each row; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import sliced, table, texts, written
from .tokens import coder, public

CAPACITY = 1024
END = 2
LEAF = 16384
FAN = 16
CARRY = 4096
SLACK = 4

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_MEMBERS = f"array<struct<{', '.join(x.strip().replace(' ', ':', 1) for x in _PIECE.split(','))}>>"


def cuts(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n tokens."""
    first = n if n <= capacity else n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Rows of _PIECE for each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(tokenizer, special=True).encode
        tail = np.array([end], "<u4").tobytes()
        for batch in sliced(batches):
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                raw = memoryview(code(text) + tail)
                rows += [(doc, i, s, n, zlib.crc32(raw[4 * s : 4 * (s + n)])) for i, (s, n) in enumerate(cuts(len(raw) // 4, capacity))]
            cols = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _PIECE)


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins as lists of item numbers: items from the largest down, each into the fullest bin with room."""
    bins: list[list[int]] = []
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by the room they have left
    some = 0  # bit r is set where room[r] has a bin
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = some >> size
        if fits:
            r = size + (fits & -fits).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                some ^= 1 << r
            bins[b].append(i)
        else:
            b, r = len(bins), capacity
            bins.append([i])
        left = r - size
        if not room[left]:
            some |= 1 << left
        room[left].append(b)
    return bins


def _node(level: int, capacity: int, slack: int, root: bool):
    def run(items: pa.Table) -> pa.Table:
        sizes = items.column("used").to_numpy()
        node = items.column("node")[0].as_py()
        members = items.column("members").combine_chunks()
        bins = best_fit(sizes, capacity)
        used = np.array([sizes[b].sum() for b in bins], np.int64)
        done = np.ones(len(bins), bool)
        if not root:
            under = (capacity - used > slack).nonzero()[0]
            done[under[np.argsort(used[under], kind="stable")][:CARRY]] = False
        counts = np.diff(members.offsets.to_numpy())
        order = np.array([i for b in bins for i in b], np.int64)
        ends = np.cumsum([0, *(int(counts[b].sum()) for b in bins)])
        out = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), members.take(pa.array(order)).flatten())
        ids = ((level << 24 | node) << 32) + np.arange(len(bins), dtype=np.int64)
        return pa.table([pa.array(np.full(len(bins), node, np.int32)), pa.array(ids), pa.array(done), pa.array(used), out], names=["node", "sequence_id", "done", "used", "members"])

    return run


def pack(found: DataFrame, capacity: int = CAPACITY, slack: int = SLACK) -> DataFrame:
    """Rows of found (_PIECE, a written table) with sequence_id and offset."""
    full = found.where(F.col("length") == capacity).select("*", (F.lit(-1) - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = found.where(F.col("length") < capacity)
    nodes = max(1, -(-rest.count() // LEAF))
    names = [x.split()[0] for x in _PIECE.split(", ")]
    # by the row's number too, so that repeated rows don't share a leaf
    items = rest.select(F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(nodes)).cast("int").alias("node"), F.col("length").alias("used"), F.array(F.struct(*names)).alias("members"))
    level, done = 0, []
    schema = f"node int, sequence_id long, done boolean, used long, members {_MEMBERS}"
    while True:
        step = written(items.groupBy("node").applyInArrow(_node(level, capacity, slack, nodes == 1), schema), f"packed-{level}")
        done.append(step.where("done"))
        if nodes == 1:
            break
        nodes, level = -(-nodes // FAN), level + 1
        items = step.where("not done").select(F.pmod("node", F.lit(nodes)).cast("int").alias("node"), "used", "members")
    out = full
    for step in done:
        out = out.unionByName(step.select("sequence_id", "members").mapInArrow(_placed, f"{_PIECE}, sequence_id long, offset long"))
    return out


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each member of each sequence, with its offset there."""
    for batch in batches:
        members = batch.column("members")
        if not len(members):
            continue
        flat, counts = members.flatten(), np.diff(members.offsets.to_numpy())
        length = flat.field("length").to_numpy()
        before = np.cumsum(length) - length
        first = np.cumsum(counts) - counts
        offset = before - np.repeat(before[first], counts)
        names = [f.name for f in flat.type]
        yield pa.RecordBatch.from_arrays([*flat.flatten(), pa.array(np.repeat(batch.column("sequence_id").to_numpy(), counts)), pa.array(offset)], names=[*names, "sequence_id", "offset"])


def packed(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    return pack(written(pieces(docs, tokenizer, capacity, end), "pieces"), capacity)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), public("byte_bpe_50k.json")).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
