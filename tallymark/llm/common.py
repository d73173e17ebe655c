"""What the operators share: table reading, shared storage, bounded bitmaps, word hashing."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of text in one Arrow batch; a worker holds one batch at a time.
BATCH_ROWS = 512
#: Parts over which by_parts() deals the rows of a key.
SALTS = 64
#: Bits of a bitmap() that is broadcast: 8 MB, whatever the input.
BITMAP_BITS = 1 << 26


def sliced(batches: Iterator[pa.RecordBatch], rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in slices of so many rows. Spark bounds a batch by its bytes (64 MB unless set); this bounds what a
    worker makes of it at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def sliced_by_bytes(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices whose texts in column have about that many bytes at most; a longer text is a slice alone."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        at, ends = 0, np.cumsum(size)
        while at < batch.num_rows:
            start = ends[at] - size[at]
            end = max(at + 1, int(np.searchsorted(ends, start + most, "right")))
            yield batch.slice(at, end - at)
            at = end


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, what: str) -> str:
    """A fresh folder name under spark.checkpoint.dir, which all executors see.

    Where that setting is absent a local master takes a temporary folder of its machine; a cluster can't, so it raises.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = os.environ.get("TALLYMARK_SCRATCH") or tempfile.mkdtemp(prefix="tallymark-")
        os.environ["TALLYMARK_SCRATCH"] = root
    return f"{root.rstrip('/')}/{what}-{uuid.uuid4().hex}"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """While it lasts, Arrow batches of BATCH_ROWS rows at most; afterwards the session is as it was."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(key)
    spark.conf.set(key, min(BATCH_ROWS, int(was)) if int(was) > 0 else BATCH_ROWS)
    try:
        yield
    finally:
        spark.conf.set(key, was)


def written(df: DataFrame, what: str, codec: str = "zstd", held: list[str] | None = None) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts the lineage, survives a lost executor. Its folder joins held."""
    path = shared_dir(df.sparkSession, what)
    with small_batches(df.sparkSession):
        df.write.option("compression", codec).parquet(path)
    if held is not None:
        held.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, held: list[str]) -> None:
    """Deletes the folders in held, which nothing reads any more, and empties it."""
    for path in held:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    held.clear()


def by_parts(rows: DataFrame, key: list[str], spread: str, what: dict[str, Column], merged: dict[str, Column], where: str = "true") -> tuple[DataFrame, DataFrame]:
    """Aggregates of a key, brought to its rows without dealing the rows by the key alone: a third of them may share it.

    what aggregates a part of a key (its rows dealt by a hash of spread over SALTS parts), merged the parts' results.
    Returns rows with the column _part, and for each key and part the results, of the keys that where selects: a join on
    key and _part gives each row its key's results, and meets a share 1 / SALTS of the key's rows in a task.
    """
    dealt = rows.withColumn("_part", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    parts = dealt.groupBy(*key, "_part").agg(*(c.alias(n) for n, c in what.items()))
    whole = parts.groupBy(*key).agg(*(c.alias(n) for n, c in merged.items())).where(where)
    return dealt, parts.drop(*(n for n in what if n in merged)).join(whole, key)


def joined_by_parts(rows: DataFrame, key: str, spread: str, keys: DataFrame, side: DataFrame) -> DataFrame:
    """rows joined to side on key, where a third of the rows may share one: a key's rows are dealt by spread over SALTS
    parts, and side goes to the parts that there are. keys, a written table, has the key and spread of all rows."""
    part = F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")
    parts = keys.select(key, part.alias("_part")).distinct().join(side, key)
    return rows.withColumn("_part", part).join(parts, [key, "_part"]).drop("_part")


def bitmap(df: DataFrame, column: str, bits: int = BITMAP_BITS) -> np.ndarray:
    """A bit for pmod(value, bits) of every value: a filter of fixed size with false positives only."""
    spot = F.pmod(F.col(column), F.lit(bits))
    rows = (
        df.where(F.col(column).isNotNull())
        .select(F.shiftright(spot, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(spot, F.lit(64)).cast("int")).alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    out = np.zeros(bits // 64, dtype=np.int64)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return out.view(np.uint64)


def in_bitmap(words: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Of int64 values, those whose bit is set."""
    spot = values.astype(np.int64).view(np.uint64) & np.uint64(words.size * 64 - 1)
    return (words[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63))) & np.uint64(1) == 1


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The batch's texts, null as the empty text."""
    return [x or "" for x in batch.column(column).to_pylist()]


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of every k consecutive items, in order; empty with fewer than k items.

    Doubling: runs of 1, 2, 4, ... are combined, so a window costs log k steps.
    """
    n = h.size - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, run, size, done = None, h, 1, 0
    while True:
        if k & size:
            part = run[done : done + n]
            out = part if out is None else mixed(out * np.uint64(0x9E3779B97F4A7C15) + part)
            done += size
        if done == k:
            return out if k > 1 else mixed(out)
        run = mixed(run[:-size] * np.uint64(0xD6E8FEB86659FD93) + run[size:])
        size *= 2


def by_key(batches: Iterator[pa.RecordBatch], key: list[str], rows: int) -> Iterator[pa.Table]:
    """Of batches sorted by key: tables of about that many rows that never part the rows of a key."""
    held: list[pa.Table] = []
    n = 0
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        n += batch.num_rows
        if n < rows:
            continue
        whole = pa.concat_tables(held)
        last = np.zeros(n, bool)
        for k in key:
            col = whole.column(k).to_numpy()
            last |= col != col[-1]
        cut = int(last.nonzero()[0][-1]) + 1 if last.any() else 0
        if cut:
            yield whole.slice(0, cut)
            held, n = [whole.slice(cut)], n - cut
    if n:
        yield pa.concat_tables(held)
