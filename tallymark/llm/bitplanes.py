"""Token ids in binary files of shuffled planes.

A file is a run of segments, each followed by a line feed. A segment is

    b"TMBP" | u32 length of header | u32 length of document index | u64 length of data | header | index | data

all little-endian. The ids of whole documents, end to end, are cut into blocks of BLOCK ids; a block is transposed into
byte planes (all lowest bytes, then all second bytes, ...) or bit planes, planes that are zero throughout are left out,
and each plane is a zstandard frame of its own. The header is JSON: part and seg (the place in the sequence of
segments), n_ids, kind ("byte" or "bit"), and the chunk index, for each block its first id, its ids, the offset of its
first plane in the data and the lengths of its planes. The document index is a zstandard frame of doc_id, a flag for a
null doc_id, and n_tokens as arrays. Blocks can be read alone through the chunk index.

Files are written and read by Spark's own text and binaryFile formats, so they can lie on any file system that Spark
reaches, and a task that is run again leaves no half-written file.

Defined cases: a null or empty text has the end id alone; null doc_ids come first; rows with equal doc_ids follow each
other in the order of their texts' hashes; an empty table gives no segments and an empty result; extra columns are ignored.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shared_dir, sliced, small_batches, table, texts, written
from .tokens import coder, public

MAGIC = b"TMBP"
HEAD = struct.Struct("<4sIIQ")
BLOCK = 1 << 16
#: Ids after which a segment ends, and segments after which a file does.
SEGMENT_IDS = 1 << 20
FILE_SEGMENTS = 16
END = 2


def planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """The block's planes from the lowest up; the last one holds a bit that is set."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        out = [raw[:, i].tobytes() for i in range(4)]
    else:
        bits = np.unpackbits(raw, axis=1, bitorder="little")
        out = [np.packbits(bits[:, i]).tobytes() for i in range(32)]
    while out and not any(out[-1]):
        out.pop()
    return out


def unplaned(found: list[bytes], n: int, kind: str) -> np.ndarray:
    if kind == "byte":
        raw = np.zeros((n, 4), np.uint8)
        for i, x in enumerate(found):
            raw[:, i] = np.frombuffer(x, np.uint8)
    else:
        bits = np.zeros((n, 32), np.uint8)
        for i, x in enumerate(found):
            bits[:, i] = np.unpackbits(np.frombuffer(x, np.uint8), count=n)
        raw = np.packbits(bits, axis=1, bitorder="little")
    return raw.reshape(-1).view("<u4")


def segment(part: int, seg: int, docs: list, counts: list[int], ids: np.ndarray, kind: str, level: int = 3) -> bytes:
    zip_ = zstandard.ZstdCompressor(level=level)
    data, chunks, at = [], [], 0
    for first in range(0, ids.size, BLOCK):
        block = ids[first : first + BLOCK]
        frames = [zip_.compress(p) for p in planes(block, kind)]
        chunks.append([first, int(block.size), at, [len(f) for f in frames]])
        at += sum(map(len, frames))
        data += frames
    header = json.dumps({"part": part, "seg": seg, "n_ids": int(ids.size), "n_docs": len(docs), "kind": kind, "chunks": chunks}).encode()
    index = zip_.compress(np.array([d or 0 for d in docs], "<i8").tobytes() + np.array([d is None for d in docs], "u1").tobytes() + np.array(counts, "<u4").tobytes())
    return HEAD.pack(MAGIC, len(header), len(index), at) + header + index + b"".join(data)


def segments(content: bytes) -> Iterator[tuple[dict, np.ndarray, np.ndarray, np.ndarray, memoryview]]:
    """Of a file: header, doc_ids, which of them are null, token counts, data."""
    view, at = memoryview(content), 0
    while at < len(view):
        magic, h, x, d = HEAD.unpack_from(view, at)
        if magic != MAGIC:
            raise ValueError(f"no segment at byte {at}")
        at += HEAD.size
        header = json.loads(bytes(view[at : at + h]))
        index = zstandard.ZstdDecompressor().decompress(view[at + h : at + h + x])
        n = header["n_docs"]
        yield header, np.frombuffer(index, "<i8", n), np.frombuffer(index, "u1", n, 8 * n).astype(bool), np.frombuffer(index, "<u4", n, 9 * n), view[at + h + x : at + h + x + d]
        at += h + x + d + 1


def block(header: dict, data: memoryview, i: int) -> np.ndarray:
    """One block by the chunk index."""
    unzip = zstandard.ZstdDecompressor()
    _, n, at, sizes = header["chunks"][i]
    found = []
    for size in sizes:
        found.append(unzip.decompress(data[at : at + size]))
        at += size
    return unplaned(found, n, header["kind"])


def all_ids(header: dict, data: memoryview) -> np.ndarray:
    parts = [block(header, data, i) for i in range(len(header["chunks"]))]
    return np.concatenate(parts) if parts else np.empty(0, "<u4")


def write_ids(docs: DataFrame, tokenizer: str, path: str, end: int = END, kind: str = "byte") -> None:
    """The ids of docs (doc_id, text) in ascending order of doc_id, as files in the folder path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, part, seg = coder(tokenizer, special=True).encode, TaskContext.get().partitionId(), 0
        tail = np.array([end], "<u4").tobytes()
        ids: list[str | None] = []
        held: list[bytes] = []
        n = 0

        def flush() -> pa.RecordBatch:
            out = segment(part, seg, ids, [len(x) // 4 for x in held], np.frombuffer(b"".join(held), "<u4"), kind)
            return pa.RecordBatch.from_arrays([pa.array([out], pa.binary())], names=["value"])

        for batch in sliced(batches):
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                ids.append(doc)
                held.append(code(text) + tail)
                n += len(held[-1]) // 4
                if n >= SEGMENT_IDS:
                    yield flush()
                    ids, held, n, seg = [], [], 0, seg + 1
        if ids:
            yield flush()

    # rows of one doc_id, or of none, are parted by their texts' hashes, and equal rows by the part they come from
    keyed = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("hash"), F.spark_partition_id().alias("part"))
    dealt = keyed.repartitionByRange("doc_id", "hash", "part").sortWithinPartitions("doc_id", "hash", "part").select("doc_id", "text")
    rows = dealt.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
    with small_batches(docs.sparkSession):
        rows.write.option("lineSep", "\n").option("maxRecordsPerFile", FILE_SEGMENTS).text(path)


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("content")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """part, seg, doc_id and the array ids of each document in the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                for header, docs, null, counts, data in segments(content.as_buffer()):
                    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([header[k]] * docs.size, pa.int32()) for k in ("part", "seg")] + [pa.array(docs, mask=null), pa.ListArray.from_arrays(offsets, pa.array(all_ids(header, data).astype(np.int32)))], names=["part", "seg", "doc_id", "ids"]
                    )

    return _read(spark, path).mapInArrow(run, "part int, seg int, doc_id long, ids array<int>")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Of each document in the files: part, seg, at (ids before it in its segment), doc_id, n_tokens, crc32 of its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                for header, docs, null, counts, data in segments(content.as_buffer()):
                    raw = memoryview(all_ids(header, data).tobytes())
                    ends = np.cumsum(counts.astype(np.int64))
                    crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([header[k]] * docs.size, pa.int32()) for k in ("part", "seg")] + [pa.array(ends - counts), pa.array(docs, mask=null), pa.array(counts, pa.int64()), pa.array(crc, pa.int64())],
                        names=["part", "seg", "at", "doc_id", "n_tokens", "ids_crc32"],
                    )

    return _read(spark, path).mapInArrow(run, "part int, seg int, at long, doc_id long, n_tokens long, ids_crc32 long")


def with_starts(index: DataFrame) -> DataFrame:
    """start: the ids of all documents before; sums by segment, then by part, so that no task sees all documents."""
    segs = index.groupBy("part", "seg").agg(F.sum("n_tokens").alias("n"))
    parts = segs.groupBy("part").agg(F.sum("n").alias("n"))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", before(Window.orderBy("part")).alias("part_start"))
    segs = segs.select("part", "seg", before(Window.partitionBy("part").orderBy("seg")).alias("seg_start")).join(parts, "part")
    return index.join(segs, ["part", "seg"]).withColumn("start", F.col("part_start") + F.col("seg_start") + F.col("at"))


def op8_bitplanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "ids")
    write_ids(table(spark, sf_dir, "documents"), public("word_bpe_49k.json"), path)
    index = written(read_index(spark, path), "id-index")
    return with_starts(index).select("doc_id", "start", "n_tokens", "ids_crc32")
