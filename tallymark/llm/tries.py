"""Prefix tries of conversations, in succinct level order.

Conversations that begin with the same turns share nodes. A node's key is the sum of hashes of (turn, position) along
its path, so that keys come from running sums, which are made in two steps: within the ranges of a sorted table, and
over the ranges before. Equal conversations are one sequence with a count from then on.

Of the paths only what two or more sequences share is a trie; a sequence's own remainder is a chain, whose figures
follow from its length and its characters. The shared part is cut into shards: subtrees of up to SHARD_ROWS rows, found
by adding up the rows below each key. In a shard numpy lays the nodes out level by level as a LOUDS bit vector (a one
for each child, then a zero, node after node) with an array of labels; parents are read from the bit vector, and a
reverse pass over the levels adds leaves and savings to them with np.add.at. The upper levels, whose subtrees are
larger than a shard, are merged from the deepest up by one aggregation a level over what their children bring.

Digests of the ids that end at a node are fed chunk by chunk, in order: memory holds one chunk, though SHA-256 itself
reads the ids of one node one after the other.

Defined cases: rows with a null conv_id are in no conversation and left out; a null turn comes before all others, equal
turns in the order of their SHA-256 hashes, repeated rows are turns of their own; null roles and texts are empty; other
columns are ignored; without any conversation there is no node, not even the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import by_key, removed, table, written

#: Rows of the largest shard.
SHARD_ROWS = 100_000
#: Ids in a chunk of a node's list of ends.
CHUNK_IDS = 50_000
ROOT = "0"

_NODES = "key string, up string, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, label (of role and text) and chars of every turn."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    label = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    return conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), label.alias("label"), F.length(text).cast("long").alias("chars"))


def _summed(rows: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """Running sums, this row included, over the rows of a conv_id; part says in which range of the order a row is. A
    long conversation is many ranges, so none of its sums is made in one task."""
    inside = Window.partitionBy("conv_id", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    over = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = rows.groupBy("conv_id", "part").agg(*(F.sum(c).alias(f"_{n}") for n, c in sums.items()))
    ranges = ranges.select("conv_id", "part", *(F.coalesce(F.sum(f"_{n}").over(over), F.lit(0)).alias(f"_{n}") for n in sums))
    out = rows.select("*", *(F.sum(c).over(inside).alias(n) for n, c in sums.items())).join(ranges, ["conv_id", "part"])
    return out.select(*rows.columns, *((F.col(n) + F.col(f"_{n}")).alias(n) for n in sums))


def with_shared_heads(turns: DataFrame, head: Column, base: Column, most: int, held: list[str]) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of another one.

    head (of conv_id) says how many, at most `most`; base, which conversation they are from. A conversation's own turns
    follow from its first after `head` on. Returns the rebuilt turns (conv_id, part, pos, label, chars), pos from 1, and
    all conversations (conv_id, n_turns), those without a turn left included.
    """
    order = [F.col("turn").asc_nulls_first(), F.col("label")]
    ranged = turns.repartitionByRange(F.col("conv_id"), *order).withColumn("part", F.spark_partition_id())
    own = _summed(written(ranged, "turns", held=held), order, {"place": F.lit(1)})
    own = written(own.withColumn("head", head), "places", held=held)
    heads = own.where(F.col("place") <= most).join(own.select(base.alias("conv_id")).distinct(), "conv_id", "left_semi")
    heads = heads.groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("place", "label", "chars"))).alias("first"))
    convs = own.groupBy("conv_id").agg(F.count("*").alias("own"), F.first("head").alias("head")).withColumn("base", base)
    convs = convs.join(heads, "base", "left").withColumn("first", F.slice(F.coalesce("first", F.array().cast("array<struct<place:bigint,label:string,chars:bigint>>")), F.lit(1), F.col("head").cast("int")))
    convs = convs.select("conv_id", "first", F.size("first").cast("long").alias("n_head"), (F.size("first") + F.greatest(F.col("own") - F.col("head"), F.lit(0))).alias("n_turns"))
    convs = written(convs, "convs", held=held)
    before = convs.select("conv_id", F.explode("first").alias("t")).select("conv_id", F.lit(-1).alias("part"), F.col("t.place").alias("pos"), "t.label", "t.chars")
    after = own.where("place > head").join(convs.select("conv_id", "n_head"), "conv_id")
    after = after.select("conv_id", "part", (F.col("n_head") + F.col("place") - F.col("head")).alias("pos"), "label", "chars")
    return written(before.unionByName(after), "rebuilt", held=held), convs.select("conv_id", "n_turns")


def louds(parent_of: list[np.ndarray]) -> np.ndarray:
    """The bit vector of a trie whose levels are given as their nodes' parents, numbered in level order from the root, 0."""
    n = 1 + sum(p.size for p in parent_of)
    degree = np.bincount(np.concatenate([*parent_of, np.empty(0, np.int64)]), minlength=n)
    bits = np.ones(int(degree.sum()) + n, bool)
    bits[np.cumsum(degree + 1) - 1] = False
    return bits


def parents(bits: np.ndarray) -> np.ndarray:
    """Of every node but the root: its parent is the number of zeros before the node's one."""
    ones = bits.nonzero()[0]
    return ones - np.arange(ones.size)


def children(bits: np.ndarray) -> np.ndarray:
    """Of every node: the ones before its zero, after that of the node before."""
    zeros = (~bits).nonzero()[0]
    return np.diff(zeros, prepend=-1) - 1


def shard_nodes(rows: pa.Table) -> pa.RecordBatch:
    """The nodes of a forest of shards. rows: level (from 1), conv_id, pos, key, up (the key before), n (conversations),
    chars, alone (whether the rest of the path is this sequence's alone), more (whether there is such a rest), rest (what
    that saves, this node included)."""
    col = {c: rows.column(c).to_numpy() for c in ("level", "conv_id", "pos", "n", "chars", "alone", "more", "rest")}
    label = rows.column("key").combine_chunks().dictionary_encode().indices.to_numpy()
    _, seq = np.unique(col["conv_id"], return_inverse=True)
    order = np.argsort(col["level"], kind="stable")
    cuts = np.searchsorted(col["level"][order], np.arange(1, int(col["level"].max()) + 2))
    node = np.zeros(rows.num_rows, np.int64)
    at = np.zeros(seq.max() + 1, np.int64)  # each sequence's node on the level before
    above, starts, n = [], [], 1
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        here = order[a:b]
        pairs, found = np.unique(np.stack([at[seq[here]], label[here]]), axis=1, return_inverse=True)
        node[here] = at[seq[here]] = n + found.reshape(-1)
        above.append(pairs[0])
        starts.append(n)
        n += pairs.shape[1]
    bits = louds(above)
    parent, degree = np.concatenate([[0], parents(bits)]), children(bits)
    size, least = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max)
    np.add.at(size, node, col["n"])
    np.minimum.at(least, node, col["conv_id"])
    one = np.zeros(n, np.int64)  # a row of each node
    one[node] = np.arange(rows.num_rows)
    alone = col["alone"][one]
    saved = np.where(alone, col["rest"][one], (size - 1) * col["chars"][one])
    leaves = (degree == 0).astype(np.int64)
    for a, b in reversed(list(zip(starts, [*starts[1:], n], strict=True))):
        np.add.at(saved, parent[a:b], saved[a:b])
        np.add.at(leaves, parent[a:b], leaves[a:b])
    degree = np.where(alone, col["more"][one], degree)
    top = parent[1:] == 0
    return pa.RecordBatch.from_arrays(
        [
            rows.column("key").combine_chunks().take(pa.array(one[1:])),
            rows.column("up").combine_chunks().take(pa.array(one[1:], mask=~top)),
            pa.array(col["pos"][one[1:]], pa.int64()),
            pa.array(least[1:]),
            pa.array(least[parent[1:]], mask=top),
            *(pa.array(x[1:].astype(np.int64)) for x in (size, degree, leaves, saved)),
        ],
        names=[x.split()[0] for x in _NODES.split(", ")],
    )


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in by_key(batches, ["shard"], SHARD_ROWS):
        yield shard_nodes(rows)


def end_digests(ends: DataFrame) -> DataFrame:
    """Of ends (key, conv_id): key and the SHA-256 of its ids, ascending, in decimal, joined by commas."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_key(batches, ["key", "conv_id"], CHUNK_IDS):
            key, ids = rows.column("key").to_numpy(), rows.column("conv_id").to_numpy()
            starts = np.concatenate([[0], (key[1:] != key[:-1]).nonzero()[0] + 1, [key.size]])
            spans = list(zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True))
            yield pa.RecordBatch.from_arrays([pa.array([key[a] for a, _ in spans], pa.string()), pa.array([ids[a] for a, _ in spans], pa.int64()), pa.array([",".join(map(str, ids[a:b].tolist())) for a, b in spans], pa.string())], names=["key", "first", "ids"])

    def fed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple[str, str]] = []
        at, sha = None, hashlib.sha256()
        for batch in batches:
            for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids"), strict=True):
                if key != at:
                    if at is not None:
                        done.append((at, sha.hexdigest()))
                    at, sha = key, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ids.as_buffer())
            if len(done) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=["key", "ends"])
                done = []
        if at is not None:
            done.append((at, sha.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=["key", "ends"])

    ranged = ends.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(chunks, "key string, first long, ids string")
    return ranged.repartition("key").sortWithinPartitions("key", "first").mapInArrow(fed, "key string, ends string")


def prefix_trie(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """The trie's nodes. rows: conv_id, part, pos (from 1), label, chars of every turn (part as for running sums); convs:
    conv_id and n_turns of every conversation. Returns the columns of op13_trie and key."""
    held: list[str] = []
    wide = F.xxhash64("label", "pos").cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(10,0)") + F.xxhash64("pos", "label").bitwiseAND(F.lit(0xFFFFFFFF)).cast("decimal(10,0)")
    rows = rows.withColumn("step", wide.cast("decimal(38,0)"))
    ends = rows.groupBy("conv_id").agg(F.sum("step").alias("key"), F.sum("chars").alias("all_chars"))
    ends = convs.join(ends, "conv_id", "left").select("conv_id", "n_turns", F.coalesce(F.col("key").cast("string"), F.lit(ROOT)).alias("key"), F.coalesce("all_chars", F.lit(0)).alias("all_chars"))
    ends = written(ends, "ends", held=held)
    seqs = ends.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n"), F.first("n_turns").alias("n_turns"), F.first("all_chars").alias("all_chars")).drop("key")
    paths = _summed(rows.join(seqs, "conv_id"), [F.col("pos")], {"sum": F.col("step"), "upto": F.col("chars")})
    paths = paths.select("conv_id", "pos", "chars", "n", "n_turns", F.col("sum").cast("string").alias("key"), (F.col("sum") - F.col("step")).cast("string").alias("up"), (F.col("all_chars") - F.col("upto") + F.col("chars")).alias("left"))
    paths = written(paths, "paths", held=held)

    same = ["pos", "chars", "n_turns", "up", "left"]
    nodes = paths.groupBy("key").agg(F.count("*").alias("n_seqs"), F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id"), *(F.first(c).alias(c) for c in same))
    nodes = written(nodes, "nodes", held=held)
    # a sequence's own nodes: the first is a leaf of the shared trie, the others a chain below it
    alone = nodes.where("n_seqs = 1").groupBy("conv_id").agg(F.min("pos").alias("from"))
    chain = nodes.where("n_seqs = 1").join(alone, "conv_id").where("pos > from")
    chain = chain.select("key", F.lit(None).cast("string").alias("up"), F.col("pos").alias("depth"), "conv_id", F.col("conv_id").alias("parent_conv_id"), "n_convs", (F.col("pos") < F.col("n_turns")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("left")).alias("saved_tokens"))

    shared = paths.join(alone, "conv_id", "left").where("from is null or pos <= from")
    shared = shared.withColumn("below", F.coalesce("from", "n_turns") - F.col("pos")).withColumn("alone", F.coalesce(F.col("pos") == F.col("from"), F.lit(False)))
    shared = written(shared, "shared", held=held)
    large = written(shared.groupBy("key").agg(F.sum("below").alias("below")).where(F.col("below") > SHARD_ROWS).select("key"), "large", held=held)
    # nodes with large subtrees are the first ones of a path; the one after them is a shard's root
    tops = shared.join(large, "key", "left_semi").groupBy("conv_id").agg(F.max("pos").alias("top"))
    cut = written(shared.join(tops, "conv_id", "left").withColumn("level", F.col("pos") - F.coalesce("top", F.lit(0))).where("level > 0"), "cut", held=held)
    roots = cut.where("level = 1").select("conv_id", F.xxhash64("key").alias("shard"))
    cut = cut.join(roots, "conv_id").select("shard", "level", "conv_id", "pos", "key", "up", "n", "chars", "alone", (F.col("alone") & (F.col("pos") < F.col("n_turns"))).alias("more"), ((F.col("n") - 1) * F.col("left")).alias("rest"))
    below = written(cut.repartition("shard").sortWithinPartitions("shard", "level", "conv_id").mapInArrow(_shards, _NODES), "below", held=held)

    # upper levels, the deepest first; what comes to a node: its children's number, leaves and savings
    brought = [below.where("up is not null").select("up", "n_leaves", "saved_tokens")]
    upper = nodes.join(large, "key", "left_semi").select("key", "up", F.col("pos").alias("depth"), "conv_id", "n_convs", "chars")
    root = ends.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(F.lit(ROOT).alias("key"), F.lit(None).cast("string").alias("up"), F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs", F.lit(0).cast("long").alias("chars"))
    upper = written(upper.unionByName(root), "upper", held=held)
    levels = []
    for depth in range(upper.agg(F.max("depth")).head()[0] or 0, -1, -1):
        came = brought[0] if not levels else brought[0].unionByName(levels[-1].select("up", "n_leaves", "saved_tokens"))
        came = came.groupBy(F.col("up").alias("key")).agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved"))
        level = upper.where(F.col("depth") == depth).join(came, "key", "left")
        level = level.select("key", "up", "depth", "conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"), (F.coalesce("saved", F.lit(0)) + (F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"))
        levels.append(written(level, "level", held=held))
    above = levels[0]
    for level in levels[1:]:
        above = above.unionByName(level)
    named = upper.select(F.col("key").alias("up"), F.col("conv_id").alias("above"))
    tied = below.unionByName(above.withColumn("parent_conv_id", F.lit(None).cast("long")).select(below.columns)).join(named, "up", "left")
    tied = tied.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above")).select(below.columns)
    out = tied.unionByName(chain).join(end_digests(ends.select("key", "conv_id")), "key", "left")
    nothing = hashlib.sha256().hexdigest()
    out = out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(nothing)).alias("ends_sha256"), "key")
    out = written(out, "trie")
    removed(out.sparkSession, held)
    return out


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    held: list[str] = []
    head = F.crc32(F.col("conv_id").cast("string")) % 6
    rows, convs = with_shared_heads(turns_of(table(spark, sf_dir, "conversations")), head, F.col("conv_id") - F.col("conv_id") % 100, 5, held)
    out = prefix_trie(rows, convs).drop("key")
    removed(spark, held)
    return out
