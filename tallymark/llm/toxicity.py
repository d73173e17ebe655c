"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over the distinct words of a text and their beginnings, trained in numpy from confirmed toxic examples and unlabelled
text. The risk of the positives is weighted by the class prior, and the part of the unlabelled risk that the positives
explain is subtracted; where that difference turns negative, as it does once the model overfits, the step goes the
other way. Labels of non-toxic rows are never read, except that their number gives the class prior.

Training reads a sample of the labelled rows, the smallest hashes of doc_id: `positives` of the toxic ones, and
`unlabelled` of all of them without their labels. Both bounds are arguments, None takes every row; scoring reads every
whole text. The weights, one float for each of DIM hash buckets, are all that is sent to the executors.

Defined cases: null and empty texts get the score of a text without words; a null doc_id is scored and isn't held out;
repeated rows are scored row by row; labels repeated for one doc_id count as toxic if any is; null labels are no
labels; without positives every score is 0; columns other than doc_id, text and toxic are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import sliced, table, texts

DIM = 1 << 18
#: Labelled rows that training reads: toxic ones, and any, their labels unseen.
POSITIVES = 4000
UNLABELLED = 12000
#: Letters of the word beginnings that are features of their own.
STEMS = (6, 5, 4)
_WORD = re.compile(r"[^\W\d_]+")


def features(text: str) -> np.ndarray:
    """Hash buckets of the text's distinct words and of their beginnings, which inflected forms share; ascending."""
    words = set(_WORD.findall(text.lower()))
    for k in STEMS:
        words |= {w[:k] + "-" for w in words if len(w) > k}
    return np.unique(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) % np.uint64(DIM)).astype(np.int32)


class Rows:
    """Sparse binary rows: bucket numbers end to end, and where each row starts."""

    def __init__(self, rows: list[np.ndarray]):
        self.ids = np.concatenate(rows) if rows else np.empty(0, np.int64)
        self.row = np.repeat(np.arange(len(rows)), [r.size for r in rows])
        self.n = len(rows)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.ids], self.n)

    def back(self, g: np.ndarray, dim: int) -> np.ndarray:
        return np.bincount(self.ids, g[self.row], dim)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _counts(rows: list[np.ndarray]) -> np.ndarray:
    """How many rows have each bucket; a few rows at a time, as the driver's memory is small."""
    out = np.zeros(DIM, np.int64)
    for i in range(0, len(rows), 256):
        out += np.bincount(np.concatenate(rows[i : i + 256]), minlength=DIM)
    return out


def nnpu(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, steps: int = 200, rate: float = 0.05, decay: float = 5e-4, least_df: float = 0.005, least_lift: float = 1.5) -> tuple[np.ndarray, float]:
    """Weights and bias; the loss is logistic, the optimiser Adam.

    A bucket takes part if a share least_df of the positives (5 at least, 2 of few) have it, least_lift times the share
    of the unlabelled texts that do.
    """
    df, free = _counts(positive), _counts(unlabelled)
    common = df >= max(min(5, max(2, len(positive) // 10)), least_df * len(positive))
    used = (common & (df * len(unlabelled) >= least_lift * free * len(positive))).nonzero()[0]
    place = np.full(DIM, -1)
    place[used] = np.arange(used.size)
    p, u = (Rows([(x := place[r])[x >= 0] for r in rows]) for rows in (positive, unlabelled))
    w, b = np.zeros(used.size), float(np.log(prior / (1 - prior)))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, steps + 1):
        zp, zu = p.dot(w) + b, u.dot(w) + b
        # derivatives of log(1 + exp(-z)) and of log(1 + exp(z))
        dp_pos, dp_neg, du_neg = -_sigmoid(-zp) / p.n, _sigmoid(zp) / p.n, _sigmoid(zu) / u.n
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        if negative >= 0:
            gp, gu = prior * (dp_pos - dp_neg), du_neg
        else:
            gp, gu = prior * dp_neg, -du_neg
        g = p.back(gp, used.size) + u.back(gu, used.size) + decay * w
        gb = gp.sum() + gu.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        c1, c2 = 1 - 0.9**t, 1 - 0.999**t
        w = w - rate * (m / c1) / (np.sqrt(v / c2) + 1e-8)
        b = b - rate * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)
    out = np.zeros(DIM)
    out[used] = w
    return out, float(b)


def fold(doc_id: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(5))


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        rows = [features(t) for t in texts(batch)]
        yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(rows, pa.list_(pa.int32()))], names=["toxic", "ids"])


def train(docs: DataFrame, labels: DataFrame, class_prior: float | None = None, positives: int | None = POSITIVES, unlabelled: int | None = UNLABELLED) -> tuple[np.ndarray, float]:
    """The model from the rows of labels outside the held-out fold; class_prior None takes the share of toxic rows there."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold() != 0)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    said = known.agg(F.count("*").alias("n"), F.sum("toxic").alias("k")).first()
    if not said["k"]:
        return np.zeros(DIM), -60.0
    prior = class_prior or min(0.9, max(0.005, said["k"] / said["n"]))
    least = lambda df, n: df if n is None else df.orderBy(F.xxhash64("doc_id"), F.col("doc_id")).limit(n)
    pos = least(known.where("toxic = 1").select("doc_id", F.lit(1).alias("toxic")), positives)
    free = least(known.select("doc_id", F.lit(0).alias("toxic")), unlabelled)
    chosen = pos.unionByName(free)
    if positives is not None and unlabelled is not None:
        chosen = F.broadcast(chosen)  # as many rows as both bounds together
    got = docs.select("doc_id", "text").join(chosen, "doc_id").mapInArrow(_buckets, "toxic int, ids array<int>").toArrow()
    toxic = got.column("toxic").to_numpy()
    ids = got.column("ids").combine_chunks()
    at, flat = ids.offsets.to_numpy(), ids.values.to_numpy()
    rows = [flat[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
    positive, free_rows = ([r for r, t in zip(rows, toxic, strict=True) if t == k] for k in (1, 0))
    if not positive or not free_rows:
        return np.zeros(DIM), -60.0
    return nnpu(positive, free_rows, prior)


def _scores(batch_texts: list[str], w: np.ndarray, b: float) -> np.ndarray:
    return _sigmoid(np.fromiter((w[features(t)].sum() + b for t in batch_texts), np.float64, len(batch_texts)))


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of docs."""
    sent = docs.sparkSession.sparkContext.broadcast((model[0].astype(np.float32), model[1]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b = sent.value
        for batch in sliced(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(_scores(texts(batch), w, b), pa.float64())], names=["doc_id", "score"])

    out = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, model: tuple[np.ndarray, float], threshold: float = 0.5) -> DataFrame:
    """The rows of docs that score below the threshold, all columns as they are."""
    sent = docs.sparkSession.sparkContext.broadcast((model[0].astype(np.float32), model[1]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b = sent.value
        for batch in sliced(batches):
            yield batch.filter(pa.array(_scores(texts(batch), w, b) < threshold, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
