"""From raw documents to packed training sequences, in stages.

Each stage takes (spark, docs, sf_dir) and gives back a DataFrame; all but the last keep the columns of documents.
Nulls, repeated rows and empty tables are as the operators' modules define them. Rows that share a doc_id are one
document to the near-duplicate stage, which keeps one of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm import minhash, mixing, packing, pii, tokens, toxicity
from tallymark.llm.common import table, written


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Word shingles of five, similarity 0.8 or more; the smallest doc_id of a group stays. Of several rows with that
    doc_id one stays, the one with the smallest text (null before any); rows without a doc_id all stay."""
    judged = minhash.near_duplicates(docs, k=5, percent=80).where("doc_id is not null")
    judged = written(judged.groupBy("doc_id").agg(F.count("*").alias("rows"), F.first("kept").alias("kept")).where("not kept or rows > 1"), "judged")
    own = docs["doc_id"].cast("long") == judged["doc_id"]
    out = docs.join(judged, own, "left_anti")
    if judged.where("kept").head(1):
        # an aggregation, as very many rows may have one doc_id
        rows = docs.join(judged.where("kept"), own, "left_semi").select(F.col("doc_id").cast("long").alias("id"), F.struct("text").alias("by"), F.struct("*").alias("row"))
        out = out.unionByName(rows.groupBy("id").agg(F.min_by("row", "by").alias("row")).select("row.*"))
    return out


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated until the languages' words are at the target weights; none is lost."""
    return mixing.repeated(docs, table(spark, sf_dir, "labels"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, tokens.public("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", one_of_each_group),
    ("personal_data", redacted),
    ("mixing", to_weights),
    ("packing", packed),
]

#: The stages train models, hash and tokenize, which SQL can't express; tests/llm compares them with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
