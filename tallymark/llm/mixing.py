"""Mixing domains to target weights by soft membership, in DataFrame operations only.

1. A multinomial word model, trained on a bounded sample (LABELLED rows) of the documents that the labelled table names,
   gives every document posteriors p over the domains; words are hashed into BUCKETS, whole texts are read, and the
   evidence is tempered to that of CALIBRATED words at most, so that long documents stay soft members too.
2. Document i of t_i words gets a rate r_i >= 0, with r_i t_i p_i its expected words by domain. The rates minimise the
   squared distance of the totals to the targets by projected gradient steps

       r_i <- max(0, r_i + p_i . x),   G x = T - sum_i r_i t_i p_i,   G = sum_i t_i p_i p_i'

   G, of domains by domains, scales the gradient so that a step that projects nothing meets the targets exactly. A step
   is one aggregation of as many sums as there are domains; a rate is a function of its own document and of the steps'
   x so far, so rates are never stored or joined.

Defined cases: null and empty texts have no words, uniform posteriors and the rate that these give; a null doc_id has a
rate like any other; repeated rows count each; without labelled documents all posteriors are uniform; labelled rows
of other domains than the targets' are ignored; a table without words has all rates 1; extra columns are kept, except
that mixed() puts its own in the place of columns of their names.
"""

from __future__ import annotations

import warnings
from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written

#: Target weights of the registered query and of the pipeline, by language.
WEIGHTS = {"en": 0.5, "de": 0.18, "fr": 0.18, "es": 0.14}
LABELLED = 4000
BUCKETS = 1024
CALIBRATED = 48
STEPS = 40
CLOSE = 1e-6
#: A step that leaves more than this share of the gap is the last one.
STALLED = 0.999
#: With rates of 1 or more: the targets' sum over the least that leaves the largest domain whole.
ROOM = 1.02


def _buckets() -> Column:
    words = F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int"))


def train(docs: DataFrame, labelled: DataFrame, domains: list[str], column: str) -> list[list[float]]:
    """Log-probabilities by domain and bucket, from docs that labelled (doc_id) names; their domain is in column."""
    chosen = labelled.select("doc_id").where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED)
    known = docs.select("doc_id", "text", F.col(column).alias("domain")).where(F.col("domain").isin(*domains))
    rows = known.join(F.broadcast(chosen), "doc_id").select("domain", F.explode(_buckets()).alias("bucket")).groupBy("domain", "bucket").count().collect()
    counts = {d: [1.0] * BUCKETS for d in domains}
    for r in rows:
        counts[r["domain"]][r["bucket"]] += r["count"]
    return [[log(x / sum(counts[d])) for x in counts[d]] for d in domains]


def with_posteriors(docs: DataFrame, model: list[list[float]], names: list[str]) -> DataFrame:
    """docs with words and, under the given names, the posterior of each domain."""
    logs = [F.array(*(F.lit(x) for x in m)) for m in model]
    total = lambda m: F.aggregate("_buckets", F.lit(0.0), lambda a, i: a + F.get(m, i))
    out = docs.withColumn("_buckets", _buckets()).select("*", F.size("_buckets").cast("long").alias("words"), *(total(m).alias(f"_l{k}") for k, m in enumerate(logs))).drop("_buckets")
    temper = F.when(F.col("words") > CALIBRATED, CALIBRATED / F.col("words")).otherwise(1.0)
    most = F.greatest(*(F.col(f"_l{k}") for k in range(len(model)))) if len(model) > 1 else F.col("_l0")
    out = out.select("*", *(F.exp((F.col(f"_l{k}") - most) * temper).alias(f"_e{k}") for k in range(len(model))))
    whole = sum((F.col(f"_e{k}") for k in range(1, len(model))), F.col("_e0"))
    out = out.select("*", *((F.col(f"_e{k}") / whole).alias(n) for k, n in enumerate(names)))
    return out.drop(*(f"_{c}{k}" for c in "le" for k in range(len(model))))


def solve(g: list[list[float]], v: list[float]) -> list[float]:
    """x with g x = v, by elimination with a slight ridge; zero where g is."""
    n = len(v)
    ridge = 1e-12 * sum(g[i][i] for i in range(n))
    if ridge <= 0:
        return [0.0] * n
    a = [[*row, y] for row, y in zip(g, v, strict=True)]
    for i in range(n):
        a[i][i] += ridge
    for i in range(n):
        p = max(range(i, n), key=lambda r: abs(a[r][i]))
        a[i], a[p] = a[p], a[i]
        for r in range(n):
            if r != i:
                f = a[r][i] / a[i][i]
                a[r] = [x - f * y for x, y in zip(a[r], a[i], strict=True)]
    return [a[i][n] / a[i][i] for i in range(n)]


def rate(names: list[str], steps: list[list[float]], least: float = 0.0) -> Column:
    out = F.lit(1.0)
    for x in steps:
        out = F.greatest(F.lit(least), out + sum((F.col(n) * c for n, c in zip(names, x, strict=True)), F.lit(0.0)))
    return out


def fit(members: DataFrame, names: list[str], weights: list[float], keep_all: bool = False) -> list[list[float]]:
    """The steps' x for members (words and posteriors). The targets sum to all words. With keep_all rates are 1 or more,
    and the targets sum to ROOM times what the domain that is furthest over its weight needs to stay whole, as
    documents of the other domains belong to that one a little too. Ends after STEPS, or where a step no longer
    narrows the gap, and warns of what is left of it."""
    sums = lambda r: [F.sum(r * F.col("words") * F.col(n)).alias(f"s{k}") for k, n in enumerate(names)]
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    first = members.agg(*sums(F.lit(1.0)), *(F.sum(F.col("words") * F.col(names[i]) * F.col(names[j])).alias(f"g{i}_{j}") for i, j in pairs)).first()
    g = [[first[f"g{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(len(names))] for i in range(len(names))]
    now = [first[f"s{k}"] or 0.0 for k in range(len(names))]
    share = [w / sum(weights) for w in weights]
    whole = ROOM * max(n / w for n, w in zip(now, share, strict=True) if w > 0) if keep_all else sum(now)
    steps: list[list[float]] = []
    gap = float("inf")
    while True:
        short = [w * whole - n for w, n in zip(share, now, strict=True)]
        before, gap = gap, sum(map(abs, short))
        if gap <= CLOSE * whole:
            break
        if len(steps) == STEPS or gap > STALLED * before:
            warnings.warn(f"the totals miss the targets by {gap / whole:.3g} of all words after {STEPS} steps", stacklevel=2)
            break
        steps.append(solve(g, short))
        got = members.agg(*sums(rate(names, steps, float(keep_all)))).first()
        now = [got[f"s{k}"] or 0.0 for k in range(len(names))]
    return steps


def _rated(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], column: str, keep_all: bool) -> tuple[DataFrame, list[str]]:
    """row (the columns of docs), words, posteriors and rate, and the posteriors' names."""
    names = [f"p_{d}" for d in weights]
    model = train(docs, labelled, list(weights), column)
    members = written(with_posteriors(docs.select("text"), model, names).select("words", *names), "members")
    least = 1.0 if keep_all else 0.0
    steps = fit(members, names, list(weights.values()), keep_all)
    rows = with_posteriors(docs.select(F.struct("*").alias("row"), "text"), model, names)
    return rows.withColumn("rate", rate(names, steps, least)), names


def mixed(docs: DataFrame, labelled: DataFrame, weights: dict[str, float] | None = None, column: str = "lang") -> DataFrame:
    """docs with words, a posterior p_<domain> for each domain, and rate, in the place of columns of these names."""
    out, names = _rated(docs, labelled, weights or WEIGHTS, column, False)
    new = ["words", *names, "rate"]
    return out.select(*(F.col("row")[c].alias(c) for c in docs.columns if c not in new), *new)


def repeated(docs: DataFrame, labelled: DataFrame, weights: dict[str, float] | None = None, column: str = "lang") -> DataFrame:
    """The columns of docs, each row as often as its rate says: its whole part, and once more with the fraction's chance
    by a hash of doc_id. Rates are 1 or more, so each row stays at least once."""
    out, _ = _rated(docs, labelled, weights or WEIGHTS, column, True)
    chance = F.pmod(F.xxhash64(F.col("row")["doc_id"], F.lit("mixing")), F.lit(1_000_000)) / 1_000_000
    times = F.greatest(F.lit(1), F.floor(F.col("rate") + chance).cast("int"))
    return out.select("row", F.explode(F.sequence(F.lit(1), times))).select("row.*")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = mixed(docs, table(spark, sf_dir, "labels"))
    return out.select("doc_id", "words", *(f"p_{d}" for d in WEIGHTS), "rate")
