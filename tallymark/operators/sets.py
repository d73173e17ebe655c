"""Set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_of(sources: dict[str, DataFrame]) -> DataFrame:
    """The rows of all sources with their source; columns that one lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (df.withColumn("source", F.lit(name)) for name, df in sources.items()))


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of a beyond those of b, repeated rows counted."""
    return a.select(*sorted(a.columns)).exceptAll(b.select(*sorted(b.columns)))


def common(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows in both."""
    return a.select(*sorted(a.columns)).intersect(b.select(*sorted(b.columns)))


def compared(a: DataFrame, b: DataFrame) -> DataFrame:
    """U4: rows that only one side has, with side left or right, each as often as it has it more."""
    return difference(a, b).withColumn("side", F.lit("left")).unionByName(difference(b, a).withColumn("side", F.lit("right")))
