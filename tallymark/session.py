"""A session with the settings the library's plans count on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "tallymark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    if master:
        builder = builder.master(master)
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    return builder.getOrCreate()
