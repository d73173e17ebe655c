"""Folders that the driver and all executors see."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, what: str) -> str:
    """A fresh folder name under spark.checkpoint.dir; a local master without that setting takes one of its machine, a
    cluster can't, so it raises."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = os.environ.get("TALLYMARK_SCRATCH") or tempfile.mkdtemp(prefix="tallymark-")
        os.environ["TALLYMARK_SCRATCH"] = root
    return f"{root.rstrip('/')}/{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str, held: list[str] | None = None) -> DataFrame:
    """df as a table in the shared folder: cuts the lineage of a loop, survives a lost executor. Its folder joins held."""
    path = shared_path(df.sparkSession, what)
    df.write.option("compression", "zstd").parquet(path)
    if held is not None:
        held.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _folder(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table lies at path: a folder with something in it besides marks and logs, or a file."""
    at, files = _folder(spark, path)
    if not files.exists(at):
        return False
    return files.getFileStatus(at).isFile() or any(not f.getPath().getName().startswith(("_", ".")) for f in files.listStatus(at))


def removed(spark: SparkSession, paths: list[str]) -> None:
    """Deletes folders that nothing reads any more, and empties the list."""
    for path in paths:
        at, files = _folder(spark, path)
        files.delete(at, True)
    paths.clear()


def named_documents(spark: SparkSession, path: str, column: str) -> None:
    """Of a folder that is partitioned by column, each partition's one file as <value>.json beside the partitions, which
    go. For a bounded number of published documents: the driver renames them one by one."""
    at, files = _folder(spark, path)
    for folder in [f.getPath() for f in files.listStatus(at) if f.getPath().getName().startswith(f"{column}=")]:
        parts = [f.getPath() for f in files.listStatus(folder) if f.getPath().getName().startswith("part-")]
        if len(parts) != 1:
            raise ValueError(f"{folder.getName()} holds {len(parts)} files, not one document")
        files.rename(parts[0], spark._jvm.org.apache.hadoop.fs.Path(at, folder.getName().partition("=")[2] + ".json"))
        files.delete(folder, True)


def moved_into_place(spark: SparkSession, fresh: str, path: str) -> None:
    """Puts the written folder fresh at path. What was there is set aside first and deleted last, so at each moment the
    old or the new table is whole, and a move that fails puts the old one back."""
    at, files = _folder(spark, path)
    new, aside = (spark._jvm.org.apache.hadoop.fs.Path(x) for x in (fresh, f"{path.rstrip('/')}.before-{uuid.uuid4().hex}"))
    had = files.exists(at)
    if had and not files.rename(at, aside):
        raise OSError(f"{path} can't be set aside")
    if not files.rename(new, at):
        if had:
            files.rename(aside, at)
        raise OSError(f"{fresh} can't be moved to {path}")
    if had:
        files.delete(aside, True)
