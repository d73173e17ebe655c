"""Streams over tables that grow."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues
from pyspark.sql.types import LongType, StructField, StructType


def read(spark: SparkSession, path: str, name: str, files: int = 8) -> DataFrame:
    """A table's files as a stream, a bounded number in each batch; the schema is the table's own."""
    batch = spark.read.parquet(f"{path}/{name}.parquet")
    return spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", files).option("pathGlobFilter", "*.parquet").parquet(f"{path}/{name}.parquet*")


def tumbling(events: DataFrame, at: str, width: str, late: str, by: list[str], *aggregates: Column) -> DataFrame:
    """Aggregates over windows of a width; rows later than the watermark don't count. Batch or stream."""
    stamped = events.withColumn("_at", F.col(at).cast("timestamp"))
    if events.isStreaming:
        stamped = stamped.withWatermark("_at", late)
    return stamped.groupBy(F.window("_at", width), *by).agg(*aggregates).select(F.col("window.start").alias("window_start"), *by, *_names(aggregates))


def _names(aggregates: tuple[Column, ...]) -> list[str]:
    return [a._jc.toString().split(" AS ")[-1].strip("`") for a in aggregates]


def sessions(events: DataFrame, at: str, gap: str, late: str, by: str) -> DataFrame:
    """Sessions of a key, parted by gaps: start, end, events. Batch or stream."""
    stamped = events.withColumn("_at", F.col(at).cast("timestamp"))
    if events.isStreaming:
        stamped = stamped.withWatermark("_at", late)
    return stamped.groupBy(F.session_window("_at", gap), by).agg(F.count("*").alias("events")).select(by, F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), "events")


CHANGE = "uid string, hash string, dtstamp string, sequence int, change string"
#: Rows of a snapshot, or of a reading: a uid with its hash, and when the reading was made.
READ = "uid string, hash string, dtstamp string, at timestamp"


#: A bucket's state: a row for each of its uids, as columns; told says that a uid was called gone.
STATE = "uid array<string>, hash array<string>, dtstamp array<string>, sequence array<int>, seen array<bigint>, told array<boolean>"
_HELD = ["uid", "hash", "dtstamp", "sequence", "seen", "told"]


class ChangeProcessor(StatefulProcessor):
    """R15 with keyed state: a uid's last hash, stamp and sequence. The state of the last snapshot comes first; a row of
    the new reading says new, changed or same. When the watermark is `wait_ms` past a uid's last row, it was in none of
    the reading's rows: it is gone, keeps its state and waits for the next reading. A uid that is seen in no reading for
    `forget_ms` drops out of the state.

    The keys are buckets of uids by hash, so that state crosses to Python once for many uids, not once for each. A bucket
    has one timer, for the uid that is due first.
    """

    def __init__(self, wait_ms: int, forget_ms: int):
        self.wait_ms, self.forget_ms = wait_ms, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", STATE)

    def _held(self) -> dict[str, list]:
        return {r[0]: list(r[1:]) for r in zip(*self.last.get(), strict=True)} if self.last.exists() else {}

    def _due(self, seen: int, told: bool) -> int:
        return seen + (self.forget_ms if told else self.wait_ms)

    def _keep(self, held: dict[str, list]) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if not held:
            self.last.clear()
            return
        self.last.update((list(held), *(list(c) for c in zip(*held.values(), strict=True))))
        self.handle.registerTimer(min(self._due(h[3], h[4]) for h in held.values()))

    def handleInitialState(self, key: tuple, initialState: pd.DataFrame, timerValues: TimerValues) -> None:  # noqa: N802, N803  Spark's names
        held = self._held()
        for r in initialState.itertuples(index=False):
            held[r.uid] = [r.hash, r.dtstamp, int(r.sequence), _ms(r.at), False]
        self._keep(held)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held, out = None, []
        for frame in rows:
            frame = frame[frame["uid"].notna()]  # a row without one is the mark that a reading is at its end
            if held is None and len(frame):
                held = self._held()
            for r in frame.sort_values(["at", "dtstamp"]).itertuples(index=False):
                h, stamp, seq, seen, _ = held.get(r.uid, (None, None, -1, 0, False))
                change = "new" if seq < 0 else "same" if r.hash == h else "changed"
                if change != "same":
                    h, stamp, seq = r.hash, r.dtstamp, seq + 1
                held[r.uid] = [h, stamp, seq, max(seen, _ms(r.at)), False]
                out.append((r.uid, h, stamp, seq, change))
        if held is not None:
            self._keep(held)
            yield pd.DataFrame(out, columns=["uid", "hash", "dtstamp", "sequence", "change"])

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now, held, out = timerValues.getCurrentWatermarkInMs(), self._held(), []
        for uid, (h, stamp, seq, seen, told) in list(held.items()):
            if self._due(seen, told) > now:
                continue
            if told:
                del held[uid]
            else:
                held[uid][4] = True
                out.append((uid, h, stamp, seq, "gone"))
        self._keep(held)
        if out:
            yield pd.DataFrame(out, columns=["uid", "hash", "dtstamp", "sequence", "change"])

    def close(self) -> None:
        pass


def _ms(at: object) -> int:
    return int(pd.Timestamp(at).value // 1_000_000)


def change_stream(rows: DataFrame, snapshot: DataFrame | None = None, wait: str = "12 hours", late: str = "1 hour", forget_days: int = 90, buckets: int = 4096) -> DataFrame:
    """R15 as a stream: rows of READ in, a row of CHANGE out for each of them, and one for each uid that is gone.

    snapshot has the state to begin with: uid, hash, dtstamp, sequence and at, the time of its reading. A uid is gone once
    the readings are more than `wait` past its last one, by the watermark, which stays `late` behind the newest row; a
    reader may end with a row without a uid to move it. State is kept in RocksDB, so the session needs that provider (see
    state_store()). A batch reads and writes the state of the buckets it has uids of: choose so many that one holds some
    thousand uids at most, and don't change their number while a checkpoint is in use.
    """
    wait_ms = int(pd.Timedelta(wait).total_seconds() * 1000)
    bucket = F.pmod(F.xxhash64("uid"), F.lit(buckets)).cast("int").alias("bucket")
    first = snapshot.select(bucket, "*").groupBy("bucket") if snapshot is not None else None
    return (
        rows.withWatermark("at", late)
        .select(bucket, "*")
        .groupBy("bucket")
        .transformWithStateInPandas(statefulProcessor=ChangeProcessor(wait_ms, forget_days * 86_400_000), outputStructType=CHANGE, outputMode="append", timeMode="eventTime", initialState=first)
    )


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """While it lasts, streams that start keep their state in RocksDB."""
    key = "spark.sql.streaming.stateStore.providerClass"
    was = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(key, was)


def overwrite_partitions(stream: DataFrame, path: str, partition: str, checkpoint: str):
    """K3 as a stream: the partitions that a run of the stream has rows of are replaced by all its rows of them. A batch's
    rows are written under its number, so one that runs again writes the same, and what an earlier batch of the run wrote
    of a partition is read back with it; a partition that the run has no rows of stays as it is."""
    ours = f"{path.rstrip('/')}.run-{uuid.uuid4().hex}"

    def put(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{ours}/batch={number}")
        here = spark.read.schema(batch.schema).parquet(f"{ours}/batch={number}").select(partition).distinct()
        whole = spark.read.schema(StructType([*batch.schema.fields, StructField("batch", LongType())])).parquet(ours).where(F.col("batch") <= number).drop("batch")
        whole.join(here, partition, "left_semi").select(batch.columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
