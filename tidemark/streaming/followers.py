"""Streaming followers: readiness, cutoff, stall, quality state, checkpoints on growing sets, retries and tracking.

Event times without a zone are cast to timestamps first, as watermarks need them. Each follower has a batch twin; with
Trigger.AvailableNow over the same files both give the same rows.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def event_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """Event files as a stream, a bounded number of files in each micro-batch."""
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_per_trigger).parquet(path).withColumn("t", F.col("ts").cast("timestamp"))


def ready_series(events: DataFrame, required: int) -> DataFrame:
    """user_id, arrived, ready_at once all required artifacts (event types) have arrived; state is the set so far."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen = dict(zip(*state.get)) if state.exists else {}
        done = len(seen) >= required
        for pdf in batches:
            for kind, at in pdf.groupby("event_type")["t"].min().items():
                us = at.value // 1000
                seen[kind] = min(seen.get(kind, us), us)
        state.update((list(seen), list(seen.values())))
        if not done and len(seen) >= required:
            yield pd.DataFrame({"user_id": [key[0]], "arrived": [len(seen)], "ready_us": [max(seen.values())]})

    return events.groupBy("user_id").applyInPandasWithState(step, "user_id long, arrived long, ready_us long", "kinds array<string>, at array<long>", "append", GroupStateTimeout.NoTimeout)


def cutoff_counts(events: DataFrame, delay: str, window: str) -> DataFrame:
    """Windowed counts; rows later than the watermark are not let in."""
    return events.withWatermark("t", delay).groupBy(F.window("t", window).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.unix_micros("w.start").alias("start_us"), "event_type", "n")


def split_by_cutoff(df: DataFrame, epoch: int, cutoff_us: int, good: str, late: str) -> None:
    """A foreachBatch sink: rows at or before the cutoff to one table, later ones for ever to the other."""
    us = F.unix_micros("t")
    df.where(us <= cutoff_us).withColumn("epoch", F.lit(epoch)).write.mode("append").parquet(good)
    df.where(us > cutoff_us).withColumn("epoch", F.lit(epoch)).write.mode("append").parquet(late)


def stalls(events: DataFrame, gap: str, delay: str) -> DataFrame:
    """Sessions of activity; where one ends, the series has been idle for the gap."""
    w = events.withWatermark("t", delay).groupBy(F.session_window("t", gap).alias("w"), "user_id").agg(F.count("*").alias("n"))
    return w.select("user_id", F.unix_micros("w.start").alias("start_us"), F.unix_micros("w.end").alias("end_us"), "n")


def upsert_state(path: str, keys: list[str], order: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink that keeps the latest row of each key. A batch is a new version of the table in a folder of
    its own number, so that a batch that runs again gives the same version."""

    def put(batch: DataFrame, epoch: int) -> None:
        spark, before, target = batch.sparkSession, _latest(path, epoch), f"{path}/v{epoch:010d}"
        rows = batch if before is None else batch.unionByName(spark.read.schema(batch.schema).parquet(before))
        others = [c for c in batch.columns if c not in keys]
        rows.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col(order)).alias("r")).select(*keys, "r.*").select(*batch.columns).write.mode("overwrite").parquet(target)

    return put


def _latest(path: str, before: int | None = None) -> str | None:
    if not os.path.isdir(path):
        return None
    found = sorted(v for v in os.listdir(path) if v.startswith("v") and os.path.exists(f"{path}/{v}/_SUCCESS") and (before is None or int(v[1:]) < before))
    return f"{path}/{found[-1]}" if found else None


def read_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(_latest(path))


def next_item(state: DataFrame, now: int, most_attempts: int) -> DataFrame:
    """First queue item that isn't done, has attempts left and whose back-off is over; later ready work goes first."""
    ok = state.where((F.col("status") != "DONE") & (F.col("attempts") < most_attempts) & (F.col("not_before") <= now))
    return ok.groupBy().agg(F.min_by("item", "ord").alias("item"))


def after_failure(state: DataFrame, item: str, now: int, backoff: int) -> DataFrame:
    hit = F.col("item") == item
    return state.withColumn("attempts", F.when(hit, F.col("attempts") + 1).otherwise(F.col("attempts"))).withColumn("not_before", F.when(hit, now + backoff).otherwise(F.col("not_before")))


def growing_checkpoint(ready: set, best: set, least: int = 1) -> str:
    """What a follower does with a ready set against its last checkpoint."""
    if best - ready:
        return "ATTENTION"
    return "EXPORT" if len(ready - best) >= least else "WAIT"


def track_stream(events: DataFrame, most_gap_us: int) -> DataFrame:
    """Runs of each series with gaps up to most_gap_us as a stateful operator: state is the open run."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        start, last, n = state.get if state.exists else (None, None, 0)
        out = []
        for us in sorted(int(t.value // 1000) for pdf in batches for t in pdf["t"]):
            if start is not None and us - last > most_gap_us:
                out.append((key[0], start, last, n))
                start, n = None, 0
            start, last, n = us if start is None else start, us if last is None else max(last, us), n + 1
        if start is not None:
            state.update((start, last, n))
        if out:
            yield pd.DataFrame(out, columns=["user_id", "start_us", "last_us", "n"])

    return events.groupBy("user_id").applyInPandasWithState(step, "user_id long, start_us long, last_us long, n long", "start long, last long, n long", "append", GroupStateTimeout.NoTimeout)


def run_available(df: DataFrame, sink: str, checkpoint: str, mode: str = "append") -> None:
    """Process what is there and stop."""
    q = df.writeStream.format("parquet").outputMode(mode).option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def run_batches(df: DataFrame, put: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    q = df.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def with_retries(attempt: Callable[[int], bool], most: int) -> tuple[int, bool]:
    """Run attempt(i) until it is complete; the last one publishes what there is. Returns (attempts, complete)."""
    for i in range(1, most + 1):
        if attempt(i):
            return i, True
    return most, False


STATE = "item string, ord int, status string, attempts int, not_before long"
