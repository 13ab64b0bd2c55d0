import os

import pytest
from pyspark.sql import functions as F

from tidemark.streaming import followers as S

FOLDER = "/root/testdata/sf0.001"
HOUR = 3_600_000_000


@pytest.fixture(scope="module")
def days(spark, tmp_path_factory):
    """Events as files, a day each, in order."""
    root = str(tmp_path_factory.mktemp("days"))
    e = spark.read.parquet(f"{FOLDER}/events.parquet")
    for i, r in enumerate(sorted(e.select(F.to_date("ts").alias("d")).distinct().collect())):
        e.where(F.to_date("ts") == F.lit(r.d)).coalesce(1).write.parquet(f"{root}/tmp")
        name = next(f for f in os.listdir(f"{root}/tmp") if f.endswith(".parquet"))
        os.makedirs(f"{root}/in", exist_ok=True)
        os.rename(f"{root}/tmp/{name}", f"{root}/in/{i:03d}.parquet")
        os.utime(f"{root}/in/{i:03d}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
        for f in os.listdir(f"{root}/tmp"):
            os.unlink(f"{root}/tmp/{f}")
        os.rmdir(f"{root}/tmp")
    return f"{root}/in"


def test_readiness_equals_batch(spark, days, tmp_path):
    S.run_available(S.ready_series(S.event_stream(spark, days, 5), 5), str(tmp_path / "o"), str(tmp_path / "c"))
    got = {(r.user_id, r.ready_us) for r in spark.read.parquet(str(tmp_path / "o")).collect()}
    from tidemark.plans import QUERIES

    want = {(r.user_id, r.ready_us) for r in QUERIES["readiness"](spark, FOLDER).where("ready").collect()}
    assert {u for u, _ in got} == {u for u, _ in want} and got == want


def test_windows_and_late_rows(spark, days, tmp_path):
    S.run_available(S.cutoff_counts(S.event_stream(spark, days, 5), "0 seconds", "1 day"), str(tmp_path / "o"), str(tmp_path / "c"))
    got = {(r.start_us, r.event_type): r.n for r in spark.read.parquet(str(tmp_path / "o")).collect()}
    from tidemark.plans import QUERIES

    want = {(r.start_us, r.event_type): r.n for r in QUERIES["tumbling_windows"](spark, FOLDER).collect()}
    assert got and all(want[k] == n for k, n in got.items())
    cutoff = 1_705_276_800_000_000
    good, late = str(tmp_path / "g"), str(tmp_path / "l")
    S.run_batches(S.event_stream(spark, days, 10), lambda df, i: S.split_by_cutoff(df, i, cutoff, good, late), str(tmp_path / "c2"))
    n = spark.read.parquet(f"{FOLDER}/events.parquet").count()
    a, b = spark.read.parquet(good), spark.read.parquet(late)
    assert a.count() + b.count() == n
    assert a.agg(F.max(F.unix_micros("t"))).first()[0] <= cutoff < b.agg(F.min(F.unix_micros("t"))).first()[0]


def test_stalls_and_tracks(spark, days, tmp_path):
    S.run_available(S.stalls(S.event_stream(spark, days, 10), "6 hours", "0 seconds"), str(tmp_path / "o"), str(tmp_path / "c"))
    from tidemark.plans import QUERIES

    want = {(r.user_id, r.start_us, r.end_us, r.n) for r in QUERIES["sessions"](spark, FOLDER).collect()}
    got = {(r.user_id, r.start_us, r.end_us, r.n) for r in spark.read.parquet(str(tmp_path / "o")).collect()}
    assert got and got <= want
    S.run_available(S.track_stream(S.event_stream(spark, days, 10), 6 * HOUR - 1), str(tmp_path / "t"), str(tmp_path / "ct"))
    closed = {(r.user_id, r.start_us, r.last_us + 6 * HOUR, r.n) for r in spark.read.parquet(str(tmp_path / "t")).collect()}
    assert closed and closed <= want


def test_state_is_idempotent(spark, days, tmp_path):
    path = str(tmp_path / "state")
    put = S.upsert_state(path, ["user_id"], "t")
    S.run_batches(S.event_stream(spark, days, 10).select("user_id", "t", "event_type"), put, str(tmp_path / "c"))
    state = S.read_state(spark, path)
    e = spark.read.parquet(f"{FOLDER}/events.parquet")
    want = {r.user_id: r.k for r in e.groupBy("user_id").agg(F.max_by("event_type", "ts").alias("k")).collect()}
    assert {r.user_id: r.event_type for r in state.collect()} == want
    last = max(int(v[1:]) for v in os.listdir(path))
    batch = e.select("user_id", F.col("ts").cast("timestamp").alias("t"), "event_type")
    put(batch, last)
    put(batch, last)
    assert S.read_state(spark, path).count() == len(want)


def test_queue_retries_and_checkpoints(spark):
    rows = [("a", 0, "OPEN", 2, 0), ("b", 1, "OPEN", 1, 100), ("c", 2, "OPEN", 0, 0), ("d", 3, "DONE", 0, 0)]
    state = spark.createDataFrame(rows, S.STATE)
    assert S.next_item(state, 99, 2).first().item == "c"
    assert S.next_item(state, 100, 2).first().item == "b"
    later = S.after_failure(state, "c", 99, 50)
    assert S.next_item(later, 99, 2).first().item is None
    assert S.growing_checkpoint({1, 2}, {1}) == "EXPORT" and S.growing_checkpoint({1}, {1}) == "WAIT" and S.growing_checkpoint({2}, {1}) == "ATTENTION"
    assert S.with_retries(lambda i: i == 2, 3) == (2, True) and S.with_retries(lambda i: False, 3) == (3, False)
