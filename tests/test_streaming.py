"""Streams against the same rows as a table."""

import random

from pyspark.sql import functions as F

from quillspan.operators import queue as Q
from quillspan.streaming import queue, telemetry


def as_stream(spark, df, path, parts):
    """df as a stream of files, part by part; the column part says which."""
    for p in range(parts):
        df.where(F.col("part") == p).drop("part").coalesce(1).write.parquet(f"{path}/p{p}")
    return spark.readStream.schema(df.drop("part").schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(path)


def test_queue_like_the_replay(spark, tmp_path):
    rng = random.Random(3)
    rows = [(f"k{k}", i, float(i), rng.choice(["dispatched", "partial", "stale", "completed"]), i // 3) for k in range(8) for i in range(9)]
    df = spark.createDataFrame(rows, "key string, seq int, at double, kind string, part int")
    seen = {}
    telemetry.drain(queue.entries(as_stream(spark, df, f"{tmp_path}/in", 3)), f"{tmp_path}/c", lambda b, n: seen.update({r.key: tuple(r)[1:] for r in b.collect()}), "update")
    assert seen == {r.key: tuple(r)[1:] for r in Q.replay(df.drop("part")).collect()}


def test_windows_like_the_batch(spark, tmp_path):
    rows = [("w", 1_700_000_000 + 4 * i, "503" if i % 3 == 0 else "404", i // 20) for i in range(60)] + [("w", 1_700_009_000, "200", 3)]
    df = spark.createDataFrame(rows, "worker string, s long, status string, part int").select("worker", F.timestamp_seconds("s").alias("ts"), "status", "part")
    got = []
    telemetry.drain(telemetry.windows(as_stream(spark, df, f"{tmp_path}/in", 4), ["worker"]), f"{tmp_path}/c", lambda b, n: got.extend(b.collect()))
    want = {tuple(r) for r in telemetry.windows(df.drop("part").where("status <> '200'"), ["worker"]).collect()}
    assert {tuple(r) for r in got if r.n and r.window_start.year == 2023} >= want


def test_each_result_once(spark, tmp_path):
    rows = [("a", 1, 0), ("b", 2, 0), ("a", 3, 1), ("c", 4, 1)]
    df = spark.createDataFrame(rows, "key string, s long, part int").select("key", F.timestamp_seconds("s").alias("ts"), "part")
    got = []
    telemetry.drain(telemetry.once(as_stream(spark, df, f"{tmp_path}/in", 2)), f"{tmp_path}/c", lambda b, n: got.extend(r.key for r in b.collect()))
    assert sorted(got) == ["a", "b", "c"]


def test_ledger_lags_a_batch(spark, tmp_path):
    rows = [("w", 0, 1, 10, 0), ("w", 100, 2, 20, 1), ("w", 20_000, 4, 40, 2)]
    df = spark.createDataFrame(rows, "worker string, s long, bad long, probed long, part int").select("worker", F.timestamp_seconds("s").alias("ts"), "bad", "probed", "part")
    got = []
    telemetry.drain(telemetry.rolling_ledger(as_stream(spark, df, f"{tmp_path}/in", 3)), f"{tmp_path}/c", lambda b, n: got.extend((r.bad, r.probed) for r in b.collect()))
    assert got == [(0, 0), (1, 10), (0, 0)]
