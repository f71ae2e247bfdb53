"""Telemetry as a stream: tumbling windows with late data, and exactly-once intake."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.status import is_bad

WINDOW_SECONDS = 10


def windows(events: DataFrame, keys: list[str], ts: str = "ts", seconds: int = WINDOW_SECONDS, late: str = "1 minute") -> DataFrame:
    """keys, window_start, n, bad of a stream (or a table) of outcomes; a window closes once the watermark has passed it."""
    w = F.window(ts, f"{seconds} seconds")
    g = events.withWatermark(ts, late).groupBy(*keys, w.alias("w")).agg(F.count(F.lit(1)).alias("n"), F.count_if(is_bad(F.col("status"))).alias("bad"))
    return g.select(*keys, F.col("w.start").alias("window_start"), "n", "bad")


def once(results: DataFrame, key: str = "key", ts: str = "ts", late: str = "3 hours") -> DataFrame:
    """Results as they come, each key once within the time it is remembered."""
    return results.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def rolling_ledger(results: DataFrame, ts: str = "ts", ttl_s: int = 3 * 3600) -> DataFrame:
    """worker, at, bad, probed: per batch of a worker's results its bad and probed over the last `ttl_s`, before the batch's own rows.

    results: worker, ts, bad, probed. The state is the rows of the time to live.
    """

    def fold(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        at, bad, probed = (list(x) for x in state.get) if state.exists else ([], [], [])
        pdf = pd.concat(list(frames)).sort_values(ts)
        now = pdf[ts].max().timestamp()
        alive = [i for i, t in enumerate(at) if now - t < ttl_s]
        at, bad, probed = [at[i] for i in alive], [bad[i] for i in alive], [probed[i] for i in alive]
        yield pd.DataFrame({"worker": [key[0]], "at": [now], "bad": [sum(bad)], "probed": [sum(probed)]})
        at += [t.timestamp() for t in pdf[ts]]
        state.update((at, bad + pdf["bad"].astype(int).tolist(), probed + pdf["probed"].astype(int).tolist()))

    return results.groupBy("worker").applyInPandasWithState(fold, "worker string, at double, bad long, probed long", "at array<double>, bad array<long>, probed array<long>", "append", GroupStateTimeout.NoTimeout)


def drain(stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], mode: str = "append") -> StreamingQuery:
    """Runs all that is there through `sink`, batch by batch, and stops. A batch that is run again has the same number."""
    writer: DataStreamWriter = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(sink)
    query = writer.start()
    query.awaitTermination()
    return query
