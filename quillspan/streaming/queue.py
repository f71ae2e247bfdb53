"""The queue's state machine on a stream of events, one entry's state at a time."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.queue import ATTEMPTS, REQUEUE_DELAY_MIN, REQUEUES, RETRY_DELAY_MIN, STALE_DELAY_MIN

_STATE = "status string, job_attempts int, requeues int, not_before double"


def advance(state: tuple[str, int, int, float], kind: str, at: float) -> tuple[str, int, int, float]:
    """The state of an entry after one event; the same rules as the batch replay."""
    status, attempts, requeues, not_before = state
    if status in ("COMPLETED", "ABANDONED", "IGNORED_TEST"):
        return state
    if kind not in ("partial", "stale"):
        new = {"dispatched": "RUNNING", "completed": "COMPLETED", "test": "IGNORED_TEST"}.get(kind, status)
        return new, attempts, requeues, not_before
    attempts += 1
    if attempts < ATTEMPTS:
        delay = STALE_DELAY_MIN if kind == "stale" else RETRY_DELAY_MIN.get(attempts + 1, 60)
        return "RETRY", attempts, requeues, at + delay * 60
    requeues += 1
    if requeues > REQUEUES:
        return "ABANDONED", attempts, requeues, not_before
    return "PENDING", attempts, requeues, at + REQUEUE_DELAY_MIN * 60


def entries(events: DataFrame) -> DataFrame:
    """key, status, job_attempts, requeues, not_before: a row for each key of a batch, after its events (key, seq, at, kind)."""

    def fold(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = tuple(state.get) if state.exists else ("PENDING", 0, 0, 0.0)
        for kind, at in pd.concat(list(frames)).sort_values("seq")[["kind", "at"]].itertuples(index=False):
            now = advance(now, kind, float(at))
        state.update(now)
        yield pd.DataFrame([(key[0], *now)], columns=["key", "status", "job_attempts", "requeues", "not_before"])

    return events.groupBy("key").applyInPandasWithState(fold, f"key string, {_STATE}", _STATE, "update", GroupStateTimeout.NoTimeout)
