"""Health of hosts over a stream of requests: refusal and failure streaks kept as state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from graphloom.operators.health import BACKOFF_AT, BACKOFF_BASE, LATCH_AT, REFUSALS

EVENTS = "host string, ts timestamp, status int, latched boolean, refusals int, failures int, backoff_seconds bigint"
STATE = "latched boolean, refusals int, failures int"
LONGEST = 86_400


def advance(state: tuple[bool, int, int], statuses: np.ndarray) -> tuple[dict[str, np.ndarray], tuple[bool, int, int]]:
    """What each of the outcomes of a host, in order, leaves behind, and the state after the last. A latch
    stays under success; the failure streak does not. No loop over outcomes: a streak is a running
    count less the count at the last success."""
    latched, refusals, failures = state
    fine, refused, failed = statuses < 400, np.isin(statuses, REFUSALS), statuses >= 500
    since = np.maximum.accumulate(np.where(fine, np.arange(len(statuses)), -1))

    def streak(counts: np.ndarray, before: int) -> np.ndarray:
        running = np.cumsum(counts)
        return np.where(since < 0, running + before, running - running[since])

    refusal, failure = streak(refused, refusals), streak(failed, failures)
    closed = np.logical_or.accumulate(refused & (refusal >= LATCH_AT)) | latched
    steps = np.clip(failure - BACKOFF_AT, 0, 40)
    waits = np.where(failed & (failure >= BACKOFF_AT), np.minimum(BACKOFF_BASE * 2.0**steps, LONGEST), 0).astype(np.int64)
    after = (bool(closed[-1]), int(refusal[-1]), int(failure[-1])) if len(statuses) else state
    return {"latched": closed, "refusals": refusal, "failures": failure, "backoff_seconds": waits}, after


def _update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    current = state.get if state.exists else (False, 0, 0)
    events = pd.concat(list(frames)).dropna(subset=["status"]).sort_values("ts", kind="stable")
    columns, after = advance(current, events["status"].to_numpy(dtype=np.int64))
    state.update(after)
    yield pd.DataFrame({"host": key[0], "ts": events["ts"].to_numpy(), "status": events["status"].to_numpy(dtype=np.int32), **columns})


def health_stream(requests: DataFrame) -> DataFrame:
    """Rows of EVENTS for a stream of (host, ts, status). Rows of one micro-batch are put in order
    of time; state is three numbers a host, and what a task holds is the rows of one host in one
    micro-batch, which the source's limit of files bounds. Rows with a null status are left out."""
    return requests.filter("host IS NOT NULL").groupBy("host").applyInPandasWithState(
        _update, EVENTS, STATE, "append", GroupStateTimeout.NoTimeout
    )
