"""Per-turn drift on a stream, with per-session state of fixed size."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUTPUT = "session bigint, turn bigint, score double, z double"
STATE = "n bigint, mean double, m2 double"
IDLE_HOURS = 24


def _drift(idle_ms: int, key, batches: Iterator[pd.DataFrame], state: GroupState):
    if state.hasTimedOut:
        state.remove()
        return
    n, mean, m2 = state.get if state.exists else (0, 0.0, 0.0)
    rows = pd.concat(list(batches)).sort_values("turn")
    zs = []
    for x in rows["score"]:
        spread = (m2 / (n - 1)) ** 0.5 if n >= 2 else 0.0
        zs.append(round((x - mean) / spread, 6) if spread > 1e-9 else 0.0)
        n += 1
        step = x - mean
        mean += step / n
        m2 += step * (x - mean)
    state.update((n, mean, m2))
    state.setTimeoutTimestamp(state.getCurrentWatermarkMs() + idle_ms)
    yield rows.assign(session=key[0], z=zs)[["session", "turn", "score", "z"]]


def drift_stream(outcomes: DataFrame, late: str = "1 hour", idle_hours: float = IDLE_HOURS) -> DataFrame:
    """``z`` of every outcome (``session, turn, score, at``) against the earlier ones of
    its session; rows of one trigger are taken in turn order. The state is a running mean and variance;
    it is dropped once the watermark is ``idle_hours`` past the last outcomes, and a
    session that goes on after that starts anew.

    Needed because each row depends on the rows before it, which no built-in
    streaming aggregate can express. One session's new rows meet in one task, so
    the amount per trigger (``maxFilesPerTrigger``) bounds that task.
    """
    idle_ms = int(idle_hours * 3_600_000)

    def drift(key, batches, state):
        yield from _drift(idle_ms, key, batches, state)

    return (
        outcomes.withWatermark("at", late)
        .groupBy("session")
        .applyInPandasWithState(
            drift, OUTPUT, STATE, "append", GroupStateTimeout.EventTimeTimeout
        )
    )
