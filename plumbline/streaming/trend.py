"""Drift and band trail of every outcome on a stream, kept per session in the state store.

Each row depends on the rows before it, which no built-in streaming aggregate can express.
Rows wait in a list state until the watermark has passed them and are then taken in the
order of time and turn, so the result does not depend on how they were spread over
files and triggers. What a session holds is the rows of its open time (the delay of the
watermark), five numbers and the current band; a timer removes it once it has been idle.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from plumbline.operators.decide import band_of

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# rows handed to the state store at once
CHUNK = 1000
IDLE_HOURS = 24 * 30
PENDING = "at bigint, turn bigint, score double, band string"
RUNNING = "n bigint, mean double, m2 double, band string, run_ix bigint, run_turns bigint, last_at bigint"


class SessionTrend(StatefulProcessor):
    """Per session: rows in order with ``z`` against the earlier ones and the run of their band."""

    def __init__(self, idle_ms: int) -> None:
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", PENDING)
        self.running = handle.getValueState("running", RUNNING)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        chunk, first = [], None
        for row in rows:
            at = row["at_ms"]
            first = at if first is None or at < first else first
            chunk.append((at, row["turn"], row["score"], row["band"]))
            if len(chunk) == CHUNK:
                self.pending.appendList(chunk)
                chunk = []
        if chunk:
            self.pending.appendList(chunk)
        if first is not None:
            self._wake(first, timerValues)
        return iter([])

    def _wake(self, at: int, timerValues) -> None:
        self.handle.registerTimer(max(at, timerValues.getCurrentWatermarkInMs() + 1))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        ready, waiting = [], []
        for at, turn, score, band in self.pending.get():
            (ready if at <= watermark else waiting).append((at, turn, score, band))
        if ready:
            if waiting:
                self.pending.put(waiting)
            else:
                self.pending.clear()
            ready.sort(key=lambda r: r[:2])
            yield from self._advance(key[0], ready)
        if waiting:
            self._wake(min(r[0] for r in waiting), timerValues)
        elif self.running.exists():
            gone = self.running.get()[6] + self.idle_ms
            if gone <= watermark:
                self.running.clear()
            else:
                self.handle.registerTimer(gone)

    def _advance(self, session, rows: list[tuple]) -> Iterator[Row]:
        fresh = (0, 0.0, 0.0, None, -1, 0, None)
        n, mean, m2, band, run_ix, run_turns, last_at = self.running.get() if self.running.exists() else fresh
        for at, turn, score, now in rows:
            # the timer may come later than the next row; the result must not depend on that
            if last_at is not None and at - last_at >= self.idle_ms:
                n, mean, m2, band, run_ix, run_turns, last_at = fresh
            if run_ix < 0 or now != band:
                band, run_ix, run_turns = now, run_ix + 1, 0
            run_turns += 1
            z = 0.0
            if score is not None:
                spread = (m2 / (n - 1)) ** 0.5 if n >= 2 else 0.0
                z = round((score - mean) / spread, 6) if spread > 1e-9 else 0.0
                n += 1
                step = score - mean
                mean += step / n
                m2 += step * (score - mean)
            last_at = at if last_at is None else max(last_at, at)
            yield Row(session=session, turn=turn, score=score, z=z, band=band, run_ix=run_ix, run_turns=run_turns)
        self.running.update((n, mean, m2, band, run_ix, run_turns, last_at))

    def close(self) -> None:
        pass


def trend_stream(
    outcomes: DataFrame, late: str = "1 hour", idle_hours: float = IDLE_HOURS, amber_at: float = 0.2, green_at: float = 0.35
) -> DataFrame:
    """``session, turn, score, z, band, run_ix, run_turns`` of ``outcomes(session, turn, score, at)``.

    ``z`` is the score against all earlier ones of the session, 0 where it is not defined;
    ``run_ix`` numbers the runs of one band and ``run_turns`` the turns of the run so far. A row
    is published once the watermark has passed it; rows later than ``late`` are dropped. A session
    that goes on after ``idle_hours`` starts anew. Rows without a score have band
    ``unknown`` and leave the mean as it is. Start it inside :func:`rocksdb`.
    """
    session = outcomes.schema["session"].dataType.simpleString()
    turn = outcomes.schema["turn"].dataType.simpleString()
    shaped = outcomes.withWatermark("at", late).select(
        "session", "turn", "score", band_of(F.col("score"), amber_at, green_at).alias("band"), "at", F.unix_millis("at").alias("at_ms")
    )
    return shaped.groupBy("session").transformWithState(
        SessionTrend(int(idle_hours * 3_600_000)),
        f"session {session}, turn {turn}, score double, z double, band string, run_ix bigint, run_turns bigint",
        "append",
        "EventTime",
    )


class rocksdb:
    """The state store that :func:`trend_stream` needs, for queries started inside ``with``."""

    def __init__(self, spark: SparkSession) -> None:
        self.conf = spark.conf

    def __enter__(self) -> None:
        self.before = self.conf.get(PROVIDER, None)
        self.conf.set(PROVIDER, ROCKSDB)

    def __exit__(self, *error) -> None:
        if self.before is None:
            self.conf.unset(PROVIDER)
        else:
            self.conf.set(PROVIDER, self.before)
