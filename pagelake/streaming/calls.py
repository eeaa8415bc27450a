"""The state of model calls as a stream: attempts come in, states and due retries go out.

Each call's state lives in the state store under its key, moved on by the machine that runs use (model.advance). A back-off
is a timer: when the stream's time is past it, the retry is due and goes out, with the level and resolution to ask with. An
ended call is forgotten after a while, so state does not grow with all calls ever made.

Needs the RocksDB state store, which `configured` sets. Attempts of a call are taken in the order of their number within a
micro-batch; one that comes with a smaller number than was seen, or after the end, counts for nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from pagelake.operators import model

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE = "status string, level string, resolution string, tries int, pause double, wait double, attempt int"
EVENT = "call_id long, kind string, status string, level string, resolution string, tries int, pause double"
#: Seconds that an ended call is remembered for.
REMEMBERED = 3600.0


def configured(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    return spark


class Calls(StatefulProcessor):
    """kind is `state` after attempts came in, `due` when the pause before a retry is over."""

    def __init__(self, policy: model.Policy):
        self.policy = policy

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("call", STATE)

    def _now(self) -> tuple[model.State, int]:
        if not self.kept.exists():
            return model.opened(self.policy), 0
        *state, attempt = self.kept.get()
        return model.State(*state), attempt

    def _row(self, key, kind: str, s: model.State) -> Row:
        return Row(call_id=key[0], kind=kind, status=s.status, level=s.level, resolution=s.resolution, tries=s.tries, pause=s.pause)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        state, last = self._now()
        for r in sorted(rows, key=lambda r: r.attempt):
            if state.status != "open" or r.attempt <= last:
                continue
            state, last = model.advance(self.policy, state, r.outcome), r.attempt
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            after = state.wait if state.status == "open" else REMEMBERED
            if after:
                self.handle.registerTimer(int((r.ts.timestamp() + after) * 1000))
        self.kept.update((state.status, state.level, state.resolution, state.tries, state.pause, state.wait, last))
        yield self._row(key, "state", state)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        state, _ = self._now()
        if state.status == "open":
            yield self._row(key, "due", state)
        else:
            self.kept.clear()

    def close(self) -> None:
        pass


def call_states(attempts: DataFrame, policy: model.Policy, delay: str = "0 seconds") -> DataFrame:
    """attempts(call_id, attempt, outcome, ts), a stream, as events of EVENT; delay is how late an attempt may come."""
    rows = attempts.withWatermark("ts", delay)
    return rows.groupBy("call_id").transformWithState(Calls(policy), EVENT, "Update", "EventTime")
