"""Alerts that fire once their condition has held, and resolve, while the stream runs."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from curvewright.streaming.state import use_keyed_state

_MADE = "status string, from_ms long, ends_ms long, evaluations long"


class _Hold(StatefulProcessor):
    """The open stretch of one alert, moved on by event-time timers.

    Evaluations wait until the watermark has passed them, so those that come out
    of order are seen in order. A timer one step after the last firing one ends the
    stretch when nothing has come.
    """

    def __init__(self, names: Sequence[str], step_ms: int, hold_ms: int):
        self._make, self._step, self._hold = Row(*names), step_ms, hold_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._waiting = handle.getMapState("waiting", "at_ms long", "firing boolean")
        self._stretch = handle.getValueState("stretch", "from_ms long, last_ms long, n long, told boolean")

    def handleInputRows(self, key: tuple, rows: Iterable[Row], timerValues) -> Iterator[Row]:
        for row in rows:
            if row["firing"]:  # only firing evaluations make a stretch
                self._waiting.updateValue((row["_at_ms"],), (True,))
                self._handle.registerTimer(row["_at_ms"])
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        due = sorted(at[0] for at in self._waiting.keys() if at[0] <= now)
        state = tuple(self._stretch.get()) if self._stretch.exists() else None
        for at in due:
            self._waiting.removeKey((at,))
            if state is not None and at - state[1] > self._step:
                yield from self._resolved(key, state)
                state = None
            first, _, n, told = state or (at, at, 0, False)
            if not told and at - first >= self._hold:
                told = True
                yield self._make(*key, "firing", first, None, n + 1)
            state = (first, at, n + 1, told)
        if state is not None and now > state[1] + self._step:
            yield from self._resolved(key, state)
            state = None
        if state is None:
            self._stretch.clear()
        else:
            self._stretch.update(state)
            self._handle.registerTimer(state[1] + self._step + 1)

    def _resolved(self, key: tuple, state: tuple) -> Iterator[Row]:
        first, last, n, told = state
        if told:
            yield self._make(*key, "resolved", first, last, n)

    def close(self) -> None:
        pass


def held_stream(
    evaluations: DataFrame, keys: Sequence[str], step_seconds: int, hold_seconds: int, late_seconds: int = 0
) -> DataFrame:
    """Streaming form of :func:`curvewright.operators.alerts.held`.

    ``evaluations`` is a stream of keys, eval_time and firing. A row with status
    ``firing`` comes once the condition has held for ``hold_seconds``; one with
    status ``resolved`` and ``ends_at`` when a step has passed without another
    firing evaluation. Resolved rows are the stretches of the batch form. The
    watermark trails by ``late_seconds``; evaluations later than that are not
    seen. State per alert is one stretch and the evaluations the watermark has not
    passed.
    """
    use_keyed_state(evaluations.sparkSession)
    fields = [evaluations.schema[k] for k in keys]
    made = T.StructType([*fields, *T.StructType.fromDDL(_MADE).fields])
    rows = (
        evaluations.withWatermark("eval_time", f"{late_seconds} seconds")
        .select(*keys, "eval_time", "firing", F.unix_millis("eval_time").alias("_at_ms"))
        .groupBy(*keys)
        .transformWithState(_Hold(made.names, step_seconds * 1000, hold_seconds * 1000), made, "append", "eventTime")
    )
    return rows.select(
        *keys,
        "status",
        F.timestamp_millis("from_ms").alias("pending_from"),
        F.timestamp_millis(F.col("from_ms") + hold_seconds * 1000).alias("starts_at"),
        F.timestamp_millis("ends_ms").alias("ends_at"),
        "evaluations",
    )
