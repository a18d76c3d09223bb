"""Alerts on breaches that last, as a stream: closed windows into keyed state with event-time timers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


class BreachRun(StatefulProcessor):
    """The run of breaching windows of a series: its last window and its length.

    A window that breaches right after the last one makes the run longer, any other one starts it anew, and one
    within bounds ends it. A window that never comes ends it too: a timer at the end of the
    window after the last one clears the run, so a silent series holds no state.
    """

    def __init__(self, value: str, threshold: float, seconds: int, duration: int) -> None:
        self.value, self.threshold, self.seconds = value, threshold, seconds
        self.needed = max(1, -(-duration // seconds))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", "last bigint, length int")

    def _timer(self, last: int) -> int:
        return (last + 2 * self.seconds) * 1000

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # one row a window that has closed since the last batch
        closed = pd.concat(list(rows), ignore_index=True)
        at = closed["window_start"].to_numpy("datetime64[s]").astype(np.int64)
        over = closed[self.value].to_numpy(float, na_value=np.nan) > self.threshold
        last, length = self.run.get() if self.run.exists() else (None, 0)
        before = last
        alerts = []
        for i in np.argsort(at, kind="stable"):
            if not over[i]:
                last, length = None, 0
                continue
            length = length + 1 if last is not None and at[i] == last + self.seconds else 1
            last = int(at[i])
            if length >= self.needed:
                alerts.append(i)
        if before is not None and before != last:
            self.handle.deleteTimer(self._timer(before))
        if last is None:
            self.run.clear()
        else:
            self.run.update((last, min(length, self.needed)))
            if before != last:
                self.handle.registerTimer(self._timer(last))
        yield closed.iloc[alerts].assign(breaching_windows=self.needed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.run.exists() and self._timer(self.run.get()[0]) <= expiredTimerInfo.getExpiryTimeInMs():
            self.run.clear()
        return iter([])

    def close(self) -> None:
        pass


def sustained_alert_stream(windows: DataFrame, series: Sequence[str], value: str, threshold: float, seconds: int, duration: int) -> DataFrame:
    """``windows.sustained_alerts`` for a stream of windows under a watermark, told as the windows close.

    Rows later than the watermark are in no window, as in any windowed stream. Needs the RocksDB state
    store (``jobs.with_state_store``).
    """
    schema = T.StructType([*windows.schema.fields, T.StructField("breaching_windows", T.LongType())])
    told = BreachRun(value, threshold, seconds, duration)
    out = windows.groupBy(*series).transformWithStateInPandas(told, schema, "Append", "EventTime")
    return out.select(*windows.columns, F.col("breaching_windows"))
