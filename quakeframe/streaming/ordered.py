"""Event-count windows and next events of streams in event time: what comes late, but within the watermark, gets its right place.

ordered_windows holds events back until the watermark has passed them, so its rows are those of the batch query over the same
events whatever the order of arrival; they come as much later. It needs a state store that keeps several state variables:
spark.sql.streaming.stateStore.providerClass set to the RocksDB provider (STATE_STORE).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
OUTPUT = "region string, start_idx long, start_time timestamp, end_time timestamp, mean_mag double, max_mag double"


class OrderedWindows(StatefulProcessor):
    """State of a region: the events that the watermark hasn't passed (a list), the last size - 1 before it, how many there were, and the
    time of the timer, which is that of the earliest held event."""

    def __init__(self, size: int, stride: int):
        self.size, self.stride = size, stride

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "micros long, magnitude double, event_id long")
        self.past = handle.getValueState("past", "seen long, micros array<long>, magnitudes array<double>")
        self.timer = handle.getValueState("timer", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for batch in rows:
            new = list(zip(batch["micros"].astype(int).tolist(), batch["magnitude"].astype(float).tolist(), batch["event_id"].astype(int).tolist(), strict=True))
            if new:
                self.held.appendList(new)
                first = min(first if first is not None else new[0][0], min(new)[0])
        if first is not None:
            self._wake(first)
        yield pd.DataFrame()

    def _wake(self, micros: int) -> None:
        """Keep one timer, at the earliest held event."""
        at = -(-micros // 1000)
        if self.timer.exists():
            now = self.timer.get()[0]
            if now <= at:
                return
            self.handle.deleteTimer(now)
        self.handle.registerTimer(at)
        self.timer.update((at,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        self.timer.clear()
        events = sorted((tuple(e) for e in self.held.get()), key=lambda e: (e[0], e[2]))
        ready = [e for e in events if e[0] <= passed]
        left = events[len(ready) :]
        seen, micros, magnitudes = self.past.get() if self.past.exists() else (0, [], [])
        micros, magnitudes = list(micros), list(magnitudes)
        out = []
        for at, magnitude, _ in ready:
            micros.append(at)
            magnitudes.append(magnitude)
            seen += 1
            if len(micros) == self.size:
                if (seen - self.size) % self.stride == 0:
                    out.append((key[0], seen - self.size, micros[0], micros[-1], sum(magnitudes) / self.size, max(magnitudes)))
                micros.pop(0)
                magnitudes.pop(0)
        self.past.update((seen, micros, magnitudes))
        self.held.clear()
        if left:
            self.held.put(left)
            self._wake(left[0][0])
        made = pd.DataFrame(out, columns=["region", "start_idx", "start_time", "end_time", "mean_mag", "max_mag"])
        yield made.assign(**{c: pd.to_datetime(made[c], unit="us") for c in ("start_time", "end_time")})

    def close(self) -> None:
        pass


def ordered_windows(events: DataFrame, size: int = 64, stride: int = 8, late: str = "1 day") -> DataFrame:
    """A row for each window of size events of a region, begun every stride events in order of (time, event_id).

    events: region, time, magnitude, event_id. Events with a null region or time are in no window; those later than the watermark
    are dropped. Regions of fewer than twice size events, which have no window in the batch query, have theirs here.
    """
    at = F.col("time").cast("timestamp")
    known = events.where(F.col("region").isNotNull() & F.col("time").isNotNull()).select("region", at.alias("time"), F.unix_micros(at).alias("micros"), F.col("magnitude").cast("double").alias("magnitude"), F.col("event_id").cast("long").alias("event_id"))
    marked = known.withWatermark("time", late)
    return marked.groupBy("region").transformWithStateInPandas(OrderedWindows(size, stride), OUTPUT, "append", "eventTime")


def next_major(windows: DataFrame, majors: DataFrame, horizon_days: float = 30.0, late: str = "1 day") -> DataFrame:
    """region, start_idx, end_time, label and next_magnitude of each window (region, start_idx, end_time): whether a major event (region,
    time, magnitude) follows it within the horizon, and the first one's magnitude; of equally early ones the smallest.

    An outer join of both streams by region and interval, then the first event of each window, which comes once the watermark has
    passed the window's horizon. A window that is sent twice is one.
    """
    seconds = round(horizon_days * 86_400)
    w = windows.select(F.col("region").alias("__region"), "start_idx", F.col("end_time").cast("timestamp").alias("end_time")).withWatermark("end_time", late)
    m = majors.select("region", F.col("time").cast("timestamp").alias("time"), F.col("magnitude").cast("double").alias("magnitude")).withWatermark("time", late)
    within = F.expr(f"__region = region and time > end_time and time <= end_time + interval {seconds} seconds")
    joined = w.join(m, within, "left_outer").withColumn("first", F.when(F.col("time").isNotNull(), F.struct("time", "magnitude")))
    found = joined.groupBy("__region", "start_idx", "end_time").agg(F.min("first").alias("first"))
    return found.select(F.col("__region").alias("region"), "start_idx", "end_time", F.col("first").isNotNull().cast("int").alias("label"), F.col("first.magnitude").alias("next_magnitude"))
