"""Event-count windows and horizon labels over streams of catalog events."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUTPUT = "region string, start_idx long, start_time timestamp, end_time timestamp, mean_mag double, max_mag double"
STATE = "seen long, times array<double>, magnitudes array<double>"


def live_windows(events: DataFrame, size: int = 64, stride: int = 8, late: str = "1 day") -> DataFrame:
    """A row each time a region's window of size events is full, every stride events; events come in order of time.

    The state of a region is its last size - 1 events. Events later than the
    watermark are dropped.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen, times, magnitudes = (state.get if state.exists else (0, [], []))
        times, magnitudes = list(times), list(magnitudes)
        new = pd.concat(list(batches)).sort_values("time")
        out = []
        for t, m in zip(new["time"].astype("int64") / 1e9 if new["time"].dtype == "datetime64[ns]" else new["time"].map(lambda x: x.timestamp()), new["magnitude"], strict=True):
            times.append(t)
            magnitudes.append(m)
            seen += 1
            if len(times) > size:
                times.pop(0)
                magnitudes.pop(0)
            if len(times) == size and (seen - size) % stride == 0:
                out.append((key[0], seen - size, pd.Timestamp(times[0], unit="s"), pd.Timestamp(times[-1], unit="s"), sum(magnitudes) / size, max(magnitudes)))
        state.update((seen, times, magnitudes))
        if out:
            yield pd.DataFrame(out, columns=["region", "start_idx", "start_time", "end_time", "mean_mag", "max_mag"])

    marked = events.withColumn("time", F.col("time").cast("timestamp")).withWatermark("time", late)
    return marked.select("region", "time", "magnitude").groupBy("region").applyInPandasWithState(step, OUTPUT, STATE, "append", GroupStateTimeout.NoTimeout)


LABELS = "region string, start_idx long, end_time timestamp, label int, next_magnitude double"
PENDING = "starts array<long>, ends array<double>, times array<double>, magnitudes array<double>"


def live_labels(windows: DataFrame, majors: DataFrame, horizon_days: float = 30.0, late: str = "1 day") -> DataFrame:
    """A row for each window (region, start_idx, end_time) once its label is certain: 1 with the magnitude of the first major event
    strictly after it, if that is within the horizon, else 0.

    A label is certain when the watermark has passed that event or the horizon. The state of a region is its open windows and
    the major events since the first of them; events and windows later than the watermark are dropped.
    """
    horizon = horizon_days * 86_400.0

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        starts, ends, times, magnitudes = (list(x) for x in state.get) if state.exists else ([], [], [], [])
        for batch in batches:
            for start, at, magnitude in zip(batch["start_idx"], batch["seconds"], batch["magnitude"], strict=True):
                if pd.isna(start):
                    times.append(float(at))
                    magnitudes.append(float(magnitude))
                else:
                    starts.append(int(start))
                    ends.append(float(at))
        passed = state.getCurrentWatermarkMs() / 1000
        out, left, waits = [], [], []
        for start, end in zip(starts, ends, strict=True):
            after = min(((t, m) for t, m in zip(times, magnitudes, strict=True) if t > end), default=None)
            certain = min(after[0], end + horizon) if after else end + horizon
            if passed <= certain:
                left.append((start, end))
                waits.append(certain)
            else:
                hit = after is not None and after[0] <= end + horizon
                out.append((key[0], start, pd.Timestamp(end, unit="s"), int(hit), after[1] if hit else None))
        first = min((e for _, e in left), default=passed)
        kept = [(t, m) for t, m in zip(times, magnitudes, strict=True) if t > min(first, passed)]
        state.update(([s for s, _ in left], [e for _, e in left], [t for t, _ in kept], [m for _, m in kept]))
        if waits:
            state.setTimeoutTimestamp(int(max(min(waits), passed) * 1000) + 1)
        if out:
            yield pd.DataFrame(out, columns=["region", "start_idx", "end_time", "label", "next_magnitude"]).astype({"next_magnitude": "float64"})

    at = lambda c: F.col(c).cast("timestamp").alias("at")
    both = windows.select("region", "start_idx", at("end_time"), F.lit(None).cast("double").alias("magnitude")).unionByName(majors.select("region", F.lit(None).cast("long").alias("start_idx"), at("time"), "magnitude"))
    marked = both.withWatermark("at", late).withColumn("seconds", F.unix_micros("at") / 1e6)
    return marked.groupBy("region").applyInPandasWithState(step, LABELS, PENDING, "append", GroupStateTimeout.EventTimeTimeout)
