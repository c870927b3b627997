"""Streams in event time against the batch operators over the same events."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quakeframe.operators import sequence
from quakeframe.streaming import ordered

T0 = datetime(2024, 1, 1)
EVENTS = "region string, time timestamp, magnitude double, event_id long"


@pytest.fixture
def rocks(spark):
    key, value = ordered.STATE_STORE
    old = spark.conf.get(key)
    spark.conf.set(key, value)
    yield spark
    spark.conf.set(key, old)


def replayed(spark, path, batches, schema):
    """A stream whose micro-batches are the given ones."""
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{path}/{k:03d}")
    paths = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", "false").option("recursiveFileLookup", "true")
    return paths.parquet(path)


def drained(df, name, path):
    q = df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", path).start()
    q.processAllAvailable()
    q.stop()
    return df.sparkSession.table(name).collect()


def test_shuffled_arrival_gives_the_batch_rows(rocks, tmp_path):
    rng = random.Random(1)
    events = []
    for region, n in (("a", 90), ("b", 40)):
        for k in range(n):
            events.append((region, T0 + timedelta(minutes=10 * (k // 2 * 2), seconds=rng.choice([0, 0, 7])), rng.random() * 5, len(events)))
    arriving = sorted(events, key=lambda e: e[1] + timedelta(minutes=rng.randrange(100)))  # up to 100 minutes late
    late = ("a", T0 - timedelta(days=3), 9.0, 999)
    batches = [arriving[k : k + 25] for k in range(0, len(arriving), 25)] + [[("z", T0 + timedelta(days=9), 1.0, 1000)], [late, ("z", T0 + timedelta(days=9), 1.0, 1001)], [(None, T0 + timedelta(days=9), 1.0, 1002)]]
    stream = replayed(rocks, f"{tmp_path}/in", batches, EVENTS)
    got = drained(ordered.ordered_windows(stream, 8, 3, "2 hours"), "ordered_windows", f"{tmp_path}/c")
    batch = sequence.event_windows(rocks.createDataFrame(events, EVENTS).withColumn("time", F.col("time").cast("timestamp_ntz")), 8, 3)
    want = sorted((r.region, r.start_idx, r.start_time, r.end_time, round(r.mean_mag, 9), round(r.max_mag, 9)) for r in batch.collect())
    assert sorted((r.region, r.start_idx, r.start_time, r.end_time, round(r.mean_mag, 9), round(r.max_mag, 9)) for r in got) == want


def test_next_major_by_interval_join(rocks, tmp_path):
    rng = random.Random(2)
    windows = [("a" if k % 3 else "b", k, T0 + timedelta(hours=7 * k)) for k in range(40)]
    majors = [(rng.choice("ab"), T0 + timedelta(hours=rng.randrange(330)), float(k % 5 + 4)) for k in range(12)] + [("a", windows[4][2], 8.0)]
    flush = T0 + timedelta(days=99)
    w = replayed(rocks, f"{tmp_path}/w", [windows[k : k + 10][::-1] for k in range(0, 40, 10)] + [[("z", 0, flush)]] * 3, "region string, start_idx long, end_time timestamp")
    m = replayed(rocks, f"{tmp_path}/m", [majors[k : k + 4] for k in range(0, 13, 4)] + [[("z", flush, 1.0)]] * 3, "region string, time timestamp, magnitude double")
    got = drained(ordered.next_major(w, m, 1.5, "16 days"), "next_major", f"{tmp_path}/c")
    want = {}
    for region, k, end in windows:
        later = sorted((t, x) for r, t, x in majors if r == region and end < t <= end + timedelta(days=1.5))
        want[region, k] = (1, later[0][1]) if later else (0, None)
    assert {(r.region, r.start_idx): (r.label, r.next_magnitude) for r in got if r.region != "z"} == want
    assert {v[0] for v in want.values()} == {0, 1} and len(got) == len(set((r.region, r.start_idx) for r in got))
