"""Operators against brute force, and queries against DuckDB at the smallest scale."""

import io
import math
import random
import struct
from datetime import datetime, timedelta

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from quakeframe.functions import columns as C
from quakeframe.operators import decluster, dsp, evaluate, mining, sequence, signal, split
from quakeframe.sources import catalog, miniseed
from quakeframe.streaming import windows as live

SF = "/root/testdata/sf0.001"
BASE = {n: q for r in entry.REGISTRIES for n, (q, _) in r.QUERIES.items()}
SQL = {n: s for r in entry.REGISTRIES for n, (_, s) in r.QUERIES.items() if s}


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return f"{float(v):.6g}"
    return str(v)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for t in ("events", "lineitem", "orders", "supplier", "embeddings", "part", "customer", "nation", "region"):
        db.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = db.sql(SQL[name])
    names = sorted(want.columns)
    at = [want.columns.index(n) for n in names]
    expected = sorted(tuple(plain(r[k]) for k in at) for r in want.fetchall())
    got = BASE[name](spark, SF)
    assert sorted(got.columns) == names
    assert sorted(tuple(plain(r[n]) for n in names) for r in got.collect()) == expected


def quakes(seed, n):
    rng = random.Random(seed)
    t0 = datetime(2024, 1, 1)
    rows = []
    for k in range(n):
        rows.append((rng.choice("ab"), t0 + timedelta(minutes=rng.randint(0, 60_000)), round(rng.choice([3.0, 3.5, 4.0, 5.0, 6.5]) + rng.random(), 1), k, 38 + rng.random(), 30 + rng.random()))
    return rows


CATALOG = "region string, time timestamp_ntz, magnitude double, event_id long, lat double, lon double"


def test_decluster_equals_greedy(spark):
    rows = quakes(1, 300) + [("a", datetime(2024, 1, 5), 7.0, 900, None, 30.0)]
    expected = {}
    for region in "ab":
        own = sorted((r for r in rows if r[0] == region), key=lambda r: (-r[2], r[1], r[3]))
        main = {r[3]: True for r in own}
        for i, r in enumerate(own):
            if not main[r[3]] or r[4] is None:
                continue
            km = 10 ** (0.1238 * r[2] + 0.983)
            days = 10 ** (0.032 * r[2] + 2.7389) if r[2] >= 6.5 else 10 ** (0.5409 * r[2] - 0.547)
            for s in own[i + 1 :]:
                if s[4] is None:
                    continue
                h = math.sin(math.radians(s[4] - r[4]) / 2) ** 2 + math.cos(math.radians(r[4])) * math.cos(math.radians(s[4])) * math.sin(math.radians(s[5] - r[5]) / 2) ** 2
                if abs((s[1] - r[1]).total_seconds()) / 86400 <= days and 2 * 6371 * math.asin(math.sqrt(h)) <= km:
                    main[s[3]] = False
        expected |= main
    got = {r.event_id: r.is_main for r in decluster.decluster(spark.createDataFrame(rows, CATALOG)).collect()}
    assert got == expected and 0 < sum(got.values()) < len(got)


def test_asof_is_strict_on_both_sides(spark):
    t = datetime(2024, 1, 1)
    left = spark.createDataFrame([("a", t + timedelta(days=d)) for d in range(6)] + [("b", t)], "region string, at timestamp_ntz")
    right = spark.createDataFrame([("a", t + timedelta(days=2)), ("a", t + timedelta(days=4)), ("a", t + timedelta(days=4, hours=1))], "region string, time timestamp_ntz")
    fwd = {(r.region, r.at): r.x.time if r.x else None for r in sequence.asof(left, right, "region", "at", "time", "x", True).collect()}
    back = {(r.region, r.at): r.x.time if r.x else None for r in sequence.asof(left, right, "region", "at", "time", "x", False).collect()}
    assert fwd["a", t + timedelta(days=2)] == t + timedelta(days=4) and fwd["a", t + timedelta(days=4)] == t + timedelta(days=4, hours=1)
    assert fwd["a", t + timedelta(days=5)] is None and fwd["b", t] is None
    assert back["a", t + timedelta(days=2)] is None and back["a", t + timedelta(days=4)] == t + timedelta(days=2) and back["a", t + timedelta(days=5)] == t + timedelta(days=4, hours=1)


def test_windows_guard_and_order(spark):
    few = spark.createDataFrame([r[:4] for r in quakes(2, 100)], "region string, time timestamp_ntz, magnitude double, event_id long")
    assert sequence.event_windows(few, 64, 8).count() == 0
    got = sequence.event_windows(few, 16, 4)
    n = {r.region: r["count"] for r in few.groupBy("region").count().collect()}
    assert got.count() == sum((k - 16) // 4 + 1 for k in n.values() if k >= 32)


def test_header_aliases():
    assert catalog.header([" Tarih ", "Saat", "Enlem"], "time") == " Tarih " and catalog.header(["x"], "lat") is None


def test_boundary_names():
    assert [C.boundary_name(d) for d in (12.4, 364.9, 730.5, 900)] == ["12d", "365d", "2y", "2.5y"]


def test_split_fold_follows_deficits(spark):
    keys = spark.createDataFrame([(k, w) for k, w in enumerate([5, 1, 9, 30, 2, 2, 8, 40, 3])], "k long, w long")
    got = {r.k: r.split for r in split.deficit_splits(keys, "k", "w").collect()}
    order = [r.k for r in keys.orderBy(split.hashed_order("k"), "k").collect()]
    weight = {r.k: r.w for r in keys.collect()}
    total, held = sum(weight.values()), {"train": 0.0, "val": 0.0, "test": 0.0}
    for k in order:
        best = max(held, key=lambda s: (total * {"train": 0.70, "val": 0.15, "test": 0.15}[s] - held[s]) / max(total * {"train": 0.70, "val": 0.15, "test": 0.15}[s], 1))
        assert got[k] == best
        held[best] += weight[k]


def test_matched_pick_follows_target(spark):
    rng = np.random.default_rng(3)
    pool = spark.createDataFrame([(k, float(v)) for k, v in enumerate(rng.random(4000))], "k long, s double")
    target = spark.createDataFrame([(k, float(v)) for k, v in enumerate(0.5 + 0.2 * rng.random(500))], "k long, s double")
    got = [r.s for r in mining.matched_pick(pool, target, "s", ["k"], 200, 10).collect()]
    assert len(got) == 200 and all(0.49 <= s <= 0.71 for s in got)


def test_roc_single_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.7)], "label int, score double")
    assert evaluate.roc_auc(df).first().auc is None


def test_angles_do_not_change_with_scale(spark):
    x = [random.Random(4).uniform(-1, 1) for _ in range(60)]
    df = spark.createDataFrame([(1, x), (2, [3.7 * v for v in x])], "k long, samples array<double>")
    a, b = (r.b for r in df.select("k", signal.relative_angles(F.col("samples"), 16).alias("b")).orderBy("k").collect())
    assert np.allclose(a, b, atol=1e-9) and len(a) == 16


def test_filter_passes_band_without_phase(spark):
    t = np.arange(1200) / 100
    rows = [(1, np.sin(2 * np.pi * 10 * t).tolist()), (2, np.sin(2 * np.pi * 0.05 * t).tolist()), (3, [1.0]), (4, None), (5, [])]
    got = {r.k: r.samples for r in dsp.clean(spark.createDataFrame(rows, "k long, samples array<double>"), 100.0, 1.0, 45.0).collect()}
    middle = slice(400, 800)
    assert np.allclose(np.array(got[1])[middle], np.sin(2 * np.pi * 10 * t)[middle], atol=0.02)
    assert np.abs(np.array(got[2])[middle]).max() < 0.05 and got[4] is None and got[5] is None
    b, a = dsp.butterworth(4, 1.0, 45.0, 100.0)
    assert len(a) == len(b) == 9 and np.all(np.abs(np.roots(a)) < 1)


def test_spectrogram_of_a_tone(spark):
    x = np.sin(2 * np.pi * 25 * np.arange(512) / 100)
    r = dsp.spectrograms(spark.createDataFrame([(1, x.tolist())], "k long, samples array<double>"), 64).first()
    db = np.array(r.db).reshape(r.freq, r.frames)
    assert (r.freq, r.frames) == (33, 33) == signal.stft_shape(100.0, 5.12, 64) and (db[:, 5:-5].argmax(axis=0) == 16).all() and db.max() - db.min() <= 80.001


def record(values, start, encoding, channel=b"HHZ"):
    head = b"000001D " + b"STA  " + b"  " + channel + b"NN" + struct.pack(">HHBBBBH", start.year, start.timetuple().tm_yday, start.hour, start.minute, start.second, 0, start.microsecond // 100)
    head += struct.pack(">HhhBBBBiHH", len(values), 100, 1, 0, 0, 0, 1, 0, 64, 48) + struct.pack(">HHBBBB", 1000, 0, encoding, 1, 9, 0)
    if encoding == 3:
        body = struct.pack(f">{len(values)}i", *values)
    else:  # Steim-1 with 8-bit differences
        gaps = [0, *np.diff(values).tolist()]
        gaps += [0] * (-len(gaps) % 4)
        words = [int.from_bytes(bytes(g & 255 for g in gaps[k : k + 4]), "big") for k in range(0, len(gaps), 4)]
        frames, at = [], 0
        while at < len(words) or not frames:
            room = 13 if not frames else 15
            part, at = words[at : at + room], at + room
            lead = [values[0] & 0xFFFFFFFF, values[-1] & 0xFFFFFFFF] if not frames else []
            codes = sum(1 << (30 - 2 * (k + 1 + len(lead))) for k in range(len(part)))
            frames.append([codes, *lead, *part] + [0] * (15 - len(lead) - len(part)))
        body = b"".join(struct.pack(">16I", *f) for f in frames)
    return (head + b"\0" * (64 - len(head)) + body).ljust(512, b"\0")


def test_miniseed_reads_and_merges(spark, tmp_path):
    t = datetime(2024, 2, 1, 3, 4, 5)
    a, b = [1, 5, 2, -7, 20, 33, 12], [4, 4, 5]
    (tmp_path / "x.mseed").write_bytes(record(a, t, 10) + record(b, t + timedelta(seconds=0.1), 3))
    rows = miniseed.read(spark, str(tmp_path)).orderBy("starttime").collect()
    assert [r.samples for r in rows] == [[float(v) for v in a], [float(v) for v in b]] and rows[0].station == "STA" and rows[0].sampling_rate == 100.0
    assert all(r.samples is None and r.npts for r in miniseed.read(spark, str(tmp_path), headers_only=True).collect())
    one = miniseed.traces(miniseed.read(spark, str(tmp_path))).first()
    assert one.npts == 13 and one.gap_mask == [False] * 7 + [True] * 3 + [False] * 3 and one.samples[7] == pytest.approx(12 + (4 - 12) / 4)
    spark.dataSource.register(miniseed.MiniSeedSource)
    assert spark.read.format("miniseed").load(str(tmp_path)).count() == 2
    heads = spark.read.format("miniseed").option("headers_only", "true").load(str(tmp_path)).orderBy("starttime").collect()
    assert [(r.npts, r.samples) for r in heads] == [(7, None), (3, None)]

    class Counted(io.BytesIO):
        taken = 0

        def read(self, size=-1):
            got = super().read(size)
            self.taken += len(got)
            return got

    held = Counted((tmp_path / "x.mseed").read_bytes())
    assert len(list(miniseed.records(held, headers_only=True))) == 2 and held.taken <= 2 * 64


def test_live_windows(spark, tmp_path):
    t = datetime(2024, 1, 1)
    rows = [("a", t + timedelta(minutes=k), float(k)) for k in range(20)]
    spark.createDataFrame(rows, "region string, time timestamp, magnitude double").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("region string, time timestamp, magnitude double").parquet(f"{tmp_path}/in")
    q = live.live_windows(stream, 8, 4).writeStream.format("memory").queryName("live_windows").outputMode("append").option("checkpointLocation", f"{tmp_path}/c").start()
    q.processAllAvailable()
    q.stop()
    got = spark.table("live_windows").orderBy("start_idx").collect()
    assert [(r.start_idx, r.max_mag, r.mean_mag) for r in got] == [(k, k + 7.0, k + 3.5) for k in (0, 4, 8, 12)]


def test_live_labels(spark, tmp_path):
    """Windows are labelled once the watermark has passed the first major event after them, or their horizon."""
    t = datetime(2024, 1, 1)
    at = lambda d: t + timedelta(days=d)
    spark.createDataFrame([("a", k, at(d)) for k, d in enumerate((1, 2, 10, 50))] + [("b", 0, at(3))], "region string, start_idx long, end_time timestamp").coalesce(1).write.parquet(f"{tmp_path}/w")
    majors = [("a", at(2), 5.0), ("a", at(4), 6.0), ("a", at(3), 5.5), ("a", at(25), 7.0), ("a", at(80), 5.0), ("b", at(80), 5.0)]
    spark.createDataFrame(majors, "region string, time timestamp, magnitude double").coalesce(1).write.parquet(f"{tmp_path}/m")
    windows = spark.readStream.schema("region string, start_idx long, end_time timestamp").parquet(f"{tmp_path}/w")
    events = spark.readStream.schema("region string, time timestamp, magnitude double").parquet(f"{tmp_path}/m")
    q = live.live_labels(windows, events, 10).writeStream.format("memory").queryName("live_labels").outputMode("append").option("checkpointLocation", f"{tmp_path}/c").start()
    q.processAllAvailable()
    q.stop()
    got = {(r.region, r.start_idx): (r.label, r.next_magnitude) for r in spark.table("live_labels").collect()}
    assert got == {("a", 0): (1, 5.0), ("a", 1): (1, 5.5), ("a", 2): (0, None), ("a", 3): (0, None), ("b", 0): (0, None)}


def test_scratch_tables_go_with_their_block(spark, tmp_path):
    import uuid
    from pathlib import Path

    from quakeframe.session import materialize, scratch, shared_dir

    tag = f"scratch-{uuid.uuid4().hex}"  # the folder may outlive this run
    here = lambda: set(Path(shared_dir(spark).removeprefix("file:")).glob(f"{tag}-*"))
    with scratch(spark):
        outer = materialize(spark.range(5), f"{tag}-a")
        with pytest.raises(RuntimeError), scratch(spark):
            materialize(spark.range(3), f"{tag}-b")
            raise RuntimeError
        assert len(here()) == 1 and outer.count() == 5
        outer.write.parquet(f"{tmp_path}/kept")
    assert not here() and spark.read.parquet(f"{tmp_path}/kept").count() == 5
    with scratch(spark):
        materialize(spark.range(1), f"{tag}-c")
        assert len(here()) == 1
    assert not here()


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "region" and set(entry.oracle_sql()) <= set(entry.queries())
