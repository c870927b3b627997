"""Dataset jobs and sinks on small records."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quakeframe.operators import dsp
from quakeframe.plans import jobs, reports
from quakeframe.sources import sinks


def records(n_stations=6, n=500):
    rng = np.random.default_rng(1)
    rows, classes = [], []
    for k in range(2 * n_stations):
        path = f"/d/{'event' if k % 2 else 'noise_event'}_{k}_raw.mseed"
        classes.append((path, "earthquake" if k % 2 else "noise"))
        for c in "ZNE":
            x = rng.normal(size=n)
            if k % 2:
                x[300:340] *= 8
            rows.append((path, f"N.S{k // 2}", c, 100.0, x.tolist()))
    return rows, classes


def test_detection_dataset(spark, tmp_path):
    rows, classes = records()
    traces = spark.createDataFrame(rows, "file_path string, station_key string, component string, sampling_rate double, samples array<double>")
    kinds = spark.createDataFrame(classes, "file_path string, class_name string")
    got = jobs.detection_dataset(traces, kinds, "dual_aux", seconds=1.0, n=8, cap=6).cache()
    assert got.count() > 0
    per = got.groupBy("station_key").agg(F.count_distinct("split").alias("s"), F.count(F.lit(1)).alias("n")).collect()
    assert all(r.s == 1 and r.n <= 6 for r in per)
    r = got.first()
    assert np.array(r.img).shape == (3, 8, 8) and np.array(r.seq).shape == (3, 100) and len(r.aux) == 2 and r.filename.endswith(f"_win{r.w_idx:03d}.parquet")
    sinks.write_manifest(got, f"{tmp_path}/m", "detection")
    sinks.write_arrays(got.select("split", "img"), f"{tmp_path}/a")
    assert spark.read.csv(f"{tmp_path}/m", header=True).count() == got.count() == spark.read.parquet(f"{tmp_path}/a").count()
    data = sinks.with_png(got.select("img")).first().png
    assert data[:8] == b"\x89PNG\r\n\x1a\n" and len(zlib.decompress(data[41 : 41 + int.from_bytes(data[33:37], "big")])) == 8 * 25


def test_event_dataset_and_onsets(spark):
    rows, classes = records(4)
    traces = spark.createDataFrame(rows, "file_path string, station_key string, component string, sampling_rate double, samples array<double>")
    windows = jobs.station_windows(traces, 5.0, 0.5, 100.0)
    events = spark.createDataFrame([(str(k), 4.0 + k, 38.0, 30.0 + k) for k in range(6)], "event_id string, magnitude double, lat double, lon double")
    stations = spark.createDataFrame([("N.S0", 38.0, 30.0), ("S1", 39.0, 31.0)], "key string, latitude double, longitude double")
    got = jobs.event_dataset(windows, events, stations).collect()
    assert {r.event_id for r in got} == {str(k) for k in range(6)} and {r.station_key for r in got if r.distance_km is not None} == {"N.S0", "N.S1"}
    labelled = windows.join(spark.createDataFrame(classes, "file_path string, class_name string"), "file_path")
    auc, best = jobs.evaluate_onsets(labelled, 5.0, 100.0)
    assert auc.first().auc == 1.0 and best.first().recall == 1.0


TRACES = "file_path string, station_key string, component string, sampling_rate double, samples array<double>"


def baselines_of(spark, stations):
    return spark.createDataFrame([(f"N.S{k}", 0.0, 0.0, 0.0, 1.0 + k, 1.0, 2.0) for k in stations], "station_key string, mu_z double, mu_n double, mu_e double, sigma_z double, sigma_n double, sigma_e double")


def test_every_kind_of_encoder(spark):
    rows, _ = records(2, 300)
    windows = jobs.station_windows(spark.createDataFrame(rows, TRACES), 1.0, 0.5, 100.0).join(baselines_of(spark, [0]), "station_key", "left").cache()
    shape = {"n_fft": 32}
    for kind in sorted(jobs.KINDS):
        r = jobs.encoder(kind, 8, shape)(windows).where("station_key = 'N.S0'").first().asDict()
        assert ("seq" in r) == ("dual" in kind) and len(r.get("aux") or []) == (6 if "v2" in kind else 2 if "aux" in kind else 0)
        if "spec" in kind:
            assert (r["freq"], r["frames"], len(r["img"])) == (17, 13, 3 * 17 * 13)
        else:
            assert np.array(r["img"]).shape == (3, 8, 8)
    assert jobs.encoder(lambda w: w.withColumn("mine", F.lit(1)))(windows).first().mine == 1
    with pytest.raises(ValueError):
        jobs.encoder("nothing")


def test_detection_dataset_mines_loud_negatives(spark):
    rows, classes = records(6, 900)
    traces = spark.createDataFrame(rows, TRACES)
    kinds = spark.createDataFrame(classes, "file_path string, class_name string")
    base = baselines_of(spark, range(6))
    plain = jobs.detection_dataset(traces, kinds, lambda w: w, seconds=1.0, cap=20, baselines=base).cache()
    count = lambda df: {(r.split, r.class_name): r["count"] for r in df.groupBy("split", "class_name").count().collect()}
    for matched in (None, "earthquake"):
        mined = jobs.detection_dataset(traces, kinds, lambda w: w, seconds=1.0, cap=20, baselines=base, mined="noise", matched=matched).cache()
        assert count(mined) == count(plain)  # as many as the quotas
        assert mined.select("file_path", "station_key", "w_idx").distinct().count() == mined.count()


def test_whitelist_is_the_band_of_all_stations(spark):
    rng = np.random.default_rng(2)
    rows = [(s, f"f{k % 7}", f"N.S{k % 5}", k, float(rng.normal())) for s in ("train", "val") for k in range(120)]
    scored = spark.createDataFrame(rows, "split string, file_path string, station_key string, w_idx int, score double")
    quotas = spark.createDataFrame([("train", 6), ("train", 4), ("val", None), ("test", 3)], "split string, quota int")
    got = {(r.file_path, r.station_key, r.w_idx) for r in jobs.negative_whitelist(scored, quotas).collect()}
    order = sorted((r for r in rows if r[0] == "train"), key=lambda r: (r[4], *r[1:4]))[90:119]
    want = {order[int(np.rint(i * 28 / 9))][1:4] for i in range(10)}
    assert got == want


def test_risk_dataset(spark):
    rng = np.random.default_rng(3)
    quakes, noise = [], []
    for k in range(10):
        for c in "ZNE":
            quakes.append((f"/d/event_{k}_raw.mseed", f"N.S{k % 4}", c, 100.0, (rng.normal(size=700) * (1 + k)).tolist()))
            noise.append((f"/n/noise_event_{k}_raw.mseed", f"N.S{k % 4}", c, 100.0, rng.normal(size=2000).tolist()))
    events = spark.createDataFrame([(str(k), 3.0 + 0.25 * k, 38.0, 30.0) for k in range(9)], "event_id string, magnitude double, lat double, lon double")
    stations = spark.createDataFrame([("N.S0", 38.0, 30.0)], "key string, latitude double, longitude double")
    got = jobs.risk_dataset(spark.createDataFrame(quakes, TRACES), spark.createDataFrame(noise, TRACES), events, stations, "angles_aux", baselines_of(spark, range(4)), ratio=1.0, n=8).cache()
    rows = got.select("split", "risk_class", "station_key", "event_id", "magnitude", "distance_km", "log_snr", "file_path").collect()
    assert {r.risk_class for r in rows} <= {"00_noise", "01_low_risk", "02_high_risk"} and "9" not in {r.event_id for r in rows}
    assert all((r.risk_class == "02_high_risk") == (r.magnitude is not None and r.magnitude >= 4.0) for r in rows)
    assert all(len({r.split for r in rows if r.station_key == s}) == 1 for s in {r.station_key for r in rows})
    assert all((r.distance_km is not None) == (r.station_key == "N.S0" and r.event_id is not None) for r in rows)
    sizes = {}
    for r in rows:
        sizes.setdefault(r.split, {}).setdefault(r.risk_class, []).append(r)
    for own in sizes.values():
        high = len(own.get("02_high_risk", []))
        biggest = 12  # windows of a noise file; the last file that is kept may overshoot
        assert not high or len(own.get("00_noise", [])) < high + biggest


def test_anchored_windows_and_raw_windows(spark):
    rng = np.random.default_rng(4)
    rows = []
    for k, size in enumerate((3000, 3000, 1300)):
        for c in "ZNE"[: 2 if k == 1 else 3]:
            x = rng.normal(size=size) * 0.1
            x[1250:1300] += 20 * np.sin(np.arange(50))
            rows.append((f"f{k}", f"N.S{k}", c, 100.0, x.tolist(), "2024-01-01 00:00:00"))
    traces = spark.createDataFrame(rows, TRACES + ", starttime string").withColumn("starttime", F.col("starttime").cast("timestamp_ntz"))
    got = jobs.anchored_windows(traces, [3.0, 20.0]).collect()
    assert {(r.file_path, r.target) for r in got} == {("f0", "window_post_3s_anchored"), ("f0", "window_post_20s_anchored"), ("f2", "window_post_3s_anchored")}
    for r in got:
        whole = next(x[4] for x in rows if x[0] == r.file_path and x[2] == r.component)
        at = min(int(r.arrival - 0.2 * len(r.samples)), len(whole) - len(r.samples))
        assert r.samples == whole[at : at + len(r.samples)] and 1245 <= r.arrival <= 1260
        assert r.starttime.minute * 60 + r.starttime.second + r.starttime.microsecond / 1e6 == pytest.approx(at / 100)
    seen = reports.picks(traces, jobs.picked(traces, ["file_path", "station_key"]), ["file_path", "station_key"]).first()
    assert (seen.seen, seen.too_few_traces, seen.picked, seen.no_pick) == (3, 1, 2, 0)
    manifest = spark.createDataFrame([("f0", "N.S0", 100.0, "f0_N.S0_win003.parquet"), ("f0", "N.S0", 100.0, "f0_N.S0_win040.parquet"), ("f9", "N.S0", 100.0, "x_win001.png"), ("f2", "N.S2", 100.0, "x_win017.png")], "file_path string, station_key string, fs double, filename string")
    raw = {r.filename: r for r in jobs.raw_windows(manifest, traces, 1.5, 0.5).collect()}
    assert set(raw) == {"f0_N.S0_win003.parquet", "x_win017.png"}
    z = next(x[4] for x in rows if x[0] == "f0" and x[2] == "Z")
    assert raw["f0_N.S0_win003.parquet"].z == z[225:375] and raw["x_win017.png"].z[25:] == [0.0] * 125


def test_ground_motion_dataset_and_reports(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(12):
        own = [rng.normal(size=200).tolist() for _ in range(9)]
        rows.append((f"/d/event_{k % 6}_raw.mseed", f"N.S{k // 6}", str(k % 6), *own, 0.0, 5.0, 60 + k if k != 3 else 2, k != 4, 0.01 if k != 5 else 0.2, 3.0 + k))
    names = [f"{a}_{c}" for a in ("raw", "vel", "acc") for c in "zne"]
    df = spark.createDataFrame(rows, "file_path string, station_key string, event_id string, " + ", ".join(f"{n} array<double>" for n in names) + ", n_masked_frac double, fs double, arrival int, response_ok boolean, sens_mismatch double, max_cft double")
    events = spark.createDataFrame([(str(k), 3.0 + k / 10, 38.0, 30.0 + k / 10) for k in range(6)], "event_id string, magnitude double, lat double, lon double")
    stations = spark.createDataFrame([(f"N.S{k}", 38.5, 30.0) for k in range(2)], "key string, latitude double, longitude double")
    got, dropped = jobs.ground_motion_dataset(df, events, stations)
    rows_of = got.collect()
    assert len(rows_of) == 10 and {r.reason for r in dropped.collect()} == {"no usable response", "no room for the input"}
    r = next(r for r in rows_of if r.file_path.endswith("_0_raw.mseed") and r.station_key == "N.S0")
    x = np.array(rows[0][6:9])[:, 57:72] * 100
    assert np.allclose(np.array(r.seq), x, rtol=1e-5) and r.log_peak_input_vel == pytest.approx(np.log10(np.sqrt((x**2).sum(axis=0)).max()))
    assert r.log_pgv_full == pytest.approx(np.log10(r.pgv_cms_full)) and r.distance_km > 0
    flags = reports.ground_motion_flags(got).first()
    assert (flags.n, flags.response_ok, flags.untrusted, flags.clean, flags.shared_events) == (10, 10, 1, 9, 0)
    assert sum(r.n for r in reports.split_sizes(got).collect()) == 10 and {r.target for r in reports.target_spread(got).collect()} == {"pgv_cms_fwd", "pga_gal_fwd", "pgv_cms_full", "pga_gal_full"}
    sinks.write_manifest(got, f"{tmp_path}/m", "ground_motion")
    assert spark.read.csv(f"{tmp_path}/m", header=True).where("peak_counts is not null").count() == 10


def test_reports_of_targets_and_images(spark):
    rows = [("A", k, 5.0, f"2024-01-{d:02d}") for k, d in enumerate((1, 3, 10, 11))] + [("B", 9, 5.0, "2024-01-02"), ("B", 10, 2.0, "2024-01-03")]
    events = spark.createDataFrame(rows, "region string, event_id long, magnitude double, t string").withColumn("time", F.col("t").cast("timestamp_ntz")).drop("t")
    got = {r.region: r for r in reports.target_counts(reports.major_events(events, 4.0), 6.0).collect()}
    assert (got["A"].n, got["A"].min_gap, got["A"].median_gap, got["A"].max_gap, got["A"].too_few, got["A"].beyond_horizon) == (4, 1, 2.0, 7, False, True)
    assert (got["B"].n, got["B"].median_gap, got["B"].too_few) == (1, None, True)
    files = [("x", "a", 10, 64, 64), ("x", "b", 10, 64, 64), ("x", "c", 10, 32, 32), ("x", "d", 0, None, None), ("x", "e", 5, None, None)]
    odd = {r.path: r.reason for r in reports.odd_images(spark.createDataFrame(files, "class_name string, path string, bytes long, width int, height int")).collect()}
    assert odd == {"c": "size", "d": "empty", "e": "unreadable"}


def test_cleaned_diffs(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=1000)
    mask = np.zeros(1000, bool)
    mask[210:260] = True
    rows = [("f", "Z", x.tolist(), mask.tolist(), "2024-01-01 00:00:00", "2024-01-01 06:00:00")]
    df = spark.createDataFrame(rows, "file_path string, component string, samples array<double>, gap_mask array<boolean>, s string, o string").select("file_path", "component", "samples", "gap_mask", F.col("s").cast("timestamp_ntz").alias("starttime"), F.col("o").cast("timestamp_ntz").alias("origin"))
    got = {r.w_idx: r for r in jobs.cleaned_diffs(df, 100.0, 1.0, ["file_path", "component"], n=8, origin="origin").collect()}
    assert set(got) == {1, 4, 5, 6, 7, 8, 9}  # the masked window breaks the chain
    whole = dsp.prepare(x[None], 100.0, 1.0, 45.0)[0]
    assert got[5].rms_diff == pytest.approx(np.sqrt(np.mean((whole[500:600] - whole[400:500]) ** 2)))
    assert got[5].hours_to_event == pytest.approx(6 - 5 / 3600) and got[5].image_diff > 0


def test_leave_one_out_wants_five_targets(spark):
    rows = [("A", k, 3.0 if k % 40 else 6.5, k) for k in range(400)]
    events = spark.createDataFrame(rows, "region string, event_id long, magnitude double, k long").withColumn("time", F.timestamp_seconds(F.col("k") * 86400).cast("timestamp_ntz")).drop("k").withColumns({"lat": F.lit(38.0), "lon": F.lit(30.0), "depth": F.lit(5.0)})
    many = events.where("magnitude > 6").select("region", "time")
    with pytest.raises(ValueError):
        jobs.tercile_dataset(events, many.limit(2), major=7.0, one_out=True)
    assert jobs.tercile_dataset(events, many, major=7.0, one_out=True).select("split").distinct().collect()[0].split == "all"


def test_only_windows_of_the_quota_are_cleaned(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(f"/d/{k}.mseed", f"N.S{k % 3}", c, 100.0, rng.normal(size=3000).tolist()) for k in range(9) for c in "ZNE"]
    traces = spark.createDataFrame(rows, TRACES)
    classes = spark.createDataFrame([(f"/d/{k}.mseed", "quake" if k % 2 else "noise") for k in range(9)], "file_path string, class_name string")
    cleaned, clean = [], dsp.clean

    def counted(df, fs, low, high, column):
        if column == "z":
            cleaned.append(df.count())
        return clean(df, fs, low, high, column)

    monkeypatch.setattr(jobs.dsp, "clean", counted)
    n = jobs.detection_dataset(traces, classes, cap=40, seconds=2.0, n=8).count()
    assert n == sum(cleaned) and 0 < n <= 120  # of 9 x 29 windows
    cleaned.clear()
    base = baselines_of(spark, range(3))
    mined = jobs.detection_dataset(traces, classes, cap=40, seconds=2.0, n=8, baselines=base, mined="noise", matched="quake").count()
    assert mined <= n and len(cleaned) == 2 and cleaned[1] == 0  # each window of the two classes once


def test_ground_motion_of_raw_counts(spark):
    rng = np.random.default_rng(9)
    rows = []
    for k in range(4):
        for c in "ZNE":
            x = rng.normal(size=6000) * 50
            x[2000:2300] += 4e4 * np.sin(np.arange(300) * 0.4) * np.exp(-np.arange(300) / 90)
            rows.append((f"/d/event_{k}_raw.mseed", "N.A" if k < 3 else "N.B", "N", "A" if k < 3 else "B", f"HH{c}", c, "2024-01-05 00:00:00" if k else "2020-01-05 00:00:00", 100.0, x.tolist(), [j < 60 for j in range(6000)]))
    traces = spark.createDataFrame(rows, "file_path string, station_key string, network string, station string, channel string, component string, starttime string, sampling_rate double, samples array<double>, gap_mask array<boolean>").withColumn("starttime", F.col("starttime").cast("timestamp_ntz"))
    table = [("N", "A", f"HH{c}", "2024-01-01 00:00:00", None, "M/S", 6e8, [1500.0, 4e5], [(-4.44, 4.44), (-4.44, -4.44)], [(0.0, 0.0), (0.0, 0.0)], 1.0, None) for c in "ZNE"]
    responses = spark.createDataFrame(table, "network string, station string, channel string, epoch_start string, epoch_end string, input_unit string, sensitivity double, stage_gains array<double>, poles array<struct<re:double,im:double>>, zeros array<struct<re:double,im:double>>, a0 double, norm_hz double")
    responses = responses.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("epoch_start", "epoch_end")})
    records = jobs.ground_motion_records(traces, responses).cache()
    got = {r.file_path: r for r in records.collect()}
    assert {k: r.response_ok for k, r in got.items()} == {f"/d/event_{k}_raw.mseed": k in (1, 2) for k in range(4)}
    r = got["/d/event_1_raw.mseed"]
    assert 1990 <= r.arrival <= 2020 and r.n_masked_frac == pytest.approx(0.01) and r.event_id == "1" and len(r.raw_z) == len(r.vel_e) == 6000 and r.sens_mismatch == pytest.approx(0)
    events = spark.createDataFrame([(str(k), 4.0, 38.0, 30.0) for k in range(4)], "event_id string, magnitude double, lat double, lon double")
    data, dropped = jobs.ground_motion_dataset(records, events, spark.createDataFrame([("N.A", 38.5, 30.0)], "key string, latitude double, longitude double"))
    assert {d.reason for d in dropped.collect()} == {"no usable response"} and dropped.count() == 2
    one = data.where("event_id = '1'").first()
    speed = np.sqrt(sum(np.array(r[f"vel_{c}"]) ** 2 for c in "zne"))
    assert one.pgv_cms_full == pytest.approx(100 * speed.max()) and 0.001 < one.pgv_cms_full < 0.1 and one.peak_in_input
