"""Long traces in blocks against the whole-trace kernels; response removal against NumPy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quakeframe.operators import dsp, groundmotion, long, signal


def traces_of(spark, rows):
    return spark.createDataFrame([(k, [None if v is None else float(v) for v in x]) for k, x in rows], "trace string, samples array<double>")


def whole_of(blocks):
    out = {}
    for r in sorted(blocks.collect(), key=lambda r: (str(r.trace), r.block)):
        assert r.at == len(out.setdefault(r.trace, []))
        out[r.trace].extend(r.samples)
    return out


@pytest.mark.parametrize("size", [128, 1000, 5000])
def test_clean_equals_the_whole_trace(spark, size):
    rng = np.random.default_rng(1)
    rows = [("a", rng.normal(size=4321).cumsum() + 0.01 * np.arange(4321)), ("b", rng.normal(size=300)), ("c", rng.normal(size=size)), ("d", [1.0]), ("e", rng.normal(size=20)), ("empty", [])]
    blocks = long.cut(traces_of(spark, rows), ["trace"], size)
    assert blocks.agg(F.max(F.size("samples"))).first()[0] <= size
    got = whole_of(long.clean(blocks, ["trace"], 100.0, 2.0, 20.0))
    assert set(got) == {"a", "b", "c", "d", "e"}
    for k, x in rows[:5]:
        want = dsp.prepare(np.array(x, float)[None], 100.0, 2.0, 20.0)[0]
        assert np.allclose(got[k], want, atol=1e-9 * max(1, np.abs(x).max()))
    unfiltered = whole_of(long.clean(blocks, ["trace"], 1.0, 2.0, 20.0))  # no band is left
    assert np.allclose(unfiltered["b"], dsp.prepare(np.array(rows[1][1])[None], 1.0, 2.0, 20.0)[0], atol=1e-9)


def test_a_null_sample_makes_its_trace_nan(spark):
    rows = [("a", [1.0] * 200 + [None] + [2.0] * 400), ("b", np.arange(600.0))]
    got = whole_of(long.clean(long.cut(traces_of(spark, rows), ["trace"], 128), ["trace"], 100.0, 2.0, 20.0))
    assert np.isnan(got["a"]).all() and not np.isnan(got["b"]).any()


def test_ten_million_samples(spark):
    """No row is longer than a block, and the result is the whole-trace kernel's."""
    n, size = 10_000_000, 1 << 16
    blocks = spark.range(0, -(-n // size), numPartitions=8).select(F.lit("x").alias("trace"), F.col("id").alias("block"), (F.col("id") * size).alias("at"), F.lit(n).cast("long").alias("n"), F.transform(F.sequence(F.col("id") * size, F.least((F.col("id") + 1) * size, F.lit(n)) - 1), lambda i: F.sin(i * 0.05) + (F.xxhash64(i) % 1000) / 1000.0).alias("samples"))
    got = long.clean(blocks, ["trace"], 100.0)
    assert got.count() == -(-n // size)
    sums = got.select(F.sum(long._sum(F.col("samples"))), F.sum(long._sum(F.transform("samples", lambda v: v * v))), F.max(F.size("samples"))).first()
    x = np.concatenate([np.array(r.samples) for r in blocks.orderBy("block").toLocalIterator()])
    want = dsp.prepare(x[None], 100.0, 1.0, 45.0)[0]
    assert sums[2] <= size and sums[0] == pytest.approx(want.sum(), abs=1e-5) and sums[1] == pytest.approx((want**2).sum(), rel=1e-9)
    some = got.where("block in (0, 77, 152)").collect()
    assert all(np.allclose(r.samples, want[r.at : r.at + len(r.samples)], atol=1e-9) for r in some)


def test_detrend_onset_and_windows_equal_the_whole_trace(spark):
    rng = np.random.default_rng(2)
    rows = []
    for k, n in enumerate((128, 700, 1500, 40)):
        x = rng.normal(size=n) + 0.02 * np.arange(n)
        x[n // 2 : n // 2 + 9] *= 12
        rows.append((f"t{k}", x.tolist()))
    rows.append(("quiet", [0.0] * 500))
    traces = traces_of(spark, rows)
    blocks = long.cut(traces, ["trace"], 128)
    level = whole_of(long.detrend(blocks, ["trace"]))
    for r in traces.select("trace", signal.detrend(F.col("samples")).alias("d")).collect():
        assert np.allclose(level[r.trace], r.d, atol=1e-9)
    for short, lasting, on in ((3, 40, 2.5), (1, 2, 1.5), (5, 60, 50.0)):
        want = {r.trace: r.o for r in traces.select("trace", signal.onset(F.col("samples"), short, lasting, on).alias("o")).collect()}
        got = {r.trace: r for r in long.onset(blocks, ["trace"], short, lasting, on).collect()}
        assert {k: r.onset for k, r in got.items()} == {k: o.onset for k, o in want.items()}
        assert all(got[k].top_ratio == pytest.approx(o.top_ratio, rel=1e-9) for k, o in want.items())
    for size, step, tolerance in ((100, 30, 5), (300, 150, 15), (60, 60, 0)):
        want = {(r.trace, r.w_idx): r.window for r in signal.sliding_windows(traces, float(size), 1.0, 1 - step / size).collect()}
        got = {(r.trace, r.w_idx): r.window for r in long.windows(blocks, ["trace"], size, signal.window_shape(float(size), 1.0, 1 - step / size)[1], int(0.05 * size)).collect()}
        assert got == want
    with pytest.raises(Exception, match="shorter than the long window"):
        long.onset(blocks, ["trace"], 3, 200, 2.0).collect()


POLES = [(-4.44, 4.44), (-4.44, -4.44), (-300.0, 0.0)]
RESPONSES = "network string, station string, channel string, epoch_start timestamp_ntz, epoch_end timestamp_ntz, input_unit string, sensitivity double, stage_gains array<double>, poles array<struct<re:double,im:double>>, zeros array<struct<re:double,im:double>>, a0 double, norm_hz double"


def reference_motion(x, fs, unit, out, gain, poles, zeros, a0, corners, level, taper):
    """Frequency by frequency, with plain loops."""
    n = len(x)
    length = 1
    while length < 2 * n:
        length *= 2
    flank = int(n * taper / 2 + 0.5)
    x = np.array(x) - np.mean(x)
    for k in range(flank):
        w = 0.5 * (1 - np.cos(np.pi * k / flank))
        x[k] *= w
        x[n - 1 - k] *= w
    spectrum = np.fft.rfft(np.concatenate([x, np.zeros(length - n)]))
    h, made = [], []
    for k in range(len(spectrum)):
        s = 2j * np.pi * k * fs / length
        v = gain * a0
        for z in zeros:
            v = v * (s - complex(*z))
        for p in poles:
            v = v / (s - complex(*p))
        power = {"M": 0, "M/S": 1, "M/S**2": 2}[unit] - {"disp": 0, "vel": 1, "acc": 2}[out]
        h.append(v * s**power if k or power >= 0 else 0)
    floor = max(map(abs, h)) * 10 ** (-level / 20)
    for k, v in enumerate(spectrum):
        f, t = k * fs / length, 1.0
        if corners:
            a, b, c, d = corners
            t = 0.0 if f < a or f > d else 0.5 * (1 - np.cos(np.pi * (f - a) / (b - a))) if f < b else 1.0 if f <= c else 0.5 * (1 + np.cos(np.pi * (f - c) / (d - c)))
        made.append(0 if h[k] == 0 else v * t / (h[k] if abs(h[k]) >= floor else h[k] / abs(h[k]) * floor))
    return np.fft.irfft(made, length)[:n]


def test_response_removal(spark):
    rng = np.random.default_rng(3)
    day = lambda d: f"2024-01-{d:02d} 00:00:00"
    zeros = [(0.0, 0.0), (0.0, 0.0)]
    table = [
        ("N", "A", "HHZ", day(1), day(10), "M/S", 6e8, [1500.0, 4e5], POLES, zeros, 310.0, None),
        ("N", "A", "HHZ", day(10), None, "M/S", 3e8, [750.0, 4e5], POLES, zeros, None, 1.0),
        ("N", "B", "HNZ", None, None, "M/S**2", 4e5, None, [(-500.0, 0.0)], [], 500.0, None),
        ("N", "C", "HHZ", day(1), None, "PA", 1.0, [1.0], [], [], 1.0, None),
        ("N", "D", "HHZ", day(1), None, "M/S", 0.0, [None], [], [], 1.0, None),
    ]
    cast = lambda df, *c: df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in c})
    responses = cast(spark.createDataFrame(table, RESPONSES.replace("timestamp_ntz", "string")), "epoch_start", "epoch_end")
    records = [("a1", "A", "HHZ", day(5), 100.0, 500), ("a2", "A", "HHZ", day(10), 100.0, 500), ("a3", "A", "HHZ", "2023-12-31 00:00:00", 100.0, 500), ("b", "B", "HNZ", day(3), 50.0, 333), ("c", "C", "HHZ", day(5), 100.0, 50), ("d", "D", "HHZ", day(5), 100.0, 50), ("x", "X", "HHZ", day(5), 100.0, 50), ("null", "A", "HHZ", day(5), 100.0, 0)]
    rows = [(k, "N", s, c, t, fs, (rng.normal(size=n) * 1000).tolist() if n else None) for k, s, c, t, fs, n in records]
    traces = cast(spark.createDataFrame(rows, "id string, network string, station string, channel string, starttime string, sampling_rate double, samples array<double>"), "starttime")
    corners = (0.05, 0.1, 20.0, 24.0)
    got = {r.id: r for r in groundmotion.without_response(traces, responses, ("disp", "vel", "acc"), corners).collect()}
    assert len(got) == len(rows) and {k for k, r in got.items() if r.response_ok} == {"a1", "a2", "b", "null"}
    a0 = abs((2j * np.pi * 1.0) ** 2 / np.prod([2j * np.pi - complex(*p) for p in POLES])) ** -1
    want = {"a1": ("M/S", 6e8, POLES, zeros, 310.0), "a2": ("M/S", 3e8, POLES, zeros, a0), "b": ("M/S**2", 4e5, [(-500.0, 0.0)], [], 500.0)}
    for k, (unit, gain, poles, z, norm) in want.items():
        x = next(r for r in rows if r[0] == k)
        for out in ("disp", "vel", "acc"):
            motion = reference_motion(x[6], x[5], unit, out, gain, poles, z, norm, corners, 60.0, 0.05)
            assert np.allclose(got[k][out], motion, rtol=1e-8, atol=1e-10 * np.abs(motion).max())
    assert all(got[k].vel is None and got[k].acc is None for k in ("a3", "c", "d", "x", "null"))
    assert got["a1"].sens_mismatch == pytest.approx(0.0) and got["a3"].sens_mismatch is None
    with pytest.raises(ValueError):
        groundmotion.without_response(traces, responses, ("snap",))


def test_a_sine_comes_back_as_its_ground_motion(spark):
    """A 2 Hz velocity of 1 mm/s seen through the response is found again, and so is its acceleration."""
    fs, hz, n = 100.0, 2.0, 6000
    t = np.arange(n) / fs
    response = {"gain": 6e8, "unit": "M/S", "poles": POLES, "zeros": [(0.0, 0.0)] * 2, "a0": 310.0, "norm_hz": None}
    h = groundmotion.transfer(np.array([hz]), response, "vel")[0]
    counts = 1e-3 * abs(h) * np.sin(2 * np.pi * hz * t + np.angle(h))
    vel, acc = groundmotion.divided(counts[None], fs, response, ("vel", "acc"), (0.05, 0.1, 40.0, 45.0), 60.0, 0.05)
    inner = slice(1000, 5000)
    assert np.allclose(vel[0][inner], 1e-3 * np.sin(2 * np.pi * hz * t[inner]), atol=1e-5)
    assert np.allclose(acc[0][inner], 1e-3 * 2 * np.pi * hz * np.cos(2 * np.pi * hz * t[inner]), atol=1.3e-4)
