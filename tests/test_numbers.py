"""Kernels and statistics against plain NumPy references."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quakeframe.functions import columns as C
from quakeframe.operators import dsp, encode, evaluate, mining, sequence, signal, split
from quakeframe.sources import catalog, stead


def samples_of(spark, rows):
    return spark.createDataFrame([(k, None if r is None else [None if v is None else float(v) for v in r]) for k, r in enumerate(rows)], "id int, samples array<double>")


def reference_filter(x, fs, low, high):
    """Line and mean removed by lstsq, cosine taper, difference equation forward and backward over an odd extension."""
    n = len(x)
    a = np.stack([np.ones(n), np.arange(n)], axis=1)
    x = x - a @ np.linalg.lstsq(a, x, rcond=None)[0]
    side = int(0.05 * n)
    for k in range(side):
        w = 0.5 - 0.5 * math.cos(2 * math.pi * k / (2 * side - 1))
        x[k] *= w
        x[n - 1 - k] *= w
    b, d = dsp.butterworth(4, low, high, fs)
    pad = 3 * len(d)
    wide = np.concatenate([2 * x[0] - x[pad:0:-1], x, 2 * x[-1] - x[-2 : -pad - 2 : -1]])

    def once(v):
        # the steady state of a constant input is the state after many equal samples
        past_in, past_out = [v[0]] * (len(b) - 1), [v[0] * b.sum() / d.sum()] * (len(d) - 1)
        out = []
        for value in v:
            y = b[0] * value + sum(p * q for p, q in zip(b[1:], past_in)) - sum(p * q for p, q in zip(d[1:], past_out))
            past_in, past_out = [value, *past_in[:-1]], [y, *past_out[:-1]]
            out.append(y)
        return np.array(out)

    return once(once(wide)[::-1])[::-1][pad:-pad]


def test_filter_equals_the_difference_equation(spark):
    rng = np.random.default_rng(1)
    rows = [rng.normal(size=400) + 0.01 * np.arange(400), rng.normal(size=250), rng.normal(size=400), None, [], [1.0, None, 2.0]]
    got = {r.id: r.samples for r in dsp.clean(samples_of(spark, rows), 100.0, 2.0, 20.0).collect()}
    for k in range(3):
        assert np.allclose(got[k], reference_filter(np.array(rows[k], float), 100.0, 2.0, 20.0), atol=1e-8)
    assert got[3] is None and got[5] is None
    b, a = dsp.butterworth(4, 2.0, 20.0, 100.0)
    gain = lambda hz: abs(np.polyval(b, np.exp(2j * np.pi * hz / 100)) / np.polyval(a, np.exp(2j * np.pi * hz / 100)))
    assert gain(2.0) == pytest.approx(math.sqrt(0.5), rel=1e-6) == gain(20.0) and gain(0.3) < 1e-3 and gain(45) < 1e-2


def reference_decibels(x, n_fft, hop, top):
    half = n_fft // 2
    wide = np.concatenate([x[half:0:-1], x, x[-2 : -half - 2 : -1]])
    out = []
    for at in range(0, len(x) + 1, hop):
        frame = [wide[at + k] * (0.5 - 0.5 * math.cos(2 * math.pi * k / n_fft)) for k in range(n_fft)]
        out.append([10 * math.log10(max(abs(sum(v * np.exp(-2j * np.pi * f * k / n_fft) for k, v in enumerate(frame))) ** 2, 1e-10)) for f in range(half + 1)])
    db = np.array(out).T
    return np.maximum(db, db.max() - top)


def test_spectrograms_and_profiles(spark):
    rng = np.random.default_rng(2)
    rows = [rng.normal(size=64), rng.normal(size=64) * 3, rng.normal(size=6)]
    spectra = dsp.spectrograms(samples_of(spark, rows), 16, 8, 40.0).cache()
    got = {r.id: r for r in spectra.collect()}
    for k in (0, 1):
        want = reference_decibels(rows[k], 16, 8, 40.0)
        assert (got[k].freq, got[k].frames) == want.shape == signal.stft_shape(64.0, 1.0, 16, 8) and np.allclose(np.reshape(got[k].db, want.shape), want, atol=1e-4)
    assert got[2].db is None
    both = np.hstack([np.reshape(got[k].db, (9, 9)) for k in (0, 1)])
    medians = {r.bin: r.median_db for r in dsp.profile(spectra, []).collect()}
    assert medians == {b: pytest.approx(np.sort(both[b])[(len(both[b]) - 1) // 2]) for b in range(9)}


def test_spectral_baselines_take_the_first_files(spark):
    rng = np.random.default_rng(3)
    rows = [("N.A", "z", f"f{k}", rng.normal(size=64).tolist()) for k in (2, 0, 1)] + [("N.B", "z", "f0", rng.normal(size=64).tolist())]
    records = spark.createDataFrame(rows, "station_key string, component string, file_path string, samples array<double>")
    got = dsp.spectral_baselines(records, 64.0, least_seconds=2.0, most_files=2, n_fft=16, hop=8).collect()
    assert [r.station_key for r in got] == ["N.A"]  # one record has too few frames
    both = np.hstack([reference_decibels(np.array(next(r[3] for r in rows if r[:3] == ("N.A", "z", f))), 16, 8, 80.0) for f in ("f0", "f1")])
    assert np.allclose(got[0].profile, np.sort(both, axis=1)[:, (both.shape[1] - 1) // 2], atol=1e-4)


def test_spectrogram_images_against_the_profile(spark):
    rng = np.random.default_rng(4)
    own = [rng.normal(size=64) * s for s in (1, 10, 100)]
    rows = [("N.A", *(x.tolist() for x in own)), ("N.B", *(x.tolist() for x in own))]
    windows = spark.createDataFrame(rows, "station_key string, z array<double>, n array<double>, e array<double>")
    profiles = spark.createDataFrame([("N.A", c, [float(k)] * 9) for k, c in enumerate("zne")] + [("N.B", c, [0.0] * 9) for c in "zn"], "station_key string, component string, profile array<double>")
    held = encode.with_profiles(windows, profiles)
    db = np.stack([reference_decibels(x, 16, 8, 1000.0) for x in own])
    db = np.maximum(db, db.max() - 30.0)
    got = {r.station_key: np.reshape(r.img, (3, 9, 9)) for r in encode.spectrogram_images(held, 16, 8, 30.0).collect()}
    assert np.allclose(got["N.A"], db - np.arange(3)[:, None, None], atol=1e-3)
    z = (db - db.mean()) / (db.std(ddof=1) + 1e-6)
    assert np.allclose(got["N.B"], z, atol=1e-4)  # two of three profiles: z-scores
    assert [r.station_key for r in encode.spectrogram_images(held, 16, 8, 30.0, strict=True).collect()] == ["N.A"]
    for mode, want in (("per_window", z), ("none", db)):
        assert all(np.allclose(np.reshape(r.img, (3, 9, 9)), want, atol=1e-3) for r in encode.spectrogram_images(held, 16, 8, 30.0, mode).collect())


def reference_exponent(x, emb=4, theiler=3):
    points = [x[k : k + emb] for k in range(len(x) - emb + 1)]
    m = len(points)
    if m < 10:
        return None
    mates = []
    for i in range(m):
        gaps = [(sum((p - q) ** 2 for p, q in zip(points[i], points[j])), j) for j in range(m) if abs(i - j) > theiler]
        mates.append(min(gaps)[1])
    curve = []
    for k in range(min(m // 4, 20)):
        gaps = [math.sqrt(sum((p - q) ** 2 for p, q in zip(points[i + k], points[j + k]))) for i, j in enumerate(mates) if max(i, j) + k < m]
        gaps = [g for g in gaps if g > 0]
        if len(gaps) < 3:
            break
        curve.append(sum(map(math.log, gaps)) / len(gaps))
    return float(np.polyfit(range(len(curve)), curve, 1)[0]) if len(curve) >= 3 else None


def test_largest_exponent(spark):
    rng = np.random.default_rng(5)
    chaos = [0.4]
    for _ in range(199):
        chaos.append(3.9 * chaos[-1] * (1 - chaos[-1]))
    rows = [rng.normal(size=64), chaos, np.sin(np.arange(120) / 3), np.round(rng.normal(size=50), 1), np.zeros(40), rng.normal(size=11), rng.normal(size=13), None]
    got = {r.id: r.lyapunov for r in dsp.lyapunov(samples_of(spark, rows)).collect()}
    for k, x in enumerate(rows[:-1]):
        want = reference_exponent(list(map(float, x)))
        assert got[k] == (None if want is None else pytest.approx(want, abs=1e-9)), k
    assert got[7] is None and got[1] > 0.2 > abs(got[2])


@pytest.mark.parametrize(("fs_from", "fs_to"), [(100.0, 50.0), (40.0, 100.0), (100.0, 100.0)])
def test_resample_is_the_polyphase_sum(spark, fs_from, fs_to):
    rng = np.random.default_rng(6)
    x = rng.normal(size=60)
    got = encode.resample(samples_of(spark, [x]), "samples", fs_from, fs_to, 80).first().samples
    g = math.gcd(int(fs_from), int(fs_to))
    up, down = int(fs_to) // g, int(fs_from) // g
    want = np.zeros(80)
    if up == down:
        want[:60] = x
    else:
        wide = max(up, down)
        half = 10 * wide
        t = np.arange(-half, half + 1)
        taps = np.sinc(t / wide) * np.kaiser(2 * half + 1, 5.0)
        taps *= up / taps.sum()
        for m in range(min(80, -(-60 * up // down))):
            want[m] = sum(x[k] * taps[m * down - k * up + half] for k in range(60) if abs(m * down - k * up) <= half)
    assert np.allclose(got, want, atol=1e-9)


def tail_of_rho(rho, df):
    """Two-sided tail: the t density in the angle asin(rho) is a power of the cosine, summed by Simpson's rule."""

    def area(end):
        grid = np.linspace(0, end, 20_001)
        f = np.cos(grid) ** (df - 1)
        return (f[0] + f[-1] + 4 * f[1:-1:2].sum() + 2 * f[2:-1:2].sum()) * (grid[1] - grid[0]) / 3

    return 1 - area(math.asin(min(abs(rho), 1.0))) / area(math.pi / 2)


def test_p_values(spark):
    rng = random.Random(7)
    for n in (3, 4, 11, 40, 900):
        x = [float(rng.randrange(30)) for _ in range(n)]
        y = [a + rng.gauss(0, 12 if n < 400 else 300) for a in x]
        r = evaluate.spearman(spark.createDataFrame(list(zip(x, y)), "x double, y double"), "x", "y").first()
        assert r.p == pytest.approx(tail_of_rho(r.rho, n - 2), abs=1e-9), n
    d = [rng.choice([-3, -2, -1, 0, 1, 2, 3, 4, 5]) for _ in range(60)]
    got = evaluate.wilcoxon(spark.createDataFrame([(float(v),) for v in d], "d double"), "d").first()
    own = sorted(abs(v) for v in d if v)
    rank = {v: (own.index(v) + 1 + own.index(v) + own.count(v)) / 2 for v in own}
    n, plus = len(own), sum(rank[v] for v in d if v > 0)
    w = min(plus, n * (n + 1) / 2 - plus)
    spread = math.sqrt(n * (n + 1) * (2 * n + 1) / 24 - sum(own.count(v) ** 3 - own.count(v) for v in set(own)) / 48)
    assert (got.n, got.w) == (n, w) and got.p == pytest.approx(math.erfc(abs(w - n * (n + 1) / 4) / spread / math.sqrt(2)), rel=1e-9)
    assert evaluate.wilcoxon(spark.createDataFrame([(1.0,)] * 9, "d double"), "d").first().p is None
    for z in (0.0, 0.7, 2.9, 3.1, 8.0):
        assert spark.range(1).select(evaluate.normal_two_sided(F.lit(z)).alias("p")).first().p == pytest.approx(math.erfc(z / math.sqrt(2)), rel=1e-8)


def test_small_p_values_of_correlations(spark):
    """Against the tail's own series, whose terms are all positive, in exact rationals and 60 digits."""
    from decimal import Decimal, getcontext
    from fractions import Fraction

    getcontext().prec = 60

    def tail(rho, n):  # I_x(a, 1/2) = x^a / B(a, 1/2) * sum of (1/2)_k / k! x^k / (a + k)
        x, a = 1 - Fraction(rho) ** 2, Fraction(n - 2, 2)
        xd = Decimal(x.numerator) / Decimal(x.denominator)
        total, term, k = Decimal(0), Decimal(1), 0
        while term > Decimal(10) ** -55 and k < 20_000:
            total += term / (Decimal(a.numerator) / Decimal(a.denominator) + k)
            term *= (Decimal(k) + Decimal("0.5")) / (k + 1) * xd
            k += 1
        log_beta = math.lgamma(a) + math.lgamma(0.5) - math.lgamma(a + 0.5)
        return math.log10(total) + float(Decimal(a.numerator) / Decimal(a.denominator) * xd.log10()) - log_beta / math.log(10)

    cases = [(0.95, 100), (0.99, 100), (-0.99, 100), (0.9, 30), (0.7, 12), (0.3, 5000), (0.999, 60), (0.05, 60_000), (0.5, 402), (0.5, 403), (1 - 1e-12, 10)]
    got = spark.createDataFrame(cases, "rho double, n long").select("rho", "n", F.log10(evaluate.t_two_sided(F.col("rho"), F.col("n"))).alias("p")).collect()
    for r in got:
        assert r.p == pytest.approx(tail(r.rho, r.n), abs=4e-7), (r.rho, r.n)  # six digits of p
    edge = spark.createDataFrame([(1.0, 9), (0.0, 9), (None, 9), (0.4, 2), (1e-9, 1_000_000_000)], "rho double, n long").select(evaluate.t_two_sided(F.col("rho"), F.col("n")).alias("p")).collect()
    assert [r.p for r in edge[:4]] == [0.0, 1.0, None, None] and edge[4].p == pytest.approx(math.erfc(1e-9 * math.sqrt(1e9) / math.sqrt(2)), rel=1e-6)


def test_exact_signed_ranks(spark):
    rng = random.Random(8)

    def exact(d):
        ranks = {v: k + 1 for k, v in enumerate(sorted(map(abs, d)))}
        w = min(sum(ranks[abs(v)] for v in d if v > 0), sum(ranks[abs(v)] for v in d if v < 0))
        ways = [1]
        for k in range(1, len(d) + 1):
            ways = [(ways[s] if s < len(ways) else 0) + (ways[s - k] if s >= k else 0) for s in range(len(ways) + k)]
        return min(1.0, 2 * sum(ways[: w + 1]) / 2 ** len(d))

    groups = {"ten": [float(k) for k in range(1, 11)], "fifty": [rng.gauss(0.2, 1) for _ in range(50)], "even": [1.0, -2.0, 3.0, -4.0, 5.0, -6.0, 7.0, -8.0, 9.0, -10.0, -11.0], "few": [1.0, 2.0]}
    rows = [(g, v) for g, d in groups.items() for v in d] + [("many", rng.gauss(0, 1)) for _ in range(51)] + [("ties", v) for v in [1.0, -1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0]] + [("zero", float(k)) for k in range(12)] + [("ten", None), (None, 1.0)]
    got = {r.g: r for r in evaluate.wilcoxon(spark.createDataFrame(rows, "g string, d double"), "d", by=("g",)).collect()}
    for g in ("ten", "fifty", "even"):
        assert got[g].n == len(groups[g]) and got[g].p == pytest.approx(exact(groups[g]), rel=1e-12)
    assert got["ten"].p == pytest.approx(0.001953125) and got["few"].p is None and got[None].p is None
    for g, d in (("many", [v for k, v in rows if k == "many"]), ("ties", [v for k, v in rows if k == "ties"]), ("zero", [float(k) for k in range(1, 12)])):
        n, own = len(d), sorted(map(abs, d))
        spread = math.sqrt(n * (n + 1) * (2 * n + 1) / 24 - sum(own.count(v) ** 3 - own.count(v) for v in set(own)) / 48)
        assert got[g].n == n and got[g].p == pytest.approx(math.erfc(abs(got[g].w - n * (n + 1) / 4) / spread / math.sqrt(2)), rel=1e-9)
    whole = evaluate.wilcoxon(spark.createDataFrame([(v,) for v in groups["fifty"]], "d double"), "d").first()
    assert whole.p == pytest.approx(exact(groups["fifty"]), rel=1e-12)


def test_running_sums_of_a_hot_group(spark):
    rng = random.Random(8)
    rows = [("hot" if k % 10 else rng.choice("ab"), rng.randrange(50), k, rng.randrange(9)) for k in range(600)] + [(None, 1, 1000, 5), (None, 0, 1001, 7)]
    df = spark.createDataFrame(rows, "g string, o int, k long, v long").repartition(5)
    got = {r.k: (r.before, r.n) for r in sequence.running(df, ["o", "k"], {"before": F.col("v"), "n": F.lit(1)}, ["g"]).collect()}
    down = {r.k: r.before for r in sequence.running(df, [F.desc("o"), F.desc("k")], {"before": F.col("v")}).collect()}
    assert len(got) == len(down) == len(rows)
    for g, o, k, _ in rows:
        own = [r for r in rows if r[0] == g and (r[1], r[2]) < (o, k)]
        assert got[k] == (sum(r[3] for r in own), len(own)) and down[k] == sum(r[3] for r in rows if (r[1], r[2]) > (o, k))
    assert sequence.running(df.limit(0), ["o"], {"x": F.col("v")}, ["g"]).count() == 0
    q = {r.g: r.edges for r in evaluate.quantiles(df, "o", [0.0, 1 / 3, 0.5, 1.0], ("g",)).collect()}
    for g in ("hot", "a", None):
        assert q[g] == pytest.approx(np.quantile([r[1] for r in rows if r[0] == g], [0.0, 1 / 3, 0.5, 1.0]).tolist()) if g else True


def test_neighbours_are_strict_and_cross_buckets(spark):
    rng = random.Random(9)
    left = [(rng.choice("ab"), rng.randrange(0, 40) * 43_200, k) for k in range(80)]
    right = [(rng.choice("ab"), rng.randrange(0, 40) * 43_200, rng.randrange(5)) for _ in range(25)]
    at = lambda c: F.timestamp_seconds(c).cast("timestamp_ntz")
    l_df = spark.createDataFrame(left, "by string, s long, k long").select("by", at(F.col("s")).alias("t"), "k", "s").repartition(3)
    r_df = spark.createDataFrame(right, "by string, s long, m int").select("by", at(F.col("s")).alias("u"), "m", "s")
    got = {r.k: r for r in sequence.neighbours(l_df, r_df, "by", "t", "u", "prev", "next", ("m", "s")).collect()}
    assert len(got) == len(left)
    for by, s, k in left:
        before, after = [(x, m) for b, x, m in right if b == by and x < s], [(x, m) for b, x, m in right if b == by and x > s]
        assert (got[k].prev and (got[k].prev.s, got[k].prev.m)) == max(before, default=None) and (got[k].next and (got[k].next.s, got[k].next.m)) == min(after, default=None)


def test_matched_negatives_follow_the_target_by_group(spark):
    rng = np.random.default_rng(10)
    pool = [(s, f"p{k}", float(v)) for s in "ab" for k, v in enumerate(rng.normal(0, 1, 900))]
    target = [(s, float(v)) for s in "ab" for v in rng.normal(1 if s == "a" else -0.5, 0.3, 300)]
    p, t = spark.createDataFrame(pool, "split string, k string, score double"), spark.createDataFrame(target, "split string, score double")
    got = mining.matched_pick(p, t, "score", ["k"], F.when(F.col("split") == "a", 60).otherwise(80), by=("split",)).collect()
    assert len({(r.split, r.k) for r in got}) == len(got)
    for s, n in (("a", 60), ("b", 80)):
        own = [r.score for r in got if r.split == s]
        edges = np.unique(np.quantile([v for g, v in target if g == s], np.linspace(0, 1, 41)))
        assert len(own) == n and abs(np.median(own) - np.median([v for g, v in target if g == s])) < 0.15
        inside = [v for v in own if edges[0] <= v < edges[-1]]
        assert len(inside) >= 0.8 * n


def test_even_places(spark):
    for n in (1, 7, 20, 101):
        for quota in (0, 1, 2, 5, 20, 60):
            got = [r.id for r in spark.range(n).where(split.evenly_spaced(F.col("id"), F.lit(n), quota)).collect()]
            want = sorted({int(np.rint(k * (n - 1) / max(quota - 1, 1))) for k in range(quota)}) if quota < n else list(range(n))
            assert sorted(got) == want, (n, quota)


def test_catalog_headers(spark):
    rows = [("2024-01-02", "03:04:05", "4.5")]
    for date, clock in (("Date", "Time"), ("tarih", " SAAT "), ("DATE", "saat")):
        got = catalog.normalize(spark.createDataFrame(rows, f"`{date}` string, `{clock}` string, buyukluk string")).first()
        assert str(got.time) == "2024-01-02 03:04:05" and got.magnitude == 4.5 and got.depth == 10.0
    whole = [("2024-01-02 03:04:05", "junk", "4.5")]
    for name in ("datetime", "date_time", "origin_time", "olus zamani", "oluş zamanı", "tarih_saat"):
        got = catalog.normalize(spark.createDataFrame(whole, f"`{name}` string, other string, Mw string")).first()
        assert str(got.time) == "2024-01-02 03:04:05"
    both = spark.createDataFrame([("2024-01-02 03:04:05", "23:00:00", "4.5")], "datetime string, time string, mag string")
    assert str(catalog.normalize(both).first().time) == "2024-01-02 03:04:05"  # a time without a date column isn't joined
    found = catalog.event_table(spark.createDataFrame([(0, "3.0", "38"), (1, "x", "39"), (2, "5.0", "40")], "row int, Mag string, Lat string"), "row")
    assert sorted((r.event_id, r.magnitude, r.lat, r.lon) for r in found.collect()) == [("idx_0", 3.0, 38.0, None), ("idx_2", 5.0, 40.0, None)]
    stations = spark.createDataFrame([("N", "S", 1.0, 2.0, 0), ("M", "S", 3.0, 4.0, 1)], "network string, station string, latitude double, longitude double, row int")
    bare = lambda last: {r.key: r.latitude for r in catalog.station_keys(stations, "row", last).collect()}
    assert bare(False) == {"N.S": 1.0, "M.S": 3.0, "S": 1.0} and bare(True) == {"N.S": 1.0, "M.S": 3.0, "S": 3.0}
    with pytest.raises(ValueError):
        catalog.normalize(spark.createDataFrame([("a",)], "x string"))


def test_shapes_scalars_and_slices(spark):
    assert signal.suggested_stft(100.0, 3.0) == (64, 16) and signal.suggested_stft(100.0, 6.0) == (128, 32) and signal.suggested_stft(10.0, 1.0) == (32, 8)
    assert signal.stft_problem(100.0, 3.0, 256) == ("severe", 64, 16) and signal.stft_problem(100.0, 6.0, 256) == ("warn", 128, 32)
    assert signal.stft_problem(100.0, 60.0, 256) is None and signal.stft_problem(10.0, 1.0, 32) is None
    row = spark.createDataFrame([([1.0, 2.0, 4.0], 7)], "x array<double>, k int")
    z = row.select(C.z_scores(F.col("x")).alias("z")).first().z
    assert np.allclose(z, (np.array([1, 2, 4]) - 7 / 3) / (np.std([1, 2, 4], ddof=1) + 1e-6))
    deg = row.select(C.degrees(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(90.0)).alias("d")).first().d
    assert deg == pytest.approx(90.0)
    long = spark.createDataFrame([(k, list(map(float, range(20)))) for k in range(200)], "k int, x array<double>")
    cuts = long.select(encode.random_window(F.col("x"), 5, "k").alias("w")).collect()
    assert all(r.w == list(map(float, range(int(r.w[0]), int(r.w[0]) + 5))) for r in cuts) and {r.w[0] for r in cuts} == set(map(float, range(16)))
    arrivals = long.limit(1).select(encode.anchored(F.col("x"), F.lit(2.7), 10, 0.2, False).alias("a"), encode.anchored(F.col("x"), F.lit(15.0), 10, 0.2, False).alias("b"), encode.anchored(F.col("x"), F.lit(15.0), 10, 0.2).alias("c")).first()
    assert arrivals.a[0] == 1.0 and arrivals.b is None and arrivals.c[0] == 10.0


def test_long_windows_equal_those_of_arrays(spark):
    rng = random.Random(11)
    rows = [(g, k, rng.random(), rng.random() < 0.2) for g, n in (("a", 97), ("b", 40), ("c", 9), ("d", 8), ("e", 10)) for k in range(n)]
    df = spark.createDataFrame(rows, "g string, k int, v double, gap boolean").repartition(4)
    arrays = df.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("k", "v", "gap"))).alias("x")).select("g", F.transform("x", lambda r: r["v"]).alias("samples"), F.transform("x", lambda r: r["gap"]).alias("mask"))
    size, step, tolerance = signal.window_shape(10.0, 2.0, 0.75)
    want = {(r.g, r.w_idx): r.window for r in signal.sliding_windows(arrays, 10.0, 2.0, 0.75, mask="mask", most_gaps=0.25).collect()}
    got = {(r.g, r.w_idx): r.window for r in signal.long_windows(df, ["g"], ["k"], "v", size, step, tolerance, "gap", 0.25).collect()}
    assert got == want and len(want) > 5


def test_trace_attributes_and_components(spark):
    rows = [(1, "[12.5 3.0 1.0]", "3.1", "100"), (2, "5", " ", "10"), (3, "", "4.0", "x"), (4, "[ 20, 1]", "9", "1")]
    df = spark.createDataFrame(rows, "id int, snr string, magnitude string, distance string")
    ids = lambda *limits: {r.id for r in stead.matching(df, *limits).collect()}
    assert ids(None, None, 10) == {1, 4} and ids(4) == {3, 4} and ids(None, 50) == {2, 4} and ids() == {1, 2, 3, 4}
    shapes = [(1, [[float(3 * k + c) for c in range(3)] for k in range(5)]), (2, [[float(10 * c + k) for k in range(5)] for c in range(3)]), (3, [[1.0, 2.0]] * 4), (4, None)]
    got = {r.id: r for r in stead.components(spark.createDataFrame(shapes, "id int, samples array<array<double>>")).collect()}
    assert set(got) == {1, 2} and got[1].z == [2.0, 5.0, 8.0, 11.0, 14.0] and got[1].e[:2] == [0.0, 3.0] and got[2].z == [20.0, 21.0, 22.0, 23.0, 24.0] and got[2].e[0] == 0.0


def test_filling_by_phases_equals_one_pass(spark, monkeypatch):
    rng = random.Random(11)
    for weights, n in ((["a"], 40), (["a", "b"], 120), (["a", "b", "c"], 90), (["a", "b"], 0)):
        rows = [(f"s{k}", *(rng.choice([0, 0, 1, 5, 30, None]) for _ in weights)) for k in range(n)]
        keys = spark.createDataFrame(rows, "station string, " + ", ".join(f"{w} long" for w in weights))
        one = {tuple(r) for r in split.fill_splits(keys, "station", weights).collect()}
        monkeypatch.setattr(split, "ONE_TASK_KEYS", -1)
        assert {tuple(r) for r in split.fill_splits(keys, "station", weights).collect()} == one
        monkeypatch.undo()
        assert n == 0 or {s for _, s in one} == {"train", "val", "test"}


def test_correlations_of_groups_that_fit_a_task_need_no_ranges(spark, monkeypatch):
    rng = random.Random(12)
    sizes = {"small": 15, "large": 90, None: 40, "odd": 12}
    rows = [(g, float(rng.randrange(9)), rng.gauss(0, 1)) for g, n in sizes.items() for _ in range(n)] + [("small", None, 1.0), ("small", 1.0, None)]
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(3)

    def average(values):
        return [(sum(v < a for v in values) + 1 + sum(v <= a for v in values)) / 2 for a in values]

    expected = {}
    for g, n in sizes.items():
        own = [r for r in rows if r[0] == g and r[1] is not None and r[2] is not None]
        expected[g] = (n, pytest.approx(np.corrcoef(average([r[1] for r in own]), average([r[2] for r in own]))[0, 1], abs=1e-12))
    both = []
    running = evaluate.running
    monkeypatch.setattr(evaluate, "running", lambda *a, **k: both.append(a) or running(*a, **k))
    of = lambda: {r.g: (r.n, r.rho) for r in evaluate.spearman(df, "x", "y", by=("g",)).collect()}
    assert of() == expected and not both
    monkeypatch.setattr(evaluate, "GROUP_ROWS", 30)  # the larger groups, a null one too, go by ranges
    assert of() == expected and len(both) == 2
