"""Queries over sample arrays, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from quakeframe.functions import columns as C
from quakeframe.operators import dsp, groundmotion
from quakeframe.operators import long as L
from quakeframe.operators import signal as G
from quakeframe.operators.sequence import running
from quakeframe.operators.split import with_total
from quakeframe.plans import fixtures as X
from quakeframe.plans import jobs as J
from quakeframe.plans.fixtures import CATALOG_SQL, TRACES_SQL


def standardize(spark, sf_dir):
    z = X.traces(spark, sf_dir).select("trace", C.standardize(F.col("samples")).alias("z"))
    return z.select("trace", F.round(F.element_at("z", 1), 9).alias("first"), F.round(F.array_max("z"), 9).alias("top"), F.round(F.array_min("z"), 9).alias("least"))


_Z = "z AS (SELECT trace, samples, list_transform(samples, lambda v: (v - list_avg(samples)) / greatest(list_stddev_pop(samples), 1e-12)) AS z FROM traces)"
STANDARDIZE_SQL = f"WITH {TRACES_SQL}, {_Z} SELECT trace, round(z[1], 9) AS first, round(list_max(z), 9) AS top, round(list_min(z), 9) AS least FROM z"


def angle_image(spark, sf_dir):
    """Sixteen relative angles of each trace, and two image cells as pixels."""
    beta = X.traces(spark, sf_dir).select("trace", G.relative_angles(F.col("samples"), 16).alias("b"))
    image = beta.withColumn("img", G.angle_image(F.col("b")))
    cell = lambda i, j: F.element_at(F.element_at("img", i + 1), j + 1)
    return image.select("trace", F.round(F.element_at("b", 1), 7).alias("b0"), F.round(F.element_at("b", 16), 7).alias("b15"), F.round(cell(2, 9), 7).alias("r_2_9"), F.round(cell(9, 2), 7).alias("r_9_2"))


ANGLE_IMAGE_SQL = f"""WITH {TRACES_SQL}, {_Z}, seg AS (SELECT trace, i, list_slice(z, i*4 + 1, i*4 + 4) AS s, [list_sum(list_transform(range(0, 16), lambda k: z[k*4 + 1 + j])) / 16 FOR j IN range(0, 4)] AS m FROM z, range(0, 16) t(i)),
b AS (SELECT trace, i, acos(least(greatest(list_dot_product(s, m) / (sqrt(list_dot_product(s, s)) * sqrt(list_dot_product(m, m))), -1), 1)) AS b FROM seg)
SELECT trace, round(max(b) FILTER (i = 0), 7) AS b0, round(max(b) FILTER (i = 15), 7) AS b15, round(max(b) FILTER (i = 9) - max(b) FILTER (i = 2), 7) AS r_2_9, round(max(b) FILTER (i = 2) - max(b) FILTER (i = 9), 7) AS r_9_2 FROM b GROUP BY trace"""


def sliding_windows(spark, sf_dir):
    """Windows of 20 samples, overlap 0.5, of each trace; a tail that is short by one sample at most is padded."""
    w = G.sliding_windows(X.traces(spark, sf_dir), 10.0, 2.0, 0.5)
    return w.select("trace", "w_idx", F.size("window").alias("n"), F.round(F.aggregate("window", F.lit(0.0), lambda a, v: a + v), 9).alias("total"))


SLIDING_WINDOWS_SQL = f"""WITH {TRACES_SQL}, w AS (SELECT trace, i AS w_idx, list_slice(samples, i*10 + 1, i*10 + 20) AS s FROM traces, range(0, 6) t(i))
SELECT trace, CAST(w_idx AS INT) AS w_idx, 20 AS n, round(list_sum(s), 9) AS total FROM w WHERE len(s) >= 19"""


def window_counts(spark, sf_dir):
    """Window counts from sample numbers alone."""
    n = F.col("l_partkey") % 1000
    return X.table(spark, sf_dir, "lineitem").select(n.alias("npts"), G.window_count(n, 100.0, 0.6, 0.9).alias("n_windows")).distinct()


WINDOW_COUNTS_SQL = "SELECT DISTINCT l_partkey % 1000 AS npts, CASE WHEN l_partkey % 1000 >= 57 THEN CAST(floor((l_partkey % 1000 - 57) / 5.0::DOUBLE) AS BIGINT) + 1 ELSE 0 END AS n_windows FROM lineitem"


def gap_windows(spark, sf_dir):
    """Windows over each user's values in time, those with more than 5 % errors left out."""
    rows = X.catalog(spark, sf_dir).where("user_id is not null").withColumn("gap", F.col("event_type") == "error")
    w = G.long_windows(rows, ["user_id"], ["time", "event_id"], "value", 10, 5, mask="gap", most_gaps=0.1)
    return w.select("user_id", "w_idx", F.round(F.aggregate("window", F.lit(0.0), lambda a, v: a + v), 6).alias("total"))


GAP_WINDOWS_SQL = f"""WITH {CATALOG_SQL}, p AS (SELECT user_id, value, event_type, row_number() OVER (PARTITION BY user_id ORDER BY time, event_id) - 1 AS k, count(*) OVER (PARTITION BY user_id) AS n FROM catalog),
w AS (SELECT user_id, i AS w_idx, count(*) AS c, sum(value) AS total, sum(CAST(event_type = 'error' AS INT)) AS gaps FROM p, range(0, 5000) t(i) WHERE k >= i*5 AND k < i*5 + 10 AND n >= 10 AND i <= ceil((n - 10) / 5.0::DOUBLE) GROUP BY ALL)
SELECT user_id, CAST(w_idx AS INT) AS w_idx, round(total, 6) AS total FROM w WHERE c >= 10 AND gaps / 10.0::DOUBLE <= 0.1"""


def onset(spark, sf_dir):
    """First sample where the 3-sample to 16-sample energy ratio exceeds 2, and the largest ratio."""
    rows = X.traces(spark, sf_dir).select("trace", G.onset(F.col("samples"), 3, 16, 2.0).alias("o"))
    return rows.select("trace", "o.onset", F.round("o.top_ratio", 7).alias("top_ratio"))


ONSET_SQL = f"""WITH {TRACES_SQL}, p AS (SELECT trace, unnest(samples) AS v, unnest(range(0, len(samples))) AS i FROM traces),
r AS (SELECT trace, i, CASE WHEN i >= 15 THEN avg(v*v) OVER (PARTITION BY trace ORDER BY i ROWS 2 PRECEDING) / avg(v*v) OVER (PARTITION BY trace ORDER BY i ROWS 15 PRECEDING) ELSE 0.0 END AS ratio FROM p)
SELECT trace, CAST(min(i) FILTER (ratio > 2.0) AS INT) AS onset, round(max(ratio), 7) AS top_ratio FROM r GROUP BY trace"""


def consecutive_diff(spark, sf_dir):
    """RMS difference of consecutive windows of 16 samples; index 1 is missing in every third trace."""
    w = G.sliding_windows(X.traces(spark, sf_dir), 16.0, 1.0, 0.0).where("not (trace % 3 = 0 and w_idx = 1)")
    return G.consecutive_diff(w, ["trace"]).withColumn("rms_diff", F.round("rms_diff", 9))


CONSECUTIVE_DIFF_SQL = f"""WITH {TRACES_SQL}, w AS (SELECT trace, i AS w_idx, list_slice(samples, i*16 + 1, i*16 + 16) AS a, list_slice(samples, i*16 - 15, i*16) AS b FROM traces, range(1, 4) t(i) WHERE NOT (trace % 3 = 0 AND i <= 2))
SELECT trace, CAST(w_idx AS INT) AS w_idx, round(sqrt(list_sum(list_transform(range(1, 17), lambda k: (a[k] - b[k]) * (a[k] - b[k]))) / 16), 9) AS rms_diff FROM w"""


def detrend(spark, sf_dir):
    d = X.traces(spark, sf_dir).select("trace", G.detrend(F.col("samples")).alias("d"))
    return d.select("trace", F.round(F.element_at("d", 1), 9).alias("first"), F.round(F.element_at("d", -1), 9).alias("last"))


DETREND_SQL = f"""WITH {TRACES_SQL}, p AS (SELECT trace, unnest(samples) AS v, unnest(range(0, len(samples))) AS i FROM traces), f AS (SELECT trace, regr_slope(v, i) AS m, regr_intercept(v, i) AS c FROM p GROUP BY trace)
SELECT trace, round(samples[1] - c, 9) AS first, round(samples[64] - c - 63*m, 9) AS last FROM traces JOIN f USING (trace)"""


def peaks(spark, sf_dir):
    """Peak amplitude after sample 20, vector peak of three consecutive traces' thirds, and a guarded log."""
    third = lambda k: F.slice("samples", 21 * k + 1, 21)
    rows = X.traces(spark, sf_dir).select("trace", C.peak(F.col("samples"), F.lit(20), F.lit(200)).alias("fwd"), C.peak(F.col("samples"), F.lit(70), F.lit(90)).alias("none"), F.array_max(C.vector_magnitude(third(0), third(1), third(2))).alias("vec"), F.element_at("samples", 1).alias("s1"))
    return rows.select("trace", F.round("fwd", 9).alias("fwd"), F.round("none", 9).alias("beyond"), F.round("vec", 9).alias("vec"), F.round(C.log10_positive(F.col("s1")), 9).alias("log_first"))


PEAKS_SQL = f"""WITH {TRACES_SQL} SELECT trace, round(list_max(list_transform(samples[21:], lambda v: abs(v))), 9) AS fwd, CAST(NULL AS DOUBLE) AS beyond,
round(list_max(list_transform(range(1, 22), lambda k: sqrt(samples[k]*samples[k] + samples[k+21]*samples[k+21] + samples[k+42]*samples[k+42]))), 9) AS vec, round(CASE WHEN samples[1] > 0 THEN log10(samples[1]) END, 9) AS log_first FROM traces"""


def log_snr(spark, sf_dir):
    """Traces not below the least log signal-to-noise against their label's baseline."""
    t = X.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("trace"), F.col("embedding").cast("array<double>").alias("samples"), "label")
    base = t.where("trace % 2 = 0").select("label", F.explode("samples").alias("v")).groupBy("label").agg(F.stddev_pop("v").alias("sigma")).where("label <> 3")
    rows = t.join(F.broadcast(base), "label", "left").withColumn("s", G.log_snr(F.col("samples"), F.col("sigma")))
    return rows.where(F.col("s").isNull() | (F.col("s") >= -0.05)).select("trace", F.round("s", 7).alias("log_snr"))


LOG_SNR_SQL = """WITH t AS (SELECT vec_id AS trace, CAST(embedding AS DOUBLE[]) AS samples, label FROM embeddings), b AS (SELECT label, stddev_pop(v) AS sigma FROM (SELECT label, unnest(samples) AS v FROM t WHERE trace % 2 = 0) GROUP BY label HAVING label <> 3),
s AS (SELECT trace, ln(greatest(list_stddev_pop(samples), 1e-12) / sigma) AS s FROM t LEFT JOIN b USING (label)) SELECT trace, round(s, 7) AS log_snr FROM s WHERE s IS NULL OR s >= -0.05"""


def pixels(spark, sf_dir):
    """Angles as grey values."""
    return X.traces(spark, sf_dir).select("trace", C.uint8(F.element_at("samples", 1) * 10).alias("p0"), C.uint8(F.element_at("samples", 2) * 100).alias("p1"))


_PIXEL = "CAST(round_even((least(greatest({}, -pi()), pi()) + pi()) / (2*pi()) * 255, 0) AS INT)"
PIXELS_SQL = f"WITH {TRACES_SQL} SELECT trace, {_PIXEL.format('samples[1]*10')} AS p0, {_PIXEL.format('samples[2]*100')} AS p1 FROM traces"


def filtered(spark, sf_dir):
    """Each trace detrended, tapered and band-passed from 2 to 12 Hz at 64 samples a second."""
    nth = lambda k: F.round(F.element_at("samples", k), 7).alias(f"s_{k}")
    return dsp.clean(X.traces(spark, sf_dir), 64.0, 2.0, 12.0).select("trace", nth(1), nth(20), nth(64))


def _difference_equation(items: str) -> str:
    """The outputs of the band-pass after a steady past, sample by sample: the list holds eight inputs, eight outputs, then the results."""
    b, a = dsp.butterworth(4, 2.0, 12.0, 64.0)
    y = " + ".join([f"{float(b[0])!r}::DOUBLE * e[1]", *(f"{float(b[k])!r}::DOUBLE * acc[{k}]" for k in range(1, 9)), *(f"{float(-a[k])!r}::DOUBLE * acc[{8 + k}]" for k in range(1, 9))])
    past = ", ".join([f"{items}[1]"] * 8 + ["0.0::DOUBLE"] * 8)
    return f"list_reduce(list_transform({items}, lambda v: [v]), lambda acc, e: [e[1]] || acc[1:7] || [{y}] || acc[9:15] || acc[17:] || [{y}], [{past}])[17:]"


FILTERED_SQL = f"""WITH {TRACES_SQL}, p AS (SELECT trace, unnest(samples) AS v, unnest(range(0, 64)) AS i FROM traces), f AS (SELECT trace, regr_slope(v, i) AS m, regr_intercept(v, i) AS c FROM p GROUP BY trace),
x AS (SELECT trace, list_transform(range(0, 64), lambda i: (samples[i + 1] - c - m * i) * CASE WHEN least(i, 63 - i) < 3 THEN 0.5 - 0.5 * cos(2 * pi() * least(i, 63 - i) / 5) ELSE 1.0 END) AS x FROM traces JOIN f USING (trace)),
w AS (SELECT trace, list_transform(range(27, 0, -1), lambda k: 2 * x[1] - x[k + 1]) || x || list_transform(range(1, 28), lambda k: 2 * x[64] - x[64 - k]) AS w FROM x),
a AS (SELECT trace, list_reverse({_difference_equation('w')}) AS w FROM w), z AS (SELECT trace, list_reverse({_difference_equation('w')})[28:91] AS z FROM a)
SELECT trace, round(z[1], 7) AS s_1, round(z[20], 7) AS s_20, round(z[64], 7) AS s_64 FROM z"""


def cleaned_diffs(spark, sf_dir):
    """RMS difference of consecutive windows of 16 samples of each trace, cleaned whole before it is cut."""
    rows = J.cleaned_diffs(X.traces(spark, sf_dir), 64.0, 0.25, ["trace"], 2.0, 12.0, n=4)
    return rows.select("trace", "w_idx", F.round("rms_diff", 7).alias("rms_diff"))


CLEANED_DIFFS_SQL = FILTERED_SQL[: FILTERED_SQL.rindex("SELECT trace, round(z[1]")] + """SELECT trace, CAST(i AS INT) AS w_idx, round(sqrt(list_sum(list_transform(range(1, 17), lambda k: (z[16 * i + k] - z[16 * i + k - 16]) * (z[16 * i + k] - z[16 * i + k - 16]))) / 16), 7) AS rms_diff FROM z, range(1, 4) t(i)"""


def spectrogram(spark, sf_dir):
    """Decibel spectrograms of the traces with 16-point frames: shape, peak, mean and floor; whole matrices in tests/test_numbers.py."""
    got = dsp.spectrograms(X.traces(spark, sf_dir), n_fft=16, hop=4)
    mean = F.aggregate("db", F.lit(0.0), lambda a, v: a + v) / F.size("db")
    return got.select("trace", "freq", "frames", F.round(F.array_max("db").cast("double"), 2).alias("peak"), F.round(mean, 2).alias("mean"), F.round(F.array_min("db").cast("double"), 2).alias("least"))


_DB = """c AS (SELECT id, f, j, sum(s[CASE WHEN q < 0 THEN -q WHEN q > 63 THEN 126 - q ELSE q END + 1] * w * cos(2 * pi() * j * k / 16)) AS re, sum(s[CASE WHEN q < 0 THEN -q WHEN q > 63 THEN 126 - q ELSE q END + 1] * w * sin(2 * pi() * j * k / 16)) AS im
 FROM (SELECT id, s, f, k, CAST(4 * f + k - 8 AS INT) AS q, 0.5 - 0.5 * cos(2 * pi() * k / 16) AS w FROM src, range(0, 17) a(f), range(0, 16) b(k)), range(0, 9) g(j) GROUP BY ALL),
d AS (SELECT id, f, j, 10 * log10(greatest(re * re + im * im, 1e-10)) AS db FROM c), e AS (SELECT id, f, j, greatest(db, max(db) OVER (PARTITION BY id) - 80) AS db FROM d)"""
SPECTROGRAM_SQL = f"WITH src AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS s FROM embeddings), {_DB} SELECT id AS trace, 9 AS freq, 17 AS frames, round(max(db), 2) AS peak, round(avg(db), 2) AS mean, round(min(db), 2) AS least FROM e GROUP BY id"


def spectral_profile(spark, sf_dir):
    """Lower median of each bin over all frames of a label's traces."""
    t = X.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("trace"), F.col("embedding").cast("array<double>").alias("samples"), "label")
    return dsp.profile(dsp.spectrograms(t, n_fft=16, hop=4), ["label"]).withColumn("median_db", F.round(F.col("median_db").cast("double"), 2))


SPECTRAL_PROFILE_SQL = f"WITH src AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS s FROM embeddings), {_DB} SELECT label, CAST(j AS INT) AS bin, round(quantile_disc(db, 0.5), 2) AS median_db FROM e JOIN embeddings ON id = vec_id GROUP BY ALL"


def lyapunov(spark, sf_dir):
    """Largest Lyapunov exponent of each trace by Rosenstein's method."""
    return dsp.lyapunov(X.traces(spark, sf_dir)).select("trace", F.round("lyapunov", 9).alias("lyapunov"))


_GAP = " + ".join(f"(a.s[a.i + {e}] - b.s[b.i + {e}]) * (a.s[a.i + {e}] - b.s[b.i + {e}])" for e in range(1, 5))
_APART = " + ".join(f"(s[i + l + {e}] - s[j + l + {e}]) * (s[i + l + {e}] - s[j + l + {e}])" for e in range(1, 5))
LYAPUNOV_SQL = f"""WITH {TRACES_SQL}, v AS (SELECT trace, samples AS s, CAST(i AS INT) AS i FROM traces, range(0, 61) r(i)),
g AS (SELECT a.trace, a.i, b.i AS j, row_number() OVER (PARTITION BY a.trace, a.i ORDER BY {_GAP}, b.i) AS k FROM v a JOIN v b ON a.trace = b.trace AND abs(a.i - b.i) > 3),
d AS (SELECT trace, l, {_APART} AS apart FROM g JOIN traces USING (trace), (SELECT CAST(l AS INT) AS l FROM range(0, 15) t(l)), (SELECT trace AS t2, samples AS s FROM traces) x WHERE k = 1 AND t2 = trace AND greatest(i, j) + l < 61),
y AS (SELECT trace, l, count(*) FILTER (apart > 0) AS n, avg(ln(apart)) FILTER (apart > 0) / 2 AS y FROM d GROUP BY ALL), o AS (SELECT *, min(CASE WHEN n < 3 THEN l ELSE 99 END) OVER (PARTITION BY trace) AS stop FROM y)
SELECT trace, CASE WHEN count(*) FILTER (l < stop) >= 3 THEN round(regr_slope(y, l) FILTER (l < stop), 9) END AS lyapunov FROM o GROUP BY trace"""


def corrected(spark, sf_dir):
    """Each trace as velocity and acceleration: a pole and a zero a label, whose gain doubles on day 100 of 2024; a day a trace."""
    t = X.table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("samples"), F.concat(F.lit("S"), "label").alias("station"), "label")
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    day = lambda d: F.timestamp_micros(F.unix_micros(start.cast("timestamp")) + d * 86_400_000_000).cast("timestamp_ntz")
    names = [F.lit("N").alias("network"), "station", F.lit("HHZ").alias("channel")]
    traces = t.select(*names, "vec_id", day(F.col("vec_id") % 200).alias("starttime"), F.lit(64.0).alias("sampling_rate"), "samples")
    pair = lambda re: F.array(F.struct(re.cast("double").alias("re"), F.lit(0.0).alias("im")))
    epoch = lambda k, a, b: F.struct(a.alias("epoch_start"), b.alias("epoch_end"), F.array(F.lit(10.0) * k, F.col("label") + 1.0).alias("stage_gains"))
    never = F.lit(None).cast("timestamp_ntz")
    epochs = t.select("station", "label").distinct().select(*names, "label", F.inline(F.array(epoch(1, never, day(F.lit(100))), epoch(2, day(F.lit(100)), never))))
    responses = epochs.withColumns({"input_unit": F.lit("M/S"), "sensitivity": F.lit(None).cast("double"), "poles": pair(-4.0 - F.col("label")), "zeros": pair(F.lit(0.0)), "a0": F.lit(1.0), "norm_hz": F.lit(None).cast("double")})
    got = groundmotion.without_response(traces, responses, corners=(0.5, 1.0, 20.0, 30.0))
    nth = lambda c, k: F.round(F.element_at(c, k) * 1000, 7)
    return got.select("vec_id", nth("vel", 20).alias("vel_20"), nth("vel", 50).alias("vel_50"), nth("acc", 20).alias("acc_20"), nth("acc", 64).alias("acc_64"))


_TAPER = "CASE WHEN f < 0.5 OR f > 30 THEN 0.0 WHEN f < 1 THEN 0.5 - 0.5 * cos(pi() * (f - 0.5) / 0.5) WHEN f <= 20 THEN 1.0 ELSE 0.5 + 0.5 * cos(pi() * (f - 20) / 10) END"
CORRECTED_SQL = f"""WITH t AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS s, CASE WHEN vec_id % 200 < 100 THEN 10.0 ELSE 20.0 END * (label + 1) AS g, 4.0::DOUBLE + label AS a FROM embeddings),
x AS (SELECT vec_id, k, (s[k + 1] - list_avg(s)) * CASE WHEN k IN (0, 63) THEN 0.0 WHEN k IN (1, 62) THEN 0.5 ELSE 1.0 END AS v FROM t, range(0, 64) r(k)),
d AS (SELECT vec_id, j, sum(v * cos(2 * pi() * j * k / 128)) AS re, -sum(v * sin(2 * pi() * j * k / 128)) AS im FROM x, range(0, 65) f(j) GROUP BY ALL),
h AS (SELECT vec_id, j, o, j / 2.0::DOUBLE AS f, pi() * j AS w, g, a FROM t, range(0, 65) f(j), (VALUES ('vel'), ('acc')) u(o)),
r AS (SELECT vec_id, j, o, f, CASE WHEN o = 'vel' THEN g * w * w / (w * w + a * a) WHEN j > 0 THEN g * a / (w * w + a * a) ELSE 0.0 END AS hr, CASE WHEN o = 'vel' THEN g * w * a / (w * w + a * a) WHEN j > 0 THEN -g * w / (w * w + a * a) ELSE 0.0 END AS hi FROM h),
l AS (SELECT *, sqrt(hr * hr + hi * hi) AS m, max(sqrt(hr * hr + hi * hi)) OVER (PARTITION BY vec_id, o) / 1000 AS low FROM r),
q AS (SELECT vec_id, o, j, {_TAPER} * (re * hr + im * hi) / (m * greatest(m, low)) AS re, {_TAPER} * (im * hr - re * hi) / (m * greatest(m, low)) AS im FROM l JOIN d USING (vec_id, j) WHERE m > 0),
y AS (SELECT vec_id, o, n, sum(CASE WHEN j IN (0, 64) THEN 1 ELSE 2 END * (re * cos(2 * pi() * j * (n - 1) / 128) - im * sin(2 * pi() * j * (n - 1) / 128))) / 128 * 1000 AS v FROM q, (VALUES (20), (50), (64)) e(n) GROUP BY ALL)
SELECT vec_id, round(max(v) FILTER (o = 'vel' AND n = 20), 7) AS vel_20, round(max(v) FILTER (o = 'vel' AND n = 50), 7) AS vel_50, round(max(v) FILTER (o = 'acc' AND n = 20), 7) AS acc_20, round(max(v) FILTER (o = 'acc' AND n = 64), 7) AS acc_64 FROM y GROUP BY vec_id"""


def _value_blocks(spark, sf_dir):
    """Each user's values in time as a long trace in blocks, 128 samples each; a row a value goes to its block."""
    rows = X.catalog(spark, sf_dir).where("user_id % 5 = 0").withColumn("user_id", F.floor(F.col("user_id") / 50).cast("long"))
    placed = with_total(running(rows, ["time", "event_id"], {"i": F.lit(1).cast("long")}, ["user_id"]), ["user_id"], {"n": F.count(F.lit(1))})
    held = placed.groupBy("user_id", "n", F.floor(F.col("i") / 128).alias("block")).agg(F.array_sort(F.collect_list(F.struct("i", "value"))).alias("x"))
    return held.select("user_id", "block", (F.col("block") * 128).alias("at"), "n", F.transform("x", lambda r: r["value"]).alias("samples"))


def block_onsets(spark, sf_dir):
    """First value of each group of users where the 5-value to 100-value energy ratio exceeds 3, and the largest ratio, over blocks."""
    return L.onset(_value_blocks(spark, sf_dir), ["user_id"], 5, 100, 3.0).withColumn("top_ratio", F.round("top_ratio", 7))


_SERIES = f"{CATALOG_SQL}, p AS (SELECT user_id // 50 AS user_id, value AS v, row_number() OVER (PARTITION BY user_id // 50 ORDER BY time, event_id) - 1 AS i FROM catalog WHERE user_id % 5 = 0)"
BLOCK_ONSETS_SQL = f"""WITH {_SERIES}, r AS (SELECT user_id, i, CASE WHEN i >= 99 THEN avg(v*v) OVER (PARTITION BY user_id ORDER BY i ROWS 4 PRECEDING) / avg(v*v) OVER (PARTITION BY user_id ORDER BY i ROWS 99 PRECEDING) ELSE 0.0 END AS ratio FROM p)
SELECT user_id, min(i) FILTER (ratio > 3.0) AS onset, round(max(ratio), 7) AS top_ratio FROM r GROUP BY user_id"""


def block_detrend(spark, sf_dir):
    """The energy of each group of users' values once their line is removed over blocks."""
    level = L.detrend(_value_blocks(spark, sf_dir), ["user_id"])
    return level.groupBy("user_id").agg(F.round(F.sqrt(F.sum(F.aggregate("samples", F.lit(0.0), lambda a, v: a + v * v)) / F.max("n")), 7).alias("rms"), F.max("n").alias("n"))


BLOCK_DETREND_SQL = f"""WITH {_SERIES}, f AS (SELECT user_id, regr_slope(v, i) AS m, regr_intercept(v, i) AS c FROM p GROUP BY user_id)
SELECT user_id, round(sqrt(avg((v - c - m*i) * (v - c - m*i))), 7) AS rms, count(*) AS n FROM p JOIN f USING (user_id) GROUP BY user_id"""


QUERIES = {n: (f, globals().get(f"{n.upper()}_SQL")) for n, f in list(globals().items()) if callable(f) and getattr(f, "__module__", "") == __name__ and not n.startswith("_")}
