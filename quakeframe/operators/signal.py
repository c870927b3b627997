"""Window and onset operators over sample arrays, as array expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakeframe.functions.columns import array_mean, array_sigma, let, standardize
from quakeframe.operators.sequence import running
from quakeframe.operators.split import with_total
from quakeframe.session import materialize


def window_shape(fs: float, seconds: float, overlap: float) -> tuple[int, int, int]:
    """Samples of a window, of a step, and of the tolerated shortfall, truncated as doubles are."""
    size = int(fs * seconds)
    step = int(size * (1 - overlap))
    if step < 1:
        raise ValueError("overlap leaves no step")
    return size, step, int(0.05 * size)


def sliding_windows(traces: DataFrame, fs: float, seconds: float, overlap: float, samples: str = "samples", mask: str | None = None, most_gaps: float = 0.05) -> DataFrame:
    """One row a window (w_idx, window) of each trace, the last one padded with zeros if it is short by 5 % at most.

    With mask (array of boolean), windows of which more than most_gaps is masked
    are left out. The original index is kept.
    """
    size, step, tolerance = window_shape(fs, seconds, overlap)
    n = F.size(samples)
    last = F.greatest(F.ceil((n - size) / step), F.lit(0)).cast("int")
    long_enough = n >= size - tolerance
    rows = traces.where(long_enough).withColumn("w_idx", F.explode(F.sequence(F.lit(0), last)))
    part = F.slice(samples, F.col("w_idx") * step + 1, size)
    rows = rows.withColumn("__part", part).where(F.size("__part") >= size - tolerance)
    if mask:
        own = F.slice(mask, F.col("w_idx") * step + 1, size)
        gaps = F.size(F.filter(own, lambda x: x)) / F.lit(float(size))
        rows = rows.where(gaps <= most_gaps).drop(mask)
    padded = F.concat("__part", F.array_repeat(F.lit(0.0), F.lit(size) - F.size("__part")))
    return rows.withColumn("window", padded).drop("__part", samples)


def long_windows(rows: DataFrame, by: list[str], order: list[str], value: str, size: int, step: int, tolerance: int = 0, mask: str | None = None, most_gaps: float = 0.05) -> DataFrame:
    """The windows of sliding_windows (by, w_idx, window) over series with a row a sample, of which one may hold most rows.

    Samples are numbered by ranges and go to the windows that hold them; only windows are gathered.
    """
    placed = with_total(running(rows, order, {"__i": F.lit(1).cast("long")}, by), by, {"__n": F.count(F.lit(1))})
    first = F.greatest(F.lit(0), F.ceil((F.col("__i") - size + 1) / step))
    last = F.least(F.floor(F.col("__i") / step), F.greatest(F.ceil((F.col("__n") - size) / step), F.lit(0)))
    inside = placed.where((F.col("__n") >= size - tolerance) & (first <= last))
    spread = inside.withColumn("w_idx", F.explode(F.sequence(first.cast("int"), last.cast("int"))))
    gap = F.coalesce(F.col(mask), F.lit(False)) if mask else F.lit(False)
    held = spread.groupBy(*by, "w_idx").agg(F.sort_array(F.collect_list(F.struct("__i", F.col(value).alias("v")))).alias("__x"), F.sum(gap.cast("int")).alias("__gaps"))  # size rows at most
    held = held.where((F.size("__x") >= size - tolerance) & (F.col("__gaps") / F.lit(float(size)) <= most_gaps))
    values = F.transform("__x", lambda r: r["v"])
    return held.select(*by, "w_idx", F.concat(values, F.array_repeat(F.lit(0.0), F.lit(size) - F.size("__x"))).alias("window"))


def window_count(n: Column, fs: float, seconds: float, overlap: float) -> Column:
    """Windows of a trace of n samples, from its header alone."""
    size, step, tolerance = window_shape(fs, seconds, overlap)
    return F.when(n >= size - tolerance, F.floor((n - size + tolerance) / step) + 1).otherwise(0)


def relative_angles(x: Column, n: int) -> Column:
    """n angles: each segment of the standardized, zero-padded samples against the mean segment direction."""
    size = F.size(x)
    d = F.greatest(F.lit(2), F.ceil(size / n)).cast("int")
    index = F.sequence(F.lit(0), F.lit(n - 1))
    floor = F.lit(1e-12)

    def dot(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda acc, t: acc + t)

    def angles(segments: Column, mean: Column) -> Column:
        cosine = lambda s, norm: dot(s, mean) / (F.greatest(F.sqrt(dot(s, s)), floor) * norm)
        return let(F.greatest(F.sqrt(dot(mean, mean)), floor), lambda norm: F.transform(segments, lambda s: F.acos(F.least(F.greatest(cosine(s, norm), F.lit(-1.0)), F.lit(1.0)))))

    def mean_of(segments: Column) -> Column:
        total = F.aggregate(segments, F.array_repeat(F.lit(0.0), d), lambda acc, s: F.zip_with(acc, s, lambda a, b: a + b))
        return F.transform(total, lambda v: v / n)

    padded = F.concat(standardize(x), F.array_repeat(F.lit(0.0), d * n - size))
    cut = lambda z: F.transform(index, lambda i: F.slice(z, i * d + 1, d))
    return let(padded, lambda z: let(cut(z), lambda segments: let(mean_of(segments), lambda mean: angles(segments, mean))))


def angle_image(beta: Column) -> Column:
    """R[i][j] = beta[j] - beta[i]."""
    return F.transform(beta, lambda a: F.transform(beta, lambda b: b - a))


def onset(x: Column, short: int, long: int, on: float) -> Column:
    """(first sample where the short-term to long-term mean-square ratio exceeds on, largest ratio); the ratio is 0 before the long window is full."""
    start = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("l"), F.lit(0).alias("i"), F.lit(None).cast("int").alias("first"), F.lit(0.0).alias("top"))

    def over(square: Column) -> Column:
        def step(acc: Column, v: Column) -> Column:
            i = acc["i"]
            s = acc["s"] + v - F.when(i >= short, F.element_at(square, i - short + 1)).otherwise(0.0)
            t = acc["l"] + v - F.when(i >= long, F.element_at(square, i - long + 1)).otherwise(0.0)
            ratio = F.when((i >= long - 1) & (t > 0), (s / short) / (t / long)).otherwise(0.0)
            first = F.coalesce(acc["first"], F.when(ratio > on, i))
            return F.struct(s.alias("s"), t.alias("l"), (i + 1).alias("i"), first.alias("first"), F.greatest(acc["top"], ratio).alias("top"))

        return F.aggregate(square, start, step, lambda acc: F.struct(acc["first"].alias("onset"), acc["top"].alias("top_ratio")))

    return let(F.transform(x, lambda v: v * v), over)


def onset_parameters(seconds: float) -> tuple[float, float]:
    """Short and long window lengths for a window of so many seconds."""
    long = min(10.0, seconds / 3)
    return max(0.05, long / 10), long


def detrend(x: Column) -> Column:
    """The array less its least-squares line."""
    n = F.size(x).cast("double")
    middle = (n - 1) / 2.0
    below = n * (n * n - 1) / 12.0

    def line(mean: Column) -> Column:
        top = F.aggregate(F.transform(x, lambda v, i: (i - middle) * (v - mean)), F.lit(0.0), lambda a, v: a + v)
        return let(F.when(below > 0, top / below).otherwise(0.0), lambda slope: F.transform(x, lambda v, i: v - mean - slope * (i - middle)))

    return let(array_mean(x), line)


def _with_previous(windows: DataFrame, by: list[str], value: str, idx: str) -> DataFrame:
    """windows that have one just before them, with its value as __v; joined by (by, idx), so a long trace stays spread over tasks."""
    before = windows.select(*by, (F.col(idx) + 1).cast(windows.schema[idx].dataType).alias(idx), F.col(value).alias("__v"))
    return windows.join(before, [*by, idx])


def consecutive_diff(windows: DataFrame, by: list[str], value: str = "window", idx: str = "w_idx") -> DataFrame:
    """Root-mean-square difference of each window and the one just before it; a missing index breaks the chain."""
    rows = _with_previous(windows.select(*by, idx, value), by, value, idx)
    square = F.aggregate(F.zip_with(value, "__v", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, v: a + v)
    return rows.select(*by, idx, F.sqrt(square / F.size(value)).alias("rms_diff"))


def image_diff(windows: DataFrame, by: list[str], n: int = 64, value: str = "window", idx: str = "w_idx") -> DataFrame:
    """Mean absolute difference of the relative-angle images of each window and the one just before it; a missing index breaks the chain.

    Windows are angles only when they meet; these are worked out once and written.
    """
    angles = materialize(windows.select(*by, idx, relative_angles(F.col(value), n).alias("__a")), "angles")
    rows = _with_previous(angles, by, "__a", idx)
    rows = rows.withColumn("__d", F.zip_with("__a", "__v", lambda a, b: a - b))  # of images, the differences of differences
    total = F.aggregate(F.transform("__d", lambda p: F.aggregate("__d", F.lit(0.0), lambda acc, q: acc + F.abs(q - p))), F.lit(0.0), lambda acc, v: acc + v)
    return rows.select(*by, idx, (total / F.lit(float(n * n))).alias("image_diff"))


def log_snr(x: Column, sigma: Column) -> Column:
    """ln of the window's population sigma over the baseline's; null without a baseline."""
    own = let(array_mean(x), lambda mean: array_sigma(x, mean))
    return F.when(sigma > 0, F.log(F.greatest(own, F.lit(1e-12)) / sigma))


def stft_shape(fs: float, seconds: float, n_fft: int, hop: int | None = None) -> tuple[int, int]:
    """Frequency bins and frames of a centred spectrogram."""
    n = int(round(fs * seconds))
    return n_fft // 2 + 1, n // (hop or n_fft // 4) + 1


#: Share of a window that one frame may span before a shape is doubtful and before it is bad, the fewest useful frames, and the shortest suggested frame; fixed values.
FRAME_SHARES, LEAST_FRAMES, SHORTEST_FRAME = (0.25, 0.50), 8, 32


def suggested_stft(fs: float, seconds: float) -> tuple[int, int]:
    """n_fft and hop: the largest power of two within a quarter of the window, and a quarter of that."""
    n_fft = SHORTEST_FRAME
    while 2 * n_fft <= int(round(fs * seconds)) * FRAME_SHARES[0]:
        n_fft *= 2
    return n_fft, n_fft // 4


def stft_problem(fs: float, seconds: float, n_fft: int, hop: int | None = None) -> tuple[str, int, int] | None:
    """How badly a spectrogram's shape fits the window (severe or warn), with n_fft and hop that fit better; None if it is fine or
    nothing fits better."""
    share, (_, frames), better = n_fft / max(1, round(fs * seconds)), stft_shape(fs, seconds, n_fft, hop), suggested_stft(fs, seconds)
    fine = share <= FRAME_SHARES[0] and frames >= LEAST_FRAMES
    return None if fine or n_fft <= better[0] else ("severe" if share > FRAME_SHARES[1] else "warn", *better)


def clipped(x: Column, bits: int = 24) -> Column:
    """Whether a sample reaches 99 % of the digitizer's range."""
    return F.array_max(F.transform(x, F.abs)) >= math.pow(2, bits - 1) * 0.99
