"""Three-component windows: component roles, encoders and anchored slices.

Encoders add columns (img, seq, aux) instead of writing one file a window; sinks
decide about formats.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quakeframe.functions.columns import array_mean, array_sigma, clip, let, z_scores
from quakeframe.operators.dsp import by_length, decibels
from quakeframe.operators.signal import angle_image, relative_angles

#: Component letters by role (vertical, north, east), first choice first; fixed values.
ROLES = (("Z",), ("N", "1"), ("E", "2"))


def role_components(letters: Column) -> Column:
    """The array of the three chosen letters, null if a role has none."""
    chosen = [F.coalesce(*(F.when(F.array_contains(letters, c), F.lit(c)) for c in role)) for role in ROLES]
    return F.when(chosen[0].isNotNull() & chosen[1].isNotNull() & chosen[2].isNotNull(), F.array(*chosen))


def stations(traces: DataFrame, by: list[str], also: tuple[str, ...] = ()) -> DataFrame:
    """One row a station record with z, n, e samples and fs, where all roles are there at one sampling rate; the longest trace of a component wins.

    Of traces with gap_mask (array of boolean), also mask_z, mask_n and mask_e. Columns named in also come for each component, as name_z and so on.
    """
    masked = "gap_mask" in traces.columns
    held = F.struct("samples", "sampling_rate", *(["gap_mask"] if masked else []), *also)
    longest = traces.groupBy(*by, "component").agg(F.max_by(held, F.struct(F.size("samples"), "sampling_rate")).alias("t"))
    grouped = longest.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("component", "t"))).alias("m"))
    chosen = grouped.withColumn("c", role_components(F.map_keys("m"))).where(F.col("c").isNotNull())
    got = chosen.select(*by, *(F.element_at("m", F.col("c")[k]).alias(name) for k, name in enumerate("zne")))
    same = (F.col("z.sampling_rate") == F.col("n.sampling_rate")) & (F.col("n.sampling_rate") == F.col("e.sampling_rate"))
    masks = [F.col(f"{c}.gap_mask").alias(f"mask_{c}") for c in "zne"] if masked else []
    more = [F.col(c)[a].alias(f"{a}_{c}") for a in also for c in "zne"]
    return got.where(same).select(*by, F.col("z.sampling_rate").alias("fs"), *(F.col(f"{c}.samples").alias(c) for c in "zne"), *masks, *more)


def _sigma(x: Column) -> Column:
    return let(array_mean(x), lambda m: array_sigma(x, m))


def aux_scalars(windows: DataFrame, per_component: bool = False, missing: float | None = 0.0) -> DataFrame:
    """Adds aux: log signal-to-noise and log amplitude, averaged over the components or one each.

    sigma_z, sigma_n, sigma_e are the baselines; a component without one, or
    without amplitude, is left out of the mean or gets missing.
    """
    own = windows.withColumns({f"__s{c}": _sigma(F.col(c)) for c in "zne"})
    snr = [F.when((F.col(f"sigma_{c}") > 0) & (F.col(f"__s{c}") > 0), F.log(F.col(f"__s{c}") / F.col(f"sigma_{c}"))) for c in "zne"]
    rms = [F.when(F.col(f"__s{c}") > 0, F.log(F.col(f"__s{c}"))) for c in "zne"]
    fill = F.lit(missing).cast("double")
    mean = lambda cols: F.coalesce(let(F.array_compact(F.array(*cols)), lambda a: F.when(F.size(a) > 0, array_mean(a))), fill)
    values = [F.coalesce(c, fill) for c in snr + rms] if per_component else [mean(snr), mean(rms)]
    return own.withColumn("aux", F.array(*values)).drop(*(f"__s{c}" for c in "zne"))


def angle_images(windows: DataFrame, n: int = 64) -> DataFrame:
    """Adds img: three n by n images with values from 0 to 1."""
    image = lambda c: F.transform(angle_image(relative_angles(F.col(c), n)), lambda row: F.transform(row, lambda v: ((clip(v, -math.pi, math.pi) + math.pi) / (2 * math.pi)).cast("float")))
    return windows.withColumn("img", F.array(*(image(c) for c in "zne")))


def sequences(windows: DataFrame) -> DataFrame:
    """Adds seq: three standardized arrays, by the baseline (mu_*, sigma_*) where there is one."""

    def one(c: str) -> Column:
        x = F.col(c)
        mu = F.coalesce(F.col(f"mu_{c}"), array_mean(x))
        sigma = F.greatest(F.coalesce(F.col(f"sigma_{c}"), _sigma(x)), F.lit(1e-12))
        return let(F.struct(mu.alias("m"), sigma.alias("s")), lambda p: F.transform(x, lambda v: ((v - p["m"]) / p["s"]).cast("float")))

    return windows.withColumn("seq", F.array(*(one(c) for c in "zne")))


def with_profiles(windows: DataFrame, profiles: DataFrame) -> DataFrame:
    """Adds profile: the spectral baselines of z, n and e, one after the other; null unless the station has all three.

    profiles: station_key, component (z, n or e), profile.
    """
    own = profiles.groupBy("station_key").pivot("component", ["z", "n", "e"]).agg(F.first("profile"))
    own = own.where(F.col("z").isNotNull() & F.col("n").isNotNull() & F.col("e").isNotNull())
    return windows.join(own.select("station_key", F.concat("z", "n", "e").alias("profile")), "station_key", "left")


NORMALIZED = ("station", "per_window", "none")


def spectrogram_images(windows: DataFrame, n_fft: int = 256, hop: int | None = None, top_db: float = 80.0, normalize: str = "station", strict: bool = False) -> DataFrame:
    """Adds img (array of float: component by component, bin by bin), freq and frames: decibels of z, n and e that stop top_db
    below the peak of the three.

    station: above the station's profile (column profile; without one, or where it is null, z-scores of the window, or with
    strict the window goes). per_window: z-scores over all three, with the sample deviation. none: decibels.
    """
    if normalize not in NORMALIZED:
        raise ValueError(f"normalize is one of {NORMALIZED}")
    step = hop or n_fft // 4

    def kernel(x: np.ndarray) -> tuple:
        size = x.shape[1] // 3
        if size <= n_fft // 2:
            return None, None, None
        db = decibels(x.reshape(-1, size), n_fft, step, np.inf)
        freq, frames = db.shape[1:]
        own = db.reshape(len(x), -1)
        return np.maximum(own, own.max(axis=1, keepdims=True) - top_db), np.full(len(x), freq), np.full(len(x), frames)

    fields = [T.StructField("__db", T.ArrayType(T.DoubleType())), T.StructField("freq", T.IntegerType()), T.StructField("frames", T.IntegerType())]
    rows = windows if "profile" in windows.columns else windows.withColumn("profile", F.lit(None).cast("array<double>"))
    made = by_length(rows.withColumn("__zne", F.concat("z", "n", "e")), "__zne", kernel, fields, [pa.list_(pa.float64()), pa.int32(), pa.int32()]).drop("__zne")
    if normalize == "station":
        fits = F.coalesce(F.size("profile") == 3 * F.col("freq"), F.lit(False))
        above = F.transform("__db", lambda v, i: v - F.element_at("profile", F.floor(i / F.col("frames")).cast("int") + 1))
        made = made.where(fits) if strict else made
        value = F.when(fits, above).otherwise(z_scores(F.col("__db")))
    else:
        value = z_scores(F.col("__db")) if normalize == "per_window" else F.col("__db")
    return made.withColumn("img", value.cast("array<float>")).drop("__db", "profile")


def amplitude_score(z: Column, n: Column, e: Column, sigma_z: Column, sigma_n: Column, sigma_e: Column) -> Column:
    """The loudest component in units of its baseline's sigma, or in counts without one."""
    return F.greatest(*(_sigma(x) / F.when(s > 0, s).otherwise(1.0) for x, s in ((z, sigma_z), (n, sigma_n), (e, sigma_e))))


def anchored(x: Column, arrival: Column, size: int, before: float, clamp: bool = True) -> Column:
    """size samples that begin before * size ahead of the arrival; null if that is before the record.

    An overrun is clamped to the record's end and the start cut to a whole sample; without clamp, as for arrivals from a
    catalog, an overrun is null and the start rounded, halves to even.
    """
    start = (arrival - before * size).cast("int") if clamp else F.rint(arrival - before * size).cast("int")
    end = F.size(x) - size
    at = F.when(start <= end, start).otherwise(end if clamp else F.lit(None))
    return F.when((start >= 0) & (at >= 0), F.slice(x, at + 1, size))


def random_window(x: Column, size: int, *keys: str, seed: int = 42) -> Column:
    """size samples from a start that the keys fix; null for a shorter array."""
    return F.when(F.size(x) >= size, F.slice(x, F.pmod(F.xxhash64(F.lit(seed), *keys), F.size(x) - size + 1).cast("int") + 1, size))


def resample(df: DataFrame, column: str, fs_from: float, fs_to: float, size: int) -> DataFrame:
    """The column at fs_to, by a polyphase Kaiser-windowed low-pass, cut or padded to size samples."""
    up, down = int(round(fs_to)), int(round(fs_from))
    g = math.gcd(up, down)
    up, down = up // g, down // g

    def kernel(x: np.ndarray) -> tuple:
        if up != down:
            half = 10 * max(up, down)
            t = np.arange(-half, half + 1)
            taps = np.sinc(t / max(up, down)) / max(up, down) * np.kaiser(2 * half + 1, 5.0)
            taps *= up / taps.sum()
            wide = np.zeros((len(x), x.shape[1] * up))
            wide[:, ::up] = x
            n = -(-x.shape[1] * up // down)
            x = np.array([np.convolve(r, taps)[half : half + len(r)][::down] for r in wide])[:, :n]
        out = np.zeros((len(x), size))
        out[:, : min(size, x.shape[1])] = x[:, :size]
        return (out,)

    return by_length(df, column, kernel, [T.StructField(column, T.ArrayType(T.DoubleType()))], [pa.list_(pa.float64())])
