"""Response removal, ground-motion labels of three-component records, response quality and picks.

The instrument response enters as a table with a row a channel epoch: network, station,
channel, epoch_start, epoch_end (null: open), input_unit (M, M/S or M/S**2), sensitivity, stage_gains
(array), poles and zeros (arrays of re, im in radians a second) and a0, or norm_hz where the normalised poles and zeros are 1.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quakeframe.functions.columns import gain_mismatch, log10_positive, peak, vector_magnitude
from quakeframe.operators.dsp import by_length

INPUT_SECONDS, BEFORE_ARRIVAL, LABEL_SECONDS = 3.0, 0.2, 25.0
#: Full scale of a 24-bit digitizer and the share of it that counts as clipped; fixed values.
FULL_SCALE, CLIPPED_SHARE = float(2**23), 0.99


#: Derivatives of displacement that a unit stands for.
UNITS = {"M": 0, "M/S": 1, "M/S**2": 2}
OUTPUTS = {"disp": 0, "vel": 1, "acc": 2}
RESPONSE = ("input_unit", "sensitivity", "stage_gains", "poles", "zeros", "a0", "norm_hz")


def transfer(hertz: np.ndarray, response: dict, output: str) -> np.ndarray:
    """Counts for one unit of output (disp, vel or acc in metres and seconds) at each frequency; 0 where it is undefined."""
    point = lambda f: np.prod([f - complex(*z) for z in response["zeros"]], axis=0) / np.prod([f - complex(*p) for p in response["poles"]], axis=0)
    s = 2j * np.pi * hertz
    a0 = response["a0"]
    if a0 is None:
        a0 = 1 / abs(point(np.array([2j * np.pi * response["norm_hz"]]))[0]) if response["norm_hz"] else 1.0
    with np.errstate(divide="ignore", invalid="ignore"):
        h = response["gain"] * a0 * point(s) * s ** (UNITS[response["unit"]] - OUTPUTS[output])
    return np.where(np.isfinite(h), h, 0.0)


def band_taper(hertz: np.ndarray, corners: tuple[float, float, float, float]) -> np.ndarray:
    """1 between the inner corners, cosine flanks to 0 at the outer ones."""
    a, b, c, d = corners
    rise, fall = (np.clip(v, 0.0, 1.0) for v in ((hertz - a) / (b - a), (d - hertz) / (d - c)))
    return (0.5 - 0.5 * np.cos(np.pi * rise)) * (0.5 - 0.5 * np.cos(np.pi * fall))


def time_taper(n: int, share: float) -> np.ndarray:
    """Cosine flanks over half the share at each end."""
    flank = min(int(n * share / 2 + 0.5), n // 2)
    ramp = 0.5 - 0.5 * np.cos(np.pi * np.arange(flank) / max(flank, 1))
    return np.concatenate([ramp, np.ones(n - 2 * flank), ramp[::-1]])


def divided(x: np.ndarray, fs: float, response: dict, outputs: tuple[str, ...], corners: tuple[float, float, float, float] | None, water_level: float, taper: float) -> list[np.ndarray]:
    """Rows of counts as ground motion: mean off, tapered, spectra divided by the response.

    Spectra have at least twice the samples, so nothing wraps around. Responses weaker than water_level decibels below the
    strongest are raised to that level, with their phase; those that are 0 stay out.
    """
    n = x.shape[1]
    length = 1 << (2 * n - 1).bit_length()
    hertz = np.fft.rfftfreq(length, 1 / fs)
    spectrum = np.fft.rfft((x - x.mean(axis=1, keepdims=True)) * time_taper(n, taper), length, axis=1)
    if corners:
        spectrum = spectrum * band_taper(hertz, corners)
    out = []
    for output in outputs:
        h = transfer(hertz, response, output)
        size = np.abs(h)
        floor = size.max() * 10 ** (-water_level / 20)
        raised = np.where(size > 0, h * np.maximum(size, floor) / np.where(size > 0, size, 1.0), 1.0)
        out.append(np.fft.irfft(np.where(size > 0, spectrum / raised, 0.0), length, axis=1)[:, :n])
    return out


def in_force(traces: DataFrame, responses: DataFrame) -> DataFrame:
    """Adds response: the struct of the channel epoch that holds the trace's starttime, the one begun last of several; null if none does.

    A channel's epochs, a row each time an instrument is changed, meet in one array, so no trace is multiplied.
    """
    by = ["network", "station", "channel"]
    epochs = responses.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("epoch_start", "epoch_end", *RESPONSE))).alias("__epochs"))
    held = lambda e: (e["epoch_start"].isNull() | (e["epoch_start"] <= F.col("starttime"))) & (e["epoch_end"].isNull() | (F.col("starttime") < e["epoch_end"]))
    joined = traces.join(epochs, by, "left").withColumn("__held", F.filter("__epochs", held))
    return joined.withColumn("response", F.try_element_at("__held", F.lit(-1))).drop("__epochs", "__held")


def without_response(traces: DataFrame, responses: DataFrame, outputs: tuple[str, ...] = ("vel", "acc"), corners: tuple[float, float, float, float] | None = (0.05, 0.1, 40.0, 45.0), water_level: float = 60.0, taper: float = 0.05) -> DataFrame:
    """Adds response_ok, sens_mismatch and, named as in outputs, the samples as ground motion (disp, vel, acc; metres and seconds).

    traces: network, station, channel, starttime, sampling_rate, samples (counts). The whole gain is the product of the stage
    gains, or the sensitivity where a stage's is unknown. A trace without an epoch in force, or whose epoch has no gain or an
    unknown unit, isn't ok and has null outputs, like one with null samples.
    """
    if unknown := set(outputs) - set(OUTPUTS):
        raise ValueError(f"outputs are of {sorted(OUTPUTS)}, not {sorted(unknown)}")
    rows = in_force(traces, responses)
    r = F.col("response")
    stages = F.when((F.size(r["stage_gains"]) > 0) & ~F.exists(r["stage_gains"], lambda g: g.isNull()), F.aggregate(r["stage_gains"], F.lit(1.0), lambda a, g: a * g))
    gain = F.coalesce(stages, r["sensitivity"])
    ok = F.coalesce((gain != 0) & r["input_unit"].isin(*UNITS) & (F.col("sampling_rate") > 0), F.lit(False))
    own = F.struct(gain.alias("gain"), r["input_unit"].alias("unit"), *(F.coalesce(r[k], F.array().cast("array<struct<re:double,im:double>>")).alias(k) for k in ("poles", "zeros")), r["a0"].alias("a0"), r["norm_hz"].alias("norm_hz"), F.col("sampling_rate").alias("fs"))
    rows = rows.withColumns({"response_ok": ok, "sens_mismatch": gain_mismatch(r["stage_gains"], r["sensitivity"]), "__own": F.when(ok, own)}).drop("response")

    def kernel(x: np.ndarray, held: pa.Array) -> tuple:
        groups: dict[str, tuple[dict, list[int]]] = {}
        for k, h in enumerate(held.to_pylist()):
            if h is not None:
                groups.setdefault(repr(h), (h, []))[1].append(k)
        made = [np.full(x.shape, np.nan) for _ in outputs]
        for h, at in groups.values():
            h |= {k: [(p["re"], p["im"]) for p in h[k]] for k in ("poles", "zeros")}
            for out, got in zip(made, divided(x[at], h["fs"], h, outputs, corners, water_level, taper), strict=True):
                out[at] = got
        return tuple(made)

    made = by_length(rows, "samples", kernel, [T.StructField(o, T.ArrayType(T.DoubleType())) for o in outputs], [pa.list_(pa.float64())] * len(outputs), "__own").drop("__own")
    return made.withColumns({o: F.when(F.col("response_ok"), F.col(o)) for o in outputs})


def response_quality(responses: DataFrame, by: list[str]) -> DataFrame:
    """sens_mismatch: the largest over a station's channel epochs; epochs with a null gain don't count."""
    return responses.groupBy(*by).agg(F.max(gain_mismatch(F.col("stage_gains"), F.col("sensitivity"))).alias("sens_mismatch"))


def pick(onsets: DataFrame, by: list[str]) -> DataFrame:
    """The arrival of the first trace that triggers (vertical first, then by name), and the largest ratio of those tried."""
    w = Window.partitionBy(*by).orderBy(F.col("component") != "Z", "channel")
    ranked = onsets.withColumn("__k", F.row_number().over(w))
    first = ranked.groupBy(*by).agg(F.min(F.when(F.col("onset").isNotNull(), F.col("__k"))).alias("__first"), F.min_by("onset", F.when(F.col("onset").isNotNull(), F.col("__k"))).alias("arrival"))
    tried = ranked.join(first, by).where(F.col("__first").isNull() | (F.col("__k") <= F.col("__first")))
    return tried.groupBy(*by).agg(F.first("arrival").alias("arrival"), F.max("top_ratio").alias("best_ratio"))


def window_bounds(arrival: Column, n: Column, fs: Column) -> tuple[Column, Column, Column]:
    """First input sample (null if the input doesn't fit), the sample after it, and the label's end."""
    size = F.rint(INPUT_SECONDS * fs).cast("int")
    start = (arrival - BEFORE_ARRIVAL * size).cast("int")
    clamped = F.least(start, n - size)
    first = F.when((start >= 0) & (clamped >= 0), clamped)
    return first, first + size, first + size + F.rint(LABEL_SECONDS * fs).cast("int")


def ground_motion(records: DataFrame) -> DataFrame:
    """Adds peaks over the label window, the whole record and the input, and flags.

    records: raw_z/n/e (counts), vel_z/n/e, acc_z/n/e (SI units), mask (fraction),
    fs, arrival (sample). Records without room for the input window go.
    """
    n = F.size("vel_z")
    first, end, stop = window_bounds(F.col("arrival"), n, F.col("fs"))
    rows = records.withColumns({"__in": first, "__end": end, "__stop": stop, "__n": n}).where(F.col("__in").isNotNull())
    rows = rows.withColumns({f"__{k}": vector_magnitude(F.col(f"{k}_z"), F.col(f"{k}_n"), F.col(f"{k}_e")) for k in ("vel", "acc")})
    counts = F.greatest(*(F.array_max(F.transform(f"raw_{c}", F.abs)) for c in "zne"))
    at = F.array_position("__vel", F.array_max("__vel")) - 1
    whole = lambda c: peak(F.col(c), F.lit(0), F.col("__n"))
    label = lambda c: peak(F.col(c), F.col("__end"), F.col("__stop"))
    own = lambda c: peak(F.col(c), F.col("__in"), F.col("__end"))
    out = rows.withColumns(
        {
            "pgv_cms_fwd": label("__vel") * 100,
            "pga_gal_fwd": label("__acc") * 100,
            "pgv_cms_full": whole("__vel") * 100,
            "pga_gal_full": whole("__acc") * 100,
            "log_peak_input_vel": log10_positive(own("__vel") * 100),
            "log_peak_input_acc": log10_positive(own("__acc") * 100),
            "peak_counts": counts,
            "clipped": counts >= FULL_SCALE * CLIPPED_SHARE,
            "label_seconds": F.greatest(F.lit(0), F.least("__stop", "__n") - F.col("__end")) / F.col("fs"),
            "label_truncated": F.col("__stop") > F.col("__n"),
            "peak_rel_arrival_s": (at - F.col("arrival")) / F.col("fs"),
            "peak_in_input": (at >= F.col("__in")) & (at < F.col("__end")),
            "pick_at_floor": F.col("arrival") == (10 * F.col("fs")).cast("int") - 1,
        }
    )
    return out.drop("__in", "__end", "__stop", "__n", "__vel", "__acc")


def travel_time(df: DataFrame, table: DataFrame, distance: str, depth: str, phases: tuple[str, ...] = ("p", "P", "Pg", "Pn")) -> DataFrame:
    """Adds predicted_p_s: the earliest of the phases in the table's cell (degrees to 3 decimals, whole km); null for a miss."""
    cell = lambda d, z: (F.bround(d, 3).alias("__d"), F.bround(z, 0).alias("__z"))
    best = table.where(F.col("phase").isin(*phases)).groupBy(*cell(F.col("distance_deg"), F.col("depth_km"))).agg(F.min("seconds").alias("predicted_p_s"))
    keyed = df.withColumn("__d", F.bround(distance, 3)).withColumn("__z", F.bround(depth, 0))
    return keyed.join(best, ["__d", "__z"], "left").drop("__d", "__z")
