"""Column expressions of the catalog and waveform operators."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance; null if any coordinate is null."""
    a1, a2 = F.radians(lat1), F.radians(lat2)
    half = F.pow(F.sin((a2 - a1) / 2), F.lit(2)) + F.cos(a1) * F.cos(a2) * F.pow(F.sin((F.radians(lon2) - F.radians(lon1)) / 2), F.lit(2))
    return 2 * EARTH_KM * F.asin(F.sqrt(clip(half, 0.0, 1.0)))


#: Kilometres of a degree of arc, fixed value.
DEGREE_KM = 111.195


def degrees(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in degrees of arc; null if any coordinate is null."""
    return F.degrees(haversine_km(lat1, lon1, lat2, lon2) / EARTH_KM)


def hours_to_event(start: Column, w_idx: Column, step: int, fs: float, origin: Column) -> Column:
    """Hours from a window's first sample to the event; the record starts at start, windows every step samples."""
    seconds = (F.unix_micros(origin.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / F.lit(1_000_000.0)
    return (seconds - w_idx * F.lit(step) / F.lit(float(fs))) / 3600.0


def clip(x: Column, low: float, high: float) -> Column:
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(low)), F.lit(high)))


def log10_positive(x: Column) -> Column:
    """Null unless x is above 0."""
    return F.when(x > 0, F.log10(x))


def b_value(n: Column, mean: Column, least: Column) -> Column:
    """Aki's estimate with the least magnitude as completeness; null for fewer than 10 events or no spread."""
    return F.when((n >= 10) & (mean - least > 1e-6), math.log10(math.e) / (mean - least))


def energy(magnitude: Column) -> Column:
    """Radiated energy in joules."""
    return F.pow(F.lit(10.0), 1.5 * magnitude + 4.8)


def days_between(first: Column, last: Column) -> Column:
    """Days as a fraction, from microseconds."""
    return (F.unix_micros(last.cast("timestamp")) - F.unix_micros(first.cast("timestamp"))) / F.lit(86_400_000_000.0)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once a row; inside a lambda it would be computed for each element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def array_mean(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, v: a + v) / F.size(x)


def array_sigma(x: Column, mean: Column) -> Column:
    """Population standard deviation."""
    return F.sqrt(F.aggregate(x, F.lit(0.0), lambda a, v: a + (v - mean) * (v - mean)) / F.size(x))


def unbiased_sigma(x: Column, mean: Column) -> Column:
    """Sample standard deviation; null for fewer than two values."""
    return F.when(F.size(x) > 1, F.sqrt(F.aggregate(x, F.lit(0.0), lambda a, v: a + (v - mean) * (v - mean)) / (F.size(x) - 1)))


def z_scores(x: Column) -> Column:
    """(x - mean) / (sample sigma + 1e-6) of an array."""
    return let(array_mean(x), lambda mean: let(F.coalesce(unbiased_sigma(x, mean), F.lit(0.0)) + 1e-6, lambda s: F.transform(x, lambda v: (v - mean) / s)))


def standardize(x: Column) -> Column:
    """(x - mean) / max(sigma, 1e-12) of an array, with the population sigma."""
    return let(array_mean(x), lambda mean: let(F.greatest(array_sigma(x, mean), F.lit(1e-12)), lambda sigma: F.transform(x, lambda v: (v - mean) / sigma)))


def uint8(x: Column) -> Column:
    """Angles within pi as 0 to 255, halves to the even number."""
    return F.rint((clip(x, -math.pi, math.pi) + math.pi) / (2 * math.pi) * 255).cast("int")


def boundary_name(days: float) -> str:
    """A class boundary: days below a year, else years, with a decimal unless within .05 of a whole one."""
    if days < 365:
        return f"{days:.0f}d"
    years = days / 365.25
    return f"{years:.0f}y" if abs(years - round(years)) < 0.05 else f"{years:.1f}y"


def vector_magnitude(z: Column, n: Column, e: Column) -> Column:
    """Length of the motion vector at each sample of three equally long arrays."""
    return F.transform(F.arrays_zip(z.alias("z"), n.alias("n"), e.alias("e")), lambda s: F.sqrt(s["z"] * s["z"] + s["n"] * s["n"] + s["e"] * s["e"]))


def peak(x: Column, start: Column, stop: Column) -> Column:
    """Largest absolute value in [start, stop) of an array; null if that range is empty."""
    low = F.greatest(start, F.lit(0))
    high = F.least(stop, F.size(x))
    return F.when(high > low, F.array_max(F.transform(F.slice(x, low + 1, F.greatest(high - low, F.lit(0))), F.abs)))


def event_id(stem: Column) -> Column:
    """The id in event_<id>_raw or noise_event_<id>_raw; null for other names."""
    found = F.regexp_extract(stem, r"^(?:noise_)?event_(.+?)_raw$", 1)
    return F.when(found != "", found)


def gain_mismatch(gains: Column, reported: Column) -> Column:
    """|product of the gains - reported| / |reported|; null if a gain is null or the reported one is 0."""
    product = F.aggregate(gains, F.lit(1.0), lambda a, g: a * g)
    return F.when((reported != 0) & product.isNotNull(), F.abs(product - reported) / F.abs(reported))
