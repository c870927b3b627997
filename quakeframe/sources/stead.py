"""Labelled three-component traces with a map of attributes: limits and the order of components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attribute(value: Column) -> Column:
    """A number from an attribute's text: the first of a bracketed list; null if blank or no number."""
    text = F.trim(F.regexp_replace(value.cast("string"), r"[\[\]]", " "))
    return F.split(text, r"[\s,]+").getItem(0).try_cast("double")


def matching(traces: DataFrame, least_magnitude: float | None = None, most_km: float | None = None, least_snr: float | None = None, magnitude: str = "magnitude", distance: str = "distance", snr: str = "snr") -> DataFrame:
    """Traces within the limits that are given; a trace without the attribute of a limit goes."""
    kept = traces
    for name, limit, above in ((magnitude, least_magnitude, True), (distance, most_km, False), (snr, least_snr, True)):
        if limit is not None:
            value = attribute(F.col(name))
            kept = kept.where(value >= limit if above else value <= limit)
    return kept


def components(traces: DataFrame, samples: str = "samples") -> DataFrame:
    """Adds z, n and e from samples, an array of rows (east, north, vertical) or of the three whole components; other shapes go."""
    rows = traces.where(F.size(samples) >= 3)
    whole = (F.size(samples) == 3) & (F.size(F.element_at(samples, 1)) != 3)
    rows = rows.where(whole | (F.forall(samples, lambda r: F.size(r) == 3)))
    at = lambda k: F.when(whole, F.element_at(samples, k + 1)).otherwise(F.transform(samples, lambda r: F.element_at(r, k + 1)))
    return rows.withColumns({c: at(k) for c, k in (("z", 2), ("n", 1), ("e", 0))}).drop(samples)
