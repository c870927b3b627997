"""Noise baselines: mean and deviation by key from sums, and values against them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def baselines(df: DataFrame, by: list[str], value: str, least: int) -> DataFrame:
    """by, n, mu and the population sigma of value, from sums that are combined before the shuffle; only keys with at least so many
    values and some spread."""
    sums = df.groupBy(*by).agg(F.sum(value).alias("__x"), F.sum(F.col(value) * F.col(value)).alias("__xx"), F.count(value).alias("n"))
    return _finished(sums, by, least)


def _finished(sums: DataFrame, by: list[str], least: int) -> DataFrame:
    mu = F.col("__x") / F.col("n")
    sigma = F.sqrt(F.greatest(F.col("__xx") / F.col("n") - mu * mu, F.lit(0.0)))
    return sums.withColumn("mu", mu).withColumn("sigma", sigma).where((F.col("n") >= least) & (F.col("sigma") >= 1e-12)).select(*by, "n", "mu", "sigma")


def sample_baselines(records: DataFrame, by: list[str], fs: float, least_seconds: float = 60.0, samples: str = "samples", mask: str | None = None) -> DataFrame:
    """The baselines of all samples of a key's records, those that mask marks left out."""
    kept = F.col(samples) if mask is None else F.transform(F.filter(F.arrays_zip(F.col(samples).alias("x"), F.col(mask).alias("m")), lambda r: ~r["m"]), lambda r: r["x"])
    own = records.select(*by, kept.alias("__s"))
    total = lambda f: F.aggregate("__s", F.lit(0.0), lambda a, v: a + f(v))
    sums = own.groupBy(*by).agg(F.sum(total(lambda v: v)).alias("__x"), F.sum(total(lambda v: v * v)).alias("__xx"), F.sum(F.size("__s")).alias("n"))
    return _finished(sums, by, int(least_seconds * fs))


def against(df: DataFrame, base: DataFrame, on: list[str], value: Column, mean: Column, sigma: Column) -> DataFrame:
    """Adds z, the value against its key's baseline (mu, sigma), or against its own mean and sigma where the key has none."""
    joined = df.join(base.select(*on, F.col("mu").alias("__mu"), F.col("sigma").alias("__sigma")), on, "left")
    z = (value - F.coalesce("__mu", mean)) / F.greatest(F.coalesce("__sigma", sigma), F.lit(1e-12))
    return joined.withColumn("z", z).drop("__mu", "__sigma")


def by_component(base: DataFrame, station: str = "station_key", component: str = "component") -> DataFrame:
    """One row a station with mu_z, sigma_z, ... of the components z, n and e; null where there is none."""
    wide = base.groupBy(station).pivot(component, ["z", "n", "e"]).agg(F.first("mu").alias("mu"), F.first("sigma").alias("sigma"))
    return wide.select(station, *(F.col(f"{c}_{k}").alias(f"{k}_{c}") for k in ("mu", "sigma") for c in "zne"))
