"""What a dataset's maker looks at before and after: reports as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakeframe.functions.columns import days_between
from quakeframe.operators.evaluate import quantiles, two_predictor_fit
from quakeframe.operators.sequence import numbered
from quakeframe.operators.split import leaks

#: Relative difference of sensitivities that is still trusted, and the fewest target events a split needs; fixed values.
TRUSTED_MISMATCH, LEAST_TARGETS = 0.05, 4


def major_events(events: DataFrame, threshold: float, by: str = "region") -> DataFrame:
    """The events that are targets, by time, with whole days since the one before in their region."""
    major = numbered(events.where(F.col("magnitude") >= threshold), by)
    before = major.select(F.col(by).alias("__by"), (F.col("idx") + 1).alias("__idx"), F.col("time").alias("__time"))
    joined = major.join(before, (F.col(by) == F.col("__by")) & (F.col("idx") == F.col("__idx")), "left")
    return joined.withColumn("gap_days", F.floor(days_between(F.col("__time"), F.col("time")))).drop("__by", "__idx", "__time")


def target_counts(majors: DataFrame, max_horizon_days: float = 3650.0, by: str = "region") -> DataFrame:
    """n targets of each region, the median, least and most gap, whether they are too few, and whether a gap is beyond the horizon."""
    own = majors.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.min("gap_days").alias("min_gap"), F.max("gap_days").alias("max_gap"))
    middle = quantiles(majors, "gap_days", [0.5], (by,)).select(by, F.element_at("edges", 1).alias("median_gap"))
    return own.join(middle, by, "left").withColumns({"too_few": F.col("n") < LEAST_TARGETS, "beyond_horizon": F.coalesce(F.col("max_gap") > max_horizon_days, F.lit(False))})


def picks(traces: DataFrame, picked: DataFrame, by: list[str]) -> DataFrame:
    """One row: station records seen, with fewer than three traces, picked, without a pick, and the median of the best ratios of these."""
    seen = traces.groupBy(*by).agg(F.count(F.lit(1)).alias("__n")).agg(F.count(F.lit(1)).alias("seen"), F.count(F.when(F.col("__n") < 3, 1)).alias("too_few_traces"))
    got = picked.agg(F.count("arrival").alias("picked"), F.count(F.when(F.col("arrival").isNull(), 1)).alias("no_pick"))
    middle = quantiles(picked.where(F.col("arrival").isNull()), "best_ratio", [0.5]).agg(F.max(F.element_at("edges", 1)).alias("median_failed_ratio"))
    return seen.crossJoin(F.broadcast(got)).crossJoin(F.broadcast(middle))  # a row each


def retention(before: DataFrame, dropped: DataFrame, reason: str = "reason") -> DataFrame:
    """Rows dropped by reason, and their share of all rows before."""
    total = before.agg(F.count(F.lit(1)).alias("__all"))  # one row
    counts = dropped.groupBy(reason).agg(F.count(F.lit(1)).alias("n"))
    return counts.crossJoin(F.broadcast(total)).withColumn("share", F.col("n") / F.col("__all")).drop("__all")


def split_sizes(manifest: DataFrame) -> DataFrame:
    """Rows, events, stations and magnitudes of each split."""
    return manifest.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("n_events"), F.count_distinct("station_key").alias("n_stations"), F.min("magnitude").alias("least_magnitude"), F.max("magnitude").alias("most_magnitude"))


def ground_motion_flags(manifest: DataFrame) -> DataFrame:
    """One row: n, how many rows have each flag, how many an untrusted sensitivity, how many are clean, and events in several splits."""
    flags = ("response_ok", "clipped", "peak_in_input", "pick_at_floor", "label_truncated")
    bad = F.coalesce(F.col("sens_mismatch") > TRUSTED_MISMATCH, F.lit(False))
    clean = F.col("response_ok") & F.coalesce(F.col("sens_mismatch") <= TRUSTED_MISMATCH, F.lit(False))
    shared = leaks(manifest, "event_id").agg(F.count(F.lit(1)).alias("shared_events"))  # one row
    own = manifest.agg(F.count(F.lit(1)).alias("n"), *(F.count(F.when(F.col(c), 1)).alias(c) for c in flags), F.count(F.when(bad, 1)).alias("untrusted"), F.count(F.when(clean, 1)).alias("clean"))
    return own.crossJoin(F.broadcast(shared))


def clean_rows(manifest: DataFrame) -> DataFrame:
    return manifest.where(F.col("response_ok") & (F.col("sens_mismatch") <= TRUSTED_MISMATCH))


def target_spread(manifest: DataFrame, columns: tuple[str, ...] = ("pgv_cms_fwd", "pga_gal_fwd", "pgv_cms_full", "pga_gal_full")) -> DataFrame:
    """The median, first and last percentile and the most of each target over the clean rows."""
    long = clean_rows(manifest).select(F.explode(F.array(*(F.struct(F.lit(c).alias("target"), F.col(c).alias("value")) for c in columns))).alias("x")).select("x.*")
    q = quantiles(long, "value", [0.01, 0.5, 0.99, 1.0], ("target",))
    return q.select("target", "n", *(F.element_at("edges", k + 1).alias(name) for k, name in enumerate(("p01", "median", "p99", "most"))))


def attenuation(manifest: DataFrame, target: str = "log_pgv_full") -> DataFrame:
    """The fit of a log peak by magnitude and log distance over the clean rows."""
    rows = clean_rows(manifest).where(F.col("distance_km") > 0).select(F.col(target).alias("y"), F.col("magnitude").alias("m"), F.log10("distance_km").alias("d"))
    return two_predictor_fit(rows, "y", "m", "d")


def odd_images(files: DataFrame, group: str = "class_name") -> DataFrame:
    """Images that are empty, unreadable (no width) or not of their group's most frequent size (the smallest of equally frequent ones), with the reason.

    files: group, path, bytes, width, height.
    """
    sizes = files.where(F.col("width").isNotNull()).groupBy(group, "width", "height").agg(F.count(F.lit(1)).alias("__n"))
    usual = sizes.groupBy(group).agg(F.max_by(F.struct("width", "height"), F.struct("__n", -F.col("width"), -F.col("height"))).alias("__usual"))
    reason = F.when(F.col("bytes") == 0, "empty").when(F.col("width").isNull(), "unreadable").when(F.struct("width", "height") != F.col("__usual"), "size")
    return files.join(usual, group, "left").withColumn("reason", reason).where(F.col("reason").isNotNull()).drop("__usual")
