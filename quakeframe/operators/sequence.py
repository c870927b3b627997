"""Numbering, as-of lookups and fixed-count windows over event sequences.

A sequence (one region) may hold most of all events, so none of these sorts a
whole sequence in one task: events are bucketed by time, and what crosses buckets
is carried over a table with one row a bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quakeframe.functions.columns import b_value, days_between, energy, haversine_km, let
from quakeframe.session import materialize

DAY = 86_400


def micros(time: str | Column) -> Column:
    return F.unix_micros((F.col(time) if isinstance(time, str) else time).cast("timestamp"))


def bucket(time: str | Column, seconds: int = DAY) -> Column:
    return F.floor(micros(time) / F.lit(seconds * 1_000_000)).cast("long")


def numbered(events: DataFrame, by: str = "region", time: str = "time", tie: str = "event_id", seconds: int = DAY) -> DataFrame:
    """Adds idx, the 0-based place in its sequence by (time, tie)."""
    marked = events.withColumn("__b", bucket(time, seconds))
    before = marked.groupBy(by, "__b").agg(F.count(F.lit(1)).alias("__n"))
    before = before.withColumn("__before", F.expr(f"coalesce(sum(__n) over (partition by `{by}` order by __b rows between unbounded preceding and 1 preceding), 0)")).drop("__n")
    placed = marked.withColumn("__k", F.expr(f"row_number() over (partition by `{by}`, __b order by `{time}`, `{tie}`)"))
    return placed.join(before, [by, "__b"]).withColumn("idx", (F.col("__before") + F.col("__k") - 1).cast("long")).drop("__b", "__k", "__before")


def running(df: DataFrame, order: list[str | Column], sums: dict[str, Column], by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Adds, by name, the sum of a column over the rows before in order, within by.

    Rows are dealt by ranges of (by, order), so one group may fill many tasks; what
    earlier ranges of a group hold is carried over a table with a row for each group
    and range. The ranges are written, because sampling them anew may cut otherwise.
    """
    ways = [F.col(c) if isinstance(c, str) else c for c in (*by, *order)]
    own = df.withColumns({f"__v_{n}": v for n, v in sums.items()})
    placed = materialize(own.repartitionByRange(*ways).withColumn("__p", F.spark_partition_id()), "ranges")
    before = lambda *on: Window.partitionBy(*on).rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy(*by, "__p").agg(*(F.sum(f"__v_{n}").alias(f"__v_{n}") for n in sums))
    carried = parts.select(*(F.col(c).alias(f"__by_{c}") for c in by), F.col("__p").alias("__q"), *(F.coalesce(F.sum(f"__v_{n}").over(before(*by).orderBy("__p")), F.lit(0)).alias(f"__c_{n}") for n in sums))
    same = F.col("__p") == F.col("__q")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__by_{c}"))
    joined = placed.join(carried, same).drop("__q", *(f"__by_{c}" for c in by))
    totals = {n: F.coalesce(F.sum(f"__v_{n}").over(before(*by, "__p").orderBy(*ways[len(by) :])), F.lit(0)) + F.col(f"__c_{n}") for n in sums}
    return joined.withColumns(totals).drop("__p", *(f"__{k}_{n}" for n in sums for k in "vc"))


def neighbours(left: DataFrame, right: DataFrame, by: str, left_time: str, right_time: str, before: str | None = None, after: str | None = None, extra: tuple[str, ...] = (), seconds: int = DAY) -> DataFrame:
    """Adds before, the struct (right_time, *extra) of the last right row strictly before left_time, and after, that of the first
    strictly after it; null if none. Of right rows at the same time, before takes the largest struct and after the smallest.

    Both sides are sorted together by bucket, once for both directions; the last and first right rows of other buckets are
    carried over a table with one row a bucket. left is read twice and is to be cheap or a written table.
    """
    kept = [c for c in left.columns if c not in (before, after)]
    r = right.select(F.col(by).alias("__by"), bucket(right_time, seconds).alias("__b"), micros(right_time).alias("__t"), F.lit(1).alias("__kind"), F.struct(right_time, *extra).alias("__r"))
    own = left.select(F.col(by).alias("__by"), bucket(left_time, seconds).alias("__b"), micros(left_time).alias("__t"), F.lit(0).alias("__kind"), F.struct(*kept).alias("__l"))
    both = own.unionByName(r, allowMissingColumns=True)
    ends = both.groupBy("__by", "__b").agg(F.min("__r").alias("__low"), F.max("__r").alias("__high"))
    there = Window.partitionBy("__by").orderBy("__b")
    carried = ends.select("__by", "__b", F.last("__high", True).over(there.rowsBetween(Window.unboundedPreceding, -1)).alias("__past"), F.first("__low", True).over(there.rowsBetween(1, Window.unboundedFollowing)).alias("__next"))
    here = Window.partitionBy("__by", "__b")
    up = here.orderBy("__t", "__kind", "__r").rowsBetween(Window.unboundedPreceding, -1)
    down = here.orderBy(F.desc("__t"), "__kind", F.desc("__r")).rowsBetween(Window.unboundedPreceding, -1)
    wanted = [(n, F.last("__r", True).over(w), far) for n, w, far in ((before, up, "__past"), (after, down, "__next")) if n]
    near = both.select("__by", "__b", "__kind", "__l", *(c.alias(f"__near_{n}") for n, c, _ in wanted)).where("__kind = 0")
    joined = near.join(carried, near["__by"].eqNullSafe(carried["__by"]) & near["__b"].eqNullSafe(carried["__b"]), "left")
    return joined.select("__l.*", *(F.coalesce(f"__near_{n}", far).alias(n) for n, _, far in wanted))


def asof(left: DataFrame, right: DataFrame, by: str, left_time: str, right_time: str, name: str, forward: bool, extra: tuple[str, ...] = (), seconds: int = DAY) -> DataFrame:
    """Adds name: the struct (right_time, *extra) of the first right row strictly after left_time, or of the last strictly before it; null if none."""
    return neighbours(left, right, by, left_time, right_time, None if forward else name, name if forward else None, extra, seconds)


def event_windows(events: DataFrame, size: int = 64, stride: int = 8, by: str = "region") -> DataFrame:
    """One row a window of size events, begun every stride events, with its features.

    events: by, time, magnitude, event_id. A sequence of fewer than 2 * size
    events has no windows. Every event goes to its size / stride windows, whose
    sums are combined before the shuffle.
    """
    placed = numbered(events, by)
    total = events.groupBy(by).agg(F.count(F.lit(1)).alias("__total")).where(F.col("__total") >= 2 * size)
    last = F.floor(F.col("idx") / stride)
    first = F.greatest(F.lit(0), F.ceil((F.col("idx") - size + 1) / stride))
    recent = max(size // 4, 2)
    spread = (
        placed.join(total, by)
        .withColumn("__w", F.explode(F.sequence(first.cast("long"), last.cast("long"))))
        .withColumn("start_idx", F.col("__w") * stride)
        .where(F.col("start_idx") + size <= F.col("__total"))
        .withColumn("__recent", F.col("idx") >= F.col("start_idx") + size - recent)
        .withColumn("__e", energy(F.col("magnitude")))
    )
    m = F.col("magnitude")
    grouped = spread.groupBy(by, "start_idx").agg(
        F.min("time").alias("start_time"),
        F.max("time").alias("end_time"),
        F.min(F.when(F.col("__recent"), F.col("time"))).alias("__recent_time"),
        F.avg(m).alias("mean_mag"),
        F.max(m).alias("max_mag"),
        F.min(m).alias("__min"),
        F.stddev_pop(m).alias("mag_std"),
        F.sum("__e").alias("__total_energy"),
        F.sum(F.when(F.col("__recent"), F.col("__e"))).alias("__recent_energy"),
    )
    length = F.greatest(days_between(F.col("start_time"), F.col("end_time")), F.lit(1e-3))
    short = F.greatest(days_between(F.col("__recent_time"), F.col("end_time")), F.lit(1e-3))
    whole = F.greatest(F.col("__total_energy"), F.lit(1e-12))
    rate, recent_rate = F.log10(F.lit(float(size)) / length), F.log10(F.lit(float(recent)) / short)
    return grouped.select(
        by,
        "start_idx",
        "start_time",
        "end_time",
        F.log10(length).alias("log_duration_days"),
        rate.alias("log_rate"),
        recent_rate.alias("log_rate_recent"),
        (recent_rate - rate).alias("rate_accel"),
        "mean_mag",
        "max_mag",
        "mag_std",
        F.log10(whole).alias("log_total_energy"),
        F.log10(F.greatest(F.col("__recent_energy"), F.lit(1e-12)) / whole).alias("log_energy_recent_frac"),
        b_value(F.lit(size), F.col("mean_mag"), F.col("__min")).alias("b_value"),
    )


def window_series(events: DataFrame, size: int = 64, stride: int = 8, by: str = "region") -> DataFrame:
    """One row a window with its series, each an array of size values in order of time.

    magnitude; log_dt (days since the event before, at least 1e-4, the first one
    the median of the others); depth (10 where null); log_energy; cum_energy_frac;
    dist_km from the mean of the known coordinates (0 where unknown).
    """
    placed = numbered(events, by)
    total = events.groupBy(by).agg(F.count(F.lit(1)).alias("__total")).where(F.col("__total") >= 2 * size)
    first = F.greatest(F.lit(0), F.ceil((F.col("idx") - size + 1) / stride))
    spread = placed.join(total, by).withColumn("__w", F.explode(F.sequence(first.cast("long"), F.floor(F.col("idx") / stride).cast("long"))))
    spread = spread.withColumn("start_idx", F.col("__w") * stride).where(F.col("start_idx") + size <= F.col("__total"))
    rows = spread.groupBy(by, "start_idx").agg(
        F.sort_array(F.collect_list(F.struct("idx", "time", "magnitude", "depth", "lat", "lon"))).alias("x"),
        F.avg(F.when(F.col("lat").isNotNull() & F.col("lon").isNotNull(), F.col("lat"))).alias("__clat"),
        F.avg(F.when(F.col("lat").isNotNull() & F.col("lon").isNotNull(), F.col("lon"))).alias("__clon"),
    )  # size events a window
    each = lambda f: F.transform("x", f)
    gap = F.transform(F.sequence(F.lit(2), F.lit(size)), lambda k: days_between(F.element_at("x", k - 1)["time"], F.element_at("x", k)["time"]))
    rows = rows.withColumn("__gap", gap).withColumn("__e", each(lambda r: energy(r["magnitude"])))
    middle = let(F.array_sort("__gap"), lambda g: (F.element_at(g, (size - 1 + 1) // 2) + F.element_at(g, (size - 1) // 2 + 1)) / 2)
    steps = F.aggregate("__e", F.struct(F.lit(0.0).alias("s"), F.expr("cast(array() as array<double>)").alias("out")), lambda a, v: F.struct((a["s"] + v).alias("s"), F.array_append(a["out"], a["s"] + v).alias("out")))
    whole = let(steps, lambda a: F.transform(a["out"], lambda v: v / F.greatest(a["s"], F.lit(1e-12))))
    return rows.select(
        by,
        "start_idx",
        each(lambda r: r["magnitude"]).alias("magnitude"),
        F.transform(F.concat(F.array(middle), "__gap"), lambda d: F.log10(F.greatest(d, F.lit(1e-4)))).alias("log_dt"),
        each(lambda r: F.coalesce(r["depth"], F.lit(10.0))).alias("depth"),
        F.transform("__e", F.log10).alias("log_energy"),
        whole.alias("cum_energy_frac"),
        each(lambda r: F.coalesce(haversine_km(r["lat"], r["lon"], F.col("__clat"), F.col("__clon")), F.lit(0.0))).alias("dist_km"),
    )


def dense_windows(events: DataFrame, size: int = 64, stride: int = 8, threshold: float = 4.5, horizon_days: float = 30.0, by: str = "region") -> DataFrame:
    """Windows with days_since_prev_major, label (a major event within the horizon after the window) and next_magnitude.

    Windows whose horizon runs past the sequence's last event are left out.
    """
    horizon = F.make_dt_interval(days=F.lit(0), hours=F.lit(0), mins=F.lit(0), secs=F.lit(horizon_days * DAY).cast("decimal(18,6)"))
    ends = events.groupBy(by).agg(F.max("time").alias("__catalog_end"))
    windows = event_windows(events, size, stride, by).join(ends, by).where(F.col("end_time") + horizon <= F.col("__catalog_end")).drop("__catalog_end")
    windows = materialize(windows, "windows")
    major = events.where(F.col("magnitude") >= threshold)
    known = neighbours(windows, major, by, "end_time", "time", "__prev", "__next", ("magnitude",))
    within = F.coalesce(F.col("__next.time") <= F.col("end_time") + horizon, F.lit(False))
    return known.select(
        *windows.columns,
        days_between(F.col("__prev.time"), F.col("end_time")).alias("days_since_prev_major"),
        within.cast("int").alias("label"),
        F.when(within, F.col("__next.magnitude")).alias("next_magnitude"),
    )


def tercile_windows(events: DataFrame, targets: DataFrame, size: int = 64, stride: int = 8, major: float = 6.0, max_horizon_days: float = 3650.0, by: str = "region") -> DataFrame:
    """Windows without a major event, with target_time and days_to_major of the next of targets (by, time)."""
    windows = materialize(event_windows(events, size, stride, by).where(F.col("max_mag") < major), "windows")
    known = asof(windows, targets, by, "end_time", "time", "__next", True)
    days = days_between(F.col("end_time"), F.col("__next.time"))
    return known.select(*windows.columns, F.col("__next.time").alias("target_time"), days.alias("days_to_major")).where(F.col("days_to_major") <= max_horizon_days)


def horizon_blocks(windows: DataFrame, events: DataFrame, threshold: float, horizon_days: float, by: str = "region") -> DataFrame:
    """Consecutive blocks of one horizon from the first window's end on, each with the last window that ends
    strictly before it (place fc_index, end fc_time), and the major events that fall in it."""
    step = int(round(horizon_days * DAY * 1_000_000))
    windows = materialize(windows.select(by, "end_time", "start_idx"), "windows")
    ends = events.groupBy(by).agg(F.max("time").alias("__catalog_end"))
    span = windows.groupBy(by).agg(F.min("end_time").alias("__first"), F.max("end_time").alias("__last")).join(ends, by)
    stop = F.least(micros("__last"), micros("__catalog_end"))
    count = F.floor((stop - micros("__first")) / step)
    blocks = span.where(count > 0).withColumn("__k", F.explode(F.sequence(F.lit(0), (count - 1).cast("int"))))
    at = lambda k: F.timestamp_micros(micros("__first") + k * F.lit(step)).cast("timestamp_ntz")
    blocks = blocks.select(by, at(F.col("__k")).alias("block_start"), at(F.col("__k") + 1).alias("block_end"))
    blocks = materialize(blocks, "blocks")
    placed = numbered(windows, by, "end_time", "start_idx").select(by, "end_time", "idx")
    known = asof(blocks, placed, by, "block_start", "end_time", "__w", False, ("idx",)).where(F.col("__w").isNotNull())
    major = events.where(F.col("magnitude") >= threshold).select(F.col(by).alias("__by"), F.col("time").alias("__t"))
    keyed = major.join(span.select(F.col(by).alias("__by"), micros("__first").alias("__f")), "__by")
    hits = keyed.groupBy("__by", F.floor((micros("__t") - F.col("__f")) / step).alias("__k")).agg(F.count(F.lit(1)).alias("n_major"))
    first = span.select(F.col(by).alias("__by"), micros("__first").alias("__f"))
    joined = known.join(first, known[by] == first["__by"]).drop("__by").withColumn("__k", F.floor((micros("block_start") - F.col("__f")) / step))
    joined = joined.join(hits, (joined[by] == hits["__by"]) & (joined["__k"] == hits["__k"]), "left")
    n = F.coalesce("n_major", F.lit(0)).cast("long")
    return joined.select(by, "block_start", "block_end", F.col("__w.idx").alias("fc_index"), F.col("__w.end_time").alias("fc_time"), (n > 0).cast("int").alias("label"), n.alias("n_major"))


SEQUENCE_SCHEMA = T.StructType([T.StructField("region", T.StringType()), T.StructField("time", T.TimestampNTZType()), T.StructField("magnitude", T.DoubleType()), T.StructField("event_id", T.LongType())])
