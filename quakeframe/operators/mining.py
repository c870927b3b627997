"""Negative mining: loud bands, amplitude matching and contamination vetoes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quakeframe.operators.evaluate import quantiles
from quakeframe.operators.sequence import micros, running
from quakeframe.operators.split import evenly_spaced, hashed_order, ranked
from quakeframe.session import materialize


def band_pick(df: DataFrame, by: list[str], score: str, keys: list[str], quota: int | Column, band: tuple[float, float] = (0.75, 0.99)) -> DataFrame:
    """quota evenly spaced rows of each group's band of ranks by score; a narrow band grows downwards, then upwards.

    The bounds of a group's band are worked out once, on a table with a row a group (and quota).
    """
    own = df.withColumn("__want", (F.lit(quota) if isinstance(quota, int) else quota).cast("long"))
    placed = ranked(own, by, [score, *keys], "__k")
    sizes = own.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"), F.max("__want").alias("__quota")).withColumnsRenamed({c: f"__by_{c}" for c in by})
    step = lambda t, **c: t.withColumns(c)
    edge = lambda q: F.rint(F.lit(q) * F.col("__n")).cast("long")
    bounds = step(sizes, __want=F.least("__quota", "__n"), __low=F.least(edge(band[0]), F.col("__n") - 1))
    bounds = step(bounds, __high=F.greatest(F.least(edge(band[1]), F.col("__n")), F.col("__low") + 1))
    bounds = step(bounds, __lo=F.when(F.col("__high") - F.col("__low") < F.col("__want"), F.greatest(F.lit(0), F.col("__high") - F.col("__want"))).otherwise(F.col("__low")))
    bounds = step(bounds, __hi=F.when(F.col("__high") - F.col("__lo") < F.col("__want"), F.least(F.col("__n"), F.col("__lo") + F.col("__want"))).otherwise(F.col("__high")))
    bounds = materialize(bounds.select(*(f"__by_{c}" for c in by), "__lo", "__hi", "__quota"), "bounds")
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__by_{c}"))
    inside = placed.drop("__want").join(bounds, same).where((F.col("__k") >= F.col("__lo")) & (F.col("__k") < F.col("__hi")))
    return inside.where(evenly_spaced(F.col("__k") - F.col("__lo"), F.col("__hi") - F.col("__lo"), F.col("__quota"))).select(*by, *keys)


#: The band that stands in for a match with too few bins: all but the loudest percent.
UNMATCHED_BAND = (0.0, 0.99)


def matched_pick(pool: DataFrame, target: DataFrame, score: str, keys: list[str], quota: int | Column, bins: int = 40, by: tuple[str, ...] = ()) -> DataFrame:
    """quota rows of pool (for each by), with bin, whose scores follow the quantile bins of target.

    Scores of the pool below the first edge, or at or above the last, are in no bin and serve
    only to fill a shortfall, nearest to the median first; the largest target score counts in the last bin. A group without target
    rows gives none. Where all target scores are one, there is no bin: evenly spaced rows of
    UNMATCHED_BAND of the pool's ranks, with a null bin.
    """
    edges = quantiles(target, score, [*(k / bins for k in range(bins + 1)), 0.5], by)
    edges = edges.select(*by, F.array_distinct(F.slice("edges", 1, bins + 1)).alias("__e"), F.element_at("edges", bins + 2).alias("__m"))  # a row for each by
    edges = materialize(edges, "edges")
    flat = edges.where(F.size("__e") < 2).select(*by)
    edges = edges.where(F.size("__e") >= 2)
    at = F.size(F.filter("__e", lambda e: e <= F.col(score)))
    inside = (at >= 1) & (at < F.size("__e"))
    met = lambda df: df.join(edges, list(by)) if by else df.crossJoin(F.broadcast(edges))
    binned = lambda df, b: met(df).withColumn("bin", b).drop("__e")
    wanted = F.lit(quota) if isinstance(quota, int) else quota
    demand = binned(target.where(F.col(score).isNotNull()), F.least(at, F.size("__e") - 1) - 1).groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("__t"))
    total = demand.groupBy(*by).agg(F.sum("__t").alias("__all")) if by else demand.agg(F.sum("__t").alias("__all"))
    demand = demand.join(total, list(by)) if by else demand.crossJoin(F.broadcast(total))
    ours = binned(pool, F.when(inside, at - 1)).join(demand, [*by, "bin"], "left").withColumn("__demand", F.greatest(F.lit(1), F.rint(F.col("__t") / F.col("__all") * wanted)))
    ours = ours.withColumn("__h", hashed_order(*keys))
    placed = running(ours, ["__h", *keys], {"__k": F.lit(1)}, [*by, "bin"])
    chosen = F.col("bin").isNotNull() & (F.col("__k") < F.coalesce("__demand", F.lit(0)))
    marked = placed.withColumn("__in", F.when(chosen, 0).otherwise(1)).withColumn("__far", F.when(chosen, F.lit(0.0)).otherwise(F.abs(F.col(score) - F.col("__m"))))
    first = running(marked, ["__in", "__far", "__h", *keys], {"__place": F.lit(1)}, by)
    matched = first.where(F.col("__place") < wanted).drop("__demand", "__t", "__all", "__in", "__far", "__m", "__h", "__k", "__place")
    if flat.isEmpty():
        return matched
    rest = pool.join(flat, list(by), "left_semi") if by else pool
    picked = band_pick(rest, list(by), score, keys, quota, UNMATCHED_BAND)
    return matched.unionByName(rest.join(picked, [*by, *keys], "left_semi"), allowMissingColumns=True)


def veto(noise: DataFrame, events: DataFrame, start: str, seconds: int, buffer: int, time: str = "time") -> DataFrame:
    """noise windows of so many seconds without any event from buffer before to buffer after, ends included.

    A window is hit if the first event at or after its early end is no later than its late one. Both kinds are sorted
    together by bucket; of a bucket's events only the next ones are looked at, and the first event of later buckets is carried over
    a table with a row a bucket, so a swarm of events in one span meets no window twice. A null start or time is never met.
    """
    low, high = micros(start) - buffer * 1_000_000, micros(start) + (seconds + buffer) * 1_000_000
    spans = noise.select(F.struct(*noise.columns).alias("__row"), low.alias("__t"), high.alias("__hi"), F.lit(1).alias("__kind"))
    times = events.select(micros(time).alias("__t")).where("__t is not null").distinct().withColumn("__kind", F.lit(0))
    width = (seconds + 2 * buffer) * 1_000_000
    both = spans.unionByName(times, allowMissingColumns=True).withColumn("__b", F.floor(F.col("__t") / width))
    firsts = times.groupBy(F.floor(F.col("__t") / width).alias("__b")).agg(F.min("__t").alias("__first"))
    # a span reaches into the next bucket at most, as a bucket is as long as a span
    later = firsts.select((F.col("__b") - 1).alias("__b"), F.col("__first").alias("__later"))
    ahead = Window.partitionBy("__b").orderBy(F.desc("__t"), "__kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = both.withColumn("__next", F.min(F.when(F.col("__kind") == 0, F.col("__t"))).over(ahead)).where("__kind = 1")
    joined = near.join(later, near["__b"].eqNullSafe(later["__b"]), "left")
    met = F.coalesce(F.coalesce("__next", "__later") <= F.col("__hi"), F.lit(False))
    return joined.where(~met).select("__row.*")
