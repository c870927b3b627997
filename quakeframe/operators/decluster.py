"""Gardner-Knopoff declustering as rounds of a binned self-join.

Events are taken by falling magnitude (then time, then id). One is a main shock
if no main shock before it in that order claims it: within T days to either side,
within L km, and of no larger magnitude. Levels of the order are taken from the top: the
events of a level that no earlier main shock has claimed are settled among
themselves, and then its main shocks claim later events, which go. So a claimed
event claims nothing itself, and an aftershock sequence costs its size. A level is
cut, within a magnitude too, where the pairs that would meet in it number PAIRS_EACH for each event of
the catalog: however dense a catalog is, pairs grow with its size. Main shocks
keep apart, so those around an event are few. Within a
level, a round settles each open event that all earlier claimers are settled for;
claims are found by bins of time, latitude and longitude.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakeframe.functions.columns import days_between, haversine_km
from quakeframe.operators.sequence import micros, running
from quakeframe.session import materialize

KM_PER_DEGREE = 111.0
#: Width of a magnitude class.
MAGNITUDE_STEP = 0.5
#: Pairs that meet in a level, for each event of the catalog, about and at most (LEAST_PAIRS in a small one).
PAIRS_EACH, LEAST_PAIRS = 4, 1_000_000
#: Events of the first level, at most; each level is tried GROWTH times as large as the one before.
FIRST_EVENTS, GROWTH = 1 << 15, 16
#: Main shocks of a level up to this number are broadcast (27 rows each); more are joined by a shuffle.
BROADCAST_MAINS = 10_000


def window_km(m: Column) -> Column:
    return F.pow(F.lit(10.0), 0.1238 * m + 0.983)


def window_days(m: Column) -> Column:
    return F.when(m >= 6.5, F.pow(F.lit(10.0), 0.032 * m + 2.7389)).otherwise(F.pow(F.lit(10.0), 0.5409 * m - 0.547))


def magnitude_class(step: float = MAGNITUDE_STEP) -> Column:
    return F.ceil(F.col("magnitude") / step).cast("int")


def _sides(events: DataFrame, by: str, claimed: DataFrame | None, magnitude_step: float) -> tuple[DataFrame, DataFrame]:
    """The claimers in each bin around them, and the events they may claim in their own bin of each class.

    Magnitude classes share a bin size, the window of the class's upper end, so
    large windows don't make small ones coarse.
    """
    known = F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.col("m").isNotNull() & F.col("id").isNotNull()
    rows_of = lambda df: df.select(by, F.col("event_id").alias("id"), "time", "lat", "lon", F.col("magnitude").alias("m"), magnitude_class(magnitude_step).alias("c")).where(known)
    classed = rows_of(events)
    sizes = classed.groupBy("c").agg(F.count(F.lit(1)).alias("n")).select(
        "c", (window_days(F.col("c") * magnitude_step) * 86_400e6).alias("bin_us"), (window_km(F.col("c") * magnitude_step) / KM_PER_DEGREE).alias("bin_lat")
    )
    tb = lambda d: F.floor(micros("time") / F.col("bin_us")) + d
    lb = lambda d: F.floor(F.col("lat") / F.col("bin_lat")) + d
    # bins of longitude fill the circle; in a latitude bin they are as wide as the window is at the highest latitude next to it
    top = F.least(F.lit(90.0), F.greatest(F.abs((F.col("lb") - 1) * F.col("bin_lat")), F.abs((F.col("lb") + 2) * F.col("bin_lat"))))
    wide = F.degrees(2 * F.asin(F.least(F.lit(1.0), F.sin(F.radians(F.col("bin_lat") / 2)) / F.greatest(F.cos(F.radians(top)), F.lit(1e-9)))))
    n_bins = F.greatest(F.lit(1), F.floor(360 / wide))
    gb = lambda d: F.pmod(F.floor((F.col("lon") + 180) * n_bins / 360) + d, n_bins)
    around = F.array(F.lit(-1), F.lit(0), F.lit(1))
    strong = classed.join(F.broadcast(sizes), "c").withColumn("dt", F.explode(around)).withColumn("dl", F.explode(around)).withColumn("tb", tb(F.col("dt"))).withColumn("lb", lb(F.col("dl")))
    strong = strong.withColumn("gb", F.explode(F.array_distinct(F.array(*(gb(d) for d in (-1, 0, 1))))))
    # each event meets the bins of every magnitude class (a few dozen) that is not below its own
    weak = (classed if claimed is None else rows_of(claimed)).withColumnRenamed("c", "own").join(F.broadcast(sizes), F.col("own") <= F.col("c")).withColumn("tb", tb(0)).withColumn("lb", lb(0)).withColumn("gb", gb(0))
    return strong, weak


BINS = ("c", "tb", "lb", "gb")


def _claimed_by(by: str) -> Column:
    """Of rows a and b of one bin: whether a comes first and claims b."""
    first = (F.col("a.m") > F.col("b.m")) | ((F.col("a.m") == F.col("b.m")) & (F.struct("a.time", "a.id") < F.struct("b.time", "b.id")))
    near = (F.abs(days_between(F.col("a.time"), F.col("b.time"))) <= window_days(F.col("a.m"))) & (haversine_km(F.col("a.lat"), F.col("a.lon"), F.col("b.lat"), F.col("b.lon")) <= window_km(F.col("a.m")))
    return reduce(Column.__and__, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in (by, *BINS)]) & first & near


def claims(events: DataFrame, by: str = "region", magnitude_step: float = MAGNITUDE_STEP) -> DataFrame:
    """(by, claimer, claimed): pairs of ids, claimer first in the order."""
    strong, weak = _sides(events, by, None, magnitude_step)
    return strong.alias("a").join(weak.alias("b"), _claimed_by(by)).select(F.col(f"a.{by}").alias(by), F.col("a.id").alias("claimer"), F.col("b.id").alias("claimed"))


def _claimed(mains: DataFrame, below: DataFrame, by: str) -> DataFrame:
    """(by, event_id) of the events below that some main shock claims."""
    strong, weak = _sides(mains, by, below, MAGNITUDE_STEP)
    strong = F.broadcast(strong) if mains.count() <= BROADCAST_MAINS else strong
    return weak.alias("b").join(strong.alias("a"), _claimed_by(by), "left_semi").select(by, F.col("id").alias("event_id")).distinct()


def _met(events: DataFrame, by: str) -> int:
    """Pairs of the events that meet in a bin."""
    sides = [x.groupBy(by, *BINS).agg(F.count(F.lit(1)).alias(n)) for x, n in zip(_sides(events, by, None, MAGNITUDE_STEP), "ab", strict=True)]
    return sides[0].join(sides[1], [by, *BINS]).agg(F.sum(F.col("a") * F.col("b"))).first()[0] or 0


def _settled(events: DataFrame, by: str) -> DataFrame:
    """(by, event_id, is_main) of events by the claims among them."""
    open_edges = materialize(claims(events, by), "claims")
    claimed_ids = open_edges.select(by, F.col("claimed").alias("event_id")).distinct()
    main = events.select(by, "event_id").join(claimed_ids, [by, "event_id"], "left_anti")  # nobody claims these
    fresh = materialize(main.withColumn("is_main", F.lit(True)), "settled")
    settled = [fresh]
    while not open_edges.isEmpty():
        done = fresh.select(by, F.col("event_id").alias("claimer"), F.col("is_main").alias("claimer_main"))
        marked = open_edges.join(done, [by, "claimer"], "left")
        verdict = marked.groupBy(by, F.col("claimed").alias("event_id")).agg(F.max(F.coalesce("claimer_main", F.lit(False))).alias("lost"), F.max(F.col("claimer_main").isNull()).alias("waits"))
        fresh = materialize(verdict.where("lost or not waits").select(by, "event_id", (~F.col("lost")).alias("is_main")), "settled")
        if fresh.isEmpty():
            raise RuntimeError("a round of declustering settled none of the open events")
        settled.append(fresh)
        if len(settled) == 20:
            settled = [materialize(reduce(DataFrame.unionByName, settled), "settled")]
        done_ids = fresh.select(by, F.col("event_id").alias("claimed"))
        # claims of settled events are used up: they took the claimed event, or are void
        waiting = marked.where(F.col("claimer_main").isNull()).drop("claimer_main")
        open_edges = materialize(waiting.join(done_ids, [by, "claimed"], "left_anti").select(by, "claimer", "claimed"), "open")
    return reduce(DataFrame.unionByName, settled)


def _cut(rest: DataFrame, n: int, total: int, most: int, by: str) -> tuple[int, int]:
    """The place where a level of rest ends, and its size: about n of its total events, fewer if more than most pairs met."""
    while True:
        if n >= total:
            place = rest.agg(F.max("place")).first()[0]
        else:
            place = rest.agg(F.percentile_approx("place", n / total, 100_000)).first()[0]
        met = _met(rest.where(F.col("place") <= place), by)
        if met <= most or n == 1:
            return place, n
        n = max(1, int(min(n, total) * min(0.5, 0.8 * (most / met) ** 0.5)))  # pairs grow by the square at most


def decluster(events: DataFrame, by: str = "region") -> DataFrame:
    """events with is_main. Rounds go on until every event is settled; an event without an id or magnitude has no claims and is main."""
    known = events.select(by, "event_id", "time", "lat", "lon", "magnitude").where("magnitude is not null")
    rest = materialize(running(known, [F.desc("magnitude"), "time", "event_id"], {"place": F.lit(1).cast("long")}), "events")
    parts, total = [], rest.count()
    n, most = FIRST_EVENTS, max(LEAST_PAIRS, PAIRS_EACH * total)
    while total:
        place, n = _cut(rest, n, total, most, by)
        level, below = rest.where(F.col("place") <= place), rest.where(F.col("place") > place)
        settled = materialize(_settled(level.drop("place"), by), "level")
        parts.append(settled)
        if below.isEmpty():
            break
        mains = materialize(level.join(settled.where("is_main").select(by, "event_id"), [by, "event_id"], "left_semi"), "mains")
        gone = materialize(_claimed(mains, below, by), "claimed")
        parts.append(gone.withColumn("is_main", F.lit(False)))
        if len(parts) >= 20:
            parts = [materialize(reduce(DataFrame.unionByName, parts), "settled")]
        rest = materialize(below.join(gone, [by, "event_id"], "left_anti").select(rest.columns), "events")
        total, n = rest.count(), n * GROWTH
    if not parts:
        return events.withColumn("is_main", F.lit(True))
    final = reduce(DataFrame.unionByName, parts)
    return events.join(final, [by, "event_id"], "left").withColumn("is_main", F.coalesce("is_main", F.lit(True)))
