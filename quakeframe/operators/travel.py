"""First-arrival times in a layered sphere: rays by take-off angle, tables by distance and depth, and their lookup.

A model is a list of shells (bottom and top in km of depth, speeds there), within which the speed is a power of the radius.
With eta = r / v, B the power and p the ray's slowness (seconds a radian), a leg between two radii has

    distance = (acos(p / eta) at the top - at the bottom) / (1 - B)
    time     = (sqrt(eta^2 - p^2) at the top - at the bottom) / (1 - B)

and a ray turns where eta = p. So no leg is integrated numerically. Rays of all depths and angles are rows; each is one
expression over the model's array, which is configuration of a few hundred numbers.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quakeframe.functions.columns import EARTH_KM
from quakeframe.session import materialize

#: Rows of a table of cells that are broadcast at most; more are joined by a shuffle.
BROADCAST_CELLS = 2_000_000


@dataclass(frozen=True)
class Shell:
    """Depths in km from top to bottom and the speeds there in km/s."""

    top: float
    bottom: float
    top_speed: float
    bottom_speed: float


#: Crust and mantle of the public 1-D model of 1991: the depth of each bottom and the speed of P waves by powers of r / 6371; fixed values.
MODEL_1991 = (
    (20.0, (5.8,)),
    (35.0, (6.5,)),
    (120.0, (8.78541, -0.74953)),
    (210.0, (25.41389, -17.69722)),
    (410.0, (30.78765, -23.25415)),
    (660.0, (29.38896, -21.40656)),
    (760.0, (25.96984, -16.93412)),
    (2740.0, (25.1486, -41.1538, 51.9932, -26.6083)),
    (2889.0, (14.49470, -1.47089)),
)


def shells_of(model: tuple = MODEL_1991, thickest: float = 20.0, radius: float = EARTH_KM) -> list[Shell]:
    """The shells of a model given by bottoms and polynomials, cut so that none is thicker."""
    out, top = [], 0.0
    for bottom, powers in model:
        speed = lambda z, powers=powers: sum(c * ((radius - z) / radius) ** k for k, c in enumerate(powers))
        n = math.ceil((bottom - top) / thickest)
        edges = [top + (bottom - top) * k / n for k in range(n + 1)]
        out += [Shell(a, b, speed(a), speed(b)) for a, b in zip(edges, edges[1:])]
        top = bottom
    return out


def _model_rows(shells: list[Shell], radius: float) -> list[tuple]:
    """From the top down: radii, eta at both, 1 / (1 - B), B, the speed's factor, and branch, which changes with each jump of the speed."""
    rows, branch, last = [], 0, None
    for s in shells:
        if not (s.top < s.bottom <= radius and s.top_speed > 0 and s.bottom_speed > 0) or last is not None and s.top != last.bottom:
            raise ValueError("shells follow each other downwards and have speeds")
        high, low = radius - s.top, max(radius - s.bottom, 1e-6)
        power = math.log(s.top_speed / s.bottom_speed) / math.log(high / low) if s.top_speed != s.bottom_speed else 0.0
        if power >= 1:
            raise ValueError("a speed that falls faster than the radius guides waves; no ray turns there")
        branch += last is not None and abs(last.bottom_speed - s.top_speed) > 1e-9
        rows.append((high, low, high / s.top_speed, low / s.bottom_speed, 1 / (1 - power), power, s.top_speed / high**power, branch))
        last = s
    return rows


_FIELDS = ("high", "low", "eta_high", "eta_low", "inverse", "power", "factor", "branch")


def rays(spark: SparkSession, shells: list[Shell], depths: list[float], angles: int = 2000, radius: float = EARTH_KM) -> DataFrame:
    """A row a depth and take-off angle that reaches the surface: depth_km, ray (its place by angle, straight down first), up, branch,
    p (seconds a radian), delta (radians), seconds."""
    model = spark.createDataFrame([(_model_rows(shells, radius),)], "model array<struct<" + ",".join(f"{n}:{'int' if n == 'branch' else 'double'}" for n in _FIELDS) + ">>")
    rows = spark.createDataFrame([(float(z),) for z in depths], "depth_km double").repartition(min(len(depths), 64)).crossJoin(F.broadcast(model))  # one row
    source = F.lit(radius) - F.col("depth_km")
    own = F.get(F.filter("model", lambda s: (s["low"] < source) & (source <= s["high"])), F.lit(0))
    rows = rows.withColumn("r", source).withColumn("eta", F.pow("r", 1 - own["power"]) / own["factor"])
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(2 * angles))).alias("ray"))
    tilt = F.col("ray") * F.lit(math.pi / 2 / angles)  # from straight down to straight up
    rows = rows.withColumns({"p": F.col("eta") * F.sin(tilt), "up": F.col("ray") > angles})
    p = F.col("p")

    def leg(s: Column, top: Column, bottom: Column) -> tuple[Column, Column]:
        """Distance and time between two etas, of which the lower may be p itself."""
        angle = lambda eta: F.acos(F.least(p / eta, F.lit(1.0)))
        root = lambda eta: F.sqrt(F.greatest(eta * eta - p * p, F.lit(0.0)))
        return (angle(top) - angle(bottom)) * s["inverse"], (root(top) - root(bottom)) * s["inverse"]

    def through(acc: Column, s: Column) -> Column:
        at = lambda r: F.pow(r, 1 - s["power"]) / s["factor"]
        above, below = s["high"] > F.col("r"), s["low"] < F.col("r")
        floor = F.when(below, at(F.col("r"))).otherwise(s["eta_low"])  # of the part above the source
        roof = F.when(above, at(F.col("r"))).otherwise(s["eta_high"])  # of the part below it
        rise, rise_time = leg(s, s["eta_high"], floor)
        dive, dive_time = leg(s, roof, s["eta_low"])
        down = ~F.col("up") & below & ~acc["turned"] & ~acc["lost"]
        lost = acc["lost"] | (above & (F.least(s["eta_high"], floor) < p * (1 - 1e-12))) | (down & (roof < p * (1 - 1e-12)))
        turned = acc["turned"] | (down & ~lost & (s["eta_low"] <= p))
        return F.struct(
            (acc["delta"] + F.when(above, rise).otherwise(0.0) + F.when(down, 2 * dive).otherwise(0.0)).alias("delta"),
            (acc["seconds"] + F.when(above, rise_time).otherwise(0.0) + F.when(down, 2 * dive_time).otherwise(0.0)).alias("seconds"),
            turned.alias("turned"),
            lost.alias("lost"),
            F.when(turned & ~acc["turned"], s["branch"]).otherwise(acc["branch"]).alias("branch"),
        )

    begin = F.struct(F.lit(0.0).alias("delta"), F.lit(0.0).alias("seconds"), F.lit(False).alias("turned"), F.lit(False).alias("lost"), F.lit(-1).alias("branch"))
    traced = rows.withColumn("t", F.aggregate("model", begin, through))
    fine = traced.where(~F.col("t.lost") & (F.col("up") | F.col("t.turned")))
    return fine.select("depth_km", "ray", "up", "t.branch", "p", "t.delta", "t.seconds")


def travel_times(traced: DataFrame, step_deg: float = 0.05, most_deg: float = 20.0) -> DataFrame:
    """depth_km, distance_deg (a multiple of step_deg), phase (p upwards, P downwards) and seconds, the earliest of each phase.

    Between neighbouring rays of one branch the time is the cubic through both with their slownesses as slopes.
    """
    order = Window.partitionBy("depth_km").orderBy("ray")  # the rays of one depth
    after = lambda c: F.lead(c).over(order)
    pairs = traced.select("*", *(after(c).alias(f"next_{c}") for c in ("ray", "up", "branch", "p", "delta", "seconds")))
    same = (F.col("next_ray") == F.col("ray") + 1) & ((F.col("next_branch") == F.col("branch")) | (F.col("next_up") & ~F.col("up") & (F.col("delta") > 0)))
    step = math.radians(step_deg)
    low, high = F.least("delta", "next_delta"), F.greatest("delta", "next_delta")
    first, last = F.ceil(low / step - 1e-9), F.least(F.floor(high / step + 1e-9), F.lit(int(round(most_deg / step_deg))))
    cut = pairs.where(same & (first <= last)).select("*", F.explode(F.sequence(first.cast("int"), last.cast("int"))).alias("k"))
    width = F.col("next_delta") - F.col("delta")
    u = F.when(F.abs(width) > 1e-15, (F.col("k") * step - F.col("delta")) / width).otherwise(0.0)
    a, b, pa, pb = (F.col(c) for c in ("seconds", "next_seconds", "p", "next_p"))
    cubic = (2 * u * u * u - 3 * u * u + 1) * a + (u * u * u - 2 * u * u + u) * width * pa + (3 * u * u - 2 * u * u * u) * b + (u * u * u - u * u) * width * pb
    phase = F.when(F.col("up") | F.col("next_up"), "p").otherwise("P")
    found = cut.select("depth_km", "k", phase.alias("phase"), cubic.alias("t")).groupBy("depth_km", "k", "phase").agg(F.min("t").alias("seconds"))
    return found.select("depth_km", (F.col("k") * F.lit(step_deg)).alias("distance_deg"), "phase", "seconds")


def table(spark: SparkSession, shells: list[Shell], depths: list[float], step_deg: float = 0.05, most_deg: float = 20.0, angles: int = 2000, radius: float = EARTH_KM) -> DataFrame:
    """The travel_times of a model, written once."""
    return materialize(travel_times(rays(spark, shells, depths, angles, radius), step_deg, most_deg), "travel")


def first_arrival(df: DataFrame, times: DataFrame, distance: str, depth: str, step_deg: float = 0.05, step_km: float = 1.0) -> DataFrame:
    """Adds predicted_p_s: the earliest phase of times, interpolated between the four corners of the cell that (distance, depth) lies in.

    times has depths at multiples of step_km and distances at multiples of step_deg; outside them, or where a corner has no
    arrival, it is null. Depths above the surface count as 0.
    """
    best = times.groupBy(F.rint(F.col("distance_deg") / step_deg).cast("long").alias("__k"), F.rint(F.col("depth_km") / step_km).cast("long").alias("__z")).agg(F.min("seconds").alias("t"))
    corners = [best.select((F.col("__k") - i).alias("__k"), (F.col("__z") - j).alias("__z"), F.struct(F.lit(2 * j + i).alias("c"), "t").alias("s")) for i in (0, 1) for j in (0, 1)]
    met = corners[0]
    for c in corners[1:]:
        met = met.unionByName(c)
    cells = met.groupBy("__k", "__z").agg(F.map_from_entries(F.collect_list("s")).alias("__t"))  # four corners at most
    cells = materialize(cells, "cells")
    cells = F.broadcast(cells) if cells.count() <= BROADCAST_CELLS else cells
    deep = F.greatest(F.col(depth).cast("double"), F.lit(0.0))
    x, y = F.col(distance) / step_deg, F.when(F.col(depth).isNotNull(), deep) / step_km
    placed = df.withColumns({"__x": x, "__y": y}).withColumns({"__k": F.floor("__x"), "__z": F.floor("__y")})
    joined = placed.join(cells, ["__k", "__z"], "left")
    u, v = F.col("__x") - F.col("__k"), F.col("__y") - F.col("__z")
    part = lambda c, w: F.when(w > 0, F.try_element_at("__t", F.lit(c)) * w).otherwise(F.lit(0.0))
    value = part(0, (1 - u) * (1 - v)) + part(1, u * (1 - v)) + part(2, (1 - u) * v) + part(3, u * v)
    return joined.withColumn("predicted_p_s", F.when(F.col("__t").isNotNull(), value)).drop("__x", "__y", "__k", "__z", "__t")
