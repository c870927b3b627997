"""Splits, quotas and balancing over window metadata."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quakeframe.operators.evaluate import quantiles
from quakeframe.operators.sequence import DAY, micros, running
from quakeframe.session import materialize

SPLITS = ("train", "val", "test")
#: Keys that one task passes through in fill_splits at most; more are placed by phases.
ONE_TASK_KEYS = 1_000_000


def chronological(windows: DataFrame, ratios: tuple[float, float] = (0.70, 0.15), embargo_days: float = 0.0, end: str = "end_time", target: str | None = None) -> DataFrame:
    """Adds split: train, val, test or dropped, by time.

    Windows within embargo_days before a cut are dropped; with target, so are
    those of train and val that are labelled by an event after their own cut.
    """
    span = windows.agg(F.min(micros(end)).alias("__t0"), F.max(micros(end)).alias("__t1"))
    days = (F.col("__t1") - F.col("__t0")) / F.lit(1_000_000.0) / DAY
    cut = lambda r: F.col("__t0") + F.round(days * F.lit(r) * F.lit(DAY * 1_000_000.0)).cast("long")
    span = span.select(cut(ratios[0]).alias("__c1"), cut(ratios[0] + ratios[1]).alias("__c2"))
    e, embargo = micros(end), F.lit(int(embargo_days * DAY * 1_000_000))
    late = (lambda c: F.coalesce(micros(target) > F.col(c), F.lit(False))) if target else (lambda c: F.lit(False))
    split = (
        F.when(e <= F.col("__c1") - embargo, F.when(late("__c1"), "dropped").otherwise("train"))
        .when((e > F.col("__c1")) & (e <= F.col("__c2") - embargo), F.when(late("__c2"), "dropped").otherwise("val"))
        .when(e > F.col("__c2"), "test")
        .otherwise("dropped")
    )
    return windows.crossJoin(F.broadcast(span)).withColumn("split", split).drop("__c1", "__c2")  # one row of cuts


def tercile_classes(windows: DataFrame, days: str = "days_to_major", fit_on: Column | None = None) -> DataFrame:
    """Adds low_days, high_days and tercile (0, 1, 2): terciles of the rows fit_on; 365 and 1825 days if those are fewer than 3."""
    own = windows.where(fit_on) if fit_on is not None else windows
    found = quantiles(own, days, [1 / 3, 2 / 3]).agg(F.max("n").alias("__n"), F.max("edges").alias("__q"))  # one row
    cuts = found.select(*(F.when(F.coalesce("__n", F.lit(0)) < 3, F.lit(d)).otherwise(F.col("__q")[k]).alias(n) for k, (n, d) in enumerate((("low_days", 365.0), ("high_days", 1825.0)))))
    d = F.col(days)
    return windows.crossJoin(F.broadcast(cuts)).withColumn("tercile", F.when(d < F.col("low_days"), 0).when(d < F.col("high_days"), 1).otherwise(2))


def hashed_order(*keys: str, seed: int = 42) -> Column:
    """A fixed shuffle: md5 of the seed and the keys."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys)))


def ranked(df: DataFrame, by: list[str], order: list, name: str = "rank", size: str | None = None) -> DataFrame:
    """Adds the 0-based place within by and, if named, the size of by."""
    placed = running(df, order, {name: F.lit(1).cast("long")}, by)
    return with_total(placed, by, {size: F.count(F.lit(1))}) if size else placed


def with_total(df: DataFrame, by: list[str], totals: dict[str, Column]) -> DataFrame:
    """Adds aggregates over by."""
    own = df.groupBy(*by).agg(*(c.alias(n) for n, c in totals.items())).withColumnsRenamed({c: f"__by_{c}" for c in by})
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__by_{c}"))
    return df.join(own, same).drop(*(f"__by_{c}" for c in by))


def cap_quota(entries: DataFrame, by: str, weight: str, cap: int, keys: list[str], seed: int = 42) -> DataFrame:
    """Adds quota: in shuffled order each entry takes what the cap leaves; null if by stays under the cap."""
    placed = running(entries.withColumn("__h", hashed_order(*keys, seed=seed)), ["__h", *keys], {"__prior": F.col(weight)}, [by])
    total = with_total(placed, [by], {"__total": F.sum(weight)})
    return total.withColumn("quota", F.when(F.col("__total") > cap, F.greatest(F.lit(0), F.least(F.col(weight), F.lit(cap) - F.col("__prior"))))).drop("__h", "__prior", "__total")


def cap_whole(entries: DataFrame, by: str, weight: str, cap: int, keys: list[str], seed: int = 42) -> DataFrame:
    """Entries kept whole, in shuffled order, while the sum before is under the cap; the last may overshoot."""
    placed = running(entries.withColumn("__h", hashed_order(*keys, seed=seed)), ["__h", *keys], {"__prior": F.col(weight)}, [by])
    return placed.where(F.col("__prior") < cap).drop("__h", "__prior")


def evenly_spaced(rank: Column, n: Column, quota: int | Column) -> Column:
    """Whether a 0-based rank of n is among quota evenly spaced ones (halves to even); all of them if n is no more."""
    want = F.lit(quota) if isinstance(quota, int) else quota
    step = (n - 1) / F.greatest(want - 1, F.lit(1)).cast("double")
    near = F.floor(rank / step)  # the place that rounds to rank is this one or a neighbour
    hit = lambda k: (k >= 0) & (k < want) & (F.rint(k * step).cast("long") == rank.cast("long"))
    return (n <= want) | ((want > 0) & (hit(near - 1) | hit(near) | hit(near + 1)))


def largest_remainder(df: DataFrame, by: str, weight: str, total: Column, key: str) -> DataFrame:
    """Adds share: total split over the rows of by in proportion to weight; what rounding leaves goes to the largest remainders."""
    exact = with_total(df, [by], {"__w": F.sum(weight)}).withColumn("__x", F.col(weight) * total / F.col("__w")).withColumn("__f", F.floor("__x"))
    exact = with_total(exact, [by], {"__floors": F.sum("__f")}).withColumn("__rest", F.col("__x") - F.col("__f"))
    short = (total - F.col("__floors")).cast("long")
    placed = running(exact, [F.desc("__rest"), F.col(key)], {"__k": F.lit(1)}, [by])
    return placed.withColumn("share", (F.col("__f") + F.when(F.col("__k") < short, 1).otherwise(0)).cast("long")).drop("__w", "__x", "__f", "__floors", "__rest", "__k")


def _folded(keys: DataFrame, key: str, columns: list[str], seed: int, start: Callable[[], list], place: Callable[[list, tuple], str | None]) -> DataFrame:
    """(key, split): place, which may change the state that start makes, is asked for each key in shuffled order.

    The order makes each choice depend on all before, so this is one pass over the keys, one row a station or event,
    sorted outside of memory; the state is a few numbers and rows stream through. Windows never pass through it.
    """
    ordered = keys.select(F.col(key).alias("k"), *columns, hashed_order(key, seed=seed).alias("h")).repartition(1).sortWithinPartitions("h", "k")
    kind = keys.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = start()
        for batch in batches:
            splits = [place(state, row) for row in zip(*(batch.column(c).to_pylist() for c in columns), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(splits, pa.string())], names=[key, "split"])

    return ordered.mapInArrow(run, T.StructType([T.StructField(key, kind), T.StructField("split", T.StringType())])).where("split is not null")


def deficit_splits(keys: DataFrame, key: str, weight: str, ratios: tuple[float, float, float] = (0.70, 0.15, 0.15), seed: int = 42) -> DataFrame:
    """(key, split): keys in shuffled order go to the split with the largest relative deficit, ties to the first.

    keys has one row a group (station or event).
    """
    total = float(keys.agg(F.sum(weight)).first()[0] or 0)
    targets = [total * r for r in ratios]

    def place(held: list, row: tuple) -> str:
        gaps = [(t - h) / max(t, 1.0) for t, h in zip(targets, held, strict=True)]
        best = gaps.index(max(gaps))
        held[best] += float(row[0] or 0)
        return SPLITS[best]

    return _folded(keys, key, [weight], seed, lambda: [0.0] * len(SPLITS), place)


def random_split(df: DataFrame, keys: list[str], ratios: tuple[float, float] = (0.70, 0.15), seed: int = 42) -> DataFrame:
    """Adds split by a fixed shuffle of all rows; leaky on purpose, to measure leaks with."""
    n = df.count()
    a, b = int(n * ratios[0]), int(n * ratios[0]) + int(n * ratios[1])
    h = hashed_order(*keys, seed=seed)
    counts = df.groupBy(h.alias("h")).agg(F.count(F.lit(1)).alias("n"))
    placed = running(counts, ["h"], {"before": F.col("n")})
    edge = lambda k: F.max(F.when((F.col("before") < k) & (F.col("before") + F.col("n") >= k), F.col("h")))
    edges = placed.agg(edge(a).alias("__a"), edge(b).alias("__b"))  # one row
    split = F.when(F.coalesce(h <= F.col("__a"), F.lit(False)), "train").when(F.coalesce(h <= F.col("__b"), F.lit(False)), "val").otherwise("test")
    return df.crossJoin(F.broadcast(edges)).withColumn("split", split).drop("__a", "__b")


def leaks(df: DataFrame, key: str, split: str = "split") -> DataFrame:
    """Keys that occur in more than one split."""
    return df.groupBy(key).agg(F.count_distinct(split).alias("n_splits")).where("n_splits > 1")


def majority_rate(df: DataFrame, label: str, split: str = "split") -> DataFrame:
    """Rows and the share of the most frequent label of each split."""
    counts = df.groupBy(split, label).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(split).agg(F.sum("n").alias("n"), (F.max("n") / F.sum("n")).alias("majority_rate"))


def fill_splits(keys: DataFrame, key: str, weights: list[str], ratios: tuple[float, float] = (0.70, 0.15), seed: int = 42) -> DataFrame:
    """(key, split): keys in shuffled order go to the first split in which a class they hold is below its target.

    weights has one column a class. Targets are shares of the smallest class
    total, cut to whole windows. Keys that no split needs are left out.
    """
    total = min(int(x or 0) for x in keys.agg(*(F.sum(w) for w in weights)).first())
    a, b = int(total * ratios[0]), int(total * ratios[1])
    targets = dict(zip(SPLITS, (a, b, total - a - b), strict=True))

    def place(held: list, row: tuple) -> str | None:
        for s, own in zip(SPLITS, held, strict=True):
            if any(n and n > 0 and h < targets[s] for n, h in zip(row, own, strict=True)):
                own[:] = [h + int(n or 0) for n, h in zip(row, own, strict=True)]
                return s
        return None

    if keys.count() > ONE_TASK_KEYS:
        return _filled_by_phases(keys, key, weights, targets, seed)
    return _folded(keys, key, weights, seed, lambda: [[0] * len(weights) for _ in SPLITS], place)


def _filled_by_phases(keys: DataFrame, key: str, weights: list[str], targets: dict[str, int], seed: int) -> DataFrame:
    """fill_splits of any number of keys: while the same classes of a split are below their targets it takes every key that holds one of
    them, so where that changes is found in running sums; a split has a phase a class at most."""
    left = materialize(keys.select(F.col(key), *(F.coalesce(F.col(w), F.lit(0)).cast("long").alias(w) for w in weights), hashed_order(key, seed=seed).alias("__h")), "keys")
    at, out = F.struct("__h", key), None
    for name in SPLITS:
        held, open_ = dict.fromkeys(weights, 0), [w for w in weights if targets[name] > 0]
        rest, taken = left, None
        while open_:
            some = F.lit(False)
            for w in open_:
                some = some | (F.col(w) > 0)
            placed = running(rest.where(some), ["__h", key], {f"__before_{w}": F.col(w) for w in open_})
            full = F.lit(False)
            for w in open_:
                full = full | (F.col(f"__before_{w}") + held[w] >= targets[name])
            end = placed.where(full).agg(F.min(at).alias("end")).first()["end"]
            edge = F.struct(F.lit(end[0]).alias("__h"), F.lit(end[1]).cast(keys.schema[key].dataType).alias(key)) if end else None
            own = placed.where(at < edge) if end else placed
            own = own.select(key, *weights, "__h")
            taken = own if taken is None else taken.unionByName(own)
            sums = own.agg(*(F.sum(w).alias(w) for w in weights)).first()
            held = {w: n + int(sums[w] or 0) for w, n in held.items()}
            if not end:
                break
            open_, rest = [w for w in weights if held[w] < targets[name]], rest.where(at >= edge)
        if taken is not None:
            taken = materialize(taken, "taken")
            left = materialize(left.join(taken.select(key, "__h"), [key, "__h"], "left_anti"), "keys")
            placed = taken.select(key, F.lit(name).alias("split"))
            out = placed if out is None else out.unionByName(placed)
    return out if out is not None else keys.select(key, F.lit(None).cast("string").alias("split")).limit(0)


def trim_surplus(entries: DataFrame, by: str, cls: str, weight: str, key: str) -> DataFrame:
    """Adds quota: within each by, every class's windows cut to the smallest class's number, shared over its entries by largest remainder."""
    totals = entries.groupBy(by, cls).agg(F.sum(weight).alias("__total"))
    least = totals.groupBy(by).agg(F.min("__total").alias("__least"))
    joined = entries.join(least, by).withColumn("__group", F.concat_ws("|", F.col(by).cast("string"), F.col(cls).cast("string")))
    shared = largest_remainder(joined, "__group", weight, F.col("__least"), key)
    return shared.withColumn("quota", F.col("share")).drop("share", "__group", "__least")


def balance_caps(totals: DataFrame, rare: str, others: list[str], ratio: float = 4.0) -> DataFrame:
    """Adds cap, ratio times the rare class's number (halves to even; null without the rare class), and kept_ of each other class."""
    cap = F.when(F.col(rare) > 0, F.rint(F.col(rare) * ratio).cast("long"))
    return totals.withColumn("cap", cap).withColumns({f"kept_{c}": F.coalesce(F.least(F.col(c), F.col("cap")), F.col(c)) for c in others})


def class_targets(totals: DataFrame, cls: str = "cls", total: str = "total", ratios: tuple[float, float] = (0.70, 0.15)) -> DataFrame:
    """Adds train, val and test, shares of the smallest class's total, and surplus, what a class has above it."""
    least = totals.agg(F.min(total).alias("__m"))  # one row
    a, b = (F.floor(F.col("__m") * r) for r in ratios)
    joined = totals.crossJoin(F.broadcast(least))
    return joined.withColumns({"train": a, "val": b, "test": F.col("__m") - a - b, "surplus": F.col(total) - F.col("__m")}).drop("__m")
