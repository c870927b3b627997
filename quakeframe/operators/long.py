"""Traces that are longer than a row: blocks of samples, and the operators of traces over them.

A block is a row: the trace's keys, block (its number), at (its first sample), n (samples of the trace)
and samples. Blocks are dealt by (keys, block), so one trace may fill many tasks; what crosses blocks is a few numbers a
block (sums, a filter's state) or the edge of the block before. Of one trace only the table
with a row a block, a filter's state each, meets in one task: for a block of 65,536 samples that is a thousandth of its bytes.
A null sample makes a cleaned trace NaN from end to end, as a recursive filter's memory has no end; fill gaps first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quakeframe.operators import dsp, signal
from quakeframe.session import materialize

BLOCK = 1 << 16
#: A block has room for the reflected edges of a filter.
SHORTEST_BLOCK = 128


def cut(traces: DataFrame, keys: list[str], size: int = BLOCK, samples: str = "samples") -> DataFrame:
    """Blocks of size samples at most, all of nearly equal length; traces without samples have none."""
    if size < SHORTEST_BLOCK:
        raise ValueError(f"blocks have {SHORTEST_BLOCK} samples at least")
    n = F.size(samples).cast("long")
    blocks = F.greatest(F.ceil(n / size), F.lit(1).cast("long"))
    edge = lambda k: F.floor(n * k / blocks).cast("long")
    piece = lambda k: F.struct(k.alias("block"), edge(k).alias("at"), F.slice(samples, (edge(k) + 1).cast("int"), (edge(k + 1) - edge(k)).cast("int")).alias("samples"))
    # cut before exploding, so that no row carries the whole trace
    rows = traces.where(n > 0).select(*keys, n.alias("n"), F.transform(F.sequence(F.lit(0).cast("long"), blocks - 1), piece).alias("p"))
    return rows.select(*keys, "n", F.inline("p")).select(*keys, "block", "at", "n", "samples")


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def _of_trace(blocks: DataFrame, keys: list[str], whole: DataFrame) -> DataFrame:
    """blocks with the columns of whole, which has a row a trace: it is laid out by block, so that a long trace stays spread."""
    places = blocks.select(*keys, "block").join(whole, keys)
    return blocks.join(places, [*keys, "block"])


def with_line(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Adds __mean and __slope, the least-squares line of the whole trace through its middle."""
    c = F.size("samples")
    middle = (c - 1) / 2.0
    own = blocks.select(*keys, "n", c.cast("double").alias("c"), (F.col("at") + middle).alias("m"), _sum(F.col("samples")).alias("s"), _sum(F.transform("samples", lambda v, i: v * (i - middle))).alias("q"))
    n = F.max("n").cast("double")
    whole = own.groupBy(*keys).agg(F.sum("s").alias("s"), F.sum(F.col("m") * F.col("s") + F.col("q")).alias("ts"), n.alias("__n"))
    mean, t = F.col("s") / F.col("__n"), (F.col("__n") - 1) / 2.0
    below = F.col("__n") * (F.col("__n") * F.col("__n") - 1) / 12.0
    slope = F.when(below > 0, (F.col("ts") - t * F.col("s")) / below).otherwise(F.lit(0.0) * F.col("s"))
    return _of_trace(blocks, keys, whole.select(*keys, mean.alias("__mean"), slope.alias("__slope")))


def detrend(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """blocks less the least-squares line of their whole trace."""
    middle = (F.col("n") - 1) / 2.0
    level = F.transform("samples", lambda v, i: v - F.col("__mean") - F.col("__slope") * (F.col("at") + i - middle))
    return with_line(blocks, keys).withColumn("samples", level).drop("__mean", "__slope")


def _prepared(x: np.ndarray, at: int, n: int, mean: float, slope: float, ramp: np.ndarray) -> np.ndarray:
    """A block without its trace's line and under its trace's taper."""
    place = np.arange(at, at + len(x))
    x = x - mean - slope * (place - (n - 1) / 2)
    early, late = place < len(ramp), place >= n - len(ramp)
    x[early] *= ramp[place[early]]
    x[late] *= ramp[n - 1 - place[late]]
    return x


def _arrays(column: pa.Array) -> list[np.ndarray]:
    return [np.asarray(x.values.to_numpy(zero_copy_only=False), float) for x in column]


def _pass(blocks: DataFrame, keys: list[str], by: dsp.Recursion, source: str, backward: bool) -> DataFrame:
    """One filter pass over the blocks' source column (wide at the trace's ends), as column samples.

    First each block is filtered from rest, or from the steady state at the trace's own end, for the state it leaves; these
    are carried from block to block; then each block is filtered from the state that it gets.
    """
    spark_key = [f for f in blocks.schema.fields if f.name in keys]
    names = [f.name for f in spark_key]
    number = T.ArrayType(T.DoubleType())
    way = slice(None, None, -1 if backward else 1)

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = []
            for x, first in zip(_arrays(batch.column(source)), batch.column("__last" if backward else "__first").to_pylist(), strict=True):
                x = x[way][None]
                begin = x[:, :1] * by.steady if first else np.zeros((1, len(by.gain)))
                ends.append(dsp.block_filter(by, x, begin)[1][0].tolist())
            lengths = pa.array(np.diff(np.asarray(batch.column(source).offsets)), pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), batch.column("block"), lengths, pa.array(ends, pa.list_(pa.float64()))], names=[*names, "block", "length", "left"])

    states = blocks.select(*keys, "block", "__first", "__last", source).mapInArrow(leaves, T.StructType([*spark_key, T.StructField("block", T.LongType()), T.StructField("length", T.LongType()), T.StructField("left", number)]))
    chains = states.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("block", "length", "left")), asc=not backward).alias("chain"))

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers: dict[int, np.ndarray] = {}
        for batch in batches:
            for row, chain in enumerate(batch.column("chain").to_pylist()):
                state, given = None, []
                for link in chain:
                    given.append(state)
                    left = np.array(link["left"])
                    if link["length"] not in powers:
                        powers[link["length"]] = by.power(link["length"])
                    state = left if state is None else powers[link["length"]] @ state + left
                kept = [batch.column(c).take(pa.array([row] * len(chain))) for c in names]
                yield pa.RecordBatch.from_arrays([*kept, pa.array([c["block"] for c in chain], pa.int64()), pa.array([None if g is None else g.tolist() for g in given], pa.list_(pa.float64()))], names=[*names, "block", "given"])

    given = chains.mapInArrow(carry, T.StructType([*spark_key, T.StructField("block", T.LongType()), T.StructField("given", number)]))
    joined = blocks.join(given, [*keys, "block"])
    rest = [f for f in joined.schema.fields if f.name not in (source, "given", "samples")]

    def filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, x in enumerate(_arrays(batch.column(source))):  # a block at a time
                x, state = x[way][None], batch.column("given")[row].as_py()
                begin = x[:, :1] * by.steady if state is None else np.array(state)[None]
                y = dsp.block_filter(by, x, begin)[0][0][way]
                own = batch.slice(row, 1)
                yield pa.RecordBatch.from_arrays([*(own.column(f.name) for f in rest), pa.ListArray.from_arrays(pa.array([0, len(y)], pa.int32()), pa.array(np.ascontiguousarray(y)))], names=[*(f.name for f in rest), "samples"])

    return joined.mapInArrow(filtered, T.StructType([*rest, T.StructField("samples", number)]))


def clean(blocks: DataFrame, keys: list[str], fs: float, low: float = 1.0, high: float = 45.0) -> DataFrame:
    """The blocks as dsp.clean makes them of the whole trace: line removed, tapered, band-passed without phase shift."""
    band = dsp.usable_band(fs, low, high)
    by = dsp.band_pass(4, *band, fs) if band else None
    lined = with_line(blocks.withColumns({"__first": F.col("at") == 0, "__last": F.col("at") + F.size("samples") == F.col("n")}), keys)
    rest = [f for f in lined.schema.fields if f.name not in ("samples", "__mean", "__slope")]

    def widen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {c: batch.column(c).to_pylist() for c in ("at", "n", "__mean", "__slope", "__first", "__last")}
            for row, x in enumerate(_arrays(batch.column("samples"))):
                c = {k: v[row] for k, v in columns.items()}
                mean, slope = (np.nan if c[k] is None else c[k] for k in ("__mean", "__slope"))
                x = _prepared(x, c["at"], c["n"], mean, slope, dsp.side_taper(c["n"]))
                pad = by.edge(c["n"]) if by else 0
                if pad > 0:
                    before = 2 * x[0] - x[pad:0:-1] if c["__first"] else x[:0]
                    after = 2 * x[-1] - x[-2 : -pad - 2 : -1] if c["__last"] else x[:0]
                    x = np.concatenate([before, x, after])
                own = batch.slice(row, 1)
                yield pa.RecordBatch.from_arrays([*(own.column(f.name) for f in rest), pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x))], names=[*(f.name for f in rest), "samples"])

    wide = lined.mapInArrow(widen, T.StructType([*rest, T.StructField("samples", T.ArrayType(T.DoubleType()))]))
    names = [c for c in blocks.columns if c != "samples"]
    if by is None:
        return wide.select(*names, "samples")
    forward = _pass(materialize(wide, "wide"), keys, by, "samples", False)
    backward = _pass(materialize(forward, "forward"), keys, by, "samples", True)
    pad = F.least(F.lit(3 * (len(by.gain) + 1)).cast("long"), F.col("n") - 1)
    before, after = (F.when(F.col(c), pad).otherwise(0) for c in ("__first", "__last"))
    own = F.slice("samples", (before + 1).cast("int"), (F.size("samples") - before - after).cast("int"))
    return backward.select(*names, F.when(F.col("n") > 1, own).otherwise(F.col("samples")).alias("samples"))


def onset(blocks: DataFrame, keys: list[str], short: int, long: int, on: float) -> DataFrame:
    """keys, onset (the first sample of the trace where the short-term to long-term energy ratio exceeds on, null if none does) and
    top_ratio, as signal.onset of the whole trace: each block is held against the long window's samples before it."""
    edge = F.slice("samples", F.greatest(F.size("samples") - (long - 1) + 1, F.lit(1)), F.lit(max(long - 1, 1))) if long > 1 else F.slice("samples", 1, 0)
    halo = blocks.select(*keys, (F.col("block") + 1).alias("block"), edge.alias("__halo"))
    joined = blocks.join(halo, [*keys, "block"], "left")
    enough = (F.col("block") == 0) | (F.size("__halo") == long - 1)
    before = F.when(enough, F.coalesce("__halo", F.slice("samples", 1, 0))).otherwise(F.raise_error(F.lit("a block is shorter than the long window")))
    rows = joined.withColumn("__halo", before)
    own = rows.select(*keys, "at", F.size("__halo").alias("__h"), signal.onset(F.concat("__halo", "samples"), short, long, on).alias("o"))
    return own.groupBy(*keys).agg(F.min(F.col("o.onset") + F.col("at") - F.col("__h")).alias("onset"), F.max("o.top_ratio").alias("top_ratio"))


def windows(blocks: DataFrame, keys: list[str], size: int, step: int, tolerance: int = 0) -> DataFrame:
    """keys, w_idx, window as signal.sliding_windows of the whole trace: blocks give the windows they touch their pieces."""
    stop = F.col("at") + F.size("samples")
    last = F.greatest(F.ceil((F.col("n") - size) / step), F.lit(0))
    first = F.greatest(F.ceil((F.col("at") - size + 1) / step), F.lit(0))
    touched = F.least(F.floor((stop - 1) / step), last)
    rows = blocks.where((F.col("n") >= size - tolerance) & (first <= touched)).select("*", F.explode(F.sequence(first.cast("long"), touched.cast("long"))).alias("w_idx"))
    begin = F.greatest(F.col("w_idx") * step, F.col("at"))
    end = F.least(F.col("w_idx") * step + size, stop)
    pieces = rows.where(begin < end).select(*keys, "w_idx", F.struct("at", F.slice("samples", (begin - F.col("at") + 1).cast("int"), (end - begin).cast("int")).alias("x")).alias("p"))
    held = pieces.groupBy(*keys, "w_idx").agg(F.flatten(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["x"])).alias("w"))  # size samples at most
    held = held.where(F.size("w") >= size - tolerance)
    return held.select(*keys, F.col("w_idx").cast("int").alias("w_idx"), F.concat("w", F.array_repeat(F.lit(0.0), F.lit(size) - F.size("w"))).alias("window"))
