"""Large count arrays as compressed blocks of rows, and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakeframe.session import materialize

BLOCK = 1 << 13


def pack(counts: np.ndarray) -> list[tuple[int, bytes]]:
    """Number and compressed bytes of each block that isn't all 0."""
    rows = counts.reshape(-1, min(BLOCK, len(counts)))
    return [(int(k), pa.compress(rows[k].tobytes(), codec="zstd", asbytes=True)) for k in np.nonzero(rows.any(axis=1))[0]]


def unpack(data: bytes, width: int, dtype: type) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, width * np.dtype(dtype).itemsize, codec="zstd", asbytes=True), dtype)


def add_up(parts: DataFrame, width: int, dtype: type = np.int64) -> DataFrame:
    """Sums the blocks (block long, data binary) of the same number; bytes stop at 255. Tasks stream over rows and hold one sum a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data in zip(batch.column("block").to_pylist(), batch.column("data").to_pylist(), strict=True):
                got = unpack(data, width, dtype)
                if block not in sums:
                    sums[block] = got
                elif dtype is np.uint8:
                    sums[block] = np.minimum(sums[block].astype(np.uint16) + got, 255).astype(np.uint8)
                else:
                    sums[block] = sums[block] + got
        for block, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([pa.compress(total.tobytes(), codec="zstd", asbytes=True)], pa.binary())], names=["block", "data"])

    schema = "block long, data binary"
    salted = parts.select("block", "data").repartition("block", F.spark_partition_id() % 8).mapInArrow(run, schema)
    return salted.repartition("block").mapInArrow(run, schema)


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, label): nodes of the same connected component share a label, one of them.

    edges has columns a and b, of a type that has an order in which the ids are
    as good as random (hashes). Each round maps every node to the smallest of
    its neighbours and itself and contracts the edges, which shrinks the graph
    by a constant factor; each round is written to the shared folder.
    """
    left = materialize(edges.where("a <> b").distinct(), "edges")
    labels = None
    for _ in range(most_rounds):
        if left.isEmpty():
            break
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")).select("node", F.least("node", "label").alias("label")), "least")
        if labels is None:
            labels = least
        else:
            step = least.select(F.col("node").alias("label"), F.col("label").alias("next"))
            labels = materialize(labels.join(step, "label", "left").select("node", F.coalesce("next", "label").alias("label")), "labels")
        to_a, to_b = (least.select(F.col("node").alias(n), F.col("label").alias(f"to_{n}")) for n in "ab")
        moved = left.join(to_a, "a").join(to_b, "b").where("to_a <> to_b")
        left = materialize(moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "edges")
    else:
        raise RuntimeError("the components did not settle")
    if labels is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels
