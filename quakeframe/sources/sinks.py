"""Manifests, array datasets and images."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Manifest columns by dataset, fixed values.
MANIFESTS = {
    "detection": ("split", "class_name", "station_key", "file_path", "filename", "fs"),
    "regression": ("split", "station_key", "event_id", "file_path", "filename", "fs", "magnitude", "log_snr", "distance_km"),
    "risk": ("split", "risk_class", "station_key", "event_id", "file_path", "filename", "fs", "magnitude", "log_snr", "distance_km"),
    "ground_motion": (
        "split", "event_id", "station_key", "filename", "fs", "magnitude", "distance_km",
        "pga_gal_fwd", "pgv_cms_fwd", "log_pga_fwd", "log_pgv_fwd", "pga_gal_full", "pgv_cms_full", "log_pga_full", "log_pgv_full",
        "log_peak_input_vel", "log_peak_input_acc", "peak_rel_arrival_s", "peak_in_input", "arrival_s", "label_seconds", "label_truncated",
        "pick_at_floor", "max_cft", "n_masked_frac", "clipped", "response_ok", "sens_mismatch", "peak_counts",
    ),
    "forecast": ("split", "filename", "region", "start_time", "end_time", "label", "next_magnitude"),
}


def window_name(file_path: Column, station_key: Column, w_idx: Column, ext: str) -> Column:
    """Stem, station and the window's original index, which keeps the sample range recoverable."""
    stem = F.regexp_extract(file_path, r"([^/]*?)(?:\.[^./]*)?$", 1)
    digits = F.when(w_idx < 1000, F.lpad(w_idx.cast("string"), 3, "0")).otherwise(w_idx.cast("string"))
    return F.concat(stem, F.lit("_"), station_key, F.lit("_win"), digits, F.lit(f".{ext}"))


#: Times to the microsecond, which the writer's default cuts to milliseconds.
TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def write_manifest(df: DataFrame, path: str, kind: str) -> None:
    """CSV with the dataset's columns; missing ones are null."""
    have = set(df.columns)
    df.select(*(F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in MANIFESTS[kind])).write.mode("overwrite").options(**TIMES).csv(path, header=True)


def write_arrays(df: DataFrame, path: str, by: tuple[str, ...] = ("split",)) -> None:
    """Array columns as Parquet, a folder for each split."""
    df.write.mode("overwrite").partitionBy(*by).parquet(path)


def write_catalog(events: DataFrame, path: str) -> None:
    """A filtered catalog as CSV with a header, UTF-8."""
    events.write.mode("overwrite").options(**TIMES).csv(path, header=True, encoding="UTF-8")


def write_traces(traces: DataFrame, path: str) -> None:
    """Anchored traces as Parquet, a folder for each target; starttime is the cut's own, so the time of each sample stays right."""
    traces.withColumn("samples", F.col("samples").cast("array<float>")).write.mode("overwrite").partitionBy("target").parquet(path)


def png(image: np.ndarray) -> bytes:
    """An RGB image of 8-bit values (height, width, 3)."""
    height, width, _ = image.shape
    rows = np.hstack([np.zeros((height, 1), np.uint8), image.astype(np.uint8).reshape(height, -1)])

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows.tobytes())) + chunk(b"IEND", b"")


def with_png(df: DataFrame, image: str = "img", name: str = "png") -> DataFrame:
    """Adds the image column (three square matrices from 0 to 1; red, green, blue) as PNG bytes; halves go to the even number."""
    schema = df.drop(name).schema.add(name, "binary")
    kept = df.drop(name).columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [None if i is None else png(np.rint(np.moveaxis(np.array(i, float), 0, -1) * 255)) for i in batch.column(image).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(made, pa.binary())], names=[*kept, name])

    return df.drop(name).mapInArrow(run, schema)
