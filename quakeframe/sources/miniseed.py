"""MiniSEED records as rows, by a Python data source.

A file is read in ranges of bytes, a partition each: a range has the records that begin in it, the first of which is
found by the form of its header and of the one after it. Filters on network, station, location, channel and
starttime are applied to headers, so records that they drop are never read; with option
headers_only none is. Samples are 16- and 32-bit integers, floats, doubles,
Steim-1 and Steim-2. traces() merges records to traces with gaps.
"""

from __future__ import annotations

import io
import os
import struct
from collections.abc import Callable, Iterator
from datetime import datetime, timedelta
from typing import Any, BinaryIO

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import datasource as D
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition

SCHEMA = "file_path string, network string, station string, location string, channel string, starttime timestamp_ntz, sampling_rate double, npts int, samples array<double>"
COLUMNS = [f.split()[0] for f in SCHEMA.split(", ")]
#: Bits and count of the differences by Steim-2 code and sub-code, fixed values.
STEIM2 = {(2, 1): (30, 1), (2, 2): (15, 2), (2, 3): (10, 3), (3, 0): (6, 5), (3, 1): (5, 6), (3, 2): (4, 7)}
#: Bytes of a range of a file, bytes that the search for its first record reads at a time, and the grid on which records begin.
SPLIT_BYTES, SEARCH_BYTES, GRID = 64 << 20, 8 << 10, 64


def signed(value: int, bits: int) -> int:
    return value - (1 << bits) if value >> (bits - 1) else value


def steim(data: bytes, n: int, level: int, order: str) -> np.ndarray:
    """Samples of n from frames of 16 words; the first frame holds the first and the last sample."""
    words = struct.unpack(f"{order}{len(data) // 4}I", data[: len(data) // 4 * 4])
    gaps: list[int] = []
    first = signed(words[1], 32)
    for at in range(0, len(words) - 15, 16):
        codes = words[at]
        for k in range(1, 16):
            code = codes >> (30 - 2 * k) & 3
            if code == 0 or (at == 0 and k < 3):
                continue
            w = words[at + k]
            if code == 1:
                bits, count = 8, 4
            elif level == 1:
                bits, count = (16, 2) if code == 2 else (32, 1)
            else:
                bits, count = STEIM2.get((code, w >> 30), (0, 0))
            gaps.extend(signed(w >> bits * (count - 1 - i) & (1 << bits) - 1, bits) for i in range(count))
    return first + np.concatenate([[0], np.cumsum(gaps[1:n], dtype=np.int64)]).astype(float)


def header(head: bytes, more: Callable[[int], bytes]) -> dict | None:
    """Fields of the record header that head (64 bytes, 48 at least) begins with; None if it isn't one. more reads 8 bytes at an offset in the record."""
    if len(head) < 48 or head[6:7] not in (b"D", b"R", b"Q", b"M") or head[7:8] not in (b" ", b"\0") or not head[:6].strip(b" \0").isdigit() and head[:6].strip(b" \0"):
        return None
    order = ">" if 1900 <= struct.unpack(">H", head[20:22])[0] <= 2200 else "<"
    year, day, hour, minute, second, _, tick = struct.unpack(f"{order}HHBBBBH", head[20:30])
    if not (1900 <= year <= 2200 and 1 <= day <= 366 and hour < 24 and minute < 60 and second <= 60 and tick < 10_000):
        return None
    npts, factor, multiplier = struct.unpack(f"{order}Hhh", head[30:36])
    begin, block = struct.unpack(f"{order}HH", head[44:48])
    encoding, length, micros, seen = 11, 512, 0, 0
    while block > seen:
        own = head[block : block + 8] if block + 8 <= len(head) else more(block)
        if len(own) < 8:
            break
        kind, following = struct.unpack(f"{order}HH", own[:4])
        if kind == 1000:
            encoding, length = own[4], 1 << min(own[6], 30)
        elif kind == 1001:
            micros = struct.unpack("b", own[5:6])[0]
        seen, block = block, following
    rate = (factor if factor > 0 else -1 / factor if factor else 0.0) * (multiplier if multiplier > 0 else -1 / multiplier if multiplier else 1.0)
    start = datetime(year, 1, 1) + timedelta(days=day - 1, hours=hour, minutes=minute, seconds=second, microseconds=tick * 100 + micros)
    names = [head[a:b].decode("ascii", "replace").strip() for a, b in ((18, 20), (8, 13), (13, 15), (15, 18))]
    return {"names": names, "start": start, "rate": rate, "npts": npts, "begin": begin, "length": length, "encoding": encoding, "order": order}


def _header_at(source: BinaryIO, at: int) -> dict | None:
    def part(offset: int, size: int) -> bytes:
        source.seek(at + offset)
        return source.read(size)

    return header(part(0, 64), lambda offset: part(offset, 8))


def first_record(source: BinaryIO, at: int, end: int, size: int) -> int | None:
    """Where the first record that begins from at on, before end, does: on the grid, with a record or the file's end after it."""
    at = -(-at // GRID) * GRID
    while at < end:
        source.seek(at)
        chunk = source.read(min(end - at, SEARCH_BYTES) + 63)
        for k in range(0, min(end - at, SEARCH_BYTES), GRID):
            if chunk[k + 6 : k + 7] in (b"D", b"R", b"Q", b"M"):  # else no header begins here
                found = _header_at(source, at + k)
                after = at + k + found["length"] if found else 0
                if found and (after >= size or _header_at(source, after)):
                    return at + k
        at += SEARCH_BYTES
    return None


def samples_of(h: dict, body: bytes) -> np.ndarray:
    plain = {1: "i2", 3: "i4", 4: "f4", 5: "f8"}.get(h["encoding"])
    if plain:
        return np.frombuffer(body, f"{h['order']}{plain}", h["npts"]).astype(float)
    if h["encoding"] in (10, 11):
        return steim(body, h["npts"], h["encoding"] - 9, h["order"])
    raise ValueError(f"encoding {h['encoding']}")


def records(data: bytes | BinaryIO, headers_only: bool = False, start: int = 0, end: int | None = None, size: int | None = None, wanted: Callable[[dict], bool] | None = None) -> Iterator[tuple]:
    """(network, station, location, channel, start, rate, npts, samples or None) of each record that begins from start on and before end.

    Of a file, only the headers of records that aren't wanted, or with headers_only of all, are read. size is the file's, where start isn't 0.
    """
    source = io.BytesIO(data) if isinstance(data, bytes) else data
    at: int | None = start
    if start:
        at = first_record(source, start, end if end is not None else size or 0, size or 0)
    while at is not None and (end is None or at < end):
        h = _header_at(source, at)
        if h is None:
            break
        if wanted is None or wanted(h):
            samples = None
            if not headers_only and h["npts"]:
                source.seek(at + h["begin"])
                samples = samples_of(h, source.read(h["length"] - h["begin"])).tolist()
            yield (*h["names"], h["start"], h["rate"], h["npts"], samples)
        at += h["length"]


def read(spark: SparkSession, path: str, headers_only: bool = False) -> DataFrame:
    """Records of all files under path; bytes come by Spark's own reader, so any store does."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.mseed").option("recursiveFileLookup", "true").load(path).select("path", "content")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                rows = [(name, *r) for r in records(content, headers_only)]
                if rows:
                    cols = list(zip(*rows, strict=True))
                    types = [pa.string()] * 5 + [pa.timestamp("us"), pa.float64(), pa.int32(), pa.list_(pa.float64())]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=COLUMNS)

    return files.mapInArrow(run, SCHEMA)


def file_system(path: str) -> tuple[Any, str]:
    """The file system of a path or URI, and the path in it; local files also as Hadoop writes them, file:/path."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path if "://" in path else os.path.abspath(path))


class FileRange(InputPartition):
    def __init__(self, path: str, start: int, end: int, size: int):
        super().__init__((path, start, end, size))


class MiniSeedSource(DataSource):
    """spark.read.format("miniseed") and df.write.format("miniseed"), after spark.dataSource.register(MiniSeedSource).

    Paths are local or URIs of a store that executors reach. Options to read: headers_only, split_bytes, and push_filters, which
    Spark takes only where spark.sql.python.filterPushdown.enabled is true (scan() sets it there). Options to write: encoding,
    record_bytes (see sources.miniseed_sink).
    """

    @classmethod
    def name(cls) -> str:
        return "miniseed"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return (FilteringReader if self.options.get("push_filters", "false").lower() == "true" else MiniSeedReader)(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        from quakeframe.sources.miniseed_sink import MiniSeedWriter

        return MiniSeedWriter(self.options, overwrite)


def scan(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Records of the files under path by the data source, whose filters reach the headers where the session allows it."""
    spark.dataSource.register(MiniSeedSource)
    push = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    return spark.read.format("miniseed").options(**({"push_filters": push} | options)).load(path)


class MiniSeedReader(DataSourceReader):
    """Records of ranges of files, of those headers that pass the filters, which only a FilteringReader is given."""

    #: What a filter says of a header's value.
    TESTS = {D.EqualTo: lambda v, x: v == x, D.GreaterThan: lambda v, x: v > x, D.GreaterThanOrEqual: lambda v, x: v >= x, D.LessThan: lambda v, x: v < x, D.LessThanOrEqual: lambda v, x: v <= x, D.In: lambda v, x: v in x, D.StringStartsWith: lambda v, x: v.startswith(x)}
    FIELDS = ("network", "station", "location", "channel")

    def __init__(self, options: dict):
        self.path, self.headers_only = options["path"], options.get("headers_only", "false").lower() == "true"
        self.split_bytes = int(options.get("split_bytes", SPLIT_BYTES))
        self.filters: list[tuple[str, type, Any]] = []

    def wanted(self, h: dict) -> bool:
        values = dict(zip(self.FIELDS, h["names"], strict=True)) | {"starttime": h["start"]}
        return all(self.TESTS[kind](values[column], value) for column, kind, value in self.filters)

    def partitions(self) -> list[FileRange]:
        from pyarrow import fs

        system, root = file_system(self.path)
        info = system.get_file_info(root)
        found = [info] if info.is_file else [f for f in system.get_file_info(fs.FileSelector(root, recursive=True)) if f.is_file and f.path.endswith(".mseed")]
        return [FileRange(f.path, at, min(at + self.split_bytes, f.size), f.size) for f in sorted(found, key=lambda f: f.path) for at in range(0, f.size, self.split_bytes)]

    def opened(self, path: str) -> BinaryIO:
        return file_system(self.path)[0].open_input_file(path)

    def read(self, partition: FileRange) -> Iterator[tuple]:
        path, start, end, size = partition.value
        with self.opened(path) as f:
            for r in records(f, self.headers_only, start, end, size, self.wanted if self.filters else None):
                yield (path, *r)


class FilteringReader(MiniSeedReader):
    def pushFilters(self, filters: list[D.Filter]) -> Iterator[D.Filter]:
        for f in filters:
            column = getattr(f, "attribute", ("",))[0]
            value = getattr(f, "value", None)
            known = column in self.FIELDS and (isinstance(value, (str, tuple, list))) or column == "starttime" and isinstance(value, datetime) and value.tzinfo is None
            if type(f) in self.TESTS and known and not (column != "starttime" and type(f) is D.StringStartsWith and not isinstance(value, str)):
                self.filters.append((column, type(f), value))
            elif not (isinstance(f, D.IsNotNull) and column in (*self.FIELDS, "starttime")):  # headers have no nulls
                yield f


def traces(rows: DataFrame) -> DataFrame:
    """One row a file, station and component: samples with gaps interpolated, and gap_mask.

    Records are placed on the grid of the first one; overlaps keep the later
    record. A gap is filled along a line; with fewer than two samples it is 0.
    """
    by = ["file_path", "network", "station", "location", "channel"]
    grouped = rows.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("starttime", "sampling_rate", "npts", "samples"))).alias("r"))  # a file's own records

    def merge(batches):
        import pyarrow as pa

        for batch in batches:
            start, rate, values, mask = [], [], [], []
            for parts in batch.column("r").to_pylist():
                fs, t0 = parts[0]["sampling_rate"], parts[0]["starttime"]
                offset = [round((p["starttime"] - t0).total_seconds() * fs) for p in parts]
                x = np.full(max(o + p["npts"] for o, p in zip(offset, parts, strict=True)), np.nan)
                for o, p in zip(offset, parts, strict=True):
                    x[o : o + p["npts"]] = p["samples"]
                gap = np.isnan(x)
                at = np.nonzero(~gap)[0]
                x[gap] = np.interp(np.nonzero(gap)[0], at, x[at]) if len(at) >= 2 else 0.0
                start.append(t0)
                rate.append(fs)
                values.append(x.tolist())
                mask.append(gap.tolist())
            new = [pa.array(start, pa.timestamp("us")), pa.array(rate, pa.float64()), pa.array([len(v) for v in values], pa.int32()), pa.array(values, pa.list_(pa.float64())), pa.array(mask, pa.list_(pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in by), *new], names=[*by, "starttime", "sampling_rate", "npts", "samples", "gap_mask"])

    head = ", ".join(f"{c} string" for c in by)
    return grouped.mapInArrow(merge, f"{head}, starttime timestamp_ntz, sampling_rate double, npts int, samples array<double>, gap_mask array<boolean>")
