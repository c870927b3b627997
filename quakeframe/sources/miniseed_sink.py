"""Traces as MiniSEED files: one file a task, written aside and moved in place when all tasks have ended.

A row (network, station, location, channel, starttime, sampling_rate, samples) becomes a run of records. Whole numbers are
coded as Steim-2 differences, or as 32-bit integers where a difference needs more than 30 bits, other values as
doubles; option encoding (steim1, steim2, int32, float32, float64) fixes one. A null or empty samples array has no records.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta
from fractions import Fraction

import numpy as np
from pyspark.sql import Row
from pyspark.sql.datasource import DataSourceWriter, WriterCommitMessage

from quakeframe.sources.miniseed import file_system

ENCODINGS = {"int32": (3, ">i4"), "float32": (4, ">f4"), "float64": (5, ">f8"), "steim1": (10, ""), "steim2": (11, "")}
#: Differences of a word, bits of each, code and sub-code (None: none), most differences first; fixed values.
PACKINGS = {
    "steim1": ((4, 8, 1, None), (2, 16, 2, None), (1, 32, 3, None)),
    "steim2": ((7, 4, 3, 2), (6, 5, 3, 1), (5, 6, 3, 0), (4, 8, 1, None), (3, 10, 2, 3), (2, 15, 2, 2), (1, 30, 2, 1)),
}
WORDS = 16  # of a frame, the first of which has the codes of the others


def _runs_that_fit(gaps: np.ndarray, kind: str) -> np.ndarray:
    """The place in PACKINGS of the packing that takes the most differences from each one on; -1 where none does."""
    size = np.where(gaps < 0, ~gaps, gaps)
    best = np.full(len(gaps), -1)
    for k in range(len(PACKINGS[kind]) - 1, -1, -1):
        count, bits, _, _ = PACKINGS[kind][k]
        fits = size < 1 << (bits - 1)
        if len(gaps) >= count:
            whole = np.lib.stride_tricks.sliding_window_view(fits, count).all(axis=1)
            best[: len(whole)][whole] = k
    return best


def steim_records(x: np.ndarray, kind: str, frames: int) -> Iterator[tuple[int, int, bytes]]:
    """(first sample, samples, frames) of each record of so many frames at most; raises ValueError where a difference has too many bits."""
    gaps = np.diff(x, prepend=x[:1])
    best = _runs_that_fit(gaps, kind)
    at, n = 0, len(x)
    while at < n:
        first, codes, words = at, [], []
        while at < n and len(words) < frames * (WORDS - 1) - 2:
            k = best[at]
            if k < 0:
                raise ValueError(f"a difference of {gaps[at]} doesn't fit {kind}")
            count, bits, code, sub = PACKINGS[kind][k]
            word = 0
            for v in gaps[at : at + count].tolist():
                word = word << bits | v & (1 << bits) - 1
            codes.append(code)
            words.append(word if sub is None else word | sub << 30)
            at += count
        codes, words = [0, 0, *codes], [int(x[first]) & 0xFFFFFFFF, int(x[at - 1]) & 0xFFFFFFFF, *words]
        out = []
        for k in range(0, len(words), WORDS - 1):
            own = [*codes[k : k + WORDS - 1], *[0] * (WORDS - 1)][: WORDS - 1]
            out += [sum(c << (28 - 2 * j) for j, c in enumerate(own)), *[*words[k : k + WORDS - 1], *[0] * (WORDS - 1)][: WORDS - 1]]
        yield first, at - first, struct.pack(f">{len(out)}I", *out)


def rate_fields(rate: float) -> tuple[int, int]:
    """Factor and multiplier of a sampling rate."""
    if rate <= 0:
        raise ValueError(f"sampling rate {rate}")
    near = Fraction(rate).limit_denominator(32_767)
    if near.numerator > 32_767 or not near.numerator:
        raise ValueError(f"sampling rate {rate}")
    return (near.numerator, 1) if near.denominator == 1 else (-near.denominator, 1) if near.numerator == 1 else (near.numerator, -near.denominator)


def record(names: list[str], start: datetime, rate: float, npts: int, number: int, encoding: int, length: int, body: bytes) -> bytes:
    """One record with blockettes 1000 and 1001."""
    network, station, location, channel = (n or "" for n in names)
    micros = start.microsecond
    tick, left = divmod(micros, 100)
    year = start.timetuple()
    head = struct.pack(">6scc5s2s3s2s", f"{number % 1_000_000:06d}".encode(), b"D", b" ", f"{station:<5}".encode()[:5], f"{location:<2}".encode()[:2], f"{channel:<3}".encode()[:3], f"{network:<2}".encode()[:2])
    head += struct.pack(">HHBBBBH", year.tm_year, year.tm_yday, year.tm_hour, year.tm_min, year.tm_sec, 0, tick)
    head += struct.pack(">HhhBBBBiHH", npts, *rate_fields(rate), 0, 0, 0, 2, 0, 64, 48)
    head += struct.pack(">HHBBBB", 1000, 56, encoding, 1, length.bit_length() - 1, 0) + struct.pack(">HHBbBB", 1001, 0, 0, left, 0, 0)
    return (head + body).ljust(length, b"\0")


def coded(names: list[str], start: datetime, rate: float, samples: list[float], encoding: str = "auto", record_bytes: int = 4096) -> Iterator[bytes]:
    """The records of a trace."""
    if record_bytes < 128 or record_bytes & (record_bytes - 1):
        raise ValueError("a record has a power of two bytes, 128 at least")
    x = np.asarray(samples, float)
    if not len(x):
        return
    room = record_bytes - 64
    kinds = [encoding]
    if encoding == "auto":
        whole = np.isfinite(x).all() and (x == np.floor(x)).all() and np.abs(x).max() < 1 << 31
        kinds = ["steim2", "int32"] if whole else ["float64"]
    for kind in kinds:
        number, form = ENCODINGS[kind]
        try:
            if form:
                each = room // np.dtype(form).itemsize
                parts = [(a, len(x[a : a + each]), x[a : a + each].astype(form).tobytes()) for a in range(0, len(x), each)]
            else:
                parts = list(steim_records(x.astype(np.int64), kind, room // (4 * WORDS)))
            break
        except ValueError:
            if kind == kinds[-1]:
                raise
    for k, (first, npts, body) in enumerate(parts):
        at = start + timedelta(microseconds=round(first / rate * 1_000_000))
        yield record(names, at, rate, npts, k + 1, number, record_bytes, body)


@dataclass
class Written(WriterCommitMessage):
    """A task's file, where it lies and where it goes, and its bytes."""

    aside: str
    name: str
    size: int


class MiniSeedWriter(DataSourceWriter):
    """Files are written to a folder beside the data, which readers skip, and moved by the driver once all tasks have ended; a job
    that fails leaves neither files nor the folder, and what a lost attempt of a task has written goes with it."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.encoding, self.record_bytes = options.get("encoding", "auto"), int(options.get("record_bytes", 4096))
        self.folder = f"_writing-{uuid.uuid4().hex}"
        if self.encoding != "auto" and self.encoding not in ENCODINGS:
            raise ValueError(f"encoding is auto or one of {sorted(ENCODINGS)}")

    def _places(self):
        system, root = file_system(self.path)
        return system, root.rstrip("/"), f"{root.rstrip('/')}/{self.folder}"

    def write(self, iterator: Iterator[Row]) -> Written:
        from pyspark import TaskContext

        system, _, aside = self._places()
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex[:12]}.mseed"
        system.create_dir(aside, recursive=True)
        size = 0
        with system.open_output_stream(f"{aside}/{name}") as out:
            for row in iterator:
                if row["samples"]:
                    for made in coded([row[c] for c in ("network", "station", "location", "channel")], row["starttime"], row["sampling_rate"], row["samples"], self.encoding, self.record_bytes):
                        out.write(made)
                        size += len(made)
        return Written(f"{aside}/{name}", name, size)

    def commit(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        system, root, aside = self._places()
        system.create_dir(root, recursive=True)
        old = [f.path for f in system.get_file_info(fs.FileSelector(root)) if f.is_file and f.path.endswith(".mseed")] if self.overwrite else []
        for m in messages:
            if m is not None and m.size:
                system.move(m.aside, f"{root}/{m.name}")
        for path in old:
            system.delete_file(path)
        self._clear(system, aside)

    def abort(self, messages: list[Written | None]) -> None:
        system, _, aside = self._places()
        self._clear(system, aside)

    @staticmethod
    def _clear(system, aside: str) -> None:
        from pyarrow import fs

        if system.get_file_info(aside).type == fs.FileType.Directory:
            system.delete_dir(aside)
