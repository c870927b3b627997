"""Benchmark decontamination by SimHash windows and multi-index Hamming blocks.

Words are ASCII-lower-cased, punctuation separates them, and five in a row make a
shingle, weighted by how often it occurs. Items are indexed by their number of
shingles and by each 16-bit block of their 64-bit SimHash. For each of these
sizes, windows of a document of that size are fingerprinted, and each block of a
window fetches the items whose block is within RADIUS / 4 bits of it; by the
pigeonhole principle that finds every item within RADIUS. The whole distance is
taken of the items fetched, and the weighted Jaccard similarity of the shingles,
computed exactly, decides. A window without any shingle of an item of its size has
similarity 0 to all of them; such windows are not fingerprinted, which changes
speed only.

A document shorter than an item is one window. Null and empty texts match
nothing; items of fewer words than a shingle are one shingle, items without words
or with a null id are ignored. Ids keep their type; of items with the same id the
best window counts, and of equally similar windows the first. Rows of documents
are judged one by one, whole texts of any length, so repeated rows and null ids
are fine. A column named matches is replaced, further ones stay.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quakeframe.llm.words import mix64, shingle_hashes, slices, word_hashes
from quakeframe.session import materialize

SHINGLE = 5
SIMILARITY = 0.8
#: Expected distance at a similarity of 0.8 is about 9.6 of 64 bits.
RADIUS = 20
BLOCKS = 4
#: Items (and their shingles) that are broadcast and held in memory at once; a larger benchmark runs in parts of that size, one after the other.
PART_ITEMS, PART_SHINGLES = 20_000, 4_000_000
FILTER_BITS = 24
#: Windows that are compared at a time.
STEP_WINDOWS = 4096


def _bits(shingles: np.ndarray) -> np.ndarray:
    """+1 or -1 for each bit of each shingle's second hash."""
    h = mix64(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    return np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32) * 2 - 1


def _pack(sums: np.ndarray) -> np.ndarray:
    """Fingerprints of rows of 64 sums."""
    return np.packbits(sums > 0, axis=1).view(np.uint64).ravel()


def simhash(shingles: np.ndarray) -> int:
    return int(_pack(_bits(shingles).sum(axis=0, keepdims=True))[0]) if len(shingles) else 0


def weighted_jaccard(a: Counter, b: Counter) -> float:
    both = sum(min(n, b[x]) for x, n in a.items())
    return both / max(1, sum(a.values()) + sum(b.values()) - both)


def _near() -> np.ndarray:
    """near[v]: whether v has at most RADIUS / BLOCKS of 16 bits set."""
    near = np.zeros(1 << 16, bool)
    for n in range(RADIUS // BLOCKS + 1):
        for at in combinations(range(16), n):
            near[sum(1 << b for b in at)] = True
    return near


NEAR = _near()


def _slot(shingles: np.ndarray) -> np.ndarray:
    return (shingles & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)


@dataclass
class SizeIndex:
    """Items of one size: for each block, its values among the items and the items of each value."""

    items: np.ndarray
    prints: np.ndarray
    values: list[np.ndarray] = field(init=False)
    posted: list[list[np.ndarray]] = field(init=False)

    def __post_init__(self):
        self.values, self.posted = [], []
        for own in self.prints.view(np.uint16).reshape(-1, BLOCKS).T:
            values, back = np.unique(own, return_inverse=True)
            order = np.argsort(back, kind="stable")
            self.values.append(values)
            self.posted.append(np.split(order, np.cumsum(np.bincount(back))[:-1]))

    def fetch(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the windows, and of the items that a block of theirs fetches and that lie within RADIUS."""
        found = np.zeros((len(prints), len(self.items)), bool)
        for own, values, posted in zip(prints.view(np.uint16).reshape(-1, BLOCKS).T, self.values, self.posted, strict=True):
            asked, back = np.unique(own, return_inverse=True)
            for k, value in enumerate(values):
                hit = NEAR[asked ^ value]
                if hit.any():
                    found[np.ix_(np.nonzero(hit[back])[0], posted[k])] = True
        window, item = np.nonzero(found)
        close = np.bitwise_count(prints[window] ^ self.prints[item]) <= RADIUS
        return window[close], item[close]


@dataclass
class Benchmark:
    """Items by their shingles. One part of a benchmark is bounded by PART_ITEMS and PART_SHINGLES."""

    ids: list
    shingles: list[np.ndarray]

    def __post_init__(self):
        prints = np.array([simhash(s) for s in self.shingles], np.uint64)
        size = np.array([len(s) for s in self.shingles], np.int64)
        self.counts = [Counter(s.tolist()) for s in self.shingles]
        self.sizes = {int(n): SizeIndex(np.nonzero(size == n)[0], prints[size == n]) for n in np.unique(size)}
        pairs = np.unique(np.stack([np.concatenate([*self.shingles, np.zeros(0, np.uint64)]), np.repeat(size, size).astype(np.uint64)], axis=1), axis=0)
        self.known, self.known_size = pairs[:, 0], pairs[:, 1].astype(np.int64)  # each shingle with the sizes of its items
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[_slot(self.known)] = True

    def matches(self, shingles: np.ndarray) -> dict[int, tuple[int, float]]:
        """For each item that is found in one document's shingles: first word and similarity of its best window."""
        maybe = np.nonzero(self.filter[_slot(shingles)])[0]
        low, high = (np.searchsorted(self.known, shingles[maybe], side) for side in ("left", "right"))
        owned = high > low
        hits: dict[int, list[int]] = {}
        for at, a, b in zip(maybe[owned].tolist(), low[owned].tolist(), high[owned].tolist(), strict=True):
            for n in self.known_size[a:b].tolist():
                hits.setdefault(n, []).append(at)
        out: dict[int, tuple[int, float]] = {}
        for n, places in hits.items():
            size = min(n, len(shingles))
            covered = np.zeros(len(shingles) - size + 2, np.int64)  # window starts that hold a hit
            at = np.array(places)
            np.add.at(covered, np.maximum(0, at - size + 1), 1)
            np.add.at(covered, np.minimum(at, len(shingles) - size) + 1, -1)
            starts = np.nonzero(np.cumsum(covered[:-1]) > 0)[0]
            for run in np.split(starts, np.nonzero(np.diff(starts) > 1)[0] + 1):
                for a in range(0, len(run), STEP_WINDOWS):
                    self._windows(shingles, run[a : a + STEP_WINDOWS], size, self.sizes[n], out)
        return out

    def _windows(self, shingles: np.ndarray, starts: np.ndarray, size: int, index: SizeIndex, out: dict[int, tuple[int, float]]) -> None:
        """Consecutive windows of one size against the items of that size."""
        own = shingles[starts[0] : starts[-1] + size]
        total = np.vstack([np.zeros((1, 64), np.int32), np.cumsum(_bits(own), axis=0)])
        for window, k in zip(*(x.tolist() for x in index.fetch(_pack(total[size:] - total[:-size]))), strict=True):
            item = int(index.items[k])
            alike = weighted_jaccard(Counter(own[window : window + size].tolist()), self.counts[item])
            if alike >= SIMILARITY and (item not in out or alike > out[item][1]):
                out[item] = (int(starts[0]) + window, alike)


def _parts_of(benchmark: DataFrame) -> Iterator[Benchmark]:
    """The items in parts of bounded size, in the order of their ids; one part at a time is on the driver."""
    rows = benchmark.select("item_id", "text").where("item_id is not null and text is not null").orderBy("item_id", "text")
    ids, shingles, total = [], [], 0
    for item, text in rows.toLocalIterator():
        got = shingle_hashes(*word_hashes(pa.array([text]), punctuation=False), SHINGLE)[0]
        if not len(got):
            continue
        if len(ids) == PART_ITEMS or total and total + len(got) > PART_SHINGLES:
            yield Benchmark(ids, shingles)
            ids, shingles, total = [], [], 0
        ids.append(item)
        shingles.append(got)
        total += len(got)
    if ids:
        yield Benchmark(ids, shingles)


def _find_part(df: DataFrame, part: Benchmark, text: str, kind: T.ArrayType) -> DataFrame:
    """df with this part's matches after those of matches."""
    held = df.sparkSession.sparkContext.broadcast(part)
    base = [c for c in df.columns if c != "matches"]
    schema = T.StructType([df.schema[c] for c in base] + [T.StructField("matches", kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Benchmark = held.value
        for batch in batches:
            for rows in slices(batch, text):
                shingles, offsets = shingle_hashes(*word_hashes(rows.column(text), punctuation=False), SHINGLE)
                out = rows.column("matches").to_pylist()
                some = np.concatenate([[0], np.cumsum(own.filter[_slot(shingles)])])
                for k in np.nonzero(some[offsets[1:]] > some[offsets[:-1]])[0].tolist():
                    best = {m["item_id"]: m for m in out[k]}
                    for item, (at, alike) in own.matches(shingles[offsets[k] : offsets[k + 1]]).items():
                        now = best.get(own.ids[item])
                        if now is None or (alike, -at) > (now["similarity"], -now["first_word"]):
                            best[own.ids[item]] = {"item_id": own.ids[item], "first_word": at, "similarity": alike}
                    out[k] = [best[i] for i in sorted(best)]
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in base), pa.array(out, rows.column("matches").type)], names=schema.names)

    return df.select(*base, "matches").mapInArrow(run, schema)


def find(df: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """Adds matches: array of (item_id, first_word, similarity), the best window of each item found, by item_id; empty if none.

    A benchmark of more than one part takes a pass over df for each, whose rows are written in between, so that one part at a
    time is in memory."""
    key = benchmark.schema["item_id"].dataType
    kind = T.ArrayType(T.StructType([T.StructField("item_id", key), T.StructField("first_word", T.LongType()), T.StructField("similarity", T.DoubleType())]))
    out, parts = df.drop("matches").withColumn("matches", F.from_json(F.lit("[]"), kind)), _parts_of(benchmark)
    now = next(parts, None)
    while now is not None:
        out, now = _find_part(out, now, text, kind), next(parts, None)
        if now is not None:
            out = materialize(out, "matches")
    return out
