"""Words, hashes and Arrow batch helpers for operators that run Python inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

MIX = np.uint64(0x9E3779B97F4A7C15)
#: Text bytes that one step of a task handles at a time; larger Arrow batches are sliced.
STEP_BYTES = 4 << 20


def key_fold(col: str = "doc_id") -> F.Column:
    """crc32 of the id written as text, modulo 4; fold 2 is the held-out one."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % 4


def slices(batch: pa.RecordBatch, text: str = "text", most: int | None = None) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each piece has about so many bytes of text (STEP_BYTES), one row at least."""
    most = most or STEP_BYTES
    if not batch.num_rows:
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(at, to - at)
        at = to
    give_back()


@lru_cache(1)
def _libc() -> ctypes.CDLL | None:
    try:
        libc = ctypes.CDLL(None)
        return libc if hasattr(libc, "malloc_trim") else None
    except OSError:
        return None


def give_back() -> None:
    """Return freed memory to the system: Python workers live on, beside the next stage's."""
    pa.default_memory_pool().release_unused()
    if _libc() is not None:
        _libc().malloc_trim(0)


def mix64(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: each input bit reaches each output bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def split_words(text: pa.Array, punctuation: bool = True) -> tuple[pa.Array, np.ndarray]:
    """Words between ASCII white space with A-Z lower-cased, and each text's first and last + 1 word as offsets.

    punctuation=False turns ASCII punctuation to white space first. Null counts as empty.
    """
    low = pc.ascii_lower(pc.fill_null(text, ""))
    if not punctuation:
        low = pc.replace_substring_regex(low, pattern=r"[[:punct:]]+", replacement=" ")
    parts = pc.ascii_split_whitespace(low)
    flat = parts.flatten()
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    kept = np.concatenate([[0], np.cumsum(full)])
    offsets = kept[parts.offsets.to_numpy() - parts.offsets[0].as_py()]
    return flat.filter(pa.array(full)), offsets


def hash_strings(values: pa.Array) -> np.ndarray:
    """64-bit hashes, the same in every process."""
    if not len(values):
        return np.zeros(0, np.uint64)
    return pd.util.hash_array(values.to_numpy(zero_copy_only=False).astype(object), categorize=False)


def word_hashes(text: pa.Array, punctuation: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word of each text, and offsets."""
    flat, offsets = split_words(text, punctuation)
    coded = flat.dictionary_encode()
    return hash_strings(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)], offsets


def shingle_hashes(words: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's consecutive word groups of that size, in order, and offsets.

    A text of fewer words, but one at least, gives the whole sequence as one shingle.
    """
    n = np.diff(offsets)
    length = len(words)
    with np.errstate(over="ignore"):
        rolled = np.zeros(length, np.uint64)
        for j in range(size):
            rolled[: max(0, length - j)] = rolled[: max(0, length - j)] * MIX + mix64(words[j:] + np.uint64(j + 1))
        rolled = mix64(rolled + np.uint64(size))
    per = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    out = np.concatenate([[0], np.cumsum(per)])
    place = np.arange(out[-1]) - np.repeat(out[:-1], per) + np.repeat(offsets[:-1], per)
    got = rolled[place]
    with np.errstate(over="ignore"):
        for i in np.nonzero((n > 0) & (n < size))[0]:  # few: short texts
            h = np.uint64(n[i])
            for w in words[offsets[i] : offsets[i + 1]]:
                h = mix64(np.asarray(h * MIX + w))
            got[out[i]] = h
    return got, out


def sum_by_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of values between offsets; empty texts give 0."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[offsets[1:]] - total[offsets[:-1]]
