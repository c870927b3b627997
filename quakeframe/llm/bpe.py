"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

The text is cut by the vocabulary's pattern, each piece is written in the
byte-to-character alphabet of byte-level BPE and merged by the library's BPE
model, and token spans are mapped from bytes back to character offsets.
Decoding reverses the byte table; characters that are split over tokens come
together again because bytes are joined before they are read as UTF-8.

Null texts count as empty (0 tokens), texts of any length are encoded whole. Rows
are judged one by one and never dropped or reordered, so null and repeated ids,
repeated rows and any further columns stay, and an empty table gives none; of a
column that is named like an output column, the operator's own value remains.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quakeframe.llm.words import slices

#: Entries of a worker's piece cache, which is emptied when full; it changes speed only.
CACHE_ENTRIES = 150_000


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next free one from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table, free = {b: chr(b) for b in shown}, 0x100
    for b in range(256):
        if b not in table:
            table[b], free = chr(free), free + 1
    return [table[b] for b in range(256)]


class Codec:
    """The vocabulary of a rank file (base64 token, rank) behind the tokenizers library's BPE model."""

    def __init__(self, ranks: str, pattern: str):
        import re

        import regex

        with open(ranks, "rb") as f:
            tokens = [base64.b64decode(line.split()[0]) for line in f if line.strip()]
        self.tokens = tokens
        self.alphabet = dict(enumerate(byte_alphabet()))
        self.find = self.find_ascii = regex.compile(pattern).findall
        plain = pattern.replace(r"[^\s\p{L}\p{N}]", r"[^\sA-Za-z0-9]").replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]")
        if "\\p" not in plain:  # the same matches within ASCII, found faster
            self.find_ascii = re.compile(plain, re.ASCII).findall
        self.cache: dict[str, bytes] = {}

    @cached_property
    def model(self):
        """The merges are built on the first encoding; a worker that only decodes does without."""
        from tokenizers.models import BPE

        shown = byte_alphabet()
        vocab = {"".join(shown[b] for b in t): i for i, t in enumerate(self.tokens)}
        return BPE(vocab, self._merges(self.tokens, shown))

    @staticmethod
    def _merges(tokens: list[bytes], shown: list[str]) -> list[tuple[str, str]]:
        """The merge of each token of two or more bytes: the last two parts that lower ranks make of it."""
        rank = {t: i for i, t in enumerate(tokens)}
        merges = []
        for top, token in enumerate(tokens):
            parts = [token[i : i + 1] for i in range(len(token))]
            while len(parts) > 2:
                best = min(range(len(parts) - 1), key=lambda i: rank.get(parts[i] + parts[i + 1], top))
                if rank.get(parts[best] + parts[best + 1], top) >= top:
                    break
                parts[best : best + 2] = [parts[best] + parts[best + 1]]
            if len(parts) == 2:
                merges.append(tuple("".join(shown[b] for b in p) for p in parts))
        return merges

    def piece(self, text: str) -> bytes:
        """Ids of one pattern match, as little-endian unsigned 32-bit integers."""
        mapped = text.encode("utf-8").decode("latin-1").translate(self.alphabet)
        return array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()

    def encode(self, text: str) -> bytes:
        cache, out = self.cache, []
        for part in self.find_ascii(text) if text.isascii() else self.find(text):
            ids = cache.get(part)
            if ids is None:
                if len(cache) >= CACHE_ENTRIES:
                    cache.clear()
                ids = self.piece(part)
                if len(part) <= 40:
                    cache[part] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def offsets(self, text: str, ids: bytes) -> tuple[list[int], list[int]]:
        """First and last + 1 character of each token; a token that holds part of a character covers that character."""
        ends = np.cumsum([len(self.tokens[i]) for i in np.frombuffer(ids, "<u4").tolist()], dtype=np.int64)
        raw = np.frombuffer(text.encode("utf-8"), np.uint8)
        char = np.cumsum((raw & 0xC0) != 0x80) - 1  # the character of each byte
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
        return char[starts].tolist(), (char[ends - 1] + 1).tolist()


@lru_cache(2)
def codec(ranks: str | None, pattern: str | None) -> Codec:
    """One per worker; None stands for the public 50k vocabulary and its pattern."""
    import public_tokenizers as public

    return Codec(ranks or public.path("byte_bpe_50k.tiktoken"), pattern or public.PATTERN)


def _extended(df: DataFrame, fields: list[T.StructField]) -> T.StructType:
    new = {f.name for f in fields}
    return T.StructType([f for f in df.schema.fields if f.name not in new] + fields)


def encode(df: DataFrame, text: str = "text", ranks: str | None = None, pattern: str | None = None, with_offsets: bool = False, keep_text: bool = True) -> DataFrame:
    """Adds n_tokens (long) and ids_le (binary: ids as little-endian unsigned 32-bit integers).

    with_offsets adds token_start and token_end (arrays of int, in characters).
    keep_text=False drops the text column.
    """
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_le", T.BinaryType())]
    if with_offsets:
        fields += [T.StructField(n, T.ArrayType(T.IntegerType())) for n in ("token_start", "token_end")]
    schema = _extended(df, fields)
    if not keep_text:
        schema = T.StructType([f for f in schema.fields if f.name != text])
    kept = schema.names[: len(schema.names) - len(fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern)
        for batch in batches:
            for part in slices(batch, text):
                texts = [x or "" for x in part.column(text).to_pylist()]
                ids = [own.encode(x) for x in texts]
                cols = [part.column(n) for n in kept] + [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
                if with_offsets:
                    spans = [own.offsets(x, i) for x, i in zip(texts, ids, strict=True)]
                    cols += [pa.array([s[k] for s in spans], pa.list_(pa.int32())) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, ids: str = "ids_le", ranks: str | None = None, pattern: str | None = None, keep_ids: bool = True) -> DataFrame:
    """Adds decoded (binary): the bytes of the ids; null ids count as none."""
    fields = [T.StructField("decoded", T.BinaryType())]
    schema = _extended(df, fields)
    if not keep_ids:
        schema = T.StructType([f for f in schema.fields if f.name != ids])
    kept = schema.names[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern)
        for batch in batches:
            for part in slices(batch, ids):
                out = pa.array([own.decode(x or b"") for x in part.column(ids).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in kept), out], names=schema.names)

    return df.mapInArrow(run, schema)
