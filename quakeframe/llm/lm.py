"""Language-model scoring by cross-entropy difference.

A target model and a background model of the same form and over one vocabulary,
all words of the corpus: bigrams with absolute discounting, p(w | c) = (max(n(c, w) -
DISCOUNT, 0) + DISCOUNT T(c) p(w)) / n(c), where T(c) is the number of distinct words after c, over
unigrams p(w) = (n(w) + 1) / (n + size), which stand alone after contexts that have no count. A
document's score is its loss per token under the target model less that under the
background model; low scores look like the target. Each document is left out of the
models that score it: its own counts, and the successors that it alone has, are taken from the background's, and from the
target's if it is a target row, so that it isn't told by having been counted. A
document that occurs twice is met by its other copy.

All counts are of real words and pairs (64-bit hashes), cover every row and grow
with the input; only totals reach the driver. Documents are cut into slices of
bounded size. A slice asks each hash shard for the counts of its distinct words,
contexts and pairs, once a slice however often they occur in it, and sends its own
counts along. The shard adds them up over all slices and answers in the slice's
order, and names one slice the owner of each pair. In a second, smaller round the slices send the shards of their contexts
how many pairs of each they own, which add up to its successors. Then the slice's documents are scored from the answers. A
frequent word or pair is one number a slice, so no shard holds more than its share.

Null and empty texts have no tokens, losses of 0 and score 0. Null and repeated
ids are fine, as rows are scored one by one and every row counts; a text of any
length is scored whole. Ties don't arise. Without target rows the target model is
uniform, an empty table gives none. Columns named like an output column are
replaced, further ones stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quakeframe.llm.words import MIX, give_back, mix64, slices, sum_by_text, word_hashes
from quakeframe.session import materialize

#: What each seen pair gives to the unigrams behind it.
DISCOUNT = 0.75
#: Text of a slice, and tokens of a shard.
SLICE_BYTES, SHARD_TOKENS = 6 << 20, 2_000_000
#: The fewest shards.
SHARDS = 64
NAMES = ("n_tokens", "target_loss", "background_loss", "score")
START, CONTEXT, WORD = (np.uint64(x) for x in (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0))


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(",")]


def pack(values: np.ndarray) -> bytes:
    """64-bit integers, byte planes one after the other, compressed."""
    return pa.compress(values.astype("<i8" if values.dtype.kind == "i" else "<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), codec="zstd", asbytes=True) if len(values) else b""


def unpack(data: bytes, n: int, kind: str = "<i8") -> np.ndarray:
    if not n:
        return np.zeros(0, kind)
    return np.frombuffer(pa.decompress(data, 8 * n, codec="zstd", asbytes=True), np.uint8).reshape(8, n).T.copy().view(kind).ravel()


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Grows with the key, so that sorted keys are sorted by shard."""
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


class Grams:
    """Keys of a slice's distinct pairs, contexts and words, in order, and the place of each token's pair, context and word among them."""

    def __init__(self, words: np.ndarray, tokens: np.ndarray, offsets: np.ndarray):
        m = len(words)
        before = np.full(len(tokens), m)
        before[1:] = tokens[:-1]
        before[offsets[:-1][np.diff(offsets) > 0]] = m
        codes, back = np.unique(before * max(m, 1) + tokens, return_inverse=True)
        hashes = np.append(words, START)
        with np.errstate(over="ignore"):
            pairs = mix64(mix64(hashes[codes // max(m, 1)]) * MIX + hashes[codes % max(m, 1)])
        keys = np.concatenate([pairs, mix64(hashes ^ CONTEXT), mix64(words ^ WORD)])
        order = np.argsort(keys, kind="stable")
        place = np.empty(len(keys), np.int64)
        place[order] = np.arange(len(keys))
        self.keys, self.is_word = keys[order], (order >= len(codes) + m + 1).astype(np.int64)
        self.is_context = (order >= len(codes)) & (order < len(codes) + m + 1)
        self.pairs, self.contexts = place[: len(codes)], place[len(codes) + codes // max(m, 1)]  # places of each distinct pair and its context
        self.places = [place[back], place[len(codes) + before], place[len(codes) + m + 1 + tokens]]

    def counts(self, mark: np.ndarray | None = None) -> np.ndarray:
        """How often each key occurs, at the marked tokens."""
        return sum(np.bincount(p if mark is None else p[mark], minlength=len(self.keys)) for p in self.places)


def cut(df: DataFrame, text: str, target: str, kept: list[str]) -> DataFrame:
    """Slices: slice, n_rows, n_words, n_tokens, n_target, rows (kept columns and target), marks (target alone), words, tokens, lengths."""
    fields = [*kept, target]

    def stream(batch: pa.RecordBatch) -> bytes:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(batch)
        return sink.getvalue().to_pybytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, text, SLICE_BYTES):
                words, offsets = word_hashes(part.column(text), punctuation=False)
                own, tokens = np.unique(words, return_inverse=True)
                length = np.diff(offsets)
                mark = np.repeat(part.column(target).to_numpy(zero_copy_only=False).astype(bool), length)
                numbers = [number, part.num_rows, len(own), len(words), int(mark.sum())]
                blobs = [stream(part.select(fields)), stream(part.select([target])), pack(own), pack(tokens.astype(np.int64)), pack(length.astype(np.int64))]
                yield pa.RecordBatch.from_arrays([*(pa.array([x], pa.int64()) for x in numbers), *(pa.array([x], pa.binary()) for x in blobs)], names=names)
                number += 1

    schema = "slice long, n_rows long, n_words long, n_tokens long, n_target long, rows binary, marks binary, words binary, tokens binary, lengths binary"
    names = _names(schema)
    return df.select(*kept, text, target).mapInArrow(run, schema)


def _held(row: dict, target: str) -> tuple[pa.RecordBatch, Grams, np.ndarray, np.ndarray]:
    """Rows of a slice, its grams, offsets, and which tokens are of target rows."""
    with pa.ipc.open_stream(row["rows"]) as stream:
        rows = stream.read_next_batch()
    own = unpack(row["words"], row["n_words"], "<u8")
    lengths = unpack(row["lengths"], row["n_rows"])
    mark = np.repeat(rows.column(target).to_numpy(zero_copy_only=False).astype(bool), lengths)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    return rows, Grams(own, unpack(row["tokens"], row["n_tokens"]), offsets), offsets, mark


def _dealt(number: int, shards: int, keys: np.ndarray, *values: np.ndarray) -> list[pa.Array]:
    """Columns shard, slice, n, keys and values, a row for each shard that has some of the sorted keys."""
    edges = np.searchsorted(shard_of(keys, shards), np.arange(shards + 1))
    full = np.nonzero(np.diff(edges))[0]
    cuts = [slice(edges[s], edges[s + 1]) for s in full]
    columns = [pa.array(full, pa.int64()), pa.array([number] * len(full), pa.int64()), pa.array([c.stop - c.start for c in cuts], pa.int64())]
    return columns + [pa.array([pack(x[c]) for c in cuts], pa.binary()) for x in (keys, *values)]


def asks(cut_up: DataFrame, shards: int, target: str) -> DataFrame:
    """For each slice and shard: n keys in order, the times of each in all rows and in target rows, and words among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                _, grams, _, mark = _held(row, target)
                keys, every, marked, word = grams.keys, grams.counts(), grams.counts(mark), grams.is_word
                columns = _dealt(row["slice"], shards, keys, every, marked, word)
                del grams, keys, every, marked, word
                give_back()
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "shard long, slice long, n long, keys binary, every binary, marked binary, word binary"
    names = _names(schema)
    return cut_up.mapInArrow(run, schema)


def _runs(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[list[dict]]:
    """Rows of the same value, which come one after the other."""
    held: list[dict] = []
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            if held and held[0][column] != row[column]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def answers(asked: DataFrame) -> DataFrame:
    """For each slice and shard: the times of each of its n keys over all slices, and which of them the slice owns (bit 1: as the
    first that has the key, bit 2: as the first that has it in target rows); size: distinct words, once a shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, "shard"):
            keys, back = np.unique(np.concatenate([unpack(r["keys"], r["n"], "<u8") for r in rows]), return_inverse=True)
            total = np.zeros((2, len(keys)), np.int64)
            is_word, seen, owned = np.zeros(len(keys), bool), np.zeros(len(keys), np.uint8), []
            at = np.concatenate([[0], np.cumsum([r["n"] for r in rows])])
            for k, r in enumerate(rows):  # a slice's keys are distinct
                own = back[at[k] : at[k + 1]]
                total[0, own] += unpack(r["every"], r["n"])
                marked = unpack(r["marked"], r["n"])
                total[1, own] += marked
                is_word[own] |= unpack(r["word"], r["n"]) > 0
                new = (1 + 2 * (marked > 0)).astype(np.uint8) & ~seen[own]
                seen[own] |= new
                owned.append(pa.compress(new.tobytes(), codec="zstd", asbytes=True))
            del keys
            for k, r in enumerate(rows):
                own = back[at[k] : at[k + 1]]
                size = int(is_word.sum()) if k == 0 else 0
                yield pa.RecordBatch.from_arrays([*(pa.array([x], pa.int64()) for x in (r["slice"], r["shard"], r["n"], size)), *(pa.array([x], pa.binary()) for x in (*(pack(t[own]) for t in total), owned[k]))], names=names)
            del back, total, is_word, seen, owned, rows
            give_back()

    schema = "slice long, shard long, n long, size long, every binary, marked binary, owned binary"
    names = _names(schema)
    return asked.repartition("shard").sortWithinPartitions("shard", "slice").mapInArrow(run, schema)


def by_slice(cut_up: DataFrame, *rounds: DataFrame) -> DataFrame:
    """Each slice's own row (turn -1), then its answers of each round (turn 0, 1) by shard, one after the other in one task."""
    both = cut_up.withColumns({"turn": F.lit(-1), "shard": F.lit(-1).cast("long")})
    for k, answered in enumerate(rounds):
        both = both.unionByName(answered.withColumn("turn", F.lit(k)), allowMissingColumns=True)
    return both.repartition("slice").sortWithinPartitions("slice", "turn", "shard")


def _joined(rows: list[dict], turn: int, column: str) -> np.ndarray:
    """A slice's answers of a round in the order of its keys."""
    return np.concatenate([np.zeros(0, np.int64), *(unpack(r[column], r["n"]) for r in rows if r["turn"] == turn)])


def successor_asks(cut_up: DataFrame, replied: DataFrame, shards: int, target: str) -> DataFrame:
    """For each slice and shard of its contexts: n of them in order, and how many pairs of each the slice owns, in all rows and in target rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, "slice"):
            _, grams, _, _ = _held(rows[0], target)
            bits = [np.frombuffer(pa.decompress(r["owned"], r["n"], codec="zstd", asbytes=True), np.uint8) for r in rows[1:]]
            owned = np.concatenate([np.zeros(0, np.uint8), *bits])[grams.pairs]
            every, marked = (np.bincount(grams.contexts, owned & bit > 0, len(grams.keys)).astype(np.int64)[grams.is_context] for bit in (1, 2))
            columns = _dealt(rows[0]["slice"], shards, grams.keys[grams.is_context], every, marked)
            del grams, bits, owned, every, marked, rows
            give_back()
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "shard long, slice long, n long, keys binary, every binary, marked binary"
    names = _names(schema)
    light = cut_up.withColumn("rows", F.col("marks")).drop("marks", "n_target")
    return by_slice(light, replied.select("slice", "shard", "n", "owned")).mapInArrow(run, schema)


def successors(asked: DataFrame) -> DataFrame:
    """For each slice and shard: the distinct words after each of its n contexts, in all rows and in target rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, "shard"):
            _, back = np.unique(np.concatenate([unpack(r["keys"], r["n"], "<u8") for r in rows]), return_inverse=True)
            at = np.concatenate([[0], np.cumsum([r["n"] for r in rows])])
            sums = [np.bincount(back, np.concatenate([unpack(r[c], r["n"]) for r in rows])).astype(np.int64) for c in ("every", "marked")]
            for k, r in enumerate(rows):
                own = back[at[k] : at[k + 1]]
                yield pa.RecordBatch.from_arrays([*(pa.array([x], pa.int64()) for x in (r["slice"], r["shard"], r["n"])), *(pa.array([pack(t[own])], pa.binary()) for t in sums)], names=names)
            del back, sums, rows
            give_back()

    schema = "slice long, shard long, n long, every binary, marked binary"
    names = _names(schema)
    return asked.repartition("shard").sortWithinPartitions("shard", "slice").mapInArrow(run, schema)


def only_here(grams: Grams, offsets: np.ndarray, rest: np.ndarray, counted: np.ndarray) -> np.ndarray:
    """For each token the distinct words after its context that only the token's own document has; rest: what is left of each
    token's pair without the document, counted: whether the document is in the counts."""
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    wide = len(grams.keys) + 1
    _, first = np.unique(row * wide + grams.places[0], return_index=True)  # a token of each pair of each document
    _, at = np.unique(row * wide + grams.places[1], return_inverse=True)
    alone = ((rest == 0) & counted)[first]
    return np.bincount(at[first], alone, at.max(initial=-1) + 1).astype(np.int64)[at]


def own_counts(places: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How often each token's gram, by its place, occurs in the token's own document."""
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    _, at, n = np.unique(row * (int(places.max(initial=0)) + 1) + places, return_inverse=True, return_counts=True)
    return n[at]


def score_corpus(df: DataFrame, text: str = "text", target: str = "target") -> DataFrame:
    """Replaces text and target (boolean; null is false) by n_tokens (long), target_loss, background_loss and score
    (double: their difference per token). The background is all of df, the target model's rows are those with target."""
    kept = [c for c in df.columns if c not in (text, target, *NAMES)]
    fields = [df.schema[c] for c in kept] + [T.StructField(NAMES[0], T.LongType()), *(T.StructField(n, T.DoubleType()) for n in NAMES[1:])]
    cut_up = materialize(cut(df.withColumn(target, F.coalesce(F.col(target), F.lit(False))), text, target, kept), "slices")
    sums = cut_up.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("every"), F.coalesce(F.sum("n_target"), F.lit(0)).alias("marked")).first()
    shards = max(SHARDS, -(-sums["every"] // SHARD_TOKENS))
    replied = materialize(answers(asks(cut_up, shards, target)), "answers")
    size = replied.agg(F.sum("size")).first()[0] or 0
    followed = successors(successor_asks(cut_up, replied, shards, target))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, "slice"):
            held, grams, offsets, mark = _held(rows[0], target)
            own, length = [own_counts(p, offsets) for p in grams.places], np.repeat(np.diff(offsets), np.diff(offsets))
            losses = []
            for name, counted in (("marked", mark), ("every", np.ones(len(mark), bool))):
                n, after = _joined(rows, 0, name), np.zeros(len(grams.keys), np.int64)
                after[grams.is_context] = _joined(rows, 1, name)
                pair, context, word = (n[p] - o * counted for p, o in zip(grams.places, own, strict=True))
                single = (word + 1) / (sums[name] - length * counted + max(size, 1))
                behind = DISCOUNT * (after[grams.places[1]] - only_here(grams, offsets, pair, counted)) * single
                p = np.where(context > 0, (np.maximum(pair - DISCOUNT, 0) + behind) / np.maximum(context, 1), single)
                losses.append(-sum_by_text(np.log(p), offsets) / np.maximum(np.diff(offsets), 1))
            del grams, own, length, pair, context, word, single, behind, p, n, after, rows
            give_back()
            yield pa.RecordBatch.from_arrays([*(held.column(c) for c in kept), pa.array(np.diff(offsets), pa.int64()), *(pa.array(x) for x in (*losses, losses[0] - losses[1]))], names=[f.name for f in fields])

    return by_slice(cut_up.drop("n_target", "marks"), replied.drop("size", "owned"), followed).mapInArrow(run, T.StructType(fields))
