"""Toxicity by class-conditional Kneser-Ney models.

Each class (toxic, ordinary) has an interpolated Kneser-Ney bigram model. Counts
are continuation counts on both levels: a pair of words counts once for each
distinct word before it and a word once for each distinct word it follows, so
copies of a document add nothing. The ordinary counts are scaled to the toxic
ones, which makes the discounts weigh alike. With n the counts, N their sum over a
context c, D the discount and B(c) the mass that it takes off, min(D, n) of each
pair,

    p(w | c)    = (max(n(c, w) - D, 0) + B(c) f(w | c)) / N(c)
    f(w | c)    = shared(w | c) own(w) / shared(w) / Z(c)

where own is the class's unigram model, discounted likewise with the shared
unigrams behind it, shared(w | c) and shared(w) come from the counts of both
classes together, and Z(c) is the sum over all words that makes f, and so p, sum to one in each context. So a
rare expression scores alike under both. Contexts that a class hasn't seen leave f alone.

The log-likelihood difference of the classes is normalised by length, over the
text and over its best passages of one and of four words: an insult is a few words
in a long text, which the text's own mean hardly moves. A logistic curve over
these three is the score. The models count every labelled row, and the curve is fitted
on every distinct labelled text: they fall into two halves by hash, and each half is
measured by the counts of the other one. The curve's sums are Spark's, a pass a Newton step.

Words and contexts have 2^20 slots by hash (feature hashing: words that share a slot are one word to the model, which
is a proper one over the slots); the counts of pairs are exact. The model that tasks get is the
numbers of the slots and the pairs above a discount, compressed; it grows with the distinct pairs of the labelled texts.
A caller may bound it by MODEL_TEXTS, which no query does.

A doc_id that stands in several rows counts with each of its texts, copies of a text once. Equal scores are no tie to be
broken, since rows are judged one by one.

Null and empty texts have no evidence and get the score of zero differences.
Without two distinct texts of each label, every score is the share of toxic rows,
or 0 where there are none; an empty table gives none. A doc_id labelled more than
once is toxic if any of its labels is, labels null are left out. Whole texts of
any length are counted and scored; null and repeated ids are fine in scoring, as
rows are scored one by one. A column named score is replaced, further ones stay.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quakeframe.llm.lm import _runs, pack, unpack
from quakeframe.llm.words import give_back, mix64, slices, sum_by_text, word_hashes
from quakeframe.session import materialize

#: Bits of the slots of words and contexts, and bits that tell the words before a pair apart.
VOCAB_BITS, LEFT_BITS = 20, 16
#: Labelled text of a shard of counts, and the fewest shards.
SHARD_BYTES, SHARDS = 8 << 20, 32
#: Discounts of a class's pairs, a class's words, and the pairs of both classes together.
PAIRS, WORDS, SHARED = 2.0, 1.5, 0.75
PASSAGES = (1, 4)
#: Bits of a text's hash among which the one that halves the labelled texts is chosen.
HALVES = 32
#: Distinct labelled texts of each label that the models count, about and at most; None: all of them.
MODEL_TEXTS: int | None = None
#: Labels up to this number are broadcast; more are joined by a shuffle.
BROADCAST_LABELS = 2_000_000
#: Text that is scored at a time.
SLICE_BYTES = 2 << 20
FEATURES = ("whole", *(f"best_{n}" for n in PASSAGES))


def _words(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Slot of each word, of the word before it and a mark of the one before that (0 at a text's start), offsets."""
    words, offsets = word_hashes(text, punctuation=False)
    slot = (words & np.uint64((1 << VOCAB_BITS) - 1)).astype(np.int64)
    mark = (mix64(words) >> np.uint64(64 - LEFT_BITS)).astype(np.int64)
    context, left = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    context[1:], left[2:] = slot[:-1], mark[:-2]
    first = offsets[:-1][np.diff(offsets) > 0]
    context[first] = left[first] = 0
    second = offsets[:-1][np.diff(offsets) > 1] + 1
    left[second] = 0
    return slot, context, left, offsets


def _dealt(keys: np.ndarray, by: np.ndarray, shards: int, *values: np.ndarray) -> Iterator[tuple]:
    """(shard, n, keys, values ...) of each shard that the hashes of by fall in: sorted keys as their differences, all packed."""
    shard = ((mix64(by.astype(np.uint64)) >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(shard, kind="stable")  # keys stay sorted within a shard
    keys, values = keys[order], [v[order] for v in values]
    edges = np.searchsorted(shard[order], np.arange(shards + 1))
    for s in np.nonzero(np.diff(edges))[0].tolist():
        own = slice(edges[s], edges[s + 1])
        yield (s, int(edges[s + 1] - edges[s]), pack(np.diff(keys[own], prepend=0)), *(pack(v[own]) for v in values))


def pair_counts(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """From (text, toxic, curve boolean): pair (context << VOCAB_BITS | word), ordinary and toxic: the distinct words before it in
    each class; ordinary_apart and toxic_apart: the same without the rows of the curve; ordinary_own and toxic_own: of those alone.

    A slice of text deals its distinct triples over hash shards, packed; a shard counts each once and deals
    partial counts by pair. A common pair is spread over the shards of its triples and one number a shard after that.
    """
    counts = ("ordinary", "toxic", "ordinary_apart", "toxic_apart", "ordinary_own", "toxic_own")

    def batch_of(dealt: Iterator[tuple], names: list[str]) -> Iterator[pa.RecordBatch]:
        if columns := list(zip(*dealt, strict=True)):
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[2:])], names=names)

    def types(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                slot, context, left, offsets = _words(part.column("text"))
                label = np.repeat(part.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64), np.diff(offsets))
                own = np.repeat(pc.fill_null(part.column("curve"), False).to_numpy(zero_copy_only=False), np.diff(offsets))
                keys = np.unique((((context << VOCAB_BITS | slot) << LEFT_BITS | left) << 1 | label) << 1 | own)
                yield from batch_of(_dealt(keys, keys >> 1, shards), ["shard", "n", "keys"])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _runs(batches, "shard"):
            keys = np.unique(np.concatenate([np.cumsum(unpack(r["keys"], r["n"])) for r in held]))
            kind = keys >> 1
            new = kind[1:] != kind[:-1]
            first, last = np.append(True, new), np.append(new, True)  # the row outside the curve, if there is one, comes first
            kind, apart, own = kind[first], 1 - (keys[first] & 1), keys[last] & 1
            label, pair = kind & 1, kind >> (LEFT_BITS + 1)
            at = np.nonzero(np.append(True, pair[1:] != pair[:-1]))[0]
            sums = [np.add.reduceat(x, at) for x in (1 - label, label, (1 - label) * apart, label * apart, (1 - label) * own, label * own)]
            yield from batch_of(_dealt(pair[at], pair[at], shards, *sums), ["shard", "n", "keys", *counts])
            give_back()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _runs(batches, "shard"):
            keys, back = np.unique(np.concatenate([np.cumsum(unpack(r["keys"], r["n"])) for r in held]), return_inverse=True)
            sums = [np.bincount(back, np.concatenate([unpack(r[c], r["n"]) for r in held]), len(keys)).astype(np.int32) for c in counts]
            yield pa.RecordBatch.from_arrays([pa.array(keys), *(pa.array(x) for x in sums)], names=["pair", *counts])
            give_back()

    gathered = lambda df: df.repartition("shard").sortWithinPartitions("shard")
    blobs = "shard long, n long, keys binary"
    seen = rows.select("text", "toxic", "curve").mapInArrow(types, blobs)
    partly = gathered(seen).mapInArrow(partial, blobs + "".join(f", {c} binary" for c in counts))
    return gathered(partly).mapInArrow(whole, "pair long" + "".join(f", {c} int" for c in counts))


@dataclass
class KneserNey:
    """For the two classes (ordinary, toxic): seen, mass and norm by context, word probabilities; for both together mass_shared by
    context and shared by word; and the counts of the pairs that exceed a discount, by their sorted keys."""

    seen: np.ndarray
    mass: np.ndarray
    norm: np.ndarray
    word: np.ndarray
    mass_shared: np.ndarray
    shared: np.ndarray
    keys: np.ndarray
    count: np.ndarray

    def probabilities(self, slot: np.ndarray, context: np.ndarray) -> np.ndarray:
        """p(word | context) in each class, of each token."""
        asked, back = np.unique(context << VOCAB_BITS | slot, return_inverse=True)  # sorted, so the search stays near
        at = np.minimum(np.searchsorted(self.keys, asked), max(len(self.keys) - 1, 0))
        n = (np.where(self.keys[at] == asked, self.count[:, at], 0.0) if len(self.keys) else np.zeros((2, len(asked))))[:, back]
        seen, word = self.seen[:, context].astype(np.float64), self.word[:, slot].astype(np.float64)
        both, single = seen.sum(axis=0), self.shared[slot].astype(np.float64)
        behind = np.where(both > 0, (np.maximum(n.sum(axis=0) - SHARED, 0) + self.mass_shared[context] * single) / np.where(both > 0, both, 1), single)
        backoff = behind * word / single / self.norm[:, context]
        return np.where(seen > 0, (np.maximum(n - PAIRS, 0) + self.mass[:, context] * backoff) / np.where(seen > 0, seen, 1), backoff)

    def differences(self, slot: np.ndarray, context: np.ndarray) -> np.ndarray:
        """log p(word | context, toxic) - log p(word | context, ordinary) of each token."""
        p = self.probabilities(slot, context)
        return np.log(p[1]) - np.log(p[0])


def _model(pairs: DataFrame, apart: bool, own: bool = False) -> KneserNey | None:
    """Of all labelled rows, apart from the curve's or of its own; None if a class has no counts. A row a slot, and the pairs above a discount, reach the driver."""
    ordinary, toxic = (F.col(n + ("_apart" if apart else "_own" if own else "")) for n in ("ordinary", "toxic"))
    sums = pairs.agg(F.sum(ordinary).alias("o"), F.sum(toxic).alias("t")).first()
    if not sums["o"] or not sums["t"]:
        return None
    scale = float(sums["t"] / sums["o"])
    scaled = ordinary * scale
    at = F.shiftright("pair", VOCAB_BITS).cast("int")
    slot = F.col("pair").bitwiseAND((1 << VOCAB_BITS) - 1).cast("int")

    def arrays(table: DataFrame) -> list[np.ndarray]:
        got = table.toArrow()
        out = []
        for column in got.columns[1:]:
            out.append(np.zeros(1 << VOCAB_BITS, np.float32))
            out[-1][got.column(0).to_numpy()] = column.to_numpy()
        return out

    least = lambda d, x: F.least(F.lit(d), x)
    total = lambda x: F.sum(x).cast("float")
    seen_o, seen_t, mass_o, mass_t, mass_s = arrays(pairs.groupBy(at.alias("at")).agg(total(scaled).alias("a"), total(toxic).alias("b"), total(least(PAIRS, scaled)).alias("c"), total(least(PAIRS, toxic)).alias("d"), total(least(SHARED, scaled + toxic)).alias("e")))
    words = np.stack(arrays(pairs.groupBy(slot.alias("at")).agg(total((ordinary > 0).cast("int")).alias("a"), total((toxic > 0).cast("int")).alias("b")))).astype(np.float64)
    words[0] *= words[1].sum() / words[0].sum()
    shared = words.sum(axis=0) + 0.01
    shared /= shared.sum()
    own = np.stack([(np.maximum(w - WORDS, 0) + np.minimum(w, WORDS).sum() * shared) / w.sum() for w in words])
    heavy = pairs.where((F.greatest(scaled, toxic) > PAIRS) | (scaled + toxic > SHARED)).select("pair", ordinary.cast("int").alias("a"), toxic.cast("int").alias("b")).toArrow()
    order = np.argsort(heavy.column("pair").to_numpy(), kind="stable")
    keys = heavy.column("pair").to_numpy()[order]
    count = np.stack([heavy.column("a").to_numpy()[order] * scale, heavy.column("b").to_numpy()[order]]).astype(np.float32)
    del heavy, order, words
    # what the words of a context get of the shared model once each is weighed by its class
    context, word, above = keys >> VOCAB_BITS, keys & (1 << VOCAB_BITS) - 1, np.maximum(count.sum(axis=0) - SHARED, 0)
    both = seen_o.astype(np.float64) + seen_t
    norm = np.stack([np.where(both > 0, (np.bincount(context, above * (k / shared)[word], 1 << VOCAB_BITS) + mass_s) / np.where(both > 0, both, 1), 1.0) for k in own])
    return KneserNey(np.stack([seen_o, seen_t]), np.stack([mass_o, mass_t]), norm.astype(np.float32), own.astype(np.float32), mass_s, shared.astype(np.float32), keys, count)


def shipped(context: SparkContext, model: object) -> Broadcast:
    """The model for all tasks, compressed: its arrays are sparse, and each executor keeps what is sent in a file."""
    data = pickle.dumps(model, protocol=5)
    return context.broadcast((len(data), pa.compress(data, codec="zstd", asbytes=True)))


def opened(held: Broadcast):
    size, data = held.value
    return pickle.loads(pa.decompress(data, size, codec="zstd", asbytes=True))


def features(text: pa.Array, model: KneserNey) -> np.ndarray:
    """Length-normalised differences of each text: over all of it, and of its best passage of each length."""
    slot, context, _, offsets = _words(text)
    value = model.differences(slot, context)
    n = np.diff(offsets)
    out = np.zeros((len(n), len(FEATURES)))
    out[:, 0] = sum_by_text(value, offsets) / np.maximum(n, 1)
    total = np.concatenate([[0.0], np.cumsum(value)])
    full = n > 0
    for k, size in enumerate(PASSAGES):
        if full.any():
            end = np.minimum(np.arange(len(value)) + size, np.repeat(offsets[1:], n))
            out[full, 1 + k] = np.maximum.reduceat((total[end] - total[:-1]) / size, offsets[:-1][full])
    return out


def _logistic(table: DataFrame, names: tuple[str, ...] = FEATURES) -> np.ndarray:
    """Coefficients and intercept for y by Newton steps with a small ridge; each step's sums are one pass over table."""
    x = [*(F.col(n) for n in names), F.lit(1.0)]
    cells = [(i, j) for i in range(len(x)) for j in range(i + 1)]
    w = np.zeros(len(x))
    for _ in range(30):
        at = sum((c * float(k) for c, k in zip(x, w, strict=True)), F.lit(0.0))
        p = 1 / (1 + F.exp(-F.least(F.greatest(at, F.lit(-30.0)), F.lit(30.0))))
        rows = table.select(*names, "y", p.alias("p"))
        curved = F.col("p") * (1 - F.col("p")) + 1e-9
        sums = list(rows.agg(*(F.sum(x[i] * x[j] * curved).alias(f"h{i}_{j}") for i, j in cells), *(F.sum(c * (F.col("y") - F.col("p"))).alias(f"g{i}") for i, c in enumerate(x))).first())
        h = 1e-2 * np.eye(len(w))
        for (i, j), v in zip(cells, sums[: len(cells)], strict=True):
            h[i, j] += v
            h[j, i] = h[i, j]
        step = np.linalg.solve(h, np.array(sums[len(cells) :]) - 1e-2 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class ToxicityModel:
    """Without a Kneser-Ney model, the weights are an intercept alone."""

    model: KneserNey | None
    weights: np.ndarray

    def score(self, text: pa.Array) -> np.ndarray:
        x = np.zeros((len(text), len(FEATURES))) if self.model is None else features(text, self.model)
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))


def _curve_texts(n: int) -> int:
    """How many of n distinct texts of a label each half is to hold at least: a quarter, or of few texts up to a half."""
    return min(n // 2, max(-(-n // 4), 25))


def _half(texts: DataFrame, wanted: dict[int, int]) -> Column | None:
    """Whether a text (key) is of the first half: the bit of its hash whose halves hold the most of the wanted numbers of both labels; None if some half has none."""
    bit = lambda k: F.shiftright(F.xxhash64(F.lit(12), "key"), k).bitwiseAND(F.lit(1))
    got = texts.groupBy("toxic").agg(F.count(F.lit(1)).alias("n"), *(F.sum(bit(k)).alias(f"b{k}") for k in range(HALVES))).collect()  # two rows
    held = [min(min(r[f"b{k}"], r["n"] - r[f"b{k}"]) / wanted[r["toxic"]] for r in got) for k in range(HALVES)]
    return bit(int(np.argmax(held))) == 1 if max(held) > 0 else None


def fit(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Fit on the rows of docs (doc_id, text) whose doc_id has a label (doc_id, toxic)."""
    own = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).where(F.col("toxic").isNotNull())
    own = F.broadcast(own) if own.count() <= BROADCAST_LABELS else own
    rows = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(own, "doc_id").select("text", "toxic", F.xxhash64("text").alias("key"))
    texts = materialize(rows.withColumn("bytes", F.octet_length("text").cast("long")).groupBy("key").agg(F.max("toxic").alias("toxic"), F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("n_toxic"), F.sum("bytes").alias("bytes")), "texts")
    sums = texts.agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("n_toxic"), F.sum("bytes").alias("bytes"), F.count(F.when(F.col("toxic") == 0, 1)).alias("0"), F.count(F.when(F.col("toxic") == 1, 1)).alias("1")).first()
    share = min(max((sums["n_toxic"] or 0) / max(sums["n"] or 0, 1), 1e-6), 1 - 1e-6)
    constant = np.array([0.0] * len(FEATURES) + [np.log(share / (1 - share))])
    if MODEL_TEXTS is not None and max(sums["0"], sums["1"]) > MODEL_TEXTS:
        share_of = {k: min(1.0, MODEL_TEXTS / max(sums[str(k)], 1)) for k in (0, 1)}
        drawn = F.pmod(F.xxhash64(F.lit(13), "key"), F.lit(1 << 30)) < F.when(F.col("toxic") == 1, int(share_of[1] * (1 << 30))).otherwise(int(share_of[0] * (1 << 30)))
        rows, texts = rows.where(drawn), texts.where(drawn)
    wanted = {k: _curve_texts(sums[str(k)]) for k in (0, 1)}
    half = _half(texts, wanted) if all(wanted.values()) else None
    if half is None:
        return ToxicityModel(None, constant)
    marked = rows.withColumn("curve", half)
    pairs = materialize(pair_counts(marked, max(SHARDS, sums["bytes"] // SHARD_BYTES)), "pairs")

    def measured(of_curve: bool) -> DataFrame | None:
        """key, toxic and features of one half's rows, by the counts of the other half."""
        model = _model(pairs, of_curve, not of_curve)
        if model is None:
            return None
        held = shipped(docs.sparkSession.sparkContext, model)
        del model

        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = opened(held)
            for batch in batches:
                for part in slices(batch, most=SLICE_BYTES):
                    x = features(part.column("text"), model)
                    yield pa.RecordBatch.from_arrays([part.column("key"), part.column("toxic"), *(pa.array(c) for c in x.T)], names=["key", "toxic", *FEATURES])

        rows_of = marked.where(F.col("curve") == of_curve).select("key", "text", "toxic")
        out = materialize(rows_of.mapInArrow(measure, "key long, toxic int, " + ", ".join(f"{n} double" for n in FEATURES)), "measured")
        held.destroy()
        return out

    halves = [measured(True), measured(False)]
    if None in halves:
        return ToxicityModel(None, constant)
    whole = halves[0].unionByName(halves[1]).groupBy("key").agg(F.max("toxic").cast("double").alias("y"), *(F.max(n).alias(n) for n in FEATURES))
    return ToxicityModel(_model(pairs, False), _logistic(materialize(whole, "curve")))


def predict(df: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """Adds score (double, 0 to 1)."""
    names = [n for n in df.columns if n != "score"]
    schema = T.StructType([f for f in df.schema.fields if f.name != "score"] + [T.StructField("score", T.DoubleType())])
    held = shipped(df.sparkSession.sparkContext, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = opened(held)
        for batch in batches:
            for part in slices(batch, text, SLICE_BYTES):
                score = own.score(pc.cast(part.column(text), pa.string()))
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(score)], names=schema.names)

    return df.select(*names).mapInArrow(run, schema)
