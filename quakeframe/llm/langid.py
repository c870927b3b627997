"""Language identification by segmentation-marginalised unigrams.

Every language has one probability per piece of a fixed public vocabulary. A
word's probability is the sum, by the forward algorithm, over all ways to cut it
into pieces; pieces never cross white space, so a text's log-likelihood is the
sum over its words. Words are counted by language over all training rows, and the
expected piece counts (forward-backward, from the uniform start) of each distinct
one are added up by Spark; what reaches the driver is one number per language and
piece.

Texts without a letter, null and empty texts are `und` with score 0. Words are
lower-cased and ASCII punctuation separates words. A language whose training texts
have no word is never predicted; with no training words at all, every text is `und`, and an
empty table gives none. Of equally likely languages the first by name is taken.
Texts and words of any length are summed whole; null and repeated ids are fine, as
rows are judged one by one. Columns named lang_pred or score are replaced, further
ones stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quakeframe.llm.words import MIX, mix64, slices, sum_by_text
from quakeframe.session import materialize

#: Probability, in every language, of a character that no piece covers.
UNKNOWN = 1e-7
#: Words longer than this are summed one at a time, rescaled at each position.
LONG = 24
#: Text whose distinct words are counted and scored at a time.
SLICE_BYTES = 12 << 20
#: Added to every expected count.
PRIOR = 0.02


@lru_cache(2)
def _pieces(model: str | None) -> tuple[dict[int, tuple[np.ndarray, np.ndarray]], dict[str, int]]:
    """Hashes and ids of the pieces by length, and the ids by text; None stands for the public 32k vocabulary."""
    import public_tokenizers as public
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model or public.path("piece_bpe_32k.model"))
    ids = {}
    for i in range(sp.get_piece_size()):
        if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)):
            ids.setdefault(sp.id_to_piece(i).lower(), i)
    by_length = {}
    for length in sorted({len(p) for p in ids}):
        own = [p for p in ids if len(p) == length]
        codes = np.array(own, dtype=f"U{length}").view(np.uint32).reshape(len(own), length)
        h = _spans(_prefix(codes), 0, length)
        order = np.argsort(h)
        by_length[length] = (h[order], np.array([ids[p] for p in own])[order])
    return by_length, ids


def _prefix(codes: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes of equally long rows of characters."""
    out = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(codes.shape[1]):
            out[:, j + 1] = out[:, j] * MIX + mix64(codes[:, j].astype(np.uint64) + np.uint64(7))
    return out


def _spans(prefix: np.ndarray, i: int, j: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        power = np.uint64(1)
        for _ in range(j - i):
            power = power * MIX
        return prefix[:, j] - prefix[:, i] * power


def _lookup(table: tuple[np.ndarray, np.ndarray], h: np.ndarray) -> np.ndarray:
    """Piece ids, -1 where there is none."""
    hashes, ids = table
    at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
    return np.where(hashes[at] == h, ids[at], -1)


def _lattice(words: list[str], length: int, model: str | None) -> dict[tuple[int, int], np.ndarray]:
    """Piece ids of all spans (i, j) of equally long words, each begun by the word-start mark."""
    by_length, _ = _pieces(model)
    codes = np.array(["▁" + w for w in words], dtype=f"U{length}").view(np.uint32).reshape(len(words), length)
    prefix = _prefix(codes)
    out = {}
    for size, table in by_length.items():
        for i in range(length - size + 1):
            found = _lookup(table, _spans(prefix, i, i + size))
            if size == 1 or (found >= 0).any():
                out[i, i + size] = found
    return out


def _forward(lattice: dict[tuple[int, int], np.ndarray], n: int, length: int, probs: np.ndarray) -> np.ndarray:
    """alpha[position, word, language]; probs has a last row for characters without a piece."""
    alpha = np.zeros((length + 1, n, probs.shape[1]))
    alpha[0] = 1
    for (i, j), ids in sorted(lattice.items(), key=lambda x: x[0][1]):
        if j - i == 1:
            alpha[j] += alpha[i] * probs[ids]  # -1 is the last row
        else:
            has = np.nonzero(ids >= 0)[0]
            alpha[j, has] += alpha[i, has] * probs[ids[has]]
    return alpha


def _backward(lattice: dict[tuple[int, int], np.ndarray], n: int, length: int, probs: np.ndarray) -> np.ndarray:
    beta = np.zeros((length + 1, n, probs.shape[1]))
    beta[length] = 1
    for (i, j), ids in sorted(lattice.items(), key=lambda x: -x[0][0]):
        if j - i == 1:
            beta[i] += beta[j] * probs[ids]
        else:
            has = np.nonzero(ids >= 0)[0]
            beta[i, has] += beta[j, has] * probs[ids[has]]
    return beta


def _long_word(word: str, logs: np.ndarray, model: str | None) -> np.ndarray:
    """The same sum as _forward for a word of any length, rescaled at each position."""
    by_length, ids = _pieces(model)
    text, top = "▁" + word, max(by_length)
    probs = np.exp(logs)
    ring = [np.ones(logs.shape[1])]
    scale = np.zeros(logs.shape[1])
    for j in range(1, len(text) + 1):
        now = np.zeros(logs.shape[1])
        for size in range(1, min(top, j) + 1):
            k = ids.get(text[j - size : j])
            if k is not None:
                now += ring[-size] * probs[k]
            elif size == 1:
                now += ring[-1] * probs[-1]
        ring.append(now)
        peak = max(now.max(), 1e-300)
        ring = [x / peak for x in ring[-top:]]
        scale += np.log(peak)
    return np.log(np.maximum(ring[-1], 1e-300)) + scale


def _long_counts(word: str, probs: np.ndarray, model: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of a word of any length under one language's probabilities, and their expected uses: forward and backward sums,
    rescaled at each position."""
    by_length, ids = _pieces(model)
    text, top = "▁" + word, max(by_length)
    n = len(text)
    spans = [[(size, k) for size in range(1, min(top, j) + 1) if (k := ids.get(text[j - size : j], -1 if size == 1 else None)) is not None] for j in range(n + 1)]
    forward, peaks = [1.0], [0.0]  # scaled so that the last one is 1, and logs of the scales
    for j in range(1, n + 1):
        now = sum(forward[j - size] * np.exp(peaks[j - size] - peaks[j - 1]) * probs[k] for size, k in spans[j])
        forward.append(1.0)
        peaks.append(peaks[j - 1] + np.log(max(now, 1e-300)))
    backward = np.full(n + 1, -np.inf)  # logs
    backward[n] = 0.0
    pieces, uses = [], []
    for j in range(n, 0, -1):
        for size, k in spans[j]:
            through = np.log(max(probs[k], 1e-300)) + backward[j]
            backward[j - size] = np.logaddexp(backward[j - size], through)
            pieces.append(k)
            uses.append(np.exp(peaks[j - size] + through - peaks[n]))
    known = np.array(pieces) >= 0
    return np.array(pieces)[known], np.array(uses)[known]


def _by_length(words: list[str]) -> dict[int, np.ndarray]:
    n = np.array([len(w) + 1 for w in words])
    return {int(k): np.nonzero(n == k)[0] for k in np.unique(n)}


def score_words(words: list[str], logs: np.ndarray, model: str | None) -> np.ndarray:
    """log P(word | language) for each word and language."""
    out = np.zeros((len(words), logs.shape[1]))
    probs = np.exp(logs)
    for length, at in _by_length(words).items():
        if length > LONG + 1:
            for k in at:
                out[k] = _long_word(words[k], logs, model)
            continue
        for part in np.array_split(at, max(1, len(at) // 4_000)):
            own = [words[k] for k in part]
            alpha = _forward(_lattice(own, length, model), len(own), length, probs)
            out[part] = np.log(np.maximum(alpha[length], 1e-300))
    return out


def expected_counts(words: list[str], langs: np.ndarray, times: np.ndarray, logs: np.ndarray, model: str | None) -> np.ndarray:
    """Expected uses of each piece in each language, over all segmentations of each whole word."""
    out = np.zeros(logs.shape)
    probs = np.exp(logs)
    width = logs.shape[1]
    for length, at in _by_length(words).items():
        if length > LONG + 1:
            for k in at.tolist():
                pieces, uses = _long_counts(words[k], probs[:, langs[k]], model)
                np.add.at(out, (pieces, langs[k]), uses * times[k])
            continue
        for part in np.array_split(at, max(1, len(at) // 4_000)):
            own, lang, weight = [words[k] for k in part], langs[part], times[part]
            lattice = _lattice(own, length, model)
            alpha = _forward(lattice, len(own), length, probs)
            beta = _backward(lattice, len(own), length, probs)
            rows = np.arange(len(own))
            scale = weight / np.maximum(alpha[length][rows, lang], 1e-300)
            for (i, j), ids in lattice.items():
                has = np.nonzero(ids >= 0)[0]
                use = alpha[i][has, lang[has]] * probs[ids[has], lang[has]] * beta[j][has, lang[has]] * scale[has]
                out += np.bincount(ids[has] * width + lang[has], use, out.size).reshape(out.shape) if len(has) > 4096 else 0
                if len(has) <= 4096:
                    np.add.at(out, (ids[has], lang[has]), use)
    return out


def _words(text: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Lower-cased words without ASCII punctuation, coded, and offsets."""
    low = pc.utf8_lower(pc.fill_null(text, ""))
    low = pc.replace_substring_regex(low, pattern=r"[[:punct:]]+", replacement=" ")
    parts = pc.ascii_split_whitespace(low)
    flat = parts.flatten()
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    kept = np.concatenate([[0], np.cumsum(full)])
    return flat.filter(pa.array(full)).dictionary_encode(), kept[parts.offsets.to_numpy() - parts.offsets[0].as_py()]


@dataclass
class LanguageModel:
    """Log probabilities by piece (and a last row for characters without one) and language."""

    langs: list[str]
    logs: np.ndarray
    model: str | None = None


def _word_table(rows: DataFrame, langs: list[str]) -> DataFrame:
    """lang (its place in langs), word and n, how often it occurs, from rows (text, lang)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                coded, offsets = _words(part.column("text"))
                lang = np.repeat(np.searchsorted(langs, part.column("lang").to_pylist()), np.diff(offsets))
                pair, times = np.unique(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(langs) + lang, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pair % len(langs), pa.int32()), coded.dictionary.take(pa.array(pair // len(langs))).cast(pa.string()), pa.array(times, pa.int64())], names=["lang", "word", "n"])

    return rows.mapInArrow(count, "lang int, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", model: str | None = None, iterations: int = 1) -> LanguageModel:
    """Fit on all rows of docs whose lang and text are not null."""
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    langs = sorted(r[0] for r in rows.select("lang").distinct().collect())
    by_length, ids = _pieces(model)
    size = max(ids.values()) + 2
    logs = np.full((size, max(1, len(langs))), np.log(1 / len(ids)))
    logs[-1] = np.log(UNKNOWN)
    shared = docs.sparkSession.sparkContext
    words = materialize(_word_table(rows, langs), "words") if langs else None
    for _ in range(iterations if langs else 0):
        held = shared.broadcast(logs)

        def gather(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            total = np.zeros(held.value.shape)
            for batch in batches:
                total += expected_counts(batch.column("word").to_pylist(), batch.column("lang").to_numpy().astype(np.int64), batch.column("n").to_numpy().astype(float), held.value, model)
            at = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at[0], pa.int64()), pa.array(at[1], pa.int64()), pa.array(total[at])], names=["piece", "lang", "n"])

        counts = np.full(logs.shape, 0.0)
        summed = words.mapInArrow(gather, "piece long, lang long, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n"))
        got = summed.toPandas()  # at most one row for each language and piece
        counts[got["piece"], got["lang"]] = got["n"]
        known = np.array(sorted(ids.values()))
        smooth = counts[known] + PRIOR
        logs = np.full(logs.shape, np.log(UNKNOWN))
        logs[known] = np.log(smooth / smooth.sum(axis=0))
        held.destroy()
    heard = sorted(r[0] for r in words.select("lang").distinct().collect()) if langs else []  # one row a language
    return LanguageModel([langs[k] for k in heard], logs[:, heard] if heard else logs, model)


def predict(df: DataFrame, fitted: LanguageModel, text: str = "text") -> DataFrame:
    """Adds lang_pred (string) and score (double: the posterior of lang_pred among the languages)."""
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    base = [f for f in df.schema.fields if f.name not in ("lang_pred", "score")]
    names = [f.name for f in base]
    lettered = df.select(*names, F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("__lettered"))
    held = df.sparkSession.sparkContext.broadcast((fitted.langs, fitted.logs))
    model = fitted.model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, logs = held.value
        for batch in batches:
            for part in slices(batch, text, SLICE_BYTES):
                pred, score = [], []
                coded, offsets = _words(part.column(text))
                own, at = score_words(coded.dictionary.to_pylist(), logs, model), coded.indices.to_numpy(zero_copy_only=False)
                total = np.stack([sum_by_text(own[:, k][at], offsets) for k in range(logs.shape[1])], axis=1)
                post = np.exp(total - total.max(axis=1, keepdims=True))
                post /= post.sum(axis=1, keepdims=True)
                best = total.argmax(axis=1)
                for row, ok in enumerate(part.column("__lettered").to_pylist()):
                    pred.append(langs[best[row]] if ok and langs else "und")
                    score.append(float(post[row, best[row]]) if ok and langs else 0.0)
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(pred, pa.string()), pa.array(score)], names=[*names, "lang_pred", "score"])

    return lettered.mapInArrow(run, T.StructType(base + fields))
