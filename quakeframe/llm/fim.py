"""Fill-in-middle texts: a prefix, a middle and a suffix cut at token bounds and put in another order.

A token is a run of other characters with the white space before it, or white space at the text's
end. Each text becomes a UTF-32 array of code points; neighbours of different class (white space or not) are its
bounds, found by flatnonzero, and the two chosen ranks index them. Texts are transformed
one by one in Arrow batches of bounded size, without a shuffle.

What is drawn for a row comes from the SHA-256 of the seed and its id, so a rerun of a lost task gives the same
text. A null id counts as the empty string; a null text counts as empty; empty texts, texts that hold a sentinel and the
share that isn't drawn stay as they are (form plain). Rows that repeat give the same output each. Of columns named like the operator's own
(n, form, prefix_chars, middle_chars, output) the operator's replace the table's; further ones stay. Texts of any length are taken whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quakeframe.llm.words import slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Percent of rows that are transformed, and of those that put the suffix first.
RATE, SUFFIX_FIRST = 50, 80
#: Text that is transformed at a time.
SLICE_BYTES = 2 << 20
FIELDS = (("n", T.LongType(), pa.int64()), ("form", T.StringType(), pa.string()), ("prefix_chars", T.LongType(), pa.int64()), ("middle_chars", T.LongType(), pa.int64()), ("output", T.StringType(), pa.string()))


def draws(seed: int, key: str) -> list[int]:
    """Four unsigned 32-bit numbers of a row."""
    digest = hashlib.sha256(f"{seed}:{key}".encode()).digest()
    return [int.from_bytes(digest[4 * k : 4 * k + 4], "big") for k in range(4)]


def token_ends(points: np.ndarray) -> np.ndarray:
    """Place after each token, in code points."""
    space = (points == 0x20) | ((points >= 0x09) & (points <= 0x0D))
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    return np.append(ends, len(points)) if len(points) else ends


def transform_text(text: str, key: str, seed: int = 42) -> tuple[int, str, int | None, int | None, str]:
    """Tokens, form, code points of the prefix and of the middle (None if plain), and the output."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    ends = token_ends(points)
    n = len(ends)
    a, b, drawn, first = draws(seed, key)
    if not n or drawn % 100 >= RATE or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    bounds = np.concatenate([[0], ends])
    low, high = (int(bounds[k]) for k in sorted((a % (n + 1), b % (n + 1))))
    prefix, middle, suffix = (points[x:y].tobytes().decode("utf-32-le") for x, y in ((0, low), (low, high), (high, len(points))))
    if first % 100 < SUFFIX_FIRST:
        return n, "spm", low, high - low, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", low, high - low, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def transform(df: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 42, keep_text: bool = True) -> DataFrame:
    """Adds n (tokens), form (plain, psm or spm), prefix_chars, middle_chars and output; the text goes unless keep_text."""
    new = [name for name, _, _ in FIELDS]
    base = [f for f in df.schema.fields if f.name not in new and (keep_text or f.name != text)]
    schema = T.StructType(base + [T.StructField(name, kind) for name, kind, _ in FIELDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__text", SLICE_BYTES):
                keys = pc.fill_null(part.column("__key"), "").to_pylist()
                texts = pc.fill_null(part.column("__text"), "")
                made = list(zip(*(transform_text(t.as_py(), k, seed) for t, k in zip(texts, keys, strict=True)), strict=True))
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in base), *(pa.array(c, t) for c, (_, _, t) in zip(made, FIELDS, strict=True))], names=schema.names)

    own = df.select(*(F.col(f.name) for f in base), F.col(key).cast("string").alias("__key"), F.col(text).cast("string").alias("__text"))
    return own.mapInArrow(run, schema)


def restore(output: Column, form: Column) -> Column:
    """The text that output was made of. Its sentinels stand once each, as no piece holds one and none begins inside another."""

    def between(a: str, b: str) -> Column:
        start = F.instr(output, a) + len(a)
        return F.substring(output, start, (F.instr(output, b) - start if b else F.length(output)))

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, ""), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, ""), between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def duckdb_sql(seed: int = 42) -> str:
    """Digests of the transformed documents, with the tokens cut by the regular expression."""
    h = lambda k: f"('0x' || substr(sha256('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), {8 * k - 7}, 8))::UBIGINT"
    joined = lambda a, b: f"array_to_string(k[{a}:{b}], '')"
    return rf"""WITH t AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS k, {h(1)} AS h1, {h(2)} AS h2, {h(3)} AS h3, {h(4)} AS h4 FROM documents),
c AS (SELECT *, CAST(len(k) AS BIGINT) AS n, least(h1 % (len(k) + 1), h2 % (len(k) + 1)) AS a, greatest(h1 % (len(k) + 1), h2 % (len(k) + 1)) AS b,
 CASE WHEN t = '' OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}') OR contains(t, '{MIDDLE}') OR h3 % 100 >= {RATE} THEN 'plain' WHEN h4 % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form FROM t),
p AS (SELECT doc_id, t, n, form, {joined(1, 'a')} AS p, {joined('a+1', 'b')} AS m, {joined('b+1', 'len(k)')} AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m ELSE '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m END) AS output_sha256, sha256(t) AS restored_sha256 FROM p"""
