"""How filters interact: survivors by order, redundancy and Shapley shares, from the filters' multilinear extension.

Each row of the table is judged by every filter, which gives it a mask of the filters it fails; what a
filter order removes depends on the rows by mask alone. Of each part of the table, these counts c(m)
give the removal polynomial

    f(x) = sum over m of c(m) (1 - product over i in m of (1 - x_i)),

multilinear in the filters: f at a corner (x_i = 1 for the filters applied, 0 for the others) is what they remove
together, so its corners supply the survivors of each step of each order. The Shapley share of filter i is the
integral over t from 0 to 1 of the partial derivative of f by x_i at (t, ..., t), taken with exact rationals.

Rows are counted by (part, mask) with map-side combine; a part becomes one row of
at most 2^filters counts. Any number of filters up to MOST_FILTERS is taken;
reports of all orders are for few filters, as there are n! of them.

The document filters (op11): nulls in text count as the empty text, in lang as the
part with the empty name; a null doc_id is no smaller than any and no doc_id is
smaller than it, so it never repeats another row. Rows with the same doc_id and
the same text don't repeat each other. A doc_id that is labelled more than once has a label if any
of its labels is 1; a row whose doc_id is null has none. An empty table has no parts and no rows.
Further columns of either table are ignored. Texts of any length are judged whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quakeframe.session import materialize

MOST_FILTERS = 8
FILTERS = "ABCDE"
#: Labels up to this number are broadcast; more are joined by a shuffle.
BROADCAST_LABELS = 2_000_000
SPACE = r"[\x20\x09-\x0D]+"


def removal_polynomial(counts: dict[int, int], filters: int) -> list[int]:
    """Coefficients of f by monomial (a mask of variables) from the rows of each failure mask."""
    inside = [0] * (1 << filters)  # rows that fail all filters of the monomial
    for m, n in counts.items():
        inside[m] += n
    for k in range(filters):
        for t in range(1 << filters):
            if not t >> k & 1:
                inside[t] += inside[t | 1 << k]
    return [0] + [n if t.bit_count() % 2 else -n for t, n in enumerate(inside) if t]


def at_corner(polynomial: list[int], chosen: int) -> int:
    """f where the chosen variables are 1 and the others 0: rows that the chosen filters remove together."""
    total, t = 0, chosen
    while t:  # the monomials inside chosen
        total += polynomial[t]
        t = (t - 1) & chosen
    return total


def shapley(polynomial: list[int], k: int) -> Fraction:
    """The integral of the partial derivative by variable k along the diagonal: x^T gives t^(|T| - 1), so 1 / |T|."""
    return sum((Fraction(a, t.bit_count()) for t, a in enumerate(polynomial) if t >> k & 1), Fraction(0))


def audit_part(masks: dict[int, tuple[int, ...]], filters: str) -> Iterator[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, lost of each further count, shapley times n!) from a part's counts by mask:
    rows, then rows of each further kind."""
    n, full = len(filters), (1 << len(filters)) - 1
    kinds = len(next(iter(masks.values())))
    polynomials = [removal_polynomial({m: c[j] for m, c in masks.items()}, n) for j in range(kinds)]
    corner = [[at_corner(p, s) for s in range(full + 1)] for p in polynomials]
    rows = sum(c[0] for c in masks.values())
    share = [shapley(polynomials[0], k) * factorial(n) for k in range(n)]
    gone = corner[0]
    for order in permutations(range(n)):
        before = 0
        for step, k in enumerate(order, 1):
            after = before | 1 << k
            removed = gone[after] - gone[before]
            lost = [c[after] - c[before] for c in corner[1:]]
            yield ("".join(filters[i] for i in order), step, rows - gone[after], removed, gone[1 << k] - removed, gone[full] - gone[full & ~(1 << k)], *lost, int(share[k]))
            before = after


def audit(counted: DataFrame, filters: str, kinds: tuple[str, ...] = (), part: str = "part") -> DataFrame:
    """Every order and step for each part: part, filter_order, step, kept, removed, redundant, unique_fails, the losses named by kinds, shapley.

    counted: part, mask (int, bit k for filters[k]), n and a column of each kind, with several rows a part and mask where need be.
    """
    if not 1 <= len(filters) <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} filters")
    sums = counted.groupBy(part, "mask").agg(*(F.sum(c).cast("long").alias(c) for c in ("n", *kinds)))
    parts = sums.groupBy(part).agg(F.collect_list(F.struct("mask", "n", *kinds)).alias("masks"))  # 2^filters at most
    fields = [T.StructField(part, counted.schema[part].dataType), T.StructField("filter_order", T.StringType()), T.StructField("step", T.IntegerType())]
    fields += [T.StructField(c, T.LongType()) for c in ("kept", "removed", "redundant", "unique_fails", *kinds, "shapley")]
    types = [pa.string(), pa.int32()] + [pa.int64()] * (len(fields) - 3)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(part)
            for at, masks in enumerate(batch.column("masks").to_pylist()):
                own = list(zip(*audit_part({m["mask"]: (m["n"], *(m[k] or 0 for k in kinds)) for m in masks}, filters), strict=True))
                name = names.take(pa.array([at] * len(own[0])))
                yield pa.RecordBatch.from_arrays([name, *(pa.array(c, t) for c, t in zip(own, types, strict=True))], names=[f.name for f in fields])

    return parts.mapInArrow(run, T.StructType(fields))


def text_failures(text: Column) -> Column:
    """Mask of the filters A to D that a text fails: short, repetitive, loud, with symbols."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    failed = (n < 100, 100 * distinct.cast("long") < 80 * n.cast("long"), 100 * capitals.cast("long") > 10 * F.length(text).cast("long"), text.rlike(r"[#$%&*|]"))
    mask = F.lit(0)
    for k, c in enumerate(failed):
        mask = mask + F.when(c, 1 << k).otherwise(0)
    return mask.cast("int")


def document_masks(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask, n): rows of docs (doc_id, text, lang) by the filters they fail.

    Copies meet by the digest of their text, combined before the shuffle; whether a row is the first of its copies is
    looked up by (digest, doc_id), so the copies of one text stay spread out.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.coalesce(F.col("lang"), F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("key"), text_failures(text).alias("mask"))
    own = materialize(rows.groupBy("key", "doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("n")), "masks")
    first = own.groupBy("key").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    repeats = F.col("doc_id").isNotNull() & F.col("first").isNull()
    judged = own.join(first, ["key", "doc_id"], "left").withColumn("mask", F.col("mask") + F.when(repeats, 16).otherwise(0))
    return judged.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five document filters by lang, with what each step loses of good and removes of toxic rows."""
    marked = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("bad")).where("good = 1 or bad = 1")
    marked = F.broadcast(marked) if labels.count() <= BROADCAST_LABELS else marked
    joined = document_masks(docs).join(marked, "doc_id", "left")
    loss = lambda c, name: (F.col("n") * F.coalesce(c, F.lit(0))).alias(name)
    return audit(joined.select("part", "mask", "n", loss("good", "good_lost"), loss("bad", "toxic_lost")), FILTERS, ("good_lost", "toxic_lost"))


def duckdb_sql() -> str:
    """The same by simulating each order on the rows by mask."""
    cells = ", ".join(f"('{f}', {1 << k})" for k, f in enumerate(FILTERS))
    differ = " AND ".join(f"f{b}.f <> f{a}.f" for a in range(1, 6) for b in range(a + 1, 6))
    return rf"""WITH l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first FROM documents),
m AS (SELECT part, CAST(len(w) < 100 AS INT) + 2 * CAST(100 * len(list_distinct(w)) < 80 * len(w) AS INT) + 4 * CAST(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) AS INT)
 + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT) + 16 * CAST(coalesce(doc_id > first, false) AS INT) AS mask, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad FROM d LEFT JOIN l USING (doc_id)),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM m GROUP BY ALL), f(f, bit) AS (VALUES {cells}),
o AS (SELECT f1.f || f2.f || f3.f || f4.f || f5.f AS filter_order, [f1.bit, f2.bit, f3.bit, f4.bit, f5.bit] AS b FROM f f1, f f2, f f3, f f4, f f5 WHERE {differ}),
s AS (SELECT filter_order, CAST(k AS INT) AS step, b[k] AS own, coalesce(list_sum(b[1:k-1]), 0) AS before FROM o, range(1, 6) t(k)),
r AS (SELECT part, filter_order, step, own, sum(CASE WHEN mask & (own | before) = 0 THEN n ELSE 0 END) AS kept, sum(CASE WHEN mask & own > 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
 sum(CASE WHEN mask & own > 0 AND mask & before > 0 THEN n ELSE 0 END) AS redundant, sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
 sum(CASE WHEN mask & own > 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN mask & own > 0 AND mask & before = 0 THEN bad ELSE 0 END) AS toxic_lost FROM c, (SELECT filter_order, step, CAST(own AS INT) AS own, CAST(before AS INT) AS before FROM s) GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r"""
