"""Filter audits, fill-in-middle texts and shards against brute force, on odd rows."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from quakeframe.llm import audit, fim, shards
from tests.llm.test_rowwise import DOCS, ODD

LABELS = "doc_id long, quality int, toxic int"
LONG = " ".join(f"w{k}" for k in range(150))
AUDITED = [(1, LONG, "en"), (2, LONG, "en"), (2, LONG, "de"), (None, LONG, None), (3, None, None), (4, "", "fr"), (4, None, "fr"), (5, "A B $ " * 40, "en"), (5, "A B $ " * 40, "en"), (6, LONG.upper(), "en"), (7, LONG + " #", "de"), (8, "x " * 50_000, "de"), (9, "a b \x0b c", "en")]


def brute_audit(rows, labels):
    first = {}
    for k, t, _ in rows:
        if k is not None:
            first[t or ""] = min(first.get(t or "", k), k)
    good, bad = ({k for k, q, x in labels if k is not None and (q, x)[j] == 1} for j in (0, 1))
    judged = []
    for k, t, lang in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = [len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), bool(re.search(r"[#$%&*|]", t)), k is not None and k > first[t]]
        judged.append((lang or "", dict(zip("ABCDE", fails)), k in good, k in bad))
    out, shapley = {}, Counter()
    for part in {j[0] for j in judged}:
        own = [j for j in judged if j[0] == part]
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [j for j in left if j[1][f]]
                left = [j for j in left if not j[1][f]]
                fails = [j for j in own if j[1][f]]
                out[part, "".join(order), step] = (len(left), len(gone), len(fails) - len(gone), sum(sum(j[1].values()) == 1 for j in fails), sum(j[2] for j in gone), sum(j[3] for j in gone))
                shapley[part, f] += len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


@pytest.mark.parametrize("broadcast", [2_000_000, -1])
def test_audit_of_odd_rows(spark, monkeypatch, broadcast):
    monkeypatch.setattr(audit, "BROADCAST_LABELS", broadcast)
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, None), (5, 1, 1), (8, None, 1), (None, 1, 1), (99, 1, 1)]
    docs = spark.createDataFrame(AUDITED, DOCS + ", lang string").withColumns({"mask": F.lit("clash"), "key": F.lit(3), "n": F.lit(4)})
    got = audit.audit_documents(docs, spark.createDataFrame(labels, LABELS).withColumn("part", F.lit("clash")))
    assert dict(got.dtypes)["step"] == "int" and {dict(got.dtypes)[c] for c in ("kept", "shapley", "good_lost")} == {"bigint"}
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got.collect()} == brute_audit(AUDITED, labels)


def test_audit_of_no_rows(spark):
    docs, labels = spark.createDataFrame([], DOCS + ", lang string"), spark.createDataFrame([], LABELS)
    assert audit.audit_documents(docs, labels).collect() == []
    assert audit.audit_documents(spark.createDataFrame(AUDITED[:2], docs.schema), labels).count() == 600


def test_shapley_by_the_extension_is_the_mean_over_orders():
    rng = random.Random(4)
    for filters in (1, 3, 4):
        counts = {rng.randrange(1 << filters): rng.randrange(50) for _ in range(10)}
        p = audit.removal_polynomial(counts, filters)
        removed = lambda s: sum(n for m, n in counts.items() if m & s)
        assert all(audit.at_corner(p, s) == removed(s) for s in range(1 << filters))
        orders = list(itertools.permutations(range(filters)))
        for k in range(filters):
            before = [sum(1 << i for i in o[: o.index(k)]) for o in orders]
            assert audit.shapley(p, k) == Fraction(sum(removed(s | 1 << k) - removed(s) for s in before), len(orders))
        assert sum(audit.shapley(p, k) for k in range(filters)) == removed((1 << filters) - 1)


def brute_fim(text, key, seed=42):
    tokens = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(tokens)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(t) for t in (tokens[:a], tokens[a:b], tokens[b:]))
    if not text or h[2] % 100 >= 50 or any(x in text for x in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    return (n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 80 else (n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def test_fim_equals_regular_expression_and_restores(spark):
    rng = random.Random(3)
    alphabet = ["a", "é", "😀", "日", " ", " ", "\t", "\n", "\x0b", "\x0d", " ", "\xa0", "<", "S", ">", "<P", "M>", "\x00"]
    rows = [(k, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))) for k in range(600)] + [(k + 1000, t) for k, t in enumerate(["<S>", "a <M> b", " ", "x", "word " * 60_000, "x" * 300_000])] + ODD
    df = spark.createDataFrame(rows, DOCS).withColumns({"n": F.lit("clash"), "output": F.lit(1), "extra": F.lit("stays")})
    got = fim.transform(df).withColumn("back", fim.restore(F.col("output"), F.col("form"))).collect()
    want = Counter((k, t, *brute_fim(t or "", "" if k is None else k)) for k, t in rows)
    assert Counter((r.doc_id, r.text, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got) == want
    assert all(r.back == (r.text or "") and r.extra == "stays" for r in got)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fim.transform(df.limit(0)).count() == 0 and "text" not in fim.transform(df, keep_text=False).columns


def test_shards_of_odd_rows(spark):
    rng = random.Random(5)
    rows = ODD + [(k, "x" * rng.randrange(200)) for k in range(500)] + [(77, "same words")] * 400 + [(77, f"t{k}") for k in range(100)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, DOCS).withColumns({"size": F.lit("clash"), "shard": F.lit("clash"), "__p": F.lit(1)})
    size = lambda t: len((t or "").encode()) + 1
    for n in (1, 7, 16, 5000):
        got = shards.shard(df, n).collect()
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((k, size(t), zlib.crc32((t or "").encode())) for k, t in rows)
        total, before, want = sum(size(t) for _, t in rows), 0, Counter()
        slots = Counter()
        for k, z, c in sorted(((-1 if k is None else k, size(t), zlib.crc32((t or "").encode())) for k, t in rows)):
            at = (2 * before + z) * n // (2 * total)
            want[k, z, c, at, slots[at]] += 1
            slots[at] += 1
            before += z
        assert Counter((-1 if r.doc_id is None else r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in got) == want
        assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}


def test_shards_are_balanced_and_copies_stay_together(spark):
    rows = [(k, f"text {k % 37} " * (1 + k % 5)) for k in range(3000)]
    df = spark.createDataFrame(rows, DOCS)
    got = shards.shard(df, 8).collect()
    sums = Counter()
    for r in got:
        sums[r.shard] += r.size
    assert len(sums) == 8 and max(sums.values()) - min(sums.values()) <= max(r.size for r in got)
    together = shards.shard(df, 8, by_text=True).collect()
    parts = {}
    for r in together:
        parts.setdefault(r.text_crc32, set()).add(r.shard)
    assert sum(len(p) > 1 for p in parts.values()) <= 7
    assert shards.shard(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        shards.shard(df, 0)
