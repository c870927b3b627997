"""Whole results where bounded models or look-ups would lose some."""

import math
import random
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quakeframe.llm import langid, licenses, queries, toxicity
from tests.llm.test_rowwise import brute_losses


def test_lm_tells_all_words_apart(spark, tmp_path):
    """op10 equals bigrams over the real words; a vocabulary or context of fixed size would merge some of these 6,000."""
    rng = random.Random(7)
    docs = [(k, " ".join(f"w{rng.randrange(20_000 if k % 2 else 40)}" for _ in range(40))) for k in range(200)] + [(None, "w1 w2"), (500, None), (501, "w1"), (501, "w1")]
    good = {k for k in range(0, 200, 3)}
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, int(k in good), 0) for k in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    tokens = [(t or "").split() for _, t in docs]
    losses = brute_losses(tokens, [k in good for k, _ in docs])
    want = sorted((str(k), len(t), *own) for (k, _), t, own in zip(docs, tokens, losses))
    got = sorted((str(r.doc_id), r.n_tokens, r.target_loss, r.background_loss) for r in queries.op10_lm_score(spark, str(tmp_path)).collect())
    assert [g[:2] for g in got] == [w[:2] for w in want]
    for g, w in zip(got, want):
        assert g[2:] == pytest.approx(w[2:])


def test_no_license_text_is_lost_among_rarer_words(spark):
    """A Creative Commons notice in a text with the whole BSD and MIT grants, whose words are rarer."""
    bsd, mit, cc = (next(t for t in licenses.TEXTS if t.name == n) for n in ("bsd notice", "mit grant", "cc by notice"))
    bundle = f"{bsd.text}. {mit.text}. {cc.text}"
    rows = [(0, bundle)] + [(k, cc.text) for k in range(1, 30)] + [(50, "text under cc by 4 0"), (51, mit.text.replace("free", "totally free")), (52, "by 4 0 cc licensed under")]
    got = {r.doc_id: {f.name: f.share for f in r.found} for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == {bsd.name: 1.0, mit.name: 1.0, cc.name: 1.0}
    assert got[1] == {cc.name: 1.0} and got[50] == {cc.name: 1.0} and set(got[51]) == {mit.name} and got[52] == {}


def test_toxicity_counts_every_labelled_row(spark):
    """An expression that stands only in the texts that the curve is fitted on is known to the model."""
    rng = random.Random(9)
    rows = []
    for k in range(800):
        text = [f"word{rng.randrange(200)}" for _ in range(30)] + (["vile"] * 2 if k % 4 == 0 else [])
        rng.shuffle(text)
        rows.append((k, " ".join(text), int(k % 4 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    chosen = {r.doc_id for r in df.where("toxic = 1").orderBy(F.xxhash64(F.lit(12), F.xxhash64("text"))).limit(toxicity._curve_texts(200)).collect()}
    own = F.when(F.col("doc_id").isin(*chosen), F.concat(F.lit("rotten rotten "), "text", F.lit(" rotten"))).otherwise(F.col("text"))
    pairs = toxicity.pair_counts(df.select(own.alias("text"), "toxic", F.col("doc_id").isin(*chosen).alias("curve"))).cache()
    value = lambda model, w: model.word[1][s] / model.word[0][s] if (s := toxicity._words(pa.array([w]))[0][0]) is not None else None
    whole, apart = (toxicity._model(pairs, x) for x in (False, True))
    assert value(whole, "rotten") > 3 and value(whole, "vile") > 3 and value(whole, "word7") < 2
    assert value(apart, "rotten") == pytest.approx(1, abs=0.1) and value(apart, "vile") > 3
    counts = pairs.agg(*(F.sum(c) for c in ("toxic", "toxic_apart"))).first()
    assert counts[0] > counts[1] > 0


def test_language_query_equals_brute_force(spark, tmp_path):
    """Fit, fold and prediction of op7 over every segmentation of every word, in plain Python."""
    vocabulary = {"en": "the cat and dog sat on mat was here".split(), "fr": "le chat et la table été sur ici".split(), "de": "der hund und die katze saß auf".split()}
    rng = random.Random(18)
    docs = [(k, " ".join(rng.choice(vocabulary[lang]) for _ in range(rng.randint(1, 8))), lang) for k, lang in enumerate(rng.choice(sorted(vocabulary)) for _ in range(60))]
    docs += [(100, None, "en"), (101, "", "fr"), (102, "12 34", "de"), (103, "The CAT", None), (None, "le chat", "fr"), (104, "qqq 日本 zzz", None), (105, "le chat", "fr"), (105, "le chat", "fr")]
    spark.createDataFrame([(*d, "s", 1) for d in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    _, ids = langid._pieces(None)
    held = lambda k: k is not None and zlib.crc32(str(k).encode()) % 4 == 2
    langs = sorted(vocabulary)

    def cuts(text):
        if not text:
            yield []
        for n in range(1, len(text) + 1):
            piece = ids.get(text[:n], -1 if n == 1 else None)
            if piece is not None:
                for rest in cuts(text[n:]):
                    yield [piece, *rest]

    counts = {lang: Counter() for lang in langs}
    for k, text, lang in docs:
        if lang and text and k is not None and not held(k):
            for w in text.lower().split():
                weights = [(c, math.prod(1 / len(ids) if p >= 0 else langid.UNKNOWN for p in c)) for c in cuts("▁" + w)]
                for c, x in weights:
                    for p in c:
                        if p >= 0:
                            counts[lang][p] += x / sum(y for _, y in weights)
    total = {lang: sum(counts[lang].values()) + langid.PRIOR * len(set(ids.values())) for lang in langs}
    prob = lambda lang, p: (counts[lang][p] + langid.PRIOR) / total[lang] if p >= 0 else langid.UNKNOWN
    want = []
    for k, text, _ in docs:
        if text is None or not any(c.isalpha() for c in text):
            want.append((k, held(k), "und", 0.0))
            continue
        logs = [sum(math.log(sum(math.prod(prob(lang, p) for p in c) for c in cuts("▁" + w))) for w in text.lower().split()) for lang in langs]
        best = max(range(len(langs)), key=lambda j: (logs[j], -j))
        want.append((k, held(k), langs[best], 1 / sum(math.exp(x - logs[best]) for x in logs)))
    got = sorted((str(r.doc_id), r.held_out, r.lang_pred, r.score) for r in queries.op7_language_id(spark, str(tmp_path)).collect())
    want = sorted((str(k), *own) for k, *own in want)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want], rel=1e-6)
