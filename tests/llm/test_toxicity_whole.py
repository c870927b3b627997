"""The toxicity model and its curve take every labelled text."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quakeframe.llm import toxicity


def test_curve_and_counts_take_every_labelled_text(spark, monkeypatch):
    rng = random.Random(21)
    rows = [(k, " ".join(f"w{rng.randrange(60)}" for _ in range(12)) + (" vile scum" if k % 5 == 0 else ""), int(k % 5 == 0)) for k in range(300)]
    rows += [(1000 + k, rows[k][1], rows[k][2]) for k in range(20)]  # copies
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "_logistic", lambda table, *_, fit=toxicity._logistic: seen.append((table.count(), table.agg(F.sum("y")).first()[0])) or fit(table))
    model = toxicity.fit(df, df)
    assert toxicity.MODEL_TEXTS is None and seen == [(300, 60)]
    pairs = toxicity.pair_counts(df.select("text", "toxic", F.lit(False).alias("curve")))
    assert model.model.seen[1].sum() == pytest.approx(pairs.agg(F.sum("toxic")).first()[0])


def test_halves_count_apart(spark):
    rows = [("a b c", 1, True), ("a b c", 1, False), ("a b d", 1, True), ("a b e", 0, False), ("a b f", 0, True)]
    got = toxicity.pair_counts(spark.createDataFrame(rows, "text string, toxic int, curve boolean")).agg(*(F.sum(c).alias(c) for c in ("ordinary", "toxic", "ordinary_apart", "toxic_apart", "ordinary_own", "toxic_own"))).first()
    assert tuple(got) == (3 + 3 - 2, 3 + 1, 3, 3, 3, 3 + 1)


def test_logistic_equals_plain_newton(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 3))
    y = (rng.random(400) < 1 / (1 + np.exp(-(x @ [1.0, -2.0, 0.5] - 1)))).astype(float)
    a, w = np.hstack([x, np.ones((400, 1))]), np.zeros(4)
    for _ in range(30):
        p = 1 / (1 + np.exp(-(a @ w)))
        w += np.linalg.solve((a.T * (p * (1 - p) + 1e-9)) @ a + 1e-2 * np.eye(4), a.T @ (y - p) - 1e-2 * w)
    table = spark.createDataFrame(np.column_stack([x, y]).tolist(), ", ".join(f"{n} double" for n in (*toxicity.FEATURES, "y"))).repartition(3)
    assert toxicity._logistic(table) == pytest.approx(w, abs=1e-7)
