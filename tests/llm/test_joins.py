"""The Jaccard join, nearest neighbours and the pipeline against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quakeframe.llm import ann, bpe, decontaminate, jaccard, langid, secrets
from quakeframe.llm.words import key_fold


def sets_of(text, size):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    return frozenset(tuple(words[k : k + size]) for k in range(len(words) - size + 1)) if len(words) >= size else frozenset([tuple(words)] if words else [])


def brute_components(rows, size, percent):
    sets = [sets_of(t, size) for _, t in rows]
    up = list(range(len(rows)))

    def top(k):
        while up[k] != k:
            k = up[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is None or rows[b][0] is None or not sets[a] or not sets[b]:
                continue
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                up[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(i, least.get(top(k), i))
    return sorted(((i if i is not None else -1), len(sets[k]), (least[top(k)] if i is not None else None) or 0) for k, (i, _) in enumerate(rows))


def near_copies(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"v{k}" for k in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(50)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.randint(6, 120))] for _ in range(6)]
    rows = []
    for k in range(n):
        words = list(rng.choice(bases)) if rng.random() < 0.7 else [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.2:
            words += passage
        for _ in range(rng.randint(0, 4)):
            if words:
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((k, rng.choice([" ", "  ", "\n"]).join(words)))
    return rows + [(n + 1, None), (n + 2, ""), (n + 3, "one two"), (n + 4, "One  TWO"), (None, rows[0][1]), (None, None), (2, rows[5][1]), (n + 5, rows[1][1]), (n + 6, "long " * 20_000)]


@pytest.mark.parametrize(("size", "percent", "chunk"), [(4, 85, 256), (5, 80, 7), (4, 50, 3), (3, 20, 256)])
def test_jaccard_components(spark, monkeypatch, size, percent, chunk):
    monkeypatch.setattr(jaccard, "CHUNK_ROWS", chunk)
    rows = near_copies(size, 140)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("clash")).repartition(3)
    got = jaccard.components(df, size=size, percent=percent).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_shingles, r.component_id or 0) for r in got) == brute_components(rows, size, percent)


def test_one_shared_shingle_links_at_low_thresholds(spark):
    rows = [(1, "a b c d"), (2, "a b c d e"), (3, "p q r s t"), (4, "s t u v w")]
    got = {r.doc_id: r.component_id for r in jaccard.components(spark.createDataFrame(rows, "doc_id long, text string"), size=4, percent=50).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}


def test_a_group_of_near_copies_costs_its_size(spark, monkeypatch):
    """300 near copies of one text: each is held against the leader, and hardly any pair of chunks is compared."""
    monkeypatch.setattr(jaccard, "CHUNK_ROWS", 16)
    rng = random.Random(17)
    base = [f"w{k}" for k in range(200)]
    rows = []
    for k in range(300):
        words = list(base)
        words[rng.randrange(200)] = f"own{k}"
        rows.append((k, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    made = []
    tiles = jaccard._tiles
    monkeypatch.setattr(jaccard, "_tiles", lambda *a: made.append(tiles(*a)) or made[-1])
    assert {r.component_id for r in jaccard.components(df).collect()} == {0}
    leaders = made[-1].select("leader").distinct().count()
    assert sum(m.count() for m in made) <= 300 * (leaders + 2) and brute_components(rows[:40], 5, 80)


def test_jaccard_ignores_columns_that_clash(spark):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "other words that stand alone")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("key", "n", "sig", "mark", "leader", "component_id", "n_shingles", "block")})
    got = jaccard.components(df)
    assert got.columns == ["doc_id", "n_shingles", "component_id"] and {r.doc_id: r.component_id for r in got.collect()} == {1: 1, 2: 1, 3: 3}


def test_jaccard_empty(spark):
    assert jaccard.components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_prefix_of_any_length_meets_partners():
    rng = np.random.default_rng(7)
    levels = np.zeros(1 << 16, np.uint8)
    for _ in range(200):
        base = np.unique(rng.integers(0, 1 << 62, 60).astype(np.uint64))
        other = np.unique(np.concatenate([base[rng.random(len(base)) < 0.97], rng.integers(0, 1 << 62, 2).astype(np.uint64)]))
        both = len(np.intersect1d(base, other))
        if 100 * both < 85 * (len(base) + len(other) - both):
            continue
        (a, la), (b, lb) = (jaccard.ordered_prefix(s, levels, 0.0, 85) for s in (base, other))
        assert len(np.intersect1d(base[a], other[b])) >= min(la, lb)


def test_nearest(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(12, 16))
    x = (centres[rng.integers(0, 12, 3000)] + 0.5 * rng.normal(size=(3000, 16))).astype(np.float32)
    x[100:1100] = x[100]  # one very common vector
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(9000, None), (9020, [0.0] * 16), (9040, [float("nan")] * 16), (9060, [1.0, None] * 8), (9080, [1.0] * 3), (9100, [float("inf")] * 16), (None, x[0].tolist())]
    got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(0)), F.col("vec_id") % 20 == 0).collect()
    by_query = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by_query.setdefault(r.query_id, []).append(r)
    assert set(by_query) == set(range(0, 3000, 20))
    hit, exact = 0, x.astype(float)
    for q, found in by_query.items():
        score = exact @ exact[q]
        score[q] = -np.inf
        order = np.lexsort((np.arange(3000), -score))[:20]
        assert [r["rank"] for r in found] == list(range(1, 21)) and all(r.score == pytest.approx(score[r.vec_id], rel=1e-12) for r in found)
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
        hit += sum(score[r.vec_id] >= score[order[-1]] - 1e-9 for r in found)
    assert hit >= 0.9 * 20 * len(by_query)


def test_nearest_of_the_usual_width(spark):
    rows = [(20 * k, [float(k), 1.0]) for k in range(4)] + [(7, [9.0, 9.0, 9.0]), (100, [9.0])]
    got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash")), F.col("vec_id") % 20 == 0).collect()
    assert {r.vec_id for r in got} == {r.query_id for r in got} == {0, 20, 40, 60}


def test_nearest_few_and_none(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [0.5, 0.5])], "vec_id long, embedding array<float>")
    got = [(r.query_id, r["rank"], r.vec_id) for r in ann.search(few, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 20), (0, 2, 3), (20, 1, 0), (20, 2, 3)]
    assert ann.search(few.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_nearest_of_repeated_ids_and_equal_vectors(spark):
    rows = [(20, [1.0, 0.0]), (20, [0.0, 1.0]), (20, [1.0, 0.0]), (3, [0.6, 0.8]), (40, [0.5, 0.5])]
    got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(2), F.col("vec_id") % 20 == 0).collect()
    found = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 6)) for r in got)
    want = []
    for a, (q, v) in enumerate(rows):
        others = sorted((-sum(np.float32(x) * np.float32(y) for x, y in zip(v, w)), i) for b, (i, w) in enumerate(rows) if b != a)
        want += [(q, k + 1, i, round(float(-s), 6)) for k, (s, i) in enumerate(others)] if q % 20 == 0 else []
    assert found == sorted(want)
    equal = spark.createDataFrame([(k, [1.0, 2.0]) for k in range(100)], "vec_id long, embedding array<float>")
    got = {}
    for r in ann.search(equal, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {q: [k for k in range(21) if k != q][:20] for q in range(0, 100, 20)}


def test_clusters_are_probed_in_few_parts():
    rng = np.random.default_rng(10)
    centres = 4 * rng.normal(size=(40, 24))
    clustered = centres[rng.integers(0, 40, 4000)] + 0.3 * rng.normal(size=(4000, 24))
    share = {}
    for name, x in (("clustered", clustered), ("random", rng.normal(size=(4000, 24)))):
        router = ann.learn(x, 40_000, x[:0])
        near = ann.neighbour_graph(x, 16)[:300]
        router.probed = ann.probability_needed(router, np.repeat(x[:300], 16, axis=0), x[near.ravel()])
        _, before = ann.route(router, x)
        share[name] = (before <= router.probed).mean()
    assert share["clustered"] < 0.5 * share["random"]


def exact_nearest(x, queries, nearest=20):
    """Every pair by one fixed-order double sum; ties to the smaller id."""
    x = x.astype(float)
    out = {}
    for q in queries:
        score = np.zeros(len(x))
        for k in range(x.shape[1]):
            score += x[q, k] * x[:, k]
        score[q] = -np.inf
        out[q] = [(score[i], i) for i in np.lexsort((np.arange(len(x)), -score))[:nearest].tolist()]
    return out


def unlike_queries():
    """Tables whose queries differ from the other rows: repeated vectors and others as queries, and clusters with queries between."""
    rng = np.random.default_rng(11)
    repeated = rng.normal(size=(20, 32))[rng.integers(0, 20, 3000)]
    repeated[::20] = rng.normal(size=(150, 32))
    centres = 6 * rng.normal(size=(60, 32))
    clusters = centres[rng.integers(0, 60, 6000)] + 0.2 * rng.normal(size=(6000, 32))
    clusters[::20] = (centres[rng.integers(0, 60, 300)] + centres[rng.integers(0, 60, 300)]) / 2 + 0.5 * rng.normal(size=(300, 32))
    return {"repeated": repeated.astype(np.float32), "clusters": clusters.astype(np.float32)}


@pytest.mark.parametrize("name", ["repeated", "clusters"])
def test_nearest_where_queries_differ_from_the_table(spark, name):
    x = unlike_queries()[name]
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(5)
    found = {}
    for r in ann.search(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.score, r.vec_id))
    want = exact_nearest(x, range(0, len(x), 20))
    assert set(found) == set(want) and all(len(f) == 20 for f in found.values())
    assert all(f == sorted(f, key=lambda p: (-p[0], p[1])) for f in found.values())
    hit = sum(len({i for _, i in found[q]} & {i for _, i in want[q]}) for q in want)
    assert hit >= 0.9 * 20 * len(want)
    by_id = {q: dict((i, s) for s, i in own) for q, own in want.items()}
    assert all(by_id[q].get(i, s) == s for q, own in found.items() for s, i in own)  # the very bits


def test_ties_keep_their_order_in_cells_of_any_size():
    rng = np.random.default_rng(12)
    one = rng.normal(size=(1, 64))
    queries = rng.normal(size=(100, 64))
    for n in (100, 333, 1001, 2000):
        ids = rng.permutation(10 * n)[:n]
        got = ann._best(np.arange(100) + 10**6, np.arange(100), queries, np.arange(n), ids, np.repeat(one, n, axis=0), 20, 0)
        assert all([p["vec_id"] for p in row] == sorted(ids.tolist())[:20] and len({p["away"] for p in row}) == 1 for row in got.column("near").to_pylist())


def test_a_cell_of_many_queries_is_copied(spark, monkeypatch):
    monkeypatch.setattr(ann, "CELL_QUERIES", 7)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 3)
    rng = np.random.default_rng(13)
    x = rng.normal(size=(600, 8)).astype(np.float32)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for r in ann.search(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    want = exact_nearest(x, range(0, 600, 20))
    hit = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert len(got) == 30 and hit >= 0.9 * 600


def test_parts_are_balanced():
    rng = np.random.default_rng(9)
    graph = ann.neighbour_graph(rng.normal(size=(500, 8)), 8)
    size = np.bincount(ann.balanced_parts(graph, 6), minlength=6)
    assert size.sum() == 500 and size.max() <= np.ceil(1.1 * 500 / 6)


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("doc_id", F.col("doc_id") + 1000)
    extra = [(1, None, "en", "s", None), (2, "", "en", "s", 0), (3, "12 34 !", None, "s", 7), (None, "a lone text with letters", "en", None, 24), (4, "api_key = abcdefgh12345 and more words here", "en", "s", 43)]
    very_long = " ".join(f"the house and the garden of the town number{k}" for k in range(20_000)) + " password = abcdefgh12345"
    extra += [(6, very_long, "en", "s", len(very_long))]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    item = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").orderBy("item_id").first()
    docs = docs.unionByName(spark.createDataFrame([(5, f"before it {item.text} after", "en", "s", 10)], docs.schema))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    out, now = [], docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, now, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        out.append(now)
    assert all(d.columns == docs.columns for d in out[:4])
    spoken, single, clean, cut, coded = out
    assert {1, 2, 3}.isdisjoint(r.doc_id for r in spoken.collect()) and spoken.count() == docs.count() - 3
    rows = [(r.doc_id, r.text) for r in spoken.collect()]
    expected = {c for i, _, c in brute_components(rows, 5, 80) if i != -1}
    assert {r.doc_id for r in single.where("doc_id is not null").collect()} == expected and single.where("doc_id is null").count() == 1
    assert 5 not in {r.doc_id for r in clean.collect()} and clean.count() >= 0.9 * single.count()
    assert cut.count() == clean.count() and cut.where("doc_id = 4").first().text.startswith("[SECRET] and more")
    assert cut.where("doc_id = 6").first().text == very_long.replace("password = abcdefgh12345", "[SECRET]")
    texts = {r.doc_id: r.text for r in cut.collect()}
    for r in coded.collect():
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == set(texts)


CLASHES = ("score", "secrets", "matches", "lang_pred", "component_id", "row", "rank")


def test_pipeline_keeps_columns_that_clash(spark, tmp_path):
    """Columns named like an operator's own come out as they went in; rows under one doc_id are near copies like any."""
    base = " ".join(f"alpha{k} beta{k} gamma" for k in range(30))
    rows = [(1, base, "en", "s", 9), (1, base + " tail", "en", "s", 9), (1, base, "en", "s", 9), (1, "quite another text of its own here", "en", "s", 9), (2, "password = abcdefgh1234 and so on", "en", "s", 9), (None, base, "en", "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in CLASHES})
    spark.createDataFrame([(1, "words that stand in no document at all")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        stage(spark, now, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        assert now.dtypes == docs.dtypes, name
        assert all(r[c] == (None if r.doc_id is None else f"{c}{r.doc_id}") for r in now.collect() for c in CLASHES)
        if k == 1:
            assert sorted((str(r.doc_id), r.text[:20]) for r in now.collect()) == sorted([("1", base[:20]), ("1", "quite another text o"), ("2", "password = abcdefgh1"), ("None", base[:20])])
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_pipeline_parts_are_the_operators(spark):
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["identify_language", "keep_one_of_near_copies", "remove_benchmark_leaks", "cut_out_secrets", "encode_and_decode"]
    assert all(m is not None for m in (bpe, decontaminate, langid, secrets, key_fold))
