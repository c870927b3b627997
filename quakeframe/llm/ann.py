"""Approximate nearest neighbours by learned partitions.

On a bounded, documented sample of the vectors, a nearest-neighbour graph is
built and cut into balanced parts: greedy growth from spread-out seeds under a
size limit, then rounds in which vectors move to the part of most of their
neighbours while it has room. A small classifier (one hidden layer) learns the
part of a sample vector's neighbours from the vector. It routes every vector of
the table to its most probable part, and every query to several; parts are cut
into cells of bounded size, so a part that holds a third of all rows, or one very
common vector, is spread over tasks. Queries meet each cell of their parts in
blocks, and a cell that very many queries ask is copied so that they are dealt over
tasks. How much probability a query probes is measured on a bounded sample of the
queries themselves and their true nearest among all rows, found by a pass over the table: so much that AIM
of these lie in the parts probed. The classifier learns from a sample of the queries, too. Vectors that
cluster need few parts, random directions most of them.

A cell's best are chosen by a matrix product, with a margin for its rounding; each of them then gets its score by a
sum in one fixed order, so equal vectors have equal scores wherever they stand. Ties go to the smaller id.

Vectors that are null, zero, of another length than the usual one, or that hold
null or non-finite components take no part, neither as queries nor as
candidates; rows with a null id neither. Each row is its
own candidate and its own query: an id that occurs twice is two candidates, and two
queries that find each other. Further columns are ignored, an empty table gives no
rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakeframe.session import materialize

#: Vectors that the parts and the classifier are learned from, at most.
SAMPLE_ROWS = 20_000
#: Queries that the classifier is trained on, and queries whose true neighbours are found to measure how much to probe, at most.
TRAINING_QUERIES, MEASURED_QUERIES = 4_000, 500
#: Neighbours of a sample vector in the graph.
GRAPH_DEGREE = 16
#: There is a part for each PART_ROOT in the root of the number of rows, and PART_SAMPLE vectors of the sample in each at least.
PART_ROOT, PART_SAMPLE = 8, 50
HIDDEN = 64
#: Share of the measured queries' true neighbours that must lie in the parts they probe.
AIM = 0.97
#: A query is routed to parts until their probabilities add up to what is probed, to this share of the parts at least.
LEAST_SHARE = 0.02
#: Rows of a cell, and queries in a block.
CELL_ROWS, BLOCK_QUERIES = 2_000, 1_000
#: Queries that meet a cell in one task, about.
CELL_QUERIES = 20_000


def usable(vector: Column, width: int | None = None) -> Column:
    """Whether a vector takes part."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0)
    return F.coalesce(fine & (F.size(vector) == width if width else F.size(vector) > 0), F.lit(False))


def neighbour_graph(x: np.ndarray, degree: int) -> np.ndarray:
    """Ids of the nearest by inner product of each row but itself, in blocks of rows."""
    degree = min(degree, len(x) - 1)
    out = np.zeros((len(x), max(degree, 0)), np.int64)
    for a in range(0, len(x), 128):
        near = x[a : a + 128] @ x.T
        near[np.arange(len(near)), np.arange(a, a + len(near))] = -np.inf
        if degree > 0:
            out[a : a + 128] = np.argpartition(near, len(x) - degree, axis=1)[:, -degree:]
    return out


def balanced_parts(graph: np.ndarray, parts: int, rounds: int = 12, slack: float = 1.1, seed: int = 5) -> np.ndarray:
    """The part of each vertex; no part has more than slack times the mean."""
    n = len(graph)
    room = math.ceil(slack * n / parts)
    rng = np.random.default_rng(seed)
    part = np.full(n, -1)
    size = np.zeros(parts, np.int64)
    links: list[list[int]] = [[] for _ in range(n)]
    for v in range(n):
        for u in graph[v].tolist():
            links[v].append(u)
            links[u].append(v)
    order = rng.permutation(n)
    share, at = math.ceil(n / parts), 0
    for k in range(parts):  # grow each part over the graph
        queue: list[int] = []
        while size[k] < share:
            if not queue:
                while at < n and part[order[at]] >= 0:
                    at += 1
                if at == n:
                    break
                queue = [int(order[at])]
            v = queue.pop(0)
            if part[v] < 0:
                part[v] = k
                size[k] += 1
                queue.extend(u for u in links[v] if part[u] < 0)
    for _ in range(rounds):
        moved = 0
        for v in rng.permutation(n).tolist():
            votes = np.bincount(part[links[v]], minlength=parts) if links[v] else np.zeros(parts)
            own = part[v]
            for k in np.argsort(-votes)[:3].tolist():
                if k == own or votes[k] <= votes[own]:
                    break
                if size[k] < room:
                    size[own] -= 1
                    size[k] += 1
                    part[v] = k
                    moved += 1
                    break
        if moved < n // 200:
            break
    return part


@dataclass
class Router:
    """Part probabilities from a vector."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    probed: float = 1.0

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0)
        z = h @ self.w2 + self.b2
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def train_router(x: np.ndarray, target: np.ndarray, epochs: int = 30, seed: int = 6) -> Router:
    """Adam on cross-entropy against soft targets: the parts of a vector and its neighbours."""
    rng = np.random.default_rng(seed)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = (x - mean) / scale
    width, parts = x.shape[1], target.shape[1]
    theta = [rng.normal(0, math.sqrt(2 / width), (width, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, math.sqrt(2 / HIDDEN), (HIDDEN, parts)), np.zeros(parts)]
    m, v, t = [np.zeros_like(p) for p in theta], [np.zeros_like(p) for p in theta], 0
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs)
        order = rng.permutation(len(x))
        for a in range(0, len(x), 256):
            rows = order[a : a + 256]
            h = np.maximum(z[rows] @ theta[0] + theta[1], 0)
            o = h @ theta[2] + theta[3]
            p = np.exp(o - o.max(axis=1, keepdims=True))
            g = (p / p.sum(axis=1, keepdims=True) - target[rows]) / len(rows)
            back = (g @ theta[2].T) * (h > 0)
            t += 1
            for k, grad in enumerate((z[rows].T @ back, back.sum(axis=0), h.T @ g, g.sum(axis=0))):
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.999 * v[k] + 0.001 * grad**2
                theta[k] = theta[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return Router(*theta, mean, scale)


def route(router: Router, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parts of each vector, the most probable first, and the probability of those before each."""
    p = router.probabilities(x)
    order = np.argsort(-p, axis=1, kind="stable")
    own = np.take_along_axis(p, order, axis=1)
    return order, np.cumsum(own, axis=1) - own


def probability_needed(router: Router, queries: np.ndarray, near: np.ndarray) -> float:
    """The probability before the part that a query's neighbour is in, at quantile AIM of all pairs (rows of queries and near)."""
    if not len(queries):
        return 1.0
    order, before = route(router, queries)
    rank = np.argsort(order, axis=1)
    part = route(router, near)[0][:, 0]
    at = rank[np.arange(len(part)), part]
    return float(np.quantile(before[np.arange(len(part)), at], AIM, method="higher"))


def learn(sample: np.ndarray, rows: int, queries: np.ndarray) -> Router:
    """Parts and router from a sample of a table with so many rows and a sample of the queries."""
    parts = int(min(max(round(math.sqrt(rows) / PART_ROOT), 1), max(1, len(sample) // PART_SAMPLE)))
    graph = neighbour_graph(sample, GRAPH_DEGREE)
    part = balanced_parts(graph, parts)
    target = np.zeros((len(sample), parts))
    np.add.at(target, (np.arange(len(sample)), part), 2.0)
    np.add.at(target, (np.repeat(np.arange(len(sample)), graph.shape[1]), part[graph].ravel()), 1.0)
    asked = np.zeros((len(queries), parts))
    degree = min(GRAPH_DEGREE, len(sample))
    for a in range(0, len(queries), 128):
        near = np.argpartition(queries[a : a + 128] @ sample.T, len(sample) - degree, axis=1)[:, -degree:]
        np.add.at(asked, (np.repeat(np.arange(a, a + len(near)), degree), part[near].ravel()), 1.0)
    target = np.vstack([target, asked])
    return train_router(np.vstack([sample, queries]), target / target.sum(axis=1, keepdims=True))


def true_nearest(good: DataFrame, row: np.ndarray, queries: np.ndarray, nearest: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query vector, vector of one of its nearest among all rows but its own), by a pass over the table; queries are few."""
    width = queries.shape[1]
    held = good.sparkSession.sparkContext.broadcast((row, queries))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, q = held.value
        top = np.full((len(q), 0), 0.0)
        vectors = np.zeros((len(q), 0, width))
        for batch in batches:
            x = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            own = batch.column("row").to_numpy(zero_copy_only=False)
            for a in range(0, len(x), 4096):
                score = q @ x[a : a + 4096].T
                score[rows[:, None] == own[None, a : a + 4096]] = -np.inf
                n = min(nearest, score.shape[1])
                at = np.argpartition(-score, n - 1, axis=1)[:, :n]
                top = np.hstack([top, np.take_along_axis(score, at, axis=1)])
                vectors = np.concatenate([vectors, x[a + at]], axis=1)
                keep = np.argsort(-top, axis=1, kind="stable")[:, :nearest]
                top, vectors = np.take_along_axis(top, keep, axis=1), np.take_along_axis(vectors, keep[:, :, None], axis=1)
        if top.shape[1]:
            number = np.repeat(np.arange(len(q)), top.shape[1])
            flat = vectors.reshape(len(number), width)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(number) + 1) * width, pa.int32()), pa.array(flat.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(top.ravel()), lists], names=["q", "score", "v"])

    found = good.select("row", "v").mapInArrow(best, "q long, score double, v array<double>")
    kept = found.where(F.col("score") > float("-inf")).groupBy("q").agg(F.expr(f"slice(sort_array(collect_list(struct(score, v)), false), 1, {nearest})").alias("n"))
    got = kept.select("q", F.explode("n.v").alias("v")).toArrow()  # MEASURED_QUERIES x nearest rows at most
    near = got.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return queries[got.column("q").to_numpy()], near


def search(df: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", nearest: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: each query's nearest by inner product among all rows but its own."""
    spark = df.sparkSession
    sized = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("q")).where(F.col("id").isNotNull())
    schema = "query_id long, rank int, vec_id long, score double"
    usual = sized.where(usable(F.col("v"))).groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), "w").first()
    if usual is None:
        return spark.createDataFrame([], schema)
    width, rows = usual["w"], usual["count"]
    good = sized.where(usable(F.col("v"), width))
    numbered = materialize(good.select(F.monotonically_increasing_id().alias("row"), "id", "v", "q"), "vectors")  # rows are told apart by a number
    drawn = lambda of, seed, most: of.orderBy(F.xxhash64(F.lit(seed), "row"), "row").limit(most).select("row", "v").toPandas()
    matrix = lambda got: np.stack(got["v"].to_list()) if len(got) else np.zeros((0, width))
    queries = numbered.where("q")
    sample, asking, measured = drawn(numbered, 3, SAMPLE_ROWS), drawn(queries, 6, TRAINING_QUERIES), drawn(queries, 7, MEASURED_QUERIES)
    router = learn(matrix(sample), rows, matrix(asking))
    if len(measured):
        router.probed = probability_needed(router, *true_nearest(numbered, measured["row"].to_numpy(), matrix(measured), nearest))
    held = spark.sparkContext.broadcast(router)

    def routed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            order, before = route(held.value, x)
            take = np.maximum((before <= held.value.probed).sum(axis=1), math.ceil(LEAST_SHARE * order.shape[1]))
            probes = [o[:n].tolist() for o, n in zip(order, take, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), batch.column("v"), batch.column("q"), pa.array(order[:, 0].astype(np.int32)), pa.array(probes, pa.list_(pa.int32()))], names=["row", "id", "v", "q", "part", "probes"])

    routed = materialize(numbered.mapInArrow(routed_rows, "row long, id long, v array<double>, q boolean, part int, probes array<int>"), "routed")
    probed = routed.where("q").select(F.explode("probes").alias("part")).groupBy("part").agg(F.ceil(F.count(F.lit(1)) / CELL_QUERIES).cast("int").alias("copies"))
    sizes = routed.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / CELL_ROWS).cast("int").alias("cells")).join(probed, "part")  # a row a part
    cell = F.pmod(F.xxhash64(F.lit(4), "row"), "cells").cast("int").alias("cell")
    base = routed.join(F.broadcast(sizes), "part").select("part", cell, F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), F.lit(-1).alias("block"), "row", "id", "v", F.lit(False).alias("q"))
    n_blocks = max(1, math.ceil(routed.where("q").count() / BLOCK_QUERIES))
    block = F.pmod(F.xxhash64(F.lit(5), "row"), F.lit(n_blocks)).cast("int").alias("block")
    asked = routed.where("q").select(F.explode("probes").alias("part"), block, "row", "id", "v")
    copy = F.pmod("block", "copies").cast("int").alias("copy")
    asked = asked.join(F.broadcast(sizes), "part").select("part", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell"), copy, "block", "row", "id", "v", F.lit(True).alias("q"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by cell, a cell's candidates before its queries."""
        now, rows_of, ids, vectors = None, [], [], []
        for batch in batches:
            x = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            part, cell_of, copy_of, row, own, q = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("part", "cell", "copy", "row", "id", "q"))
            edges = np.nonzero((np.diff(part) != 0) | (np.diff(cell_of) != 0) | (np.diff(copy_of) != 0) | (np.diff(q.astype(np.int8)) != 0))[0] + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(own)], strict=True):
                if a == b:
                    continue
                if (part[a], cell_of[a], copy_of[a]) != now:
                    now, rows_of, ids, vectors = (part[a], cell_of[a], copy_of[a]), [], [], []
                if not q[a]:
                    rows_of.append(row[a:b])
                    ids.append(own[a:b])
                    vectors.append(x[a:b])
                elif ids:
                    yield _best(row[a:b], own[a:b], x[a:b], np.concatenate(rows_of), np.concatenate(ids), np.vstack(vectors), nearest, int(part[a]) * 31 + int(cell_of[a]))

    dealt = base.unionByName(asked).repartition("part", "cell", "copy").sortWithinPartitions("part", "cell", "copy", "q", "block")
    kind = "array<struct<away:double,vec_id:bigint>>"
    found = dealt.mapInArrow(meet, f"row long, query_id long, cell long, near {kind}")
    best = F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, nearest).alias("near")
    some = found.groupBy("row", "query_id", (F.col("cell") % 32).alias("__salt")).agg(best)  # a query's cells in two steps
    whole = some.groupBy("row", "query_id").agg(best).select("query_id", F.posexplode("near").alias("at", "n"))
    return whole.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("n.vec_id").alias("vec_id"), (-F.col("n.away")).alias("score"))


def _best(queries: np.ndarray, names: np.ndarray, q: np.ndarray, rows: np.ndarray, ids: np.ndarray, v: np.ndarray, nearest: int, cell: int) -> pa.RecordBatch:
    """Each query's nearest of one cell, by away (the score's negative); its own row is left out.

    Products and fixed-order sums are both within width units of rounding of the truth, so the margin holds all that may be among the best.
    """
    out = []
    n = min(nearest, len(ids))
    margin = 8 * v.shape[1] * np.finfo(float).eps * np.sqrt((v * v).sum(axis=1).max())
    for a in range(0, len(q), 256):
        asked = q[a : a + 256]
        score = asked @ v.T
        score[rows[None, :] == queries[a : a + 256, None]] = -np.inf
        edge = -np.partition(-score, n - 1, axis=1)[:, n - 1]
        near = (score >= (edge - margin * np.sqrt((asked * asked).sum(axis=1)))[:, None]) & (score > -np.inf)
        of, at = np.nonzero(near)
        exact = np.zeros(len(of))
        for k in range(v.shape[1]):
            exact += asked[of, k] * v[at, k]
        order = np.lexsort((ids[at], -exact, of))
        of, at, exact = of[order], at[order], exact[order]
        starts = np.searchsorted(of, np.arange(len(asked) + 1))
        for x, y in zip(starts[:-1], np.minimum(starts[1:], starts[:-1] + n), strict=True):
            out.append([{"away": -s, "vec_id": i} for s, i in zip(exact[x:y].tolist(), ids[at[x:y]].tolist(), strict=True)])
    kind = pa.list_(pa.struct([("away", pa.float64()), ("vec_id", pa.int64())]))
    return pa.RecordBatch.from_arrays([pa.array(queries, pa.int64()), pa.array(names, pa.int64()), pa.array([cell] * len(queries), pa.int64()), pa.array(out, kind)], names=["row", "query_id", "cell", "near"])
