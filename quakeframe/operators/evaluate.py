"""Evaluation: ranks, ROC, tests, fits and quantile groups.

Ranks come from tables of distinct values, whose counts are combined before the
shuffle; these are put in order by ranges (sequence.running), never in one task.
Groups of GROUP_ROWS at most are ranked where a shuffle by group brings them.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quakeframe.operators.sequence import running
from quakeframe.session import materialize


#: Rows of a group that one task ranks, at most; larger groups are ranked by ranges.
GROUP_ROWS = 100_000


def _same(left: DataFrame, right: DataFrame, by: tuple[str, ...]) -> Column:
    """Null-safe equality of by."""
    return reduce(Column.__and__, (left[c].eqNullSafe(right[c]) for c in by))


def average_ranks(df: DataFrame, value: str, name: str = "rank", by: tuple[str, ...] = ()) -> DataFrame:
    """Adds the 1-based rank of value, ties averaged."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("__n"))
    placed = running(counts, [value], {"__before": F.col("__n")}, by)
    ranks = placed.select(*(F.col(c).alias(f"__by_{c}") for c in by), F.col(value).alias("__value"), (F.col("__before") + (F.col("__n") + 1) / 2.0).alias(name))
    same = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"__by_{c}")) for c in by), F.col(value) == F.col("__value"))
    return df.join(ranks, same).drop("__value", *(f"__by_{c}" for c in by))


def _ranked_in_groups(df: DataFrame, values: dict[str, str], by: tuple[str, ...]) -> DataFrame:
    """by and the rank of each value (name by column), ties averaged, of rows that know all values: one shuffle for the groups that fit a task."""
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > GROUP_ROWS)
    large = materialize(sizes.select(*by), "large")  # a row for each GROUP_ROWS rows at most
    own = Window.partitionBy(*by)
    rank = lambda c: F.rank().over(own.orderBy(c)) + (F.count(F.lit(1)).over(Window.partitionBy(*by, c)) - 1) / 2.0
    any_large = not large.isEmpty()
    small = df.join(F.broadcast(large), _same(df, large, by), "left_anti") if any_large else df
    out = small
    for c, name in values.items():
        out = out.withColumn(name, rank(c))
    out = out.select(*by, *values.values())
    if any_large:
        ranked = df.join(F.broadcast(large), _same(df, large, by), "left_semi")
        for c, name in values.items():
            ranked = average_ranks(ranked, c, name, by)
        out = out.unionByName(ranked.select(*by, *values.values()))
    return out


def _by_score(df: DataFrame, label: str, score: str) -> DataFrame:
    """score, p and n: positives and negatives of each distinct score."""
    known = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    positive = (F.col(label) == 1).cast("long")
    return known.groupBy(F.col(score).alias("score")).agg(F.sum(positive).alias("p"), F.sum(1 - positive).alias("n"))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """n_pos, n_neg and auc (ties count half; null with one class)."""
    counts = running(_by_score(df, label, score), ["score"], {"before": F.col("p") + F.col("n")})
    rank = F.col("before") + (F.col("p") + F.col("n") + 1) / 2.0
    total = counts.agg(F.sum("p").alias("n_pos"), F.sum("n").alias("n_neg"), F.sum(F.col("p") * rank).alias("s"))
    pos, neg = F.col("n_pos"), F.col("n_neg")
    return total.select("n_pos", "n_neg", F.when((pos > 0) & (neg > 0), (F.col("s") - pos * (pos + 1) / 2.0) / (pos * neg)).alias("auc"))


def roc_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """threshold, tp, fp, n_pos, n_neg at each distinct score, a row predicted positive if its score is no less."""
    counts = running(_by_score(df, label, score), [F.desc("score")], {"tp": F.col("p"), "fp": F.col("n")})
    totals = counts.agg(F.sum("p").alias("n_pos"), F.sum("n").alias("n_neg"))  # one row
    return counts.crossJoin(F.broadcast(totals)).select(F.col("score").alias("threshold"), (F.col("tp") + F.col("p")).alias("tp"), (F.col("fp") + F.col("n")).alias("fp"), "n_pos", "n_neg")


def youden(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """The threshold of the largest tpr - fpr (the highest of equal ones; none if no threshold beats 0), and accuracy, precision and recall there."""
    curve = roc_curve(df, label, score).withColumn("j", F.col("tp") / F.col("n_pos") - F.col("fp") / F.col("n_neg"))
    best = curve.agg(F.max_by(F.struct("threshold", "tp", "fp", "n_pos", "n_neg", "j"), F.struct("j", "threshold")).alias("b")).select("b.*")
    some = F.col("j") > 0
    tp, fp = (F.when(some, F.col(c)).otherwise(0) for c in ("tp", "fp"))
    return best.select(
        F.when(some, F.col("threshold")).alias("threshold"),
        F.greatest("j", F.lit(0.0)).alias("youden_j"),
        ((tp + F.col("n_neg") - fp) / (F.col("n_pos") + F.col("n_neg"))).alias("accuracy"),
        F.when(tp + fp > 0, tp / (tp + fp)).alias("precision"),
        (tp / F.col("n_pos")).alias("recall"),
    )


def spearman(df: DataFrame, x: str, y: str, least_rows: int = 3, by: tuple[str, ...] = ()) -> DataFrame:
    """(by,) n, rho and the two-sided p of Student's t with n - 2 degrees; null for fewer rows or without spread."""
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*by, x, y)
    ranked = _ranked_in_groups(both, {x: "__rx", y: "__ry"}, by) if by else average_ranks(average_ranks(both, x, "__rx"), y, "__ry")
    n = F.count(F.lit(1))
    rho = F.when((n >= least_rows) & (F.stddev_pop("__rx") > 0) & (F.stddev_pop("__ry") > 0), F.corr("__rx", "__ry"))
    out = ranked.groupBy(*by).agg(n.alias("n"), rho.alias("rho")) if by else ranked.agg(n.alias("n"), rho.alias("rho"))
    return out.withColumn("p", t_two_sided(F.col("rho"), F.col("n")))


#: Coefficients of the asymptotic series of log gamma, B(2k) / (2k (2k - 1)).
STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188)


def log_gamma(a: Column) -> Column:
    """Of a positive number: the asymptotic series at a + 10, less the steps to there."""
    far = a + 10.0
    series = sum((F.lit(c) / F.pow(far, F.lit(2 * k + 1.0)) for k, c in enumerate(STIRLING)), F.lit(0.0))
    steps = sum((F.log(a + float(k)) for k in range(10)), F.lit(0.0))
    return (far - 0.5) * F.log(far) - far + 0.5 * math.log(2 * math.pi) + series - steps


def log_beta_half(a: Column) -> Column:
    """Logarithm of the beta function at (a, 1/2); for large a from the series of the ratio of the two gammas, which cancel."""
    ratio = F.when(a > 1e4, 0.5 * F.log(a) - 1 / (8 * a) + 1 / (192 * a * a * a)).otherwise(log_gamma(a + 0.5) - log_gamma(a))
    return 0.5 * math.log(math.pi) - ratio


def log_beta_tail(x: Column, a: Column, b: Column, log_beta: Column) -> Column:
    """Logarithm of the regularised incomplete beta function I_x(a, b), for x up to about (a + 1) / (a + b + 2).

    The continued fraction of the hypergeometric series, from its far end inwards; its terms settle after some roots of the
    larger of a and b.
    """
    steps = (F.ceil(6 * F.sqrt(F.greatest(a, b))) + 100).cast("int")
    odd = lambda m: -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
    even = lambda m: m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
    fraction = F.aggregate(F.sequence(steps, F.lit(1), F.lit(-1)), F.lit(1.0), lambda acc, m: 1 + even(m.cast("double")) / (1 + odd(m.cast("double")) / acc))
    first = 1 + odd(F.lit(0.0)) / fraction
    return a * F.log(x) + b * F.log1p(-x) - F.log(a) - log_beta - F.log(first)


def t_two_sided(rho: Column, n: Column) -> Column:
    """P(|r| >= |rho|) without correlation: the tail of Student's t with n - 2 degrees of freedom, I of 1 - rho^2 at ((n - 2) / 2, 1/2).

    For any number of rows and down to the smallest double: a tail is summed as such, never as one less the rest of it, and
    in logarithms.
    """
    degrees = F.greatest(n - 2, F.lit(1)).cast("double")
    a, half = degrees / 2, F.lit(0.5)
    log_beta = log_beta_half(a)
    inside = (1 - F.abs(rho)) * (1 + F.abs(rho))
    small = inside <= (a + 1) / (a + 2.5)
    tail = F.exp(log_beta_tail(F.greatest(F.when(small, inside).otherwise(0.5), F.lit(1e-300)), a, half, log_beta))
    square = F.when(small, 0.25).otherwise(rho * rho)
    rest = F.when(square > 0, 1 - F.exp(log_beta_tail(square, half, a, log_beta))).otherwise(1.0)
    return F.when(rho.isNotNull() & (n > 2), F.when(inside <= 0, 0.0).when(small, tail).otherwise(rest))


def normal_two_sided(z: Column) -> Column:
    """P(|Z| >= |z|): a series for small |z|, a continued fraction beyond."""
    x = F.abs(z)
    density = F.exp(-x * x / 2) / math.sqrt(2 * math.pi)
    begin = F.struct(x.alias("term"), x.alias("sum"))
    series = F.aggregate(F.sequence(F.lit(1), F.lit(60)), begin, lambda acc, k: F.struct((acc["term"] * x * x / (2.0 * k + 1)).alias("term"), (acc["sum"] + acc["term"] * x * x / (2.0 * k + 1)).alias("sum")))["sum"]
    fraction = F.aggregate(F.sequence(F.lit(60), F.lit(1), F.lit(-1)), x, lambda acc, k: x + k / acc)
    return F.when(x < 3, F.greatest(1 - 2 * density * series, F.lit(0.0))).otherwise(2 * density / fraction)


#: Most differences whose rank sums are counted exactly.
EXACT_ROWS = 50


def rank_sum_tail(w: Column, n: Column) -> Column:
    """P(W <= w) of the sum of the positive ranks among 1 to n, each sign as likely: the number of subsets of each sum, rank by rank."""
    begin = F.array(F.lit(1.0))

    def add(counts: Column, rank: Column) -> Column:
        room = F.array_repeat(F.lit(0.0), rank.cast("int"))
        return F.zip_with(F.concat(counts, room), F.concat(room, counts), lambda p, q: p + q)

    ways = F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1)).cast("int")), begin, add)
    low = F.slice(ways, F.lit(1), (F.floor(w) + 1).cast("int"))
    return F.aggregate(low, F.lit(0.0), lambda acc, v: acc + v) / F.pow(F.lit(2.0), n)


def wilcoxon(df: DataFrame, difference: str, least_rows: int = 10, by: tuple[str, ...] = ()) -> DataFrame:
    """(by,) n (differences that aren't 0), w_plus, w_minus, w, the smaller one, and its two-sided p; p is null for fewer rows.

    p is exact for up to EXACT_ROWS differences, all of different size and none 0; else by the normal approximation with the
    correction for ties of size, which share their rank.
    """
    known = df.where(F.col(difference).isNotNull()).select(*by, F.abs(difference).alias("__size"), (F.col(difference) > 0).alias("__up"))
    counts = known.groupBy(*by, "__size").agg(F.count(F.lit(1)).alias("__n"), F.sum(F.col("__up").cast("long")).alias("__ups"))
    zero = F.col("__size") == 0
    ranked = running(counts, ["__size"], {"__before": F.when(zero, 0).otherwise(F.col("__n"))}, by).withColumn("__rank", F.col("__before") + (F.col("__n") + 1) / 2.0)
    sums = {"w_plus": F.col("__ups"), "w_minus": F.col("__n") - F.col("__ups")}
    m = F.col("__n").cast("double")
    of = lambda c: F.when(~zero, c)
    totals = [F.coalesce(F.sum(of(F.col("__n"))), F.lit(0)).alias("n"), *(F.coalesce(F.sum(of(c * F.col("__rank"))), F.lit(0.0)).alias(k) for k, c in sums.items()), F.coalesce(F.sum(of(m * m * m - m)), F.lit(0.0)).alias("__ties"), F.coalesce(F.max(zero.cast("int")), F.lit(0)).alias("__zeros")]
    out = (ranked.groupBy(*by).agg(*totals) if by else ranked.agg(*totals)).withColumn("w", F.least("w_plus", "w_minus"))
    n = F.col("n").cast("double")
    spread = F.sqrt(n * (n + 1) * (2 * n + 1) / 24 - F.col("__ties") / 48)
    z = (F.col("w") - n * (n + 1) / 4) / spread
    exact = (F.col("n") <= EXACT_ROWS) & (F.col("__ties") == 0) & (F.col("__zeros") == 0)
    p = F.when(exact, F.least(2 * rank_sum_tail(F.col("w"), F.least("n", F.lit(EXACT_ROWS))), F.lit(1.0))).otherwise(F.when(spread > 0, normal_two_sided(z)))
    return out.withColumn("p", F.when(F.col("n") >= least_rows, p)).drop("__ties", "__zeros")


def two_predictor_fit(df: DataFrame, y: str, a: str, b: str, least_rows: int = 50) -> DataFrame:
    """Least squares y ~ c0 + ca * a + cb * b and R^2, from moments that are summed in one pass."""
    own = df.where(F.col(y).isNotNull() & F.col(a).isNotNull() & F.col(b).isNotNull())
    m = own.agg(
        F.count(F.lit(1)).alias("n"),
        *(F.avg(c).alias(f"m_{k}") for k, c in (("y", y), ("a", a), ("b", b))),
        *(F.var_pop(c).alias(f"v_{k}") for k, c in (("y", y), ("a", a), ("b", b))),
        *(F.covar_pop(p, q).alias(f"c_{k}") for k, p, q in (("ya", y, a), ("yb", y, b), ("ab", a, b))),
    )
    det = F.col("v_a") * F.col("v_b") - F.col("c_ab") * F.col("c_ab")
    m = m.withColumn("ca", (F.col("c_ya") * F.col("v_b") - F.col("c_yb") * F.col("c_ab")) / det).withColumn("cb", (F.col("c_yb") * F.col("v_a") - F.col("c_ya") * F.col("c_ab")) / det)
    enough = F.col("n") >= least_rows
    r2 = (F.col("ca") * F.col("c_ya") + F.col("cb") * F.col("c_yb")) / F.col("v_y")
    c0 = F.col("m_y") - F.col("ca") * F.col("m_a") - F.col("cb") * F.col("m_b")
    return m.select("n", *(F.when(enough, c).alias(k) for k, c in (("c0", c0), ("ca", F.col("ca")), ("cb", F.col("cb")), ("r2", r2))))


def quantiles(df: DataFrame, value: str, cuts: list[float], by: tuple[str, ...] = ()) -> DataFrame:
    """One row (for each by) with edges, the interpolated quantiles of value, and n, its known rows; no row without any."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("__value")).agg(F.count(F.lit(1)).alias("__n"))
    placed = running(counts, ["__value"], {"__before": F.col("__n")}, by)
    total = counts.groupBy(*by).agg(F.sum("__n").alias("n")) if by else counts.agg(F.sum("__n").alias("n"))
    joined = placed.join(total, list(by)) if by else placed.crossJoin(F.broadcast(total))
    place = lambda q: (F.col("n") - 1) * F.lit(float(q))
    at = lambda k: F.max(F.when((F.col("__before") <= k) & (k < F.col("__before") + F.col("__n")), F.col("__value").cast("double")))
    ends = joined.groupBy(*by, "n").agg(*(at(f(place(q))).alias(f"__{side}{k}") for k, q in enumerate(cuts) for side, f in (("lo", F.floor), ("hi", F.ceil))))

    def edge(k: int, q: float) -> Column:
        p, low, high = place(q), F.col(f"__lo{k}"), F.col(f"__hi{k}")
        return F.when(low == high, low).otherwise((F.ceil(p) - p) * low + (p - F.floor(p)) * high)

    return ends.select(*by, F.array(*(edge(k, q) for k, q in enumerate(cuts))).alias("edges"), "n")


def quantile_groups(df: DataFrame, value: str, groups: int = 3) -> DataFrame:
    """Adds grp, the 0-based interpolated-quantile interval (open on the left) of value; equal edges are merged. No rows without a value."""
    edges = quantiles(df, value, [k / groups for k in range(groups + 1)]).select(F.array_distinct("edges").alias("__edges"))  # one row
    inner = F.slice("__edges", F.lit(2), F.greatest(F.size("__edges") - 2, F.lit(0)))
    return df.crossJoin(F.broadcast(edges)).withColumn("grp", F.size(F.filter(inner, lambda e: F.col(value) > e))).drop("__edges")


def lower_medians(df: DataFrame, value: str, by: list[str], name: str = "median") -> DataFrame:
    """by and the lower of the two middle values of each group."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("__value")).agg(F.count(F.lit(1)).alias("__n"))
    placed = running(counts, ["__value"], {"__before": F.col("__n")}, by)
    total = counts.groupBy(*by).agg(F.sum("__n").alias("__all"))
    joined = placed.join(total, by) if by else placed.crossJoin(F.broadcast(total))
    middle = F.floor((F.col("__all") - 1) / 2)
    return joined.where((F.col("__before") <= middle) & (middle < F.col("__before") + F.col("__n"))).select(*by, F.col("__value").alias(name))
