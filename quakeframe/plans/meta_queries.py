"""Queries over window metadata and scores, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from quakeframe.functions import columns as C
from quakeframe.operators import baseline as B
from quakeframe.operators import evaluate as E
from quakeframe.operators import mining as M
from quakeframe.operators import encode as N
from quakeframe.operators import split as S
from quakeframe.plans import fixtures as X
from quakeframe.plans import jobs as J
from quakeframe.plans import reports as R
from quakeframe.plans.fixtures import CATALOG_SQL, ENTRIES_SQL, TRACES_SQL, ZONED_SQL
from quakeframe.sources import catalog as K

_MD5 = "md5('42|' || {})"


def roc_auc(spark, sf_dir):
    rows = X.catalog(spark, sf_dir).select((F.col("event_type") == "error").cast("int").alias("label"), F.round("value", 0).alias("score"))
    return E.roc_auc(rows).withColumn("auc", F.round("auc", 9))


_SCORES = "scores AS (SELECT CAST(event_type = 'error' AS INT) AS label, {} AS score FROM events)"
ROC_AUC_SQL = f"""WITH {_SCORES.format('round(value, 0)')}, r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS rk FROM scores)
SELECT sum(label) AS n_pos, sum(1 - label) AS n_neg, round((sum(CASE WHEN label = 1 THEN rk END) - sum(label) * (sum(label) + 1) / 2.0::DOUBLE) / (sum(label) * sum(1 - label)), 9) AS auc FROM r"""


def roc_youden(spark, sf_dir):
    rows = X.catalog(spark, sf_dir).select((F.col("event_type") == "error").cast("int").alias("label"), F.col("value").alias("score"))
    got = E.youden(rows)
    return got.withColumns({n: F.round(n, 9) for n in got.columns})


ROC_YOUDEN_SQL = f"""WITH {_SCORES.format('value')}, c AS (SELECT DISTINCT score AS t, sum(label) OVER w AS tp, sum(1 - label) OVER w AS fp, sum(label) OVER () AS p, sum(1 - label) OVER () AS n FROM scores WINDOW w AS (ORDER BY score DESC RANGE UNBOUNDED PRECEDING)),
b AS (SELECT *, tp / p::DOUBLE - fp / n::DOUBLE AS j FROM c ORDER BY j DESC, t DESC LIMIT 1), s AS (SELECT CASE WHEN j > 0 THEN t END AS t, greatest(j, 0.0) AS j, CASE WHEN j > 0 THEN tp ELSE 0 END AS tp, CASE WHEN j > 0 THEN fp ELSE 0 END AS fp, p, n FROM b)
SELECT round(t, 9) AS threshold, round(j, 9) AS youden_j, round((tp + n - fp) / (p + n)::DOUBLE, 9) AS accuracy, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE END, 9) AS "precision", round(tp / p::DOUBLE, 9) AS recall FROM s"""


def spearman(spark, sf_dir):
    return E.spearman(X.table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice").select("n", F.round("rho", 9).alias("rho"))


SPEARMAN_SQL = """WITH r AS (SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0::DOUBLE AS a, rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0::DOUBLE AS b FROM lineitem)
SELECT count(*) AS n, round(corr(a, b), 9) AS rho FROM r"""


def wilcoxon(spark, sf_dir):
    """Signed ranks of the differences between two event types' rounded means per user."""
    means = X.catalog(spark, sf_dir).groupBy("user_id").pivot("event_type", ["click", "error"]).agg(F.round(F.avg("value"), 0))
    return E.wilcoxon(means.select((F.col("click") - F.col("error")).alias("d")), "d").withColumn("p", F.round("p", 9))


WILCOXON_SQL = """WITH m AS (SELECT user_id, round(avg(value) FILTER (event_type = 'click'), 0) - round(avg(value) FILTER (event_type = 'error'), 0) AS d FROM events GROUP BY user_id),
r AS (SELECT d, rank() OVER (ORDER BY abs(d)) + (count(*) OVER (PARTITION BY abs(d)) - 1) / 2.0::DOUBLE AS k, count(*) OVER (PARTITION BY abs(d)) AS t FROM m WHERE d IS NOT NULL AND d <> 0),
s AS (SELECT count(*) AS n, coalesce(sum(k) FILTER (d > 0), 0.0) AS w_plus, coalesce(sum(k) FILTER (d < 0), 0.0) AS w_minus, least(coalesce(sum(k) FILTER (d > 0), 0.0), coalesce(sum(k) FILTER (d < 0), 0.0)) AS w, sum(CAST(t AS DOUBLE) * t - 1) AS ties FROM r),
z AS (SELECT *, abs(w - n * (n + 1) / 4.0::DOUBLE) / sqrt(n * (n + 1) * (2 * n + 1) / 24.0::DOUBLE - ties / 48.0::DOUBLE) AS z FROM s)
SELECT n, w_plus, w_minus, w, round(1 - 2 * exp(-z * z / 2) / sqrt(2 * pi()) * (SELECT sum(exp((2 * k + 1) * ln(z) - (k + 1) * ln(2) - lgamma(k + 1.5::DOUBLE) + 0.5 * ln(pi()))) FROM range(0, 200) t(k)), 9) AS p FROM z"""


def wilcoxon_exact(spark, sf_dir):
    """Signed ranks of each order's prices against 40,000: orders of five lines and more, whose p is exact."""
    rows = X.table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_extendedprice") - 40_000).alias("d"))
    got = E.wilcoxon(rows, "d", 5, ("l_orderkey",)).where("n >= 5")
    return got.withColumn("p", F.round("p", 9))


WILCOXON_EXACT_SQL = """WITH r AS (SELECT l_orderkey, l_extendedprice > 40000 AS up, rank() OVER (PARTITION BY l_orderkey ORDER BY abs(l_extendedprice - 40000)) AS k FROM lineitem),
s AS (SELECT l_orderkey, count(*) AS n, CAST(coalesce(sum(k) FILTER (up), 0) AS DOUBLE) AS w_plus, CAST(coalesce(sum(k) FILTER (NOT up), 0) AS DOUBLE) AS w_minus FROM r GROUP BY l_orderkey HAVING count(*) >= 5),
e AS (SELECT n, list_sum(list_transform(range(0, CAST(n AS INT)), lambda j: ((m >> j) & 1) * (j + 1))) AS sum FROM (SELECT DISTINCT n FROM s), range(0, 1 << 16) t(m) WHERE m < 1 << CAST(n AS INT)),
w AS (SELECT n, sum, CAST(count(*) AS DOUBLE) AS ways FROM e GROUP BY ALL), c AS (SELECT n, sum, sum(ways) OVER (PARTITION BY n ORDER BY sum) / sum(ways) OVER (PARTITION BY n) AS p FROM w)
SELECT l_orderkey, s.n, w_plus, w_minus, least(w_plus, w_minus) AS w, round(least(1.0, 2 * p), 9) AS p FROM s JOIN c ON c.n = s.n AND c.sum = least(w_plus, w_minus)"""


def spearman_groups(spark, sf_dir):
    """Rank correlations of a total with quantity, which are strong, and of price with tax, which aren't, for each supplier and line number."""
    rows = X.table(spark, sf_dir, "lineitem").withColumn("total", F.col("l_quantity") * 5_000 + F.col("l_extendedprice"))
    by = ("l_suppkey", "l_linenumber")
    strong = E.spearman(rows, "l_quantity", "total", by=by).where("n >= 10")
    weak = E.spearman(rows, "l_tax", "l_extendedprice", by=by).select(*by, F.col("rho").alias("weak_rho"), F.col("p").alias("weak_p"))
    joined = strong.join(weak, list(by))
    return joined.select(*by, "n", F.round("rho", 9).alias("rho"), F.round(F.log10("p"), 6).alias("log_p"), F.round("weak_rho", 9).alias("weak_rho"), F.round("weak_p", 8).alias("weak_p"))


_RANK = "rank() OVER (PARTITION BY l_suppkey, l_linenumber ORDER BY {c}) + (count(*) OVER (PARTITION BY l_suppkey, l_linenumber, {c}) - 1) / 2.0::DOUBLE"
SPEARMAN_GROUPS_SQL = f"""WITH r AS (SELECT l_suppkey, l_linenumber, {_RANK.format(c='l_quantity')} AS q, {_RANK.format(c='l_extendedprice')} AS e, {_RANK.format(c='total')} AS u, {_RANK.format(c='l_tax')} AS t FROM (SELECT *, l_quantity * 5000 + l_extendedprice AS total FROM lineitem)),
s AS (SELECT l_suppkey, l_linenumber, count(*) AS n, corr(q, u) AS rho, corr(t, e) AS weak_rho FROM r GROUP BY ALL HAVING count(*) >= 10),
v AS (SELECT *, n - 2 AS v, (n - 2) / 2.0::DOUBLE AS a, 1 - rho * rho AS x, 1 - weak_rho * weak_rho AS c2, sqrt(1 - weak_rho * weak_rho) AS c, abs(weak_rho) AS sine FROM s),
p AS (SELECT l_suppkey, l_linenumber, max(n) AS n, max(rho) AS rho, max(weak_rho) AS weak_rho,
 (max(a * ln(x) - lgamma(a) - lgamma(0.5::DOUBLE) + lgamma(a + 0.5)) + ln(sum(exp(lgamma(k + 0.5::DOUBLE) - lgamma(k + 1.0::DOUBLE) - 0.5 * ln(pi()) + k * ln(x)) / (a + k)))) / ln(10) AS log_p,
 sum(CASE WHEN v % 2 = 1 AND k < (v - 1) // 2 THEN c * exp(k * ln(c2) + 0.5 * ln(pi()) - ln(2) + lgamma(k + 1.0::DOUBLE) - lgamma(k + 1.5::DOUBLE)) WHEN v % 2 = 0 AND k < v // 2 THEN exp(k * ln(c2) + lgamma(k + 0.5::DOUBLE) - lgamma(k + 1.0::DOUBLE) - 0.5 * ln(pi())) ELSE 0 END) AS series,
 max(v) AS v, max(sine) AS sine FROM v, range(0, 2000) t(k) GROUP BY ALL)
SELECT l_suppkey, l_linenumber, n, round(rho, 9) AS rho, round(log_p, 6) AS log_p, round(weak_rho, 9) AS weak_rho, round(1 - CASE WHEN v % 2 = 1 THEN 2 / pi() * (asin(sine) + sine * series) ELSE sine * series END, 8) AS weak_p FROM p"""


def attenuation_fit(spark, sf_dir):
    rows = X.table(spark, sf_dir, "lineitem").select(F.log10("l_extendedprice").alias("y"), F.col("l_quantity").alias("m"), F.log10(F.greatest(F.col("l_discount") * 100, F.lit(1.0))).alias("d"))
    got = E.two_predictor_fit(rows, "y", "m", "d")
    return got.withColumns({n: F.round(n, 6) for n in ("c0", "ca", "cb", "r2")})


ATTENUATION_FIT_SQL = """WITH r AS (SELECT log10(l_extendedprice) AS y, l_quantity AS a, log10(greatest(l_discount * 100, 1.0)) AS b FROM lineitem),
m AS (SELECT count(*) AS n, avg(y) AS my, avg(a) AS ma, avg(b) AS mb, var_pop(y) AS vy, var_pop(a) AS va, var_pop(b) AS vb, covar_pop(y, a) AS ya, covar_pop(y, b) AS yb, covar_pop(a, b) AS ab FROM r),
c AS (SELECT *, (ya*vb - yb*ab) / (va*vb - ab*ab) AS ca, (yb*va - ya*ab) / (va*vb - ab*ab) AS cb FROM m)
SELECT n, round(my - ca*ma - cb*mb, 6) AS c0, round(ca, 6) AS ca, round(cb, 6) AS cb, round((ca*ya + cb*yb) / vy, 6) AS r2 FROM c"""


def distance_correlation(spark, sf_dir):
    return X.catalog(spark, sf_dir).agg(F.round(F.corr("depth", "value"), 9).alias("r"))


DISTANCE_CORRELATION_SQL = f"WITH {CATALOG_SQL} SELECT round(corr(depth, value), 9) AS r FROM catalog"


def tercile_groups(spark, sf_dir):
    rows = E.quantile_groups(X.table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice"), "l_quantity")
    return rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.min("l_quantity").alias("low"), F.max("l_quantity").alias("high"), F.round(F.avg("l_extendedprice"), 4).alias("mean_price"))


TERCILE_GROUPS_SQL = """WITH q AS (SELECT quantile_cont(l_quantity, 1.0::DOUBLE/3) AS a, quantile_cont(l_quantity, 2.0::DOUBLE/3) AS b FROM lineitem)
SELECT CAST(l_quantity > a AS INT) + CAST(l_quantity > b AS INT) AS grp, count(*) AS n, min(l_quantity) AS low, max(l_quantity) AS high, round(avg(l_extendedprice), 4) AS mean_price FROM lineitem, q GROUP BY grp"""


def profile_median(spark, sf_dir):
    """The lower median of each user's values by event type."""
    return E.lower_medians(X.catalog(spark, sf_dir), "value", ["user_id", "event_type"], "median_value")


PROFILE_MEDIAN_SQL = "SELECT user_id, event_type, quantile_disc(value, 0.5) AS median_value FROM events GROUP BY ALL"


def noise_baseline(spark, sf_dir):
    """Mean and population sigma from sums, for keys with enough values and spread."""
    got = B.baselines(X.catalog(spark, sf_dir), ["user_id", "event_type"], "value", 10)
    return got.withColumns({n: F.round(n, 6) for n in ("mu", "sigma")})


NOISE_BASELINE_SQL = """WITH s AS (SELECT user_id, event_type, sum(value) AS sx, sum(value*value) AS sx2, count(value) AS n FROM events GROUP BY ALL), m AS (SELECT *, sx / n AS mu, sqrt(greatest(sx2 / n - (sx / n) * (sx / n), 0.0)) AS sigma FROM s)
SELECT user_id, event_type, n, round(mu, 6) AS mu, round(sigma, 6) AS sigma FROM m WHERE n >= 10 AND sigma >= 1e-12"""


def baseline_join(spark, sf_dir):
    """Each type's standardized mean value against its user's baseline, its own where the user has none."""
    own = X.catalog(spark, sf_dir).groupBy("user_id", "event_type").agg(F.avg("value").alias("m"), F.stddev_pop("value").alias("s"))
    base = own.where("event_type = 'view' and s > 0").select("user_id", F.col("m").alias("mu"), F.col("s").alias("sigma"))
    joined = B.against(own, base, ["user_id"], F.col("m"), F.col("m"), F.col("s"))
    return joined.select("user_id", "event_type", F.round("z", 6).alias("z"))


BASELINE_JOIN_SQL = """WITH own AS (SELECT user_id, event_type, avg(value) AS m, stddev_pop(value) AS s FROM events GROUP BY ALL), base AS (SELECT user_id, m AS bm, s AS bs FROM own WHERE event_type = 'view' AND s > 0)
SELECT own.user_id, event_type, round((m - coalesce(bm, m)) / greatest(coalesce(bs, s), 1e-12), 6) AS z FROM own LEFT JOIN base USING (user_id)"""


def station_cap(spark, sf_dir):
    """Quotas under 2000 windows a station, in shuffled order."""
    return S.cap_quota(X.entries(spark, sf_dir), "station", "n_windows", 2000, ["file", "part", "item"])


_ORDERED = "(PARTITION BY station ORDER BY md5('42|' || file || '|' || part || '|' || item), file, part, item ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
STATION_CAP_SQL = f"""WITH {ENTRIES_SQL} SELECT station, file, part, item, cls, n_windows, CASE WHEN sum(n_windows) OVER (PARTITION BY station) > 2000
  THEN CAST(greatest(0, least(n_windows, 2000 - coalesce(sum(n_windows) OVER {_ORDERED}, 0))) AS BIGINT) END AS quota FROM entries"""


def station_cap_whole(spark, sf_dir):
    return S.cap_whole(X.entries(spark, sf_dir), "station", "n_windows", 1500, ["file", "part", "item"])


STATION_CAP_WHOLE_SQL = f"WITH {ENTRIES_SQL}, s AS (SELECT *, coalesce(sum(n_windows) OVER {_ORDERED}, 0) AS prior FROM entries) SELECT station, file, part, item, cls, n_windows FROM s WHERE prior < 1500"


def even_subsample(spark, sf_dir):
    """Sixteen evenly spaced entries of each station."""
    ranked = S.ranked(X.entries(spark, sf_dir), ["station"], ["file", "part"], "k", size="n")
    return ranked.where(S.evenly_spaced(F.col("k"), F.col("n"), 16)).select("station", "file", "part")


EVEN_SUBSAMPLE_SQL = f"""WITH {ENTRIES_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY station ORDER BY file, part) - 1 AS k, count(*) OVER (PARTITION BY station) AS n FROM entries)
SELECT station, file, part FROM r WHERE n <= 16 OR k IN (SELECT round_even(i * ((n - 1) / 15::DOUBLE), 0) FROM range(0, 16) t(i))"""


def largest_remainder(spark, sf_dir):
    """One hundred windows split over the classes of each station in proportion."""
    counts = X.entries(spark, sf_dir).groupBy("station", "cls").agg(F.sum("n_windows").alias("w"))
    return S.largest_remainder(counts, "station", "w", F.lit(100), "cls")


LARGEST_REMAINDER_SQL = f"""WITH {ENTRIES_SQL}, c AS (SELECT station, cls, CAST(sum(n_windows) AS BIGINT) AS w FROM entries GROUP BY ALL), x AS (SELECT *, w * 100 / CAST(sum(w) OVER (PARTITION BY station) AS DOUBLE) AS x FROM c),
o AS (SELECT *, row_number() OVER (PARTITION BY station ORDER BY x - floor(x) DESC, cls) AS k, 100 - sum(floor(x)) OVER (PARTITION BY station) AS short FROM x)
SELECT station, cls, w, CAST(floor(x) + CASE WHEN k <= short THEN 1 ELSE 0 END AS BIGINT) AS share FROM o"""


def class_balance(spark, sf_dir):
    """Targets: the smallest class total, as train and validation shares and the rest."""
    totals = X.entries(spark, sf_dir).groupBy("cls").agg(F.sum("n_windows").alias("total"))
    return S.class_targets(totals)


CLASS_BALANCE_SQL = f"""WITH {ENTRIES_SQL}, t AS (SELECT cls, CAST(sum(n_windows) AS BIGINT) AS total, min(CAST(sum(n_windows) AS BIGINT)) OVER () AS m FROM entries GROUP BY cls)
SELECT cls, total, CAST(floor(m * 0.70::DOUBLE) AS BIGINT) AS train, CAST(floor(m * 0.15::DOUBLE) AS BIGINT) AS val, m - CAST(floor(m * 0.70::DOUBLE) AS BIGINT) - CAST(floor(m * 0.15::DOUBLE) AS BIGINT) AS test, total - m AS surplus FROM t"""


def balance_cap(spark, sf_dir):
    """Cap of the other classes: 0.55 times the rare class, halves to even; none without it."""
    totals = X.entries(spark, sf_dir).groupBy("station").agg(*(F.sum(F.when(F.col("cls") == c, F.col("n_windows")).otherwise(0)).alias(c.lower()) for c in ("A", "N", "R")))
    return S.balance_caps(totals, "a", ["n", "r"], 0.55)


BALANCE_CAP_SQL = f"""WITH {ENTRIES_SQL}, t AS (SELECT station, CAST(coalesce(sum(n_windows) FILTER (cls = 'A'), 0) AS BIGINT) AS a, CAST(coalesce(sum(n_windows) FILTER (cls = 'N'), 0) AS BIGINT) AS n, CAST(coalesce(sum(n_windows) FILTER (cls = 'R'), 0) AS BIGINT) AS r FROM entries GROUP BY station),
c AS (SELECT *, CASE WHEN a > 0 THEN CAST(round_even(a * 0.55::DOUBLE, 0) AS BIGINT) END AS cap FROM t) SELECT station, a, n, r, cap, CASE WHEN cap < n THEN cap ELSE n END AS kept_n, CASE WHEN cap < r THEN cap ELSE r END AS kept_r FROM c"""


def _split_entries(spark, sf_dir):
    rows = X.entries(spark, sf_dir)
    keys = rows.groupBy("station").agg(F.sum("n_windows").alias("w"))
    return rows.join(S.deficit_splits(keys, "station", "w"), "station")


def station_splits(spark, sf_dir):
    """Greedy split of stations by the largest relative deficit."""
    return _split_entries(spark, sf_dir).groupBy("station", "split").agg(F.sum("n_windows").alias("n_windows"))


STATION_SPLITS_SQL = f"""WITH RECURSIVE {ENTRIES_SQL}, g AS (SELECT station, CAST(sum(n_windows) AS DOUBLE) AS w, row_number() OVER (ORDER BY md5('42|' || station)) AS k, CAST(sum(sum(n_windows)) OVER () AS DOUBLE) AS t FROM entries GROUP BY station),
gaps(k, a, b, c, split) AS (SELECT 0::BIGINT, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, '' UNION ALL
  SELECT k, a + CASE WHEN s = 'train' THEN w ELSE 0 END, b + CASE WHEN s = 'val' THEN w ELSE 0 END, c + CASE WHEN s = 'test' THEN w ELSE 0 END, s FROM (
    SELECT g.k, w, a, b, c, CASE WHEN (t*0.70::DOUBLE - a) / greatest(t*0.70::DOUBLE, 1) >= (t*0.15::DOUBLE - b) / greatest(t*0.15::DOUBLE, 1) AND (t*0.70::DOUBLE - a) / greatest(t*0.70::DOUBLE, 1) >= (t*0.15::DOUBLE - c) / greatest(t*0.15::DOUBLE, 1) THEN 'train'
      WHEN (t*0.15::DOUBLE - b) / greatest(t*0.15::DOUBLE, 1) >= (t*0.15::DOUBLE - c) / greatest(t*0.15::DOUBLE, 1) THEN 'val' ELSE 'test' END AS s FROM gaps JOIN g ON g.k = gaps.k + 1))
SELECT station, split, CAST(w AS BIGINT) AS n_windows FROM g JOIN gaps USING (k)"""


def random_split(spark, sf_dir):
    return S.random_split(X.entries(spark, sf_dir).select("file", "part", "item"), ["file", "part", "item"])


RANDOM_SPLIT_SQL = f"""WITH {ENTRIES_SQL}, r AS (SELECT file, part, item, row_number() OVER (ORDER BY md5('42|' || file || '|' || part || '|' || item)) AS k, count(*) OVER () AS n FROM entries)
SELECT file, part, item, CASE WHEN k <= CAST(trunc(n * 0.70::DOUBLE) AS BIGINT) THEN 'train' WHEN k <= CAST(trunc(n * 0.70::DOUBLE) AS BIGINT) + CAST(trunc(n * 0.15::DOUBLE) AS BIGINT) THEN 'val' ELSE 'test' END AS split FROM r"""


def split_leaks(spark, sf_dir):
    """Files in more than one split of a random split by entry."""
    return S.leaks(S.random_split(X.entries(spark, sf_dir).select("file", "part", "item"), ["file", "part", "item"]), "file")


SPLIT_LEAKS_SQL = f"WITH s AS ({RANDOM_SPLIT_SQL}) SELECT file, count(DISTINCT split) AS n_splits FROM s GROUP BY file HAVING count(DISTINCT split) > 1"


def majority_rate(spark, sf_dir):
    rows = X.entries(spark, sf_dir).withColumn("split", (F.col("station") % 3).cast("string"))
    return S.majority_rate(rows, "cls").withColumn("majority_rate", F.round("majority_rate", 9))


MAJORITY_RATE_SQL = f"WITH {ENTRIES_SQL}, c AS (SELECT CAST(station % 3 AS VARCHAR) AS split, cls, count(*) AS n FROM entries GROUP BY ALL) SELECT split, CAST(sum(n) AS BIGINT) AS n, round(max(n) / CAST(sum(n) AS DOUBLE), 9) AS majority_rate FROM c GROUP BY split"


def class_counts(spark, sf_dir):
    """Classes by split, pivoted."""
    rows = X.entries(spark, sf_dir).withColumn("split", (F.col("station") % 3).cast("string"))
    return rows.groupBy("split").pivot("cls", ["A", "N", "R"]).agg(F.count(F.lit(1))).select("split", F.col("A").alias("n_a"), F.col("N").alias("n_n"), F.col("R").alias("n_r"), )


CLASS_COUNTS_SQL = f"WITH {ENTRIES_SQL} SELECT CAST(station % 3 AS VARCHAR) AS split, count(*) FILTER (cls = 'A') AS n_a, count(*) FILTER (cls = 'N') AS n_n, count(*) FILTER (cls = 'R') AS n_r FROM entries GROUP BY split"


def hard_negatives(spark, sf_dir):
    """Twenty evenly spaced entries of each station's loudest quarter, the top percent left out."""
    return M.band_pick(X.table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("station"), F.col("l_orderkey").alias("file"), F.col("l_linenumber").alias("part"), F.col("l_extendedprice").alias("score")), ["station"], "score", ["file", "part"], 20)


HARD_NEGATIVES_SQL = """WITH r AS (SELECT l_suppkey AS station, l_orderkey AS file, l_linenumber AS part, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice, l_orderkey, l_linenumber) - 1 AS k, count(*) OVER (PARTITION BY l_suppkey) AS n FROM lineitem),
b AS (SELECT *, least(round_even(0.75::DOUBLE * n, 0), n - 1) AS lo0, greatest(least(round_even(0.99::DOUBLE * n, 0), n), least(round_even(0.75::DOUBLE * n, 0), n - 1) + 1) AS hi0 FROM r), u AS (SELECT *, CASE WHEN hi0 - lo0 < least(20, n) THEN greatest(0, hi0 - least(20, n)) ELSE lo0 END AS lo1 FROM b),
d AS (SELECT *, CASE WHEN hi0 - lo1 < least(20, n) THEN least(n, lo1 + least(20, n)) ELSE hi0 END AS hi1 FROM u), p AS (SELECT *, k - lo1 AS j, hi1 - lo1 AS m FROM d WHERE k >= lo1 AND k < hi1)
SELECT station, file, part FROM p WHERE m <= 20 OR j IN (SELECT round_even(i * ((m - 1) / 19::DOUBLE), 0) FROM range(0, 20) t(i))"""


def matched_negatives(spark, sf_dir):
    """Negatives whose score histogram follows that of the positives."""
    rows = X.table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("cls"), F.col("l_orderkey").alias("file"), F.col("l_linenumber").alias("part"), F.col("l_extendedprice").alias("score"))
    picked = M.matched_pick(rows.where("cls = 'N'").drop("cls"), rows.where("cls = 'A'").drop("cls"), "score", ["file", "part"], 500)
    return picked.select("file", "part", "bin")


MATCHED_NEGATIVES_SQL = """WITH t AS (SELECT l_extendedprice AS score FROM lineitem WHERE l_returnflag = 'A'), q AS (SELECT list_distinct(list_sort(quantile_cont(score, [k / 40.0::DOUBLE FOR k IN range(0, 41)]))) AS u, median(score) AS m FROM t), e AS (SELECT list_sort(u) AS e, m FROM q),
d AS (SELECT bin, greatest(1, round_even(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) * 500, 0)) AS demand FROM (SELECT least(len(list_filter(e, lambda x: x <= score)), len(e) - 1) - 1 AS bin FROM t, e) GROUP BY bin),
p AS (SELECT l_orderkey AS file, l_linenumber AS part, l_extendedprice AS score, md5('42|' || l_orderkey || '|' || l_linenumber) AS h, len(list_filter(e, lambda x: x <= l_extendedprice)) AS pos, len(e) AS n, m FROM lineitem, e WHERE l_returnflag = 'N'),
b AS (SELECT *, CASE WHEN pos >= 1 AND pos < n THEN pos - 1 END AS bin FROM p), r AS (SELECT b.*, row_number() OVER (PARTITION BY b.bin ORDER BY h, file, part) <= coalesce(demand, 1) AND b.bin IS NOT NULL AS chosen FROM b LEFT JOIN d ON d.bin = b.bin),
o AS (SELECT *, row_number() OVER (ORDER BY CAST(NOT chosen AS INT), CASE WHEN chosen THEN 0.0 ELSE abs(score - m) END, h, file, part) AS place FROM r)
SELECT file, part, CAST(bin AS INT) AS bin FROM o WHERE place <= 500"""


def noise_veto(spark, sf_dir):
    """Orders without an event from five minutes before to six minutes after their date."""
    noise = X.table(spark, sf_dir, "orders").select("o_orderkey", F.timestamp_seconds(F.unix_seconds(F.lit("2024-01-01").cast("timestamp")) + F.col("o_orderkey") * 173 % 2_592_000).cast("timestamp_ntz").alias("start"))
    strong = X.catalog(spark, sf_dir).where("magnitude >= 3.0")
    return M.veto(noise, strong, "start", 60, 300).select("o_orderkey")


NOISE_VETO_SQL = f"""WITH {CATALOG_SQL}, noise AS (SELECT o_orderkey, TIMESTAMP '2024-01-01' + to_seconds(o_orderkey * 173 % 2592000) AS start FROM orders)
SELECT o_orderkey FROM noise WHERE NOT EXISTS (SELECT 1 FROM catalog WHERE magnitude >= 3.0 AND time >= start - INTERVAL 300 SECOND AND time <= start + INTERVAL 360 SECOND)"""


def download_plan(spark, sf_dir):
    """Batches around each strong event that have no output yet."""
    batches = F.array(*(F.struct(F.lit(n).alias("batch"), F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b")) for n, a, b in (("event", 0, 60), ("noise_3h", -11100, -10800), ("noise_6h", -21900, -21600))))
    strong = X.catalog(spark, sf_dir).where("magnitude >= 4.0")
    at = lambda k: F.timestamp_micros(F.unix_micros(F.col("time").cast("timestamp")) + F.col(k) * 1_000_000).cast("timestamp_ntz")
    plan = strong.select("event_id", "time", F.explode(batches).alias("x")).select("event_id", "time", "x.*").select("event_id", "batch", at("a").alias("start"), at("b").alias("stop"))
    done = X.catalog(spark, sf_dir).where("event_id % 3 = 0").select("event_id", F.lit("noise_3h").alias("batch"))
    return plan.join(done, ["event_id", "batch"], "left_anti")


DOWNLOAD_PLAN_SQL = f"""WITH {CATALOG_SQL}, b(batch, a, z) AS (VALUES ('event', 0, 60), ('noise_3h', -11100, -10800), ('noise_6h', -21900, -21600))
SELECT event_id, batch, time + to_seconds(a) AS start, time + to_seconds(z) AS stop FROM catalog, b WHERE magnitude >= 4.0 AND NOT (event_id % 3 = 0 AND batch = 'noise_3h')"""


def paired_types(spark, sf_dir):
    """Users with both types: their means side by side."""
    c = X.catalog(spark, sf_dir)
    a, b = (c.where(F.col("event_type") == t).groupBy("user_id").agg(F.round(F.avg("value"), 6).alias(f"mean_{s}"), F.count(F.lit(1)).alias(f"n_{s}")) for t, s in (("click", "a"), ("error", "b")))
    return a.join(b, "user_id")


PAIRED_TYPES_SQL = """SELECT user_id, round(avg(value) FILTER (event_type = 'click'), 6) AS mean_a, count(*) FILTER (event_type = 'click') AS n_a, round(avg(value) FILTER (event_type = 'error'), 6) AS mean_b, count(*) FILTER (event_type = 'error') AS n_b
FROM events GROUP BY user_id HAVING count(*) FILTER (event_type = 'click') > 0 AND count(*) FILTER (event_type = 'error') > 0"""


def shared_stations(spark, sf_dir):
    """Stations that supply both classes."""
    rows = X.entries(spark, sf_dir)
    return rows.where("cls = 'A'").select("station").intersect(rows.where("cls = 'R'").select("station"))


SHARED_STATIONS_SQL = f"WITH {ENTRIES_SQL} SELECT station FROM entries WHERE cls = 'A' INTERSECT SELECT station FROM entries WHERE cls = 'R'"


def negative_whitelist(spark, sf_dir):
    """Windows of the mined class by loudness over all stations of a split: as many as its quotas."""
    rows = X.table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 3).cast("string").alias("split"), F.col("l_orderkey").cast("string").alias("file_path"), F.col("l_suppkey").cast("string").alias("station_key"), F.col("l_linenumber").alias("w_idx"), F.col("l_extendedprice").alias("score"), "l_partkey")
    rows = rows.groupBy("split", "file_path", "station_key", "w_idx").agg(F.max("score").alias("score"))
    quotas = spark.range(2).select(F.col("id").cast("string").alias("split"), (40 + 30 * F.col("id")).alias("quota"))
    return J.negative_whitelist(rows, quotas)


NEGATIVE_WHITELIST_SQL = """WITH c AS (SELECT CAST(l_suppkey % 3 AS VARCHAR) AS split, CAST(l_orderkey AS VARCHAR) AS file_path, CAST(l_suppkey AS VARCHAR) AS station_key, l_linenumber AS w_idx, max(l_extendedprice) AS score FROM lineitem GROUP BY ALL),
q(split, want) AS (VALUES ('0', 40), ('1', 70)), r AS (SELECT c.*, want, row_number() OVER (PARTITION BY split ORDER BY score, file_path, station_key, w_idx) - 1 AS k, count(*) OVER (PARTITION BY split) AS n FROM c JOIN q USING (split)),
b AS (SELECT *, least(round_even(0.75::DOUBLE * n, 0), n - 1) AS lo0, greatest(least(round_even(0.99::DOUBLE * n, 0), n), least(round_even(0.75::DOUBLE * n, 0), n - 1) + 1) AS hi0, least(want, n) AS w FROM r),
u AS (SELECT *, CASE WHEN hi0 - lo0 < w THEN greatest(0, hi0 - w) ELSE lo0 END AS lo1 FROM b), d AS (SELECT *, CASE WHEN hi0 - lo1 < w THEN least(n, lo1 + w) ELSE hi0 END AS hi1 FROM u),
p AS (SELECT *, k - lo1 AS j, hi1 - lo1 AS m FROM d WHERE k >= lo1 AND k < hi1)
SELECT file_path, station_key, w_idx FROM p WHERE m <= want OR j IN (SELECT round_even(i * ((m - 1) / (want - 1)::DOUBLE), 0) FROM range(0, want) t(i))"""


def paired_offsets(spark, sf_dir):
    """Users' rounded means at two offsets side by side, and the change."""
    c = X.catalog(spark, sf_dir).where(F.col("event_type").isin("click", "error"))
    rows = c.groupBy(F.col("user_id").alias("event_id"), F.lit("N.S").alias("station_key"), F.when(F.col("event_type") == "click", "3h").otherwise("6h").alias("offset")).agg(F.round(F.avg("value"), 4).alias("raw_diff"), F.round(F.avg("magnitude"), 4).alias("ram_diff"))
    got = J.paired_offsets(rows)
    return got.withColumns({n: F.round(n, 4) for n in got.columns if n.endswith("_change")})


PAIRED_OFFSETS_SQL = f"""WITH {CATALOG_SQL}, m AS (SELECT user_id AS event_id, 'N.S' AS station_key, event_type, round(avg(value), 4) AS r, round(avg(magnitude), 4) AS i FROM catalog WHERE event_type IN ('click', 'error') GROUP BY ALL)
SELECT a.event_id, a.station_key, a.r AS raw_diff_a, a.i AS ram_diff_a, b.r AS raw_diff_b, b.i AS ram_diff_b, round(a.r - b.r, 4) AS raw_diff_change, round(a.i - b.i, 4) AS ram_diff_change FROM m a JOIN m b USING (event_id, station_key) WHERE a.event_type = 'click' AND b.event_type = 'error'"""


def pooled_diffs(spark, sf_dir):
    """Mean values of station and class groups with enough windows."""
    rows = X.entries(spark, sf_dir).withColumn("rms_diff", (F.col("n_windows") % 7).cast("double")).withColumn("image_diff", (F.col("item") % 5).cast("double"))
    got = J.pooled_diffs(rows, ["station", "cls", "part"], least=900)
    return got.withColumns({n: F.round(n, 9) for n in ("rms_diff", "image_diff")})


POOLED_DIFFS_SQL = f"""WITH {ENTRIES_SQL} SELECT station, cls, part, CAST(sum(n_windows) AS BIGINT) AS n_windows, round(avg(CAST(n_windows % 7 AS DOUBLE)), 9) AS rms_diff, round(avg(CAST(item % 5 AS DOUBLE)), 9) AS image_diff
FROM entries GROUP BY station, cls, part HAVING sum(n_windows) >= 900"""


def target_counts(spark, sf_dir):
    """Targets of each zone, the gaps between them, and whether they are too few."""
    return R.target_counts(R.major_events(X.zoned(spark, sf_dir), 3.5), 1.0)


TARGET_COUNTS_SQL = f"""WITH {ZONED_SQL}, g AS (SELECT region, floor((epoch_us(time) - epoch_us(lag(time) OVER (PARTITION BY region ORDER BY time, event_id))) / 86400e6) AS gap FROM zoned WHERE magnitude >= 3.5)
SELECT region, count(*) AS n, CAST(min(gap) AS BIGINT) AS min_gap, CAST(max(gap) AS BIGINT) AS max_gap, median(gap) AS median_gap, count(*) < 4 AS too_few, coalesce(max(gap) > 1.0, false) AS beyond_horizon FROM g GROUP BY region"""


def magnitude_types(spark, sf_dir):
    """Events on a known magnitude scale."""
    scale = F.element_at(F.array(*(F.lit(t) for t in ("ML", "MB", "mb", "Mx", "MW"))), (F.col("event_id") % 5 + 1).cast("int"))
    return K.of_magnitude_type(X.catalog(spark, sf_dir).withColumn("Type", scale)).groupBy("Type").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("Type", "scale")


MAGNITUDE_TYPES_SQL = "SELECT ['ML', 'MB', 'mb', 'Mx', 'MW'][event_id % 5 + 1] AS scale, count(*) AS n FROM events WHERE event_id % 5 NOT IN (1, 3) GROUP BY scale"


def degree_distance(spark, sf_dir):
    """Degrees of arc and kilometres from each event to one place."""
    c = X.catalog(spark, sf_dir)
    deg = C.degrees(F.col("lat"), F.col("lon"), F.lit(39.0), F.lit(35.0))
    return c.select("event_id", F.round(deg, 7).alias("degrees"), F.round(deg * C.DEGREE_KM, 4).alias("km"))


DEGREE_DISTANCE_SQL = f"""WITH {CATALOG_SQL}, d AS (SELECT event_id, degrees(2 * asin(sqrt(pow(sin(radians(39.0 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(39.0)) * pow(sin(radians(35.0 - lon) / 2), 2)))) AS deg FROM catalog)
SELECT event_id, round(deg, 7) AS degrees, round(deg * 111.195::DOUBLE, 4) AS km FROM d"""


def hours_to_event(spark, sf_dir):
    """Hours from a window of each order's record to an event at a fixed time."""
    rows = X.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").alias("start"), F.col("l_partkey").alias("w"))
    hours = C.hours_to_event(F.col("start"), F.col("w"), 600, 100.0, F.lit("2000-01-01 06:00:00").cast("timestamp_ntz"))
    return rows.select("l_orderkey", "l_linenumber", F.round(hours, 6).alias("hours"))


HOURS_TO_EVENT_SQL = "SELECT l_orderkey, l_linenumber, round(((epoch_us(TIMESTAMP '2000-01-01 06:00:00') - epoch_us(CAST(l_shipdate AS TIMESTAMP))) / 1000000.0::DOUBLE - l_partkey * 600 / 100.0::DOUBLE) / 3600.0::DOUBLE, 6) AS hours FROM lineitem"


def window_z_scores(spark, sf_dir):
    """Sums of traces' z-scores by the sample deviation: the first value and the spread."""
    rows = X.traces(spark, sf_dir).withColumn("z", C.z_scores(F.col("samples")))
    return rows.select("trace", F.round(F.element_at("z", 1), 7).alias("first"), F.round(F.array_max("z") - F.array_min("z"), 7).alias("spread"))


WINDOW_Z_SCORES_SQL = f"""WITH {TRACES_SQL}, s AS (SELECT trace, samples, list_avg(samples) AS m, list_stddev_samp(samples) + 1e-6 AS s FROM traces)
SELECT trace, round((samples[1] - m) / s, 7) AS first, round((list_max(samples) - list_min(samples)) / s, 7) AS spread FROM s"""


def profile_lookup(spark, sf_dir):
    """Traces with their station's three profiles, null where one is missing."""
    c = X.catalog(spark, sf_dir).where("user_id % 4 <> 1 or event_type <> 'error'").groupBy("user_id", "event_type").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    letter = F.when(F.col("event_type") == "click", "z").when(F.col("event_type") == "view", "n").when(F.col("event_type") == "error", "e")
    profiles = c.select(F.col("user_id").alias("station_key"), letter.alias("component"), F.array("low", "high").alias("profile")).where("component is not null")
    rows = X.traces(spark, sf_dir).select("trace", (F.col("trace") % 160).alias("station_key"))
    return N.with_profiles(rows, profiles).select("trace", "station_key", F.size("profile").alias("n"), F.element_at("profile", 1).alias("z_low"), F.element_at("profile", 6).alias("e_high"))


PROFILE_LOOKUP_SQL = """WITH c AS (SELECT user_id, event_type, min(value) AS low, max(value) AS high FROM events WHERE user_id % 4 <> 1 OR event_type <> 'error' GROUP BY ALL),
p AS (SELECT user_id, max(low) FILTER (event_type = 'click') AS z_low, max(high) FILTER (event_type = 'error') AS e_high FROM c WHERE event_type IN ('click', 'view', 'error') GROUP BY user_id HAVING count(*) = 3)
SELECT vec_id AS trace, vec_id % 160 AS station_key, CASE WHEN z_low IS NULL THEN NULL ELSE 6 END AS n, z_low, e_high FROM embeddings LEFT JOIN p ON user_id = vec_id % 160"""


def raw_windows(spark, sf_dir):
    """Windows of a manifest, cut again from the records: first and last sample and the padding."""
    t = X.traces(spark, sf_dir)
    traces = t.select(F.col("trace").cast("string").alias("file_path"), F.lit("N.S").alias("station_key"), F.explode(F.array(F.lit("Z"), F.lit("N"), F.lit("E"))).alias("component"), F.lit(10.0).alias("sampling_rate"), "samples")
    manifest = t.select(F.col("trace").cast("string").alias("file_path"), F.lit("N.S").alias("station_key"), F.lit(10.0).alias("fs"), F.format_string("x_win%03d.png", F.col("trace") % 9).alias("filename"))
    got = J.raw_windows(manifest, traces, 2.0, 0.5)
    return got.select(F.col("file_path").cast("long").alias("trace"), F.element_at("z", 1).alias("first"), F.element_at("e", 20).alias("last"), F.size("n").alias("n"))


RAW_WINDOWS_SQL = f"""WITH {TRACES_SQL} SELECT trace, samples[trace % 9 * 10 + 1] AS first, coalesce(samples[trace % 9 * 10 + 20], 0.0) AS last, 20 AS n FROM traces WHERE trace % 9 * 10 < 64"""


def gain_mismatch(spark, sf_dir):
    """Largest mismatch of each order between its lines' gain products and the reported sensitivity."""
    rows = X.table(spark, sf_dir, "lineitem").select("l_orderkey", C.gain_mismatch(F.array("l_quantity", "l_discount", F.when(F.col("l_linenumber") != 5, F.col("l_tax"))), F.col("l_extendedprice") / 1000).alias("m"))
    return rows.groupBy("l_orderkey").agg(F.round(F.max("m"), 9).alias("mismatch"))


GAIN_MISMATCH_SQL = "SELECT l_orderkey, round(max(CASE WHEN l_linenumber <> 5 THEN abs(l_quantity * l_discount * l_tax - l_extendedprice / 1000) / abs(l_extendedprice / 1000) END), 9) AS mismatch FROM lineitem GROUP BY l_orderkey"


def manifest_window(spark, sf_dir):
    """Window index, event id and component from names."""
    name = F.format_string("event_%s_raw_%s_win%s", F.col("l_orderkey"), F.concat(F.lit("N."), F.col("l_suppkey")), F.lpad(F.col("l_partkey").cast("string"), 4, "0"))
    rows = X.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", name.alias("name"))
    return rows.select("l_orderkey", "l_linenumber", C.event_id(F.regexp_extract("name", "^(.*_raw)", 1)).alias("event_id"), F.regexp_extract("name", r"_win(\d+)$", 1).cast("int").alias("w_idx"), F.regexp_extract("name", r"_raw_(.+)_win\d+$", 1).alias("station_key"))


MANIFEST_WINDOW_SQL = "SELECT l_orderkey, l_linenumber, CAST(l_orderkey AS VARCHAR) AS event_id, CAST(left(lpad(CAST(l_partkey AS VARCHAR), 4, '0'), 4) AS INT) AS w_idx, 'N.' || l_suppkey AS station_key FROM lineitem"


def dominant_size(spark, sf_dir):
    """Rows whose size isn't the most frequent one of their class."""
    counts = X.entries(spark, sf_dir).groupBy("cls", "n_windows").agg(F.count(F.lit(1)).alias("n"))
    usual = counts.groupBy("cls").agg(F.max_by("n_windows", F.struct("n", -F.col("n_windows"))).alias("usual"))
    return counts.join(F.broadcast(usual), "cls").where(F.col("n_windows") != F.col("usual"))


DOMINANT_SIZE_SQL = f"WITH {ENTRIES_SQL}, c AS (SELECT cls, n_windows, count(*) AS n FROM entries GROUP BY ALL), u AS (SELECT cls, n_windows AS usual FROM c QUALIFY row_number() OVER (PARTITION BY cls ORDER BY n DESC, n_windows) = 1) SELECT cls, n_windows, n, usual FROM c JOIN u USING (cls) WHERE n_windows <> usual"


QUERIES = {n: (f, globals().get(f"{n.upper()}_SQL")) for n, f in list(globals().items()) if callable(f) and getattr(f, "__module__", "") == __name__ and not n.startswith("_")}
