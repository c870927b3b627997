"""Queries over station records: roles, encoders, anchors, ground motion, and their DuckDB SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quakeframe.operators import encode as N
from quakeframe.operators import groundmotion as M
from quakeframe.operators import split as S
from quakeframe.operators import travel as V
from quakeframe.plans import fixtures as X
from quakeframe.plans import jobs as J
from quakeframe.plans.fixtures import CATALOG_SQL, ENTRIES_SQL, TRACES_SQL, ZONED_SQL
from quakeframe.session import shared_dir
from quakeframe.sources import miniseed as MS
from quakeframe.sources import sinks as K
from quakeframe.sources import stead

_THIRDS = "list_slice(samples, {a}, {b})"


def component_roles(spark, sf_dir):
    """Chosen components of each order's lines, whose line numbers stand for letters."""
    letters = F.element_at(F.array(*map(F.lit, ("Z", "N", "1", "E", "2", "X", "Z"))), F.col("l_linenumber").cast("int"))
    rows = X.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_set(letters).alias("have"))
    return rows.select("l_orderkey", F.array_join(N.role_components(F.col("have")), "").alias("roles")).where("roles is not null")


COMPONENT_ROLES_SQL = """WITH h AS (SELECT l_orderkey, list(DISTINCT ['Z','N','1','E','2','X','Z'][l_linenumber]) AS have FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, 'Z' || CASE WHEN list_contains(have, 'N') THEN 'N' ELSE '1' END || CASE WHEN list_contains(have, 'E') THEN 'E' ELSE '2' END AS roles FROM h
WHERE list_contains(have, 'Z') AND (list_contains(have, 'N') OR list_contains(have, '1')) AND (list_contains(have, 'E') OR list_contains(have, '2'))"""


def _windows(spark, sf_dir):
    part = lambda k: F.slice("samples", 20 * k + 1, 20)
    t = X.traces(spark, sf_dir).select("trace", part(0).alias("z"), part(1).alias("n"), part(2).alias("e"))
    sigma = lambda m: F.when(F.col("trace") % m != 0, 0.05 + (F.col("trace") % 7) / 50.0)
    return t.withColumns({"sigma_z": sigma(2), "sigma_n": sigma(3), "sigma_e": sigma(5), "mu_z": F.lit(0.01), "mu_n": F.lit(None).cast("double"), "mu_e": F.lit(0.0)})


_W = f"{TRACES_SQL}, w AS (SELECT trace, samples[1:20] AS z, samples[21:40] AS n, samples[41:60] AS e, CASE WHEN trace % 2 <> 0 THEN 0.05 + (trace % 7) / 50.0::DOUBLE END AS sz, CASE WHEN trace % 3 <> 0 THEN 0.05 + (trace % 7) / 50.0::DOUBLE END AS sn, CASE WHEN trace % 5 <> 0 THEN 0.05 + (trace % 7) / 50.0::DOUBLE END AS se FROM traces)"


def aux_scalars(spark, sf_dir):
    """Log signal-to-noise and log amplitude of three-component windows."""
    rows = N.aux_scalars(_windows(spark, sf_dir))
    return rows.select("trace", F.round(F.element_at("aux", 1), 8).alias("log_snr"), F.round(F.element_at("aux", 2), 8).alias("log_rms"))


AUX_SCALARS_SQL = f"""WITH {_W}, s AS (SELECT trace, [ln(list_stddev_pop(z) / sz), ln(list_stddev_pop(n) / sn), ln(list_stddev_pop(e) / se)] AS snr, [ln(list_stddev_pop(z)), ln(list_stddev_pop(n)), ln(list_stddev_pop(e))] AS rms FROM w)
SELECT trace, round(coalesce(list_avg(snr), 0.0), 8) AS log_snr, round(list_avg(rms), 8) AS log_rms FROM s"""


def aux_per_component(spark, sf_dir):
    rows = N.aux_scalars(_windows(spark, sf_dir), per_component=True)
    return rows.select("trace", *(F.round(F.element_at("aux", k + 1), 8).alias(f"a{k}") for k in range(6)))


AUX_PER_COMPONENT_SQL = f"""WITH {_W} SELECT trace, round(coalesce(ln(list_stddev_pop(z) / sz), 0.0), 8) AS a0, round(coalesce(ln(list_stddev_pop(n) / sn), 0.0), 8) AS a1, round(coalesce(ln(list_stddev_pop(e) / se), 0.0), 8) AS a2,
round(ln(list_stddev_pop(z)), 8) AS a3, round(ln(list_stddev_pop(n)), 8) AS a4, round(ln(list_stddev_pop(e)), 8) AS a5 FROM w"""


def amplitude_scores(spark, sf_dir):
    """The loudest component of each window in units of its baseline."""
    c = [F.col(x) for x in ("z", "n", "e", "sigma_z", "sigma_n", "sigma_e")]
    return _windows(spark, sf_dir).select("trace", F.round(N.amplitude_score(*c), 8).alias("score"))


AMPLITUDE_SCORES_SQL = f"WITH {_W} SELECT trace, round(greatest(list_stddev_pop(z) / coalesce(sz, 1), list_stddev_pop(n) / coalesce(sn, 1), list_stddev_pop(e) / coalesce(se, 1)), 8) AS score FROM w"


def dual_encoding(spark, sf_dir):
    """Standardized sequences by baseline and angle images: sums of each."""
    rows = N.angle_images(N.sequences(_windows(spark, sf_dir)), 8)
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v.cast("double"))
    return rows.select("trace", *((F.round(total(F.element_at("seq", k + 1)), 3) + 0.0).alias(f"seq_{c}") for k, c in enumerate("zne")), F.round(total(F.flatten(F.element_at("img", 1))), 3).alias("img_z"))


DUAL_ENCODING_SQL = f"""WITH {_W} SELECT trace, round((list_sum(z) - 20*0.01) / greatest(coalesce(sz, list_stddev_pop(z)), 1e-12), 3) + 0.0 AS seq_z, 0.0::DOUBLE AS seq_n, round(list_sum(e) / greatest(coalesce(se, list_stddev_pop(e)), 1e-12), 3) + 0.0 AS seq_e, 32.0::DOUBLE AS img_z FROM w"""


def anchored_slices(spark, sf_dir):
    """Sixteen samples around an arrival, cut to a whole start and clamped to the end; and with the start rounded, without the clamp."""
    rows = X.traces(spark, sf_dir).withColumn("arrival", (F.col("trace") % 70).cast("int"))
    total = lambda a: F.round(F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v), 8)
    return rows.select("trace", "arrival", total(N.anchored(F.col("samples"), F.col("arrival"), 16, 0.2)).alias("clamped"), total(N.anchored(F.col("samples"), F.col("arrival"), 16, 0.2, False)).alias("strict"))


ANCHORED_SLICES_SQL = f"""WITH {TRACES_SQL}, a AS (SELECT trace, CAST(trace % 70 AS INT) AS arrival, samples, CAST(trunc(trace % 70 - 0.2::DOUBLE*16) AS INT) AS start, CAST(round_even(trace % 70 - 0.2::DOUBLE*16, 0) AS INT) AS rounded FROM traces)
SELECT trace, arrival, CASE WHEN start >= 0 AND trace % 70 >= 0.2::DOUBLE*16 - 1 THEN round(list_sum(list_slice(samples, least(start, 48) + 1, least(start, 48) + 16)), 8) END AS clamped,
CASE WHEN rounded >= 0 AND rounded <= 48 THEN round(list_sum(list_slice(samples, rounded + 1, rounded + 16)), 8) END AS strict FROM a"""


def ground_motion(spark, sf_dir):
    """Peaks and flags of records at 5 samples a second; traces 20 and 40 samples on stand for the other components."""
    base = X.traces(spark, sf_dir).withColumn("arrival", (F.col("trace") % 60).cast("int")).withColumn("fs", F.lit(5.0))
    comp = lambda f, s: F.transform("samples", lambda v: v * f + s)
    cols = {f"vel_{c}": comp(1.0 + k, 0.0) for k, c in enumerate("zne")} | {f"acc_{c}": comp(2.0, 0.1 * k) for k, c in enumerate("zne")} | {f"raw_{c}": comp(3e7, 0.0) for c in "zne"}
    rows = M.ground_motion(base.withColumns(cols).withColumn("mask", F.lit(0.0)))
    r = lambda c: F.round(c, 7).alias(c)
    return rows.select("trace", "arrival", *map(r, ("pgv_cms_fwd", "pga_gal_fwd", "pgv_cms_full", "log_peak_input_vel", "label_seconds", "peak_rel_arrival_s")), *(F.col(c).cast("int").alias(c) for c in ("clipped", "label_truncated", "peak_in_input", "pick_at_floor")))


GROUND_MOTION_SQL = f"""WITH {TRACES_SQL}, a AS (SELECT trace, CAST(trace % 60 AS INT) AS arrival, samples, CAST(trunc(trace % 60 - 3.0::DOUBLE) AS INT) AS s FROM traces),
b AS (SELECT *, least(s, 49) AS i0, least(s, 49) + 15 AS i1, list_transform(samples, lambda v: sqrt(v*v + 4*v*v + 9*v*v)) AS vel, list_transform(samples, lambda v: sqrt(4*v*v + (2*v+0.1)*(2*v+0.1) + (2*v+0.2)*(2*v+0.2))) AS acc FROM a WHERE s >= 0),
c AS (SELECT *, list_position(vel, list_max(vel)) - 1 AS pk FROM b)
SELECT trace, arrival, round(list_max(vel[i1+1:64]) * 100, 7) AS pgv_cms_fwd, round(list_max(acc[i1+1:64]) * 100, 7) AS pga_gal_fwd, round(list_max(vel) * 100, 7) AS pgv_cms_full, round(log10(list_max(vel[i0+1:i1]) * 100), 7) AS log_peak_input_vel,
round((64 - i1) / 5.0::DOUBLE, 7) AS label_seconds, round((pk - arrival) / 5.0::DOUBLE, 7) AS peak_rel_arrival_s, CAST(list_max(list_transform(samples, lambda v: abs(v*3e7))) >= 8388608 * 0.99::DOUBLE AS INT) AS clipped, 1 AS label_truncated,
CAST(pk >= i0 AND pk < i1 AS INT) AS peak_in_input, CAST(arrival = 49 AS INT) AS pick_at_floor FROM c"""


def picks(spark, sf_dir):
    """First triggering line of each order: discount stands for the ratio, the vertical comes first."""
    rows = X.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.when(F.col("l_linenumber") == 3, "Z").otherwise("N").alias("component"), F.concat_ws("_", "l_linenumber", "l_partkey", "l_suppkey").alias("channel"), F.when(F.col("l_discount") > 0.06, F.col("l_quantity").cast("int")).alias("onset"), F.col("l_discount").alias("top_ratio")
    )
    return M.pick(rows, ["l_orderkey"])


PICKS_SQL = """WITH r AS (SELECT l_orderkey, CASE WHEN l_discount > 0.06 THEN CAST(l_quantity AS INT) END AS onset, l_discount AS ratio, row_number() OVER (PARTITION BY l_orderkey ORDER BY CAST(l_linenumber <> 3 AS INT), concat_ws('_', l_linenumber, l_partkey, l_suppkey)) AS k FROM lineitem),
f AS (SELECT l_orderkey, min(k) FILTER (onset IS NOT NULL) AS first, arg_min(onset, k) FILTER (onset IS NOT NULL) AS arrival FROM r GROUP BY l_orderkey)
SELECT l_orderkey, arrival, max(ratio) AS best_ratio FROM r JOIN f USING (l_orderkey) WHERE first IS NULL OR k <= first GROUP BY ALL"""


def travel_times(spark, sf_dir):
    """Earliest phase of the cell of each order's distance and depth."""
    grid = spark.range(0, 400).select((F.col("id") % 20 / 10.0).alias("distance_deg"), F.floor(F.col("id") / 20).cast("double").alias("depth_km"), F.explode(F.array(F.lit("P"), F.lit("Pn"), F.lit("S"))).alias("phase"))
    grid = grid.withColumn("seconds", F.col("distance_deg") * 15 + F.col("depth_km") / 7 + F.length("phase"))
    rows = X.table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 27 / 10.0).alias("d"), (F.col("o_custkey") % 23).cast("double").alias("z"))
    return M.travel_time(rows, grid, "d", "z").select("o_orderkey", F.round("predicted_p_s", 7).alias("predicted_p_s"))


TRAVEL_TIMES_SQL = "SELECT o_orderkey, CASE WHEN o_orderkey % 27 < 20 AND o_custkey % 23 < 20 THEN round(o_orderkey % 27 / 10.0::DOUBLE * 15 + o_custkey % 23 / 7.0::DOUBLE + 1, 7) END AS predicted_p_s FROM orders"


def travel_model(spark, sf_dir):
    """First arrivals of a uniform sphere at 6 km/s, interpolated between cells of 0.1 degrees and 5 km of a table that the library makes."""
    times = V.table(spark, [V.Shell(0, 20, 6.0, 6.0), V.Shell(20, 700, 6.0, 6.0)], [5.0 * k for k in range(6)], 0.1, 3.0)
    rows = X.table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 270 / 100.0).alias("d"), (F.col("o_custkey") % 230 / 10.0).alias("z"))
    return V.first_arrival(rows, times, "d", "z", 0.1, 5.0).select("o_orderkey", F.round("predicted_p_s", 3).alias("predicted_p_s"))


_CHORD = "sqrt(6371.0::DOUBLE * 6371 + (6371 - 5.0::DOUBLE * (zk + {j})) * (6371 - 5.0::DOUBLE * (zk + {j})) - 2 * 6371 * (6371 - 5.0::DOUBLE * (zk + {j})) * cos(radians(0.1::DOUBLE * (k + {i})))) / 6"
TRAVEL_MODEL_SQL = f"""WITH r AS (SELECT o_orderkey, o_orderkey % 270 / 100.0::DOUBLE / 0.1::DOUBLE AS x, o_custkey % 230 / 10.0::DOUBLE / 5 AS y FROM orders), c AS (SELECT o_orderkey, floor(x) AS k, floor(y) AS zk, x - floor(x) AS u, y - floor(y) AS v FROM r)
SELECT o_orderkey, round({_CHORD.format(i=0, j=0)} * (1 - u) * (1 - v) + {_CHORD.format(i=1, j=0)} * u * (1 - v) + {_CHORD.format(i=0, j=1)} * (1 - u) * v + {_CHORD.format(i=1, j=1)} * u * v, 3) AS predicted_p_s FROM c"""


def miniseed_round_trip(spark, sf_dir):
    """Traces as whole numbers, without their samples 41 to 44, written as MiniSEED, read in ranges of bytes and merged: the gap is a line."""
    spark.dataSource.register(MS.MiniSeedSource)
    start = F.lit("2024-02-28 23:59:59.5").cast("timestamp_ntz")
    later = F.lit("2024-02-29 00:00:00.1875").cast("timestamp_ntz")  # 44 samples at 64 a second
    whole = X.traces(spark, sf_dir).withColumn("x", F.transform("samples", lambda v: F.rint(v * 1000)))
    pieces = F.array(F.struct(start.alias("starttime"), F.slice("x", 1, 40).alias("samples")), F.struct(later.alias("starttime"), F.slice("x", 45, 20).alias("samples")))
    code = F.conv(F.col("trace").cast("string"), 10, 36)
    rows = whole.select(F.lit("").alias("file_path"), F.lit("XX").alias("network"), code.alias("station"), F.lit("").alias("location"), F.lit("HHZ").alias("channel"), F.inline(pieces))
    path = f"{shared_dir(spark)}/miniseed-{uuid.uuid4().hex}"
    rows.withColumns({"sampling_rate": F.lit(64.0), "npts": F.size("samples")}).select(*MS.COLUMNS).write.format("miniseed").option("record_bytes", "512").mode("append").save(path)
    back = MS.traces(MS.scan(spark, path, split_bytes="65536"))
    total = F.aggregate("samples", F.lit(0.0), lambda a, v: a + v)
    return back.select(F.conv("station", 36, 10).cast("long").alias("trace"), "npts", F.size(F.filter("gap_mask", lambda g: g)).alias("n_gap"), F.element_at("samples", 40).alias("s_40"), F.round(F.element_at("samples", 42), 6).alias("s_42"), F.round(total, 6).alias("total"), "starttime")


MINISEED_ROUND_TRIP_SQL = f"""WITH {TRACES_SQL}, x AS (SELECT trace, list_transform(samples, lambda v: round_even(v * 1000, 0)) AS x FROM traces)
SELECT trace, 64 AS npts, 4 AS n_gap, x[40] + 0.0 AS s_40, round(x[40] + 0.4::DOUBLE * (x[45] - x[40]), 6) AS s_42, round(list_sum(x[1:40]) + list_sum(x[45:64]) + 4 * x[40] + 2 * (x[45] - x[40]), 6) AS total, TIMESTAMP '2024-02-28 23:59:59.5' AS starttime FROM x"""


def manifest_round_trip(spark, sf_dir):
    """Window metadata written as a detection manifest and read back: its columns, missing ones empty."""
    rows = X.entries(spark, sf_dir).select(F.when(F.col("station") % 3 == 0, "test").otherwise("train").alias("split"), F.col("cls").alias("class_name"), F.col("station").alias("station_key"), F.concat_ws("/", F.lit("/d"), "file").alias("file_path"), F.concat_ws("_", "file", "part", "item").alias("filename"), "n_windows")
    path = f"{shared_dir(spark)}/manifest-{uuid.uuid4().hex}"
    K.write_manifest(rows, path, "detection")
    return spark.read.csv(path, header=True).select(*K.MANIFESTS["detection"])


MANIFEST_ROUND_TRIP_SQL = f"""WITH {ENTRIES_SQL} SELECT CASE WHEN station % 3 = 0 THEN 'test' ELSE 'train' END AS split, cls AS class_name, CAST(station AS VARCHAR) AS station_key, '/d/' || file AS file_path, file || '_' || part || '_' || item AS filename, CAST(NULL AS VARCHAR) AS fs FROM entries"""


def array_round_trip(spark, sf_dir):
    """Sequences written as Parquet by split and read back."""
    rows = N.sequences(_windows(spark, sf_dir)).select("trace", "seq", F.when(F.col("trace") % 4 == 0, "val").otherwise("train").alias("split"))
    path = f"{shared_dir(spark)}/arrays-{uuid.uuid4().hex}"
    K.write_arrays(rows, path)
    total = F.aggregate(F.element_at("seq", 1), F.lit(0.0), lambda a, v: a + v.cast("double"))
    return spark.read.parquet(path).select("split", "trace", F.size("seq").alias("n"), (F.round(total, 3) + 0.0).alias("seq_z"))


ARRAY_ROUND_TRIP_SQL = f"""WITH {_W} SELECT CASE WHEN trace % 4 = 0 THEN 'val' ELSE 'train' END AS split, trace, 3 AS n, round((list_sum(z) - 20*0.01) / greatest(coalesce(sz, list_stddev_pop(z)), 1e-12), 3) + 0.0 AS seq_z FROM w"""


def catalog_round_trip(spark, sf_dir):
    """Zoned events written as a catalog and read back by zone."""
    path = f"{shared_dir(spark)}/catalog-{uuid.uuid4().hex}"
    K.write_catalog(X.zoned(spark, sf_dir), path)
    back = spark.read.csv(path, header=True)
    return back.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("magnitude").cast("double")), 4).alias("magnitudes"), F.max(F.col("time").cast("timestamp_ntz")).alias("last"))


CATALOG_ROUND_TRIP_SQL = f"WITH {ZONED_SQL} SELECT region, count(*) AS n, round(sum(magnitude), 4) AS magnitudes, max(time) AS last FROM zoned GROUP BY region"


def window_spectra(spark, sf_dir):
    """Images of three-component windows: decibels that stop 30 below the loudest of the three, as z-scores over all."""
    images = N.spectrogram_images(_windows(spark, sf_dir), 8, 4, 30.0, "per_window")
    of = lambda f, name: F.round(f("img").cast("double"), 2).alias(name)
    return images.select("trace", "freq", "frames", F.size("img").alias("n"), of(F.array_max, "top"), of(F.array_min, "least"))


WINDOW_SPECTRA_SQL = f"""WITH {_W}, src AS (SELECT trace, unnest([1, 2, 3]) AS part, unnest([z, n, e]) AS s FROM w),
c AS (SELECT trace, part, f, j, sum(s[CASE WHEN q < 0 THEN -q WHEN q > 19 THEN 38 - q ELSE q END + 1] * h * cos(2 * pi() * j * k / 8)) AS re, sum(s[CASE WHEN q < 0 THEN -q WHEN q > 19 THEN 38 - q ELSE q END + 1] * h * sin(2 * pi() * j * k / 8)) AS im
 FROM (SELECT trace, part, s, f, k, CAST(4 * f + k - 4 AS INT) AS q, 0.5 - 0.5 * cos(2 * pi() * k / 8) AS h FROM src, range(0, 6) a(f), range(0, 8) b(k)), range(0, 5) g(j) GROUP BY ALL),
d AS (SELECT trace, 10 * log10(greatest(re * re + im * im, 1e-10)) AS db FROM c), e AS (SELECT trace, greatest(db, max(db) OVER (PARTITION BY trace) - 30) AS db FROM d)
SELECT trace, 5 AS freq, 6 AS frames, CAST(count(*) AS INT) AS n, round((max(db) - avg(db)) / (stddev_samp(db) + 1e-6), 2) AS top, round((min(db) - avg(db)) / (stddev_samp(db) + 1e-6), 2) AS least FROM e GROUP BY trace"""


def station_records(spark, sf_dir):
    """Station records of orders whose lines stand for traces: the longest trace of a component, all at one sampling rate."""
    letters = F.element_at(F.array(*map(F.lit, ("Z", "N", "1", "E", "2", "X", "Z"))), F.col("l_linenumber").cast("int"))
    length = (F.col("l_partkey") % 40 + 1).cast("int")
    traces = X.table(spark, sf_dir, "lineitem").where("l_linenumber <= 7").select("l_orderkey", letters.alias("component"), F.array_repeat(F.col("l_quantity"), length).alias("samples"), F.when(F.col("l_linestatus") == "F", 100.0).otherwise(50.0).alias("sampling_rate"))
    rows = N.stations(traces, ["l_orderkey"])
    return rows.select("l_orderkey", "fs", *(F.size(c).alias(f"n_{c}") for c in "zne"))


STATION_RECORDS_SQL = """WITH t AS (SELECT l_orderkey AS o, ['Z','N','1','E','2','X','Z'][l_linenumber] AS c, l_partkey % 40 + 1 AS n, CASE WHEN l_linestatus = 'F' THEN 100.0::DOUBLE ELSE 50.0::DOUBLE END AS fs FROM lineitem WHERE l_linenumber <= 7),
r AS (SELECT *, row_number() OVER (PARTITION BY o, c ORDER BY n DESC, fs DESC) AS k FROM t), p AS (SELECT o, max(n) FILTER (c = 'Z') AS z, max(fs) FILTER (c = 'Z') AS fz, max(n) FILTER (c = 'N') AS n0, max(fs) FILTER (c = 'N') AS f0, max(n) FILTER (c = '1') AS n1, max(fs) FILTER (c = '1') AS f1,
 max(n) FILTER (c = 'E') AS e0, max(fs) FILTER (c = 'E') AS g0, max(n) FILTER (c = '2') AS e1, max(fs) FILTER (c = '2') AS g1 FROM r WHERE k = 1 GROUP BY o)
SELECT o AS l_orderkey, fz AS fs, CAST(z AS INT) AS n_z, CAST(coalesce(n0, n1) AS INT) AS n_n, CAST(coalesce(e0, e1) AS INT) AS n_e FROM p WHERE fz = coalesce(f0, f1) AND fz = coalesce(g0, g1)"""


def first_files(spark, sf_dir):
    """The first 200 file names in order, of the rows of one class."""
    files = X.entries(spark, sf_dir).where("cls = 'A'").select(F.concat_ws("_", "file", "part", "item").alias("file_path"))
    return J.first_files(files, 200)


FIRST_FILES_SQL = f"WITH {ENTRIES_SQL} SELECT file || '_' || part || '_' || item AS file_path FROM entries WHERE cls = 'A' ORDER BY file_path LIMIT 200"


def resampled(spark, sf_dir):
    """Traces from 64 to 32 samples a second, by the taps of the low-pass in SQL."""
    rows = N.resample(X.traces(spark, sf_dir), "samples", 64.0, 32.0, 40)
    nth = lambda k: F.round(F.element_at("samples", k), 8).alias(f"s_{k}")
    return rows.select("trace", F.size("samples").alias("n"), nth(1), nth(17), nth(32), nth(40))


_BESSEL = "list_sum(list_transform(range(0, 40), lambda m: exp(2 * m * ln(greatest({x}, 1e-300) / 2) - 2 * lgamma(m + 1.0::DOUBLE))))"
RESAMPLED_SQL = f"""WITH {TRACES_SQL}, k AS (SELECT i, CASE WHEN i = 0 THEN 0.5::DOUBLE ELSE sin(pi() * i / 2) / (pi() * i) END * {_BESSEL.format(x='(5.0::DOUBLE * sqrt(1 - i * i / 400.0::DOUBLE))')} AS h FROM range(-20, 21) r(i)), t AS (SELECT i, h / sum(h) OVER () AS h FROM k),
c AS (SELECT trace, j, sum(h * coalesce(CASE WHEN 2 * (j - 1) - i >= 0 THEN samples[2 * (j - 1) - i + 1] END, 0.0)) AS v FROM traces, t, (VALUES (1), (17), (32)) q(j) GROUP BY ALL)
SELECT trace, 40 AS n, round(max(v) FILTER (j = 1), 8) AS s_1, round(max(v) FILTER (j = 17), 8) AS s_17, round(max(v) FILTER (j = 32), 8) AS s_32, 0.0::DOUBLE AS s_40 FROM c GROUP BY trace"""


def quality_counts(spark, sf_dir):
    """Records by response flag and mismatch, and how many pass both."""
    rows = X.table(spark, sf_dir, "lineitem").select((F.col("l_linestatus") == "F").alias("ok"), F.when(F.col("l_tax") > 0.01, F.col("l_tax")).alias("mismatch"))
    keep = F.col("ok") & (F.col("mismatch") <= 0.05)
    return rows.groupBy(F.col("ok").cast("int").alias("ok")).agg(F.count(F.lit(1)).alias("n"), F.count(F.when(keep, 1)).alias("n_clean"), F.count(F.when(F.col("mismatch").isNull(), 1)).alias("n_unknown"))


QUALITY_COUNTS_SQL = "WITH r AS (SELECT CAST(l_linestatus = 'F' AS INT) AS ok, CASE WHEN l_tax > 0.01 THEN l_tax END AS m FROM lineitem) SELECT ok, count(*) AS n, count(*) FILTER (ok = 1 AND m <= 0.05) AS n_clean, count(*) FILTER (m IS NULL) AS n_unknown FROM r GROUP BY ok"


def stead_match(spark, sf_dir):
    """Traces that pass optional limits; the ratio is the first number of a bracketed list."""
    rows = X.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.concat(F.lit("["), F.col("l_discount") * 100, F.lit(" 3.5 1.0]")).alias("snr"), F.when(F.col("l_linenumber") != 2, F.col("l_quantity")).alias("magnitude"))
    return stead.matching(rows, 10, None, 4).select("l_orderkey", "l_linenumber", "l_partkey")


STEAD_MATCH_SQL = "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_discount * 100 >= 4 AND l_linenumber <> 2 AND l_quantity >= 10"


def fill_splits(spark, sf_dir):
    """Stations fill train, validation and test in that order."""
    keys = X.entries(spark, sf_dir).groupBy("station").agg(F.sum(F.when(F.col("cls") == "A", F.col("n_windows")).otherwise(0)).alias("w_a"), F.sum(F.when(F.col("cls") == "R", F.col("n_windows")).otherwise(0)).alias("w_r"))
    return S.fill_splits(keys, "station", ["w_a", "w_r"])


FILL_SPLITS_SQL = f"""WITH RECURSIVE {ENTRIES_SQL}, g AS (SELECT station, CAST(coalesce(sum(n_windows) FILTER (cls = 'A'), 0) AS BIGINT) AS a, CAST(coalesce(sum(n_windows) FILTER (cls = 'R'), 0) AS BIGINT) AS r, row_number() OVER (ORDER BY md5('42|' || station)) AS k FROM entries GROUP BY station),
t AS (SELECT CAST(floor(m * 0.70::DOUBLE) AS BIGINT) AS t1, CAST(floor(m * 0.15::DOUBLE) AS BIGINT) AS t2, m - CAST(floor(m * 0.70::DOUBLE) AS BIGINT) - CAST(floor(m * 0.15::DOUBLE) AS BIGINT) AS t3 FROM (SELECT CAST(least(sum(a), sum(r)) AS BIGINT) AS m FROM g)),
f(k, a1, r1, a2, r2, a3, r3, split) AS (SELECT 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, NULL::VARCHAR UNION ALL
 SELECT k, a1 + CASE WHEN s = 'train' THEN a ELSE 0 END, r1 + CASE WHEN s = 'train' THEN r ELSE 0 END, a2 + CASE WHEN s = 'val' THEN a ELSE 0 END, r2 + CASE WHEN s = 'val' THEN r ELSE 0 END, a3 + CASE WHEN s = 'test' THEN a ELSE 0 END, r3 + CASE WHEN s = 'test' THEN r ELSE 0 END, s FROM (
  SELECT g.k, a, r, a1, r1, a2, r2, a3, r3, CASE WHEN (a > 0 AND a1 < t1) OR (r > 0 AND r1 < t1) THEN 'train' WHEN (a > 0 AND a2 < t2) OR (r > 0 AND r2 < t2) THEN 'val' WHEN (a > 0 AND a3 < t3) OR (r > 0 AND r3 < t3) THEN 'test' END AS s FROM f JOIN g ON g.k = f.k + 1, t))
SELECT station, split FROM g JOIN f USING (k) WHERE split IS NOT NULL"""


def trim_surplus(spark, sf_dir):
    """Quotas that cut every class of a station to its smallest class."""
    counts = X.entries(spark, sf_dir).groupBy("station", "cls", "part").agg(F.sum("n_windows").alias("w"))
    return S.trim_surplus(counts, "station", "cls", "w", "part").select("station", "cls", "part", "w", "quota")


TRIM_SURPLUS_SQL = f"""WITH {ENTRIES_SQL}, c AS (SELECT station, cls, part, CAST(sum(n_windows) AS BIGINT) AS w FROM entries GROUP BY ALL), s AS (SELECT *, CAST(sum(w) OVER (PARTITION BY station, cls) AS BIGINT) AS total FROM c),
m AS (SELECT *, min(total) OVER (PARTITION BY station) AS least FROM s), x AS (SELECT *, w * least / CAST(total AS DOUBLE) AS x FROM m), o AS (SELECT *, row_number() OVER (PARTITION BY station, cls ORDER BY x - floor(x) DESC, part) AS k, least - sum(floor(x)) OVER (PARTITION BY station, cls) AS short FROM x)
SELECT station, cls, part, w, CAST(floor(x) + CASE WHEN k <= short THEN 1 ELSE 0 END AS BIGINT) AS quota FROM o"""


def _station_traces(spark, sf_dir):
    """Each vector as a file of three components of 20 samples, a label a station."""
    t = X.traces(spark, sf_dir).join(X.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("trace"), "label"), "trace")
    parts = F.array(*(F.struct(F.lit(c).alias("component"), F.slice("samples", 20 * k + 1, 20).alias("samples")) for k, c in enumerate("ZNE")))
    return t.select("trace", F.concat(F.lit("/d/event_"), "trace", F.lit("_raw.mseed")).alias("file_path"), F.concat(F.lit("N.S"), "label").alias("station_key"), F.lit(10.0).alias("sampling_rate"), F.inline(parts))


def detection_manifest(spark, sf_dir):
    """The manifest of the detection dataset: two classes, 152 windows a station at most, stations in one split each."""
    traces = _station_traces(spark, sf_dir)
    classes = traces.select("file_path", F.when(F.col("trace") % 3 == 0, "quake").otherwise("noise").alias("class_name")).distinct()
    rows = J.detection_dataset(traces.drop("trace"), classes, lambda windows: windows, 152, 10.0, 0.6, 0.5)
    return rows.select(*K.MANIFESTS["detection"])


_MANIFEST = """f AS (SELECT '/d/event_' || vec_id || '_raw.mseed' AS file_path, 'N.S' || label AS station_key, CASE WHEN vec_id % 3 = 0 THEN 'quake' ELSE 'noise' END AS class_name, vec_id FROM embeddings),
q AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY station_key) * 5 > 152 THEN greatest(0, least(5, 152 - 5 * (row_number() OVER (PARTITION BY station_key ORDER BY md5('42|' || file_path), file_path) - 1))) ELSE 5 END AS kept FROM f)"""
DETECTION_MANIFEST_SQL = f"""WITH RECURSIVE {_MANIFEST}, g AS (SELECT station_key, CAST(coalesce(sum(kept) FILTER (class_name = 'noise'), 0) AS BIGINT) AS a, CAST(coalesce(sum(kept) FILTER (class_name = 'quake'), 0) AS BIGINT) AS r, row_number() OVER (ORDER BY md5('42|' || station_key)) AS k FROM q GROUP BY station_key),
t AS (SELECT CAST(floor(m * 0.70::DOUBLE) AS BIGINT) AS t1, CAST(floor(m * 0.15::DOUBLE) AS BIGINT) AS t2, m - CAST(floor(m * 0.70::DOUBLE) AS BIGINT) - CAST(floor(m * 0.15::DOUBLE) AS BIGINT) AS t3 FROM (SELECT CAST(least(sum(a), sum(r)) AS BIGINT) AS m FROM g)),
s(k, a1, r1, a2, r2, a3, r3, split) AS (SELECT 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, NULL::VARCHAR UNION ALL
 SELECT k, a1 + CASE WHEN c = 'train' THEN a ELSE 0 END, r1 + CASE WHEN c = 'train' THEN r ELSE 0 END, a2 + CASE WHEN c = 'val' THEN a ELSE 0 END, r2 + CASE WHEN c = 'val' THEN r ELSE 0 END, a3 + CASE WHEN c = 'test' THEN a ELSE 0 END, r3 + CASE WHEN c = 'test' THEN r ELSE 0 END, c FROM (
  SELECT g.k, a, r, a1, r1, a2, r2, a3, r3, CASE WHEN (a > 0 AND a1 < t1) OR (r > 0 AND r1 < t1) THEN 'train' WHEN (a > 0 AND a2 < t2) OR (r > 0 AND r2 < t2) THEN 'val' WHEN (a > 0 AND a3 < t3) OR (r > 0 AND r3 < t3) THEN 'test' END AS c FROM s JOIN g ON g.k = s.k + 1, t)),
w AS (SELECT split, class_name, station_key, file_path, vec_id, kept, i FROM q JOIN g USING (station_key) JOIN s USING (k), range(0, 5) r(i) WHERE split IS NOT NULL AND kept > 0)
SELECT split, class_name, station_key, file_path, 'event_' || vec_id || '_raw_' || station_key || '_win00' || i || '.parquet' AS filename, 10.0::DOUBLE AS fs FROM w WHERE kept >= 5 OR i IN (SELECT round_even(j * (4 / greatest(kept - 1, 1)::DOUBLE), 0) FROM range(0, 5) u(j) WHERE j < kept)"""


def risk_manifest(spark, sf_dir):
    """The manifest of the risk dataset without its arrays: three classes, noise and low risk cut to twice a split's high-risk windows."""
    traces = _station_traces(spark, sf_dir)
    quakes, noise = traces.where("trace % 3 <> 0").drop("trace"), traces.where("trace % 3 = 0").drop("trace")
    events = X.catalog(spark, sf_dir).where("event_id % 7 <> 0").select(F.col("event_id").cast("string").alias("event_id"), "magnitude", "lat", "lon")
    stations = spark.range(0, 10).select(F.concat(F.lit("N.S"), "id").alias("key"), (38 + F.col("id") / 10).alias("latitude"), (30 - F.col("id") / 10).alias("longitude"))
    rows = J.risk_dataset(quakes, noise, events, stations, lambda windows: windows, None, 3.0, 2.0, None, None, 10.0, 0.6, 0.5)
    return rows.select("split", "risk_class", "station_key", "event_id", "file_path", "filename", "fs", "magnitude", F.round("distance_km", 6).alias("distance_km"))


_HAV = "2 * 6371.0 * asin(sqrt(pow(sin(radians(38 + label / 10.0::DOUBLE - lat) / 2), 2) + cos(radians(lat)) * cos(radians(38 + label / 10.0::DOUBLE)) * pow(sin(radians(30 - label / 10.0::DOUBLE - lon) / 2), 2)))"
_GAPS = """gaps(k, a, b, c, split) AS (SELECT 0::BIGINT, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, '' UNION ALL
  SELECT k, a + CASE WHEN s = 'train' THEN w ELSE 0 END, b + CASE WHEN s = 'val' THEN w ELSE 0 END, c + CASE WHEN s = 'test' THEN w ELSE 0 END, s FROM (
    SELECT g.k, w, a, b, c, CASE WHEN (t*0.70::DOUBLE - a) / greatest(t*0.70::DOUBLE, 1) >= (t*0.15::DOUBLE - b) / greatest(t*0.15::DOUBLE, 1) AND (t*0.70::DOUBLE - a) / greatest(t*0.70::DOUBLE, 1) >= (t*0.15::DOUBLE - c) / greatest(t*0.15::DOUBLE, 1) THEN 'train'
      WHEN (t*0.15::DOUBLE - b) / greatest(t*0.15::DOUBLE, 1) >= (t*0.15::DOUBLE - c) / greatest(t*0.15::DOUBLE, 1) THEN 'val' ELSE 'test' END AS s FROM gaps JOIN g ON g.k = gaps.k + 1))"""
RISK_MANIFEST_SQL = f"""WITH RECURSIVE {CATALOG_SQL}, f AS (SELECT vec_id, label, '/d/event_' || vec_id || '_raw.mseed' AS file_path, 'N.S' || label AS station_key FROM embeddings),
e AS (SELECT f.*, CAST(event_id AS VARCHAR) AS event_id, magnitude, lat, lon, CASE WHEN magnitude >= 3 THEN '02_high_risk' ELSE '01_low_risk' END AS risk_class FROM f JOIN catalog ON vec_id = event_id WHERE vec_id % 3 <> 0 AND event_id % 7 <> 0
 UNION ALL SELECT f.*, NULL, NULL, NULL, NULL, '00_noise' FROM f WHERE vec_id % 3 = 0),
g AS (SELECT station_key, 5.0::DOUBLE * count(*) AS w, row_number() OVER (ORDER BY md5('42|' || station_key)) AS k, sum(5.0::DOUBLE * count(*)) OVER () AS t FROM e GROUP BY station_key), {_GAPS},
p AS (SELECT *, 5 * (row_number() OVER (PARTITION BY split, risk_class ORDER BY md5('49|' || file_path || '|' || station_key), file_path, station_key) - 1) AS prior, sum(CASE WHEN risk_class = '02_high_risk' THEN 5 ELSE 0 END) OVER (PARTITION BY split) AS high FROM e JOIN g USING (station_key) JOIN gaps USING (k))
SELECT split, risk_class, station_key, event_id, file_path, 'event_' || vec_id || '_raw_' || station_key || '_win00' || i || '.parquet' AS filename, 10.0::DOUBLE AS fs, magnitude, round({_HAV}, 6) AS distance_km FROM p, range(0, 5) r(i)
WHERE risk_class = '02_high_risk' OR high = 0 OR prior < round_even(high * 2.0::DOUBLE, 0)"""


def event_manifest(spark, sf_dir):
    """Windows of known events with magnitude and distance, an event in one split: the regression dataset's manifest."""
    windows = J.station_windows(_station_traces(spark, sf_dir).drop("trace"), 0.6, 0.5, 10.0)
    events = X.catalog(spark, sf_dir).where("event_id % 4 = 0").select(F.col("event_id").cast("string").alias("event_id"), "magnitude", "lat", "lon")
    stations = spark.range(0, 10).where("id <> 7").select(F.concat(F.lit("N.S"), "id").alias("key"), (38 + F.col("id") / 10).alias("latitude"), (30 - F.col("id") / 10).alias("longitude"))
    rows = J.event_dataset(windows, events, stations)
    return rows.select("split", "event_id", "station_key", "w_idx", "magnitude", F.round("distance_km", 6).alias("distance_km"))


EVENT_MANIFEST_SQL = f"""WITH RECURSIVE {CATALOG_SQL}, j AS (SELECT CAST(event_id AS VARCHAR) AS event_id, 'N.S' || label AS station_key, magnitude, CASE WHEN label <> 7 THEN round({_HAV}, 6) END AS distance_km FROM catalog JOIN embeddings ON event_id = vec_id WHERE event_id % 4 = 0),
g AS (SELECT event_id, 5.0::DOUBLE AS w, row_number() OVER (ORDER BY md5('42|' || event_id)) AS k, 5.0::DOUBLE * count(*) OVER () AS t FROM j),
{_GAPS}
SELECT split, event_id, station_key, CAST(i AS INT) AS w_idx, magnitude, distance_km FROM j JOIN g USING (event_id) JOIN gaps USING (k), range(0, 5) r(i)"""


QUERIES = {n: (f, globals().get(f"{n.upper()}_SQL")) for n, f in list(globals().items()) if callable(f) and getattr(f, "__module__", "") == __name__ and not n.startswith("_")}
