"""Catalog queries and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakeframe.functions import columns as C
from quakeframe.operators import decluster as D
from quakeframe.operators import evaluate as E
from quakeframe.operators import sequence as Q
from quakeframe.operators import split as S
from quakeframe.plans import fixtures as X
from quakeframe.plans import jobs as J
from quakeframe.plans.fixtures import CATALOG_SQL, HORIZON_DAYS, THRESHOLD, ZONED_SQL
from quakeframe.session import materialize
from quakeframe.sources import catalog as K

FEATURES = ("log_duration_days", "log_rate", "log_rate_recent", "rate_accel", "mean_mag", "max_mag", "mag_std", "log_total_energy", "log_energy_recent_frac", "b_value")
R = 7


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    """Values that differ in the last bits between engines, to R decimals."""
    return df.withColumns({n: F.round(n, R) for n in names})


#: Features of the 64-event windows, every eighth event, by the plain definition.
WINDOWS_SQL = f"""{ZONED_SQL}, placed AS (
  SELECT *, row_number() OVER (PARTITION BY region ORDER BY time, event_id) - 1 AS idx, count(*) OVER (PARTITION BY region) AS total,
         max(time) OVER (PARTITION BY region) AS catalog_end, pow(10.0, 1.5*magnitude + 4.8) AS e FROM zoned),
framed AS (
  SELECT region, idx AS start_idx, total, catalog_end, time AS start_time, last_value(time) OVER w AS end_time, nth_value(time, 49) OVER w AS recent_time,
         avg(magnitude) OVER w AS mean_mag, max(magnitude) OVER w AS max_mag, min(magnitude) OVER w AS min_mag, stddev_pop(magnitude) OVER w AS mag_std,
         sum(e) OVER w AS whole, sum(e) OVER (PARTITION BY region ORDER BY time, event_id ROWS BETWEEN 48 FOLLOWING AND 63 FOLLOWING) AS recent
  FROM placed WINDOW w AS (PARTITION BY region ORDER BY time, event_id ROWS BETWEEN CURRENT ROW AND 63 FOLLOWING)),
kept AS (
  SELECT *, greatest(epoch_us(end_time) / 86400e6 - epoch_us(start_time) / 86400e6, 1e-3) AS dur0,
         greatest((epoch_us(end_time) - epoch_us(start_time)) / 86400e6, 1e-3) AS dur, greatest((epoch_us(end_time) - epoch_us(recent_time)) / 86400e6, 1e-3) AS short
  FROM framed WHERE start_idx % 8 = 0 AND start_idx + 64 <= total AND total >= 128),
windows AS (
  SELECT region, start_idx, start_time, end_time, catalog_end, log10(dur) AS log_duration_days, log10(64/dur) AS log_rate, log10(16/short) AS log_rate_recent,
         log10(16/short) - log10(64/dur) AS rate_accel, mean_mag, max_mag, mag_std, log10(greatest(whole, 1e-12)) AS log_total_energy,
         log10(greatest(recent, 1e-12) / greatest(whole, 1e-12)) AS log_energy_recent_frac,
         CASE WHEN mean_mag - min_mag > 1e-6 THEN log10(exp(1)) / (mean_mag - min_mag) END AS b_value
  FROM kept)"""
_FEATURE_SQL = ", ".join(f"round({f}, {R}) AS {f}" for f in FEATURES)
DENSE_SQL = f"""{WINDOWS_SQL}, dense AS (
  SELECT w.*, (SELECT max(time) FROM zoned z WHERE z.region = w.region AND magnitude >= {THRESHOLD} AND time < w.end_time) AS prev_major,
         (SELECT min(time) FROM zoned z WHERE z.region = w.region AND magnitude >= {THRESHOLD} AND time > w.end_time) AS next_major
  FROM windows w WHERE end_time + INTERVAL 1 DAY <= catalog_end)"""


def _dense(spark, sf_dir):
    return Q.dense_windows(X.zoned(spark, sf_dir), threshold=THRESHOLD, horizon_days=HORIZON_DAYS)


def forecast_windows(spark, sf_dir):
    return _rounded(_dense(spark, sf_dir).drop("next_magnitude"), *FEATURES, "days_since_prev_major")


FORECAST_WINDOWS_SQL = f"""WITH {DENSE_SQL}
SELECT region, start_idx, start_time, end_time, {_FEATURE_SQL}, round((epoch_us(end_time) - epoch_us(prev_major)) / 86400e6, {R}) AS days_since_prev_major,
       CAST(coalesce(next_major <= end_time + INTERVAL 1 DAY, false) AS INT) AS label FROM dense"""


def next_magnitude(spark, sf_dir):
    return _dense(spark, sf_dir).select("region", "start_idx", "label", "next_magnitude")


NEXT_MAGNITUDE_SQL = f"""WITH {DENSE_SQL}
SELECT d.region, start_idx, CAST(coalesce(next_major <= end_time + INTERVAL 1 DAY, false) AS INT) AS label,
       min(CASE WHEN next_major <= end_time + INTERVAL 1 DAY THEN magnitude END) AS next_magnitude
FROM dense d LEFT JOIN zoned z ON z.region = d.region AND z.time = d.next_major AND magnitude >= {THRESHOLD} GROUP BY ALL"""


def forecast_split(spark, sf_dir):
    split = S.chronological(_dense(spark, sf_dir), embargo_days=HORIZON_DAYS)
    return split.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("positives"), F.min("end_time").alias("first"), F.max("end_time").alias("last"))


_CUTS_SQL = """span AS (SELECT min(epoch_us(end_time)) AS t0, max(epoch_us(end_time)) AS t1 FROM {src}),
cuts AS (SELECT t0 + CAST(round((t1-t0)/1e6/86400*0.7*86400e6) AS BIGINT) AS c1, t0 + CAST(round((t1-t0)/1e6/86400*(0.7::DOUBLE+0.15::DOUBLE)*86400e6) AS BIGINT) AS c2 FROM span)"""
FORECAST_SPLIT_SQL = f"""WITH {DENSE_SQL}, {_CUTS_SQL.format(src="dense")}, split AS (
  SELECT *, epoch_us(end_time) AS e, CASE WHEN epoch_us(end_time) <= c1 - 86400000000 THEN 'train' WHEN epoch_us(end_time) > c1 AND epoch_us(end_time) <= c2 - 86400000000 THEN 'val'
         WHEN epoch_us(end_time) > c2 THEN 'test' ELSE 'dropped' END AS split FROM dense, cuts)
SELECT split, count(*) AS n, sum(CAST(coalesce(next_major <= end_time + INTERVAL 1 DAY, false) AS INT)) AS positives, min(end_time) AS first, max(end_time) AS last FROM split GROUP BY split"""


def forecast_blocks(spark, sf_dir):
    events = X.zoned(spark, sf_dir)
    return Q.horizon_blocks(_dense(spark, sf_dir), events, THRESHOLD, HORIZON_DAYS)


FORECAST_BLOCKS_SQL = f"""WITH {DENSE_SQL}, placed_windows AS (SELECT *, row_number() OVER (PARTITION BY region ORDER BY end_time, start_idx) - 1 AS fc FROM dense),
span AS (SELECT region, min(end_time) AS t0, least(max(end_time), max(catalog_end)) AS stop FROM dense GROUP BY region),
blocks AS (SELECT region, t0 + to_days(CAST(k AS INT)) AS block_start, t0 + to_days(CAST(k AS INT) + 1) AS block_end FROM span, range(0, 400) r(k) WHERE t0 + to_days(CAST(k AS INT) + 1) <= stop),
known AS (SELECT b.region, block_start, block_end, max(fc) AS fc_index FROM blocks b JOIN placed_windows p ON p.region = b.region AND p.end_time < block_start GROUP BY ALL)
SELECT k.region, block_start, block_end, fc_index, p.end_time AS fc_time, CAST(count(z.time) > 0 AS INT) AS label, count(z.time) AS n_major
FROM known k JOIN placed_windows p ON p.region = k.region AND p.fc = fc_index LEFT JOIN zoned z ON z.region = k.region AND z.magnitude >= {THRESHOLD} AND z.time >= block_start AND z.time < block_end
GROUP BY ALL"""


def _tercile(spark, sf_dir):
    events = X.zoned(spark, sf_dir)
    return Q.tercile_windows(events, events.where(F.col("magnitude") >= THRESHOLD).select("region", "time"), major=THRESHOLD)


TERCILE_SQL = f"""{WINDOWS_SQL}, tercile AS (
  SELECT *, (epoch_us(target_time) - epoch_us(end_time)) / 86400e6 AS days_to_major FROM (
    SELECT w.*, (SELECT min(time) FROM zoned z WHERE z.region = w.region AND magnitude >= {THRESHOLD} AND time > w.end_time) AS target_time FROM windows w WHERE max_mag < {THRESHOLD})
  WHERE target_time IS NOT NULL AND (epoch_us(target_time) - epoch_us(end_time)) / 86400e6 <= 3650)"""


def tercile_windows(spark, sf_dir):
    return _rounded(_tercile(spark, sf_dir).select("region", "start_idx", "end_time", "target_time", "days_to_major", "b_value", "max_mag"), "days_to_major", "b_value")


TERCILE_WINDOWS_SQL = f"WITH {TERCILE_SQL} SELECT region, start_idx, end_time, target_time, round(days_to_major, {R}) AS days_to_major, round(b_value, {R}) AS b_value, max_mag FROM tercile"


def tercile_split(spark, sf_dir):
    """Label-aware split, then classes by the terciles of train."""
    split = S.chronological(_tercile(spark, sf_dir), target="target_time")
    classed = S.tercile_classes(split, fit_on=F.col("split") == "train")
    return _rounded(classed.select("region", "start_idx", "split", "tercile", "low_days", "high_days"), "low_days", "high_days")


TERCILE_SPLIT_SQL = f"""WITH {TERCILE_SQL}, {_CUTS_SQL.format(src="tercile")}, split AS (
  SELECT *, CASE WHEN epoch_us(end_time) <= c1 THEN CASE WHEN epoch_us(target_time) > c1 THEN 'dropped' ELSE 'train' END
    WHEN epoch_us(end_time) <= c2 THEN CASE WHEN epoch_us(target_time) > c2 THEN 'dropped' ELSE 'val' END ELSE 'test' END AS split FROM tercile, cuts),
edges AS (SELECT CASE WHEN count(*) < 3 THEN 365.0 ELSE quantile_cont(days_to_major, 1.0::DOUBLE/3) END AS low_days, CASE WHEN count(*) < 3 THEN 1825.0 ELSE quantile_cont(days_to_major, 2.0::DOUBLE/3) END AS high_days FROM split WHERE split = 'train')
SELECT region, start_idx, split, CASE WHEN days_to_major < low_days THEN 0 WHEN days_to_major < high_days THEN 1 ELSE 2 END AS tercile, round(low_days, {R}) AS low_days, round(high_days, {R}) AS high_days FROM split, edges"""


def tercile_one_out(spark, sf_dir):
    """Windows for folds that leave one target event out: one split, terciles of all rows."""
    events = X.zoned(spark, sf_dir)
    rows = J.tercile_dataset(events, events.where(F.col("magnitude") >= THRESHOLD).select("region", "time"), THRESHOLD, True, 1)
    return _rounded(rows.select("region", "start_idx", "split", "tercile", "low_days", "high_days"), "low_days", "high_days")


TERCILE_ONE_OUT_SQL = f"""WITH {TERCILE_SQL}, edges AS (SELECT CASE WHEN count(*) < 3 THEN 365.0 ELSE quantile_cont(days_to_major, 1.0::DOUBLE/3) END AS low_days, CASE WHEN count(*) < 3 THEN 1825.0 ELSE quantile_cont(days_to_major, 2.0::DOUBLE/3) END AS high_days FROM tercile)
SELECT region, start_idx, 'all' AS split, CASE WHEN days_to_major < low_days THEN 0 WHEN days_to_major < high_days THEN 1 ELSE 2 END AS tercile, round(low_days, {R}) AS low_days, round(high_days, {R}) AS high_days FROM tercile, edges"""


def zone_events(spark, sf_dir):
    return X.zoned(spark, sf_dir).groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("magnitude") >= THRESHOLD).cast("int")).alias("n_major"), F.min("time").alias("first"), F.max("time").alias("last"))


ZONE_EVENTS_SQL = f"WITH {ZONED_SQL} SELECT region, count(*) AS n, sum(CAST(magnitude >= {THRESHOLD} AS INT)) AS n_major, min(time) AS first, max(time) AS last FROM zoned GROUP BY region"


def radius_events(spark, sf_dir):
    rows = X.catalog(spark, sf_dir).withColumn("km", C.haversine_km(F.col("lat"), F.col("lon"), F.lit(38.0), F.lit(33.0)))
    return rows.where(K.in_radius(F.col("lat"), F.col("lon"), (38.0, 33.0), 250.5)).select("event_id", F.round("km", 6).alias("km"))


_HAVERSINE = "2*6371*asin(sqrt(least(greatest(pow(sin((radians({b})-radians({a}))/2),2) + cos(radians({a}))*cos(radians({b}))*pow(sin((radians({d})-radians({c}))/2),2),0),1)))"
RADIUS_EVENTS_SQL = f"WITH {CATALOG_SQL}, d AS (SELECT event_id, {_HAVERSINE.format(a='lat', b='38.0', c='lon', d='33.0')} AS km FROM catalog) SELECT event_id, round(km, 6) AS km FROM d WHERE km <= 250.5"


def catalog_normalize(spark, sf_dir):
    """A raw catalog with day-first text times, blank magnitudes and depths, read by header aliases."""
    c = X.catalog(spark, sf_dir)
    raw = c.select(
        F.date_format("time", "dd/MM/yyyy HH:mm:ss").alias("Tarih"),
        F.col("lat").cast("string").alias(" Enlem "),
        F.col("lon").cast("string").alias("Boylam"),
        F.when(F.col("event_id") % 5 != 0, F.col("depth").cast("string")).otherwise("").alias("Derinlik"),
        F.when(F.col("event_id") % 7 != 0, F.col("magnitude").cast("string")).otherwise("n/a").alias("Büyüklük"),
        F.col("event_id").alias("EventID"),
    )
    return K.normalize(raw, 2.5)


CATALOG_NORMALIZE_SQL = f"""WITH {CATALOG_SQL}, kept AS (SELECT date_trunc('second', time) AS time, lat, lon, CASE WHEN event_id % 5 <> 0 THEN depth END AS depth, magnitude, CAST(event_id AS VARCHAR) AS event_id FROM catalog WHERE event_id % 7 <> 0 AND magnitude >= 2.5)
SELECT time, lat, lon, coalesce(depth, (SELECT median(depth) FROM kept), 10.0) AS depth, magnitude, event_id FROM kept"""


def event_lookup(spark, sf_dir):
    rows = X.catalog(spark, sf_dir).select((F.col("event_id") % 997).cast("string").alias("event_id"), "magnitude", "lat", "lon", F.col("event_id").alias("row"))
    return K.last_by_id(rows, "row").select("event_id", "magnitude", "lat", "lon")


EVENT_LOOKUP_SQL = f"WITH {CATALOG_SQL} SELECT CAST(event_id % 997 AS VARCHAR) AS event_id, arg_max(magnitude, event_id) AS magnitude, arg_max(lat, event_id) AS lat, arg_max(lon, event_id) AS lon FROM catalog GROUP BY ALL"


def station_fallback(spark, sf_dir):
    """NET.STA coordinates, else those of the bare station code."""
    sup = X.table(spark, sf_dir, "supplier")
    stations = sup.where(F.col("s_suppkey") % 3 != 0).select(
        F.concat(F.lit("N"), F.col("s_nationkey") % 2).alias("network"), (F.col("s_suppkey") % 40).cast("string").alias("station"), (34 + F.col("s_suppkey") * 7 % 80 / 10.0).alias("latitude"), (25 + F.col("s_suppkey") * 13 % 170 / 10.0).alias("longitude"), F.col("s_suppkey").alias("row")
    )
    asked = sup.select("s_suppkey", F.concat(F.lit("N"), F.col("s_suppkey") % 3).alias("network"), (F.col("s_suppkey") % 55).cast("string").alias("station"))
    return K.with_station(asked, K.station_keys(stations, "row"))


STATION_FALLBACK_SQL = """WITH st AS (SELECT 'N' || (s_nationkey % 2) AS network, CAST(s_suppkey % 40 AS VARCHAR) AS station, 34 + (s_suppkey*7 % 80) / 10.0::DOUBLE AS latitude, 25 + (s_suppkey*13 % 170) / 10.0::DOUBLE AS longitude, s_suppkey AS row FROM supplier WHERE s_suppkey % 3 <> 0),
keys AS (SELECT key, arg_min(latitude, row) AS latitude, arg_min(longitude, row) AS longitude FROM (SELECT network || '.' || station AS key, * FROM st UNION ALL SELECT station AS key, * FROM st) GROUP BY key),
asked AS (SELECT s_suppkey, 'N' || (s_suppkey % 3) AS network, CAST(s_suppkey % 55 AS VARCHAR) AS station FROM supplier)
SELECT s_suppkey, network, station, coalesce(f.latitude, b.latitude) AS latitude, coalesce(f.longitude, b.longitude) AS longitude FROM asked a LEFT JOIN keys f ON f.key = network || '.' || station LEFT JOIN keys b ON b.key = station"""


def window_series(spark, sf_dir):
    """Some values of each window's series."""
    w = Q.window_series(X.zoned(spark, sf_dir))
    at = lambda c, k, d=8: F.round(F.element_at(c, k), d).alias(f"{c}_{k}")
    return w.select("region", "start_idx", at("magnitude", 64), at("log_dt", 1), at("log_dt", 2), at("depth", 5), at("log_energy", 3), at("cum_energy_frac", 32), at("dist_km", 1, 5))


WINDOW_SERIES_SQL = f"""WITH {ZONED_SQL}, p AS (SELECT *, row_number() OVER (PARTITION BY region ORDER BY time, event_id) - 1 AS idx, count(*) OVER (PARTITION BY region) AS total, pow(10.0, 1.5*magnitude + 4.8) AS e, (epoch_us(time) - epoch_us(lag(time) OVER (PARTITION BY region ORDER BY time, event_id))) / 86400e6 AS gap FROM zoned),
w AS (SELECT DISTINCT region, idx AS start_idx FROM p WHERE idx % 8 = 0 AND idx + 64 <= total AND total >= 128),
j AS (SELECT w.region, start_idx, idx - start_idx + 1 AS k, time, magnitude, e, depth, lat, lon, CASE WHEN idx > start_idx THEN gap END AS gap FROM w JOIN p ON p.region = w.region AND idx BETWEEN start_idx AND start_idx + 63),
c AS (SELECT region, start_idx, avg(lat) AS clat, avg(lon) AS clon, median(gap) AS med, sum(e) AS whole, sum(e) FILTER (k <= 32) AS half FROM j GROUP BY ALL)
SELECT region, start_idx, max(magnitude) FILTER (k = 64) AS magnitude_64, round(log10(greatest(any_value(med), 1e-4)), 8) AS log_dt_1, round(log10(greatest(max(gap) FILTER (k = 2), 1e-4)), 8) AS log_dt_2, max(depth) FILTER (k = 5) AS depth_5,
round(log10(max(e) FILTER (k = 3)), 8) AS log_energy_3, round(any_value(half) / any_value(whole), 8) AS cum_energy_frac_32, round(max({_HAVERSINE.format(a='lat', b='clat', c='lon', d='clon')}) FILTER (k = 1), 5) AS dist_km_1 FROM j JOIN c USING (region, start_idx) GROUP BY region, start_idx"""


def event_gaps(spark, sf_dir):
    """Whole days between consecutive strong events of each zone: n, median, least and most."""
    strong = Q.numbered(X.zoned(spark, sf_dir).where(F.col("magnitude") >= 3.5))
    nxt = strong.select("region", (F.col("idx") + 1).alias("idx"), F.col("time").alias("before"))
    gaps = strong.join(nxt, ["region", "idx"]).select("region", F.floor(C.days_between(F.col("before"), F.col("time"))).alias("gap"))
    gaps = materialize(gaps, "gaps")
    middle = E.quantiles(gaps, "gap", [0.5], ("region",)).select("region", F.col("edges")[0].alias("median_gap"))
    return gaps.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.min("gap").alias("min_gap"), F.max("gap").alias("max_gap")).join(middle, "region").select("region", "n", "median_gap", "min_gap", "max_gap")


EVENT_GAPS_SQL = f"""WITH {ZONED_SQL}, g AS (SELECT region, floor((epoch_us(time) - epoch_us(lag(time) OVER (PARTITION BY region ORDER BY time, event_id))) / 86400e6) AS gap FROM zoned WHERE magnitude >= 3.5)
SELECT region, count(*) AS n, median(gap) AS median_gap, CAST(min(gap) AS BIGINT) AS min_gap, CAST(max(gap) AS BIGINT) AS max_gap FROM g WHERE gap IS NOT NULL GROUP BY region"""


def decluster(spark, sf_dir):
    """Main shocks of all events of each zone."""
    return D.decluster(X.zoned(spark, sf_dir)).select("region", "event_id", "is_main")


_NEAR = _HAVERSINE.format(a="m.lat", b="x[1].lat", c="m.lon", d="x[1].lon")
DECLUSTER_SQL = f"""WITH {ZONED_SQL}, o AS (SELECT region, list({{'t': epoch_us(time), 'lat': lat, 'lon': lon, 'm': magnitude, 'id': event_id}} ORDER BY magnitude DESC, time, event_id) AS e FROM zoned GROUP BY region),
r AS (SELECT region, list_reduce(list_transform(e, lambda x: [x]), lambda acc, x: CASE WHEN len(list_filter(acc, lambda m: abs(x[1].t - m.t) / 86400e6 <= CASE WHEN m.m >= 6.5 THEN pow(10, 0.032 * m.m + 2.7389) ELSE pow(10, 0.5409 * m.m - 0.547) END AND {_NEAR} <= pow(10, 0.1238 * m.m + 0.983))) = 0 THEN acc || x ELSE acc END) AS mains FROM o),
u AS (SELECT region, unnest(list_transform(mains, lambda m: m.id)) AS event_id FROM r)
SELECT zoned.region, zoned.event_id, u.event_id IS NOT NULL AS is_main FROM zoned LEFT JOIN u ON u.region = zoned.region AND u.event_id = zoned.event_id"""


QUERIES = {
    "forecast_windows": (forecast_windows, FORECAST_WINDOWS_SQL),
    "next_magnitude": (next_magnitude, NEXT_MAGNITUDE_SQL),
    "forecast_split": (forecast_split, FORECAST_SPLIT_SQL),
    "forecast_blocks": (forecast_blocks, FORECAST_BLOCKS_SQL),
    "tercile_windows": (tercile_windows, TERCILE_WINDOWS_SQL),
    "tercile_split": (tercile_split, TERCILE_SPLIT_SQL),
    "tercile_one_out": (tercile_one_out, TERCILE_ONE_OUT_SQL),
    "zone_events": (zone_events, ZONE_EVENTS_SQL),
    "radius_events": (radius_events, RADIUS_EVENTS_SQL),
    "catalog_normalize": (catalog_normalize, CATALOG_NORMALIZE_SQL),
    "event_lookup": (event_lookup, EVENT_LOOKUP_SQL),
    "station_fallback": (station_fallback, STATION_FALLBACK_SQL),
    "window_series": (window_series, WINDOW_SERIES_SQL),
    "event_gaps": (event_gaps, EVENT_GAPS_SQL),
    "decluster": (decluster, DECLUSTER_SQL),
}
