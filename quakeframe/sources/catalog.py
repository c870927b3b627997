"""Event catalogs and station tables: header aliases, coercion and filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quakeframe.functions.columns import haversine_km
from quakeframe.operators.evaluate import quantiles

#: Header names by column, in the order in which they are looked for, fixed values. date and clock are a pair that is joined.
ALIASES = {
    "time": ("datetime", "date_time", "origin_time", "time", "tarih", "olus zamani", "oluş zamanı", "date", "tarih_saat"),
    "date": ("date", "tarih"),
    "clock": ("time", "saat"),
    "lat": ("latitude", "lat", "enlem"),
    "lon": ("longitude", "lon", "long", "boylam"),
    "depth": ("depth", "derinlik", "depth_km"),
    "magnitude": ("magnitude", "mag", "ml", "mw", "buyukluk", "büyüklük"),
    "event_id": ("eventid", "event_id", "id"),
}
#: Time formats tried in this order, day first.
TIME_FORMATS = ("dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy HH:mm", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "dd.MM.yyyy HH:mm:ss", "dd/MM/yyyy", "yyyy-MM-dd")
#: Fault zones: least and largest latitude, least and largest longitude, fixed values. They overlap.
ZONES = {"NAFZ": (39.5, 42.0, 26.0, 42.0), "EAFZ": (36.5, 39.5, 35.0, 42.0), "AEGEAN": (36.0, 40.0, 25.0, 30.0), "CENTRAL": (34.0, 37.5, 28.0, 36.0)}
#: Magnitude types that count, fixed values.
MAGNITUDE_TYPES = ("ML", "MW", "MS", "Mb", "MD", "mw", "ml", "ms", "mb", "md")


def header(columns: list[str], name: str, aliases: dict[str, tuple[str, ...]] | None = None) -> str | None:
    """The column whose stripped, lower-cased header is the first alias of name that there is."""
    seen = {}
    for c in columns:
        seen.setdefault(c.strip().lower(), c)
    return next((seen[a] for a in (aliases or ALIASES)[name] if a in seen), None)


def parse_time(text: Column) -> Column:
    """Timestamp without zone from the first format that fits, else null."""
    return F.coalesce(*(F.try_to_timestamp(text, F.lit(f)) for f in TIME_FORMATS)).cast("timestamp_ntz")


def normalize(raw: DataFrame, least_magnitude: float | None = None) -> DataFrame:
    """time, lat, lon, depth, magnitude, event_id from a raw catalog of any known header.

    A date and a time of day in two columns are joined, else the first time header counts. Rows without a time or a finite magnitude go; a null depth becomes the median
    of the rest, else 10 km.
    """
    at = {k: header(raw.columns, k) for k in ALIASES}
    if not at["time"] or not at["magnitude"]:
        raise ValueError(f"no time or magnitude column in {raw.columns}")
    trimmed = lambda name: F.trim(F.col(f"`{at[name]}`").cast("string"))
    text = F.concat(trimmed("date"), F.lit(" "), trimmed("clock")) if at["date"] and at["clock"] else trimmed("time")

    def number(name: str) -> Column:
        return F.expr(f"try_cast(trim(cast(`{at[name]}` as string)) as double)") if at[name] else F.lit(None).cast("double")

    rows = raw.select(
        parse_time(text).alias("time"), *(number(k).alias(k) for k in ("lat", "lon", "depth", "magnitude")), (F.col(f"`{at['event_id']}`").cast("string") if at["event_id"] else F.lit(None).cast("string")).alias("event_id")
    )
    finite = ~F.isnan("magnitude") & (F.abs("magnitude") < float("inf"))
    rows = rows.where(F.col("time").isNotNull() & F.col("magnitude").isNotNull() & finite)
    if least_magnitude is not None:
        rows = rows.where(F.col("magnitude") >= least_magnitude)
    return fill_depth(rows)


def fill_depth(rows: DataFrame) -> DataFrame:
    usual = quantiles(rows, "depth", [0.5]).agg(F.coalesce(F.max(F.element_at("edges", 1)), F.lit(10.0)).alias("__depth"))  # one row
    return rows.crossJoin(F.broadcast(usual)).withColumn("depth", F.coalesce("depth", "__depth")).drop("__depth")


def read_csv(spark, path: str, least_magnitude: float | None = None) -> DataFrame:
    """A catalog CSV, all columns read as strings."""
    return normalize(spark.read.csv(path, header=True), least_magnitude)


def in_box(lat: Column, lon: Column, box: tuple[float, float, float, float]) -> Column:
    """Both ends belong to the box; null coordinates don't."""
    return F.coalesce(lat.between(box[0], box[1]) & lon.between(box[2], box[3]), F.lit(False))


def in_radius(lat: Column, lon: Column, centre: tuple[float, float], km: float) -> Column:
    return F.coalesce(haversine_km(lat, lon, F.lit(centre[0]), F.lit(centre[1])) <= km, F.lit(False))


def by_zone(events: DataFrame, zones: dict[str, tuple[float, float, float, float]] = ZONES) -> DataFrame:
    """events with region, once for each zone that holds the event."""
    held = F.array_compact(F.array(*(F.when(in_box(F.col("lat"), F.col("lon"), box), F.lit(name)) for name, box in zones.items())))
    return events.withColumn("region", F.explode(held))


def of_magnitude_type(events: DataFrame, column: str = "Type", types: tuple[str, ...] = MAGNITUDE_TYPES) -> DataFrame:
    """Events on one of the magnitude scales; all of them where the table has no such column."""
    return events.where(F.col(column).isin(*types)) if column in events.columns else events


#: Headers of an event table for look-ups, fixed values.
LOOKUP = {"event_id": ("eventid", "event_id", "id"), "magnitude": ("magnitude", "mag", "ml", "m"), "lat": ("latitude", "lat"), "lon": ("longitude", "lon", "long")}


def event_table(raw: DataFrame, order: str) -> DataFrame:
    """event_id, magnitude, lat, lon from a raw table of any known header: the last by order of each id with a finite magnitude.

    order numbers the rows from 0; without an id column, ids are idx_ and that number.
    """
    at = {k: header(raw.columns, k, LOOKUP) for k in LOOKUP}
    if not at["magnitude"]:
        raise ValueError(f"no magnitude column in {raw.columns}")
    number = lambda k: F.expr(f"try_cast(trim(cast(`{at[k]}` as string)) as double)") if at[k] else F.lit(None).cast("double")
    key = F.trim(F.col(f"`{at['event_id']}`").cast("string")) if at["event_id"] else F.concat(F.lit("idx_"), F.col(order).cast("string"))
    return last_by_id(raw.select(key.alias("event_id"), *(number(k).alias(k) for k in ("magnitude", "lat", "lon")), F.col(order).alias("__order")), "__order").drop("__order")


def last_by_id(events: DataFrame, order: str) -> DataFrame:
    """One row an event_id: the last by order among those with a finite magnitude."""
    valid = events.where(F.col("magnitude").isNotNull() & ~F.isnan("magnitude") & (F.abs("magnitude") < float("inf")))
    rest = [c for c in valid.columns if c != "event_id"]
    return valid.groupBy("event_id").agg(F.max_by(F.struct(*rest), F.col(order)).alias("r")).select("event_id", "r.*")


def station_keys(stations: DataFrame, order: str, last: bool = False) -> DataFrame:
    """key, latitude, longitude: one row for NET.STA, and one for the bare station, of the first network by order, or of the last."""
    full = stations.select(F.concat_ws(".", "network", "station").alias("key"), "latitude", "longitude", F.col(order).alias("o"))
    bare = stations.select(F.col("station").alias("key"), "latitude", "longitude", F.col(order).alias("o"))
    both = full.unionByName(bare).groupBy("key").agg((F.max_by if last else F.min_by)(F.struct("latitude", "longitude"), "o").alias("s"))
    return both.select("key", "s.*")


def with_station(df: DataFrame, keys: DataFrame, network: str = "network", station: str = "station") -> DataFrame:
    """Adds latitude and longitude of NET.STA, else of the bare station, else null."""
    full, bare = (keys.select(F.col("key").alias(f"__{n}"), F.col("latitude").alias(f"__{n}_lat"), F.col("longitude").alias(f"__{n}_lon")) for n in ("full", "bare"))
    joined = df.join(full, F.concat_ws(".", network, station) == F.col("__full"), "left").join(bare, F.col(station) == F.col("__bare"), "left")
    return joined.withColumns({"latitude": F.coalesce("__full_lat", "__bare_lat"), "longitude": F.coalesce("__full_lon", "__bare_lon")}).drop("__full", "__full_lat", "__full_lon", "__bare", "__bare_lat", "__bare_lon")


RAW_CATALOG = T.StructType([T.StructField(n, T.StringType()) for n in ("Date", "Longitude", "Latitude", "Depth", "Rms", "Type", "Magnitude", "Location", "EventID")])
