"""The driver's tables as catalogs, stations, traces and window metadata; the same formulas in Spark and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quakeframe.sources.catalog import ZONES, by_zone

THRESHOLD = 4.0
HORIZON_DAYS = 1.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("double")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").alias("time"),
        (F.lit(34) + (F.col("event_id") * 7 % 80).cast("double") / 10).alias("lat"),
        (F.lit(25) + (F.col("event_id") * 13 % 170).cast("double") / 10).alias("lon"),
        k.alias("depth"),
        F.round(2 + F.col("value") / F.lit(115.13), 1).alias("magnitude"),
        "event_type",
        "user_id",
        "value",
    )


CATALOG_SQL = """catalog AS (
  SELECT event_id, ts AS time, 34 + CAST((event_id*7) % 80 AS DOUBLE)/10 AS lat, 25 + CAST((event_id*13) % 170 AS DOUBLE)/10 AS lon,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS depth, round(2 + value/CAST(115.13 AS DOUBLE), 1) AS magnitude, event_type, user_id, value
  FROM events)"""


def zoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_zone(catalog(spark, sf_dir)).select("region", "time", "magnitude", "event_id", "lat", "lon", "depth")


_BOXES = ", ".join(f"('{n}', {b[0]}, {b[1]}, {b[2]}, {b[3]})" for n, b in ZONES.items())
ZONED_SQL = f"""{CATALOG_SQL}, zones(region, la0, la1, lo0, lo1) AS (VALUES {_BOXES}),
zoned AS (SELECT region, time, magnitude, event_id, lat, lon, depth FROM catalog JOIN zones ON lat BETWEEN la0 AND la1 AND lon BETWEEN lo0 AND lo1)"""


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window metadata: station, file, class and number of windows."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("station"), F.col("l_orderkey").alias("file"), F.col("l_linenumber").alias("part"), F.col("l_partkey").alias("item"), F.col("l_returnflag").alias("cls"), F.col("l_quantity").cast("long").alias("n_windows")
    )


ENTRIES_SQL = "entries AS (SELECT l_suppkey AS station, l_orderkey AS file, l_linenumber AS part, l_partkey AS item, l_returnflag AS cls, CAST(l_quantity AS BIGINT) AS n_windows FROM lineitem)"


def traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("trace"), F.col("embedding").cast("array<double>").alias("samples"))


TRACES_SQL = "traces AS (SELECT vec_id AS trace, CAST(embedding AS DOUBLE[]) AS samples FROM embeddings)"
