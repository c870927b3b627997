"""Instrument responses from StationXML, as the table that groundmotion takes: a row a channel epoch.

Spark's own XML reader cuts files by Network elements; nothing is parsed in Python. The analogue and digital stages with poles
and zeros are joined into one set in radians a second, with the product of their normalisation factors; of other stages (decimation,
filters of coefficients) the gain counts alone. A station under several networks has its rows under each.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_NUMBER = "struct<Real:double,Imaginary:double>"
_POLES = f"struct<InputUnits:struct<Name:string>,PzTransferFunctionType:string,NormalizationFactor:double,NormalizationFrequency:double,Zero:array<{_NUMBER}>,Pole:array<{_NUMBER}>>"
_STAGE = f"struct<_number:int,PolesZeros:{_POLES},StageGain:struct<Value:double,Frequency:double>>"
_RESPONSE = f"struct<InstrumentSensitivity:struct<Value:double,Frequency:double,InputUnits:struct<Name:string>>,Stage:array<{_STAGE}>>"
_CHANNEL = f"struct<_code:string,_locationCode:string,_startDate:string,_endDate:string,SampleRate:double,Response:{_RESPONSE}>"
SCHEMA = f"_code string, Station array<struct<_code:string,Latitude:double,Longitude:double,Elevation:double,Channel:array<{_CHANNEL}>>>"
#: Transfer functions whose poles and zeros are in radians a second and in hertz.
RADIANS, HERTZ = "LAPLACE (RADIANS/SECOND)", "LAPLACE (HERTZ)"


def read(spark: SparkSession, path: str) -> DataFrame:
    """Networks of the StationXML files under path, as nested rows."""
    return spark.read.format("xml").option("rowTag", "Network").option("ignoreNamespace", "true").option("recursiveFileLookup", "true").schema(SCHEMA).load(path)


def stations(networks: DataFrame) -> DataFrame:
    """network, station, latitude, longitude, elevation: a row a station element."""
    s = networks.select(F.col("_code").alias("network"), F.explode("Station").alias("s"))
    return s.select("network", F.col("s._code").alias("station"), F.col("s.Latitude").alias("latitude"), F.col("s.Longitude").alias("longitude"), F.col("s.Elevation").alias("elevation"))


def _time(text: Column) -> Column:
    return F.try_to_timestamp(text).cast("timestamp_ntz")


def responses(networks: DataFrame) -> DataFrame:
    """network, station, location, channel, epoch_start, epoch_end, input_unit, sensitivity, stage_gains, poles, zeros, a0, norm_hz."""
    channels = networks.select(F.col("_code").alias("network"), F.explode("Station").alias("s")).select("network", F.col("s._code").alias("station"), F.explode("s.Channel").alias("c"))
    stages = F.array_sort(F.coalesce("c.Response.Stage", F.array().cast(f"array<{_STAGE}>")), lambda a, b: F.coalesce(a["_number"], F.lit(0)) - F.coalesce(b["_number"], F.lit(0)))
    analogue = F.filter("stages", lambda s: s["PolesZeros"]["PzTransferFunctionType"].isin(RADIANS, HERTZ))
    rows = channels.withColumn("stages", stages).withColumn("shaped", analogue)
    turn = lambda s: F.when(s["PolesZeros"]["PzTransferFunctionType"] == HERTZ, 2 * math.pi).otherwise(1.0)
    none = F.array().cast(f"array<{_NUMBER}>")
    points = lambda kind: F.flatten(F.transform("shaped", lambda s: F.transform(F.coalesce(s["PolesZeros"][kind], none), lambda z: F.struct((z["Real"] * turn(s)).alias("re"), (z["Imaginary"] * turn(s)).alias("im")))))
    size = lambda s, kind: F.size(F.coalesce(s["PolesZeros"][kind], none))
    factor = lambda s: F.coalesce(s["PolesZeros"]["NormalizationFactor"], F.lit(1.0)) * F.pow(turn(s), (size(s, "Pole") - size(s, "Zero")).cast("double"))
    unit = F.coalesce(F.get("shaped", F.lit(0))["PolesZeros"]["InputUnits"]["Name"], F.col("c.Response.InstrumentSensitivity.InputUnits.Name"))
    return rows.select(
        "network",
        "station",
        F.coalesce("c._locationCode", F.lit("")).alias("location"),
        F.col("c._code").alias("channel"),
        _time(F.col("c._startDate")).alias("epoch_start"),
        _time(F.col("c._endDate")).alias("epoch_end"),
        F.upper(unit).alias("input_unit"),
        F.col("c.Response.InstrumentSensitivity.Value").alias("sensitivity"),
        F.transform("stages", lambda s: s["StageGain"]["Value"]).alias("stage_gains"),
        points("Pole").alias("poles"),
        points("Zero").alias("zeros"),
        F.aggregate("shaped", F.lit(1.0), lambda a, s: a * factor(s)).alias("a0"),
        F.get("shaped", F.lit(0))["PolesZeros"]["NormalizationFrequency"].alias("norm_hz"),
    )
