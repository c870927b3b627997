"""Responses from StationXML: epochs, gains, poles and zeros, and the ground motion they give."""

import math
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from quakeframe.operators import groundmotion
from quakeframe.sources import stationxml

POINT = '<{k} number="{n}"><Real plusError="0.1">{re}</Real><Imaginary>{im}</Imaginary></{k}>'


def stage(number, gain, poles=(), zeros=(), kind=stationxml.RADIANS, a0=1.0):
    shape = ""
    if poles or zeros:
        points = "".join(POINT.format(k=k, n=n, re=z.real, im=z.imag) for k, own in (("Zero", zeros), ("Pole", poles)) for n, z in enumerate(own))
        shape = f"<PolesZeros><InputUnits><Name>m/s</Name></InputUnits><PzTransferFunctionType>{kind}</PzTransferFunctionType><NormalizationFactor>{a0}</NormalizationFactor><NormalizationFrequency>1.0</NormalizationFrequency>{points}</PolesZeros>"
    own = "" if gain is None else f"<StageGain><Value>{gain}</Value><Frequency>1.0</Frequency></StageGain>"
    return f'<Stage number="{number}">{shape}{own}</Stage>'


def channel(code, start, end, stages, sensitivity=6e8):
    last = f' endDate="{end}"' if end else ""
    value = f"<InstrumentSensitivity><Value>{sensitivity}</Value><Frequency>1.0</Frequency><InputUnits><Name>M/S</Name></InputUnits></InstrumentSensitivity>" if sensitivity else ""
    return f'<Channel code="{code}" locationCode="" startDate="{start}"{last}><SampleRate>100.0</SampleRate><Response>{value}{"".join(stages)}</Response></Channel>'


def station(code, channels):
    return f'<Station code="{code}"><Latitude>38.5</Latitude><Longitude>27.1</Longitude><Elevation>100.0</Elevation><Site><Name>x</Name></Site>{"".join(channels)}</Station>'


PAIR = [complex(-4.44, 4.44), complex(-4.44, -4.44)]


@pytest.fixture
def inventory(tmp_path):
    a = station("AAA", [channel("HHZ", "2020-01-01T00:00:00.0000", "2022-01-01T00:00:00", [stage(2, 4e5), stage(1, 1500.0, PAIR, [0j, 0j])]), channel("HHZ", "2022-01-01T00:00:00", None, [stage(1, 750.0, [p / 2 / math.pi for p in PAIR], [0j, 0j], stationxml.HERTZ, 2.0), stage(2, 4e5)], 3e8)])
    b = station("BBB", [channel("HNZ", "2020-01-01T00:00:00", None, [stage(1, None)], None)])
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "KO.xml").write_text(f'<?xml version="1.0"?><FDSNStationXML xmlns="http://www.fdsn.org/xml/station/1" schemaVersion="1.1"><Source>s</Source><Network code="KO">{a}{b}</Network><Network code="TU">{station("CCC", [])}</Network></FDSNStationXML>')
    return str(tmp_path / "in")


def test_epochs_gains_and_shapes(spark, inventory):
    networks = stationxml.read(spark, inventory)
    assert {(r.network, r.station, r.latitude, r.elevation) for r in stationxml.stations(networks).collect()} == {("KO", "AAA", 38.5, 100.0), ("KO", "BBB", 38.5, 100.0), ("TU", "CCC", 38.5, 100.0)}
    got = {(r.station, r.epoch_start.year): r for r in stationxml.responses(networks).collect()}
    assert set(got) == {("AAA", 2020), ("AAA", 2022), ("BBB", 2020)}
    first, second, bare = got["AAA", 2020], got["AAA", 2022], got["BBB", 2020]
    assert (first.input_unit, first.sensitivity, first.stage_gains, first.epoch_end, first.a0, first.norm_hz) == ("M/S", 6e8, [1500.0, 4e5], datetime(2022, 1, 1), 1.0, 1.0)
    assert [(p.re, p.im) for p in first.poles] == [(-4.44, 4.44), (-4.44, -4.44)] and len(first.zeros) == 2 and second.epoch_end is None
    assert [p.re for p in second.poles] == pytest.approx([-4.44, -4.44]) and second.a0 == pytest.approx(2.0)  # as many poles as zeros
    assert (bare.sensitivity, bare.stage_gains, bare.poles, bare.input_unit) == (None, [None], [], None)
    quality = {r.station: r.sens_mismatch for r in groundmotion.response_quality(stationxml.responses(networks), ["station"]).collect()}
    assert quality["AAA"] == pytest.approx(0.0) and quality["BBB"] is None


def test_ground_motion_by_the_epoch_of_the_file(spark, inventory):
    rng = np.random.default_rng(1)
    x = (rng.normal(size=400) * 1000).tolist()
    rows = [("KO", s, c, t, 100.0, x) for s, c, t in (("AAA", "HHZ", "2021-05-01 00:00:00"), ("AAA", "HHZ", "2023-05-01 00:00:00"), ("BBB", "HNZ", "2023-05-01 00:00:00"))]
    traces = spark.createDataFrame(rows, "network string, station string, channel string, starttime string, sampling_rate double, samples array<double>").withColumn("starttime", F.col("starttime").cast("timestamp_ntz"))
    got = {(r.station, r.starttime.year): r for r in groundmotion.without_response(traces, stationxml.responses(stationxml.read(spark, inventory)), corners=(0.5, 1.0, 20.0, 30.0)).collect()}
    assert {k: r.response_ok for k, r in got.items()} == {("AAA", 2021): True, ("AAA", 2023): True, ("BBB", 2023): False}
    # half the gain, twice the normalisation: the same instrument
    assert np.allclose(got["AAA", 2021].vel, got["AAA", 2023].vel, rtol=1e-9)
