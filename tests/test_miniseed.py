"""MiniSEED: ranges of a file, pushed filters, and traces written and read back."""

import io
import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, In, IsNotNull, LessThan

from quakeframe.sources import miniseed, miniseed_sink

T0 = datetime(2024, 2, 28, 23, 59, 58, 123456)
FIELDS = "network string, station string, location string, channel string, starttime timestamp_ntz, sampling_rate double, samples array<double>"


def traces(n=6, size=3000):
    rng = np.random.default_rng(1)
    out = []
    for k in range(n):
        x = np.cumsum(rng.integers(-(4**k), 4**k + 1, size)).astype(float) if k < 5 else rng.normal(size=size)
        out.append(("KO", f"S{k}", "", ("HHZ", "HHN", "HHE")[k % 3], T0 + timedelta(seconds=100 * k), 100.0, x.tolist()))
    return out


def written(rows, **options):
    return b"".join(r for row in rows for r in miniseed_sink.coded(list(row[:4]), *row[4:], **options))


@pytest.mark.parametrize("kind", ["steim1", "steim2", "int32", "float64", "auto"])
@pytest.mark.parametrize("length", [128, 512, 4096])
def test_every_coding_comes_back(kind, length):
    rng = np.random.default_rng(2)
    cases = [[5.0], [0.0] * 400, rng.integers(-3, 4, 1000), rng.integers(-2000, 2000, 777), np.cumsum(rng.integers(-(1 << 20), 1 << 20, 500)), [2.0**28, -(2.0**28), 7.0], np.where(np.arange(300) % 17 == 0, 30_000, np.arange(300) % 3)]
    for x in cases:
        got = list(miniseed.records(written([("N", "STA", "00", "HHZ", T0, 50.0, list(map(float, x)))], encoding=kind, record_bytes=length)))
        assert [v for r in got for v in r[7]] == list(map(float, x))
        assert [r[4] for r in got] == [T0 + timedelta(microseconds=round(sum(len(r[7]) for r in got[:k]) / 50 * 1e6)) for k in range(len(got))]
        assert {r[:4] for r in got} == {("N", "STA", "00", "HHZ")} and {r[5] for r in got} == {50.0}


def test_codings_that_do_not_fit():
    wide = [0.0, 2.0**30, -(2.0**30)]
    with pytest.raises(ValueError):
        written([("N", "S", "", "Z", T0, 1.0, wide)], encoding="steim2")
    assert [v for r in miniseed.records(written([("N", "S", "", "Z", T0, 1.0, wide)])) for v in r[7]] == wide  # as integers
    odd = [0.5, -1e300, 3.0]
    assert [v for r in miniseed.records(written([("N", "S", "", "Z", T0, 1.0, odd)])) for v in r[7]] == odd
    for rate in (0.1, 12.5, 99.99, 31.25, 1000.0):
        a, b = miniseed_sink.rate_fields(rate)
        assert (a if a > 0 else -1 / a) * (b if b > 0 else -1 / b) == pytest.approx(rate, rel=1e-9)
    with pytest.raises(ValueError):
        miniseed_sink.rate_fields(0.0)


class Counted(io.BytesIO):
    taken = 0

    def read(self, n=-1):
        got = super().read(n)
        self.taken += len(got)
        return got


@pytest.mark.parametrize("length", [256, 4096])
def test_ranges_share_out_every_record_once(length):
    data = written(traces(), record_bytes=length)
    whole = list(miniseed.records(data))
    for step in (100, 1000, length, 3 * length + 7, 50_000):
        got = []
        for a in range(0, len(data), step):
            got += miniseed.records(io.BytesIO(data), start=a, end=min(a + step, len(data)), size=len(data))
        assert got == whole


def test_a_header_among_samples_is_not_taken_for_one():
    """Samples that spell a header are followed by no other header."""
    false = written([("XX", "FAKE", "", "HHZ", T0, 100.0, [1.0])])[:64]
    spelled = np.frombuffer(false * 20, ">f8").tolist()
    data = written([("N", "S", "", "HHZ", T0, 100.0, spelled)], encoding="float64", record_bytes=1024) + written(traces(2))
    whole = list(miniseed.records(data))
    for a in (64, 128, 300, 1024, 1100):
        got = list(miniseed.records(io.BytesIO(data), start=a, end=len(data), size=len(data)))
        assert {r[1] for r in got} <= {"S", "S0", "S1"} and got == whole[-len(got) :]


def test_one_large_file_gives_several_tasks_and_headers_alone_are_few_bytes(spark, tmp_path):
    rows = traces(6, 60_000)
    data = written(rows)
    (tmp_path / "day.mseed").write_bytes(data)
    spark.dataSource.register(miniseed.MiniSeedSource)
    df = spark.read.format("miniseed").option("split_bytes", "100000").load(str(tmp_path))
    assert df.rdd.getNumPartitions() == math.ceil(len(data) / 100_000) > 5
    got = {}
    for r in df.orderBy("station", "starttime").collect():
        got.setdefault(r.station, []).extend(r.samples)
    assert got == {r[1]: r[6] for r in rows}
    reader = miniseed.MiniSeedReader({"path": str(tmp_path), "headers_only": "true", "split_bytes": "200000"})
    counted = []
    reader.opened = lambda path: counted.append(Counted(data)) or counted[-1]
    heads = [r for p in reader.partitions() for r in reader.read(p)]
    assert sum(r[7] for r in heads) == 6 * 60_000 and all(r[8] is None for r in heads)
    assert sum(c.taken for c in counted) < 0.1 * len(data)


def test_filters_reach_the_headers(spark, tmp_path):
    rows = traces(6, 20_000)
    data = written(rows)
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.mseed").write_bytes(data)
    reader = miniseed.FilteringReader({"path": str(tmp_path)})
    asked = [EqualTo(("station",), "S2"), In(("channel",), ("HHE", "HHZ")), GreaterThanOrEqual(("starttime",), T0), LessThan(("starttime",), T0 + timedelta(seconds=290)), IsNotNull(("station",)), EqualTo(("npts",), 5)]
    assert list(reader.pushFilters(asked)) == asked[-1:]
    counted = []
    reader.opened = lambda path: counted.append(Counted(data)) or counted[-1]
    some = [r for p in reader.partitions() for r in reader.read(p)]
    assert {r[2] for r in some} == {"S2"} and all(r[5] < T0 + timedelta(seconds=290) for r in some)
    assert sum(c.taken for c in counted) < 0.3 * len(data)
    df = miniseed.scan(spark, str(tmp_path)).where((F.col("station") == "S2") & (F.col("starttime") < F.lit(T0 + timedelta(seconds=290))) & F.col("channel").isin("HHE", "HHZ"))
    assert sorted((r.starttime, r.samples) for r in df.collect()) == sorted((r[5], r[8]) for r in some)
    assert spark.conf.get("spark.sql.python.filterPushdown.enabled") == "true" and " Filter " not in df._jdf.queryExecution().executedPlan().toString()
    plain = spark.read.format("miniseed").load(str(tmp_path)).where("station = 'S2' and channel = 'HHE'")  # without the option Spark filters
    assert " Filter " in plain._jdf.queryExecution().executedPlan().toString() and {r.station for r in plain.collect()} == {"S2"}


def test_written_traces_are_read_back_equal(spark, tmp_path):
    spark.dataSource.register(miniseed.MiniSeedSource)
    df = spark.createDataFrame([*traces(), ("N", "NONE", "", "Z", T0, 1.0, None), ("N", "EMPTY", "", "Z", T0, 1.0, [])], FIELDS).repartition(4)
    path = str(tmp_path / "out")
    as_rows = lambda: df.withColumns({"file_path": F.lit(""), "npts": F.lit(0)}).select(*miniseed.COLUMNS)
    as_rows().write.format("miniseed").mode("append").save(path)
    for r in miniseed.traces(miniseed.read(spark, path)).collect():
        want = next(t for t in traces() if t[1] == r.station)
        assert (r.samples, r.starttime, r.sampling_rate, r.gap_mask.count(True)) == (want[6], want[4], 100.0, 0)
    assert {r.station for r in miniseed.read(spark, path).select("station").distinct().collect()} == {f"S{k}" for k in range(6)}
    n = len(list((tmp_path / "out").iterdir()))
    as_rows().where("station = 'S1'").write.format("miniseed").mode("overwrite").option("record_bytes", "512").save(path)
    left = list((tmp_path / "out").iterdir())
    assert len(left) == 1 < n and left[0].stat().st_size % 512 == 0 and not any(p.name.startswith("_") for p in left)


def test_local_paths_in_every_form(tmp_path):
    want = str(tmp_path / "x")
    assert {miniseed.file_system(p)[1] for p in (want, f"file:{want}", f"file://{want}")} == {want}


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    spark.dataSource.register(miniseed.MiniSeedSource)
    rows = [*traces(3, 200), ("N", "BAD", "", "Z", T0, 0.0, [1.0])]  # no sampling rate
    df = spark.createDataFrame(rows, FIELDS).repartition(4).withColumns({"file_path": F.lit(""), "npts": F.lit(0)}).select(*miniseed.COLUMNS)
    with pytest.raises(Exception, match="division by zero"):
        df.write.format("miniseed").mode("append").save(str(tmp_path / "out"))
    assert not (tmp_path / "out").exists() or list((tmp_path / "out").iterdir()) == []
