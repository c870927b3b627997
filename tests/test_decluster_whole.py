"""Declustering of whole catalogs."""

from datetime import datetime, timedelta

import pytest

from quakeframe.operators import decluster
from quakeframe.plans import catalog_queries

CATALOG = "region string, time timestamp_ntz, magnitude double, event_id long, lat double, lon double"


def test_query_takes_every_zoned_event(spark):
    sf = "/root/testdata/sf0.001"
    got = catalog_queries.decluster(spark, sf)
    assert got.count() == catalog_queries.X.zoned(spark, sf).count()


def test_chains_of_claims_may_be_deep_and_cross_the_date_line(spark):
    """Each event claims only the next one, so they are settled one a round and every other one is main."""
    day = 10 ** (0.5409 * 2.0 - 0.547) * 0.9
    rows = [("a", datetime(2020, 1, 1) + timedelta(days=day * k), 2.0, k, -60.0, 179.99 if k % 2 else -179.99) for k in range(8)]
    got = {r.event_id: r.is_main for r in decluster.decluster(spark.createDataFrame(rows, CATALOG)).collect()}
    assert got == {k: k % 2 == 0 for k in range(8)}


def test_unsettled_events_are_an_error(spark, monkeypatch):
    """Claims in a ring cannot be settled and must not pass as main shocks."""
    ring = spark.createDataFrame([("a", 1, 2), ("a", 2, 1)], "region string, claimer long, claimed long")
    monkeypatch.setattr(decluster, "claims", lambda events, by="region": ring)
    rows = [("a", datetime(2020, 1, k), 2.0, k, 0.0, 0.0) for k in (1, 2)]
    with pytest.raises(RuntimeError, match="settled none"):
        decluster.decluster(spark.createDataFrame(rows, CATALOG)).collect()


def test_pairs_of_a_dense_catalog_grow_with_its_size(spark, monkeypatch):
    """Events of one magnitude that all claim each other are cut into levels, so their pairs are no square."""
    monkeypatch.setattr(decluster, "LEAST_PAIRS", 1000, raising=False)
    met = []
    monkeypatch.setattr(decluster, "claims", lambda *a, own=decluster.claims, **k: met.append(own(*a, **k)) or met[-1])
    rows = [("a", datetime(2020, 1, 1) + timedelta(minutes=k), 2.0, k, 38.0, 30.0) for k in range(400)]
    got = {r.event_id: r.is_main for r in decluster.decluster(spark.createDataFrame(rows, CATALOG)).collect()}
    assert got == {k: k == 0 for k in range(400)}
    assert sum(d.count() for d in met) <= 4 * len(rows)


def test_levels_of_any_size_give_the_same_main_shocks(spark, monkeypatch):
    rows = [("ab"[k % 2], datetime(2024, 1, 1) + timedelta(hours=k * 37 % 900), 2.0 + k * 7 % 13 / 5, k, 38 + k * 29 % 40 / 40, 30 + k * 17 % 60 / 40) for k in range(160)] + [("a", datetime(2024, 1, 5), None, 900, 38.0, 30.0), ("a", datetime(2024, 1, 5), 4.4, 901, None, 30.0)]
    df = spark.createDataFrame(rows, CATALOG)
    whole = {r.event_id: r.is_main for r in decluster.decluster(df).collect()}
    monkeypatch.setattr(decluster, "FIRST_EVENTS", 30, raising=False)
    monkeypatch.setattr(decluster, "GROWTH", 2, raising=False)
    assert {r.event_id: r.is_main for r in decluster.decluster(df).collect()} == whole and 2 < sum(whole.values()) < len(whole) / 2
