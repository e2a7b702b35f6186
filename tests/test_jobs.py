"""Whole jobs on hand-worked series."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from meterloom.operators import jobs
from meterloom.sources import sinks

T0 = datetime(2024, 1, 1)
SCHEMA = "device string, energy string, ts timestamp, value double, accumulated double, n int"


def at(minutes):
    return T0 + timedelta(minutes=minutes)


@pytest.fixture(scope="module")
def raw(spark):
    rows = []

    def add(device, minutes, value=None, counter=None):
        rows.append((device, "e", at(minutes), value, counter, len(rows)))

    for m, v in ((0, 1.0), (60, 5.0), (60, 2.0), (240, 4.0), (300, -1.0)):  # hourly, one instant twice
        add("instant", m, v)
    for m, c in ((0, 1.0), (60, 1.5), (180, 2.5), (240, 4.0)):
        add("counter", m, None, c)
    for i in range(60):  # half-hourly, one of them wild
        add("wild", 10 * i, 1000.0 if i == 31 else 1.0 + i % 3)
    for d, v in ((0, 3.0), (3, 9.0), (6, 3.0)):
        add("bill", 1440 * d, v)
    for d, c in ((0, 10.0), (2, 14.0), (4, 16.0)):
        add("slow counter", 1440 * d, None, c)
    add("mixed", 0, 1.0, 2.0)
    add("mixed", 30, 1.0, 3.0)
    add("one", 0, 1.0)
    add("none", 0)
    add("none", 30)
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def values(found, device):
    return {r.ts: r.value for r in found.clean.filter(F.col("device") == device).collect()}


def test_hourly_metering(raw):
    found = jobs.clean_metering(raw, ["device", "energy"], "ts", order=["n"], limit=3.0)
    assert list(values(found, "instant").values()).count(None) == 1
    assert values(found, "instant") == {at(0): 1.0, at(60): 2.0, at(120): 0.0, at(180): 0.0, at(240): 4.0, at(300): None}
    assert values(found, "counter") == {at(0): None, at(60): 0.5, at(120): 0.5, at(180): 0.5, at(240): 1.5}
    wild = values(found, "wild")
    assert len(wild) == 20 and [t for t, v in wild.items() if v is None] == [at(300)] and wild[at(0)] == 6.0
    record = {r.device: r for r in found.quality.collect()}
    assert {d: r.status for d, r in record.items()} == {
        "instant": "ok", "counter": "ok", "wild": "ok", "bill": "too slow", "slow counter": "too slow",
        "mixed": "counter and instant values", "one": "no interval", "none": "no data",
    }
    assert record["instant"].frequency == "1:00:00" and record["wild"].frequency == "0:10:00" and record["bill"].frequency == "3 days, 0:00:00"
    counts = lambda d: tuple(record[d][f"n_{k}"] for k in ("duplicated", "gap", "negative", "outlier"))
    assert counts("instant") == (1, 1, 1, 0) and counts("wild") == (0, 1, 0, 1) and counts("counter") == (0, 1, 0, 0)
    issues = {(r.device, r.issue, r.ts) for r in found.issues.collect()}
    assert ("instant", "duplicated", at(60)) in issues and ("wild", "outlier", at(300)) in issues and ("instant", "negative", at(300)) in issues


def test_daily_metering(raw):
    found = jobs.clean_metering(raw, ["device", "energy"], "ts", order=["n"], daily=True, limit=None)
    day = lambda n: T0 + timedelta(n)
    assert values(found, "bill") == {day(0): None, day(1): 3.0, day(2): 3.0, day(3): 3.0, day(4): 1.0, day(5): 1.0, day(6): 1.0}
    assert values(found, "slow counter") == {day(0): None, day(1): 2.0, day(2): 2.0, day(3): 1.0, day(4): 1.0}
    assert values(found, "instant") == {day(0): 6.0} and values(found, "counter") == {day(0): None}
    record = {r.device: (r.status, r.frequency) for r in found.quality.collect()}
    assert record["bill"] == ("ok", "D") and record["wild"] == ("ok", "T") and record["instant"] == ("ok", "H")


def test_a_run_replaces_its_series(spark, raw):
    folder = sinks.work_path(spark, "clean")
    keys = ["device", "energy"]
    run = lambda rows: jobs.store(spark, folder, jobs.clean_metering(rows, keys, "ts", order=["n"], limit=3.0), keys, ["energy"])
    run(raw.filter("device IN ('instant', 'wild')"))
    run(raw.filter("device = 'instant' AND ts < '2024-01-01 04:30:00'"))
    found = jobs.clean_metering(raw, keys, "ts", order=["n"], limit=3.0)
    rows = sinks.read_version(spark, f"{folder}/clean", found.clean.schema, ["energy"]).collect()
    assert sum(r.device == "wild" for r in rows) == 20 and sum(r.device == "instant" for r in rows) == 5
    record = sinks.read_version(spark, f"{folder}/quality", found.quality.schema, ["energy"]).collect()
    assert {r.device: r.n_negative for r in record} == {"instant": 0, "wild": 0}


def test_bills_and_weather(spark):
    d = lambda n: date(2024, 1, n)
    bills = spark.createDataFrame(
        [("a", d(1), d(3), 9.0, 1), ("a", d(3), d(4), 4.0, 2), ("a", d(8), d(9), -2.0, 3)], "device string, ini date, fin date, value double, bill_id int"
    )
    found = jobs.clean_billing(bills, ["device"])
    assert {r.day.day: r.value for r in found.clean.collect()} == {1: 3.0, 2: 3.0, 3: 2.0, 4: 2.0, 8: None, 9: None}
    (r,) = found.quality.collect()
    assert (r.n_days, r.n_overlap, r.n_gap, r.n_negative) == (6, 1, 1, 2)
    rows = [("s", at(0), -80.0, 1), ("s", at(60), 10.0, 2), ("s", at(120), 75.0, 3), ("s", at(60), 11.0, 4), ("s", at(180), None, 5)]
    weather = jobs.clean_station(spark.createDataFrame(rows, "station string, ts timestamp, temperature double, n int"), ["station"], "ts", "temperature", -70.0, 70.0, ["n"])
    assert {r.ts: r.temperature for r in weather.clean.collect()} == {at(0): None, at(60): 11.0, at(120): None, at(180): None}
    (r,) = weather.quality.collect()
    assert (r.n_rows, r.n_duplicated, r.n_below, r.n_above, r.n_gap) == (4, 1, 1, 1, 3)


def test_hourly_bands_are_smoothed_and_documented(spark):
    hours = 168 * 5
    rows = [("u", "e", T0 + timedelta(hours=h), float(h % 168) - (500.0 if h == 400 else 0.0), 10.0) for h in range(hours)]
    series = spark.createDataFrame(rows, "unit string, energy string, hour timestamp, value double, temperature double")
    out = jobs.baseline(series, jobs.HOUR)
    got = out.collect()
    assert {r.fold for r in got} == {1, 2, 3} and len(got) == 3 * 168
    assert all(r.p5 >= -10 for r in got) and not any(r.model not in ("constant", "none") for r in got)
    (doc,) = jobs.baseline_documents(out, "2024-02-05").collect()
    assert doc.hour == sorted(doc.hour) and len(doc.value) == len(doc.p95) == 3 * 168


def test_units_take_the_preferred_source_and_need_all_devices(spark):
    rows = [("d1", "e", 3600, at(0), 1.0, "A"), ("d1", "e", 3600, at(0), 5.0, "R"), ("d1", "e", 3600, at(60), 2.0, "A"), ("d2", "e", 3600, at(0), 10.0, "A"),
            ("d2", "g", 3600, at(60), 7.0, "A")]
    use = spark.createDataFrame(rows, "device string, energy string, step_s long, ts timestamp, value double, source string")
    bridge = spark.createDataFrame([("d1", "u", 2.0, "s"), ("d2", "u", 1.0, "s")], "device string, unit string, multiplier double, station string")
    weather = spark.createDataFrame([("s", at(0), 4.0), ("s", at(60), 5.0)], "station string, hour timestamp, temperature double")
    got = jobs.unit_series(use, bridge, weather, ["R", "A"]).collect()
    assert {(r.unit, r.energy, r.hour, r.value, r.temperature) for r in got} == {("u", "e", at(0), 20.0, 4.0), ("u", "g", at(60), 7.0, 5.0)}
