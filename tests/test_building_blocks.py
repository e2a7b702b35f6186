"""Two-level scans and percentiles against plain Python."""

import random
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterloom.functions import scalars as S
from meterloom.functions import stats
from meterloom.functions.ordered import Step, most_frequent, ordered_scan
from meterloom.functions.quantiles import exact_percentiles

KINDS = ["sum", "count", "max", "max_before", "last", "next_value", "prev", "next", "total"]


@pytest.fixture(scope="module")
def ragged(spark):
    rng = random.Random(3)
    rows = [(k, i, float(rng.randint(-9, 9)) if rng.random() > 0.3 else None) for k in "ab" for i in range(60)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k string, t int, v double")


def test_chunked_scan_equals_plain_window(ragged):
    steps = [Step(kind, kind, F.col("v")) for kind in KINDS if kind != "total"]
    plain = ordered_scan(ragged, ["k"], ["t"], steps).select("k", "t", *[s.out for s in steps])
    for width in (1, 7, 1000):
        parts = ordered_scan(ragged, ["k"], ["t"], steps, F.floor(F.col("t") / width))
        assert sorted(plain.collect(), key=str) == sorted(parts.select(plain.columns).collect(), key=str)


def test_total_step(ragged):
    out = ordered_scan(ragged, ["k"], ["t"], [Step("s", "total", F.col("v"))], F.floor(F.col("t") / 5))
    want = {r.k: r.s for r in ragged.groupBy("k").agg(F.sum("v").alias("s")).collect()}
    assert all(r.s == want[r.k] for r in out.collect())


def test_exact_percentiles_with_a_hot_key(spark):
    rng = random.Random(5)
    rows = [("hot", rng.choice([-3.5, 0.0, 1e-9, 2.0, 7.25, rng.gauss(0, 1e4)])) for _ in range(900)]
    rows += [("cold", float(i)) for i in range(1, 11)] + [("cold", None), ("one", 4.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {r.k: r for r in exact_percentiles(df, ["k"], "v", probs, [f"p{i}" for i in range(7)], "n").collect()}
    for k in ("hot", "cold", "one"):
        values = [v for kk, v in rows if kk == k and v is not None]
        want = np.percentile(values, [p * 100 for p in probs])
        assert np.allclose([got[k][f"p{i}"] for i in range(7)], want, rtol=1e-12)
    assert got["cold"].n == 11 and got["cold"].p2 == 3.25 and got["cold"].p3 == 5.5 and abs(got["cold"].p5 - 9.1) < 1e-12


def test_mode_takes_the_smallest_on_ties(spark):
    df = spark.createDataFrame([("a", 5), ("a", 3), ("a", 5), ("a", 3), ("a", 9)], "k string, v int")
    assert most_frequent(df, ["k"], "v", "m", "n").collect()[0][:] == ("a", 3, 2)


def test_units(spark):
    df = spark.createDataFrame([("Wh", 1500.0), ("MWh", 2.0), ("kWh", 3.0), ("WHTH", 10.0)], "u string, v double")
    assert [r[0] for r in df.select(S.to_kilo("u", "v")).collect()] == [1.5, 2000.0, 3.0, 0.01]
    out = df.select(S.convert_unit("v", "u", F.lit("m3")).alias("x")).collect()
    assert all(r.x is None for r in out)


def test_t_table_known_values():
    table = stats.t_table()
    assert abs(table[0] - 6.3138) < 1e-3 and abs(table[9] - 1.8125) < 1e-3 and abs(table[119] - 1.6577) < 1e-3


def test_sun_is_high_at_noon_and_down_at_midnight(spark):
    rows = [(datetime(2024, 6, 21, 12),), (datetime(2024, 6, 21, 0),)]
    alt, azi = S.sun_position("t", F.lit(41.6), F.lit(0.62))
    noon, night = spark.createDataFrame(rows, "t timestamp").select(alt.alias("a"), azi.alias("z")).collect()
    assert abs(noon.a - (90 - 41.6 + 23.44)) < 0.5 and abs(noon.z - 180) < 3
    assert night.a < 0


def test_direction_sectors(spark):
    df = spark.createDataFrame([(0.0,), (22.5,), (23.0,), (180.0,), (350.0,), (None,)], "d double")
    assert [r[0] for r in df.select(S.sector("d")).collect()] == ["N", "N", "NE", "S", "N", "NA"]


def test_dated_json(spark):
    df = spark.createDataFrame([('{"$date": 1700000000000}',), ("{}",), ('{"$date": "x"}',)], "j string")
    got = [r[0] for r in df.select(S.to_epoch(S.dated_json("j"))).collect()]
    assert got == [1700000000, None, None]
