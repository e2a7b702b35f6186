"""Hand-worked cases and brute-force comparisons."""

import math
import random
from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from meterloom.functions import scalars as S
from meterloom.operators import align, clean, compare, events, grid, loadfit, loadmodel, models, quality
from meterloom.sources import ingest, sinks

T0 = datetime(2024, 1, 1)


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def day(n):
    return date(2024, 1, n)


# --- resampling ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def three(spark):
    return spark.createDataFrame([("a", at(10), 1.0), ("a", at(125), 2.0), ("a", at(240), 4.0)], "k string, ts timestamp, v double")


def test_instant_readings_per_hour(three):
    out = grid.resample_sum(three, ["k"], S.bin_start("ts", 3600), "v", grid.STEPS[3600]).orderBy("bin")
    assert [r.v for r in out.collect()] == [1.0, 0.0, 2.0, 0.0, 4.0]
    null = grid.resample_sum(three, ["k"], S.bin_start("ts", 3600), "v", grid.STEPS[3600], empty="null").orderBy("bin")
    assert [r.v for r in null.collect()] == [1.0, None, 2.0, None, 4.0]


def test_counter_per_hour(three):
    out = grid.resample_counter(three, ["k"], S.bin_start("ts", 3600), "v", 3600).orderBy("bin")
    assert [r.value for r in out.collect()] == [None, 0.5, 0.5, 1.0, 1.0]


def test_counter_edges(spark):
    rows = [("a", at(60 * h), c) for h, c in enumerate([None, None, 3.0, None, 7.0, None])]
    out = grid.resample_counter(spark.createDataFrame(rows, "k string, ts timestamp, c double"), ["k"], F.col("ts"), "c", 3600)
    assert [r.value for r in out.orderBy("bin").collect()] == [None, None, None, 2.0, 2.0, 0.0]


def test_interpolation_edges(spark):
    df = spark.createDataFrame([("a", day(i + 1), v) for i, v in enumerate([None, 1.0, None, None, 4.0, None])], "k string, d date, v double")
    for chunk in (None, F.trunc("d", "week")):
        out = grid.interpolate(df, ["k"], "d", "v", "v", chunk).orderBy("d")
        assert [r.v for r in out.collect()] == [None, 1.0, 2.0, 3.0, 4.0, 4.0]


def test_spread_bill_keeps_total(spark):
    df = spark.createDataFrame([("a", day(1), day(3), 9.0), ("b", day(30), date(2024, 2, 2), 5.0)], "k string, ini date, fin date, v double")
    out = grid.spread_interval(df, "ini", "fin", "v").collect()
    assert sorted(r.v for r in out if r.k == "a") == [3.0, 3.0, 3.0]
    assert abs(sum(r.v for r in out) - 14.0) < 1e-12


def test_spread_readings(spark):
    df = spark.createDataFrame([("a", day(1), 5.0), ("a", day(4), 6.0), ("a", day(5), 1.0)], "k string, d date, v double")
    out = grid.spread_readings(df, ["k"], "d", "v").orderBy("day")
    assert [r.value for r in out.collect()] == [None, 2.0, 2.0, 2.0, 1.0]


def test_regular_grid_follows_numpy(spark):
    rng, t, rows = random.Random(1), 0.0, []
    for _ in range(200):
        t += rng.choice([20, 30, 31, 200]) + rng.random()
        rows.append(("a", at(t), rng.random()))
    df = spark.createDataFrame(rows, "k string, ts timestamp, v double")
    out = grid.regularise(df, ["k"], "ts", "v", 1800).orderBy("ts").toPandas()
    x = np.array([r[1].timestamp() for r in rows])
    g = np.array([v.to_pydatetime().timestamp() for v in out["ts"]])
    want = np.interp(g, x, np.cumsum([r[2] for r in rows]))
    assert np.allclose(out["value"][1:], np.diff(want), atol=1e-6)
    assert np.all(np.diff(g) == 1800)
    gaps = [(a, b) for a, b in zip(x, x[1:]) if math.floor(b) - math.floor(a) > 3600]
    assert list(out["missing"]) == [any(a <= p <= b for a, b in gaps) for p in g]


# --- cleaning -------------------------------------------------------------------------


def test_bill_overlap_and_gap(spark):
    rows = [("a", day(1), day(3), 3.0, 1), ("a", day(3), day(4), 4.0, 2)]
    df = spark.createDataFrame(rows, "k string, ini date, fin date, value double, bill_id long")
    days = clean.bill_days(df, ["k"])
    assert {r.day.day: r.value for r in days.collect()} == {1: 1.0, 2: 1.0, 3: 2.0, 4: 2.0}
    assert [r.day for r in clean.bill_overlaps(days).collect()] == [day(3)]
    assert clean.bill_days(df, ["k"], keep_all=True).count() == 5
    gap = spark.createDataFrame([("a", day(d)) for d in (1, 2, 5, 6)], "k string, d date")
    assert clean.day_gaps(gap, ["k"], "d").collect()[0][1:] == (day(2), day(5))


def test_weather_limits(spark):
    df = spark.createDataFrame([("s", -80.0), ("s", 10.0), ("s", 75.0)], "k string, t double")
    out = clean.clean_weather(df, ["k"], "t", clean.TEMPERATURE_MIN, clean.TEMPERATURE_MAX)
    assert [r.t for r in out.collect()] == [None, 10.0, None]


def half_hours(n):
    return [("a", T0 + timedelta(minutes=30 * i), 1.0) for i in range(n)]


@pytest.mark.parametrize("moved_front,moved_end,left", [(0, 0, 1000), (1, 0, 999), (0, 1, 999), (1, 1, 998), (2, 0, 998), (0, 2, 998)])
def test_trim_ends(spark, moved_front, moved_end, left):
    rows = half_hours(1000)
    shift = timedelta(days=14)
    rows = [
        (k, t - (moved_front - i) * shift if i < moved_front else t + (i - 999 + moved_end) * shift if i > 999 - moved_end else t, v)
        for i, (k, t, v) in enumerate(rows)
    ]
    df = spark.createDataFrame(rows, "k string, ts timestamp, v double")
    assert clean.trim_ends(df, ["k"], "ts", chunk=F.trunc("ts", "week")).count() == left


def test_increasing_times_is_the_fixpoint(spark):
    rng = random.Random(2)
    rows = [("a", i, rng.randint(0, 400)) for i in range(120)]
    kept = [r for r in rows]
    while any(b[2] <= a[2] for a, b in zip(kept, kept[1:])):
        kept = [kept[0]] + [b for a, b in zip(kept, kept[1:]) if b[2] > a[2]]
    df = spark.createDataFrame(rows, "k string, i int, t int")
    out = clean.increasing_times(df, ["k"], ["i"], "t", F.floor(F.col("i") / 9))
    assert sorted(r.i for r in out.collect()) == [r[1] for r in kept]


def test_remove_extremes_follows_the_loop(spark):
    rng = random.Random(4)
    data = {k: [rng.gauss(10, 1) for _ in range(80)] + [60.0, 300.0, 25.0] for k in "ab"}
    data["c"] = [5.0] * 10
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs], "k string, v double")
    want = []
    for k, vs in data.items():
        vs = np.array(vs)
        while True:
            ok = np.abs(vs - vs.mean()) <= 3 * vs.std()
            if ok.all():
                break
            vs = vs[ok]
        want += [(k, v) for v in vs]
    assert sorted((r.k, r.v) for r in clean.remove_extremes(df, ["k"], "v", 3.0).collect()) == sorted(want)


def test_clean_series_recomputes_rates(spark):
    rng, t, rows = random.Random(6), 0, []
    for i in range(150):
        t += rng.choice([30, 30, 60])
        rows.append(("a", i, at(t), rng.random() * (40 if i % 37 == 5 else 1)))
    ts, mv = np.array([r[2].timestamp() for r in rows]), np.array([r[3] for r in rows])
    while True:
        rate = mv[1:] / np.diff(ts)
        lo, hi = max(0.0, rate.mean() - 3 * rate.std()), rate.mean() + 3 * rate.std()
        keep = np.append(True, (rate >= lo) & (rate <= hi))
        if keep.all():
            break
        ts, mv = ts[keep], mv[keep]
    df = spark.createDataFrame(rows, "k string, i int, ts timestamp, v double")
    out = clean.clean_series(df, ["k"], ["i"], "ts", "v", "electricity", 3.0, F.trunc("ts", "month"))
    assert sorted(r.ts.timestamp() for r in out.collect()) == list(ts)


def test_valid_series_is_not_changed(spark):
    df = spark.createDataFrame([(k, i, t, v + 0.1 * (i % 3)) for i, (k, t, v) in enumerate(half_hours(600))], "k string, i int, ts timestamp, v double")
    assert clean.clean_series(df, ["k"], ["i"], "ts", "v", "electricity", 30.0).count() == 600


# --- alignment and comparison ------------------------------------------------------------


def test_source_preference(spark):
    df = spark.createDataFrame([("a", 1, "x", 1.0), ("a", 1, "y", 2.0), ("a", 1, "unlisted", 3.0), ("a", 2, "unlisted", 4.0)], "k string, t int, src string, v double")
    out = align.prefer_source(df, ["k", "t"], "src", ["y", "x"], ["v"], ["v"])
    assert {r.t: r.v for r in out.collect()} == {1: 2.0, 2: 4.0}


def test_keep_last_is_idempotent(spark):
    df = spark.createDataFrame([("a", 1, 5, 1.0), ("a", 1, 7, 2.0), ("b", 1, 1, 3.0)], "k string, t int, tie int, v double")
    once = align.keep_last(df, ["k", "t"], ["tie"], ["v", "tie"])
    twice = align.keep_last(once, ["k", "t"], ["tie"], ["v", "tie"])
    assert sorted(once.collect()) == sorted(twice.select(once.columns).collect())


def test_device_alignment(spark):
    df = spark.createDataFrame([("A", day(1), 1.0), ("A", day(2), 2.0), ("B", day(2), 3.0), ("B", day(3), 4.0)], "device string, day date, value double")
    bridge = spark.createDataFrame([("A", "u", 1.0), ("B", "u", 2.0), ("absent", "u", 1.0)], "device string, unit string, multiplier double")
    assert [r[:] for r in align.align_devices(df, bridge, "day").collect()] == [("u", day(2), 8.0)]


def test_annual_mean_counts_empty_months(spark):
    rows = [("u", date(2023, m, 1), float(m)) for m in (1, 6, 12)] + [("u", date(2022, 12, 1), 100.0)]
    months = compare.month_grid(spark.createDataFrame(rows, "unit string, month date, value double"), ["unit"])
    assert months.count() == 13
    out = compare.annual_mean(months, ["unit"], "value").collect()[0]
    assert out.n_months == 3 and abs(out.annual - 19 / 3) < 1e-12


# --- models -------------------------------------------------------------------------------


def test_percentile_of_score(spark):
    train = spark.createDataFrame([("u", v) for v in (1.0, 2.0, 3.0, 4.0)], "k string, v double")
    test = spark.createDataFrame([("u", 3.0), ("u", 2.5), ("u", 9.0)], "k string, v double")
    out = {r.v: r.score for r in models.score_percentile(train, test, ["k"], "v").collect()}
    assert out == {3.0: 75.0, 2.5: 50.0, 9.0: 100.0}


def test_degree_day_fit_and_gate(spark):
    up = [("up", date(2023, m, 1), 10 + 2.0 * m, float(m), 0.0) for m in range(1, 9)]
    down = [("down", date(2023, m, 1), 50 - 2.0 * m, float(m), 0.0) for m in range(1, 9)]
    two = [("two", date(2023, m, 1), 1.0 * m, float(m), 0.0) for m in (1, 2)]
    df = spark.createDataFrame(up + down + two, "unit string, month date, value double, hdd double, cdd double")
    out = {r.unit: r for r in models.degree_fits(df, ["unit"], "value").collect()}
    assert abs(out["up"].hdd_slope - 2) < 1e-9 and abs(out["up"].hdd_intercept - 10) < 1e-9
    assert out["up"].hdd_ok and not out["down"].hdd_ok and not out["two"].hdd_ok


def test_monthly_baseline_falls_back_to_the_month_mean(spark):
    months = [date(2020 + i // 12, i % 12 + 1, 1) for i in range(48)]
    rows = [("u", m, 50.0 - 2 * m.month + (m.year - 2020), 30) for m in months]
    monthly = spark.createDataFrame(rows, "unit string, month date, value double, n_days int")
    degrees = spark.createDataFrame([("u", m, float(m.month), 0.0) for m in months], "unit string, month date, hdd double, cdd double")
    out = {r.month: r for r in models.monthly_baseline(monthly, degrees, ["unit"]).collect()}
    assert len(out) == 12 and {r.status for r in out.values()} == {"ok"}
    assert abs(out[date(2023, 3, 1)].p50 - (50 - 6 + 1) * 30) < 1e-9


def test_change_point_fit(spark):
    rng = random.Random(8)
    rows = [("u", t, 5 + 3 * max(14 - t, 0) + rng.gauss(0, 0.01)) for t in np.linspace(-2, 30, 120).tolist()]
    fit = models.fit_heating(spark.createDataFrame(rows, "unit string, temperature double, value double"), ["unit"], "value", "temperature").collect()[0]
    assert abs(fit.change_point - 14) < 0.5 and abs(fit.slope - 3) < 0.1
    best = models.select_model(models.fit(spark.createDataFrame(rows, "unit string, temperature double, value double"), ["unit"], "value", "temperature", models.ALL_MODELS), ["unit"])
    assert best.collect()[0].model == "heating"


def test_smoothing_follows_the_loop(spark):
    rng = random.Random(9)
    for _ in range(4):
        v = [float(rng.choice([5, 7, -20, -30])) for _ in range(25)]
        want = list(v)
        for i, x in enumerate(v):
            if x < -10:
                want[i] = want[1] if i == 0 else want[i - 1] if i == 24 else (want[i - 1] + want[i + 1]) / 2
        df = spark.createDataFrame([("k", i, x) for i, x in enumerate(v)], "k string, i int, v double")
        got = [r.s for r in models.smooth_band(df, ["k"], "i", "v", "s").orderBy("i").collect()]
        assert np.allclose(got, want)


# --- events ----------------------------------------------------------------------------------


def test_cusum_hand_case(spark):
    rows = [("u", i, -1.0 if i <= 10 else 1.0) for i in range(1, 21)]
    out = events.scaled_cusum(spark.createDataFrame(rows, "unit string, t int, residual double"), ["unit"], "t")
    row = out.filter("t = 11").collect()[0]
    assert abs(row["lambda"] + 4.4721) < 1e-3
    assert events.strongest_change(out, ["unit"], "t", 0.005).collect()[0].event == 11
    assert events.strongest_change(out, ["unit"], "t", 0.001).count() == 0


def _loop_events(values, alpha):
    """Plain recursion over half-open segments."""
    found, todo = set(), [(0, len(values))]
    while todo:
        a, b = todo.pop()
        x = np.array(values[a:b]) - np.mean(values[a:b])
        n, sd = len(x), np.std(x)
        if n < 2 or sd < 1e-12:
            continue
        i = np.arange(1, n)
        lam = np.round(np.abs(np.cumsum(x)[:-1] / (sd * np.sqrt(n)) / np.sqrt(i / n * (1 - i / n))), 9)
        k = int(np.argmax(lam)) + 1
        if lam[k - 1] >= events.critical_value(alpha):
            found.add(a + k)
            todo += [(a, a + k), (a + k, b)]
    return found


def test_event_detection_follows_the_recursion(spark):
    rng = random.Random(11)
    levels = [0, 6, 6, 2, 9]
    series = {u: [rng.gauss(levels[i // 30] * s, 1) for i in range(150)] for u, s in (("u", 1), ("v", 0.4), ("w", 0))}
    rows = [(u, i, v) for u, vs in series.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "unit string, t int, v double")
    want = {(u, e) for u, vs in series.items() for e in _loop_events(vs, 0.01)}
    for every in (False, True):
        found = events.detect_events(df, ["unit"], "t", "v", 0.01, every)
        assert {(r.unit, r.event) for r in found.collect()} == want
    kept = events.confirm_events(df, found, ["unit"], "t", "v", 0.01)
    near = {(u, e) for u, e in ((r.unit, r.event) for r in kept.collect()) if u == "u"}
    assert {("u", 30), ("u", 90), ("u", 120)} <= {(u, round(e / 30) * 30) for u, e in near}


# --- load model ---------------------------------------------------------------------------------


def test_low_pass_restarts_after_a_null(spark):
    x = [3.0, 1.0, None, 5.0, 2.0] + [float(i % 7) for i in range(80)]
    y, want = None, []
    for v in x:
        y = None if v is None else v if y is None else 0.6 * y + 0.4 * v
        want.append(y)
    df = spark.createDataFrame([("u", at(60 * i), v) for i, v in enumerate(x)], "k string, ts timestamp, x double")
    got = [r.y for r in loadmodel.low_pass(df, ["k"], "ts", "x", 0.6, "y").orderBy("ts").collect()]
    assert [g is None for g in got] == [w is None for w in want]
    assert np.allclose([g for g in got if g is not None], [w for w in want if w is not None])


def test_least_squares_leaves_out_dependent_columns():
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=50), rng.normal(size=50)
    fit = loadfit.least_squares({"one": np.ones(50), "a": a, "twice": 2 * a + 1, "b": b}, 1 + 2 * a - b)
    assert list(fit["term"]) == ["one", "a", "b"] and np.allclose(fit["coef"], [1, 2, -1])


def test_recursive_prediction_feeds_lags():
    pdf = pd.DataFrame(
        {
            "day": [1, 1, 1, 2], "s": "1", "dayhour": [0, 1, 2, 0], "occupancy": 50.0, "temperature": 10.0, "wind_speed": 0.0,
            "ghi": 0.0, "wind_sector": "N", "sun_label": "NA", "lag1": [4.0, 99.0, 99.0, 8.0],
        }
    )
    fit = pd.DataFrame({"term": ["lag1|1"], "coef": [0.5]})
    hyper = {"n": 1, "alpha_t": 0, "alpha_w": 0, "alpha_g": 0, "tbal": 18, "p": 15}
    assert list(loadfit.predict_days(pdf, fit, hyper, [])) == [2.0, 1.0, 0.5, 4.0]


def test_mixture_separates_two_shapes(spark):
    rng = np.random.default_rng(1)
    rows = []
    for d in range(40):
        weekend = d % 4 == 0
        z = rng.normal(2.0 if weekend else -1.0, 0.3, 24)
        rows.append(("u", date(2024, 1, 1) + timedelta(days=d), 100.0 if weekend else 300.0, *[float(v) for v in z]))
    hours = ", ".join(f"h{h} double" for h in range(24))
    wide = spark.createDataFrame(rows, f"unit string, day date, total double, {hours}")
    params = loadfit.train_clusters(wide, "unit", (2, 3))
    long = wide.select("unit", "day", F.posexplode(F.array(*[f"h{h}" for h in range(24)])).alias("dayhour", "z"))
    days = loadmodel.assign_clusters(long, params, ["unit"]).toPandas()
    groups = days.groupby([d.toordinal() % 4 == date(2024, 1, 1).toordinal() % 4 for d in days["day"]])["s"].agg(set)
    assert all(len(g) >= 1 for g in groups) and not (groups.iloc[0] & groups.iloc[1])


def test_trained_model_beats_the_mean(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(24 * 60):
        t = T0 + timedelta(hours=i)
        load = np.exp(1 + 0.8 * np.sin(2 * np.pi * t.hour / 24) + 0.05 * rng.normal())
        rows.append(("u", t, float(load), float(10 + 5 * np.sin(i / 50)), float(100 * max(np.sin((t.hour - 6) / 12 * np.pi), 0)), 3.0, 90.0))
    df = spark.createDataFrame(rows, "unit string, time timestamp, value double, temperature double, ghi double, wind_speed double, wind_bearing double")
    df = df.withColumns({"day": F.to_date("time"), "dayhour": F.hour("time"), "s": F.lit("1")})
    feats = loadmodel.prepare_features(df, ["unit"], "time", "value", 3, F.lit(41.6), F.lit(0.62))
    early = feats.filter("time < '2024-02-20'").withColumn("train", loadfit.training_days("day"))
    grid_small = [{"n": n, "alpha_t": 0.1, "alpha_w": 0.1, "alpha_g": 0.1, "tbal": 20.0, "p": 15.0} for n in (1, 3)]
    fitted = loadfit.train_models(early, "unit", grid_small)
    late = feats.filter("time >= '2024-02-20'")
    out = loadfit.predict_models(late, fitted, "unit", 3).join(late.select("unit", "time", "value"), ["unit", "time"])
    score = quality.validation_scores(out, ["unit"], "value", "prediction").collect()[0]
    assert score.r2 > 0.95 and score.nrmse < 0.15


def test_search_covers_every_parameter(spark):
    units = spark.createDataFrame([("u", "cooling,heating,ghi,wind"), ("bare", "")], "unit string, groups string")
    table = loadfit.coarse_settings(units, 6).toPandas()
    full, bare = table[table["unit"] == "u"], table[table["unit"] == "bare"]
    assert len(full.drop_duplicates(["alpha_t", "alpha_w", "alpha_g"])) == 27 and set(full["n"]) == {0, 1, 3, 6}
    ends = {h: (full[h].min(), full[h].max()) for h in ("alpha_w", "tbal", "p")}
    assert ends == {"alpha_w": (0, 0.5), "tbal": (16, 24), "p": (1, 30)}
    assert len(bare) == 4 and not full.duplicated().any()
    start = units.selectExpr("unit", "groups", "1D n", "0D alpha_t", "0D alpha_w", "0D alpha_g", "16D tbal", "1D p", "0D score")
    lines = loadfit.line_settings(start, 6).toPandas()
    assert lines.groupby("unit").size().to_dict() == {"bare": 6, "u": 6 + 5 * 15}
    assert all(lines[lines["unit"] == "u"][h].nunique() == 16 for h in ("alpha_t", "alpha_w", "alpha_g", "tbal", "p"))


def test_search_finds_occupancy_and_balance_between_grid_points(spark):
    rng = np.random.default_rng(3)
    tbal, p = loadfit.steps_of("tbal")[10], loadfit.steps_of("p")[12]
    rows = []
    for i in range(24 * 60):
        t = T0 + timedelta(hours=i)
        temp, occ = 24 + 8 * float(rng.normal()), 10.0 if t.hour < 6 else 25.0 if t.hour < 18 else 23.0
        log = 1.0 + 0.1 * max(temp - tbal, 0) * (occ >= p) + 0.05 * max(tbal - temp, 0) + 0.001 * rng.normal()
        rows.append(("u", t, t.date(), "1", t.hour, occ, float(log), temp, 0.0, 0.0, "N", "NA", t.day % 5 > 0, *[0.0] * 6))
    kinds = "unit string, time timestamp, day date, s string, dayhour int, occupancy double, log_value double, temperature double, "
    kinds += "wind_speed double, ghi double, wind_sector string, sun_label string, train boolean, "
    df = spark.createDataFrame(rows, kinds + ", ".join(f"lag{k} double" for k in range(1, 7)))
    got = loadfit.train_models(df, "unit").select(*loadfit.HYPER, "score").distinct().collect()
    assert len(got) == 1 and got[0].tbal == pytest.approx(tbal) and got[0].p == pytest.approx(p) and got[0].score > 0.999


def plain_usage_limit(values):
    """The rule on the exact density, point by point."""
    v = np.sort(values)
    v = v[v <= np.quantile(v, 0.7)]
    iqr = np.quantile(v, 0.75) - np.quantile(v, 0.25)
    spread = min(np.std(v, ddof=1), iqr / 1.34) or np.std(v, ddof=1) or abs(v[0]) or 1.0
    bw = 0.9 * spread * len(v) ** -0.2
    x = np.linspace(v[0] - 3 * bw, v[-1] + 3 * bw, 512)
    d = np.exp(-0.5 * ((x[:, None] - v) / bw) ** 2).sum(axis=1)
    turns = [i for i in range(1, 511) if (d[i] - d[i - 1]) * (d[i + 1] - d[i]) < 0]
    if len(turns) == 1:
        return x[turns[0]] if x[turns[0]] < 0.5 else 0.0
    if len(turns) < 3:
        return 0.0
    limit = 0.0
    if x[turns[0]] <= np.quantile(v, 0.2) and d[turns[0]] > 0.2 * d[turns].max():
        limit = x[turns[1]]
    modes = range(0, len(turns), 2)
    big = [k for k in modes if k > 0 and d[turns[k]] > 3 * d[turns[k - 2]] and x[turns[k]] > np.quantile(v, 0.1)]
    mode = big[0] if big else 0
    if big:
        limit = x[turns[mode - 1]]
    if x[turns[mode]] < 0.5:
        limit = x[turns[mode + 1]] if mode + 1 < len(turns) else 0.0
    return limit


def test_usage_limit_follows_the_density(spark):
    from meterloom.operators import usage

    rng = np.random.default_rng(4)
    series = {
        "valley": np.concatenate([rng.normal(1, 0.2, 300), rng.normal(6, 1, 1500)]),
        "flat": np.full(50, 2.0),
        "zeros": np.zeros(40),
        "rising": np.arange(1000) ** 0.5,
        # Most of the use within a sixty-fourth of the range, where equal bins see a single one.
        "spike": np.concatenate([rng.normal(3, 0.01, 1500), rng.normal(3.1, 0.01, 1200), rng.uniform(0, 20, 400)]),
        # A small dip early, then a mode over three times as high.
        "growth": np.concatenate([rng.normal(2, 0.3, 60), rng.normal(4, 0.3, 90), rng.normal(9, 0.6, 1500)]),
        "standby": np.concatenate([rng.normal(0.1, 0.02, 500), rng.normal(5, 1, 900)]),
    }
    rows = [(k, float(v)) for k, values in series.items() for v in values] + [("flat", None), ("one", 1.0), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.limit for r in usage.usage_limits(df, ["k"], "v").collect()}
    for k, values in series.items():
        assert got[k] == pytest.approx(plain_usage_limit(values), abs=0.02 * (1 + abs(got[k]))), k
    assert 1.4 < got["valley"] < 4 and 5 < got["growth"] < 8 and 0.2 < got["standby"] < 4
    assert got["flat"] == got["one"] == 0 and got.get("none", 0) == 0


def test_critical_values_go_on_beyond_the_table(spark):
    from meterloom.functions import stats

    got = [r.t for r in spark.createDataFrame([(n,) for n in (10, 120, 121, 500)], "n long").select(stats.t_critical(F.col("n")).alias("t")).collect()]
    assert got == pytest.approx([1.812461, 1.657651, 1.657544, 1.647907], abs=2e-6)


# --- ingest and sinks ------------------------------------------------------------------------------


def test_unknown_reading_becomes_a_dead_letter(spark):
    docs = spark.createDataFrame([("r1", "d", 1500.0, T0), ("rx", "d", 1.0, T0)], "reading string, device string, value double, timestamp timestamp")
    meta = spark.createDataFrame([("r1", "electricity", "Wh", "CUMULATIVE")], "reading string, type string, unit string, period string")
    good, bad = ingest.split_errors(ingest.with_reading(docs, meta), "now")
    row = ingest.metering_rows(good).collect()[0]
    assert row.value is None and row.accumulated == 1.5
    assert [r.reading for r in bad.collect()] == ["rx"]


def test_replace_in_table_touches_its_partitions_only(spark):
    path = sinks.work_path(spark, "t")
    old = spark.createDataFrame([(1, "a", 1.0), (2, "a", 2.0), (3, "b", 3.0)], "k int, p string, v double")
    sinks.create_table(old, path, ["p"])
    sinks.replace_in_table(spark, path, spark.createDataFrame([(1, "a", 9.0), (7, "c", 5.0)], old.schema), ["k"], ["p"])
    assert sorted((r.k, r.p, r.v) for r in sinks.read_version(spark, path, old.schema, ["p"]).collect()) == [(1, "a", 9.0), (2, "a", 2.0), (3, "b", 3.0), (7, "c", 5.0)]


def test_status_and_route(spark):
    rows = [("one", at(0), 1.0, None), ("mix", at(0), 1.0, None), ("mix", at(30), None, 2.0)] + [("slow", at(1440 * 30 * i), 1.0, None) for i in range(3)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, value double, accumulated double")
    kinds, steps = clean.series_kind(df, ["k"]), clean.dominant_interval(df, ["k"], "ts")
    status = {r.k: r.status for r in clean.series_status(kinds, steps, ["k"]).collect()}
    assert status == {"one": "no interval", "mix": "counter and instant values", "slow": "ok"}
    assert {r.k: r.route for r in clean.route_series(kinds, steps, ["k"]).collect()} == {"one": "billing", "mix": "metering", "slow": "billing"}


def test_replaced_key_leaves_its_old_partition(spark):
    path = sinks.work_path(spark, "t")
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "b", 3.0), (4, None, 4.0)], "k int, p string, v double")
    sinks.create_table(old, path, ["p"])
    new = spark.createDataFrame([(1, "b", 9.0), (3, "c", 5.0), (4, "c", 6.0)], old.schema)
    sinks.replace_in_table(spark, path, new, ["k"], ["p"])
    assert sorted((r.k, r.p, r.v) for r in sinks.read_version(spark, path, old.schema, ["p"]).collect()) == [(1, "b", 9.0), (2, "b", 2.0), (3, "c", 5.0), (4, "c", 6.0)]


def test_empty_months_count_in_groups_and_rolling_means(spark):
    import datetime as dt

    month = lambda m: dt.date(2024, m, 1)
    rows = [(u, month(m), v) for u in (1, 2, 3) for m, v in ((1, 10.0 * u), (2, 20.0 * u), (4, 60.0 * u))]
    grid = compare.month_grid(spark.createDataFrame(rows, "unit int, month date, value double"), ["unit"])
    sizes = compare.peer_percentiles(grid, ["month"], "value", 3, [50])
    assert {r.month.month: (r.n_rows, r.p50) for r in sizes.collect()} == {1: (3, 20.0), 2: (3, 40.0), 3: (3, None), 4: (3, 120.0)}
    two = compare.rolling_annual(grid.filter("unit = 1"), ["unit"], "value", rows=2)
    assert {r.month.month: r.annual for r in two.collect()} == {1: 10.0, 2: 15.0, 3: 20.0, 4: 60.0}
