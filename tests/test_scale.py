"""Large groups, loops, lost writers: what a method does beyond the right values."""

import json
import os
import random
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterloom.functions import quantiles
from meterloom.functions.recovery import shared_folder
from meterloom.operators import clean, events, grid, loadmodel, models
from meterloom.sources import ingest, sinks
from meterloom.streaming import ingest as streaming

T0 = datetime(2024, 1, 1)


def plan_of(df):
    return df._jdf.queryExecution().toString()


def folder_bytes(path):
    path = path.removeprefix("file:")
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names)


# --- percentiles ----------------------------------------------------------------------------------


def test_large_groups_are_ranked_in_parts(spark, monkeypatch):
    rng = random.Random(2)
    close = [100 + rng.random() for _ in range(6000)]
    tied = [rng.choice([1.0, 2.0, 2.0, 5.0]) for _ in range(3000)]
    wide = [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(2500)] + [1e308, -1e308]
    series = {"close": close, "tied": tied, "wide": wide, "small": [3.0, 1.0, 2.0], None: [7.0] * 10 + [8.0] * 900}
    rows = [(k, v) for k, vs in series.items() for v in vs] + [("close", None), ("small", float("nan")), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    probs = [0.0, 0.05, 0.5, 0.9, 1.0]
    seen = []
    real = quantiles._inside
    monkeypatch.setattr(quantiles, "_inside", lambda rows, wanted, keys: seen.append(wanted) or real(rows, wanted, keys))
    got = {r.k: r for r in quantiles.exact_percentiles(df, ["k"], "v", probs, list("abcde"), "n", bound=100).collect()}
    for k, values in series.items():
        want = np.percentile(values, [p * 100 for p in probs])
        assert np.allclose([got[k][c] for c in "abcde"], want, rtol=1e-9), k
    assert got["close"].n == 6001 and got["small"].n == 4 and got["none"].a is None
    # The last step ranks several small intervals of the group whose values are close together.
    last = seen[-1].filter("k = 'close'")
    assert last.select("__lo").distinct().count() >= 3 and last.agg(F.max("__in")).first()[0] <= 100


def test_weighted_percentiles(spark):
    rng = random.Random(3)
    counts = {float(v): rng.randrange(1, 9) for v in range(400)}
    df = spark.createDataFrame([("a", v, n) for v, n in counts.items()], "k string, v double, n long")
    values = [v for v, n in counts.items() for _ in range(n)]
    want = np.percentile(values, [5, 50, 95])
    for bound in (10, 1000):
        (r,) = quantiles.exact_percentiles(df, ["k"], "v", [0.05, 0.5, 0.95], ["a", "b", "c"], "n", "n", bound).collect()
        assert np.allclose([r.a, r.b, r.c], want) and r.n == len(values)


# --- change points and backtests ------------------------------------------------------------------


def plain_heating(t, y):
    """Two passes over 21 change points, each by least squares."""

    def best(low, high):
        step = (high - low) / 19
        options = [(15.5, -1)] + [(low + i * step, i) for i in range(20)]
        scored = []
        for cp, i in options:
            x = np.maximum(cp - t, 0)
            sxx, syy = ((x - x.mean()) ** 2).sum(), ((y - y.mean()) ** 2).sum()
            slope = 0.0 if sxx < 1e-9 else ((x - x.mean()) * (y - y.mean())).sum() / sxx
            sse = syy - slope * ((x - x.mean()) * (y - y.mean())).sum()
            scored.append((round(sse / max(syy, 1e-9), 9), i, cp, slope, y.mean() - slope * x.mean()))
        return min(scored)[2:], step

    (cp, _, _), step = best(t.min(), t.max())
    return best(cp - step, cp + step)[0]


def model_rows(rng, groups=6):
    rows = []
    for g in range(groups):
        n = rng.choice([4, 6, 30, 200])
        t = [round(rng.uniform(-5, 30), rng.choice([0, 3])) for _ in range(n)]
        rows += [(f"g{g}", x, 5 + g + (2.0 + g) * max(14.0 + g - x, 0) + rng.gauss(0, 1)) for x in t]
    rows += [("same", 10.0, float(i)) for i in range(10)] + [("hot", float(20 + i), float(i % 3)) for i in range(12)]
    return rows


def test_change_points_equal_a_plain_search(spark):
    rows = model_rows(random.Random(6))
    df = spark.createDataFrame([*rows, ("g0", None, 3.0), ("g1", 2.0, None), ("empty", None, 1.0)], "k string, t double, y double")
    fits = models.fit_heating(df.repartition(3), ["k"], "y", "t")
    assert "inline" not in plan_of(fits)
    got = {r.k: (r.change_point, r.slope, r.intercept) for r in fits.collect()}
    for k in {r[0] for r in rows}:
        t, y = (np.array([r[i] for r in rows if r[0] == k]) for i in (1, 2))
        if len(t) >= 6:
            assert np.allclose(got[k], plain_heating(t, y), rtol=1e-6, atol=1e-6), k
        else:
            assert k not in got
    assert "empty" not in got


def test_no_row_of_a_series_is_copied_for_folds(spark):
    rows = [(u, date(2023, 1, 1) + timedelta(i), float((i * 7 + u) % 13), float(i % 29)) for u in (1, 2) for i in range(150)]
    df = spark.createDataFrame(rows, "u int, day date, v double, t double").withColumn("slot", F.dayofweek("day") > 5)
    out = models.backtest(df, ["u"], "day", "v", "slot", 7, 16, "t", models.ALL_MODELS, "v2", score_by_slot=True)
    got = {(r.u, r.day): r for r in out.collect()}
    assert len(got) == 2 * 16 * 7
    assert "explode(sequence(1" not in plan_of(out).lower()
    for (u, d), r in list(got.items())[::37]:
        before = [x for x in rows if x[0] == u and x[1] < date(2023, 1, 1) + timedelta(150 - 7 * r.fold)]
        same = [x for x in before if (x[1].isoweekday() % 7 + 1 > 5) == (d.isoweekday() % 7 + 1 > 5)]
        y = np.array([x[2] for x in same])
        if r.model == "constant":
            res = np.round(y - y.mean(), 9)
            own = round(r.v - y.mean(), 9)
            lt, le = (res < own).sum(), (res <= own).sum()
            assert r.prediction == pytest.approx(y.mean()) and r.score == pytest.approx((lt + le + (le > lt)) * 50 / len(res))
            assert r.p25 == pytest.approx(y.mean() + np.percentile(res, 25))


def test_scores_over_all_slots_look_up_sorted_residuals(spark):
    rng = random.Random(8)
    rows = [("u", i, rng.gauss(0, 5) + 10 * (i % 3), i % 3) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, i int, v double, slot int")
    got = models.backtest(df, ["k"], "i", "v", "slot", 30, 4).collect()
    assert len(got) == 120
    for r in got[::11]:
        train = [x for x in rows if x[1] < 900 - 30 * r.fold]
        mean = {s: np.mean([x[2] for x in train if x[3] == s]) for s in range(3)}
        res = np.round([x[2] - mean[x[3]] for x in train], 9)
        own = round(r.v - mean[r.slot], 9)
        lt, le = (res < own).sum(), (res <= own).sum()
        assert r.score == pytest.approx((lt + le + (le > lt)) * 50 / len(res))


# --- extremes -------------------------------------------------------------------------------------


def test_rounds_of_extremes_write_one_row_a_key(spark):
    rng = random.Random(1)
    rows = [(k, rng.gauss(0, 1) * (1 + 40 * (rng.random() < 0.02))) for k in ("a", "b") for _ in range(20000)]
    path = sinks.work_path(spark, "values")
    spark.createDataFrame(rows, "k string, v double").write.parquet(path)
    before = folder_bytes(shared_folder(spark))
    df = spark.read.parquet(path)
    kept = clean.remove_extremes(df, ["k"], "v", 3.0)
    n = kept.count()
    assert folder_bytes(shared_folder(spark)) - before < folder_bytes(path) / 4
    want = 0
    for k in ("a", "b"):
        v = np.array([x for kk, x in rows if kk == k])
        while True:
            ok = np.abs(v - v.mean()) <= 3 * v.std()
            if ok.all():
                break
            v = v[ok]
        want += len(v)
    assert n == want


# --- grids ----------------------------------------------------------------------------------------


def test_regular_grid_reads_any_number_of_meters_once(spark):
    def rows(meters):
        return [("k", m, T0 + timedelta(seconds=600 * i + m % 7), 1.0) for m in range(meters) for i in range(40)]

    schema = "k string, meter int, ts timestamp, v double"
    one, many = (grid.regularise(spark.createDataFrame(rows(n), schema), ["k"], "ts", "v", 900) for n in (1, 100))
    a, b = ({r.ts: r.value for r in x.collect()} for x in (one, many))
    assert set(a) <= set(b) and sum(v for v in b.values() if v) > 90 * sum(v for v in a.values() if v)
    # Windows run over one row a cell, behind the aggregate of the only scan.
    plan = many._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1


def test_merged_counters_equal_the_sum_of_their_movements(spark):
    rng = random.Random(4)
    rows, per_bin = [], {}
    for m in range(30):
        level = 1000.0 * m
        for h in sorted(rng.sample(range(48), 20)):
            step = rng.random()
            level += step
            rows.append(("e", m, T0 + timedelta(hours=h), level))
            per_bin.setdefault(h, []).append((m, step))
    df = spark.createDataFrame(rows, "k string, d int, ts timestamp, c double")
    got = {r.ts: r.total for r in grid.merge_counters(df, ["k"], "d", "ts", "c", "total").collect()}
    first, total = set(), 0.0
    for h in sorted(per_bin):
        total += sum(step for m, step in per_bin[h] if m in first)
        first |= {m for m, _ in per_bin[h]}
        assert got[T0 + timedelta(hours=h)] == pytest.approx(total, abs=1e-6)


@pytest.mark.parametrize("alpha", [0.0001, 0.05, 0.6, 0.995])
def test_low_pass_on_a_fine_grid(spark, alpha):
    rng = random.Random(9)
    x = [rng.uniform(0, 1e6) for _ in range(3 * 288)]
    x[500] = None
    y, want = None, []
    for v in x:
        y = None if v is None else v if y is None else alpha * y + (1 - alpha) * v
        want.append(y)
    df = spark.createDataFrame([("u", T0 + timedelta(minutes=5 * i), v) for i, v in enumerate(x)], "k string, ts timestamp, x double")
    got = [r.y for r in loadmodel.low_pass(df, ["k"], "ts", "x", alpha, "y").orderBy("ts").collect()]
    assert [g is None for g in got] == [w is None for w in want]
    assert np.allclose([g for g in got if g is not None], [w for w in want if w is not None], rtol=1e-12)


# --- events ---------------------------------------------------------------------------------------


def plain_confirm(v, found, alpha):
    """Rounds of moving each event within its neighbours, until a set of events comes again."""

    def strongest(a, b):
        x = np.array(v[a:b]) - np.mean(v[a:b])
        sd, n = x.std(), b - a
        if n < 2 or sd < 1e-12:
            return None
        i = np.arange(1, n)
        lam = np.round(np.abs(np.cumsum(x)[:-1] / (sd * np.sqrt(n)) / np.sqrt(i / n * (1 - i / n))), 9)
        k = int(np.argmax(lam))
        return a + k + 1 if lam[k] >= events.critical_value(alpha) else None

    seen, now = [set(found)], set(found)
    while True:
        ends = [0, *sorted(now), len(v)]
        after = {strongest(a, b) for a, b in zip(ends[:-2], ends[2:], strict=True)} - {None}
        if after == now or after in seen or not after:
            return after, after == now
        seen.append(after)
        now = after


def test_confirmation_runs_until_it_stands_or_turns_in_a_circle(spark):
    rng = random.Random(21)
    series = {f"u{k}": [rng.gauss(rng.choice([0, 1, 3]) if i % 25 == 0 else 0, 1) + 2 * ((i // (20 + k)) % 3) for i in range(160)] for k in range(8)}
    rows = [(k, i, v) for k, vs in series.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "a string, t int, v double")
    found = events.detect_events(df, ["a"], "t", "v", 0.1, every_segment=True)
    start = {}
    for r in found.collect():
        start.setdefault(r.a, set()).add(r.event)
    got, stands = {}, {}
    for r in events.confirm_events(df, found, ["a"], "t", "v", 0.1).collect():
        got.setdefault(r.a, set()).add(r.event)
        stands[r.a] = r.converged
    assert len(start) >= 5 and max(map(len, start.values())) >= 3
    for k, at in start.items():
        want, stable = plain_confirm(series[k], at, 0.1)
        assert got.get(k, set()) == want and (not want or stands[k] == stable)


def test_a_round_reads_only_segments_that_were_split(spark):
    rows = [("u", i, float(6 * (i >= 40) + i % 2)) for i in range(100)]
    table = events._prefix_sums(spark.createDataFrame(rows, "k string, t int, v double"), ["k"], "t", "v")
    whole = events._whole_series(table, ["k"])
    (one,) = events._significant(table, whole, ["k"], 0.01).collect()
    halves = events._halves(events._significant(table, whole, ["k"], 0.01), ["k"])
    assert one.event == 40 and sorted((r["__a"], r["__b"]) for r in halves.collect()) == [(0, 40), (40, 100)]
    assert events._significant(table, halves, ["k"], 0.01).isEmpty()


# --- writes ---------------------------------------------------------------------------------------


def test_a_replacement_that_stops_half_way_leaves_the_old_table(spark, monkeypatch):
    path = sinks.work_path(spark, "t")
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "b", 3.0)], "k int, p string, v double")
    sinks.create_table(old, path, ["p"])
    read = lambda: sorted((r.k, r.p, r.v) for r in sinks.read_version(spark, path, old.schema, ["p"]).collect())
    new = spark.createDataFrame([(1, "b", 9.0), (2, "c", 8.0)], old.schema)

    def stop(*_):
        raise RuntimeError("the driver is lost")

    for step in ("_write_version", "_switch"):
        with monkeypatch.context() as m:
            m.setattr(sinks, step, stop)
            with pytest.raises(RuntimeError):
                sinks.replace_in_table(spark, path, new, ["k"], ["p"])
        assert read() == [(1, "a", 1.0), (2, "b", 2.0), (3, "b", 3.0)]
    sinks.replace_in_table(spark, path, new, ["k"], ["p"])
    want = [(1, "b", 9.0), (2, "c", 8.0), (3, "b", 3.0)]
    assert read() == want
    before = folder_bytes(path)
    sinks.drop_old_versions(spark, path)
    assert read() == want and folder_bytes(path) < before


def test_late_documents_are_loaded_once(spark, tmp_path):
    schema = "reading string, device string, value double, timestamp timestamp, company string"
    doc = lambda d, days, v=1.0, reading="r": {"reading": reading, "device": d, "value": v, "timestamp": str(T0 + timedelta(days=days)), "company": "c"}
    source = tmp_path / "in"
    source.mkdir()
    meta = spark.createDataFrame([("r", "electricity", "kWh", "INSTANT")], "reading string, type string, unit string, period string")
    paths = [f"file://{tmp_path}/{n}" for n in ("good", "bad", "state", "index")]

    def load(name, docs):
        (source / name).write_text("\n".join(map(json.dumps, docs)))
        stream = streaming.document_stream(spark, f"file://{source}", spark.createDataFrame([], schema).schema, 1)
        streaming.load_stream(stream, meta, ingest.metering_rows, paths[0], paths[1], paths[2], "now", paths[3], ["device", "timestamp", "company", "value"], "timestamp")

    load("1.json", [doc("a", 0), doc("a", 0), doc("b", 4000), doc("x", 1, reading="unknown")])
    # Ten years late: one document again, one for the first time.
    load("2.json", [doc("a", 0), doc("z", -3650), doc("b", 4000, 2.0), doc("x", 1, reading="unknown")])
    good = sorted((r.device, r.value) for r in spark.read.parquet(paths[0]).collect())
    assert good == [("a", 1.0), ("b", 1.0), ("b", 2.0), ("z", 1.0)]
    assert spark.read.parquet(paths[1]).count() == 1


def test_month_degrees_are_not_sent_through_the_driver(spark):
    import re

    from meterloom.functions.recovery import cut_lineage

    units = spark.range(40).select(F.col("id").alias("unit"))
    months = spark.sql("SELECT explode(sequence(DATE'2020-01-01', DATE'2023-08-01', INTERVAL 1 MONTH)) AS month")
    rows = units.crossJoin(months).withColumns({"value": F.month("month") + F.col("unit") / 10, "n_days": F.lit(30)})
    cold = F.greatest(F.lit(0.0), 12.0 - F.month("month"))
    degrees = units.crossJoin(months).select("unit", "month", cold.alias("hdd"), F.lit(0.0).alias("cdd"))
    out = models.monthly_baseline(cut_lineage(rows), cut_lineage(degrees), ["unit"])
    # The files of both tables are small whatever their rows, so that a join of the two in the result would be a broadcast.
    assert not re.search(r"BroadcastHashJoin \[unit#\d+L, month#\d+\]", out._jdf.queryExecution().sparkPlan().toString())
    assert out.filter("status = 'ok'").count() == 40 * 12


def test_grid_keeps_the_partitions_of_its_keys(spark):
    ends = spark.createDataFrame([(k, d) for k in range(40) for d in ("2020-01-01", "2022-01-01")], "k int, d string")
    full = grid.fill_grid(ends.select("k", F.to_date("d").alias("day")), ["k"], "day", "interval 1 day")
    assert full.count() == 40 * 732
    # Two rows a key would be merged into one partition before they become 732.
    assert full.select(F.spark_partition_id()).distinct().count() > 1


def test_days_of_bills_are_not_shuffled(spark):
    bills = spark.createDataFrame(
        [(1, "2020-01-01", "2020-01-04", 4.0, 1), (1, "2020-01-01", "2020-01-04", 8.0, 2), (1, "2020-01-03", "2020-01-03", 7.0, None),
         (2, "2020-01-01", "2020-01-02", 6.0, None), (2, "2020-01-05", "2020-01-04", 6.0, 3)],
        "k int, ini string, fin string, value double, bill_id int",
    )
    bills = bills.withColumns({"ini": F.to_date("ini"), "fin": F.to_date("fin")})
    days = clean.bill_days(bills, ["k"])
    found = {(r.k, r.day.day): (r.value, r.n_bills) for r in days.collect()}
    assert found == {(1, 1): (2.0, 2), (1, 2): (2.0, 2), (1, 3): (7.0, 3), (1, 4): (2.0, 2), (2, 1): (3.0, 1), (2, 2): (3.0, 1)}
    plan = days._jdf.queryExecution().sparkPlan().toString(), days._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan[0] and plan[1].index("Generate") < plan[1].index("Exchange")


def test_rounds_of_extreme_rates_read_the_input_once(spark, monkeypatch, tmp_path):
    rows = [(k, f"2020-01-{d:02d} {h:02d}:00:00", 900.0 if (d, h) in ((5, 3), (9, 7)) else 1.0 + h % 2) for k in (1, 2) for d in range(1, 15) for h in range(24)]
    rows += [(3, f"2020-01-01 {h:02d}:00:00", 1.0) for h in range(24)]
    path = str(tmp_path / "readings")
    spark.createDataFrame(rows, "k int, ts string, v double").withColumn("ts", F.to_timestamp("ts")).write.parquet(path)
    read, cut = [], clean.cut_lineage

    def watched(df):
        read.append(any(path in f for f in df.inputFiles()))
        return cut(df)

    monkeypatch.setattr(clean, "cut_lineage", watched)
    out = clean.remove_extreme_rates(spark.read.parquet(path), ["k"], "ts", "v", 3.0, F.trunc("ts", "month"))
    assert out.filter("v > 800").count() == 0 and out.count() == len(rows) - 4
    assert read[0] and not any(read[1:]) and len(read) >= 4


def test_costs_of_a_stored_table_are_not_broadcast(spark):
    from meterloom.functions.recovery import cut_lineage
    from meterloom.operators import compare

    rows = spark.range(2000).select((F.col("id") % 3).alias("g"), (F.col("id") % 7).cast("double").alias("v"))
    own = cut_lineage(rows)
    peers = own.groupBy("g").agg(F.avg("v").alias("mean"), F.stddev_samp("v").alias("disp"))
    cost = compare.group_cost(own, peers, ["g"], "v", "mean", "disp")
    assert "BroadcastHashJoin" not in cost._jdf.queryExecution().sparkPlan().toString()
    assert cost.count() == 2000


def test_rows_of_peer_groups_are_not_broadcast(spark, monkeypatch):
    from meterloom.functions.recovery import cut_lineage
    from meterloom.plans import compare_queries

    month = F.to_date(F.lit("2024-01-01")).alias("month")
    rows = spark.range(60).select(
        F.lit("type").alias("criteria"), (F.col("id") % 3).cast("string").alias("criteria_values"), F.lit("gas").alias("energy_type"),
        month, F.col("id").alias("unit"), F.col("id").cast("double").alias("per_area"), F.col("id").cast("double").alias("annual"),
    )
    stored = cut_lineage(rows)
    monkeypatch.setattr(compare_queries, "_rolling", lambda spark, folder: stored)
    out = compare_queries.j17(spark, "")
    assert "BroadcastHashJoin [criteria" not in out._jdf.queryExecution().sparkPlan().toString()
    assert out.count() == 60
