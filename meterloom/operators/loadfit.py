"""Iterative fits of the hourly load model, one unit per group; in the search, one slice of a unit's settings.

Only what SQL cannot say runs here: mixture fits on day profiles, regressions
whose lags feed on their own predictions.  A group is one unit on the hourly grid (two years are 17,520 rows).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterloom.functions.recovery import cut_lineage
from meterloom.functions.stats import t_limit, t_table
from meterloom.operators.loadmodel import VARIANCE_FLOOR

# Settings of the feature gate and ranges of the hyper-parameter search.
GATE = {"n": 1, "alpha_t": 0.05, "alpha_w": 0.05, "alpha_g": 0.05, "tbal": 20.0, "p": 15.0}
GATED = ["occupancy", "cooling", "heating", "ghi", "wind"]
MIN_ACTIVE_SHARE = 0.2
MAX_LAGS = 6
STEPS = 15
RANGES = {"alpha_t": (0.0, 0.5), "alpha_w": (0.0, 0.5), "alpha_g": (0.0, 0.5), "tbal": (16.0, 24.0), "p": (1.0, 30.0)}
# Steps of each range in the first table; later tables have all of them.
COARSE = {"alpha_t": (0, 7, 15), "alpha_w": (0, 7, 15), "alpha_g": (0, 7, 15), "tbal": (0, 7, 15), "p": (0, 5, 10, 15)}
# Terms that a parameter changes; without all of them it has no effect.
ACTS_ON = {
    "alpha_t": ("heating", "cooling"), "alpha_w": ("wind",), "alpha_g": ("ghi",), "tbal": ("heating", "cooling"),
    "p": ("cooling", "ghi", "wind"),
}
# Settings of a unit that one task fits.
SLICE = 16
HYPER = ["n", "alpha_t", "alpha_w", "alpha_g", "tbal", "p"]
COLUMNS = [
    "time", "day", "s", "dayhour", "occupancy", "log_value", "temperature", "wind_speed", "ghi", "wind_sector", "sun_label",
]


def _filtered(x: np.ndarray, alpha: float) -> np.ndarray:
    if alpha == 0 or len(x) == 0:
        return x
    out, y = np.empty(len(x)), np.nan
    for i, v in enumerate(x):
        y = v if np.isnan(y) else alpha * y + (1 - alpha) * v
        out[i] = y
    return out


def model_terms(pdf: pd.DataFrame, hyper: dict, groups: Sequence[str]) -> dict[str, np.ndarray]:
    """Regressor columns by name, without the lags."""
    temp = _filtered(pdf["temperature"].to_numpy(float), hyper["alpha_t"])
    wind = _filtered(pdf["wind_speed"].to_numpy(float), hyper["alpha_w"])
    sun = _filtered(pdf["ghi"].to_numpy(float), hyper["alpha_g"])
    flag = (pdf["occupancy"].to_numpy(float) >= hyper["p"]).astype(float)
    out = {}
    cell = pdf["s"].astype(str) + "|" + pdf["dayhour"].astype(str)
    for c in sorted(cell.unique()):
        out[f"cell|{c}"] = (cell == c).to_numpy(float)
    single = {
        "occupancy": pdf["occupancy"].to_numpy(float),
        "heating": np.maximum(hyper["tbal"] - temp, 0.0),
        "cooling": np.maximum(temp - hyper["tbal"], 0.0) * flag,
    }
    for name, column in single.items():
        if name in groups:
            out[name] = column
    for name, column, label in (("ghi", sun * flag, "sun_label"), ("wind", wind * flag, "wind_sector")):
        if name not in groups:
            continue
        out[name] = column
        # All levels: the fit leaves out the one that the others add up to, so no choice depends on the rows at hand.
        for level in sorted(pdf[label].unique()):
            out[f"{name}|{level}"] = column * (pdf[label] == level).to_numpy(float)
    return out


def lag_terms(pdf: pd.DataFrame, n: int) -> dict[str, np.ndarray]:
    """Lags 1..n separately for every cluster."""
    out = {}
    for s in sorted(pdf["s"].unique()):
        mine = (pdf["s"] == s).to_numpy(float)
        for k in range(1, n + 1):
            out[f"lag{k}|{s}"] = pdf[f"lag{k}"].to_numpy(float) * mine
    return out


def least_squares(terms: dict[str, np.ndarray], y: np.ndarray) -> pd.DataFrame:
    """Ordinary least squares; a column that adds nothing to the earlier ones is left out."""
    kept, basis = [], []
    for name, column in terms.items():
        norm = np.linalg.norm(column)
        rest = column.copy()
        for _ in range(2):
            if basis:
                q = np.column_stack(basis)
                rest = rest - q @ (q.T @ rest)
        left = np.linalg.norm(rest)
        if norm > 0 and left > 1e-7 * norm:
            kept.append(name)
            basis.append(rest / left)
    if not kept:
        return _with_rows(pd.DataFrame({"term": [], "coef": [], "se": []}), y)
    x, q = np.column_stack([terms[k] for k in kept]), np.column_stack(basis)
    coef = np.linalg.solve(q.T @ x, q.T @ y)
    free = len(y) - len(kept)
    sigma2 = float(np.sum((y - x @ coef) ** 2) / free) if free > 0 else np.nan
    inv = np.linalg.inv(q.T @ x)
    se = np.sqrt(sigma2 * np.sum(inv * inv, axis=1))
    return _with_rows(pd.DataFrame({"term": kept, "coef": coef, "se": se}), y)


def _with_rows(fit: pd.DataFrame, y: np.ndarray) -> pd.DataFrame:
    """Note the number of rows that entered the fit."""
    fit.attrs["rows"] = len(y)
    return fit


def _fit(pdf: pd.DataFrame, hyper: dict, groups: Sequence[str]) -> pd.DataFrame:
    rows = pdf.dropna(subset=["log_value", "occupancy", "temperature", "wind_speed", "ghi"] + [f"lag{k}" for k in range(1, int(hyper["n"]) + 1)])
    terms = model_terms(rows, hyper, groups)
    for name in ("heating", "cooling"):
        if name in terms and np.mean(terms[name] > 0) <= MIN_ACTIVE_SHARE:
            del terms[name]
    terms.update(lag_terms(rows, int(hyper["n"])))
    return least_squares(terms, rows["log_value"].to_numpy(float))


def gate_features(pdf: pd.DataFrame) -> list[str]:
    """Weather terms with at least one coefficient significant at 5 %."""
    fit = _fit(pdf, GATE, GATED)
    free = max(fit.attrs["rows"] - len(fit), 1)
    table = t_table(0.95)
    limit = table[free - 1] if free <= len(table) else t_limit(1.959963984540054, free)
    strong = fit[np.abs(fit["coef"]) >= limit * fit["se"]]["term"]
    return [g for g in GATED if any(t == g or t.startswith(g + "|") for t in strong)]


def predict_days(pdf: pd.DataFrame, fit: pd.DataFrame, hyper: dict, groups: Sequence[str]) -> np.ndarray:
    """Log prediction hour by hour; inside a day earlier predictions replace the lagged values."""
    coef = dict(zip(fit["term"], fit["coef"]))
    base = np.zeros(len(pdf))
    for name, column in model_terms(pdf, hyper, groups).items():
        base += coef.get(name, 0.0) * column
    n = int(hyper["n"])
    if n == 0:
        return base
    lags = np.column_stack([pdf[f"lag{k}"].to_numpy(float) for k in range(1, n + 1)])
    weight = np.array([[coef.get(f"lag{k}|{s}", 0.0) for k in range(1, n + 1)] for s in pdf["s"]])
    day = pdf["day"].to_numpy()
    out = np.empty(len(pdf))
    for i in range(len(pdf)):
        out[i] = base[i] + float(weight[i] @ lags[i])
        for k in range(1, min(n, len(pdf) - 1 - i) + 1):
            if day[i + k] != day[i]:
                break
            lags[i + k, k - 1] = out[i]
    return out


def _r2(actual: np.ndarray, pred: np.ndarray) -> float:
    ok = np.isfinite(actual) & np.isfinite(pred)
    if ok.sum() < 3 or np.std(actual[ok]) == 0 or np.std(pred[ok]) == 0:
        return -1.0
    r2 = float(np.corrcoef(actual[ok], pred[ok])[0, 1] ** 2)
    return r2 if np.isfinite(r2) else -1.0


def _parts(pdf: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Training and validation rows in the order of time."""
    pdf = pdf.sort_values("time").reset_index(drop=True)
    return pdf[pdf["train"]].reset_index(drop=True), pdf[~pdf["train"]].reset_index(drop=True)


def score_setting(train: pd.DataFrame, val: pd.DataFrame, hyper: dict, groups: Sequence[str]) -> float:
    """Squared correlation on the validation rows, or on the training rows if there are none."""
    head = train if val.empty else val
    fit = _fit(train, hyper, groups)
    return _r2(np.exp(head["log_value"].to_numpy(float)), np.exp(predict_days(head, fit, hyper, groups)))


def _names(groups: str) -> list[str]:
    return [g for g in groups.split(",") if g]


def feature_groups(rows: DataFrame, key: str) -> DataFrame:
    """Kept weather terms (``groups``) of every unit with training rows."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        train, _ = _parts(pdf)
        return pd.DataFrame({key: pdf[key].iloc[:1], "groups": [",".join(gate_features(train))]})

    return rows.filter("train").groupBy(key).applyInPandas(run, f"{key} string, groups string")


def steps_of(name: str) -> list[float]:
    low, high = RANGES[name]
    return [low + (high - low) * i / STEPS for i in range(STEPS + 1)]


def _acts(name: str):
    """Whether a parameter has an effect on the unit's terms."""
    return F.arrays_overlap(F.split("groups", ","), F.array(*[F.lit(g) for g in ACTS_ON[name]])) if name in ACTS_ON else F.lit(True)


def coarse_settings(units: DataFrame, lags: int) -> DataFrame:
    """Every unit with the settings of a coarse grid over all ranges; a parameter without effect stays at its lowest value."""
    out = units.withColumn("n", F.explode(F.array(*[F.lit(float(n)) for n in sorted({0, min(lags, 1), lags // 2, lags})])))
    for name, places in COARSE.items():
        values = [steps_of(name)[i] for i in places]
        column = F.when(_acts(name), F.array(*map(F.lit, values))).otherwise(F.array(F.lit(values[0])))
        out = out.withColumn(name, F.explode(column))
    return out


def line_settings(best: DataFrame, lags: int) -> DataFrame:
    """Around each unit's best setting: every step of each parameter, with the others kept."""
    values = {"n": [float(n) for n in range(lags + 1)], **{name: steps_of(name) for name in RANGES}}
    moves = [F.struct(F.lit(name).alias("name"), F.lit(v).alias("value")) for name, all_ in values.items() for v in all_]
    rows = best.withColumn("move", F.explode(F.array(*moves)))
    useful = F.lit(False)
    for name in HYPER:
        useful |= (F.col("move.name") == name) & _acts(name) & (F.col("move.value") != F.col(name))
    moved = {h: F.when(F.col("move.name") == h, F.col("move.value")).otherwise(F.col(h)) for h in HYPER}
    return rows.filter(useful).select(*[c for c in best.columns if c not in (*HYPER, "score")], *[moved[h].alias(h) for h in HYPER])


def score_settings(rows: DataFrame, settings: DataFrame, key: str) -> DataFrame:
    """``settings`` (key, groups, parameters) with their ``score``.

    A unit's rows go to one group for about ``SLICE`` of its settings, so that the work of a group does not grow with the table.
    """
    many = settings.groupBy(key).agg(F.ceil(F.count("*") / SLICE).alias("slices"))
    sliced = settings.join(many, key).withColumn("slice", F.pmod(F.xxhash64(*HYPER), F.col("slices")).cast("int")).drop("slices")
    needed = sliced.select(F.col(key).alias("of"), F.col("slice").alias("copy")).distinct()
    copies = rows.join(needed, F.col(key) == F.col("of")).drop("of")
    schema = f"{key} string, groups string, " + ", ".join(f"{h} double" for h in HYPER) + ", score double"

    def run(pdf: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty or table.empty:
            return pd.DataFrame(columns=[key, "groups", *HYPER, "score"])
        train, val = _parts(pdf)
        scores = [score_setting(train, val, h, _names(g)) for h, g in zip(table[HYPER].to_dict("records"), table["groups"], strict=True)]
        return table[[key, "groups", *HYPER]].assign(score=scores)

    return copies.groupBy(key, "copy").cogroup(sliced.groupBy(key, "slice")).applyInPandas(run, schema)


def best_settings(scores: DataFrame, key: str) -> DataFrame:
    """The setting with the highest score; of equal ones that with the lowest values."""
    order = F.struct("score", *[(-F.col(h)).alias(h) for h in HYPER])
    best = F.max_by(F.struct("groups", *HYPER, "score"), order)
    return scores.groupBy(key).agg(best.alias("best")).select(key, "best.*")


def search_settings(rows: DataFrame, units: DataFrame, key: str, lags: int = MAX_LAGS) -> DataFrame:
    """Best setting of every unit: a coarse grid over all ranges, then lines through the best one for as long as a unit gains.

    ``rows`` and ``units`` are read in every round: pass stored tables.  A round raises the score of its units on a finite
    grid, so the loop ends.
    """
    best = moving = cut_lineage(best_settings(score_settings(rows, cut_lineage(coarse_settings(units, lags)), key), key))
    while not moving.isEmpty():
        found = best_settings(score_settings(rows, cut_lineage(line_settings(moving, lags)), key), key)
        old = moving.select(F.col(key).alias("of"), F.col("score").alias("old"))
        moving = cut_lineage(found.join(old, F.col(key) == F.col("of")).filter("score > old").select(best.columns))
        best = cut_lineage(best.join(moving, key, "left_anti").unionByName(moving))
    return best


def train_models(features: DataFrame, key: str, grid: Sequence[dict] | None = None, lags: int = MAX_LAGS) -> DataFrame:
    """Coefficient table of every unit's log-linear model: gate the features, search the settings, fit.

    Without a ``grid`` of settings all ranges are searched, with up to ``lags`` lags.
    """
    if grid is not None:
        lags = int(max(h["n"] for h in grid))
    cols = [key, *COLUMNS, "train", *[f"lag{k}" for k in range(1, max(lags, 1) + 1)]]
    rows = cut_lineage(features.select(*cols))
    units = cut_lineage(feature_groups(rows, key))
    if grid is None:
        best = search_settings(rows, units, key, lags)
    else:
        table = F.array(*[F.struct(*[F.lit(float(h[c])).alias(c) for c in HYPER]) for h in grid])
        settings = units.withColumn("h", F.explode(table)).select(key, "groups", "h.*").distinct()
        best = cut_lineage(best_settings(score_settings(rows, cut_lineage(settings), key), key))
    schema = (
        f"{key} string, term string, coef double, se double, "
        + ", ".join(f"{h} double" for h in HYPER)
        + ", groups string, score double"
    )
    names = [c.split()[0] for c in schema.split(", ")]

    def run(pdf: pd.DataFrame, chosen: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty or chosen.empty:
            return pd.DataFrame(columns=names)
        one = chosen.iloc[0]
        fit = _fit(_parts(pdf)[0], {h: float(one[h]) for h in HYPER}, _names(one["groups"]))
        return fit.assign(**{c: one[c] for c in (key, *HYPER, "groups", "score")})[names]

    return rows.groupBy(key).cogroup(best.groupBy(key)).applyInPandas(run, schema)


def predict_models(features: DataFrame, models: DataFrame, key: str, lags: int) -> DataFrame:
    """Apply the stored coefficients to a window, hour after hour within each day."""
    schema = f"{key} string, time timestamp, prediction double"

    def run(rows: pd.DataFrame, fit: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or fit.empty:
            return pd.DataFrame({key: [], "time": [], "prediction": []})
        rows = rows.sort_values("time").reset_index(drop=True)
        hyper = {h: float(fit[h].iloc[0]) for h in HYPER}
        groups = _names(str(fit["groups"].iloc[0]))
        pred = np.exp(predict_days(rows, fit, hyper, groups))
        return pd.DataFrame({key: rows[key], "time": rows["time"], "prediction": pred})

    cols = [key, *COLUMNS, *[f"lag{k}" for k in range(1, lags + 1)]]
    return (
        features.select(*cols).groupBy(key).cogroup(models.groupBy(key)).applyInPandas(run, schema)
    )


# --- mixture of day profiles ---------------------------------------------------------

def _mixture(z: np.ndarray, start: np.ndarray, k: int, spherical: bool, rounds: int = 200):
    """Expectation-maximisation of k diagonal (or spherical) normal clusters."""
    n, d = z.shape
    resp = np.eye(k)[start]
    last = -np.inf
    for _ in range(rounds):
        size = resp.sum(axis=0)
        if (size < 1.0).any():
            return None
        mean = (resp.T @ z) / size[:, None]
        var = np.maximum((resp.T @ (z * z)) / size[:, None] - mean**2, VARIANCE_FLOOR)
        if spherical:
            var = np.repeat(var.mean(axis=1, keepdims=True), d, axis=1)
        weight = size / n
        logp = np.log(weight) - 0.5 * (
            np.log(2 * np.pi * var).sum(axis=1) + ((z[:, None, :] - mean) ** 2 / var).sum(axis=2)
        )
        top = logp.max(axis=1, keepdims=True)
        norm = top + np.log(np.exp(logp - top).sum(axis=1, keepdims=True))
        resp = np.exp(logp - norm)
        total = float(norm.sum())
        if total - last < 1e-8 * abs(total):
            break
        last = total
    n_params = k * d + (k if spherical else k * d) + k - 1
    return 2 * total - n_params * np.log(n), mean, var, weight


def fit_mixture(pdf: pd.DataFrame, hours: list[str], ks: Sequence[int]) -> pd.DataFrame:
    """Best mixture by information criterion; starts from quantiles of the day totals."""
    pdf = pdf.dropna(subset=hours).sort_values(["total", "day"])
    z, best = pdf[hours].to_numpy(float), None
    for k in ks:
        if len(z) < 2 * k:
            continue
        start = np.minimum(np.arange(len(z)) * k // len(z), k - 1)
        for spherical in (False, True):
            found = _mixture(z, start, k, spherical)
            if found and (best is None or found[0] > best[0]):
                best = found
    if best is None:
        return pd.DataFrame(columns=["s", "dayhour", "mean", "variance", "weight"])
    _, mean, var, weight = best
    return pd.DataFrame(
        [
            {"s": str(c + 1), "dayhour": h, "mean": mean[c, h], "variance": var[c, h], "weight": weight[c]}
            for c in range(len(weight))
            for h in range(24)
        ]
    )


def train_clusters(profiles: DataFrame, key: str, ks: Sequence[int] = (2, 3, 4)) -> DataFrame:
    """Cluster parameters per unit from day rows (key, day, total, h0..h23)."""
    hours = [f"h{h}" for h in range(24)]
    schema = f"{key} string, s string, dayhour int, mean double, variance double, weight double"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = fit_mixture(pdf, hours, ks)
        return out.assign(**{key: pdf[key].iloc[0]})[[key, "s", "dayhour", "mean", "variance", "weight"]]

    return profiles.select(key, "day", "total", *hours).groupBy(key).applyInPandas(run, schema)


def training_days(day: str, share: int = 80):
    """Stable split: about ``share`` percent of the days train."""
    return F.pmod(F.crc32(F.col(day).cast("string")), F.lit(100)) < share
