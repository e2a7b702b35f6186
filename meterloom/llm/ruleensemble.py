"""Quality classifier: a sparse ensemble of rules over text statistics.

Shallow random trees are fitted on labelled documents; every path from a root is a conjunctive rule.  A logistic
regression with a lasso penalty weighs the rules, most of them with 0.  The rules left are compiled into one Spark column
expression, so scoring is a projection.

The fit uses at most about ``MAX_ROWS`` labelled rows, chosen by a hash of the id; scoring covers every row.

Defined results: null and empty texts have statistics of 0 and a score like any other; without labels of both classes
every score is the share of label 1 (0.5 without labels); rows that repeat an id are scored apart; null ids are never
learned from; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom.llm import store
from meterloom.llm.textstats import STATS, text_stats

MAX_ROWS = 20_000
TREES = 24
DEPTH = 3
LASSO = 0.002
SEED = 11
THRESHOLD = 0.3

Rule = tuple[tuple[str, float, float], ...]  # (statistic, above, up to)


@dataclass
class Ensemble:
    rules: list[tuple[Rule, float]]
    intercept: float

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(holds(rule), weight).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def holds(rule: Rule) -> Column:
    out = F.lit(True)
    for name, low, high in rule:
        if low != float("-inf"):
            out = out & (F.col(name) > low)
        if high != float("inf"):
            out = out & (F.col(name) <= high)
    return out


def bounded(labels: DataFrame, id_col: str, most: int, seed: int) -> DataFrame:
    """About ``most`` rows at the most, by a hash of the id; all rows if there are not more."""
    n = labels.count()
    if n <= most:
        return labels
    return labels.filter(F.pmod(F.xxhash64(id_col, F.lit(seed)), F.lit(1 << 30)) < int(most / n * (1 << 30)))


def sample(docs: DataFrame, labels: DataFrame, label: str, most: int = MAX_ROWS, seed: int = SEED) -> DataFrame:
    """Labelled documents: the columns of ``docs`` and ``label`` as a double."""
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    known = bounded(known.groupBy("doc_id").agg(F.max(label).cast("double").alias("label")), "doc_id", most, seed)
    return docs.join(F.broadcast(known), "doc_id")


def paths(model) -> list[Rule]:
    """Every path of the trees as a rule with one interval for a statistic, without repeats."""
    found: dict[Rule, None] = {}

    def walk(at, bounds: dict[int, tuple[float, float]]) -> None:
        if bounds:
            found[tuple((STATS[k], *v) for k, v in sorted(bounds.items()))] = None
        if at.subtreeDepth() == 0:
            return
        k, cut = at.split().featureIndex(), float(at.split().threshold())
        low, high = bounds.get(k, (float("-inf"), float("inf")))
        walk(at.leftChild(), bounds | {k: (low, min(high, cut))})
        walk(at.rightChild(), bounds | {k: (max(low, cut), high)})

    for tree in model.trees:
        walk(tree._java_obj.rootNode(), {})
    return list(found)


def fit(stats: DataFrame, seed: int = SEED) -> Ensemble:
    """``stats`` has :data:`STATS` and ``label``."""
    # The statistics are taken by many tasks; the bounded sample then lies in one sorted file, so fits repeat.
    rows = stats.select(*STATS, "label").repartition(1).sortWithinPartitions(*STATS, "label")
    rows = store.stored(rows, "sample")
    n, ones = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not 0 < ones < n:
        share = ones / n if n else 0.5
        odds = min(max(share, 1e-6), 1 - 1e-6)
        return Ensemble([], _logit(odds) if n else 0.0)
    vectors = VectorAssembler(inputCols=STATS, outputCol="x").transform(rows).select("x", "label", *STATS)
    forest = RandomForestClassifier(
        featuresCol="x", labelCol="label", numTrees=TREES, maxDepth=DEPTH, featureSubsetStrategy="onethird", seed=seed
    ).fit(vectors)
    rules = paths(forest)
    marks = rows.select("label", *[holds(r).cast("double").alias(f"r{i}") for i, r in enumerate(rules)])
    marks = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="x").transform(marks)
    marks = store.stored(marks.select("x", "label"), "marks")
    lasso = LogisticRegression(featuresCol="x", labelCol="label", elasticNetParam=1.0, regParam=LASSO, maxIter=100)
    model = lasso.fit(marks)
    weights = [(r, float(w)) for r, w in zip(rules, model.coefficients.toArray(), strict=True) if w]
    return Ensemble(weights, float(model.intercept))


def _logit(p: float) -> float:
    from math import log

    return log(p / (1 - p))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> Ensemble:
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return fit(text_stats(sample(rows, labels, label), also=("label",)))


def score(docs: DataFrame, model: Ensemble, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``score``, ``predicted`` of every row."""
    out = text_stats(docs, id_col, text_col).select("doc_id", model.score().alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, model: Ensemble, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    names = docs.columns
    held = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    at = f"c{names.index(text_col)}"
    stats = text_stats(held, at, at, tuple(held.columns)).filter(model.score() >= threshold)
    return stats.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
