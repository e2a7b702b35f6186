"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton over folded text.

Folding lower-cases, maps homoglyphs to Latin letters and undoes digits and signs put for letters.  Where they may stand for
letters or not (``@loser``, ``@ss``), or for one of two (``kil1``), a word is read in each way and counts once.  An entry is the
beginning of a word; matches inside an exception phrase do not count.  A text's density is the sum of the weights of its
matches for 100 words, and the score is a logistic function of its logarithm.

Entries, weights and exceptions are learned from about ``MAX_ROWS`` labelled rows at the most, chosen by a hash of the id;
scoring covers every row and the whole text.

Defined results: null and empty texts have density 0 and the score of a text without a match; without toxic labels
the lexicon is empty and every score is the share of toxic labels (0.5 without labels); rows that repeat an id are scored
apart; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom.llm import store
from meterloom.llm.ruleensemble import bounded

MAX_ROWS = 20_000
SEED = 13
THRESHOLD = 0.3
MIN_DOCS = 5
MIN_WEIGHT = 3.0
ENTRY_LENGTHS = range(3, 13)
FLOOR = 0.01

# Letters of other scripts that look like Latin ones, fixed values.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ӏ": "l",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
}
# Digits and signs put for letters, fixed values.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l"}

_LOOKS = str.maketrans(HOMOGLYPHS)
_PUT = str.maketrans(SUBSTITUTES)
_GAP = re.compile(r"[\W_]+")
# Other readings of a word: signs before it and digits behind it count too, and 1, ! and | are each i or l.
_WAYS = [str.maketrans(SUBSTITUTES | {"1": x, "!": x, "|": x}) for x in "il"]
_ODD = re.compile(r"[@$!|][^\W_]|[^\W\d_][\d@$!|]|\d[^\W\d_]")
_RUN = re.compile(r"(?:[^\W_]|[@$!|])*")
_NOT_RUN = re.compile(r"[^\w@$!|]|_")
# A digit or sign between letters, or digits before a letter, after signs.
_BETWEEN = re.compile(r"[^\W\d_][\d@$!|]++[^\W\d_]|^[@$!|]*+\d++[^\W\d_]")
_SIGNS = "@$!|"


def _plain(text: str) -> str:
    text = text.lower()
    return text if text.isascii() else unicodedata.normalize("NFKC", text).translate(_LOOKS)


def _spaced(text: str) -> str:
    return " " + _GAP.sub(" ", text).strip() + " "


def _odd_runs(plain: str) -> Iterator[tuple[int, int]]:
    """Runs of letters, digits and signs in which a letter stands next to a digit or a sign.

    Each run is walked through once, so a word of any length takes time in proportion to it.
    """
    at = 0
    while odd := _ODD.search(plain, at):
        start = odd.start()
        while start > at and not _NOT_RUN.match(plain, start - 1):
            start -= 1
        at = _RUN.match(plain, odd.end()).end()
        yield start, at


def _folded(run: str) -> str:
    if not _BETWEEN.search(run):
        return run
    core = run.strip(_SIGNS)
    start = run.index(core)
    return run[:start] + core.translate(_PUT) + run[start + len(core) :]


def _read(run: str, way: dict[int, str]) -> str:
    """Signs ``!`` and ``|`` at the end of a word are punctuation."""
    word = run.rstrip("!|")
    return word.translate(way) + run[len(word) :] if any(c.isalpha() for c in word) else run


def _replaced(plain: str, runs: list[tuple[int, int]], new: list[str]) -> str:
    parts, last = [], 0
    for (a, b), word in zip(runs, new, strict=True):
        parts += (plain[last:a], word)
        last = b
    return "".join([*parts, plain[last:]])


def readings(text: str) -> list[str]:
    """:func:`fold` and the other readings that differ from it."""
    plain = _plain(text)
    runs = list(_odd_runs(plain))
    words = [plain[a:b] for a, b in runs]
    base = [_folded(w) for w in words]
    out = [_spaced(_replaced(plain, runs, base))]
    for way in _WAYS:
        read = [_read(w, way) for w in words]
        if read != base:
            other = _spaced(_replaced(plain, runs, read))
            if other not in out:
                out.append(other)
    return out


def fold(text: str) -> str:
    """Words of letters, each behind one space, and a space at the end."""
    plain = _plain(text)
    runs = list(_odd_runs(plain))
    return _spaced(_replaced(plain, runs, [_folded(plain[a:b]) for a, b in runs]))


@dataclass
class Lexicon:
    entries: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    slope: float = 0.0
    intercept: float = 0.0

    def score(self, density: Column) -> Column:
        z = F.lit(self.intercept) + F.lit(self.slope) * F.log(density + FLOOR)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


class Matcher:
    """Automaton of a lexicon; built once in a task."""

    def __init__(self, lexicon: Lexicon):
        self.automaton = ahocorasick.Automaton()
        for entry, weight in lexicon.entries.items():
            self.automaton.add_word(" " + entry, (len(entry) + 1, weight))
        for phrase in lexicon.exceptions:
            self.automaton.add_word(fold(phrase), (len(fold(phrase)), None))
        self.empty = not len(self.automaton)
        if not self.empty:
            self.automaton.make_automaton()

    def density(self, text: str | None) -> tuple[float, int]:
        """Weight for 100 words, and number of matches."""
        if not text or self.empty:
            return 0.0, 0
        ways = readings(text)
        found = self._hits(ways[0])
        weights = [h[1] for h in found]
        if len(ways) > 1:
            # A word counts in the first reading that has it.
            taken = set(self._words(ways[0], found))
            for folded in ways[1:]:
                more = self._hits(folded)
                at = self._words(folded, more)
                weights += [h[1] for h, word in zip(more, at, strict=True) if word not in taken]
                taken |= set(at)
        words = max(1, ways[0].count(" ") - 1)
        return 100.0 * sum(weights) / words, len(weights)

    def _hits(self, folded: str) -> list[tuple[int, float]]:
        """Place and weight of the matches outside exception phrases."""
        hits, spared = [], []
        for end, (length, weight) in self.automaton.iter(folded):
            (spared if weight is None else hits).append((end - length + 1, end, weight))
        if spared:
            # One sweep: of the phrases that begin at or before a match, does the farthest reach behind it?
            spared.sort(key=lambda h: h[0])
            hits.sort(key=lambda h: h[0])
            left, at, reach = [], 0, -1
            for hit in hits:
                while at < len(spared) and spared[at][0] <= hit[0]:
                    reach, at = max(reach, spared[at][1]), at + 1
                if reach < hit[1]:
                    left.append(hit)
            hits = left
        return [(h[0], h[2]) for h in hits]

    @staticmethod
    def _words(folded: str, hits: list[tuple[int, float]]) -> list[int]:
        """Number of the word of each match."""
        out, last, n = [], 0, 0
        for place, _ in hits:
            n += folded.count(" ", last, place) if place >= last else -folded.count(" ", place, last)
            last = place
            out.append(n)
        return out


def densities(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text", also: tuple[str, ...] = ()) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("doc_id"), *also, F.col(text_col).alias("text"))
    schema = rows.drop("text").schema.add("density", "double", False).add("matches", "long", False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon)
        for batch in batches:
            found = [matcher.density(t.as_py()) for t in batch.column(batch.num_columns - 1)]
            columns = [*batch.columns[:-1], pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)


def _beginnings(text: str | None) -> set[str]:
    words = {w for way in readings(text or "") for w in way.split()}
    return {w[:n] for w in words for n in ENTRY_LENGTHS if n <= len(w)} | {w + " " for w in words if len(w) >= 3}


def _phrases(text: str | None) -> set[str]:
    words = fold(text or "").split()
    return {f"{a} {b}" for a, b in zip(words, words[1:], strict=False)}


def _counted(rows: DataFrame, items) -> DataFrame:
    """Documents and toxic documents of each item, combined in each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter = Counter()
        bad: Counter = Counter()
        for batch in batches:
            for label, text in zip(batch["label"].to_pylist(), batch["text"].to_pylist(), strict=True):
                found = items(text)
                n.update(found)
                if label:
                    bad.update(found)
            if len(n) > 300_000:
                yield _table(n, bad)
                n, bad = Counter(), Counter()
        yield _table(n, bad)

    return (
        rows.mapInArrow(run, "item string, n bigint, bad bigint")
        .groupBy("item")
        .agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    )


def _table(n: Counter, bad: Counter) -> pa.RecordBatch:
    keys = list(n)
    columns = [pa.array(keys, pa.string()), pa.array([n[k] for k in keys], pa.int64()), pa.array([bad[k] for k in keys], pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["item", "n", "bad"])


def shortest(weights: Iterable[tuple[str, float]]) -> dict[str, float]:
    """Entries without those that only extend another one."""
    kept: dict[str, float] = {}
    for entry, weight in sorted(weights, key=lambda x: (len(x[0]), x[0])):
        if not any(entry[:n] in kept for n in range(1, len(entry))):
            kept[entry] = weight
    return kept


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", exceptions: Iterable[str] = (), most: int = MAX_ROWS) -> Lexicon:
    """Learn from ``labels`` (``doc_id`` and ``label``) of ``docs`` (``doc_id``, ``text``)."""
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max(label).cast("double").alias("label"))
    known = bounded(known, "doc_id", most, SEED)
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("doc_id", "label", "text")
    rows = store.stored(rows, "labelled")
    n, bad = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not 0 < bad < n:
        share = min(max(bad / n, 1e-6), 1 - 1e-6) if n else 0.5
        return Lexicon(intercept=math.log(share / (1 - share)))
    weight = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("n") - F.col("bad") + 0.5) / (n - bad + 1))
    good = _counted(rows, _beginnings).withColumn("weight", weight)
    good = good.filter((F.col("bad") >= MIN_DOCS) & (F.col("weight") >= MIN_WEIGHT))
    # The sample is bounded, and so are these.
    found = good.select("item", "weight").collect()
    entries = shortest((r["item"], r["weight"]) for r in found)
    lexicon = Lexicon(entries, list(exceptions))
    if not entries:
        return Lexicon(intercept=math.log(bad / (n - bad)))
    # A pair of words with an entry that only harmless documents have is an exception.
    has_entry = lambda text: {p for p in _phrases(text) if any(w[:k] in entries for w in p.split() for k in range(3, len(w) + 1))}
    spared = _counted(rows, has_entry).filter((F.col("bad") == 0) & (F.col("n") >= MIN_DOCS))
    lexicon.exceptions += [r["item"] for r in spared.orderBy(F.desc("n"), "item").collect()]
    points = densities(rows, lexicon, also=("label",)).select("label", F.log(F.col("density") + FLOOR).alias("z"))
    points = VectorAssembler(inputCols=["z"], outputCol="x").transform(points)
    points = store.stored(points.select("x", "label", "z").repartition(1).sortWithinPartitions("label", "z"), "points")
    model = LogisticRegression(featuresCol="x", labelCol="label", regParam=1e-4, maxIter=100).fit(points)
    lexicon.slope, lexicon.intercept = float(model.coefficients[0]), float(model.intercept)
    return lexicon


def score(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``score``, ``predicted``, ``density``, ``matches`` of every row."""
    out = densities(docs, lexicon, id_col, text_col)
    out = out.withColumn("score", lexicon.score(F.col("density")))
    return out.select("doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "density", "matches")
