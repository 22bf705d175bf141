"""Text quality by a sparse ensemble of rules over statistics of a text.

A random forest over the statistics of labelled documents gives paths; each path from a
root is a rule, a conjunction of comparisons. Logistic regression with an L1 penalty keeps
few rules. The result is a column expression: Spark computes statistics and score in one
scan, without Python.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanweave.llm.common import fold, labelled_sample, ship, unused
from loanweave.sources.staging import staged

#: Labelled documents to learn from, at most.
SAMPLE = 20_000
TREES, DEPTH, PENALTY = 16, 3, 0.001
#: Most Newton steps and sweeps over the weights in each, and change at which they end.
NEWTON_STEPS, SWEEPS, TOLERANCE = 25, 200, 1e-9
_TMP = "_quality"


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _statistics(text: Column, column: str) -> tuple[Column, dict[str, Column]]:
    """Parts of a text that several statistics need (a struct), and statistics over that struct."""
    plain = F.coalesce(text, F.lit(""))
    parts = F.struct(
        plain.alias("text"),
        F.filter(F.split(F.translate(plain, "\n\t\r", "   "), " "), lambda w: w != "").alias("words"),
        F.filter(F.split(plain, "\n"), lambda line: line != "").alias("lines"),
    )
    p = F.col(column)
    n = F.greatest(F.size(p["words"]), F.lit(1))
    chars = F.greatest(F.length(p["text"]), F.lit(1))
    upper, marks = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "#$%&*"
    stats = {
        "log_words": F.log(n),
        "word_length": F.length(p["text"]) / n,
        "distinct_words": F.size(F.array_distinct(p["words"])) / n,
        "distinct_lines": F.size(F.array_distinct(p["lines"])) / F.greatest(F.size(p["lines"]), F.lit(1)),
        "lines_per_word": F.size(p["lines"]) / n,
        "bars": _count(p["text"], "|<>") / n,
        "marks": _count(p["text"], marks) / n,
        "bangs": _count(p["text"], "!?") / n,
        "upper": _count(p["text"], upper) / chars,
        "digits": _count(p["text"], "0123456789") / chars,
        "stops": _count(p["text"], ".,;:") / n,
    }
    return parts, {k: v.cast("double") for k, v in stats.items()}


STATISTICS = (
    "log_words", "word_length", "distinct_words", "distinct_lines", "lines_per_word", "bars", "marks", "bangs", "upper", "digits", "stops",
)


def with_statistics(df: DataFrame, text: Column, column: str = _TMP) -> DataFrame:
    """``df`` with a struct column of statistics."""
    parts, stats = _statistics(text, column)
    return df.withColumn(column, parts).withColumn(column, F.struct(*[stats[k].alias(k) for k in STATISTICS]))


@dataclass(frozen=True)
class Test:
    feature: int
    below: bool  # feature <= value, else feature > value
    value: float

    def sql(self, column: str) -> str:
        return f"`{column}`.{STATISTICS[self.feature]} {'<=' if self.below else '>'} {self.value!r}D"


Rule = tuple[Test, ...]
_TEST = re.compile(r"^( *)(?:If|Else) \(feature (\d+) (<=|>) ([-0-9.Ee]+)\)$")


def paths(tree: str) -> list[Rule]:
    """All paths from the root of a printed tree, one rule for each node below it."""
    found, open_tests = [], []
    for line in tree.splitlines():
        m = _TEST.match(line)
        if m:
            depth = len(m[1])
            open_tests = [(d, t) for d, t in open_tests if d < depth]
            open_tests.append((depth, Test(int(m[2]), m[3] == "<=", float(m[4]))))
            found.append(tuple(sorted({t for _, t in open_tests}, key=repr)))
    return found


def _holds(rule: Rule, column: str = _TMP) -> str:
    return " AND ".join(test.sql(column) for test in rule)


@dataclass(frozen=True)
class RuleEnsemble:
    intercept: float
    weights: tuple[tuple[Rule, float], ...]

    def score(self, column: str = _TMP) -> Column:
        """Probability of label 1, over a frame with that column of statistics. Compiled from one text,
        so that the driver holds no object for each comparison."""
        margin = " + ".join([f"{self.intercept!r}D", *(f"IF({_holds(rule, column)}, {weight!r}D, 0D)" for rule, weight in self.weights)])
        return F.expr(f"1D / (1D + exp(-({margin})))")


def _minimize(fired: np.ndarray, n: np.ndarray, ones: np.ndarray) -> tuple[float, np.ndarray]:
    """Intercept and weights of the least mean log loss plus ``PENALTY`` times the weights' sizes,
    each rule counted in units of its standard deviation.

    Rows are distinct combinations of rules that fire, ``n`` times each, ``ones`` of them with
    label 1. Newton steps on the loss; within each, one weight after the other is set exactly.
    """
    share = n / n.sum()
    mean = share @ fired
    deviation = np.sqrt(np.maximum(share @ fired**2 - mean**2, 0))
    used = np.flatnonzero(deviation > 0)
    x = (fired[:, used] - mean[used]) / deviation[used]
    y = ones / n
    start = share @ y
    intercept, weights = math.log(start / (1 - start)), np.zeros(len(used))
    for _ in range(NEWTON_STEPS):
        margin = np.clip(intercept + x @ weights, -30, 30)
        p = 1 / (1 + np.exp(-margin))
        curve = np.maximum(p * (1 - p), 1e-5)
        pull = share * curve
        rest = (y - p) / curve  # of the quadratic that touches the loss here, at the weights so far
        square, old = pull @ x**2, weights.copy()
        for _ in range(SWEEPS):
            moved = 0.0
            for j in range(len(used)):
                want = weights[j] * square[j] + (pull * rest) @ x[:, j]
                new = math.copysign(max(abs(want) - PENALTY, 0.0), want) / square[j]
                if new != weights[j]:
                    rest -= (new - weights[j]) * x[:, j]
                    moved = max(moved, square[j] * (new - weights[j]) ** 2)
                    weights[j] = new
            step = (pull @ rest) / pull.sum()
            intercept += step
            rest -= step
            if moved < TOLERANCE:
                break
        if np.abs(weights - old).max(initial=0) < TOLERANCE**0.5:
            break
    out = np.zeros(fired.shape[1])
    out[used] = weights / deviation[used]
    return float(intercept - out @ mean), out


def _lasso(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weights by rule, the intercept as rule -1."""
    rows = pa.Table.from_batches(batches).combine_chunks()
    fired = np.array([list(f) for f in rows.column("fired").to_pylist()]) == "1"
    intercept, weights = _minimize(fired.astype(np.float64), rows.column("n").to_numpy().astype(float), rows.column("ones").to_numpy())
    yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(weights))), pa.array([intercept, *weights])], ["rule", "weight"])


def fit(sample: DataFrame) -> RuleEnsemble:
    """Learns from ``text`` and ``label``. Without rows of both labels, the score is the
    smoothed share of label 1 (0.5 if there is nothing at all)."""
    ship(sample.sparkSession)
    with staged(with_statistics(sample, F.col("text")).select(_TMP, "label"), "quality-sample") as known:
        counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
        ones, rows = counts.get(1.0, 0), sum(counts.values())
        if len(counts) < 2:
            share = (ones + 1) / (rows + 2)
            return RuleEnsemble(math.log(share / (1 - share)), ())
        vectors = known.coalesce(4).select("label", array_to_vector(F.array(*[f"{_TMP}.{s}" for s in STATISTICS])).alias("features"))
        forest = RandomForestClassifier(
            numTrees=TREES, maxDepth=DEPTH, maxBins=64, minInstancesPerNode=5, featureSubsetStrategy="0.5", seed=17
        ).fit(vectors)
        rules = list(dict.fromkeys(r for tree in forest.trees for r in paths(tree.toDebugString)))
        if not rules:
            rules = [(Test(0, True, 0.0),)]
        # At most as many combinations of rules as sampled rows, mostly far fewer: one task fits them.
        fired = F.expr("concat(" + ", ".join(f"IF({_holds(r)}, '1', '0')" for r in rules) + ")")
        kinds = known.groupBy(fired.alias("fired")).agg(F.count("*").alias("n"), F.sum("label").alias("ones"))
        found = {r["rule"]: r["weight"] for r in kinds.coalesce(1).mapInArrow(_lasso, "rule long, weight double").collect()}
    return RuleEnsemble(found[-1], tuple((rule, found[i]) for i, rule in enumerate(rules) if found[i] != 0.0))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All rows and columns of ``docs`` with ``held_out``, ``score`` and ``predicted``.

    Learns from labelled documents whose CRC32 of the id modulo 3 is not 1 (at most
    ``SAMPLE`` of them); the others are held out. Only the text is an input.

    - NULL or empty text: scored like any other, by statistics that are all 0 or 1.
    - Repeated rows: each is scored. No documents: no rows. No labels: all scores are 0.5.
    - Columns of ``docs`` named like the added ones (in any case) are replaced.
    """
    model = fit(labelled_sample(docs, labels, "quality", fold(F.col("doc_id"), 3) != 1, SAMPLE))
    added, column = ("held_out", "score", "predicted"), unused(docs, _TMP)
    keep = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in added])
    scored = with_statistics(keep, F.col("text"), column).withColumn("score", model.score(column))
    return scored.withColumns(
        {"held_out": fold(F.col("doc_id"), 3) == 1, "predicted": (F.col("score") >= 0.5).cast("int")}
    ).drop(column)
