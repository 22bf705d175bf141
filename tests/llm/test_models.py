"""Operators that learn from labels: held-out accuracy, disguises, edge cases."""

from __future__ import annotations

import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loanweave.llm import common, quality_classifier, quality_rules, toxicity
from loanweave.llm import textvec as V
from tests.llm.helpers import awkward, empty

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
with_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def confusion(scored, labels, target, predicted):
    rows = scored.join(labels.select("doc_id", target), "doc_id").groupBy(target, F.col(predicted).cast("int").alias("p")).count().collect()
    return {(r[target], r.p): r["count"] for r in rows}


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def quality_scores(spark, tables):
    """Scores, and the model they come from."""
    docs, labels = tables
    made, fit = [], quality_classifier.fit
    quality_classifier.fit = lambda sample: made.append(fit(sample)) or made[-1]
    try:
        scored = quality_classifier.score(docs, labels).cache()
    finally:
        quality_classifier.fit = fit
    return scored, made[0]


def plain_statistics(text):
    words, lines = [w for w in re.split("[ \n\t\r]", text) if w], [x for x in text.split("\n") if x]
    n, chars = max(len(words), 1), max(len(text), 1)
    share = lambda characters, of: sum(text.count(c) for c in characters) / of
    return {
        "log_words": math.log(n), "word_length": len(text) / n, "distinct_words": len(set(words)) / n, "distinct_lines": len(set(lines)) / max(len(lines), 1),
        "lines_per_word": len(lines) / n, "bars": share("|<>", n), "marks": share("#$%&*", n), "bangs": share("!?", n),
        "upper": share("ABCDEFGHIJKLMNOPQRSTUVWXYZ", chars), "digits": share("0123456789", chars), "stops": share(".,;:", n),
    }


@with_tables
def test_rules_in_plain_python(tables, quality_scores):
    """Every score is the logistic of the weights of the rules that hold for the text's statistics."""
    scored, model = quality_scores
    assert 1 <= len(model.weights) < 16 * 14
    for r in scored.select("text", "score").limit(300).collect():
        stats = plain_statistics(r.text or "")
        margin = model.intercept
        for rule, weight in model.weights:
            values = [(stats[quality_classifier.STATISTICS[t.feature]], t) for t in rule]
            margin += weight * all(v <= t.value if t.below else v > t.value for v, t in values)
        assert r.score == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-9)


def test_lasso_is_at_its_minimum():
    """No small change of intercept or weights lowers the penalised loss."""
    draw = np.random.default_rng(5)
    fired = (draw.random((60, 6)) < 0.4).astype(float)
    fired[:, 5] = 1.0  # always holds, so it carries no weight
    n = draw.integers(1, 30, 60).astype(float)
    ones = np.round(n / (1 + np.exp(1 - 2 * fired[:, 0] + fired[:, 1])))
    intercept, weights = quality_classifier._minimize(fired, n, ones)
    share = n / n.sum()
    deviation = np.sqrt(share @ fired**2 - (share @ fired) ** 2)

    def cost(b, w):
        m = b + fired @ w
        return (np.log1p(np.exp(m)) * n - ones * m).sum() / n.sum() + quality_classifier.PENALTY * np.abs(w * deviation).sum()

    least = cost(intercept, weights)
    assert weights[5] == 0 and weights[0] > 0 > weights[1]
    for j in range(6):
        for step in (-1e-3, 1e-3):
            assert cost(intercept, weights + step * np.eye(6)[j]) >= least - 1e-12
            assert cost(intercept + step, weights) >= least - 1e-12


@with_tables
def test_quality_classifier_on_held_out(tables, quality_scores):
    (docs, labels), (scored, _) = tables, quality_scores
    assert scored.count() == docs.count()
    found = confusion(scored.where("held_out"), labels, "quality", "predicted")
    right = found.get((0, 0), 0) + found.get((1, 1), 0)
    assert right >= 0.95 * sum(found.values())
    assert found.get((1, 0), 0) <= 0.03 * sum(found.values())
    for r in scored.limit(50).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


@with_tables
def test_toxicity_on_held_out(spark, tables):
    docs, labels = tables
    scored = toxicity.score(docs, labels).cache()
    assert scored.count() == docs.count()
    new = confusion(scored.where("held_out"), labels, "toxic", "predicted")
    assert new.get((1, 1), 0) >= 0.6 * (new.get((1, 1), 0) + new.get((1, 0), 0))
    assert new.get((0, 1), 0) <= 0.02 * sum(new.values())
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == scored.where("predicted = 0").count()


def plain_frequencies(text):
    """Cell of each word and character n-gram, with its frequency times the scale."""
    raw, out = text.encode(), Counter()
    words = V.words(pa.array([text]), V.NOT_BLANK, lower=False)
    grams = [[int(h) >> 50 for h in words.hashes()]]
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in raw)
    for block, n in enumerate(quality_rules.CHARACTER_GRAMS, 1):
        codes = []
        for i in range(len(low) - n + 1):
            code = 0
            for b in low[i : i + n]:
                code = code << 9 | (b + 1)
            codes.append(code)
        grams.append([(c * 0x9E3779B97F4A7C15 % 2**64 >> 50) + block * quality_rules.CELLS for c in codes])
    for cells in grams:
        for cell in cells:
            out[cell] += quality_rules.SCALE / len(cells)
    return out


@with_tables
def test_quality_rules_keep_clean_documents(spark, tables, monkeypatch):
    docs, labels = tables
    made, fit = [], quality_rules.fit
    monkeypatch.setattr(quality_rules, "fit", lambda sample: made.append(fit(sample)) or made[-1])
    judged = quality_rules.judge(docs, labels).cache()
    model = made[0]
    for r in judged.join(docs.select("doc_id", "text"), "doc_id").where("n_words < 200").limit(40).collect():
        margin = model.intercept + sum(float(model.weights[cell]) * f for cell, f in plain_frequencies(r.text or "").items())
        assert r.probability == pytest.approx(1 / (1 + math.exp(-(model.slope * margin + model.offset))), abs=1e-6)
        assert r.kept == (not r.base_failed and r.probability >= quality_rules.MIN_PROBABILITY)
    judged = judged.where("NOT base_failed")
    found = confusion(judged, labels, "quality", "kept")
    assert found.get((1, 0), 0) <= 0.05 * (found.get((1, 0), 0) + found[1, 1])


# Rules


def test_paths_of_a_printed_tree():
    tree = "\n".join([
        "DecisionTreeClassificationModel: uid=x, depth=2, numNodes=5, numClasses=2, numFeatures=3",
        "  If (feature 2 <= 0.5)", "   Predict: 1.0", "  Else (feature 2 > 0.5)", "   If (feature 0 <= -1.0E-3)", "    Predict: 0.0",
        "   Else (feature 0 > -1.0E-3)", "    Predict: 1.0",
    ])
    t = quality_classifier.Test
    assert {frozenset(r) for r in quality_classifier.paths(tree)} == {
        frozenset({t(2, True, 0.5)}), frozenset({t(2, False, 0.5)}), frozenset({t(2, False, 0.5), t(0, True, -0.001)}),
        frozenset({t(2, False, 0.5), t(0, False, -0.001)}),
    }


def test_quality_classifier_awkward(spark):
    docs, none = awkward(spark), empty(spark, "doc_id long, quality int")
    scored = quality_classifier.score(docs, none)
    assert {r.score for r in scored.collect()} == {0.5} and scored.count() == docs.count()
    assert set(scored.columns) == set(docs.columns) and dict(scored.dtypes)["score"] == "double"
    labels = spark.createDataFrame([(1, 1), (3, 1), (3, 0), (4, 0), (7, 1), (None, 1), (5, None), (9, 0)], "doc_id long, quality int")
    assert all(0 <= r.score <= 1 for r in quality_classifier.score(docs, labels).collect())
    assert quality_classifier.score(empty(spark), labels).count() == 0


def test_sample_is_bounded_and_leaves_out_contradictions(spark):
    docs = spark.range(100).selectExpr("id AS doc_id", "string(id) AS text")
    labels = docs.selectExpr("doc_id", "int(doc_id % 2) AS quality").union(docs.where("doc_id < 10").selectExpr("doc_id", "1 - int(doc_id % 2)"))
    rows = common.labelled_sample(docs, labels, "quality", F.lit(True), 50).collect()
    assert len(rows) == 50 and min(r.doc_id for r in rows) >= 10
    many = spark.range(500).selectExpr("42L AS doc_id", "string(id) AS text").union(docs)
    rows = common.labelled_sample(many, labels, "quality", F.lit(True), 90).collect()
    assert len(rows) == 90 and [r.text for r in rows if r.doc_id == 42] == ["0"]


# Toxicity


@pytest.mark.parametrize("text", ["IDIOT", "1d1ot", "іdіоt", "ｉｄｉｏｔ", "id​iot", "an idi0t!", "id!ot"])
def test_disguises(text):
    assert "idiot" in toxicity.fold_words(text)


def test_measure():
    lexicon = toxicity.Lexicon({"trash ": 4.0, "trash": 1.0, "idio": 2.0, "idiot ": 3.0, "can": 0.5})
    measure = lambda t: toxicity.measure(t, lexicon.automaton())
    assert measure("You trash, idiot") == (3, 7.0)
    assert measure("idiotic trashy") == (2, 3.0)
    assert measure("the trash can is full") == (5, 0.0)
    assert measure("the trash cannot; trash can, trash") == (6, 4.0 + 4.0 + 0.5)
    assert measure("vidiot") == (1, 0.0) and measure("") == (0, 0.0) and measure("2024 100") == (0, 0.0)
    assert toxicity.measure("idiot", toxicity.Lexicon({}, ()).automaton()) == (1, 0.0)


def naive(text, weights, exceptions):
    """All entries tried at the start of every word, then all exceptions at every place."""
    words = toxicity.fold_words(text)
    whole = " " + " ".join(words) + " "
    starts = [i + 1 for i, c in enumerate(whole[:-1]) if c == " "]
    best = {i: max([w for e, w in weights.items() if whole.startswith(e, i)], default=0.0) for i in starts}
    for i in range(len(whole)):
        for phrase in exceptions:
            if whole.startswith(f" {phrase} ", i):
                best |= {b: 0.0 for b in best if i <= b < i + len(phrase) + 1}
    return len(words), math.fsum(w for w in best.values() if w > 0)


def test_automaton_finds_what_plain_search_finds():
    draw = random.Random(8)
    stems = ["".join(draw.choices("abci", k=draw.randrange(1, 5))) for _ in range(30)]
    for _ in range(60):
        entries = {draw.choice(stems) + draw.choice(["", " ", "a"]): draw.randrange(1, 9) / 4 for _ in range(12)}
        exceptions = tuple(" ".join(draw.choices(stems, k=draw.randrange(1, 3))) for _ in range(4))
        automaton = toxicity.Lexicon(entries, exceptions).automaton()
        for _ in range(20):
            text = draw.choice([" ", ", ", "! "]).join(draw.choices(stems, k=draw.randrange(0, 12))).replace("i", draw.choice("i1"))
            assert toxicity.measure(text, automaton) == naive(text, entries, exceptions)


def test_toxicity_awkward(spark):
    docs, none = awkward(spark), empty(spark, "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.5}
    rows = [(i, f"text number {i} is {'foul' if i % 3 == 0 else 'fair'} and w{i}") for i in range(100, 220)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id long, toxic int")
    more = docs.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))
    out = toxicity.score(more, labels).collect()
    assert len(out) == more.count()
    assert all((r.predicted == 1) == (r.doc_id is not None and r.doc_id >= 100 and r.doc_id % 3 == 0) for r in out)
    assert toxicity.score(empty(spark), labels).count() == 0
