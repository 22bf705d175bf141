"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton on folded text.

Folding undoes disguises: look-alike letters of other scripts, full-width forms, and digits
or signs put for letters inside a word. The lexicon is learned: words and word beginnings
that are much more frequent in toxic than in other labelled documents, weighted by their log
odds. A word counts with the largest weight that fits it, unless it is part of an exception
phrase. The sum of weights, as such and per word of the text, gives a calibrated probability.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanweave.llm.common import fold, labelled_sample, ship, unused
from loanweave.sources.staging import stage

#: Labelled documents to learn from, at most.
SAMPLE = 20_000
#: A lexicon entry is in at least so many toxic documents, and its log odds are at least so many
#: standard errors above zero, and at least so many. At most ``ENTRIES`` with the largest such ratio are kept.
SUPPORT, SIGNIFICANCE, MIN_WEIGHT, ENTRIES = 3, 2.4, 3.0, 5_000
#: Parts of the sample for calibration.
PARTS = 4
_COUNTS = [f"{kind}{i}" for kind in "tc" for i in range(PARTS)]
PREFIXES = range(4, 10)

# Characters that pass for Latin letters.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "і": "i", "ї": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ӏ": "l",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ո": "n", "ս": "u", "օ": "o",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "+": "t", "|": "l"}
# Phrases in which an insult is none.
EXCEPTIONS = (
    "trash can", "trash bag", "trash bin", "trash collection", "pond scum", "soap scum", "clown fish", "circus clown", "class clown",
    "sore loser", "loser bracket", "idiot proof", "idiot light", "stupid question",
)

_INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
_DISGUISES = str.maketrans(LOOKALIKES) | dict.fromkeys(map(ord, _INVISIBLE))
_DISGUISED = re.compile(f"[{''.join(LOOKALIKES)}{_INVISIBLE}]")
_SUBSTITUTES = str.maketrans(SUBSTITUTES)
_MIXED = re.compile(r"(?<=[^\W\d_])[0-9@$!+|]+(?=[^\W\d_])|(?<![\w@$!+|])[0-9@$]+(?=[^\W\d_])|(?<=[^\W\d_])[0-9]+(?!\w)")
_WORD = re.compile(r"[^\W\d_]+")
_SUBSTITUTE = re.compile(f"[{re.escape(''.join(SUBSTITUTES))}]")


def fold_words(text: str) -> list[str]:
    """Words of the text, all lower-case, with disguises undone."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    text = text.lower()
    if _DISGUISED.search(text):  # looking is much cheaper than changing
        text = text.translate(_DISGUISES)
    if _SUBSTITUTE.search(text):
        text = _MIXED.sub(lambda m: m[0].translate(_SUBSTITUTES), text)
    return _WORD.findall(text)


@dataclass(frozen=True)
class Lexicon:
    """Entries start at a word's beginning; one that ends in a space is a whole word."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS

    def automaton(self) -> ahocorasick.Automaton:
        out = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            out.add_word(f" {entry}", (len(entry) + 1, weight))
        for phrase in self.exceptions:
            out.add_word(f" {phrase} ", (len(phrase) + 2, None))
        out.make_automaton()
        return out


def measure(text: str, automaton: ahocorasick.Automaton) -> tuple[int, float]:
    """Number of words, and the sum of the weights of matched words."""
    words = fold_words(text)
    if not words or not len(automaton):
        return len(words), 0.0
    best: dict[int, float] = {}
    spared: list[tuple[int, int]] = []
    for end, (length, weight) in automaton.iter(" " + " ".join(words) + " "):
        begin = end - length + 1
        if weight is None:
            spared.append((begin, end))
        elif weight > best.get(begin, 0.0):
            best[begin] = weight
    for begin, end in spared:
        for at in [b for b in best if begin <= b < end]:
            del best[at]
    return len(words), math.fsum(best.values())


def _entries(words: set[str]) -> set[str]:
    return {w[:n] for w in words for n in PREFIXES if len(w) > n} | {f"{w} " for w in words if len(w) > 2}


def _count_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each entry, in how many toxic and clean documents of each part it is."""
    for batch in batches:
        counts: dict[str, Counter] = {name: Counter() for name in _COUNTS}
        for text, label, part in zip(*(batch.column(c).to_pylist() for c in ("text", "label", "part"))):
            counts[f"{'t' if label == 1.0 else 'c'}{part}"].update(_entries(set(fold_words(text))))
        names = list(set().union(*counts.values()))
        columns = [pa.array([found[n] for n in names], pa.int64()) for found in counts.values()]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *columns], ["entry", *counts])


def entry_counts(sample: DataFrame) -> DataFrame:
    """Counts by entry and part, from ``text``, ``label`` and ``part``; only entries of enough toxic documents."""
    schema = ", ".join(["entry string", *(f"{c} long" for c in _COUNTS)])
    found = sample.select("text", "label", "part").mapInArrow(_count_entries, schema).groupBy("entry").agg(*[F.sum(c).alias(c) for c in _COUNTS])
    return found.where(sum((F.col(f"t{i}") for i in range(PARTS)), F.lit(0)) >= SUPPORT)


def choose_entries(counts: DataFrame, totals: dict, parts: list[int], exceptions: tuple[str, ...]) -> Lexicon:
    """Lexicon from the documents of some parts. Documents count, not uses."""
    toxic, clean = (sum(totals.get((i, label), 0) for i in parts) for label in (1.0, 0.0))
    t, c = (sum((F.col(f"{k}{i}") for i in parts), F.lit(0)) for k in "tc")
    odds = F.log((t + 0.5) / (F.lit(toxic + 0.5) - t)) - F.log((c + 0.5) / (F.lit(clean + 0.5) - c))
    error = F.sqrt(1 / (t + 0.5) + 1 / (c + 0.5))
    chosen = (
        counts.where(t >= SUPPORT)
        .select("entry", odds.alias("weight"), (odds / error).alias("ratio"))
        .where((F.col("ratio") >= SIGNIFICANCE) & (F.col("weight") >= MIN_WEIGHT))
        .orderBy(F.desc("ratio"), "entry")
        .limit(ENTRIES)
    )
    return Lexicon({r["entry"]: float(r["weight"]) for r in chosen.collect()}, exceptions)


def _measure_batches(lexicon, added: list[str]):
    """Adds the number of words and the weight of the matched ones to each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.value.automaton()
        for batch in batches:
            found = [measure(text or "", automaton) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([n for n, _ in found], pa.int64()), pa.array([w for _, w in found], pa.float64())],
                [*batch.schema.names, *added],
            )

    return run


_ADDED = ["_n_words", "_weight"]


def _measured(texts: DataFrame, lexicon, added: list[str] = _ADDED) -> DataFrame:
    schema = T.StructType([*texts.schema.fields, T.StructField(added[0], T.LongType()), T.StructField(added[1], T.DoubleType())])
    return texts.mapInArrow(_measure_batches(lexicon, added), schema)


def _inputs(added: list[str]) -> tuple[Column, Column, Column]:
    w, n = F.col(f"`{added[1]}`"), F.greatest(F.col(f"`{added[0]}`"), F.lit(1))
    return F.log1p(w), F.log1p(1000 * w / n), (w > 0).cast("double")


def _fit(docs: DataFrame, labels: DataFrame, exceptions: tuple[str, ...], added: list[str] = _ADDED) -> tuple[Broadcast, Column]:
    """Lexicon for the tasks, and the log odds of a text measured in the columns ``added``."""
    ship(docs.sparkSession)
    sample = labelled_sample(docs, labels, "toxic", fold(F.col("doc_id"), 5) != 0, SAMPLE)
    part = F.pmod(F.xxhash64("text", F.lit(5)), F.lit(PARTS)).cast("int").alias("part")
    known = stage(sample.dropDuplicates(["text"]).select("text", "label", part), "toxicity-sample")
    totals = {(r[0], r[1]): r[2] for r in known.groupBy("part", "label").count().collect()}
    context = docs.sparkSession.sparkContext
    if len({label for _, label in totals}) < 2:
        ones = sum(n for (_, label), n in totals.items() if label == 1.0)
        share = (ones + 1) / (sum(totals.values()) + 2)
        return context.broadcast(Lexicon({}, exceptions)), F.lit(math.log(share / (1 - share)))
    counts = stage(entry_counts(known), "toxicity-entries")
    # each part is measured with what the others teach, so that calibration sees new texts
    lexicons = [context.broadcast(choose_entries(counts, totals, [j for j in range(PARTS) if j != i], exceptions)) for i in range(PARTS)]
    measured = [_measured(known.where(F.col("part") == i).select("text", "label"), lexicon) for i, lexicon in enumerate(lexicons)]
    shared = context.broadcast(choose_entries(counts, totals, list(range(PARTS)), exceptions))
    calibration = stage(reduce(DataFrame.union, measured).drop("text"), "toxicity-calibration")
    for lexicon in lexicons:
        lexicon.destroy()
    vectors = calibration.select("label", array_to_vector(F.array(*_inputs(_ADDED))).alias("features"))
    model = LogisticRegression(regParam=1e-4, maxIter=60).fit(vectors)
    margin = F.lit(float(model.intercept))
    for value, weight in zip(_inputs(added), model.coefficients.toArray()):
        margin = margin + value * F.lit(float(weight))
    return shared, margin


def score(docs: DataFrame, labels: DataFrame, exceptions: tuple[str, ...] = EXCEPTIONS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``score``, ``predicted``,
    ``n_words`` and ``weight`` (sum over matched words).

    Learns from labelled documents whose CRC32 of the id modulo 5 is not 0 (at most
    ``SAMPLE``; equal texts count once); the others are held out. Only the text is an input.

    - NULL or empty text: no matches, so the lowest score there is.
    - Repeated rows: each is scored. No documents: no rows.
    - Labels of one kind only: no lexicon; all scores are the smoothed share of label 1.
    - Other columns are not read, so their names cannot clash.
    """
    lexicon, margin = _fit(docs, labels, exceptions)
    return _measured(docs.select("doc_id", "text"), lexicon).select(
        "doc_id",
        (fold(F.col("doc_id"), 5) == 0).alias("held_out"),
        (F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))).alias("score"),
        (margin >= 0).cast("int").alias("predicted"),
        F.col("_n_words").alias("n_words"),
        F.col("_weight").alias("weight"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, exceptions: tuple[str, ...] = EXCEPTIONS) -> DataFrame:
    """``docs`` without the rows that ``score`` predicts to be toxic; all columns stay, in one scan.

    NULL and empty texts and repeated rows are judged as by ``score``; extra columns may have any
    names. No documents: no rows.
    """
    added = [unused(docs, name) for name in _ADDED]
    lexicon, margin = _fit(docs, labels, exceptions, added)
    return _measured(docs, lexicon, added).where(margin < 0).select(*[F.col(f"`{c}`") for c in docs.columns])
