"""Quality rules: exact base counts of a text, and a hashed n-gram model with fixed thresholds.

Everything is computed on whole Arrow batches with NumPy. The model is logistic regression
over hashed words and character n-grams, trained by Spark on a bounded sample of labelled
documents and calibrated on a part of the sample that it has not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanweave.llm import textvec as V
from loanweave.llm.common import labelled_sample, ship, text_chunks
from loanweave.sources.staging import stage

#: Labelled documents to learn from, at most; a quarter of them calibrates.
SAMPLE = 6_000
#: Hash cells of words, and of each length of character n-grams.
CELLS = 1 << 14
CHARACTER_GRAMS = (2, 4)
BLOCKS = 1 + len(CHARACTER_GRAMS)
#: Values are frequencies in a text, times this.
SCALE = 100.0

# Fixed thresholds.
MIN_WORDS, MAX_REPEAT_PERCENT, MIN_PROBABILITY = 50, 50, 0.5
_SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))


def _twice(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: is it one of several equal ones; is an equal one before it."""
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys) + 1, dtype=bool)
    same[1:-1] = keys[order][1:] == keys[order][:-1]
    several, later = np.empty(len(keys), bool), np.empty(len(keys), bool)
    several[order], later[order] = same[:-1] | same[1:], same[:-1]
    return several, later


def base_counts(words: V.Words) -> dict[str, np.ndarray]:
    """The exact counts of each row."""
    rows, data = len(words.first) - 1, words.data
    hashes = words.hashes()
    leading = (data & 0xC0) != 0x80  # first byte of each character
    inside = V.by_row((leading & V.NOT_BLANK[data]).astype(np.int64), words.bounds)
    symbols = V.by_row(_SYMBOLS[data].astype(np.int64), words.bounds)

    breaks = np.flatnonzero(data == 0x0A)
    starts = np.unique(np.concatenate([words.bounds[:-1], breaks + 1]))
    starts = starts[starts < len(data)]
    ends = np.append(starts[1:], len(data))
    ends = ends - (data[ends - 1] == 0x0A)  # without the line feed
    full = np.searchsorted(words.start, ends) > np.searchsorted(words.start, starts)
    starts, ends = starts[full], ends[full]
    row = np.searchsorted(words.bounds, starts, "right") - 1
    lines = V.segment_hashes(data, starts, ends)
    _, later = _twice(V.mix(lines ^ V.mix(row.astype(np.uint64))))

    at, counts = V.whole_grams(words.first, 3)
    owner = np.repeat(np.arange(rows, dtype=np.uint64), counts)
    several, _ = _twice(V.mix(V.grams(hashes, 3)[at] ^ V.mix(owner)))
    step = np.zeros(len(hashes) + 4, np.int32)
    np.add.at(step, at[several], 1)
    np.add.at(step, at[several] + 3, -1)
    covered = np.cumsum(step)[: len(hashes)] > 0
    return {
        "n_words": words.counts.astype(np.int64),
        "word_chars": inside,
        "n_symbols": symbols,
        "n_dup_lines": np.bincount(row[later], minlength=rows).astype(np.int64),
        "n_repeat_words": V.by_row(covered.astype(np.int64), words.first),
    }


def _cells(words: V.Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each block of features: the cell of each n-gram, and where each row's begin."""
    shift = np.uint64(50)
    out = [(words.hashes() >> shift, words.first)]
    data = V.LOWER[words.data].astype(np.uint64) + np.uint64(1)
    for block, n in enumerate(CHARACTER_GRAMS, 1):
        at, counts = V.whole_grams(words.bounds, n)
        first = np.concatenate([[0], np.cumsum(counts)])
        code = np.zeros(max(len(data) - n + 1, 0), np.uint64)
        for j in range(n):
            code = (code << np.uint64(9)) | data[j : j + len(code)]
        cell = (code * np.uint64(0x9E3779B97F4A7C15)) >> shift
        out.append((cell[at] + np.uint64(block * CELLS), first))
    return out


def _margins(words: V.Words, weights: np.ndarray, intercept: float) -> np.ndarray:
    total = np.full(len(words.first) - 1, intercept)
    for cell, first in _cells(words):
        # in double precision, so that a text's sum does not depend on the texts before it
        total += V.by_row(weights[cell.astype(np.int64)].astype(np.float64), first) * SCALE / np.maximum(np.diff(first), 1)
    return total


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi in text_chunks(batch.column("text")):
            part = batch.slice(lo, hi - lo)
            blocks = _cells(V.words(part.column("text"), V.NOT_BLANK, lower=False))
            indices, values = [], []
            for i in range(hi - lo):
                at, value = [], []
                for cell, first in blocks:
                    found, n = np.unique(cell[first[i] : first[i + 1]].astype(np.int32), return_counts=True)
                    at.append(found)
                    value.append(n * (SCALE / max(first[i + 1] - first[i], 1)))
                indices.append(np.concatenate(at))
                values.append(np.concatenate(value))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("label"), pa.array(indices, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float64()))],
                ["doc_id", "label", "indices", "values"],
            )


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # one per cell of each block
    intercept: float
    slope: float  # calibration: probability = logistic(slope * margin + offset)
    offset: float

    def probabilities(self, words: V.Words) -> np.ndarray:
        margin = self.slope * _margins(words, self.weights, self.intercept) + self.offset
        return 1.0 / (1.0 + np.exp(-np.clip(margin, -500, 500)))


def fit(sample: DataFrame) -> Model:
    """Learns from ``doc_id``, ``text``, ``label``. If one part of the sample lacks a label,
    all texts get the smoothed share of label 1 (0.5 of nothing)."""
    schema = f"doc_id {sample.schema['doc_id'].dataType.simpleString()}, label double, indices array<int>, values array<double>"
    found = sample.select("doc_id", "text", "label").mapInArrow(_sparse, schema)
    vector = F.udf(lambda i, v: Vectors.sparse(BLOCKS * CELLS, i, v), VectorUDT())
    calibrates = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4)) == 0
    # vectors are made once here; the fits read them as often as they need
    known = stage(found.select("label", vector("indices", "values").alias("features"), calibrates.alias("calibrates")), "ngram-sample")
    counts = {(r[0], r[1]): r[2] for r in known.groupBy("calibrates", "label").count().collect()}
    if len(counts) < 4:
        ones = sum(n for (_, label), n in counts.items() if label == 1.0)
        share = (ones + 1) / (sum(counts.values()) + 2)
        return Model(np.zeros(BLOCKS * CELLS, np.float32), float(np.log(share / (1 - share))), 1.0, 0.0)
    linear = LogisticRegression(regParam=0.05, maxIter=40).fit(known.where("NOT calibrates"))
    margin = vector_to_array(F.col("rawPrediction"))[1]
    seen = linear.transform(known.where("calibrates")).select("label", array_to_vector(F.array(margin)).alias("features"))
    platt = LogisticRegression(regParam=0.001, maxIter=40).fit(seen)
    return Model(
        linear.coefficients.toArray().astype(np.float32), float(linear.intercept), float(platt.coefficients[0]), float(platt.intercept)
    )


def judge(docs: DataFrame, labels: DataFrame, min_probability: float = MIN_PROBABILITY) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, the base counts, ``base_failed``,
    ``probability`` (of good quality, calibrated) and ``kept``.

    - NULL or empty text: no words, so the base rule fails.
    - Repeated rows: each is judged. No documents: no rows. Too few labels: see ``fit``.
    - Other columns are not read, so their names cannot clash.
    """
    ship(docs.sparkSession)
    everyone = F.lit(True)
    model = docs.sparkSession.sparkContext.broadcast(fit(labelled_sample(docs, labels, "quality", everyone, SAMPLE)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_chunks(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                words = V.words(part.column("text"), V.NOT_BLANK, lower=False)
                counts, probability = base_counts(words), model.value.probabilities(words)
                n = counts["n_words"]
                failed = (n < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * n)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *map(pa.array, (*counts.values(), failed, probability, ~failed & (probability >= min_probability)))],
                    ["doc_id", *counts, "base_failed", "probability", "kept"],
                )

    schema = (
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, word_chars long, n_symbols long,"
        " n_dup_lines long, n_repeat_words long, base_failed boolean, probability double, kept boolean"
    )
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, schema)
