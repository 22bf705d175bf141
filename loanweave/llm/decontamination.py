"""Benchmark passages in documents, by winnowing.

A window is ``window`` consecutive words of a benchmark item, or the whole of a shorter
item. The fingerprint of a window is the smallest hash of its ``k``-word grams, so equal
windows have equal fingerprints and no shared passage of a window's length can be missed.
Documents keep those of their windows whose fingerprint may be one of the benchmark's
(a bitmap of fixed size tells), fingerprints are joined, and a hit holds only if the whole
window is equal, word for word. Hits of a document are merged to spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanweave.llm import bits
from loanweave.llm import textvec as V
from loanweave.llm.common import ship, text_chunks, unused
from loanweave.sources.staging import stage

WINDOW, GRAM = 10, 5
_HIT = pa.struct([("fp", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("words", pa.string())])


def _fingerprints(words: V.Words, hashes: np.ndarray, n: int, window: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of all ``n``-word windows that lie in one row, and their fingerprints."""
    starts, _ = V.whole_grams(words.first, n)
    if n < window:
        return starts, V.grams(hashes, n, seed=100 + n)[starts]
    grams = V.grams(hashes, k)
    least = grams[: max(len(hashes) - window + 1, 0)].copy()
    for j in range(1, window - k + 1):
        np.minimum(least, grams[j : j + len(least)], out=least)
    return starts, least[starts]


def item_windows(items: DataFrame, item: str, text: str, window: int = WINDOW, k: int = GRAM) -> DataFrame:
    """(item, fp, n, words) of every window of every item; an item without words has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_chunks(batch.column("text")):
                words = V.words(batch.column("text").slice(lo, hi - lo), V.ALNUM, lower=True)
                hashes, ids = words.hashes(), batch.column("item").slice(lo, hi - lo)
                for n in sorted({min(int(c), window) for c in words.counts} - {0}):
                    starts, prints = _fingerprints(words, hashes, n, window, k)
                    row = words.row[starts]
                    mine = np.minimum(words.counts[row], window) == n
                    starts, prints, row = starts[mine], prints[mine], row[mine]
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(pa.array(row)),
                            pa.array(prints.view(np.int64)),
                            pa.array(np.full(len(starts), n, np.int32)),
                            pa.array([words.text(s, s + n) for s in starts], pa.string()),
                        ],
                        ["item", "fp", "n", "words"],
                    )

    named = items.select(F.col(f"`{item}`").cast("string").alias("item"), F.col(f"`{text}`").alias("text"))
    return named.mapInArrow(run, "item string, fp long, n int, words string")


def _scanner(bitmap, lengths: list[int], window: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_chunks(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                words = V.words(part.column("text"), V.ALNUM, lower=True)
                hashes, found = words.hashes(), [[] for _ in range(hi - lo)]
                for n in lengths:
                    starts, prints = _fingerprints(words, hashes, n, window, k)
                    may = bits.holds(bitmap.value, prints)
                    starts, prints = starts[may], prints[may].view(np.int64)
                    rows = np.searchsorted(words.first, starts, "right") - 1
                    for row, s, fp in zip(rows.tolist(), starts.tolist(), prints.tolist()):
                        found[row].append({"fp": fp, "start": s - int(words.first[row]), "n": n, "words": words.text(s, s + n)})
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        part.column("digest"),
                        pa.array(words.counts.astype(np.int64)),
                        pa.array(found, pa.list_(_HIT)),
                    ],
                    ["id", "digest", "n_words", "hits"],
                )

    return run


def find(
    docs: DataFrame, items: DataFrame, doc: str = "doc_id", item: str = "item_id", text: str = "text",
    window: int = WINDOW, k: int = GRAM,
) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``digest`` (hash of the text), ``n_words``,
    ``n_hit``, ``spans`` (array of first word and the word after the last) and ``items``
    (sorted array of item ids as strings).

    Words are runs of ASCII letters and digits and of any longer characters, A-Z lower-cased.

    - NULL or empty text: no words, no hits. Items without words are never found.
    - Repeated documents: each row gets its result. Rows that share an id but not the text
      are told apart by ``digest``. A NULL id is an id like any other.
    - Repeated or equal items: all their ids are listed. No items or no documents: no hits, no rows.
    - Other columns are not read, so their names cannot clash.
    """
    ship(docs.sparkSession)
    named = docs.select(
        F.col(f"`{doc}`").alias("id"), F.xxhash64(f"`{text}`").alias("digest"), F.coalesce(f"`{text}`", F.lit("")).alias("text")
    )
    windows = stage(item_windows(items, item, text, window, k), "benchmark-windows")
    lengths = [r[0] for r in windows.select("n").distinct().collect()]  # at most ``window`` numbers
    bitmap = bits.build(windows, "fp")
    id_type = named.schema["id"].dataType.simpleString()
    scanned = stage(
        named.mapInArrow(
            _scanner(bitmap, sorted(lengths), window, k),
            f"id {id_type}, digest long, n_words long, hits array<struct<fp:long,start:int,n:int,words:string>>",
        ),
        "benchmark-candidates",
    )
    known = windows.groupBy("fp", "words").agg(F.collect_set("item").alias("items"))
    hits = (
        scanned.where(F.size("hits") > 0)
        .select("id", "digest", F.inline("hits"))
        .distinct()  # repeated documents
        .join(known, ["fp", "words"])
    )
    merged = F.aggregate(
        F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("n")).alias("end")))),
        F.array().cast("array<struct<start:int,end:int>>"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["end"] >= s["start"]),
            F.concat(
                F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))),
                F.array(F.struct(F.try_element_at(acc, F.lit(-1))["start"].alias("start"), F.greatest(F.try_element_at(acc, F.lit(-1))["end"], s["end"]).alias("end"))),
            ),
        ).otherwise(F.concat(acc, F.array(s))),
    )
    by_doc = hits.groupBy("id", "digest").agg(
        merged.alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")
    )
    base = scanned.select("id", "digest", "n_words")
    b = by_doc.select(F.col("id").alias("b_id"), F.col("digest").alias("b_digest"), "spans", "items")
    none = F.array()
    return base.join(b, F.col("id").eqNullSafe(F.col("b_id")) & (F.col("digest") == F.col("b_digest")), "left").select(
        "id",
        "digest",
        "n_words",
        F.coalesce(F.aggregate("spans", F.lit(0), lambda a, s: a + s["end"] - s["start"]), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("spans", none.cast("array<struct<start:int,end:int>>")).alias("spans"),
        F.coalesce("items", none.cast("array<string>")).alias("items"),
    )


def remove(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold any window of the benchmark; all columns stay.

    NULL and empty texts stay. Repeated rows stay or go together, as do rows with a NULL id by
    their text. Extra columns may have any names. No documents: no rows.
    """
    bad_id, bad_digest = unused(docs, "_bad_id"), unused(docs, "_bad_digest")
    bad = find(docs, items).where("n_hit > 0").select(F.col("id").alias(bad_id), F.col("digest").alias(bad_digest)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(bad_id)) & (F.xxhash64("text") == F.col(bad_digest))
    return docs.join(bad, same, "left_anti")
