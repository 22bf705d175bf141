"""Similarity join of texts on word n-grams by chosen paths.

A text is the set of its 5-word shingles. In each run a set is split off along a path: at
every level it goes where one of its tokens, sampled by a hash that depends on the path so
far, leads. Two sets of Jaccard similarity J sample the same token with probability J. A
bucket of few sets is compared by brute force; a larger one is split again, up to ``DEPTH``
levels. Runs are repeated until a pair at the threshold is found with probability
``RECALL`` even if it stays together to the last level.

Texts with equal words are one set from the start, so exact copies cost nothing. What is
left in large buckets after the last level is compared block by block. Each pair is counted
in the first of the buckets that it shares, so nothing has to list or compare pairs between
tasks: a bucket sends one row for each of its sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanweave.llm import bits
from loanweave.llm import textvec as V
from loanweave.llm.common import ship, shuffle_partitions, text_chunks, unused
from loanweave.llm.components import components
from loanweave.sources.staging import stage

SIMILARITY, SHINGLE = 0.8, 5
DEPTH, RECALL = 4, 0.999
#: Sets in a bucket that is not split further, and sets compared with as many others in one go.
SMALL, BLOCK = 48, 1024


def runs_for(similarity: float, depth: int, recall: float) -> int:
    """Runs after which a pair at the threshold shares a path of full depth with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**depth))


def _shingles(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Signature and word count of each row, the shingles of all rows, and where each row's begin.

    Equal signatures mean equal words in equal order (of texts without words: equal texts).
    Rows of fewer than ``n`` words have no shingles: they are like none but their equals.
    """
    words = V.words(texts, V.ALNUM, lower=True)
    hashes, counts = words.hashes(), words.counts
    place = np.arange(len(hashes)) - np.repeat(words.first[:-1], counts)
    total = V.by_row(V.mix(hashes + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), words.first)
    signature = V.mix(total + counts.astype(np.uint64))
    bare = np.flatnonzero((counts == 0) & (np.diff(words.bounds) > 0))
    raw, bounds = V.raw_bytes(texts)
    signature[bare] = ~V.segment_hashes(raw, bounds[:-1][bare], bounds[1:][bare])
    at, each = V.whole_grams(words.first, n)
    return signature, counts, V.grams(hashes, n)[at], np.concatenate([[0], np.cumsum(each)])


def _paths(tokens: np.ndarray, first: np.ndarray, runs: int, depth: int) -> np.ndarray:
    """Path of each row that has tokens, for each run and level."""
    counts = np.diff(first)
    rows = np.flatnonzero(counts)
    starts, counts = first[rows], counts[rows]
    out = np.empty((len(rows), runs, depth), np.uint64)
    if len(rows):
        for run in range(runs):
            path = np.full(len(rows), V.factors(run + 1, 23)[run])
            for level in range(depth):
                value = np.repeat(path, counts)
                value ^= tokens
                value *= np.uint64(0xFF51AFD7ED558CCD)
                value ^= value >> np.uint64(29)
                value *= np.uint64(0xC4CEB9FE1A85EC53)
                value ^= value >> np.uint64(32)
                path = V.mix(path + np.minimum.reduceat(value, starts) * np.uint64(0x9E3779B97F4A7C15))
                out[:, run, level] = path
    return out


def _describe(n: int, runs: int, depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_chunks(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                signature, _, tokens, first = _shingles(part.column("text"), n)
                paths = _paths(tokens, first, runs, depth)
                size = np.zeros(hi - lo + 1, np.int32)
                size[1:] = np.cumsum((np.diff(first) > 0) * (runs * depth))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("digest"),
                        pa.array(signature.view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(size), pa.array(paths.reshape(-1).view(np.int64))),
                    ],
                    ["doc_id", "digest", "sig", "paths"],
                )

    return run


def _sets(bitmap, n: int):
    """Shingle sets of the texts whose signature may be wanted, once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            for lo, hi in text_chunks(batch.column("text")):
                signature, _, tokens, first = _shingles(batch.column("text").slice(lo, hi - lo), n)
                wanted = np.flatnonzero(bits.holds(bitmap.value, signature) & (np.diff(first) > 0))
                wanted = [i for i in wanted if int(signature[i]) not in sent and not sent.add(int(signature[i]))]
                if wanted:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(signature[wanted].view(np.int64)),
                            pa.array([np.unique(tokens[first[i] : first[i + 1]]).tobytes() for i in wanted], pa.binary()),
                        ],
                        ["sig", "tokens"],
                    )

    return run


def _buckets(branches: DataFrame, depth: int) -> DataFrame:
    """(bucket, sig): where sets are compared. Sets alone in a bucket are left out."""
    stopped, open_ = [], branches
    for level in range(1, depth + 1):
        path = f"p{level}"
        sizes = open_.groupBy(path).agg(F.count("*").alias("n")).where("n > 1")
        here = stage(open_.join(sizes, path), "paths")
        last = level == depth
        stopped.append(here.where(F.lit(last) | (F.col("n") <= SMALL)).select(F.col(path).alias("bucket"), "sig"))
        open_ = here.where(F.col("n") > SMALL).drop("n")
    out = stopped[0]
    for more in stopped[1:]:
        out = out.union(more)
    return out


def _distinct_buckets(buckets: DataFrame) -> DataFrame:
    """Of buckets with the same sets, the first: (bucket, sig, n)."""
    content = buckets.groupBy("bucket").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("sig", F.lit(1))).alias("a"), F.bit_xor(F.xxhash64("sig", F.lit(2))).alias("b")
    )
    kept = content.groupBy("n", "a", "b").agg(F.min("bucket").alias("bucket")).select("bucket", "n")
    return buckets.join(kept, "bucket")


def _compare(sigs: np.ndarray, stops: list, tokens: list, side: np.ndarray | None, bucket: int, similarity: float):
    """Links of each set that are this bucket's to count, and the smallest set linked locally.

    ``side`` tells the two blocks apart if only pairs across them are compared.
    """
    rows = len(sigs)
    sizes = np.array([len(t) // 8 for t in tokens])
    values, column = np.unique(np.frombuffer(b"".join(tokens), np.uint64), return_inverse=True)
    shared = np.bincount(column) > 1  # a token of one set only adds to no intersection
    owner, keep = np.repeat(np.arange(rows), sizes), shared[column]
    owner, column = owner[keep], (np.cumsum(shared) - 1)[column[keep]]
    common = np.zeros((rows, rows), np.float32)
    width = int(shared.sum())
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for begin in range(0, width, 4096):
        lo, hi = np.searchsorted(column, [begin, begin + 4096])
        m = np.zeros((rows, min(4096, width - begin)), np.float32)
        m[owner[lo:hi], column[lo:hi] - begin] = 1
        common += m @ m.T
    union = sizes[:, None] + sizes[None, :] - common
    linked = common >= similarity * union - 1e-6
    np.fill_diagonal(linked, False)
    if side is not None:
        linked &= side[:, None] != side[None, :]
    earlier, at = np.unique([s for mine in stops for s in mine if s < bucket], return_inverse=True)
    if len(earlier) and linked.any():
        e = np.zeros((rows, len(earlier)), np.float32)
        e[np.repeat(np.arange(rows), [sum(s < bucket for s in mine) for mine in stops]), at] = 1
        linked &= (e @ e.T) == 0  # counted where they met first
    label = sigs.copy()
    while True:
        least = np.where(linked, label[None, :], np.iinfo(np.int64).max).min(axis=1)
        new = np.minimum(label, least)
        if (new == label).all():
            break
        label = new
    return linked.sum(axis=1), label


def _verify(similarity: float):
    def group(table: pa.Table) -> pa.RecordBatch:
        sigs = table.column("sig").to_numpy()
        bucket, left, right = (table.column(c)[0].as_py() for c in ("bucket", "left", "right"))
        side = None if left == right else table.column("block").to_numpy()
        links, root = _compare(sigs, table.column("stops").to_pylist(), table.column("tokens").to_pylist(), side, bucket, similarity)
        has = links > 0
        return pa.RecordBatch.from_arrays([pa.array(sigs[has]), pa.array(links[has]), pa.array(root[has])], ["sig", "links", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by group; a group may go on in the next batch."""
        rest: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if rest is not None:
                table = pa.concat_tables([rest, table])
            if not table.num_rows:
                continue
            keys = np.stack([table.column(c).to_numpy() for c in ("bucket", "left", "right")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for lo, hi in zip(np.append(0, cuts[:-1]), cuts):
                yield group(table.slice(lo, hi - lo))
            rest = table.slice(cuts[-1] if len(cuts) else 0)
        if rest is not None:
            yield group(rest)

    return run


def join(docs: DataFrame, similarity: float = SIMILARITY, shingle: int = SHINGLE, depth: int = DEPTH, recall: float = RECALL) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``digest`` (hash of the text), ``class_id``,
    ``class_digest``, ``n_links`` and ``n_copies``.

    A class is a connected component of texts with links of at least ``similarity``;
    ``class_id`` is its smallest ``doc_id`` and ``class_digest`` the digest of that row.
    ``n_links`` counts other, different texts (by their words) that are linked directly;
    ``n_copies`` counts documents with the same words in the same order, itself included.
    Words are runs of ASCII letters and digits and of longer characters, A-Z lower-cased.

    - A text of fewer than ``shingle`` words is like its equals only; texts without words
      are alike if equal (NULL is empty).
    - Repeated rows are copies. NULL ids come after all others. No documents: no rows.
    - Other columns are not read, so their names cannot clash.
    - Texts are told apart by 64-bit hashes of their words.
    """
    spark = docs.sparkSession
    ship(spark)
    named = docs.select("doc_id", F.xxhash64("text").alias("digest"), F.coalesce("text", F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    runs = runs_for(similarity, depth, recall)
    described = stage(
        named.mapInArrow(_describe(shingle, runs, depth), f"doc_id {kind}, digest long, sig long, paths array<long>"), "jaccard-paths"
    )
    steps = [F.lit(i * depth) for i in range(runs)]
    branch = F.transform(F.array(*steps), lambda i: F.struct(*[F.get("paths", i + k).alias(f"p{k + 1}") for k in range(depth)]))
    sets = described.where(F.size("paths") > 0).dropDuplicates(["sig"])
    buckets = stage(_distinct_buckets(_buckets(sets.select("sig", F.inline(branch)), depth)), "buckets")

    live = buckets.groupBy("sig").agg(
        F.sort_array(F.collect_list("bucket")).alias("stops"), F.collect_list(F.struct("bucket", "n")).alias("places")
    )
    bitmap = bits.build(buckets.select("sig").distinct(), "sig")
    tokens = named.select("text").mapInArrow(_sets(bitmap, shingle), "sig long, tokens binary").dropDuplicates(["sig"])
    blocks = F.ceil(F.col("n") / F.lit(float(BLOCK))).cast("int")
    block = F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("sig", F.lit(3)), F.col("blocks"))).otherwise(0).cast("int")
    meetings = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda k: F.struct(F.least("block", k).alias("left"), F.greatest("block", k).alias("right")),
    )
    compared = (
        live.join(tokens, "sig")
        .select("sig", "stops", "tokens", F.inline("places"))
        .withColumn("blocks", blocks)
        .withColumn("block", block)
        .select("sig", "stops", "tokens", "bucket", "block", F.inline(meetings))
        .repartition(shuffle_partitions(spark), "bucket", "left", "right")
        .sortWithinPartitions("bucket", "left", "right")
        .mapInArrow(_verify(similarity), "sig long, links long, root long")
    )
    links = stage(compared, "jaccard-links")
    counted = links.groupBy("sig").agg(F.sum("links").alias("n_links"))
    classes = components(links.select(F.col("sig").alias("u"), F.col("root").alias("v"))).toDF("sig", "root")

    copies = described.groupBy("sig").agg(
        F.count("*").alias("n_copies"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "digest")).alias("best")
    )
    by_set = copies.join(counted, "sig", "left").join(classes, "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    heads = by_set.groupBy("root").agg(F.min("best").alias("head"))
    resolved = by_set.join(heads, "root").select(
        "sig", F.coalesce("n_links", F.lit(0)).alias("n_links"), "n_copies", F.col("head.doc_id").alias("class_id"), F.col("head.digest").alias("class_digest")
    )
    return described.select("doc_id", "digest", "sig").join(resolved, "sig").select(
        "doc_id", "digest", "class_id", "class_digest", "n_links", "n_copies"
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each class (the one with the smallest id); all columns stay.

    Of rows equal in id and text, the one with the smallest other columns, in their order, stays
    (any of them, if a column has a type without an order). NULL ids come after all others; a
    NULL text is like an empty one. Extra columns may have any names. No documents: no rows.
    """
    id_, digest, own = (unused(docs, name) for name in ("_kept_id", "_kept_digest", "_digest"))
    mine = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("digest") == F.col("class_digest"))
    kept = join(docs).where(mine).select(F.col("doc_id").alias(id_), F.col("digest").alias(digest)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(own) == F.col(digest))
    left = docs.withColumn(own, F.xxhash64("text")).join(kept, same, "left_semi")
    if any(isinstance(field.dataType, (T.MapType, T.VariantType)) for field in docs.schema):
        return left.dropDuplicates(["doc_id", own]).select(docs.columns)
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "doc_id"])
    found = left.groupBy("doc_id", own).agg(F.min(rest).alias("rest"))
    return found.select(*[F.col("doc_id") if c == "doc_id" else F.col(f"rest.`{c}`") for c in docs.columns])
