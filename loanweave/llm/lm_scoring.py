"""Language-model scores from a log-frequency Bloom filter.

Counts of words and of word pairs over all training documents are quantised on a log scale,
and an n-gram of level ``q`` is stored as the members (n-gram, 1) ... (n-gram, q) of a Bloom
filter. A count is read back by probing level after level until one is missing. The filter
is built by Spark in shards, one range of hashes each, and grows with the number of stored
members. All n-grams are counted. The broadcast is bounded by ``MAX_BITS``: if the members
need more, n-grams are stored from a count on that makes them fit, found from a histogram of
all counts. The filter then tells which n-grams of a text it cannot hold, and those are joined
to the table of the rarer counts, quantised alike, so that every count is used at any size.

The base score needs exact counts. The most frequent words (a bounded table) are broadcast
with theirs; the other words of each document are joined to the table of all counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanweave.llm import bits
from loanweave.llm import textvec as V
from loanweave.llm.common import fold, least_frequent, ship, shuffle_partitions, text_chunks
from loanweave.sources.staging import stage

#: Words whose exact counts are broadcast, 16 bytes each.
FREQUENT = 1 << 19
#: Bits for each stored member, and the most for all (64 MB).
BITS_PER_MEMBER, MAX_BITS = 8, 1 << 29
SHARDS, PROBES = 1 << 12, 3
#: Counts are quantised to floor(log(c) / log(BASE)) + 1.
BASE, MAX_LEVEL = 2.0, 40
#: Pseudo-count of the base distribution in the probability after a word.
MU = 8.0
_END = np.uint64(0x5E0F7E87)  # stands for the end of a text
_LOW = np.uint64(0xFFFFFFFF)
_PAIR = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each token, ends included, and where each row's tokens begin."""
    words = V.words(texts, V.NOT_BLANK, lower=True)
    rows = len(words.first) - 1
    out = np.empty(len(words.start) + rows, np.uint64)
    first = words.first + np.arange(rows + 1)
    ends = first[1:] - 1
    is_end = np.zeros(len(out), bool)
    is_end[ends] = True
    out[~is_end], out[ends] = words.hashes(), _END
    return out, first


def _pairs(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hash of each token with the one before it; the first of a text follows an end."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[first[:-1]] = _END
    return V.mix(before * _PAIR[0] + tokens * _PAIR[1])


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, hash, n): 1 for words, 2 for pairs; summed within a batch."""
    for batch in batches:
        parts: dict[int, list[np.ndarray]] = {1: [], 2: []}
        for lo, hi in text_chunks(batch.column("text")):
            tokens, first = _tokens(batch.column("text").slice(lo, hi - lo))
            parts[1].append(tokens)
            parts[2].append(_pairs(tokens, first))
        for kind, found in parts.items():
            if found:
                hashes, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(hashes), kind, np.int8)), pa.array(hashes.view(np.int64)), pa.array(n)], ["kind", "hash", "n"]
                )


class _Probes:
    """Bits of hashes at a level, within their shard: one for each probe, by double hashing."""

    def __init__(self, hashes: np.ndarray, level: int, shard_bits: int):
        h = V.mix(hashes ^ np.uint64(level * 0x2545F4914F6CDD1D & 0xFFFFFFFFFFFFFFFF))
        self.start, self.step, self.size = h & _LOW, (h >> np.uint64(32)) | np.uint64(1), np.uint64(shard_bits)

    def bit(self, probe: int, which: np.ndarray | slice = slice(None)) -> np.ndarray:
        at = (self.start[which] + np.uint64(probe) * self.step[which]) & _LOW
        return (at * self.size) >> np.uint64(32)


def _shard(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(52)).astype(np.int64)


def _level(n: Column) -> Column:
    return F.least(F.floor(F.log(n.cast("double")) / F.log(F.lit(BASE)) + 1e-9) + 1, F.lit(MAX_LEVEL)).cast("int")


def _middle(level: np.ndarray) -> np.ndarray:
    """Middle of the range of counts of a level; 0 for what is not stored."""
    level = level.astype(np.float64)
    return np.where(level > 0, (BASE ** (level - 1) + np.maximum(BASE**level - 1, 1)) / 2, 0.0)


def _middle_column(level: Column) -> Column:
    power = lambda x: F.pow(F.lit(BASE), x)
    return (power(level - 1) + F.greatest(power(level) - 1, F.lit(1.0))) / 2


@dataclass(frozen=True)
class Filter:
    shard_bits: int
    bits: np.ndarray  # SHARDS rows of bytes
    cut: int = 1  # n-grams of smaller counts are not stored

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        """Highest level reached by probing 1, 2, ... until one is missing."""
        out = np.zeros(len(hashes), np.int64)
        flat, row = self.bits.reshape(-1), _shard(hashes).astype(np.uint64) * np.uint64(self.shard_bits // 8)
        open_ = np.arange(len(hashes))
        for level in range(1, MAX_LEVEL + 1):
            probes, alive = _Probes(hashes[open_], level, self.shard_bits), np.arange(len(open_))
            for i in range(PROBES):
                bit = probes.bit(i, alive)
                byte = flat[row[open_[alive]] + (bit >> np.uint64(3))]
                alive = alive[(byte >> (bit & np.uint64(7)).astype(np.uint8)) & np.uint8(1) != 0]
            open_ = open_[alive]
            if not len(open_):
                break
            out[open_] = level
        return out

    def lacks(self, levels: np.ndarray) -> np.ndarray:
        """Whether n-grams found at these levels are not stored, though they may have been counted."""
        if self.cut <= 1:
            return np.zeros(len(levels), bool)
        return levels < min(int(np.log(self.cut) / np.log(BASE) + 1e-9) + 1, MAX_LEVEL)


def build_filter(counts: DataFrame) -> Filter:
    """From ``shard``, ``hash`` and ``n``."""
    level = _level(F.col("n"))
    cut = least_frequent(counts, "n", MAX_BITS // BITS_PER_MEMBER, level)
    counts = counts.where(F.col("n") >= cut)
    members = counts.agg(F.sum(level)).first()[0] or 0
    shard_bits = max(1 << 10, int(members) * BITS_PER_MEMBER // SHARDS // 64 * 64)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots: dict[int, int] = {}  # place of each shard that this task meets
        flags = np.zeros(0, bool)  # one for each bit of those shards
        for batch in batches:
            hashes = batch.column("hash").to_numpy().view(np.uint64)
            levels, shard = batch.column("level").to_numpy(), batch.column("shard").to_numpy()
            met, inverse = np.unique(shard, return_inverse=True)
            mine = np.array([slots.setdefault(int(s), len(slots)) for s in met], np.uint64)
            if len(slots) * shard_bits > len(flags):
                flags = np.concatenate([flags, np.zeros(len(slots) * shard_bits * 2 - len(flags), bool)])
            base = mine[inverse] * np.uint64(shard_bits)
            for q in range(1, int(levels.max(initial=0)) + 1):
                deep = np.flatnonzero(levels >= q)
                probes = _Probes(hashes[deep], q, shard_bits)
                for i in range(PROBES):
                    flags[base[deep] + probes.bit(i)] = True
        for s, slot in slots.items():
            bits = np.packbits(flags[slot * shard_bits : (slot + 1) * shard_bits], bitorder="little").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([bits], pa.binary())], ["shard", "bits"])

    # the counts are stored by shard, so a task meets few of them and sends those parts only
    filled = counts.select("hash", level.alias("level"), "shard").mapInArrow(fill, "shard int, bits binary")
    out = np.zeros((SHARDS, shard_bits // 8), np.uint8)
    for batch in filled.toArrow().to_batches():
        for s, bits in zip(batch.column("shard").to_pylist(), batch.column("bits")):
            out[s] |= np.frombuffer(bits.as_buffer(), np.uint8)
    return Filter(shard_bits, out, cut)


def _left_out(counts: DataFrame, cut: int, asked: DataFrame) -> DataFrame:
    """(kind, hash, middle) of the counts that the filter lacks. A bitmap of what is ``asked``
    keeps most of the others out of the joins."""
    every = asked.select(F.explode(F.array("pair", "before", "word")).alias("hash"))
    shared = bits.build(every, "hash")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(bits.holds(shared.value, batch.column("hash").to_numpy().view(np.uint64))))

    rare = counts.where(F.col("n") < cut).select("kind", "hash", "n").mapInArrow(keep, "kind byte, hash long, n long")
    return rare.select("kind", "hash", _middle_column(_level(F.col("n"))).alias("middle"))


def _added_scores(counts: DataFrame, cut: int, asked: DataFrame, total: float) -> DataFrame:
    """(row, more_score) of the uses that need a count which the filter lacks."""
    left_out = _left_out(counts, cut, asked)
    words, pairs = (left_out.where(F.col("kind") == k).drop("kind") for k in (1, 2))
    columns = ["row", "pair", "context", "n", "uses"]
    # words that the filter lacks are few; where only one of both is, the pair, which is no word, stands in as key
    open_ = F.col("before").isNotNull() | F.col("word").isNotNull()
    open_words = (
        asked.where(open_)
        .withColumns({"before_key": F.coalesce("before", "pair"), "word_key": F.coalesce("word", "pair")})
        .join(words.toDF("before_key", "before_n"), "before_key", "left")
        .join(words.toDF("word_key", "word_n"), "word_key", "left")
        .withColumn("context", F.when(F.col("before").isNull(), F.col("context")).otherwise(F.coalesce("before_n", F.lit(0.0))))
        .withColumn("n", F.when(F.col("word").isNull(), F.col("n")).otherwise(F.coalesce("word_n", F.lit(0.0))))
    )
    known = asked.where(~open_).select(columns).union(open_words.select(columns))
    found = known.join(pairs.toDF("pair", "pair_n"), "pair", "left")
    top = F.least(F.coalesce("pair_n", F.lit(0.0)), F.col("context")) + F.lit(MU) * (F.col("n") + 1) / F.lit(total)
    return found.groupBy("row").agg(F.sum(F.col("uses") * F.log10(top / (F.col("context") + F.lit(MU)))).alias("more_score"))


def score(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` and ``score``.

    Learns from documents whose CRC32 of the id modulo 7 is not 2. Tokens are runs of
    characters other than ASCII white space, A-Z lower-cased, and one end for each text. The
    base score adds one to each count. The score is the log10 probability of the text, where
    P(word | before) = (c(before, word) + MU * base(word)) / (c(before) + MU) with counts
    read from the filter (the pair's at most the word's before it). Words outside the
    broadcast table take the count for ``base(word)`` from the filter, too. What the filter
    lacks for its bound is joined.

    - NULL or empty text: only its end.
    - Repeated rows: each is counted and scored. No documents: no rows. No training
      documents: all counts are 0, and with nothing counted a token has probability 1.
    - Other columns are not read, so their names cannot clash.
    """
    spark = docs.sparkSession
    ship(spark)
    held_out = fold(F.col("doc_id"), 7) == 2
    named = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), held_out.alias("held_out"))
    counts = stage(
        named.where("NOT held_out")
        .select("text")
        .mapInArrow(_count_batches, "kind byte, hash long, n long")
        .withColumn("shard", F.shiftrightunsigned("hash", 52).cast("int"))
        .repartition(shuffle_partitions(spark), "shard")
        .groupBy("shard", "kind", "hash")
        .agg(F.sum("n").alias("n")),
        "ngram-counts",
    )
    words = counts.where("kind = 1")
    n, v = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    table = words.where(F.col("n") >= least_frequent(words, "n", FREQUENT)).select("hash", "n").toArrow()
    hashes = table.column("hash").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    grams = build_filter(counts)
    cut = grams.cut
    shared = spark.sparkContext.broadcast((hashes[order], table.column("n").to_numpy()[order], grams))
    total = float(n + v + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, exact, grams = shared.value
        for batch in batches:
            for lo, hi in text_chunks(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                tokens, first = _tokens(part.column("text"))
                kinds, inverse = np.unique(tokens, return_inverse=True)
                at = np.minimum(np.searchsorted(known, kinds), max(len(known) - 1, 0))
                found = known[at] == kinds if len(known) else np.zeros(len(kinds), bool)
                level = grams.levels(kinds)
                quantised = _middle(level)
                count = np.where(found, exact[at] if len(known) else 0, 0)
                base = np.log10((count + 1) / total)
                smooth = np.where(found, count, quantised)
                lacking = grams.lacks(level) & ~found

                pairs, back = np.unique(_pairs(tokens, first), return_inverse=True)
                level = grams.levels(pairs)
                pair, n = _middle(level)[back], smooth[inverse]
                before = np.zeros(len(tokens), np.int64)
                before[1:] = inverse[:-1]
                before[first[:-1]] = np.searchsorted(kinds, _END)
                context, no_word, no_before = smooth[before], lacking[inverse], lacking[before]
                ends = float(count[kinds == _END].sum())
                stored = quantised[kinds == _END] if not ends else _middle(np.floor(np.log([ends]) / np.log(BASE) + 1e-9) + 1)
                context[first[:-1]] = max(ends, float(stored.sum()))
                asked = grams.lacks(level)[back] | no_word | no_before
                if grams.cut == 2:  # what training texts hold and the filter lacks was counted once
                    learned = np.repeat(~part.column("held_out").to_numpy(zero_copy_only=False), np.diff(first))
                    once = asked & learned
                    pair[once], n[once & no_word], context[once & no_before] = 1.0, 1.0, 1.0
                    asked &= ~learned
                each = np.log10((np.minimum(pair, context) + MU * (n + 1) / total) / (context + MU))
                each[asked] = 0.0

                # equal pairs of a row are asked for once
                places = np.flatnonzero(asked)
                row = np.searchsorted(first, places, "right") - 1
                _, one, uses = np.unique(row * len(pairs) + back[places], return_index=True, return_counts=True)
                places, row = places[one], row[one]
                names = ["pair", "before", "context", "word", "n", "uses"]
                wanted = [
                    pa.array(pairs[back[places]].view(np.int64)),
                    pa.array(kinds[before[places]].view(np.int64), mask=~no_before[places]),
                    pa.array(context[places]),
                    pa.array(tokens[places].view(np.int64), mask=~no_word[places]),
                    pa.array(n[places]),
                    pa.array(uses),
                ]
                bounds = np.searchsorted(row, np.arange(hi - lo + 1)).astype(np.int32)
                open_ = pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays(wanted, names))

                rare = np.flatnonzero(~found[inverse])
                row = np.searchsorted(first, rare, "right") - 1
                offsets = np.searchsorted(row, np.arange(hi - lo + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(np.diff(first)),
                        pa.array(V.by_row(found[inverse].astype(np.int64), first)),
                        pa.array(V.by_row(np.where(found, base, 0.0)[inverse], first)),
                        pa.array(V.by_row(each, first)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(tokens[rare].view(np.int64))),
                        open_,
                    ],
                    ["doc_id", "n_tokens", "n_known", "base", "score", "rare", "open"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = stage(
        named.mapInArrow(
            run,
            f"doc_id {kind}, n_tokens long, n_known long, base double, score double, rare array<long>, "
            "open array<struct<pair: long, before: long, context: double, word: long, n: double, uses: long>>",
        ).withColumn("row", F.monotonically_increasing_id()),
        "lm-scores",
    )
    rare = scored.where(F.size("rare") > 0).select("row", F.explode("rare").alias("hash")).groupBy("row", "hash").agg(F.count("*").alias("uses"))
    added = (
        rare.join(words.select("hash", "n"), "hash", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("uses") * F.log10((F.coalesce("n", F.lit(0)) + 1) / F.lit(total))).alias("more"),
            F.sum(F.when(F.col("n").isNotNull(), F.col("uses")).otherwise(0)).alias("known"),
        )
    )
    if cut > 1:
        asked = scored.where(F.size("open") > 0).select("row", F.inline("open"))
        added = added.join(_added_scores(counts, cut, asked, total), "row", "full")
    else:
        added = added.withColumn("more_score", F.lit(0.0))
    return scored.join(added, "row", "left").select(
        "doc_id",
        (fold(F.col("doc_id"), 7) == 2).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(int(n)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )
