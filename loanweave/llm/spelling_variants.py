"""Spelling variants: words one edit apart, found through Bloom filters.

The vocabulary (words that are frequent and long enough, with counts) goes into blocked Bloom
filters, one shard for each word length: a member sets a few bits within one 64-bit block.
The shards are broadcast; their size follows the counts of words up to a fixed bound, beyond
which they let more pass. Tasks generate the edits of every word, as hashes that follow from
the hash of the word, and probe the shard of the edit's length. Only deletions and
replacements by a larger character (of those that the vocabulary has) are generated, as the other edits are these, seen from the
other word; so each pair comes once. Positives are joined to the vocabulary by hash, and the
edit itself is compared, which removes what the filters or equal hashes let through.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanweave.llm import textvec as V
from loanweave.llm.common import ship, text_chunks
from loanweave.sources.staging import stage, staged

#: Code points and uses that make a run a word; one run of a document in ``NOISE`` loses a code point.
LEAST_LENGTH, LEAST_COUNT, NOISE = 5, 3, 97
#: Shards by length; all longer words share the last one.
SHARDS = 64
#: Bits of a filter for each word, bits that a word sets, and most 64-bit blocks of all shards (32 MB).
BITS_PER_WORD, SET_BITS, MOST_BLOCKS = 16, 4, 1 << 22
#: Patterns of ``SET_BITS`` bits that a hash chooses from.
PATTERNS = 1 << 12
#: Code points of words whose edits are made at a time (by one letter after the other; at least
#: one word), and distinct runs in a task's counts.
EDITS, COUNTED = 1 << 16, 1 << 17

_DELETED = 0  # stands for a deletion where a replacing character would stand
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


# --- words and their counts ---


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320) ^ (table >> 1), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


def crc32s(data: np.ndarray, start: np.ndarray, end: np.ndarray, begun: np.ndarray) -> np.ndarray:
    """CRC32 of byte ranges, each carried on from a CRC32 in ``begun``."""
    out, size = ~begun.astype(np.uint32), end - start
    order = np.argsort(-size, kind="stable")
    ranges, left = start[order], out[order]
    longer = np.searchsorted(-size[order], -np.arange(64), "left")  # ranges with more than k bytes
    for k in range(64):
        n = longer[k]
        if not n:
            break
        left[:n] = _CRC[(left[:n] ^ data[ranges[:n] + k]) & np.uint32(0xFF)] ^ (left[:n] >> np.uint32(8))
    left = ~left
    raw = memoryview(np.ascontiguousarray(data))
    for i in range(int((size > 64).sum())):
        left[i] = zlib.crc32(raw[ranges[i] + 64 : ranges[i] + size[order[i]]], int(left[i]))
    out[order] = left
    return out


def runs(texts: pa.Array) -> V.Words:
    """Maximal runs of letters, A-Z lower-cased. U+00C0 to U+00FF are a byte C3 and one more."""
    data, bounds = V.raw_bytes(texts)
    data = V.LOWER[data]
    letter = (data >= 0x61) & (data <= 0x7A)
    lead = data == 0xC3
    letter |= lead
    letter[1:] |= lead[:-1]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    begins, ends = letter.copy(), np.zeros(len(data) + 1, bool)
    begins[1:] &= ~letter[:-1] | edge[1:-1]
    ends[1:] = letter
    ends[1:-1] &= ~letter[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends)
    return V.Words(data, bounds, start, end, np.searchsorted(start, bounds))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of the words of texts, after the noise."""

    def rows(counts: dict[bytes, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([w.decode() for w in counts], pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    counts: dict[bytes, int] = {}
    for batch in batches:
        for lo, hi in text_chunks(batch.column("text")):
            found = runs(batch.column("text").slice(lo, hi - lo))
            points = np.append(0, np.cumsum((found.data & 0xC0) != 0x80))
            length = points[found.end] - points[found.start]
            long_enough = length >= LEAST_LENGTH
            start, end, length, row = found.start[long_enough], found.end[long_enough], length[long_enough], found.row[long_enough]
            begun = np.array([zlib.crc32(f"{i or ''}:".encode()) for i in batch.column("id").slice(lo, hi - lo).to_pylist()], np.uint32)
            crc = crc32s(found.data, start, end, begun[row])
            noisy = crc % NOISE == 0
            raw = found.data.tobytes()
            for s, e, n, h in zip(start[noisy].tolist(), end[noisy].tolist(), length[noisy].tolist(), crc[noisy].tolist()):
                if n > LEAST_LENGTH:
                    word = raw[s:e].decode()
                    key = (word[: h % n] + word[h % n + 1 :]).encode()
                    counts[key] = counts.get(key, 0) + 1
            start, end = start[~noisy], end[~noisy]
            _, at, uses = np.unique(V.segment_hashes(found.data, start, end), return_index=True, return_counts=True)
            for s, e, n in zip(start[at].tolist(), end[at].tolist(), uses.tolist()):
                counts[raw[s:e]] = counts.get(raw[s:e], 0) + n
            if len(counts) >= COUNTED:
                yield rows(counts)
                counts = {}
    yield rows(counts)


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of the distinct words of all texts that are long and frequent enough."""
    texts = docs.select(F.col("doc_id").cast("string").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


# --- hashes of words and of their edits ---


def _weights(begin: int, end: int) -> np.ndarray:
    """Pseudo-random odd factors of the places ``begin`` to ``end`` in a word."""
    return V.mix(np.arange(begin + 1, end + 1, dtype=np.uint64) * _GOLDEN) | np.uint64(1)


def _final(sums: np.ndarray, length: int) -> np.ndarray:
    return V.mix(sums + np.uint64(length * int(_GOLDEN) & (1 << 64) - 1))


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in the list, and code points as one row each, of words of one length, a bounded number at a time."""
    length = np.array([len(w) for w in words], np.int64)
    for n in np.unique(length).tolist():
        at = np.flatnonzero(length == n)
        step = max(EDITS // n, 1)
        for lo in range(0, len(at), step):
            part = at[lo : lo + step]
            raw = "".join([words[i] for i in part.tolist()]).encode("utf-32-le")
            yield part, np.frombuffer(raw, np.uint32).reshape(len(part), n).astype(np.uint64)


def word_hashes(points: np.ndarray) -> np.ndarray:
    return _final((points * _weights(0, points.shape[1])).sum(axis=1, dtype=np.uint64), points.shape[1])


def edits(points: np.ndarray, alphabet: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Length of the edits, the new character, and for each its flat place in ``points`` and its hash."""
    m, n = points.shape
    weight = _weights(0, n)
    whole = (points * weight).sum(axis=1, dtype=np.uint64)
    if n > 1:  # of equal neighbours, only the last one is deleted
        before = np.cumsum(points * weight, axis=1, dtype=np.uint64) - points * weight
        moved = points[:, 1:] * weight[:-1]
        after = np.zeros((m, n), np.uint64)
        after[:, :-1] = moved[:, ::-1].cumsum(axis=1, dtype=np.uint64)[:, ::-1]
        new = np.ones((m, n), bool)
        new[:, :-1] = points[:, 1:] != points[:, :-1]
        at = np.flatnonzero(new)
        yield n - 1, _DELETED, at, _final((before + after).ravel()[at], n - 1)
    without = (whole[:, None] - points * weight).ravel()
    weights, old = np.broadcast_to(weight, (m, n)).ravel(), points.ravel()
    for char in alphabet:
        at = np.flatnonzero(old < char)
        if len(at):
            yield n, int(char), at, _final(without[at] + char * weights[at], n)


# --- Bloom filters ---


def shard(length):
    return np.minimum(length, SHARDS)


def _patterns() -> np.ndarray:
    places = V.mix(np.arange(PATTERNS, dtype=np.uint64) + _GOLDEN)
    out = np.zeros(PATTERNS, np.uint64)
    for i in range(SET_BITS):
        out |= np.uint64(1) << ((places >> np.uint64(6 * i)) & np.uint64(63))
    return out


_PATTERNS = _patterns()


class Shards:
    """Where the blocks of each shard lie in one array, and the bits that a hash sets there."""

    def __init__(self, words: dict[int, int]):
        total = max(sum(words.values()) * BITS_PER_WORD / 64, 1)
        scale = min(1.0, MOST_BLOCKS / total) * BITS_PER_WORD / 64
        size = [max(int(words.get(k, 0) * scale), 1) if words.get(k) else 0 for k in range(SHARDS + 1)]
        self.size = np.array(size, np.uint64)
        self.first = np.append(0, np.cumsum(size)).astype(np.uint64)

    def block(self, hashes: np.ndarray, k: int) -> np.ndarray:
        return self.first[k] + (((hashes >> np.uint64(32)) * self.size[k]) >> np.uint64(32))

    @staticmethod
    def mask(hashes: np.ndarray) -> np.ndarray:
        return _PATTERNS[hashes & np.uint64(PATTERNS - 1)]


def _members(shards: Shards):
    """(block, mask) of the vocabulary, combined for the words of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, points in by_length(batch.column("word").to_pylist()):
                hashes = word_hashes(points)
                block = shards.block(hashes, int(shard(points.shape[1]))).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(shards.mask(hashes).view(np.int64))], ["block", "mask"])

    return run


def build_filter(words: DataFrame, shards: Shards) -> Broadcast:
    """All shards as one array of blocks, broadcast. At most ``MOST_BLOCKS`` and one for each shard reach the driver."""
    blocks = words.select("word").mapInArrow(_members(shards), "block long, mask long").groupBy("block").agg(F.bit_or("mask").alias("mask"))
    found = blocks.toArrow()
    out = np.zeros(int(shards.first[-1]), np.uint64)
    out[found.column("block").to_numpy()] = found.column("mask").to_numpy().view(np.uint64)
    return words.sparkSession.sparkContext.broadcast(out)


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = np.zeros(batch.num_rows, np.uint64)
        for at, points in by_length(batch.column("word").to_pylist()):
            out[at] = word_hashes(points)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out.view(np.int64))], [*batch.schema.names, "hash"])


def _probe(shards: Shards, filter_: Broadcast, alphabet: np.ndarray):
    """(hash, edit, place, letter) of the edits that the filters let through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = filter_.value
        for batch in batches:
            for _, points in by_length(batch.column("word").to_pylist()):
                own = word_hashes(points).view(np.int64)
                found = []
                for length, char, at, hashes in edits(points, alphabet):
                    k = int(shard(length))
                    if shards.size[k]:
                        bits = shards.mask(hashes)
                        some = np.flatnonzero(table[shards.block(hashes, k)] & bits == bits)
                        word, place = np.divmod(at[some], points.shape[1])
                        found.append((own[word], hashes[some].view(np.int64), place, np.full(len(some), char)))
                if found:
                    columns = [pa.array(np.concatenate(c), pa.int64()) for c in zip(*found)]
                    yield pa.RecordBatch.from_arrays(columns, ["hash", "edit", "place", "letter"])

    return run


# --- pairs, forms and roots ---


def near_pairs(words: DataFrame) -> tuple[DataFrame, Broadcast]:
    """(word, n, other, other_n): pairs of words (``word``, ``n``, ``hash``) one edit apart, each once;
    and the filters that they are found through, which can be destroyed once the pairs are stored."""
    sizes = words.groupBy(F.least(F.length("word"), F.lit(SHARDS)).alias("k")).count().collect()  # a row for each shard
    shards = Shards({r["k"]: r["count"] for r in sizes})
    filter_ = build_filter(words, shards)
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).distinct().collect()  # at most 90
    alphabet = np.array(sorted(ord(r["c"]) for r in letters if r["c"]), np.uint64)
    positives = words.select("word").mapInArrow(_probe(shards, filter_, alphabet), "hash long, edit long, place long, letter long")
    others = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"), F.col("hash").alias("edit"))
    start, rest = F.expr("substring(word, 1, CAST(place AS INT))"), F.expr("substring(word, CAST(place AS INT) + 2)")
    made = F.concat(start, F.when(F.col("letter") == _DELETED, F.lit("")).otherwise(F.chr("letter")), rest)
    pairs = positives.join(others, "edit").join(words, "hash").where(made == F.col("other"))
    return pairs.select("word", "n", "other", "other_n"), filter_


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms followed to the last. Each round doubles the steps taken; a form is at
    least twice as frequent as its word, so there are at most six rounds."""
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = stage(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "variants-roots")
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def group(docs: DataFrame) -> DataFrame:
    """One row per word: ``word``, ``n``, ``n_near``, ``form``, ``form_n``, ``root``.

    Runs of letters (A-Z lower-cased, a-z, U+00C0 to U+00FF) of ``text`` are words if, after the
    noise (a code point lost where 97 divides the CRC32 of ``doc_id:run``), they have at least
    5 code points and 3 uses. ``form`` is the most frequent word one edit apart (ties: smallest in
    code-point order) if it is at least twice as frequent, else NULL; ``root`` follows forms to the last.

    - NULL or empty text: no words. A NULL id counts as empty text in the CRC32.
    - Repeated rows count as often as they stand. No words, or no documents: no rows.
    - Words may be of any length. Other columns are not read, so their names cannot clash.
    """
    ship(docs.sparkSession)
    with staged(vocabulary(docs).mapInArrow(_hash, "word string, n long, hash long"), "variants-words") as words:
        pairs, filter_ = near_pairs(words)
        both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
        near = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best"))
        fits = -F.col("best.less") >= 2 * F.col("n")
        with staged(
            words.join(near, "word", "left").select(
                "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(fits, F.col("best.form")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n")
            ),
            "variants-forms",
        ) as forms:
            filter_.destroy()
            roots = _roots(forms.where("form IS NOT NULL"))
            return stage(forms.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word")), "variants")
