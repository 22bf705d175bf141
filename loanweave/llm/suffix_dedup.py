"""Removal of text that repeats an earlier document, by prefix-free parsing.

A string of ``LENGTH`` bytes that also starts in a document with a smaller id is removed
wherever it stands. The corpus order of all such strings is never built byte by byte; it is
put together from a parse and a dictionary, at two scales:

- Rolling-hash triggers (one in 2^``PHRASE_BITS`` places) cut every document into phrases. A phrase
  holds all strings that start before the next trigger, so equal phrases hold equal strings.
  The dictionary is the set of distinct phrases, each owned by the first document that has
  it. All strings of a phrase that its document does not own are removed at once; only owned
  phrases, the dictionary, take part in what follows.
- Within the dictionary each string is known by its trigger: the least rolling hash in it.
  Strings in a row with the same trigger are a block. Equal strings have equal triggers, so
  only blocks whose trigger occurs in several documents are compared. Tasks sort the suffixes
  of the distinct blocks (their suffix array, ``LENGTH`` bytes deep, whole groups of triggers
  at a time); neighbours with a common prefix of ``LENGTH`` bytes are one class, and the
  smallest document of a class, taken from the parse, decides.

Bitmaps of bounded size only spare work: they let more pass when they fill up, and what
passes is compared as bytes or by digests of 128 bits (of a block: trigger and digest). A trigger with very many distinct blocks
is not sorted in one task: its strings are grouped by digest, combined before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanweave.llm import bits
from loanweave.llm import textvec as V
from loanweave.llm.common import ship, shuffle_partitions, text_chunks
from loanweave.sources.staging import stage, staged

#: Bytes of a string that counts as repeated.
LENGTH = 50
#: Bytes of a rolling hash; a place starts a phrase if so many leading bits of its hash are zero.
WIDTH, PHRASE_BITS = 24, 7
#: Distinct blocks of one trigger that a task sorts together.
SORTED_BLOCKS = 1 << 15
#: Bytes of text whose hashes are worked on at a time, bytes whose hashes are kept for two uses, and
#: bytes of blocks sorted at a time.
SLICE, KEPT, SORTED_BYTES = 1 << 18, 1 << 22, 1 << 20

_BASE = 0x9E3779B97F4A7C15
_HIGH, _LOW = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF)
_WINDOWS = LENGTH - WIDTH + 1  # most strings of a block


def rolling(data: np.ndarray) -> np.ndarray:
    """Polynomial hash of the ``WIDTH`` bytes from each place on; put together from the hashes of
    1, 2, 4, ... bytes that add up to ``WIDTH``."""
    part, width, out, done = data.astype(np.uint64) + np.uint64(1), 1, None, 0
    while True:
        factor = np.uint64(pow(_BASE, width, 1 << 64))
        if WIDTH & width:
            n = len(data) - done - width + 1
            out = part if out is None else out[:n] * factor + part[done : done + n]
            done += width
        if 2 * width > WIDTH:
            return out
        part, width = part[:-width] * factor + part[width:], 2 * width


def least(values: np.ndarray, n: int) -> np.ndarray:
    """Least of the ``n`` values from each place on."""
    width = 1
    while 2 * width <= n:
        values, width = np.minimum(values[:-width], values[width:]), 2 * width
    return np.minimum(values[: len(values) - (n - width)], values[n - width :]) if width < n else values


def hashes_of(data: np.ndarray) -> np.ndarray | None:
    """Hashes of the whole text, unless it is long: then they are made again where they are needed."""
    return rolling(data) if WIDTH <= len(data) <= KEPT else None


def _slices(data: np.ndarray, hashes: np.ndarray | None, span: int) -> Iterator[tuple[int, np.ndarray]]:
    """First place, and hashes, of parts of a text; every range of ``span`` bytes starts in one part and ends in it."""
    for lo in range(0, len(data) - span + 1, SLICE):
        end = lo + SLICE + span - 1
        yield lo, rolling(data[lo:end]) if hashes is None else hashes[lo : end - WIDTH + 1]


def phrases(data: np.ndarray, bounds: np.ndarray, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Phrases that hold a string: first string, end of strings, end of bytes, and row."""
    cuts = [bounds[:-1]]
    for lo, part in _slices(data, hashes, WIDTH):
        cuts.append(lo + np.flatnonzero(part < np.uint64(1 << (64 - PHRASE_BITS))))
    start = np.unique(np.concatenate(cuts))
    row = np.searchsorted(bounds, start, "right") - 1
    after = np.append(start[1:], bounds[-1])
    end = np.minimum(after + LENGTH - 1, bounds[np.minimum(row + 1, len(bounds) - 1)])
    some = end - start >= LENGTH
    start, after, end, row = start[some], after[some], end[some], row[some]
    return start, np.minimum(after, end - LENGTH + 1), end, row


def digests(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """128-bit digests of byte ranges, as rows of two integers."""
    raw, digest = memoryview(np.ascontiguousarray(data)), xxhash.xxh3_128_digest
    joined = b"".join([digest(raw[s:e]) for s, e in zip(start.tolist(), end.tolist())])
    return np.frombuffer(joined, np.int64).reshape(-1, 2)


def blocks(
    data: np.ndarray, bounds: np.ndarray, skip: tuple[np.ndarray, np.ndarray], hashes: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigger, first string and end of strings of all blocks, without the ranges of strings to skip."""
    begins, ends = np.concatenate([bounds[1:] - LENGTH + 1, skip[0]]), np.concatenate([bounds[1:], skip[1]])
    out = []
    for lo, part in _slices(data, hashes, LENGTH):
        n = len(part) - (LENGTH - WIDTH)
        lowest = least((part & _HIGH) | np.arange(len(part), dtype=np.uint64), _WINDOWS)
        change = np.zeros(n + 1, np.int32)
        near = (ends > lo) & (begins < lo + n)
        np.add.at(change, np.clip(begins[near] - lo, 0, n), 1)
        np.add.at(change, np.clip(ends[near] - lo, 0, n), -1)
        wanted = np.cumsum(change[:-1]) == 0  # never the last strings of a row, so a run is in one row
        new = np.ones(n, bool)
        new[1:] = (lowest[1:] != lowest[:-1]) | (wanted[1:] != wanted[:-1])
        first = np.flatnonzero(new)
        after = np.append(first[1:], n)[wanted[first]]
        first = first[wanted[first]]
        out.append((V.mix(part[lowest[first] & _LOW]).view(np.int64), lo + first, lo + after))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out))


def _table(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], list(columns))


def _unsigned(values: np.ndarray) -> np.ndarray:
    return values.view(np.uint64)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, pa.RecordBatch]]:
    """Ids, bytes, bounds and rows of about a megabyte of texts at a time."""
    for batch in batches:
        for lo, hi in text_chunks(batch.column("text")):
            part = batch.slice(lo, hi - lo)
            ids = part.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
            yield ids, *V.raw_bytes(part.column("text")), part


def _phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, data, bounds, _ in _chunks(batches):
        start, _, end, row = phrases(data, bounds)
        found = digests(data, start, end)
        yield _table(p1=found[:, 0], p2=found[:, 1], doc=ids[row])


def _foreign(
    ids: np.ndarray, data: np.ndarray, bounds: np.ndarray, owners: np.ndarray, hashes: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of strings in phrases that certainly belong to an earlier document, and their rows."""
    start, after, end, row = phrases(data, bounds, hashes)
    found = digests(data, start, end)
    other = ~bits.holds(owners, _unsigned(found[:, 0] ^ ids[row]))
    return start[other], after[other], row[other]


def _triggers(owners: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, data, bounds, _ in _chunks(batches):
            hashes = hashes_of(data)
            trigger, first, _ = blocks(data, bounds, _foreign(ids, data, bounds, owners.value, hashes)[:2], hashes)
            row = np.searchsorted(bounds, first, "right") - 1
            order = np.lexsort((trigger, row))
            row, trigger = row[order], trigger[order]
            once = np.ones(len(row), bool)  # a trigger of a text counts once
            once[1:] = (row[1:] != row[:-1]) | (trigger[1:] != trigger[:-1])
            yield _table(t=trigger[once])

    return run


def _text_keys(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    raw = memoryview(np.ascontiguousarray(data))
    return np.array([xxhash.xxh3_64_intdigest(raw[s:e]) for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist())], np.uint64).view(np.int64)


def _candidates(owners: Broadcast, shared: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, data, bounds, _ in _chunks(batches):
            hashes = hashes_of(data)
            trigger, first, after = blocks(data, bounds, _foreign(ids, data, bounds, owners.value, hashes)[:2], hashes)
            some = bits.holds(shared.value, _unsigned(trigger))
            trigger, first, after = trigger[some], first[some], after[some]
            row = np.searchsorted(bounds, first, "right") - 1
            end = after + LENGTH - 1
            found, raw = digests(data, first, end)[:, 0], memoryview(np.ascontiguousarray(data))
            body = pa.array([raw[s:e].tobytes() for s, e in zip(first.tolist(), end.tolist())], pa.binary())
            yield _table(t=trigger, b=found, doc=ids[row], text_key=_text_keys(data, bounds)[row], at=first - bounds[row], body=body)

    return run


def _to_sort(mixed: Broadcast, firsts: Broadcast, hot: Broadcast, split: bool):
    """Blocks that the first document with them sends to be compared: those of hot triggers as
    single strings with their digests (``split``), the others whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t, b, doc = (batch.column(c).to_numpy() for c in ("t", "b", "doc"))
            some = bits.holds(mixed.value, _unsigned(t)) & bits.holds(firsts.value, _unsigned(b ^ doc))
            some &= bits.holds(hot.value, _unsigned(t)) == split
            place = np.flatnonzero(some)
            place = place[np.lexsort((doc[place], b[place], t[place]))]
            once = np.ones(len(place), bool)  # a block may stand in its first document many times
            once[1:] = (t[place][1:] != t[place][:-1]) | (b[place][1:] != b[place][:-1]) | (doc[place][1:] != doc[place][:-1])
            part = batch.take(pa.array(place[once])).select(["t", "b", "doc", "body"])
            if not split:
                yield part
                continue
            data, bounds = V.raw_bytes(part.column("body").cast(pa.large_binary()))
            n = np.diff(bounds) - LENGTH + 1
            row = np.repeat(np.arange(len(n)), n)
            place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            found = digests(data, bounds[row] + place, bounds[row] + place + LENGTH)
            own = part.take(pa.array(row)).select(["t", "b", "doc"])
            yield pa.RecordBatch.from_arrays([*own.columns, pa.array(found[:, 0]), pa.array(found[:, 1]), pa.array(place)], ["t", "b", "doc", "s1", "s2", "place"])

    return run


def suffix_classes(data: np.ndarray, bounds: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each block, a bit for every string of it that also occurs in a block of a smaller document.

    Sorts all strings of the blocks, which are their suffixes cut at ``LENGTH`` bytes, by eight
    bytes after the other; equal neighbours are one class.
    """
    n = np.diff(bounds) - LENGTH + 1
    block = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(block)) - np.repeat(np.cumsum(n) - n, n)
    start = bounds[block] + place
    eight = np.zeros(len(data) - 7, np.uint64)
    for i in range(8):
        eight = (eight << np.uint64(8)) | data[i : len(data) - 7 + i]
    keys = [eight[start + min(i, LENGTH - 8)] for i in range(0, LENGTH, 8)]
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    first = np.flatnonzero(new)
    smallest = np.repeat(np.minimum.reduceat(doc[block][order], first), np.diff(np.append(first, len(order))))
    earlier = np.zeros(len(order), bool)
    earlier[order] = smallest < doc[block][order]
    out = np.zeros(len(n), np.int64)
    np.bitwise_or.at(out, block[earlier], np.int64(1) << place[earlier])
    return out


def _sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Masks of blocks that come in order of their triggers; a trigger's blocks are sorted together."""

    def masks(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        data, bounds = V.raw_bytes(table.column("body").combine_chunks().cast(pa.large_binary()))
        found = suffix_classes(data, bounds, table.column("doc").to_numpy())
        some = pa.array(found != 0)
        own = [table.column(c).combine_chunks().filter(some) for c in ("t", "b", "doc")]
        return pa.RecordBatch.from_arrays([*own, pa.array(found).filter(some)], ["t", "b", "doc", "mask"])

    held, size = [], 0
    for batch in batches:
        for lo in range(0, batch.num_rows, SORTED_BLOCKS):
            part = batch.slice(lo, SORTED_BLOCKS)
            held.append(part)
            size += part.num_rows * LENGTH
            if size < SORTED_BYTES:
                continue
            rows = pa.Table.from_batches(held)
            t = rows.column("t").to_numpy()
            last = int(np.searchsorted(t, t[-1]))  # the last trigger may go on
            if last:
                yield masks(rows.slice(0, last))
                held, size = rows.slice(last).to_batches(), (len(t) - last) * LENGTH
    if size:
        yield masks(pa.Table.from_batches(held))


def _marks(docs: DataFrame, owners: Broadcast) -> DataFrame:
    """(doc, text_key, found): strings of owned phrases that are repeated, as first place and bits."""
    spark = docs.sparkSession
    triggers = docs.mapInArrow(_triggers(owners), "t long").groupBy("t").agg(F.count("*").alias("texts"))
    with staged(triggers.where("texts > 1").select("t"), "dedup-triggers") as common:
        shared = bits.build(common, "t", bits.size_for(common.count()))
    kind = "t long, b long, doc long, text_key long, at long, body binary"
    with (
        staged(docs.mapInArrow(_candidates(owners, shared), kind), "dedup-candidates") as candidates,
        staged(candidates.groupBy("t", "b").agg(F.min("doc").alias("first")), "dedup-blocks") as distinct,
        staged(
            distinct.groupBy("t").agg(F.count("*").alias("n"), F.min("first").alias("low"), F.max("first").alias("high")).where("n > 1 AND low < high").select("t", "n"),
            "dedup-mixed",
        ) as per_trigger,
    ):
        mixed = bits.build(per_trigger, "t", bits.size_for(per_trigger.count()))
        hot = bits.build(per_trigger.where(F.col("n") > SORTED_BLOCKS), "t", bits.SMALLEST)
        owned = distinct.select(F.col("b").bitwiseXOR(F.col("first")).alias("key"))
        firsts = bits.build(owned, "key", bits.size_for(distinct.count()))
        parts = shuffle_partitions(spark)
        whole = candidates.select("t", "b", "doc", "body").mapInArrow(_to_sort(mixed, firsts, hot, False), "t long, b long, doc long, body binary")
        masks = whole.repartition(parts, "t").sortWithinPartitions("t").mapInArrow(_sort, "t long, b long, doc long, mask long")
        single = candidates.select("t", "b", "doc", "body").mapInArrow(_to_sort(mixed, firsts, hot, True), "t long, b long, doc long, s1 long, s2 long, place long")
        with staged(single, "dedup-hot") as strings:
            lowest = strings.groupBy("s1", "s2").agg(F.min("doc").alias("low"))
            late = strings.join(lowest, ["s1", "s2"]).where("low < doc").selectExpr("t", "b", "doc", "shiftleft(1L, CAST(place AS INT)) AS mask")
            every = masks.unionByName(late).groupBy("t", "b", "doc").agg(F.bit_or("mask").alias("mask"))
            known = distinct.join(every.withColumnRenamed("doc", "first"), ["t", "b", "first"], "left").select("t", "b", "first", "mask")
            full = F.expr(f"shiftleft(1L, CAST(octet_length(body) AS INT) - {LENGTH - 1}) - 1")
            uses = candidates.select("t", "b", "doc", "text_key", "at", full.alias("full")).join(known, ["t", "b"])
            found = uses.withColumn("bits", F.when(F.col("doc") > F.col("first"), F.col("full")).otherwise(F.col("mask"))).where("bits != 0")
            marks = stage(found.groupBy("doc", "text_key").agg(F.collect_set(F.struct("at", "bits")).alias("found")), "dedup-marks")
    for bitmap in (shared, mixed, hot, firsts):
        bitmap.destroy()
    return marks


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def _spans(first: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal byte ranges covered by the strings of the given ranges."""
    order = np.argsort(first, kind="stable")
    start, end = first[order], np.maximum.accumulate(after[order] + LENGTH - 1) if len(order) else after
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    begin = np.flatnonzero(new)
    return start[begin], end[np.append(begin[1:], len(start)) - 1] if len(begin) else end


def _cut(raw: memoryview, first: np.ndarray, after: np.ndarray) -> tuple[int, int, bytes]:
    """Removed bytes, spans, and what is left of a text."""
    start, end = _spans(first, after)
    kept = b"".join(raw[a:b] for a, b in zip([0, *end.tolist()], [*start.tolist(), len(raw)]))
    return len(raw) - len(kept), len(start), kept


def _first_cut(owners: Broadcast, marked: Broadcast, codec: str, digest: bool):
    """Finished rows for texts without marks; for the others the text, compressed, and the ranges of strings in foreign phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = pa.Codec(codec)
        for ids, data, bounds, part in _chunks(batches):
            raw, keys = memoryview(np.ascontiguousarray(data)), _text_keys(data, bounds)
            nameless = part.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            first, after, row = _foreign(ids, data, bounds, owners.value)
            at = np.searchsorted(row, np.arange(len(ids) + 1))
            open_ = bits.holds(marked.value, _unsigned(keys ^ ids)) & ~nameless
            rows = []
            for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                mine = slice(at[i], at[i] if nameless[i] else at[i + 1])
                ranges = first[mine] - a, after[mine] - a
                if open_[i]:
                    rows.append((b - a, None, None, None, pack.compress(raw[a:b], asbytes=True), np.concatenate(ranges).tobytes()))
                else:
                    removed, spans, kept = _cut(raw[a:b], *ranges)
                    rows.append((b - a, removed, spans, _shown(kept, digest), None, None))
            sizes, removed, spans, kept, body, gone = zip(*rows)
            yield _table(
                doc_id=part.column("doc_id"), text_key=keys, n_bytes=pa.array(sizes, pa.int64()), n_removed=pa.array(removed, pa.int64()), n_spans=pa.array(spans, pa.int64()),
                kept=pa.array(kept, pa.binary()), body=pa.array(body, pa.binary()), gone=pa.array(gone, pa.binary()),
            )

    return run


def _shown(kept: bytes, digest: bool) -> bytes:
    return hashlib.sha256(kept).digest() if digest else kept


def _last_cut(codec: str, digest: bool):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, bit = pa.Codec(codec), np.arange(_WINDOWS)
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                batch = whole.slice(lo, 256)
                rows = list(zip(*(batch.column(c).to_pylist() for c in ("n_bytes", "n_removed", "n_spans", "kept"))))
                for i in np.flatnonzero(batch.column("body").is_valid().to_numpy(zero_copy_only=False)).tolist():
                    raw = memoryview(pack.decompress(batch.column("body")[i].as_buffer(), rows[i][0])) if rows[i][0] else memoryview(b"")
                    first, after = np.frombuffer(batch.column("gone")[i].as_py(), np.int64).reshape(2, -1)
                    marks = batch.column("found")[i]
                    if marks.is_valid:
                        at, mask = (marks.values.field(c).to_numpy() for c in ("at", "bits"))
                        which, place = np.nonzero((mask[:, None] >> bit) & 1)
                        more = at[which] + place
                        first, after = np.concatenate([first, more]), np.concatenate([after, more + 1])
                    removed, spans, kept = _cut(raw, first, after)
                    rows[i] = (rows[i][0], removed, spans, _shown(kept, digest))
                sizes, removed, spans, kept = zip(*rows)
                columns = [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in (sizes, removed, spans)), pa.array(kept, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def dedup(docs: DataFrame, digest: bool = False) -> DataFrame:
    """One row per row of ``docs`` (integer ``doc_id``, ``text``): ``doc_id``, ``n_bytes`` of the
    text in UTF-8, ``n_removed`` bytes, ``n_spans`` (maximal removed runs), and ``kept``, the
    remaining bytes (with ``digest`` their SHA-256).

    - NULL or empty text, or one shorter than ``LENGTH``: nothing is removed.
    - Rows with a NULL id take no part: nothing is removed from them or because of them.
    - Rows that share an id do not remove each other's text, whether or not they are equal.
    - Strings are compared as bytes, so a removed run may begin or end inside a character.
    - No documents: no rows. Other columns are not read, so their names cannot clash.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    named = texts.where("doc_id IS NOT NULL")
    parse = named.mapInArrow(_phrases, "p1 long, p2 long, doc long")
    dictionary = parse.groupBy("p1", "p2").agg(F.min("doc").alias("owner"))
    with staged(dictionary.select(F.col("p1").bitwiseXOR(F.col("owner")).alias("key")), "dedup-phrases") as owned:
        owners = bits.build(owned, "key", bits.size_for(owned.count()))
    marks = _marks(named, owners)
    marked = bits.build(marks.select(F.col("text_key").bitwiseXOR(F.col("doc")).alias("key")), "key", bits.size_for(marks.count()))
    columns = "doc_id long, text_key long, n_bytes long, n_removed long, n_spans long, kept binary, body binary, gone binary"
    begun = texts.mapInArrow(_first_cut(owners, marked, "zstd", digest), columns)
    return begun.join(marks.withColumnRenamed("doc", "doc_id"), ["doc_id", "text_key"], "left").mapInArrow(_last_cut("zstd", digest), _RESULT)
