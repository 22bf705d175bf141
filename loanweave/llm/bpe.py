"""Byte-level BPE: encoding by a table of distinct words, decoding by a table of pieces.

Spark counts the distinct words of all texts, and each is encoded once, by tasks of their own.
Ids come back by joins: the most frequent words, a bounded number, are a broadcast table that
tasks look up at each word's position; the uses of all other words, which are few, are
joined to the table of the rare words and gathered by text. So only texts, compressed, and
rare words move. Decoding joins each id to its piece in the vocabulary, whose size is fixed and
which every task therefore holds. Words of more than ``TABLE_WORD_BYTES`` bytes, and texts with
special tokens or characters of no settled class, are encoded where they stand.

Tasks cut, look up and join whole chunks of texts as arrays of code points; within a task a
word is known by a 64-bit hash of its code points.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

from loanweave.llm import textvec as V
from loanweave.llm.common import least_frequent, ship, text_chunks
from loanweave.sources.staging import stage

#: Words in the broadcast table, and bytes of a word in it: at most about 40 MB in all.
TABLE_WORDS, TABLE_WORD_BYTES = 1 << 20, 64
#: Long words in a task's cache, words in its counts before it sends them, and rows unpacked at a time.
CACHE_WORDS, COUNTED_WORDS, UNPACKED_ROWS = 1 << 12, 1 << 17, 256
#: Stands between a word and its ids; no byte of UTF-8.
_END = b"\xff"
#: Longer words are merged with a heap instead of a scan.
LONG_WORD = 256

# Fixed value: how the byte-level pre-tokenizer cuts words. White space is Unicode's property.
SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
# Ranges in which all Unicode versions in use class characters alike. A text with
# any other character is cut by the tokenizers library, whose tables are older than those of regex.
SETTLED = "\x00-\u0557\u0590-\u088e\u0900-\u0c5b\u0d00-\u208e\u20a0-\ua7cd\uac00-\U000107ba\U0001f000-\U0001faff"
_NONE = 1 << 62
LETTER, NUMBER, BLANK, OTHER, UNSETTLED = range(5)


def _letters() -> dict[str, int]:
    """The printable stand-in of each byte: itself, or the next free character from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in plain}
    for n, b in enumerate(sorted(set(range(256)) - set(plain))):
        out[chr(256 + n)] = b
    return out


@dataclass
class Vocabulary:
    """Pieces and merges of a tokenizer file, as plain values that can be sent to tasks."""

    pieces: list[bytes]  # by id
    merges: dict[int, int]  # left id and right id -> rank and id of the result, packed
    bytes_: list[int]  # id of each single byte
    special: dict[str, int]

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters, ids = _letters(), spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pieces = [b""] * (max([*ids.values(), *special.values()]) + 1)
        for token, i in ids.items():
            pieces[i] = bytes(letters[c] for c in token)
        for token, i in special.items():
            pieces[i] = token.encode()
        merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            merges[ids[left] << 32 | ids[right]] = rank << 32 | ids[left + right]
        return cls(pieces, merges, [ids[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])], special)

    @cached_property
    def classes(self) -> np.ndarray:
        """Class of each code point: letter, number, white space, other, or not settled."""
        out = np.full(0x110000, UNSETTLED, np.uint8)
        for low, high in zip(SETTLED[::3], SETTLED[2::3]):
            out[ord(low) : ord(high) + 1] = OTHER
        every = "".join(map(chr, np.flatnonzero(out == OTHER).tolist()))
        for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (BLANK, r"\p{White_Space}")):
            out[[ord(c) for c in regex.findall(pattern, every)]] = kind
        return out

    @cached_property
    def _cut(self):
        own, unsettled = regex.compile(SPLIT).findall, regex.compile(f"[^{SETTLED}]").search
        library = ByteLevel(add_prefix_space=False).pre_tokenize_str

        def words(text: str) -> list[str]:
            if not text.isascii() and unsettled(text):
                return [text[a:b] for _, (a, b) in library(text)]
            return own(text)

        if not self.special:
            return words
        marks = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")

        def cut(text: str) -> list[str]:
            if not any(s in text for s in self.special):
                return words(text)
            parts = marks.split(text)
            return [w for i, part in enumerate(parts) for w in ([part] if i % 2 else words(part))]

        return cut

    def words(self, text: str) -> list[str]:
        """Words of the text in order; special tokens are words of their own."""
        return self._cut(text)

    def encode_word(self, word: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers. The pair of the lowest rank is merged
        first, of equal ones the leftmost."""
        if word in self.special:
            return np.array([self.special[word]], "<u4").tobytes()
        ids = [self.bytes_[b] for b in word.encode("utf-8", "replace")]
        ids = self._merge_long(ids) if len(ids) > LONG_WORD else self._merge(ids)
        return np.array(ids, "<u4").tobytes()

    def _merge(self, ids: list[int]) -> list[int]:
        get = self.merges.get
        ranks = [get(a << 32 | b, _NONE) for a, b in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == _NONE:
                break
            i = ranks.index(best)
            ids[i] = best & 0xFFFFFFFF
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get(ids[i - 1] << 32 | ids[i], _NONE)
            if i < len(ranks):
                ranks[i] = get(ids[i] << 32 | ids[i + 1], _NONE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n:
                found = self.merges.get(ids[i] << 32 | ids[j])
                if found is not None:
                    heapq.heappush(heap, (found >> 32, i, ids[i], ids[j], found & 0xFFFFFFFF))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, left, right, merged = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue
            ids[i], ids[j] = merged, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [i for i in ids if i >= 0]


def word_starts(points: np.ndarray, bounds: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """First code points of all words of texts that lie one after the other, as ``SPLIT`` cuts them.

    A word ends where the next one starts. Runs of one class are words, but: a single space
    belongs to the run after it; of several blanks before a run, the last one is on its own
    or belongs to the run; and an apostrophe that starts a word takes a known ending with it.
    """
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    begins = np.zeros(n + 1, bool)
    begins[bounds] = True  # of texts
    blank = kind == BLANK
    start = begins[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    inner = ~begins[1:n]
    start[:-1] |= blank[:-1] & ~blank[1:] & inner
    start[1:] &= ~((points[:-1] == 0x20) & ~blank[1:] & inner)

    quote = np.flatnonzero((points == 0x27) & start)
    ahead = np.append(points, [0, 0])
    begins = np.append(begins, True)
    one, two = ahead[quote + 1], ahead[quote + 2]
    same = ~begins[quote + 1]
    short = same & np.isin(one, [ord(c) for c in "stmd"])
    ending = [(one == ord(a)) & (two == ord(b)) for a, b in ("re", "ve", "ll")]
    long = same & ~begins[quote + 2] & (ending[0] | ending[1] | ending[2])
    start = np.append(start, False)
    start[quote[short | long] + 1] = False
    start[np.concatenate([quote[short] + 2, quote[long] + 3])] = True
    return np.flatnonzero(start[:n])


@dataclass
class Cut:
    """Words of some texts: the texts joined, the words' first and last places and hashes, and
    where the words of each text begin. ``odd`` texts are left empty here, to be cut one by one."""

    text: str
    start: np.ndarray
    end: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    odd: list[int]

    def word(self, i: int) -> str:
        return self.text[self.start[i] : self.end[i]]


def cut(texts: list[str], vocabulary: Vocabulary) -> Cut:
    odd = [i for i, t in enumerate(texts) if any(s in t for s in vocabulary.special)]
    while True:
        for i in odd:
            texts = [*texts[:i], "", *texts[i + 1 :]]
        joined = "".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]) if texts else np.zeros(1, np.int64)
        kind = vocabulary.classes[points]
        unsettled = np.flatnonzero(kind == UNSETTLED)
        if not len(unsettled):
            break
        odd = sorted({*odd, *(np.searchsorted(bounds, unsettled, "right") - 1).tolist()})
    start = word_starts(points, bounds, kind)
    end = np.append(start[1:], len(points))[: len(start)]
    return Cut(joined, start, end, V.segment_hashes(points, start, end), np.searchsorted(start, bounds), odd)


def _chunks(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    for lo, hi in text_chunks(texts):
        yield lo, texts.slice(lo, hi - lo).to_pylist()


def _count_words(vocabulary: Broadcast):
    def rows(counts: dict[str, int]) -> pa.RecordBatch:
        # in order, so that neighbours in a shuffle file share their beginnings and pack well
        short = sorted((w, n) for w, n in counts.items() if len(w) <= TABLE_WORD_BYTES)
        columns = [pa.array([w for w, _ in short], pa.string()), pa.array([n for _, n in short], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for batch in batches:
            for _, texts in _chunks(batch.column("text")):
                found = cut(texts, vocabulary.value)
                _, at, n = np.unique(found.hashes, return_index=True, return_counts=True)
                for word, more in zip(map(found.word, at.tolist()), n.tolist()):
                    counts[word] = counts.get(word, 0) + more
                for i in found.odd:
                    for word in vocabulary.value.words(texts[i]):
                        counts[word] = counts.get(word, 0) + 1
                if len(counts) >= COUNTED_WORDS:
                    yield rows(counts)
                    counts = {}
        yield rows(counts)

    return run


def id_type(vocabulary: Vocabulary) -> np.dtype:
    """The shortest integers that hold the ids of rare words, which travel."""
    return np.dtype("<u2" if len(vocabulary.pieces) <= 1 << 16 else "<u4")


def _encode_table(vocabulary: Broadcast, short: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [vocabulary.value.encode_word(w) for w in batch.column("word").to_pylist()]
            if short:
                kind = id_type(vocabulary.value)
                ids = [np.frombuffer(x, "<u4").astype(kind).tobytes() for x in ids]
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(ids, pa.binary())], ["word", "ids"])

    return run


def count_words(texts: DataFrame, vocabulary: Broadcast) -> DataFrame:
    """(word, n) of all distinct words of at most ``TABLE_WORD_BYTES``."""
    counted = texts.mapInArrow(_count_words(vocabulary), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.octet_length("word") <= TABLE_WORD_BYTES)


def encoded(words: DataFrame, vocabulary: Broadcast, short: bool = False) -> DataFrame:
    """(word, ids) of distinct words, each encoded once; ids of 4 bytes, or ``short`` ones of ``id_type``."""
    return words.select("word").mapInArrow(_encode_table(vocabulary, short), "word string, ids binary")


class Table:
    """Words by hash, each with its place in one long array of ids; made from (word, ids)."""

    def __init__(self, words: pa.Table, vocabulary: Vocabulary):
        plain = words.filter(pc.invert(pc.is_in(words.column("word"), pa.array(list(vocabulary.special), pa.string()))))
        hashes, sizes, ids = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        for batch in plain.to_batches(max_chunksize=1 << 16):  # the driver's memory is small
            text, bounds = V.raw_bytes(batch.column("word"))
            points = np.frombuffer(text.tobytes().decode().encode("utf-32-le"), np.uint32)
            end = np.cumsum(V.by_row(((text & 0xC0) != 0x80).astype(np.int64), bounds))
            hashes.append(V.segment_hashes(points, np.append(0, end[:-1])[: len(end)], end))
            raw, at = V.raw_bytes(batch.column("ids"))
            sizes.append(np.diff(at) // 4)
            ids.append(np.frombuffer(raw.tobytes(), np.int32))
        every, size = np.concatenate(hashes), np.concatenate(sizes)
        order = np.argsort(every)
        self.hashes, self.size, self.start = every[order], size[order], (np.cumsum(size) - size)[order]
        self.ids = np.concatenate(ids)


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places ``start`` to ``start + size``, range after range."""
    ahead = np.cumsum(size) - size
    return np.repeat(start - ahead, size) + np.arange(int(size.sum()))


@dataclass
class Found:
    """Distinct words of a cut: where each stands first, which one every word is, and its place in the table."""

    index: np.ndarray
    inverse: np.ndarray
    place: np.ndarray
    known: np.ndarray


def find(words: Cut, table: Table) -> Found:
    kinds, index, inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
    place = np.minimum(np.searchsorted(table.hashes, kinds), max(len(table.hashes) - 1, 0))
    known = table.hashes[place] == kinds if len(table.hashes) else np.zeros(len(kinds), bool)
    return Found(index, inverse, place, known)


def _rare_uses(vocabulary: Broadcast, shared: Broadcast):
    """(key, word) of each text and each word in it that the broadcast table lacks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy()
            for lo, texts in _chunks(batch.column("text")):
                words = cut(texts, vocabulary.value)
                found = find(words, shared.value)
                at = np.flatnonzero(~found.known[found.inverse])
                owner = np.searchsorted(words.first, at, "right") - 1
                once = np.unique(owner * len(found.index) + found.inverse[at])
                owner, kind = np.divmod(once, max(len(found.index), 1))
                rows = [(k, w) for k, w in zip(keys[lo + owner].tolist(), map(words.word, found.index[kind].tolist())) if len(w.encode()) <= TABLE_WORD_BYTES]
                columns = list(zip(*rows)) if rows else [(), ()]
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string())], ["key", "word"])

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``text`` becomes its compressed bytes in ``body`` and their length before in ``size``."""
    pack = pa.Codec("zstd", compression_level=6)
    for batch in batches:
        raw = [t.encode() for t in batch.column("text").to_pylist()]
        bodies = [pack.compress(t, asbytes=True) for t in raw]
        at = batch.schema.get_field_index("text")
        rest = [c for i, c in enumerate(batch.columns) if i != at]
        names = [n for i, n in enumerate(batch.schema.names) if i != at]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(bodies, pa.binary()), pa.array([len(t) for t in raw], pa.int64())], [*names, "body", "size"])


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = pa.Codec("zstd")
    for whole in batches:
        for lo in range(0, whole.num_rows, UNPACKED_ROWS):
            batch = whole.slice(lo, UNPACKED_ROWS)
            pairs = zip(batch.column("body").to_pylist(), batch.column("size").to_pylist())
            texts = pa.array([pack.decompress(b, n).to_pybytes().decode() if n else "" for b, n in pairs], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), texts, batch.column("rare")], ["doc_id", "text", "rare"])


def _encode(vocabulary: Broadcast, shared: Broadcast):
    """``text`` and ``rare`` (its words outside the table, each with its ids) become ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, table, cache = vocabulary.value, shared.value, {}
        kind = id_type(vocab)

        def long_word(word: str) -> np.ndarray:
            ids = cache.get(word)
            if ids is None:
                ids = np.frombuffer(vocab.encode_word(word), np.int32)
                if len(cache) >= CACHE_WORDS:
                    cache.clear()
                cache[word] = ids
            return ids

        for batch in batches:
            for lo, texts in _chunks(batch.column("text")):
                part = batch.slice(lo, len(texts))
                uses = [use.partition(_END) for use in part.column("rare").flatten().to_pylist()]
                rare = {word.decode(): ids for word, _, ids in uses}
                words = cut(texts, vocab)
                found = find(words, table)
                names = [words.word(i) for i in found.index[~found.known].tolist()]
                more = [np.frombuffer(rare[w], kind).astype(np.int32) if w in rare else long_word(w) for w in names]
                size, start = np.empty(len(found.index), np.int64), np.empty(len(found.index), np.int64)
                size[found.known], start[found.known] = table.size[found.place[found.known]], table.start[found.place[found.known]]
                size[~found.known] = [len(m) for m in more]
                start[~found.known] = len(table.ids) + np.cumsum(size[~found.known]) - size[~found.known]
                where = spread(start[found.inverse], size[found.inverse])
                if more:  # ids of this chunk's rare words follow those of the table
                    pool, late = table.ids, np.concatenate(more)
                    ids = np.where(where < len(pool), pool[np.minimum(where, max(len(pool) - 1, 0))] if len(pool) else 0, late[np.maximum(where - len(pool), 0) % len(late)])
                else:
                    ids = table.ids[where]
                ends = np.append(0, np.cumsum(size[found.inverse]))[words.first]
                if words.odd:
                    each = [ids[a:b] for a, b in zip(ends[:-1], ends[1:])]
                    for i in words.odd:
                        each[i] = np.frombuffer(b"".join(map(vocab.encode_word, vocab.words(texts[i]))), np.int32)
                    ids, ends = np.concatenate(each), np.append(0, np.cumsum([len(e) for e in each]))
                coded = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), coded], ["doc_id", "ids"])

    return run


def _decode(vocabulary: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = np.array([len(p) for p in vocabulary.value.pieces], np.int64)
        start, pieces = np.cumsum(size) - size, np.frombuffer(b"".join(vocabulary.value.pieces), np.uint8)
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                lists = part.column("ids")
                at = lists.offsets.to_numpy()
                ids = lists.values.to_numpy()[at[0] : at[-1]]
                raw = pieces[spread(start[ids], size[ids])].tobytes()
                ends = np.append(0, np.cumsum(size[ids]))[at - at[0]]
                texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, "decoded"])

    return run


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``n_tokens`` and ``ids_sha256`` (hex, of little-endian unsigned 32-bit ids) instead of ``ids``."""
    for batch in batches:
        at = batch.schema.get_field_index("ids")
        ids = batch.column(at)
        offsets = ids.offsets.to_numpy()
        raw = memoryview(ids.values.to_numpy()[offsets[0] : offsets[-1]].astype("<u4").tobytes())
        ends = (offsets - offsets[0]) * 4
        digests = [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(ends[:-1], ends[1:])]
        columns = [c for i, c in enumerate(batch.columns) if i != at]
        names = [n for i, n in enumerate(batch.schema.names) if i != at]
        sizes = pa.array((np.diff(offsets)).astype(np.int64))
        yield pa.RecordBatch.from_arrays([*columns, sizes, pa.array(digests, pa.string())], [*names, "n_tokens", "ids_sha256"])


def _chain(*steps):
    """Steps from batches to batches, one after the other in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps:
            batches = step(batches)
        yield from batches

    return run


def _encoder(docs: DataFrame, path: str) -> tuple[DataFrame, Broadcast, Broadcast]:
    """Rows (doc_id, body, size, rare) to encode, the vocabulary and the table of words for the tasks."""
    spark = docs.sparkSession
    ship(spark)
    vocabulary = spark.sparkContext.broadcast(Vocabulary.load(path))
    texts = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    counted = stage(count_words(texts.select("text"), vocabulary).sortWithinPartitions("word"), "bpe-words")
    least = least_frequent(counted, "n", TABLE_WORDS)
    frequent = encoded(counted.where(F.col("n") >= least), vocabulary).toArrow()
    table = spark.sparkContext.broadcast(Table(frequent, vocabulary.value))
    # Texts that share a key share their rare words, which does no harm.
    uses = texts.select("key", "text").mapInArrow(_rare_uses(vocabulary, table), "key long, word string")
    rare = uses.join(encoded(counted.where(F.col("n") < least), vocabulary, short=True), "word")
    pair = F.concat(F.col("word").cast("binary"), F.lit(_END), "ids")
    by_text = rare.groupBy("key").agg(F.collect_set(pair).alias("rare"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    bodies = texts.select("doc_id", "key", "text").mapInArrow(_packed, f"doc_id {kind}, key long, body binary, size long")
    none = F.array().cast("array<binary>")
    joined = bodies.join(by_text, "key", "left").select("doc_id", "body", "size", F.coalesce("rare", none).alias("rare"))
    return joined, vocabulary, table


def encode(docs: DataFrame, path: str) -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` and ``ids`` (array of int).

    ``path`` names a tokenizer file on the driver; its vocabulary and merges are sent to the tasks.

    - NULL or empty text: no ids. Special tokens in a text become their ids.
    - Repeated rows: each is encoded. No documents: no rows.
    - Very long words are merged in time that grows as n log n.
    - Other columns are not read, so their names cannot clash.
    """
    texts, vocabulary, table = _encoder(docs, path)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(_chain(_unpacked, _encode(vocabulary, table)), f"doc_id {kind}, ids array<int>")


def decode(coded: DataFrame, path: str) -> DataFrame:
    """``coded`` (``doc_id``, ``ids``) with ``decoded``; bytes that are no UTF-8 become U+FFFD. NULL ids: empty."""
    ship(coded.sparkSession)
    vocabulary = coded.sparkSession.sparkContext.broadcast(Vocabulary.load(path))
    plain = coded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    kind = coded.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(_decode(vocabulary), f"doc_id {kind}, ids array<int>, decoded string")


def encode_and_decode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded``: as ``decode`` of ``encode``, with the vocabulary sent once."""
    texts, vocabulary, table = _encoder(docs, path)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(_chain(_unpacked, _encode(vocabulary, table), _decode(vocabulary)), f"doc_id {kind}, ids array<int>, decoded string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``decoded`` (from the ids), ``n_tokens`` and ``ids_sha256``: ``encode`` and ``decode``
    of each text in one task, so that ids, which are as large as the texts, need not be sent on."""
    texts, vocabulary, table = _encoder(docs, path)
    kind = docs.schema["doc_id"].dataType.simpleString()
    steps = _chain(_unpacked, _encode(vocabulary, table), _decode(vocabulary), _digest)
    return texts.mapInArrow(steps, f"doc_id {kind}, decoded string, n_tokens long, ids_sha256 string")
