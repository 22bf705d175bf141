"""Jaccard join, language model, decontamination, BPE and quality rules beside brute force."""

from __future__ import annotations

import hashlib
import math
import os
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from loanweave.llm import bpe, components, decontamination, jaccard_join, lm_scoring, quality_rules
from loanweave.llm import textvec as V
from tests.llm.helpers import LONG, alnum_words, awkward, blank_words, empty, lower

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
BPE = public_tokenizers.path("byte_bpe_50k.json")


def by_key(rows, *keys):
    out = defaultdict(list)
    for r in rows:
        out[tuple(r[k] for k in keys)].append(r)
    return out


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


# Words of Arrow columns


@pytest.mark.parametrize("member,find,low", [(V.ALNUM, alnum_words, True), (V.NOT_BLANK, blank_words, False)])
def test_words(member, find, low):
    rng = random.Random(1)
    texts = ["".join(rng.choice("aB9 \t\n.-é日😀_Z") for _ in range(rng.randint(0, 30))) for _ in range(300)] + [None, "", "x" * 70000]
    for array in (pa.array(texts), pa.array(texts).slice(3, 100), pa.array(texts, pa.large_string()), pa.array([], pa.string())):
        words, seen = V.words(array, member, low), {}
        hashes = words.hashes()
        for i, text in enumerate(array.to_pylist()):
            at = range(words.first[i], words.first[i + 1])
            assert [words.text(j, j + 1) for j in at] == find(text)
            for j, w in zip(at, find(text)):
                assert seen.setdefault(w, hashes[j]) == hashes[j]
        assert len(set(map(int, seen.values()))) == len(seen)


# Jaccard join


def brute_classes(texts, similarity=0.8, n=5):
    sets = {}
    for _, text in texts:
        words = tuple(alnum_words(text))
        sets.setdefault(words or ("", text or ""), {words[i : i + n] for i in range(len(words) - n + 1)})
    keys, links, root = list(sets), Counter(), {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[:i]:
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    groups = defaultdict(list)
    for i, text in texts:
        words = tuple(alnum_words(text))
        groups[find(words or ("", text or ""))].append(i)
    out = []
    for i, text in texts:
        key = tuple(alnum_words(text)) or ("", text or "")
        ids = [g for g in groups[find(key)] if g is not None]
        copies = sum((tuple(alnum_words(t)) or ("", t or "")) == key for _, t in texts)
        out.append((i, min(ids) if ids else None, links[key], copies))
    return Counter(out)


def near_copies(rng, n):
    words = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(n):
        base = [rng.choice(words) for _ in range(rng.randint(6, 90))]
        for _ in range(rng.choice([1, 1, 2, 6])):
            copy = list(base)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append(" ".join(copy))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("small,block", [(48, 1024), (2, 7)])
def test_jaccard(spark, monkeypatch, small, block):
    monkeypatch.setattr(jaccard_join, "SMALL", small)
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rng = random.Random(small)
    hot = [(10_000 + i, f"common passage of many words that all of these texts share and repeat v{i % 40} and then some more words to end it well") for i in range(120)]
    texts = near_copies(rng, 60) + hot
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    got = Counter((r.doc_id, r.class_id, r.n_links, r.n_copies) for r in jaccard_join.join(df).collect())
    assert got == brute_classes(texts)


def test_jaccard_awkward(spark):
    df = awkward(spark)
    got = Counter((r.doc_id, r.class_id, r.n_links, r.n_copies) for r in jaccard_join.join(df).collect())
    assert got == brute_classes(texts_of(df))
    kept = jaccard_join.one_of_each(df)
    assert kept.columns == df.columns
    assert kept.count() == len({(c.class_id, c.class_digest) for c in jaccard_join.join(df).collect()})
    assert jaccard_join.join(empty(spark)).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_jaccard_recall_on_the_tables(spark):
    """Links found among all pairs of different texts: by brute force over the shingles of each."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sets, holders = {}, defaultdict(list)
    for r in docs.collect():
        words = tuple(alnum_words(r.text))
        shingles = {words[i : i + 5] for i in range(len(words) - 4)}
        if shingles:
            sets[words] = (shingles, r.doc_id)
    for words, (shingles, _) in sets.items():
        for s in shingles:
            holders[s].append(words)
    shared = Counter()
    for words, (shingles, _) in sets.items():
        for s in shingles:
            shared.update((words, other) for other in holders[s] if other < words)
    wanted = Counter()
    for (a, b), n in shared.items():
        if n >= 0.8 * (len(sets[a][0]) + len(sets[b][0]) - n) - 1e-9:
            wanted.update([sets[a][1], sets[b][1]])
    found = {r.doc_id: r.n_links for r in jaccard_join.join(docs).collect()}
    assert sum(wanted.values()) > 0
    assert all(found[i] <= n for i, n in wanted.items()) and sum(found[i] for i in wanted) >= 0.99 * sum(wanted.values())


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (9, 8), (8, 7), (5, 5), (2, 1), (-4, 4), (20, 21)] + [(100 + i, 101 + i) for i in range(40)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {**dict.fromkeys((1, 2, 3, 4, -4), -4), **dict.fromkeys((7, 8, 9), 7), 20: 20, 21: 20, **dict.fromkeys(range(100, 141), 100)}
    assert got == want


# Language model


@pytest.mark.parametrize("frequent", [3, 1 << 19])
def test_lm(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm_scoring, "FREQUENT", frequent)
    rng = random.Random(2)
    texts = texts_of(awkward(spark)) + [(i, " ".join(rng.choice(["The", "cat", "sat", f"w{rng.randint(0, 99)}"]) for _ in range(30))) for i in range(20, 120)]
    part = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7
    tokens = [(i, [*blank_words(lower(t or "")), None]) for i, t in texts]
    counts = Counter(w for i, ws in tokens if part(i) != 2 for w in ws)
    n, v = sum(counts.values()), len(counts)
    df = spark.createDataFrame([(*t, "x") for t in texts], "doc_id long, text string, score string").repartition(3)
    got = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.held_out, r.train_tokens, round(r.base_score, 6)) for r in lm_scoring.score(df).collect())
    want = sorted(
        (str(i), len(ws), sum(counts[w] > 0 for w in ws), part(i) == 2, n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 6))
        for i, ws in tokens
    )
    assert got == want


def test_lm_learns(spark):
    rng = random.Random(3)
    seen = [(i, " ".join(["alpha beta gamma delta"] * rng.randint(1, 9))) for i in range(60)]
    odd = [(1000 + i, " ".join(rng.sample("alpha beta gamma delta".split() * 5, 20))) for i in range(20)]
    out = {r.doc_id: r.score / r.n_tokens for r in lm_scoring.score(spark.createDataFrame(seen + odd, "doc_id long, text string")).collect()}
    assert max(out[i] for i, _ in odd) < min(out[i] for i, _ in seen if len(seen[i][1]) > 60)
    none = lm_scoring.score(empty(spark))
    assert none.count() == 0


def test_filter_never_loses_a_count(spark):
    rows = [(0, i * 0x9E3779B97F4A7C15 % (1 << 63), 1 + i % 300) for i in range(1, 3000)]
    df = spark.createDataFrame([((h >> 52) & 0xFFF, h, n) for _, h, n in rows], "shard int, hash long, n long")
    import numpy as np

    levels = lm_scoring.build_filter(df).levels(np.array([h for _, h, _ in rows], np.uint64))
    assert all(level >= int(math.log2(n)) + 1 for level, (_, _, n) in zip(levels, rows))
    assert np.mean([level == int(math.log2(n)) + 1 for level, (_, _, n) in zip(levels, rows)]) > 0.9


def test_filter_bound_leaves_rare_ngrams_out(spark, monkeypatch):
    import numpy as np

    rows = [(i * 0x9E3779B97F4A7C15 % (1 << 63), 1 + i % 8) for i in range(1, 4000)]
    df = spark.createDataFrame([((h >> 52) & 0xFFF, h, n) for h, n in rows], "shard int, hash long, n long")
    monkeypatch.setattr(lm_scoring, "MAX_BITS", 7000 * lm_scoring.BITS_PER_MEMBER)
    levels = lm_scoring.build_filter(df).levels(np.array([h for h, _ in rows], np.uint64))
    assert all(level >= int(math.log2(n)) + 1 for level, (_, n) in zip(levels, rows) if n >= 5)
    assert np.mean([level == 0 for level, (_, n) in zip(levels, rows) if n <= 3]) > 0.9


@pytest.mark.parametrize("frequent", [3, 1 << 19])
@pytest.mark.parametrize("least", [2, 3, 6, 10**9])
def test_lm_bound_changes_no_score(spark, monkeypatch, frequent, least):
    """Whatever count the filter begins at, scores are those of a filter of all n-grams."""
    rng = random.Random(5)
    texts = [(i, " ".join(rng.choice(["the", "cat", f"w{rng.randint(0, 9)}", f"v{rng.randint(0, 400)}"]) for _ in range(25))) for i in range(150)]
    texts += texts_of(awkward(spark))
    part = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7
    words, pairs = Counter(), Counter()
    for i, t in texts:
        ws = [*blank_words(lower(t or "")), None]
        if part(i) != 2:
            words.update(ws)
            pairs.update(zip([None, *ws], ws))
    level = lambda c: int(math.log2(c) + 1e-9) + 1 if c else 0
    middle = lambda c: (2 ** (level(c) - 1) + max(2 ** level(c) - 1, 1)) / 2 if c else 0.0
    limit = sum(level(c) for c in [*words.values(), *pairs.values()] if c >= least)
    monkeypatch.setattr(lm_scoring, "FREQUENT", frequent)
    monkeypatch.setattr(lm_scoring, "MAX_BITS", limit * lm_scoring.BITS_PER_MEMBER)
    known = min(c for c in set(words.values()) if sum(w >= c for w in words.values()) <= frequent)
    use = lambda w: words[w] if words[w] >= known else middle(words[w])
    end, total = max(words[None], middle(words[None])), sum(words.values()) + len(words) + 1

    def want(text):
        out, before = 0.0, end
        ws = [*blank_words(lower(text or "")), None]
        for a, w in zip([None, *ws], ws):
            out += math.log10((min(middle(pairs[a, w]), before) + 8 * (use(w) + 1) / total) / (before + 8))
            before = use(w)
        return out

    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    got = sorted((str(r.doc_id), round(r.score, 6)) for r in lm_scoring.score(df).collect())
    off = [(a, b) for a, b in zip(got, sorted((str(i), round(want(t), 6)) for i, t in texts)) if a[0] != b[0] or abs(a[1] - b[1]) > 2e-6]
    assert len(off) <= 2, off  # a false positive of the filter


# Decontamination


def brute_hits(texts, items, window=10):
    spans = set()
    for item, text in items:
        w = alnum_words(text)
        for s in range(max(len(w) - window, 0) + 1 if w else 0):
            spans.add((tuple(w[s : s + window]), str(item)))
    lengths = {len(s) for s, _ in spans}
    where = defaultdict(set)
    for s, item in spans:
        where[s].add(item)
    out = []
    for i, text in texts:
        w, hit, found = alnum_words(text), set(), set()
        for n in lengths:
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in where:
                    hit |= set(range(s, s + n))
                    found |= where[tuple(w[s : s + n])]
        out.append((str(i), len(w), len(hit), tuple(sorted(found))))
    return sorted(out)


def test_decontamination(spark):
    rng = random.Random(6)
    vocabulary = [f"t{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 25)))) for i in range(40)]
    items += [(100, "short one"), (100, "short one"), (101, "Quick, BROWN fox!"), (102, None), (103, ""), (104, "..."), (None, "null id item here")]
    texts = texts_of(awkward(spark))
    for i in range(20, 160):
        parts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 30)))]
        if i % 3 == 0:
            parts += [rng.choice(items)[1] or "", "tail words"]
        texts.append((i, ", ".join(parts)))
    df = spark.createDataFrame([(*t, "x", 1) for t in texts], "doc_id long, text string, spans string, n_hit int").repartition(4)
    named = [(i, t) for i, t in items if i is not None]
    item_df = spark.createDataFrame(named, "item_id long, text string")
    got = decontamination.find(df, item_df).collect()
    assert sorted((str(r.id), r.n_words, r.n_hit, tuple(r["items"])) for r in got) == brute_hits(texts, named)
    for r in got:
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:])) and r.n_hit == sum(s.end - s.start for s in r.spans)
    clean = decontamination.remove(df, item_df)
    assert clean.columns == df.columns and clean.count() == sum(h == 0 for _, _, h, _ in brute_hits(texts, named))
    assert decontamination.find(df, item_df.limit(0)).where("n_hit > 0").count() == 0
    assert decontamination.find(df.limit(0), item_df).count() == 0


# BPE


def test_bpe_words():
    rng = random.Random(7)
    library, mine = Tokenizer.from_file(BPE), bpe.Vocabulary.load(BPE)
    bits = ["the", " ", "  ", "\n", "\t", "'s", "'ll", "é", "日", "😀", "1", "23", ".", "!!", "<|endoftext|>", "　", "\x1c", "\x85", "\u200b", "\u058b", "\U00016d40"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(3000)] + ["a" * 3000, "ab" * 1500, "the" * 500 + "é" * 99]
    for text in texts:
        ids = list(struct.unpack(f"<{sum(len(mine.encode_word(w)) for w in mine.words(text)) // 4}I", b"".join(map(mine.encode_word, mine.words(text)))))
        assert ids == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("table,cache", [(1 << 19, 1 << 17), (4, 2)])
def test_bpe(spark, monkeypatch, table, cache):
    monkeypatch.setattr(bpe, "TABLE_WORDS", table)
    monkeypatch.setattr(bpe, "CACHE_WORDS", cache)
    library, df = Tokenizer.from_file(BPE), awkward(spark)
    coded = bpe.encode(df, BPE)
    got = by_key(bpe.decode(coded, BPE).collect(), "doc_id", "decoded")
    want = by_key([{"doc_id": i, "decoded": t or ""} for i, t in texts_of(df)], "doc_id", "decoded")
    assert {k: len(v) for k, v in got.items()} == {k: len(v) for k, v in want.items()}
    for (_, text), rows in got.items():
        ids = library.encode(text, add_special_tokens=False).ids
        assert all(list(r.ids) == ids for r in rows) and library.decode(ids, skip_special_tokens=False) == text
    digests = {(r.decoded, r.n_tokens, r.ids_sha256) for r in bpe.round_trip(df, BPE).collect()}
    assert digests == {(r.decoded, len(r.ids), hashlib.sha256(struct.pack(f"<{len(r.ids)}I", *r.ids)).hexdigest()) for rows in got.values() for r in rows}
    assert bpe.encode(empty(spark), BPE).count() == 0
    broken = spark.createDataFrame([(1, [164]), (2, None)], "doc_id long, ids array<int>")
    assert [r.decoded for r in bpe.decode(broken, BPE).orderBy("doc_id").collect()] == [library.decode([164], skip_special_tokens=False), ""]


# Quality rules


def brute_base(text):
    text, words = text or "", blank_words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if blank_words(line):
            dup += line in seen
            seen.add(line)
    windows, covered = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2)), set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_base_counts():
    rng = random.Random(8)
    texts = ["".join(rng.choice("ab \n\n\r\t#é|") for _ in range(rng.randint(0, 60))) for _ in range(800)] + [None, "", "\n", "\n\n a\n a", "x\n", LONG]
    texts += [" ".join(rng.choice(["a", "b", "c"]) for _ in range(rng.randint(0, 12))) for _ in range(300)]
    counts = quality_rules.base_counts(V.words(pa.array(texts), V.NOT_BLANK, lower=False))
    got = list(zip(*(counts[k].tolist() for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))))
    assert got == [brute_base(t) for t in texts]


def test_quality_rules_awkward(spark):
    df, none = awkward(spark), empty(spark, "doc_id long, quality int")
    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality_rules.judge(df, none).collect())
    want = [(str(i), *brute_base(t)) for i, t in texts_of(df)]
    assert got == sorted((*w, w[1] < 50 or 100 * w[5] > 50 * w[1]) for w in want)
    assert quality_rules.judge(empty(spark), none).count() == 0
    one = spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id long, quality int")
    assert quality_rules.judge(df, one).where("probability > 0.5").count() == df.count()

