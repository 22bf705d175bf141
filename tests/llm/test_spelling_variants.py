"""Spelling variants against plain edits of every word."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from loanweave.llm import spelling_variants as variants
from tests.llm.helpers import awkward, empty, lower

LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))


def counts(rows):
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def one_edit(word):
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    out = {a + b[1:] for a, b in cuts if b} | {a + c + b for a, b in cuts for c in LETTERS} | {a + c + b[1:] for a, b in cuts if b for c in LETTERS}
    return out - {word}


def brute(rows):
    n = counts(rows)
    near = {w: sorted(one_edit(w) & n.keys(), key=lambda u: (-n[u], u)) for w in n}
    form = {w: u[0] if u and n[u[0]] >= 2 * n[w] else None for w, u in near.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root(w)) for w in n)


def result(docs):
    return sorted((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in variants.group(docs).collect())


def corpus(seed):
    draw = random.Random(seed)
    stems = ["".join(draw.choices("abcdeéßÿ÷", k=draw.randrange(4, 9))) for _ in range(40)] + ["aaaaa", "aaaaaa", "aabbaa", "ÀÀÀÀÀé", "x" * 70, "x" * 69, "y" * 300]
    words = stems + [draw.choice(sorted(one_edit(draw.choice(stems)))) for _ in range(150)]
    weights = [2 ** draw.randrange(7) for _ in words]
    rows = []
    for i in range(150):
        text = " ".join(draw.choices(words, weights, k=80))
        rows.append((i, text.upper().replace("SS", "ß") if i % 9 == 0 else re.sub(" ", lambda _: draw.choice(" .,-9日\n"), text)))
    return rows


def test_equals_plain_edits(spark):
    rows = corpus(1)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = result(docs)
    assert found == brute(rows)
    assert any(f[5] != f[3] for f in found if f[3])  # some forms have forms themselves


def test_full_filters_only_let_more_pass(spark, monkeypatch):
    rows = corpus(2)
    monkeypatch.setattr(variants, "MOST_BLOCKS", 3)
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_awkward_rows(spark):
    docs = awkward(spark)
    assert result(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert result(empty(spark)) == []
    assert result(docs.where("doc_id = 5")) == []


@pytest.mark.parametrize("text", ["", "a", "é", "Ünïcode-Wörter ABCéàX日本æ xÀ", "z" * 200])
def test_runs(text):
    found = variants.runs(pa.array([text, None, text]))
    want = [lower(r).encode() for r in re.findall("[A-Za-zÀ-ÿ]+", text)]
    assert [found.data[s:e].tobytes() for s, e in zip(found.start, found.end)] == want * 2
    begun = np.full(len(found.start), zlib.crc32(b"77:"), np.uint32)
    crc = variants.crc32s(found.data, found.start, found.end, begun)
    assert crc.tolist() == [zlib.crc32(b"77:" + w) for w in want * 2]


@pytest.mark.parametrize("word", ["abcde", "aabba", "zÿzéé", "q"])
def test_edits(word):
    made = {}
    (_, points), *_ = variants.by_length([word])
    for _, c, place, hashes in variants.edits(points, np.array(sorted(map(ord, LETTERS)), np.uint64)):
        for p, h in zip(place.tolist(), hashes.tolist()):
            made[word[:p] + (chr(c) if c else "") + word[p + 1 :]] = h
    assert len(made) == len(set(made.values()))
    assert set(made) == {e for e in one_edit(word) if e and len(e) <= len(word) and (len(e) < len(word) or e > word)}
    for e, h in made.items():
        (_, points), *_ = variants.by_length([e])
        assert variants.word_hashes(points).tolist() == [h]
