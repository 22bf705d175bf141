"""URL filters, chat formatting and licence scans."""

from __future__ import annotations

import hashlib
import random
import textwrap
from importlib.metadata import files as installed

import pytest
from pyspark.sql import functions as F

from loanweave.llm import chat_formatting as chat
from loanweave.llm import license_scans, url_filters

RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.net", "/en/private/", "block"), ("b.example.net", "/", "allow"),
    ("ple.net", "/", "block"), ("org", "/fr/", "allow"), ("org", "/fr/", "block"),
]


def brute_url(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
        host, rest = rest[:cut], rest[cut:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest] + [len(rest)])]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    _, rule, verdict = max(fits, default=(0, None, "allow"))
    return host, path, rule, verdict


@pytest.mark.parametrize("rules", [RULES, RULES[:1], []])
def test_urls(spark, rules):
    rng = random.Random(4)
    hosts = ["net", "example.net", "EXAMPLE.net", "a.example.net", "x.b.example.net", "xample.net", "org", "w.org", "netx", "", "a..net", "net."]
    paths = ["", "/", "/en/", "/en/private/x", "/fr/a?b#c", "/en", "?q=/en/", "#x", "/en/a\n/b"]
    urls = [f"http://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(300)]
    urls += [None, "", "no scheme", "x://", "a://b://net/", "http://net/", "http://net/"]
    df = spark.createDataFrame([(i, u, "mine", 3) for i, u in enumerate(urls)], "page_id int, url string, Host string, rule int")
    table = spark.createDataFrame([*rules, (None, "/", "block"), ("com", None, "block")], "host string, path string, verdict string")
    got = url_filters.judge(df, table).collect()
    assert len(got) == len(urls)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == brute_url(urls[r.page_id], rules)
    assert url_filters.judge(df.limit(0), table).count() == 0


def test_chats(spark):
    rng = random.Random(5)
    bits = ["[INST]", "[/INST]", "<s>", "</s>", "\\", "<", "[", "<<SYS>>", "<</SYS>>", "[TURN=a] ", "x", "\n", "é", " ", "[\\INST]", "]", ">"]
    rows = []
    for c in range(80):
        for t in range(rng.randint(1, 5)):
            role = rng.choice(["user", "assistant", "system", "tool] x\n", None, ""])
            rows.append((c, t, role, rng.choice([None, "".join(rng.choice(bits) for _ in range(rng.randint(0, 9)))])))
    rows += [(100, None, "user", "first"), (100, 0, "assistant", "b"), (100, 0, "assistant", "a"), (100, 0, "assistant", "a"), (None, 1, "user", "u")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id int, turn int, role string, text string, formatted string, valid int")
    out = chat.format_chats(df).withColumns({"turns": chat.read_back(F.col("formatted")), "lost": chat.loss_text(F.col("segments"))}).collect()
    assert len(out) == 82
    follows = {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    for r in out:
        mine = [(t if t is not None else -1, role or "", text or "") for c, t, role, text in rows if c == r.conv_id]
        want = [(role, text) for _, role, text in sorted(mine)]
        assert [tuple(t) for t in r.turns] == want
        assert r.lost == "".join(text for role, text in want if role == "assistant")
        assert r.formatted == "".join(s.text for s in r.segments)
        states = ["", *(role for role, _ in want)]
        bad = next((i for i, (a, b) in enumerate(zip(states, states[1:])) if b not in follows.get(a, ())), None)
        bad = len(want) if bad is None and states[-1] != "assistant" else bad
        assert (r.valid, r.bad_turn) == (bad is None, bad)
        for s in r.segments[1::3]:
            assert not any(c in s.text for c in chat.TEMPLATE.controls)
    assert chat.format_chats(df.limit(0)).count() == 0
    assert hashlib.sha256(b"").hexdigest() == spark.range(1).select(F.sha2(chat.loss_text(F.expr("array(struct('' AS text, true AS loss))")), 256)).first()[0]


def test_licences(spark):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    body = "plain text without cue " * 10
    files = [
        ("repo/LICENSE", f"{mit}\n{body}"), ("repo/a.py", body), ("repo/sub/b.py", body), ("repo/sub/own.py", f"{body}\n{apache}\n{body}"),
        ("repo/apache/notes", apache), ("repo/apache/deep/er/c.py", body), ("other/x", body), ("other/y", None), (None, ""), (None, mit + " " + body),
        ("repo/a.py", body), ("repository/z", body), ("other/w", "A driving licence is needed to drive here and there and everywhere else too"),
        ("tie/x", f"{mit}\n{mit}\n{body}"),
    ]
    df = spark.createDataFrame([(*f, "no", "no") for f in files], "path string, text string, license string, folder string")
    got = sorted(((r.path or "", r.own_license or "", r.license or "", r.origin) for r in license_scans.scan(df).collect()))
    assert got == sorted([
        ("repo/LICENSE", "MIT", "MIT", "own"), ("repo/a.py", "", "MIT", "inherited"), ("repo/a.py", "", "MIT", "inherited"),
        ("repo/sub/b.py", "", "MIT", "inherited"), ("repo/sub/own.py", "Apache-2.0", "Apache-2.0", "own"),
        ("repo/apache/notes", "Apache-2.0", "Apache-2.0", "own"), ("repo/apache/deep/er/c.py", "", "Apache-2.0", "inherited"),
        ("other/x", "", "", "none"), ("other/y", "", "", "none"), ("", "", "", "none"), ("", "", "", "none"), ("repository/z", "", "", "none"),
        ("other/w", "", "", "none"), ("tie/x", "MIT", "MIT", "own"),
    ])
    assert license_scans.scan(df.limit(0)).count() == 0


def test_licence_texts_and_headers(spark):
    """Real licence files of installed packages, and headers wrapped as comments."""
    real = {"psutil": "BSD-3-Clause", "requests": "Apache-2.0", "hypothesis": "MPL-2.0", "iniconfig": "MIT"}
    rows = [(f"{p}/{'LICENSE' if k % 2 else 'COPYING.txt'}", next(f for f in installed(p) if f.name.startswith("LICENSE")).read_text()) for k, p in enumerate(real)]
    rows += [(f"{p}/src/code.py", "x = 1\n") for p in real]
    want = {path: real[path.split("/")[0]] for path, _ in rows}
    for name, text in license_scans.HEADERS:
        wrapped = textwrap.wrap(text, 34)
        for style, mark in (("hash", "# "), ("slash", "// ")):
            rows.append((f"{name}-{style}/a", "\n".join(mark + w for w in ["Copyright 2020 A. Body", *wrapped]) + "\n\nx = 1\n" * 200))
        rows.append((f"{name}-block/a", "\n/*\n * Copyright 2020 A. Body\n" + "".join(f" * {w}\n" for w in wrapped) + " */\nint x;\n" * 200))
        want |= {f"{name}-{style}/a": name for style in ("hash", "slash", "block")}
    got = {r.path: r.license for r in license_scans.scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert got == want
