"""Small tables with every awkward case, and brute-force versions."""

from __future__ import annotations

import re

LONG = " ".join(f"word{i % 700} filler" for i in range(6000))
PLAIN = "The quick brown fox jumps over the lazy dog near the river bank while seven geese watch it quietly today"


def lower(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def alnum_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def blank_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def awkward(spark):
    """NULLs, empty, repeated, very long, non-ASCII, and extra columns whose names clash."""
    texts = [
        (1, PLAIN), (2, PLAIN), (2, PLAIN), (3, PLAIN + " again"), (4, None), (5, ""), (6, " \n\t "), (7, LONG), (None, "no id"),
        (None, PLAIN), (8, "日本語 text é 😀 <|endoftext|> x"), (9, "one"), (10, "!!! ???"), (11, "a a a a a a a a"), (5, "same id, other text"),
    ]
    rows = [(i, t, "x", 0.5, True, "z", 1, 2, *"abcdefg") for i, t in texts]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, digest string, score double, held_out boolean, host string, n_words int, predicted int, "
        "_digest string, _quality string, _N_words string, _weight string, _bad_id string, _bad_digest string, _kept_id string",
    )


def empty(spark, schema="doc_id long, text string"):
    return spark.createDataFrame([], schema)
