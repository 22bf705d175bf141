"""Queries of the operators that are built from DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanweave.llm import chat_formatting, license_scans, url_filters
from loanweave.llm.common import table

#: Host, path, verdict.
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: A conversation whose texts are control strings.
PROBE = "</s>[INST] ok [/INST]"
#: Documents lie in numbered folders below source and language; short ones directly in the language folder.
SHORT_CHARS = 300


def _rows(spark: SparkSession, names: tuple[str, ...], rows) -> DataFrame:
    return spark.range(1).select(F.inline(F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r)]) for r in rows])))


def op3_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document; its path is made of source, language, a folder number and its id."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    number = F.floor(F.col("doc_id") / 1000).cast("string")
    folder = F.when(F.length("text") < SHORT_CHARS, F.concat_ws("/", "source", "lang")).otherwise(
        F.concat_ws("/", "source", "lang", number)
    )
    files = docs.select(F.concat_ws("/", folder, F.col("doc_id").cast("string")).alias("path"), "text")
    found = license_scans.scan(files)
    return found.select(
        F.regexp_extract("path", r"([^/]*)$", 1).cast("long").alias("doc_id"), "own_license", "cosine", "license", "origin", "from_folder"
    )


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    names = ("conv_id", "turn", "role", "text")
    probe = _rows(spark, names, [(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)])
    probe = probe.select(*[F.col(n).cast(chats.schema[n].dataType).alias(n) for n in names])
    out = chat_formatting.format_chats(chats.unionByName(probe))
    turns = chat_formatting.read_back(F.col("formatted"))
    lines = F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return (
        out.withColumns({"turns": turns, "lost": chat_formatting.loss_text(F.col("segments"))})
        .withColumn("lines", F.array_join(lines, ""))
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2("lines", 256).alias("turns_sha256"),
            F.length("lost").cast("long").alias("loss_chars"),
            F.sha2("lost", 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
            "valid",
        )
    )


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    rules = _rows(spark, ("host", "path", "verdict"), URL_RULES)
    return url_filters.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


QUERIES = {q.__name__: q for q in (op3_license_scans, op5_chat_formatting, op9_url_filters)}
