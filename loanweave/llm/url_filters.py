"""Host and path rules for URLs, found by a sorted sweep over reversed-host keys.

A host becomes a key of its labels from last to first, each ended by ``\\x01``, so a rule's
host and all its subdomains are one interval of keys, and intervals nest. Rule ends and
distinct hosts are range-partitioned by key. A running "last boundary" over the sorted
rows of a block is the top of the stack of open intervals: each boundary carries the rules
that are open from it on. What is open where a block begins is carried over from earlier
blocks. Only distinct hosts are swept, so a host with a third of all URLs is one row here;
the URLs then join their host's rules, which adaptive execution splits if a host is hot.

Built from DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanweave.llm.common import lower_ascii, shuffle_partitions
from loanweave.sources.staging import stage

_ENDED, _AFTER = "\x01", "\x02"  # end of a label; the next character, past all subdomains
_ADDED = ("host", "path", "rule", "verdict")


def url_host(url: Column) -> Column:
    """Text between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """Text after the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), _ENDED), F.lit(_ENDED))


def _rules_by_host(rules: DataFrame) -> DataFrame:
    """One row per rule host with its paths. Of equal rules, ``block`` wins."""
    clean = rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL")
    return (
        clean.groupBy(lower_ascii(F.col("host")).alias("host"), "path")
        .agg(F.max("verdict").alias("verdict"))
        .groupBy("host")
        .agg(F.sort_array(F.collect_list(F.struct("path", "verdict"))).alias("paths"))
    )


def _boundaries(by_host: DataFrame) -> DataFrame:
    """Start and end of each rule host's interval, with the rules open from there on."""
    labels = F.split("host", r"\.")
    outer = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    enclosing = by_host.select(F.col("host").alias("outer"), F.col("paths"))
    stacks = (
        by_host.select("host", F.explode(outer).alias("outer"))
        .join(enclosing, "outer")
        .groupBy("host")
        .agg(F.collect_list(F.struct(F.col("outer").alias("host"), "paths")).alias("stack"))
    )
    key = host_key(F.col("host"))
    events = F.array(
        F.struct(key.alias("key"), F.col("stack").alias("stack")),
        F.struct(
            F.regexp_replace(key, f"{_ENDED}$", _AFTER).alias("key"),
            F.filter("stack", lambda s: s["host"] != F.col("host")).alias("stack"),
        ),
    )
    return stacks.select(F.inline(events))


def host_stacks(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """For each host of ``hosts`` (column ``host``, distinct): the rules open at its key."""
    bounds = _boundaries(_rules_by_host(rules)).select("key", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("host"), "stack")
    stack_type = bounds.schema["stack"].dataType
    points = hosts.select(host_key(F.col("host")).alias("key"), F.lit(1).alias("kind"), "host", F.lit(None).cast(stack_type).alias("stack"))
    dealt = bounds.unionByName(points).repartitionByRange(shuffle_partitions(hosts.sparkSession), "key")
    # written once, so that block numbers are the same for the sweep and for what it carries over
    blocks = stage(dealt.withColumn("block", F.spark_partition_id()), "url-blocks")

    so_far = Window.partitionBy("block").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(F.lit(0)).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (  # one row per block, so at most as many rows as there are shuffle partitions
        blocks.groupBy("block")
        .agg(F.max_by("stack", F.when(F.col("kind") == 0, F.col("key"))).alias("last"))
        .select("block", F.last("last", ignorenulls=True).over(before).alias("carried"))
    )
    swept = blocks.withColumn("open", F.last("stack", ignorenulls=True).over(so_far)).where("kind = 1")
    return (
        swept.join(F.broadcast(carried), "block", "left")
        .select("host", F.coalesce("open", "carried").alias("stack"))
        .where(F.size("stack") > 0)
    )


def judge(urls: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """All rows of ``urls`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict`` (allow or block). A rule fits its host
    and all subdomains if the URL's path starts with its path. The longest fitting rule
    (host and path together, then the larger text) decides; without one, ``rule`` is NULL
    and the verdict is ``default``.

    - NULL, empty or relative URL: empty host and path, no rule.
    - Rules with a NULL are ignored; of rules that differ only in the verdict, block wins.
    - Repeated URLs: each row is judged. No URLs: no rows. No rules: all rows get ``default``.
    - Columns of ``urls`` named like the added ones (in any case) are replaced.
    """
    keep = [F.col(f"`{c}`") for c in urls.columns if c.lower() not in _ADDED]
    parsed = urls.select(*keep, url_host(F.col(f"`{url}`")).alias("host"), url_path(F.col(f"`{url}`")).alias("path"))
    stacks = host_stacks(parsed.select("host").where("host != ''").distinct(), rules)

    fits = F.flatten(
        F.transform(
            F.filter("stack", lambda s: (F.col("host") == s["host"]) | F.endswith(F.col("host"), F.concat(F.lit("."), s["host"]))),
            lambda s: F.transform(
                F.filter(s["paths"], lambda p: F.startswith(F.col("path"), p["path"])),
                lambda p: F.struct(
                    F.length(F.concat(s["host"], p["path"])).alias("length"),
                    F.concat(s["host"], p["path"]).alias("rule"),
                    p["verdict"].alias("verdict"),
                ),
            ),
        )
    )
    found = parsed.join(stacks, "host", "left").withColumn("found", F.array_max(fits))
    return found.select(
        *keep,
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", F.lit(default)).alias("verdict"),
    )
