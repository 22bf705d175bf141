"""Small helpers that the operators share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text handed to NumPy in one go, in bytes. Only batches the work; a longer text goes alone.
CHUNK_BYTES = 1 << 20


def ship(spark: SparkSession) -> None:
    """Gives the tasks this package, so that it need not be installed on the executors.

    Once per application. Spark itself serves the archive from the driver.
    """
    context = spark.sparkContext
    if hasattr(context, "_corpus_code"):
        return
    root = Path(__file__).resolve().parents[1]
    folder = tempfile.TemporaryDirectory(prefix="corpus-code-")  # goes when the driver ends
    archive = os.path.join(os.path.realpath(folder.name), f"{root.name}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(archive)
    context._corpus_code = folder


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a table, all rows."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def fold(column: Column, parts: int) -> Column:
    """Remainder of the CRC32 of a key as text; a NULL key counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % parts


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as set it apart from all columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def lower_ascii(column: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``CHUNK_BYTES`` of text each."""
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    begin = size = 0
    for i, n in enumerate(lengths):
        if size and size + n > CHUNK_BYTES:
            yield begin, i
            begin, size = i, 0
        size += int(n)
    if begin < len(lengths):
        yield begin, len(lengths)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, seen: Column, limit: int) -> DataFrame:
    """At most ``limit`` labelled documents to learn from: ``doc_id``, ``text``, ``label`` (0.0 or 1.0).

    ``seen`` says which documents may be learned from. The choice is by a hash of the id, so
    it is the same in every run. Labels that are NULL or contradict each other are left out.
    Of documents that share an id, the smallest text is taken.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(target).isNotNull() & seen)
    # Only twice as many rows as wanted, those of the smallest hashes, go on to be sorted.
    share = min(1.0, 2 * limit / max(usable.count(), 1))
    last = min(int(share * 2**64) - 2**63, 2**63 - 1)
    marks = (
        usable.where(F.xxhash64("doc_id") <= F.lit(last))
        .groupBy("doc_id")
        .agg(F.max(target).alias("label"), F.min(target).alias("least"))
        .where("label = least")
        .select("doc_id", F.col("label").cast("double").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )  # so small that it may be broadcast
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(marks), "doc_id")
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))


def least_frequent(counts: DataFrame, column: str, limit: int, weight: Column | None = None) -> int:
    """Smallest count that at most ``limit`` rows reach, for a table whose size must be bounded.
    With ``weight``, each row counts as so many.

    Found from a histogram with a bin for each small count and finer than 2 % steps for
    larger ones, so at most some thousand rows are collected, whatever the number of rows.
    """
    n = F.col(column)
    bin_ = F.when(n < 4096, n).otherwise(F.floor(F.log2(n.cast("double")) * 64) + 4096)
    bins = counts.groupBy(bin_.alias("bin")).agg((F.count("*") if weight is None else F.sum(weight)).alias("rows"), F.min(n).alias("least")).collect()
    cut, rows = max((b["least"] for b in bins), default=0) + 1, 0
    for b in sorted(bins, key=lambda b: -b["bin"]):
        rows += b["rows"]
        if rows > limit:
            break
        cut = b["least"]
    return cut
