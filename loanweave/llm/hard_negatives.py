"""Hard-negative mining with cover trees.

Rows are dealt by a hash of their id into parts of about ``TREE_ROWS``; each part becomes a
cover tree, written once. Every anchor meets every tree: first to find the anchors' positives,
then, with the windows of scores that follow from these, for the negatives.

A task holds a group of trees, and the anchors come by in blocks of up to ``BLOCK``. So a tree
moves once (or once for each lane, where there are more tasks to fill than groups), and an
anchor once for each group. Both go to their tasks by number: nothing is joined or broadcast, and
the tasks grow with the bytes of the trees, not with pairs of trees and blocks. A task returns
only the first rows of each window; the first of all tasks are found by a window function over
these. Where there are many groups, a look at some of the trees first tells how high a score
must be at least, so that the tasks return few rows that others beat.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import ExitStack

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanweave.llm import cover_tree
from loanweave.llm.common import ship, shuffle_partitions
from loanweave.sources.staging import stage, staged

#: Expected rows of a tree, most anchors of a block, and about the bytes of the trees of a task at
#: four bytes a component.
TREE_ROWS, BLOCK, HELD = 8192, 512, 64 << 20
#: One of so many trees is looked at first, if there are more than twice as many groups.
LOOK = 16
#: Components become ``floor(SCALE * x)``; a row with a larger |x| takes no part, so that scores fit.
SCALE, LARGEST = 256, float(1 << 17)

#: Windows of an anchor: for each positive its id and score, and the least score asked for as far as
#: it is known. The window for the positives themselves has neither id nor score.
_WINDOWS = "array<struct<id: bigint, score: bigint, least: bigint>>"
_FOUND = "anchor_id long, positive_id long, positive_score long, other_id long, score long"


def whole_vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, label, vector of whole numbers) of the rows that take part, one per id."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    usable = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull()).where(F.forall(x, lambda v: v.between(-LARGEST, LARGEST)))
    whole = usable.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.struct(F.col("label").cast("long").alias("label"), F.transform(x, lambda v: F.floor(v * SCALE).cast("int")).alias("vector")).alias("row"),
    )
    return whole.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.vector")


def _matrix(vectors: pa.Array, width: int = 0) -> np.ndarray:
    """Rows of whole numbers; shorter vectors go on with zeros."""
    ends = vectors.offsets.to_numpy()
    flat, size = vectors.values.to_numpy()[ends[0] : ends[-1]], np.diff(ends)
    out = np.zeros((len(size), max(int(size.max(initial=0)), width)), np.int64)
    out[np.arange(out.shape[1]) < size[:, None]] = flat
    return out


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of each run of equal values."""
    cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
    return [(lo, hi) for lo, hi in zip(cuts[:-1], cuts[1:]) if hi > lo]


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trees of the parts whose rows follow each other."""

    def tree(part: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        ids, labels = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy()
        vectors = _matrix(rows.column("vector").combine_chunks())
        made = cover_tree.build(vectors.astype(np.int32), ids, labels).to_bytes()
        return pa.RecordBatch.from_arrays([pa.array([part]), pa.array([4 * vectors.size]), pa.array([made], pa.binary())], ["part", "bytes", "tree"])

    now, held = None, []
    for batch in batches:
        for lo, hi in _runs(batch.column("part").to_numpy()):
            part = batch.column("part")[lo].as_py()
            if now is not None and part != now:
                yield tree(now, held)
                held = []
            now = part
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield tree(now, held)


def _block(rows: pa.RecordBatch, size: int, low: int, high: int) -> tuple[cover_tree.Block, np.ndarray, np.ndarray]:
    """The anchors as a block, and the ids and scores of the positives of their windows, query by query."""
    asked = rows.column("windows")
    ends, flat = asked.offsets.to_numpy(), asked.values
    ids, scores, least = (flat.field(k).slice(ends[0], ends[-1] - ends[0]).to_pylist() for k in ("id", "score", "least"))
    # In Python's whole numbers, as a product with a large score may not fit.
    lows = [cover_tree.LEAST if s is None else -(-low * s // 100) for s in scores]
    highs = [cover_tree.MOST if s is None else high * s // 100 for s in scores]
    lows = [lo if x is None else max(lo, x) for lo, x in zip(lows, least)]
    size_of = np.diff(ends)
    place = np.arange(size_of.max(initial=1)) < size_of[:, None]

    def wide(values: list[int | None], none: int) -> np.ndarray:
        out = np.full(place.shape, none, np.int64)
        out[place] = [0 if v is None else v for v in values]
        return out

    block = cover_tree.Block(
        _matrix(rows.column("vector")), rows.column("vec_id").to_numpy(), rows.column("label").to_numpy(), wide(lows, cover_tree.MOST), wide(highs, cover_tree.LEAST), size
    )
    return block, wide(ids, 0).ravel(), wide(scores, 0).ravel()


def _search(same: bool, size: int, low: int, high: int, most: int):
    """First rows of every window of every anchor in the trees of a task, which come before its anchors."""

    def found(trees: list[cover_tree.Tree], rows: pa.RecordBatch) -> pa.RecordBatch:
        block, positive, positive_score = _block(rows, size, low, high)
        for tree in trees:
            cover_tree.search_all(tree, block, same)
        block.settle()
        window, score, other = block.held
        columns = [block.ids[window // block.least.shape[1]], *([None] * 2 if same else [positive[window], positive_score[window]]), other, score]
        names = ["anchor_id", "positive_id", "positive_score", "other_id", "score"]
        return pa.RecordBatch.from_arrays([pa.nulls(len(window), pa.int64()) if c is None else pa.array(c, pa.int64()) for c in columns], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, trees = None, []
        for batch in batches:
            for lo, hi in _runs(batch.column("task").to_numpy()):
                if batch.column("task")[lo].as_py() != now:
                    now, trees = batch.column("task")[lo].as_py(), []
                own = batch.slice(lo, hi - lo)
                n = len(own) - own.column("tree").null_count
                trees += [cover_tree.Tree.from_bytes(raw.as_py()) for raw in own.column("tree").slice(0, n)]
                for begin in range(n, len(own), most):
                    yield found(trees, own.slice(begin, min(most, len(own) - begin)))

    return run


def _tasks(n: int, a: int, parts: int, size: int, wanted: int) -> tuple[int, int]:
    """Groups that ``size`` bytes of trees are dealt into, and lanes of anchors.

    As many groups as memory asks for. Where these are fewer than ``wanted``, more of both: a lane
    moves all rows, a group all anchors with about three times their size in rows found.
    """
    least = min(parts, -(-size // HELD) or 1)
    groups = max(least, min(parts, wanted, math.ceil(math.sqrt(wanted * n / (4 * max(a, 1))))))
    return groups, max(min(-(-a // BLOCK), wanted // groups), 1)


def _dealt(anchors: DataFrame, trees: DataFrame, groups: int, lanes: int) -> DataFrame:
    """Trees and anchors of each task, in its partition, the trees first. Anchors of a label follow each other."""
    each = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    task = (F.col("group") * lanes + F.col("lane")).cast("int").alias("task")
    blank = lambda *names: [F.lit(None).cast(anchors.schema[c].dataType).alias(c) for c in names]
    columns = ("vec_id", "label", "vector", "windows")
    held = trees.withColumn("group", F.col("place") % groups).withColumn("lane", each(lanes)).select(task, "tree", *blank(*columns))
    asking = anchors.withColumn("lane", F.pmod(F.xxhash64("vec_id"), F.lit(lanes))).withColumn("group", each(groups))
    both = held.unionByName(asking.select(task, F.lit(None).cast("binary").alias("tree"), *columns))
    return both.repartitionById(groups * lanes, "task").sortWithinPartitions("task", F.col("tree").isNull(), "label")


def _first(found: DataFrame, size: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "other_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def mine(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    ``rows`` has integer ``vec_id`` and ``label``, and ``embedding`` (array of numbers). Scores are
    inner products of the whole numbers ``floor(256 x)``, the higher first, ties by smaller
    id. Rows where ``anchor`` holds are anchors; an anchor's positives are its first rows of the
    same label, and the negatives of a positive the first rows of other labels whose score is
    between ``low`` and ``high`` percent of the positive's.

    - Rows with a NULL id, label or vector, or any component that is NULL, not finite or above
      131,072 in size, take no part.
    - An id that repeats is one row: the smallest label, then the smallest vector in order of components.
    - Vectors of different lengths: the shorter one goes on with zeros; an empty one is all zeros.
    - A positive with a negative score has no negatives. An anchor without positives has no rows; no anchors, no rows.
    - Other columns are not read, so their names cannot clash.
    """
    spark = rows.sparkSession
    ship(spark)
    partitions = shuffle_partitions(spark)
    wanted = min(partitions, 4 * spark.sparkContext.defaultParallelism)  # tasks, for cores to be busy
    with ExitStack() as copies:
        with staged(whole_vectors(rows), "negatives-rows") as whole:
            n, largest = whole.agg(F.count("*"), F.max(F.array_max(F.transform("vector", F.abs)))).first()
            narrow = F.col("vector").cast("array<smallint>" if (largest or 0) < 1 << 15 else "array<int>")
            anchors = copies.enter_context(staged(whole.where(anchor).withColumn("vector", narrow), "negatives-marked"))
            a, parts = anchors.count(), -(-n // TREE_ROWS) or 1
            dealt = whole.withColumn("vector", narrow).withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(parts)))
            builders = min(parts, max(partitions, -(-parts // LOOK)))
            grown = dealt.repartition(builders, "part").sortWithinPartitions("part").mapInArrow(_build, "part long, bytes long, tree binary")
            trees = copies.enter_context(staged(grown, "negatives-trees"))
        size = trees.agg(F.sum("bytes")).first()[0] or 0

        def best(asking: DataFrame, same: bool, most: int) -> DataFrame:
            def found(among: DataFrame, share: int) -> DataFrame:
                groups, lanes = _tasks(n // share, a, -(-parts // share), size // share, wanted)
                tasks = _dealt(asking, among.withColumn("place", F.expr(f"part div {share}")), groups, lanes)
                return _first(tasks.mapInArrow(_search(same, most, low, high, BLOCK), _FOUND), most, "anchor_id", "positive_id")

            if _tasks(n, a, parts, size, wanted)[0] > 2 * LOOK:
                last = found(trees.where(F.col("part") % LOOK == 0), LOOK).where(F.col("rank") == most)
                known = last.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list(F.struct("positive_id", "score")).alias("known"))
                least = F.expr("transform(windows, w -> struct(w.id, w.score, get(filter(known, k -> k.positive_id <=> w.id), 0).score AS least))")
                joined = asking.join(known.hint("merge"), "vec_id", "left").withColumn("windows", least).drop("known")
                asking = copies.enter_context(staged(joined, "negatives-known"))
            return found(trees, 1)

        near = best(anchors.withColumn("windows", F.expr(f"CAST(array((NULL, NULL, NULL)) AS {_WINDOWS})")), True, positives)
        windows = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.expr(f"CAST(collect_list(struct(other_id, score, NULL)) AS {_WINDOWS})").alias("windows"))
        asking = copies.enter_context(staged(anchors.join(windows.hint("merge"), "vec_id"), "negatives-anchors"))
        columns = ["anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")]
        return stage(best(asking, False, negatives).select(columns), "negatives")
