"""Comparison of all pairs of sets in bounded cells, for many sets over few different neighbours.

Where most sets share most neighbours, nearly every pair is a candidate, and a
shuffle of candidates costs more than comparing everything. The sets are then cut
into blocks by hash, every two blocks are one cell, and a cell is one product of
two matrices with a row per set and a column per neighbour. Only pairs that reach
the wanted score leave a cell, so nothing quadratic is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from knotwork.llm.common import ship

MOST_NEIGHBORS = 4096
ENTRIES_PER_BLOCK = 1 << 23
SETS_PER_BLOCK = 4096
#: Beyond so many blocks they grow up to four times, as each set is sent to every block.
FEW_BLOCKS = 24
PAIRS_AT_ONCE = 1 << 20
MOST_TASKS = 4096


def _divided(s: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.divide(s, whole, out=np.zeros_like(s), where=whole != 0)


def _scores(s: np.ndarray, x: dict[str, np.ndarray], y: dict[str, np.ndarray], metric: str) -> np.ndarray:
    """Scores of a stripe of pairs from their shared mass; the same formulas as ``similarity._score``."""
    if metric == "jaccard":
        return _divided(s, x["size"] + y["size"] - s)
    if metric == "weighted_jaccard":
        return _divided(s, x["total"] + y["total"] - s)
    if metric == "overlap":
        return _divided(s, np.minimum(x["size"], y["size"]))
    if metric == "cosine":
        return _divided(s, np.sqrt(x["squares"] * y["squares"]))
    return s


def _least(x: dict[str, np.ndarray], y: dict[str, np.ndarray], metric: str, floor: float) -> np.ndarray | float:
    """Shared mass that a pair needs to score ``floor``, less a little for rounding: a cheap test before the scores of those that pass."""
    if metric in ("jaccard", "weighted_jaccard"):
        whole = "size" if metric == "jaccard" else "total"
        slack = floor / (1 + floor) * (1 - 1e-4)
        return x[whole] * slack + (y[whole] * slack - 1e-6)
    if metric == "overlap":
        return np.minimum(x["size"], y["size"]) * (floor * (1 - 1e-4)) - 1e-6
    if metric == "cosine":
        return np.sqrt(x["squares"]) * (np.sqrt(y["squares"]) * (floor * (1 - 1e-4))) - 1e-6
    return floor - 1e-6


def block_count(sets: int, n_neighbors: int) -> int:
    """Blocks of SETS_PER_BLOCK sets, or of up to four times as many where there are more than FEW_BLOCKS; fewer sets if they are wide."""
    widest = max(1, ENTRIES_PER_BLOCK // max(n_neighbors, 1))
    usual, large = (-(-sets // min(n, widest)) for n in (SETS_PER_BLOCK, 4 * SETS_PER_BLOCK))
    return max(1, large, min(usual, FEW_BLOCKS))


def cell_scores(
    entries: DataFrame, profiles: DataFrame, metric: str, floor: float, weighted: bool, n_sets: int, n_neighbors: int,
    membership: DataFrame | None = None,
) -> DataFrame:
    """``(x, y, score)`` of every two sets that share a neighbour and score at least ``floor``, each pair once and x < y.

    ``entries`` is (profile, neighbor, m) and ``profiles`` (profile, size, total, squares). With ``membership``
    (node, profile) x and y are nodes instead of profiles, and the pairs need no join afterwards. A set is sent to
    one cell per block, so rows grow with the square of their number over that of a block. With weights ``floor``
    must be positive, as a shared mass of zero is then no sign that nothing is shared.
    """
    blocks = block_count(n_sets, n_neighbors)
    own = {"neighbors": "neighbor", "masses": "m"} if weighted else {"neighbors": "neighbor"}
    # the two lists are of one struct, so that they keep the same order
    sets = entries.filter(F.col("neighbor").isNotNull()).groupBy("profile").agg(F.collect_list(F.struct("neighbor", "m")).alias("_e")).select(
        "profile", *[F.col("_e")[c].alias(name) for name, c in own.items()]
    )
    numbers = ["size", "total", "squares"]
    placed = sets.join(profiles.select("profile", *[F.col(c).cast("double").alias(c) for c in numbers]), "profile").withColumnRenamed("profile", "name")
    if membership is not None:
        named = membership.select(F.col("profile").alias("name"), F.col("node").alias("_node")).filter(F.col("_node").isNotNull())
        placed = named.join(placed, "name").drop("name").withColumnRenamed("_node", "name")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("name"), F.lit(blocks)))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint")))
    cells = placed.withColumn("_other", other).withColumn(
        "cell", F.least("block", "_other") * F.lit(blocks).cast("bigint") + F.greatest("block", "_other")
    ).drop("_other")
    kind = placed.schema["name"].dataType
    schema = T.StructType([T.StructField("x", kind), T.StructField("y", kind), T.StructField("score", T.DoubleType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches)
        rows = rows.take(pc.sort_indices(rows, sort_keys=[("name", "ascending")])).combine_chunks()
        names, block, lists = (rows[c].combine_chunks() for c in ("name", "block", "neighbors"))
        block = block.to_numpy(zero_copy_only=False)
        codes = lists.flatten().dictionary_encode()
        at = (np.repeat(np.arange(len(names)), pc.list_value_length(lists).to_numpy(zero_copy_only=False)), codes.indices.to_numpy(zero_copy_only=False))
        right = np.zeros((len(names), len(codes.dictionary)), dtype=np.float64 if weighted else np.float32)
        right[at] = 1.0
        left = right
        if weighted:
            left = np.zeros_like(right)
            left[at] = rows["masses"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        one, two = (np.flatnonzero(block == b) for b in (block.min(), block.max()))
        within = block.min() == block.max()
        facts = {c: rows[c].to_numpy() for c in numbers}
        quick = {c: v.astype(right.dtype) for c, v in facts.items()}
        against, y = right[two].T, {c: v[two] for c, v in quick.items()}
        step = max(1, PAIRS_AT_ONCE // max(len(two), 1))
        for start in range(0, len(one), step):
            stripe = one[start : start + step]
            s = left[stripe] @ against
            least = _least({c: v[stripe, None] for c, v in quick.items()}, y, metric, floor)
            keep = s >= (least if weighted else np.maximum(least, 0.5))  # counts are whole numbers
            if within:
                keep &= np.arange(len(two)) > np.arange(start, start + len(stripe))[:, None]
            a, b = np.nonzero(keep)
            i, j = stripe[a], two[b]
            score = _scores(s[a, b].astype(np.float64), {c: v[i] for c, v in facts.items()}, {c: v[j] for c, v in facts.items()}, metric)
            if not (sure := score >= floor - 1e-12).all():
                i, j, score = i[sure], j[sure], score[sure]
            if len(i):  # names are in order
                first, second = (names.take(pa.array(at)) for at in (np.minimum(i, j), np.maximum(i, j)))
                yield pa.RecordBatch.from_arrays([first, second, pa.array(score)], names=["x", "y", "score"])

    ship(entries.sparkSession)
    n_cells = blocks * (blocks + 1) // 2
    tasks = max(int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(n_cells, MOST_TASKS))
    return cells.repartition(tasks, "cell").groupBy("cell").applyInArrow(work, schema)
