"""Joins whose keys may be hot on either side."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knotwork.session import written

ROWS_PER_FRAGMENT = 100_000
PAIRS_PER_FRAGMENT = 2e7
ROWS_PER_TASK = 500_000


def spread(df: DataFrame, rows: int, *by: str) -> DataFrame:
    """Deal rows by the given columns to as many tasks as keep each near ROWS_PER_TASK rows.

    What follows groups them without another shuffle, and no task holds more when the table grows,
    whatever the session's number of partitions. ``rows`` is their number.
    """
    usual = min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows * 10 // ROWS_PER_TASK)
    return df.repartition(max(1, usual, -(-rows // ROWS_PER_TASK)), *by)


def meeting_counts(left: DataFrame, right: DataFrame, key_sets: Sequence[Sequence[str]]) -> DataFrame:
    """Rows of each side per key that both sides have, for several key sets in one scan of each.

    Rows are (set_no, key_hash, n_left, n_right). Counts are combined on the map
    side; the table is stored, as several plans start from it. A hash shared by
    two keys only makes their rows be cut finer. Null keys join nothing and are
    left out.
    """

    def keyed(set_no: int, keys: Sequence[str]) -> Column:
        present = reduce(and_, [F.col(k).isNotNull() for k in keys])
        return F.when(present, F.struct(F.lit(set_no).alias("set_no"), F.xxhash64(*keys).alias("key_hash")))

    def side(df: DataFrame, l: int, r: int) -> DataFrame:
        rows = df.select(F.inline(F.array_compact(F.array(*[keyed(i, keys) for i, keys in enumerate(key_sets)]))))
        return rows.select("set_no", "key_hash", F.lit(l).alias("l"), F.lit(r).alias("r"))

    both = side(left, 1, 0).unionByName(side(right, 0, 1)).groupBy("set_no", "key_hash")
    return written(both.agg(F.sum("l").alias("n_left"), F.sum("r").alias("n_right")).filter("n_left > 0 AND n_right > 0"), "meetings")


def grid(counts: DataFrame, rows_per_fragment: int | None = None, pairs_per_fragment: float | None = None) -> DataFrame:
    """Hot keys and how their pairs are cut: ``(key_hash, cuts_left, cuts_right)``.

    A key is hot if a side has too many rows for one task or both together too
    many pairs. Its pairs form a rectangle that is cut along both sides, about
    equally, so that each cell stays below the limits; rows of a side are
    repeated once per cut of the other, hence n x sqrt(pairs / limit) copies at
    most. There is no limit to the number of cells.
    """
    rows, pairs = rows_per_fragment or ROWS_PER_FRAGMENT, pairs_per_fragment or PAIRS_PER_FRAGMENT
    n_left, n_right = F.col("n_left").cast("double"), F.col("n_right").cast("double")
    square = F.ceil(F.sqrt(n_left * n_right / pairs))

    def cuts(own: Column, other: Column) -> Column:
        alone = F.ceil(own / rows)
        needed = F.ceil(own * other / pairs / F.least(other, square))  # the other side may be too short for its share
        return F.least(own, F.greatest(alone, square, needed)).cast("bigint")

    hot = counts.filter((n_left > rows) | (n_right > rows) | (n_left * n_right > pairs))
    return hot.select("key_hash", cuts(n_left, n_right).alias("cuts_left"), cuts(n_right, n_left).alias("cuts_right"))


def fragment_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_by: Sequence[str], right_by: Sequence[str],
    rows_per_fragment: int | None = None, pairs_per_fragment: float | None = None, counts: DataFrame | None = None,
    many_pairs: bool = False,
) -> DataFrame:
    """Inner equi-join in which keys that are hot on either side are spread over many tasks.

    Without hot keys it is a plain join. Otherwise the rows of a hot key are cut
    by the hash of ``left_by`` and ``right_by``, and every cell of that grid is a
    join key of its own; every pair is still formed exactly once. ``counts`` is
    ``meeting_counts`` without ``set_no`` when the caller has counted already.
    With ``many_pairs`` the number of tasks follows the number of pairs, which
    few input bytes can make.
    """
    keys = list(keys)
    if counts is None:
        counts = meeting_counts(left, right, [keys]).drop("set_no")
    on = keys
    hot = grid(counts, rows_per_fragment, pairs_per_fragment)
    if not hot.isEmpty():
        hot = written(hot, "hot")
        own_l, own_r = F.coalesce("cuts_left", F.lit(1)), F.coalesce("cuts_right", F.lit(1))

        def cut(df: DataFrame, own: Column, by: Sequence[str], other: Column, own_name: str, other_name: str) -> DataFrame:
            marked = df.withColumn("key_hash", F.xxhash64(*keys)).join(hot, "key_hash", "left")
            marked = marked.withColumn(own_name, F.pmod(F.xxhash64(*by), own))
            return marked.withColumn(other_name, F.explode(F.sequence(F.lit(0).cast("bigint"), other - 1))).drop("key_hash", "cuts_left", "cuts_right")

        left = cut(left, own_l, left_by, own_r, "_row", "_column")
        right = cut(right, own_r, right_by, own_l, "_column", "_row")
        on = [*keys, "_row", "_column"]
    if many_pairs:
        pairs = counts.agg(F.sum(F.col("n_left").cast("double") * F.col("n_right"))).first()[0] or 0.0
        tasks = max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(pairs / (pairs_per_fragment or PAIRS_PER_FRAGMENT)) + 1)
        left, right = left.repartition(tasks, *on), right.repartition(tasks, *on)
    return left.join(right, on).drop("_row", "_column")
