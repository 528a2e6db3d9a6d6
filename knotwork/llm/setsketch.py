"""SetSketch registers of shingle sets: merged by maximum, banded for candidates, compared by joint likelihood."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property, partial
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knotwork.llm.common import arrow_map, record, slices, whole_text
from knotwork.operators.clusters import entity_clusters
from knotwork.session import written

SEED = 42
#: Pairs are read exactly unless their estimate lies so many standard deviations below the similarity.
DEVIATIONS = 4
#: Rounds in which the sets of a bucket are compared with one of them, before the rest is compared in cells.
HEAD_ROUNDS = 2
#: A cell compares at most about so many sets, of so many elements in all, with as many others.
CELL_SETS, CELL_ELEMENTS = 1024, 1 << 21
#: Pairs of a cell that are estimated together.
CELL_PAIRS = 16_384
#: Elements hashed at a time; a set of any size is sketched in parts of so many, which are merged.
ELEMENTS_AT_ONCE = 512

_hash = partial(xxhash.xxh64_intdigest, seed=SEED)


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """The distinct hashes of the ``words``-word shingles in ascending order.

    A-Z are lower-cased; words are separated by space, tab, line feed, vertical
    tab, form feed and carriage return. Fewer words are one shingle, no words none.
    """
    found = text.lower().split()
    if len(found) <= words:
        shingles = [b" ".join(found)] if found else []
    else:
        shingles = set(map(b" ".join, zip(*(found[i:] for i in range(words)))))
    hashed = np.fromiter(map(_hash, shingles), dtype=np.uint64, count=len(shingles))
    return np.unique(hashed)


def set_key(hashes: np.ndarray) -> int:
    """A signed 64-bit name of a set, the same for equal sets."""
    return int(np.uint64(_hash(hashes.tobytes())).view(np.int64))


@dataclass(frozen=True)
class SetSketch:
    """Parameters of a sketch (Ertl, "SetSketch: filling the gap between MinHash and HyperLogLog", 2021).

    Every element gets an exponential variate of rate ``rate`` per register.
    A register keeps the least of them on a scale of powers of ``base``, cut to
    0..``top``: floor(1 - log_base(least)). The maximum of two registers is the
    register of the union. With a base near 1 two registers agree with a
    probability close to the Jaccard similarity. ``bands`` groups of ``rows``
    registers each serve as join keys.
    """

    bands: int = 32
    rows: int = 8
    base: float = 1.1
    rate: float = 20.0
    top: int = 254

    @property
    def size(self) -> int:
        return self.bands * self.rows

    @cached_property
    def _multipliers(self) -> np.ndarray:
        draws = np.random.default_rng(SEED).integers(0, 2**63, (2, self.size), dtype=np.int64).astype(np.uint64)
        draws[0] = draws[0] * np.uint64(2) + np.uint64(1)
        return draws

    def registers(self, hashes: np.ndarray) -> np.ndarray:
        """The registers of a set of 64-bit hashes; all 0 for the empty set."""
        factor, shift = self._multipliers
        least = np.full(self.size, np.iinfo(np.uint64).max, dtype=np.uint64)
        for start in range(0, len(hashes), ELEMENTS_AT_ONCE):
            some = hashes[start : start + ELEMENTS_AT_ONCE, None] * factor
            some += shift
            np.minimum(least, some.min(axis=0), out=least)
        if not len(hashes):
            return np.zeros(self.size, dtype=np.uint8)
        uniform = (least.astype(np.float64) + 0.5) / 2.0**64
        variate = -np.log1p(-np.minimum(uniform, 1 - 1e-16)) / self.rate
        return np.clip(np.floor(1 - np.log(variate) / math.log(self.base)), 0, self.top).astype(np.uint8)

    def band_keys(self, registers: np.ndarray) -> list[int]:
        """One signed 64-bit key per band, of its number and register values."""
        rows = registers.reshape(self.bands, self.rows)
        return [int(np.uint64(xxhash.xxh64_intdigest(r.tobytes(), seed=i)).view(np.int64)) for i, r in enumerate(rows)]

    def _above(self, x: np.ndarray) -> np.ndarray:
        """Probability that a register of one set exceeds the other's, for the part ``x`` of both that only the one holds."""
        return -np.log1p(-x * (self.base - 1) / self.base) / math.log(self.base)

    def likelihood(self, similarity: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, above: np.ndarray, below: np.ndarray) -> np.ndarray:
        """Log-likelihood of Jaccard similarities for sets of known sizes, given in how many registers a exceeds b and falls below it."""
        u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
        more, less = (self._above(np.clip(x, 1e-12, 1)) for x in (u - v * similarity, v - u * similarity))
        same = np.maximum(1 - more - less, 1e-12)
        return above * np.log(more) + below * np.log(less) + (self.size - above - below) * np.log(same)

    def estimate(self, n_a: np.ndarray, n_b: np.ndarray, a: np.ndarray, b: np.ndarray, steps: int = 18) -> np.ndarray:
        """Maximum-likelihood Jaccard similarity of pairs of register rows, by golden-section search."""
        n_a, n_b = n_a.astype(np.float64), n_b.astype(np.float64)
        above, below = (a > b).sum(axis=1), (a < b).sum(axis=1)
        low, high = np.zeros(len(n_a)), np.minimum(n_a, n_b) / np.maximum(n_a, n_b)
        golden = (math.sqrt(5) - 1) / 2
        for _ in range(steps):
            left, right = high - golden * (high - low), low + golden * (high - low)
            better = self.likelihood(left, n_a, n_b, above, below) > self.likelihood(right, n_a, n_b, above, below)
            low, high = np.where(better, low, left), np.where(better, right, high)
        return (low + high) / 2

    def spread(self, similarity: float) -> float:
        """Standard deviation of the estimate near a similarity, for sets of equal size."""
        return math.sqrt(similarity * (1 - similarity) / self.size)


def sketches(docs: DataFrame, words: int, sketch: SetSketch) -> DataFrame:
    """``(doc_id, text_key, key, n, registers)`` of every row; texts without words have n = 0 and a null key."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets = [shingle_set(t, words) for t in part.column("text").to_pylist()]
            yield record(
                doc_id=part.column("doc_id"), text_key=part.column("text_key"),
                key=pa.array([set_key(s) if len(s) else None for s in sets], pa.int64()),
                n=pa.array([len(s) for s in sets], pa.int64()),
                registers=pa.array([sketch.registers(s).tobytes() for s in sets], pa.binary()),
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(whole_text()).alias("text_key"), whole_text().cast("binary").alias("text"))
    return arrow_map(rows, work, "doc_id bigint, text_key bigint, key bigint, n bigint, registers binary")


def _entries(sets: DataFrame, sketch: SetSketch) -> DataFrame:
    """``(bucket, band, key, n)``: a row per band of every set."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            keys = [sketch.band_keys(np.frombuffer(r, dtype=np.uint8)) for r in part.column("registers").to_pylist()]
            at = np.repeat(np.arange(len(keys)), sketch.bands)
            yield record(
                bucket=pa.array(np.array(keys, dtype=np.int64).reshape(-1)), band=pa.array(np.tile(np.arange(sketch.bands, dtype=np.int32), len(keys))),
                key=part.column("key").take(pa.array(at)), n=part.column("n").take(pa.array(at)),
            )

    return arrow_map(sets.select("key", "n", "registers"), work, "bucket bigint, band int, key bigint, n bigint")


def _sets_of(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``(key, elements)`` of the sets in ``wanted`` (text_key, key), each from one of its texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets = [shingle_set(t, words) for t in part.column("text").to_pylist()]
            yield record(key=part.column("key"), elements=pa.array([s.tobytes() for s in sets], pa.binary()))

    # copies are reduced to one where they are read, before they meet
    texts = docs.select(F.xxhash64(whole_text()).alias("text_key"), whole_text().cast("binary").alias("text"))
    texts = texts.groupBy("text_key").agg(F.first("text").alias("text")).join(wanted, "text_key")
    return arrow_map(texts.select("key", "text"), work, "key bigint, elements binary")


def reaches(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether the Jaccard similarity of two sorted sets is ``similarity`` or more, in whole hundredths of a percent."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 10_000 * shared >= round(10_000 * similarity) * (len(a) + len(b) - shared)


def _near_enough(sketch: SetSketch, similarity: float, n_a: np.ndarray, n_b: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return sketch.estimate(n_a, n_b, a, b) >= similarity - DEVIATIONS * sketch.spread(similarity)


def _sizes_allow(a: str, b: str, similarity: float):
    return F.least(a, b) * 10_000 >= F.lit(round(10_000 * similarity)) * F.greatest(a, b)


def _linked(pairs: DataFrame, sets: DataFrame, bodies: DataFrame, similarity: float, sketch: SetSketch) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity: by their registers first, those left by their elements."""

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            regs = [np.frombuffer(b"".join(part.column(c).to_pylist()), dtype=np.uint8).reshape(-1, sketch.size) for c in ("registers_a", "registers_b")]
            keep = _near_enough(sketch, similarity, part.column("n_a").to_numpy(), part.column("n_b").to_numpy(), *regs)
            yield part.select(["a", "b"]).filter(pa.array(keep))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in slices([whole], "elements_a"):
                sides = (part.column(c).to_pylist() for c in ("elements_a", "elements_b"))
                keep = [reaches(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), similarity) for x, y in zip(*sides)]
                yield part.select(["a", "b"]).filter(pa.array(keep))

    def with_both(pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
        for x in "ab":
            pairs = pairs.join(table.select(F.col("key").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in columns)), x)
        return pairs

    some = written(arrow_map(with_both(pairs, sets, "n", "registers"), likely, "a bigint, b bigint"), "likely-pairs")
    return written(arrow_map(with_both(some, bodies, "elements"), exact, "a bigint, b bigint"), "exact-links")


def _cell_pairs(cluster: np.ndarray, n: np.ndarray, side: np.ndarray, earlier: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of a cell that are apart, of fitting sizes, and not brought together by an earlier band; about ``CELL_PAIRS`` at a time."""
    held, size = [], 0
    for i in range(len(n) - 1):
        others = np.arange(i + 1, len(n))
        others = others[(cluster[others] != cluster[i]) & ((side[others] != side[i]) | (side[i] == 2))]
        others = others[10_000 * np.minimum(n[others], n[i]) >= least * np.maximum(n[others], n[i])]
        if len(others):
            others = others[~(earlier[others] == earlier[i]).any(axis=1)]
            held.append((np.full(len(others), i), others))
            size += len(others)
        if size >= CELL_PAIRS or i == len(n) - 2:
            if size:
                yield tuple(np.concatenate(x) for x in zip(*held))
            held, size = [], 0


def cell_links(rows: list[tuple], similarity: float, sketch: SetSketch) -> list[tuple[int, int]]:
    """Links that connect what the pairs of one cell connect; each row is (key, cluster, n, side, band, registers, elements).

    Rows of side 0 and 1 are compared across, rows of side 2 with each other.
    A pair is left out if its clusters are one already, or if an earlier band
    brings it together too.
    """
    rows = sorted(rows, key=itemgetter(0))
    key, cluster, n, side = (np.array([r[i] for r in rows]) for i in range(4))
    band, elements = rows[0][4], [np.frombuffer(r[6], dtype=np.uint64) for r in rows]
    registers = np.frombuffer(b"".join(r[5] for r in rows), dtype=np.uint8).reshape(len(rows), sketch.size)
    bands = registers.reshape(len(rows), sketch.bands, sketch.rows)[:, :band]
    earlier = np.empty((len(rows), band), dtype=np.int32)  # equal numbers for equal registers
    for i in range(band):
        earlier[:, i] = np.unique(bands[:, i], axis=0, return_inverse=True)[1].reshape(-1)
    found = []
    for a, b in _cell_pairs(cluster, n, side, earlier, round(10_000 * similarity)):
        near = _near_enough(sketch, similarity, n[a], n[b], registers[a], registers[b])
        for i, j in zip(a[near].tolist(), b[near].tolist()):
            if cluster[j] != cluster[i] and reaches(elements[i], elements[j], similarity):
                found.append((int(key[i]), int(key[j])))
                cluster[cluster == cluster[j]] = cluster[i]
    return found


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for whole in batches:
        for part in slices([whole], "elements"):
            yield from zip(*(c.to_pylist() for c in part.columns))


def _links_in_cells(open_: DataFrame, sets: DataFrame, bodies: DataFrame, similarity: float, sketch: SetSketch) -> DataFrame:
    """Links between the clusters that still meet in a bucket; every pair that shares a bucket is compared.

    The members of a bucket are dealt to chunks of bounded size, and each pair of
    chunks is a cell of its own, so that a task holds one cell at a time.
    """
    sizes = open_.groupBy("bucket").agg(F.greatest(F.ceil(F.count("*") / CELL_SETS), F.ceil(F.sum("n") / CELL_ELEMENTS)).alias("chunks"))
    dealt = open_.join(sizes, "bucket").withColumn("own", F.pmod(F.xxhash64("key"), F.col("chunks")))
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0L, chunks - 1)")))
    side = F.when(F.col("own") == F.col("other"), 2).otherwise((F.col("own") > F.col("other")).cast("int"))
    cells = dealt.select("bucket", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "key", "cluster", "n", side.alias("side"), "band")
    cells = cells.join(sets.select("key", "registers"), "key").join(bodies, "key")
    cells = cells.select("bucket", "x", "y", "key", "cluster", "n", "side", "band", "registers", "elements")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groupby(_rows(batches), key=itemgetter(0, 1, 2)):
            found = cell_links([r[3:] for r in rows], similarity, sketch)
            if found:
                yield record(a=pa.array([a for a, _ in found], pa.int64()), b=pa.array([b for _, b in found], pa.int64()))

    order = ("bucket", "x", "y")
    return written(arrow_map(cells.repartition(*order).sortWithinPartitions(*order), work, "a bigint, b bigint"), "links-of-cells")


def _still_open(entries: DataFrame, clusters: DataFrame) -> DataFrame:
    """Entries of the buckets that hold more than one cluster, with the clusters of their sets."""
    named = entries.drop("cluster").join(clusters, "key", "left").withColumn("cluster", F.coalesce("cluster", "key"))
    named = written(named, "bucket-clusters")
    apart = named.groupBy("bucket").agg(F.min("cluster").alias("x"), F.max("cluster").alias("y")).filter("x != y").select("bucket")
    return written(named.join(apart, "bucket", "left_semi"), "open-buckets")


def set_clusters(docs: DataFrame, sketched: DataFrame, words: int, similarity: float, sketch: SetSketch) -> DataFrame:
    """``(key, cluster)`` of the sets that are linked to another one; ``sketched`` is the stored ``sketches(docs)``.

    Sets meet in the buckets of their bands. In a few rounds all sets of a bucket
    that are not connected yet are compared with one of them, another in every
    round, which connects large groups of near copies at little cost. Pairs that
    are apart after that are compared in cells of bounded size, all of them. A
    pair of similarity s meets unless all bands differ, (1 - s^rows)^bands; every
    link is confirmed on the elements.
    """
    sets = sketched.filter("key IS NOT NULL").groupBy("key").agg(
        F.min("text_key").alias("text_key"), F.first("n").alias("n"), F.first("registers").alias("registers"),
    )
    sets = written(sets, "sets")
    entries = written(_entries(sets, sketch), "band-entries")
    shared = entries.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1").select("bucket")
    open_ = written(entries.join(shared, "bucket", "left_semi").withColumn("cluster", F.col("key")), "open-buckets")
    wanted = sets.select("key", "text_key").join(open_.select("key").distinct(), "key")
    bodies = written(_sets_of(docs, wanted, words), "set-elements")
    links, number = sets.sparkSession.createDataFrame([], "a bigint, b bigint"), 0
    while number < HEAD_ROUNDS and not open_.isEmpty():
        head = F.min(F.struct(F.xxhash64("key", F.lit(number)).alias("place"), F.col("key").alias("a"), F.col("cluster").alias("cluster_a"), F.col("n").alias("n_a")))
        heads = open_.groupBy("bucket").agg(head.alias("head")).select("bucket", "head.*")
        met = open_.join(heads, "bucket").filter(F.col("cluster") != F.col("cluster_a")).filter(_sizes_allow("n", "n_a", similarity))
        found = _linked(met.select("a", F.col("key").alias("b")).distinct(), sets, bodies, similarity, sketch)
        if found.isEmpty():
            break
        links, number = links.unionByName(found), number + 1
        open_ = _still_open(open_, written(entity_clusters(links).select(F.col("id").alias("key"), "cluster"), "set-clusters"))
    if not open_.isEmpty():
        links = links.unionByName(_links_in_cells(open_, sets, bodies, similarity, sketch))
    return entity_clusters(links).select(F.col("id").alias("key"), "cluster")


def near_duplicates(docs: DataFrame, words: int = 5, similarity: float = 0.8, sketch: SetSketch = SetSketch()) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of every row.

    Documents are linked if the sets of their ``words``-word shingles have a
    Jaccard similarity of ``similarity`` (to a hundredth of a percent) or more.
    ``component_id`` is the smallest doc_id that is reachable, ``kept`` tells the
    document that has it. Null and empty texts and texts without words have no
    shingles and are linked with nothing; equal texts with words are always linked.
    Null ids are never smallest and never kept; a group of nothing else has a
    null component. Repeated rows are each returned. Extra columns are ignored.
    Sets are named by 64-bit hashes.
    """
    if not 0 < similarity <= 1 or words < 1:
        raise ValueError("similarity lies in (0, 1], shingles have a word at least")
    sketched = written(sketches(docs, words, sketch), "sketches")
    linked = written(set_clusters(docs, sketched, words, similarity, sketch), "linked-sets")
    least = sketched.filter("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("least"))
    grouped = written(least.join(linked, "key", "left").withColumn("cluster", F.coalesce("cluster", "key")), "set-groups")
    named = grouped.groupBy("cluster").agg(F.min("least").alias("component_id"))
    groups = written(grouped.join(named, "cluster").select("key", "component_id"), "set-components")
    rows = sketched.join(groups, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"),
    )
