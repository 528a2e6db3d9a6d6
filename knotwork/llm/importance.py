"""Importance resampling towards a target distribution, over hashed n-grams found by overlapped regex scanning."""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from knotwork.llm.common import arrow_map, free_names, record, slices, whole_text
from knotwork.session import written

BUCKETS = 10_000
SEED = 2024
#: A-Z to a-z; digits, small letters and all bytes of other characters stay; every other byte separates words.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def collapsed(text: bytes) -> bytes:
    """The words of a UTF-8 text in lower case, with single spaces between them."""
    return b" ".join(text.translate(_LETTERS).split())


def _spans(words: int) -> regex.Pattern:
    """Matches a run of ``words`` words of a collapsed text; scanned with overlaps it starts at every word once."""
    return regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (words - 1))


class Scanner:
    """Buckets of the n-grams of 1 to ``longest`` words of a text."""

    def __init__(self, longest: int, buckets: int) -> None:
        if longest < 1 or buckets < 1:
            raise ValueError("n-grams have a word at least, and there is a bucket at least")
        self.patterns, self.buckets = [_spans(n) for n in range(1, longest + 1)], buckets

    def grams(self, text: bytes) -> Iterator[bytes]:
        """Every n-gram in order of its length and place, repeats included."""
        line = collapsed(text)
        for pattern in self.patterns:
            for found in pattern.finditer(line, overlapped=True):
                yield found[0]

    def __call__(self, text: bytes) -> np.ndarray:
        return np.fromiter(map(crc32, self.grams(text)), dtype=np.uint32) % np.uint32(self.buckets)


def _texts(docs: DataFrame) -> Column:
    return whole_text().cast("binary").alias("text")


def bucket_counts(docs: DataFrame, longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, n)``: how many n-grams of all texts fall into a bucket; buckets without any have no row.

    A task adds up its documents in one array of ``buckets`` numbers and sends it once.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan, total = Scanner(longest, buckets), np.zeros(buckets, dtype=np.int64)
        for part in slices(batches):
            for text in part.column("text").to_pylist():
                found = scan(text)
                if len(found) < buckets:
                    np.add.at(total, found, 1)
                else:
                    total += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(total)
        yield record(bucket=pa.array(held, pa.int64()), n=pa.array(total[held], pa.int64()))

    return arrow_map(docs.select(_texts(docs)), work, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) for every bucket, in double precision."""
    all_s, all_t = float(sum(corpus.values())) + buckets, float(sum(target.values())) + buckets
    return np.array(
        [math.floor(1000 * math.log((target.get(b, 0) + 1.0) * all_s / ((corpus.get(b, 0) + 1.0) * all_t))) for b in range(buckets)],
        dtype=np.int64,
    )


def train(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Gains of all buckets, from the whole texts of both tables; ``buckets`` rows of each come to the driver."""
    found = [
        {r["bucket"]: r["n"] for r in bucket_counts(table, longest, buckets).collect()} for table in (docs, target)
    ]
    return gains(*found, buckets)


def weights(docs: DataFrame, table: np.ndarray, longest: int = 1) -> DataFrame:
    """``(doc_id, n_words, n_features, weight)``: the floored mean gain of a document's n-grams, 0 if it has none."""
    size = len(table)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scanner(longest, size)
        for part in slices(batches):
            n_words, n_features, weight = [], [], []
            for text in part.column("text").to_pylist():
                found = scan(text)
                n_words.append(len(text.translate(_LETTERS).split()) if longest > 1 else len(found))
                n_features.append(len(found))
                weight.append(int(table[found].sum()) // len(found) if len(found) else 0)
            yield record(
                doc_id=part.column("doc_id"), n_words=pa.array(n_words, pa.int64()),
                n_features=pa.array(n_features, pa.int64()), weight=pa.array(weight, pa.int64()),
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _texts(docs))
    return arrow_map(rows, work, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths from the first 32 bits of sha256("seed:doc_id"); a null id counts as empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(-1000 * F.log(-F.log(uniform))).cast("bigint")


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """The rows with their position from 1 in the order, as column ``name``.

    Rows are dealt by ranges of the order, each task sorts its own range and
    numbers it, and the counts of the ranges before are added: no task holds more
    than its range. Rows that tie in everything keep the order they were read in,
    so that many equal rows are spread too.
    """
    tie, place, part = free_names(df, "_tie", "_place", "_part")
    keys = [*order, F.col(tie)]
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    rows = written(dealt.drop(tie).withColumn(place, F.monotonically_increasing_id()), "numbered")
    rows = rows.withColumn(part, F.shiftright(place, 33))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    bases = rows.groupBy(part).agg(F.count("*").alias("n")).select(part, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = F.col(place).bitwiseAND(F.lit((1 << 33) - 1))
    return rows.join(bases, part).withColumn(name, F.col("base") + within + 1).drop(part, place, "base")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, longest: int = 1,
    buckets: int = BUCKETS, seed: int = SEED,
) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` of every document; ``rank`` is null where it is not drawn.

    A score is the document's weight plus Gumbel noise, so the best scores are a
    draw without replacement in proportion to exp(weight / 1000). Of the N
    documents with ``least_words`` words, floor(percent N / 100) are drawn; ties
    go to the smaller doc_id, null ids last. Null and empty texts have weight 0
    and are drawn only if ``least_words`` is 0. Texts are never cut. Repeated rows
    are rows of their own with the same score. Extra columns of either table are
    ignored; an empty ``docs`` gives no rows, an empty ``target`` no occurrences.
    """
    if not 0 <= percent <= 100:
        raise ValueError("percent is between 0 and 100")
    scored = weights(docs, train(docs, target, longest, buckets), longest)
    scored = written(scored.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scored")
    enough = F.col("n_words") >= least_words
    drawn = scored.filter(enough).count() * percent // 100
    placed = numbered(scored, [F.desc(enough), F.desc("score"), F.asc_nulls_last("doc_id")], "rank")
    return placed.select("doc_id", "n_features", "weight", "score", F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
