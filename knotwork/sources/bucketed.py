"""Tables in folders by the hash of a key, for look-ups that read only the folders they meet."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that a bucket holds on average, and the most buckets there are.
ROWS_PER_BUCKET, MOST_BUCKETS = 200_000, 4096
BUCKET = "bucket"


def bucket_count(rows: int, rows_per_bucket: int | None = None) -> int:
    """The number of buckets follows the rows, so a bucket keeps its size when the table grows."""
    return min(MOST_BUCKETS, rows // (rows_per_bucket or ROWS_PER_BUCKET) + 1)


@dataclass(frozen=True)
class Bucketed:
    """A stored table with a folder per bucket of ``key``; ``rows`` has the column ``bucket`` too."""

    rows: DataFrame
    key: str
    buckets: int

    @staticmethod
    def _bucket(key: str, buckets: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(buckets))

    @classmethod
    def store(cls, table: DataFrame, key: str, path: str, rows_per_bucket: int | None = None) -> Bucketed:
        """Write a table to a fresh path; a bucket with a hot key is split over files."""
        buckets = bucket_count(table.count(), rows_per_bucket)
        placed = table.withColumn(BUCKET, cls._bucket(key, buckets)).hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, key)
        placed.write.partitionBy(BUCKET).parquet(path)
        return cls(table.sparkSession.read.schema(placed.schema).parquet(path), key, buckets)

    def touched(self, wanted: DataFrame) -> DataFrame:
        """The buckets that can hold wanted keys, whole; their numbers, ``MOST_BUCKETS`` at most, come to the driver."""
        numbers = wanted.select(self._bucket(self.key, self.buckets).alias(BUCKET)).distinct().collect()
        return self.rows.filter(F.col(BUCKET).isin([r[BUCKET] for r in numbers])) if numbers else self.rows.limit(0)

    def rows_of(self, wanted: DataFrame) -> DataFrame:
        """The rows whose key is in the column of that name of ``wanted``."""
        return self.touched(wanted).drop(BUCKET).join(wanted.select(self.key), self.key, "left_semi")
