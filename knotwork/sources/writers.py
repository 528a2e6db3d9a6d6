"""Partitioned graph tables on a shared file system."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_partitioned_graph(
    df: DataFrame,
    path: str,
    partition_by: tuple[str, ...] = ("label", "part"),
    sort_within: tuple[str, ...] = ("id",),
    bloom_columns: tuple[str, ...] = (),
    max_records_per_file: int = 10_000_000,
    mode: str = "errorifexists",
) -> None:
    """Write one folder per label and partition.

    The rebalance hint shuffles on the partition columns and lets adaptive
    execution split a label or partition that holds most of the rows and join
    small ones, so neither giant tasks nor thousands of tiny files result.
    Rows are sorted inside each file for min/max skipping; bloom filters serve
    equality look-ups on promoted keys.
    """
    order = [*partition_by, *[c for c in sort_within if c in df.columns]]
    balanced = df.hint("rebalance", *[F.col(c) for c in partition_by]).sortWithinPartitions(*order)
    writer = balanced.write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
    for c in bloom_columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.partitionBy(*partition_by).parquet(path)


def write_property_index(index: DataFrame, path: str) -> None:
    """Store the inverted property table: a folder per label, rows sorted by key and value."""
    write_partitioned_graph(
        index, path, partition_by=("label",), sort_within=("key", "value_text"), bloom_columns=("value_text",)
    )


def save_bucketed(df: DataFrame, table: str, by: str, buckets: int, path: str | None = None) -> None:
    """Store a table bucketed and sorted by one id column.

    Vertices bucketed by ``id`` and edges by ``start_id`` with the same number of
    buckets join without a shuffle; pick the number so that a bucket fits a task.
    """
    spread = df.repartition(buckets, F.col(by))
    writer = spread.write.bucketBy(buckets, by).sortBy(by).format("parquet")
    (writer if path is None else writer.option("path", path)).saveAsTable(table)


def similar_edges(scores: DataFrame, label: str = "SIMILAR_TO", node_label: str | None = None) -> DataFrame:
    """Similarity rows (node1, node2, score) as typed edges."""
    end = F.lit(node_label).cast("string")
    return scores.select(
        F.lit(label).alias("label"),
        end.alias("start_label"),
        F.col("node1").alias("start_id"),
        end.alias("end_label"),
        F.col("node2").alias("end_id"),
        F.lit("{}").alias("props"),
        F.col("score").cast("double").alias("score"),
    )


def write_similar_edges(scores: DataFrame, path: str, node_label: str | None = None) -> None:
    """Append top similarities to an edge table partitioned by label."""
    edges = similar_edges(scores, node_label=node_label)
    write_partitioned_graph(edges, path, partition_by=("label",), sort_within=("start_id",), mode="append")
