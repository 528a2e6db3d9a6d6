"""Headline queries at one scale factor; prints one JSON line."""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import time
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, Observation  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from knotwork.functions.properties import prop_date  # noqa: E402
from knotwork.operators import partitions  # noqa: E402
from knotwork.operators.graph import range_scan  # noqa: E402
from knotwork.plans import fixtures  # noqa: E402
from knotwork.plans.catalog import QUERIES  # noqa: E402
from knotwork.plans.registry import Tables  # noqa: E402
from knotwork.session import local_session, scratch_path  # noqa: E402
from knotwork.sources.writers import write_partitioned_graph  # noqa: E402

HEADLINE = [
    "edge_counts", "edge_expand", "merge_vertices", "merge_subset_match", "partition_distribution", "range_scan",
    "range_scan_pruned", "describe", "correlation_matrix", "similarity_topk", "cosine_idf", "shared_neighbor_pairs",
    "blocking_pairs", "match_decision", "likely_pairs", "link_or_new", "entity_clusters", "risk_connections",
]


SECONDS = 420  # no query is repeated once this much time has gone


def pruned_scan(tables: Tables) -> Callable[[], DataFrame]:
    """The pruned range scan on a table that is written beforehand."""
    path = scratch_path(tables.spark, "bench-graph")
    spec = partitions.year_ranges("Order", range(fixtures.AS_OF.year - 2, fixtures.AS_OF.year + 2), with_default=True)
    day = prop_date(F.col("props"), "created_at")
    orders = fixtures.order_vertices(tables)
    write_partitioned_graph(orders.withColumn("created_at", day).withColumn("part", partitions.year_partition(day, fixtures.AS_OF)), path)
    lo, hi = dt.date(1997, 3, 1), dt.date(2000, 2, 1)
    return lambda: range_scan(tables.spark.read.parquet(path), "Order", "created_at", lo, hi, spec).select("id", "props")


def run(build: Callable[[], DataFrame], repeats: int, until: float) -> tuple[float, int]:
    """Median seconds and rows out."""
    times, rows = [], 0
    while not times or len(times) < repeats and time.perf_counter() < until:
        seen = Observation()
        start = time.perf_counter()
        build().observe(seen, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
        rows = seen.get["rows"]
    return statistics.median(times), rows


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = local_session("bench", cores=cpus, shuffle_partitions=max(8, int(cpus) if cpus.isdigit() else 8))
    tables = Tables(spark, folder)
    until = time.perf_counter() + SECONDS
    for key in ("row_count", "edge_counts"):
        run(lambda: QUERIES[key](tables), 1, until)  # noqa: B023
    found = {}
    for key in HEADLINE:
        build = pruned_scan(tables) if key == "range_scan_pruned" else lambda: QUERIES[key](tables)  # noqa: B023
        found[key] = run(build, repeats, until)
    times = {key: round(seconds, 3) for key, (seconds, _) in found.items()}
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "rows": {key: rows for key, (_, rows) in found.items()}, "sf": Path(folder).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
