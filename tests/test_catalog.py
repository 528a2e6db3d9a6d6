"""Registered queries against their SQL oracles on the smallest tables, and what their plans must not hold."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from knotwork.operators.graph import edge_expand
from knotwork.plans import fixtures as X
from knotwork.plans.catalog import ORACLES, QUERIES
from knotwork.plans.registry import Tables
from tools.check_oracle import compare

FOLDER = "/root/testdata/sf0.001"
COMPARED = [
    "edge_counts", "graph_stats", "label_check", "props_typed", "props_literal_text", "range_scan_pruned", "resolve_endpoints",
    "ingest_report", "merge_triplets", "partition_distribution", "range_spec_check", "similarity_topk", "cosine_idf",
    "match_decision", "likely_pairs", "link_or_new", "entity_clusters", "merged_profile", "risk_connections",
    "describe", "correlation_matrix", "histogram", "kde", "code_blocks", "adjacency",
]
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in Path(FOLDER).glob("*.parquet"):
        c.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("key", COMPARED)
def test_same_rows_as_sql(spark, con, key):
    assert compare(spark, con, FOLDER, key, entry.queries()[key], ORACLES[key]).startswith("ok")


@pytest.mark.parametrize("key", ["edge_expand", "assign_range", "blocking_pairs", "jaccard_similarity", "kde", "table_page", "idf_weights"])
def test_plan_stays_in_equi_joins_and_jvm(spark, key):
    plan = QUERIES[key](Tables(spark, FOLDER))._jdf.queryExecution().executedPlan().toString()
    assert not [w for w in FORBIDDEN if w in plan]


def test_counting_edges_reads_no_properties(spark):
    plan = QUERIES["edge_counts"](Tables(spark, FOLDER))._jdf.queryExecution().executedPlan().toString()
    assert "l_quantity" not in plan and "o_orderdate" not in plan


def test_expansion_reads_only_needed_columns(spark):
    t = Tables(spark, FOLDER)
    plan = edge_expand(X.placed(t), X.vertices(t)).groupBy("label").count()._jdf.queryExecution().executedPlan().toString()
    assert "p_name" not in plan and "c_mktsegment" not in plan


def test_entry_runs(spark):
    assert entry.entry(spark).columns == ["node1", "node2", "score"]
