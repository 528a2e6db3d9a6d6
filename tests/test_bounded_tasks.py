"""Tasks hold a bounded number of rows, whatever the session's number of partitions."""

import random

import pytest
from pyspark.sql import functions as F

from knotwork.operators import customer, resolution, skew
from knotwork.operators import graph as G
from knotwork.session import written
from tests.test_resolution import plain_paths


def _edges(spark, text):
    edges = spark.range(9000).selectExpr("id % 300 AS start_id", "id DIV 10 AS end_id")
    edges = edges.unionByName(spark.sql("SELECT 7 AS start_id, id AS end_id FROM range(5000)")).unionByName(edges.limit(50))
    return edges.select(*[F.concat(F.lit("v"), F.col(c).cast("string")).alias(c) for c in edges.columns]) if text else edges


def _tasks(df):
    return df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"))


def test_adjacency_and_incident_counts_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 200)
    for text in (False, True):
        edges = _edges(spark, text)
        found = G.adjacency(edges)
        assert found.rdd.getNumPartitions() > 40
        rows = found.select("id", F.inline("neighbors").alias("other", "n")).collect()
        expected = edges.groupBy("start_id", "end_id").count().collect()
        assert sorted(map(tuple, rows)) == sorted(map(tuple, expected))
        counts = {r["node"]: (r["incident"], r["neighbors"]) for r in G.incident_counts(edges).collect()}
        both = G.undirected(edges).groupBy("node").agg(F.count("*").alias("i"), F.count_distinct("neighbor").alias("n")).collect()
        assert counts == {r["node"]: (r["i"], r["n"]) for r in both}
        assert "REPARTITION_BY_NUM" in G.incident_counts(edges)._jdf.queryExecution().executedPlan().toString()
    assert _tasks(G.neighbor_blocks(_edges(spark, True).toDF("node", "neighbor"))).count() > 40


def test_long_lists_of_text_ids_are_cut_and_short_ones_whole(spark):
    found = G.adjacency(_edges(spark, True), block_bits=8)
    sizes = found.groupBy("id").agg(F.count("*").alias("blocks"), F.max(F.size("neighbors")).alias("most"))
    assert sizes.filter("id = 'v7'").first()["blocks"] > 30 and sizes.agg(F.max("most")).first()[0] <= 256
    assert sizes.filter("id <> 'v7' AND blocks > 1").isEmpty()


@pytest.mark.parametrize("hops", [1, 3])
def test_risk_paths_through_hubs_store_no_pairs(spark, monkeypatch, hops):
    chance, stored = random.Random(hops), []
    pairs = [(chance.randrange(60), f"n{chance.randrange(45)}") for _ in range(110)] + [(i, f"hub{i % 4}") for i in range(0, 60, 3)]
    pairs += [(i, "all") for i in range(100, 300)] + [(100, "n1"), (200, "n2")]
    asked, flagged = {*range(0, 60, 3), *range(100, 300, 2)}, {*range(0, 60, 4), *range(101, 300, 2)}
    ends = [spark.createDataFrame([(x,) for x in nodes], "node bigint") for nodes in (asked, flagged)]
    frame = spark.createDataFrame([*pairs, pairs[0], (None, "hub1"), (3, None)], "node bigint, neighbor string")
    monkeypatch.setattr(customer, "HUB_NODES", 4)
    monkeypatch.setattr(customer, "RARE_PATHS_PER_ROW", 2)

    def counted(df, name):
        stored.append((name, (kept := written(df, name)).count()))
        return kept

    monkeypatch.setattr(customer, "written", counted)
    found = {(r["node"], r["flagged"]): (r["hops"], r["path"]) for r in customer.risk_paths(frame, *ends, hops).collect()}
    assert found == plain_paths(pairs, asked, flagged, hops) and len(found) > 10_000
    assert max(n for _, n in stored) < 4_000


def test_blocking_counts_keys_in_bounded_tasks(spark, monkeypatch):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 100)
    seen = []

    def counted(left, right, key_sets):
        seen.extend(_tasks(df).agg(F.max("n")).first()[0] * len(key_sets) for df in (left, right))
        return skew.meeting_counts(left, right, key_sets)

    monkeypatch.setattr(resolution, "meeting_counts", counted)
    people = spark.range(3000).selectExpr("id", "id % 1000 AS x", "if(id % 7 = 0, null, id DIV 2) AS y").coalesce(1)
    found = resolution.blocking_pairs(people, people, [["x"], ["y"]], same_table=True).select("a_id", "b_id", "pass_no")
    rows = [(r["id"], r["x"], r["y"]) for r in people.collect()]
    expected = {(i, j, 1) for i, x, _ in rows for j in range(i + 1000, 3000, 1000)}
    expected |= {(i, i + 1, 2) for i, _, y in rows if i % 2 == 0 and y is not None and (i + 1) % 7}
    assert sorted(map(tuple, found.collect())) == sorted(expected) and max(seen) < 250
