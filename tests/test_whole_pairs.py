"""Queries over pairs leave none out, and pairs that are formed in cells or need no twins are not moved again."""

import itertools
import json

import pytest

from knotwork.functions.names import initial_match
from knotwork.operators import cells
from knotwork.operators import graph as G
from knotwork.operators import resolution as E
from knotwork.operators import similarity as M
from knotwork.plans.catalog import QUERIES
from knotwork.plans.registry import Tables

SETS = {1: {1, 2, 3, 4}, 2: {4, 5, 6, 7}, 3: {1, 2, 3, 4}, 4: {8}, 5: {7, 8}}


def pairs_of(spark, sets):
    return spark.createDataFrame([(n, v) for n, vs in sets.items() for v in vs], "node bigint, neighbor bigint")


def together(sets):
    return {(a, b): len(sets[a] & sets[b]) for a, b in itertools.combinations(sorted(sets), 2) if sets[a] & sets[b]}


def test_jaccard_similarity_gives_low_scores_too(spark, tmp_path):
    rows = [(n, json.dumps({"k": v})) for n, vs in SETS.items() for v in vs]
    spark.createDataFrame(rows, "user_id bigint, props string").write.parquet(f"{tmp_path}/events.parquet")
    found = {(r["node1"], r["node2"]): r["score"] for r in QUERIES["jaccard_similarity"](Tables(spark, str(tmp_path))).collect()}
    assert found == {(a, b): round(n / len(SETS[a] | SETS[b]), 6) for (a, b), n in together(SETS).items()} and found[1, 2] < 0.2


def test_shared_neighbor_pairs_gives_pairs_of_one_part_too(spark, tmp_path):
    spark.createDataFrame([(n, n) for n in SETS], "o_orderkey bigint, o_custkey bigint").write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(n, v) for n, vs in SETS.items() for v in vs]
    spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint").write.parquet(f"{tmp_path}/lineitem.parquet")
    found = {(r["node1"], r["node2"]): r["shared"] for r in QUERIES["shared_neighbor_pairs"](Tables(spark, str(tmp_path))).collect()}
    assert found == together(SETS) and found[1, 2] == 1


def test_all_shared_pairs_move_an_array_per_entry(spark, monkeypatch):
    monkeypatch.setattr(M, "_meet", lambda *a, **k: pytest.fail("every pair that meets is a row of a shuffle"))
    named = {f"c{n}": vs for n, vs in SETS.items()}
    rows = [(n, v) for n, vs in named.items() for v in vs] + [(None, 8), ("c4", None)]
    found = M.shared_neighbor_pairs(spark.createDataFrame(rows, "node string, neighbor bigint")).collect()
    assert {(r["node1"], r["node2"]): r["shared"] for r in found} == together(named)


@pytest.mark.parametrize("metric", ["shared", "jaccard"])
def test_cells_give_pairs_of_nodes(spark, monkeypatch, metric):
    monkeypatch.setattr(M, "_expand_all", lambda *a, **k: pytest.fail("pairs from cells are joined again"))
    monkeypatch.setattr(M, "DIRECT_BELOW", -1)
    monkeypatch.setattr(M, "CELLS_FROM", 0)
    monkeypatch.setattr(cells, "SETS_PER_BLOCK", 2)
    frame = pairs_of(spark, SETS)
    found = M.shared_neighbor_pairs(frame) if metric == "shared" else M.node_similarity(frame)
    score = {k: n if metric == "shared" else n / len(SETS[k[0]] | SETS[k[1]]) for k, n in together(SETS).items()}
    assert {tuple(r)[:2]: tuple(r)[2] for r in found.collect()} == pytest.approx(score)


def test_without_twins_scores_are_not_joined(spark):
    alone = {n: vs for n, vs in SETS.items() if n != 3}
    sets = M.neighbor_profiles(M._weigh(pairs_of(spark, alone), None), "shared")
    scores = spark.createDataFrame([(2, 1, 1.0)], "x bigint, y bigint, score double")
    out = M._expand_all(scores, sets, "shared", 1.0)
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString() and [tuple(r) for r in out.collect()] == [(1, 2, 1.0)]


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_sets_of_one_list_need_no_search_for_other_lists(spark, kind):
    rows = [(n, str(v) if kind == "string" else v) for n, vs in SETS.items() for v in vs]
    asked = spark.createDataFrame([(1, 2), (4, 5), (1, 9), (9, 1), (9, 10), (1, 2)], "node1 bigint, node2 bigint")
    out = G.neighbor_set_algebra(asked, spark.createDataFrame(rows, f"node bigint, neighbor {kind}"))
    assert "LeftAnti" not in out._jdf.queryExecution().optimizedPlan().toString()
    known = {n: {str(v) if kind == "string" else v for v in vs} for n, vs in SETS.items()} | {9: set()}
    want = [(a, b, 0, sorted(known[a] & known[b]), sorted(known[a] | known[b])) for a, b in [(1, 2), (1, 9), (4, 5), (9, 1)]]
    assert sorted(tuple(r) for r in out.select("node1", "node2", "block", "shared", "all").collect()) == want


def test_many_names_are_reduced_to_scored_nodes(spark, monkeypatch):
    monkeypatch.setattr(E, "MANY_NAMES", 1, raising=False)
    kept, write = {}, E.written
    monkeypatch.setattr(E, "written", lambda df, name: kept.setdefault(name, []).append(write(df, name)) or kept[name][-1])
    names = spark.createDataFrame([(1, "Ann"), (2, "A."), (3, "Bob"), (4, "Cy"), (2, "Ann")], "node bigint, name string")
    scores = spark.createDataFrame([(1, 2, 0.9), (1, 3, 0.9)], "node1 bigint, node2 bigint, score double")
    found = E.structural_plus_name(scores, names, initial_match)
    assert sorted((r["node1"], r["node2"], r["name2"]) for r in found.collect()) == [(1, 2, "A."), (1, 2, "Ann")]
    assert {r["node"] for r in kept["names"][-1].collect()} == {1, 2, 3}
