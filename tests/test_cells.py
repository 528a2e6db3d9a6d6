import random

import pytest

from knotwork.operators import cells
from knotwork.operators import similarity as M
from test_similarity import brute, frame


@pytest.fixture
def only_cells(monkeypatch):
    """Sets over few neighbours are compared in small cells; meeting at neighbours would be the square of every degree."""

    def refuse(*args, **kwargs):
        raise AssertionError("candidates were shuffled")

    monkeypatch.setattr(M, "_meet", refuse)
    monkeypatch.setattr(M, "DIRECT_BELOW", -1)
    monkeypatch.setattr(M, "CELLS_FROM", 0)
    monkeypatch.setattr(cells, "SETS_PER_BLOCK", 20)
    monkeypatch.setattr(cells, "PAIRS_AT_ONCE", 64)


def dense_sets(seed):
    rnd = random.Random(seed)
    sets = {i: set(rnd.sample(range(30), rnd.randint(8, 20))) for i in range(70)}
    return sets | {i: sets[i - 70] for i in range(70, 76)}


@pytest.mark.parametrize("metric,cutoff", [("jaccard", 0.45), ("jaccard", 0.0), ("overlap", 0.7), ("weighted_jaccard", 0.4), ("cosine", 0.5)])
def test_dense_sets_are_compared_in_cells(spark, only_cells, metric, cutoff):
    sets = dense_sets(4)
    got = {(r["node1"], r["node2"]): r["score"] for r in M.node_similarity(frame(spark, sets), metric, cutoff=cutoff).collect()}
    want = {k: v for k, v in brute(sets, metric).items() if v >= cutoff - 1e-12}
    assert got.keys() == want.keys() and len(got) > 100
    assert all(abs(got[k] - v) < 1e-9 for k, v in want.items())


@pytest.mark.parametrize("least", [1, 9])
def test_dense_shared_counts_with_text_ids_and_nulls(spark, only_cells, least):
    sets = dense_sets(8)
    rows = [(f"u{n}", f"n{x}") for n, s in sets.items() for x in s] + [("u1", None), ("u2", None), ("only null", None), (None, "n1")]
    pairs = spark.createDataFrame(rows, "node string, neighbor string")
    got = {(r["node1"], r["node2"]): r["shared"] for r in M.shared_neighbor_pairs(pairs, least).collect() if r["node1"] is not None}
    named = {f"u{n}": s for n, s in sets.items()}
    want = {(a, b): len(named[a] & named[b]) for a in named for b in named if a < b and len(named[a] & named[b]) >= least}
    assert got == want


def test_sparse_sets_still_meet_at_neighbours(spark, monkeypatch):
    monkeypatch.setattr(M, "DIRECT_BELOW", -1)
    monkeypatch.setattr(M, "CELLS_FROM", 0)
    monkeypatch.setattr(M, "PRODUCTS_PER_MEETING", 10)
    sets = M.neighbor_profiles(M._weigh(frame(spark, {i: {i + 1000, i // 2} for i in range(200)}), None), "jaccard")
    assert M._dense(sets, "jaccard", 0.2, 1) is None
