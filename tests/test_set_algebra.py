import random

import pytest

from knotwork.operators import graph as G


@pytest.mark.parametrize("kind", ["bigint", "string"])
@pytest.mark.parametrize("bits", [3, 12])
def test_set_algebra_moves_lists_and_equals_entries(spark, monkeypatch, kind, bits):
    """Sets that fit one list are compared without a row per entry; nulls, absent nodes and several blocks give the same rows."""
    rnd = random.Random(bits)
    sets = {i: set(rnd.sample(range(40), rnd.randint(1, 4 if i % 2 else 20))) for i in range(12)}
    name = (lambda x: x) if kind == "bigint" else (lambda x: f"n{x:03d}")
    rows = [(n, name(x)) for n, s in sets.items() for x in s] + [(1, None), (2, None), (3, None), (50, None), (51, None)]
    known = spark.createDataFrame(rows, f"node bigint, neighbor {kind}")
    wanted = [(a, b) for a in range(12) for b in range(12) if a != b] + [(50, 51), (50, 1), (1, 50), (1, 99), (99, 1), (1, 2), (None, 1)]
    asked = spark.createDataFrame(wanted, "node1 bigint, node2 bigint")

    def rows_of(df):
        return sorted(((r["node1"], r["node2"], r["block"], r["shared"], r["all"]) for r in df.collect()), key=repr)

    want = rows_of(G._entry_algebra(asked.distinct(), known.distinct(), bits))
    if kind == "bigint" or bits == 12:

        def refuse(*args):
            raise AssertionError("a row per pair and entry")

        monkeypatch.setattr(G, "_entry_algebra", refuse)
    assert rows_of(G.neighbor_set_algebra(asked, known, bits)) == want and len(want) > 100
