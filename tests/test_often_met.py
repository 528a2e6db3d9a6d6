import itertools
import random

import pytest
from pyspark.sql import functions as F

from knotwork.operators import similarity as M


@pytest.mark.parametrize("code", [None, lambda: F.pmod(F.hash("profile"), F.lit(9)).cast("int")])
def test_pairs_that_meet_often_are_counted_without_moving_the_others(spark, monkeypatch, code):
    """Also where several sets have the same code; no row per pair that merely meets is joined."""
    chance = random.Random(24)
    sets = {i: set(chance.sample(range(200), chance.randint(1, 14))) for i in range(120)}
    sets[120], sets[121], sets[122] = sets[3], set(list(sets[5])[:-1]) | {999}, {7}
    rows = [(n, v) for n, vs in sets.items() for v in vs] + [(0, min(sets[0])), (None, 3), (5, None)]
    if code:
        monkeypatch.setattr(M, "_code", code)
    monkeypatch.setattr(M, "_meet", lambda *a, **k: pytest.fail("pairs that meet once are formed as rows"))
    found = M.shared_neighbor_pairs(spark.createDataFrame(rows, "node bigint, neighbor bigint"), 3).collect()
    want = [(a, b, n) for a, b in itertools.combinations(sorted(sets), 2) if (n := len(sets[a] & sets[b])) >= 3]
    assert sorted(map(tuple, found)) == want
