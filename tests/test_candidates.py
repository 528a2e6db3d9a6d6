import random

import pytest

from knotwork.operators import resolution as E


@pytest.mark.parametrize("rows", [0, 2, 100])
def test_pairs_of_frequent_keys_are_not_shuffled(spark, monkeypatch, rows):
    """Candidates by blocks and links, with null and repeated ids and keys; no pair of a frequent key is grouped afterwards."""
    monkeypatch.setattr(E, "FREQUENT_KEY_ROWS", rows, raising=False)
    chance = random.Random(rows)

    def people(first):
        ids = [None, *range(first, first + 25)]
        blocks = [(i, chance.choice([None, "x", "y", f"z{chance.randrange(9)}"])) for i in [*ids, first]]
        links = [(chance.choice(ids), chance.choice([None, "hub", "big", *map(str, range(20))])) for _ in range(90)]
        return blocks, [*links, links[0]]

    (a, a_links), (b, b_links) = people(100), people(0)
    frames = [spark.createDataFrame(x, "id bigint, block string") for x in (a, b)]
    frames += [spark.createDataFrame(x, "node bigint, neighbor string") for x in (a_links, b_links)]
    found = E.applicant_candidates(frames[0], frames[1], [["block"]], frames[2], frames[3])
    want = {}
    for i, x in a:
        for j, y in b:
            if x is not None and x == y:
                want[i, j] = (1, 0)
    for i, x in set(a_links):
        for j, y in set(b_links):
            if x is not None and x == y:
                block, shared = want.get((i, j), (0, 0))
                want[i, j] = (block, shared + 1)
    got = [((r["a_id"], r["b_id"]), (r["same_block"], r["shared"])) for r in found.collect()]
    assert len(got) == len(want) and dict(got) == want
    assert "Aggregate" not in found._jdf.queryExecution().optimizedPlan().toString()
