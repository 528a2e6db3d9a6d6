import random

from knotwork.operators import similarity as M


def test_best_existing_meets_once_for_cosine(spark, monkeypatch):
    """The prefix of cosine is the same on the smaller and the larger side."""
    chance, met = random.Random(25), []
    known = {f"k{i:02}": set(chance.sample(range(30), chance.randint(1, 6))) for i in range(40)}
    new = {f"n{i:02}": set(chance.sample(range(34), chance.randint(1, 6))) for i in range(25)}
    one, two = (spark.createDataFrame([(n, v) for n, vs in s.items() for v in vs], "node string, neighbor bigint") for s in (known, new))
    meet = M._meet
    monkeypatch.setattr(M, "_meet", lambda *a, **k: met.append(1) or meet(*a, **k))
    monkeypatch.setattr(M, "DIRECT_BELOW", 0)
    got = {r["node1"]: (r["node2"], round(r["score"], 9)) for r in M.best_existing(two, M.prepare_existing(one), 0.4).collect()}
    degree = {v: sum(v in s for s in known.values()) for v in range(34)}
    w = {v: M.math.log(len(known) / (degree[v] or 1)) for v in degree}
    norm = lambda s: sum(w[v] ** 2 for v in s) ** 0.5
    want = {}
    for n, s in new.items():
        scores = [(-round(sum(w[v] ** 2 for v in s & k) / (norm(s) * norm(k)), 9), name) for name, k in known.items() if norm(s) * norm(k)]
        best = min(scores)
        if -best[0] >= 0.4:
            want[n] = (best[1], -best[0])
    assert got == want and len(met) == 1
