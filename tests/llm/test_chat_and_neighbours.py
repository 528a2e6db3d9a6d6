"""Role repair against a search over all repairs; nearest neighbours against comparing all."""

import itertools
import random

import numpy as np
import pytest

from knotwork.llm import chat, neighbours
from knotwork.session import scratch_path
from pyspark.sql import functions as F

SCHEMA = "conv_id bigint, turn bigint, role string, text string, place int, segment string, cost int"


def cheapest(roles):
    """Dijkstra over (turns taken, state) with single merges, empty turns and relabels."""
    best = {(0, chat.START): 0}
    todo = [(0, 0, chat.START)]
    while todo:
        cost, i, state = todo.pop(todo.index(min(todo)))
        if i == len(roles) and (state in chat.FINAL or not roles):
            return cost
        moves = [(cost + chat.INSERT, i, n) for n in chat.NEXT[state]]
        if i < len(roles):
            for label in (chat.SYSTEM, chat.USER, chat.ASSISTANT):
                own = roles[i] in chat.ROLES and chat.ROLES.index(roles[i]) + 1 == label
                price = cost + (0 if own else chat.RELABEL)
                if label in chat.NEXT[state]:
                    moves.append((price, i + 1, label))
                if label == state:
                    moves.append((price + chat.MERGE, i + 1, label))
        for move in moves:
            if move[0] < best.get(move[1:], 10**9):
                best[move[1:]] = move[0]
                todo.append(move)
    raise AssertionError


def legal(rendered):
    roles = [part.split("|>")[0] for part in rendered.split("<|") if not part.startswith("end")][1:]
    if roles[:1] == ["system"]:
        roles = roles[1:]
    return len(roles) % 2 == 0 and roles == ["user", "assistant"] * (len(roles) // 2)


def conversations():
    chance = random.Random(4)
    out = [list(r) for n in range(1, 4) for r in itertools.product(["system", "user", "assistant", None], repeat=n)]
    return out + [[chance.choice(["user", "assistant", "system", "tool", " User "]) for _ in range(chance.randint(4, 30))] for _ in range(40)]


@pytest.mark.parametrize("segment", [16_384, 3])
def test_repairs_are_legal_and_cheapest(spark, monkeypatch, segment):
    monkeypatch.setattr(chat, "SEGMENT", segment)
    talks = conversations()
    rows = [(c, t, r, f"{c}-{t}", 0, "x", 1) for c, roles in enumerate(talks) for t, r in enumerate(roles)]
    got = chat.repair(spark.createDataFrame(rows, SCHEMA).repartition(4)).toPandas().sort_values("place")
    assert len(got) == len(rows)
    for c, part in got.groupby("conv_id"):
        roles = [(r or "").strip().lower() for r in talks[int(c)]]
        text = "".join(part.rendered)
        assert legal(text) and part.cost.nunique() == 1
        assert part.cost.iloc[0] == cheapest(roles), roles
        changed = [chat.RELABEL * (a != b) for a, b in zip(roles, part.new_role)]
        assert part.cost.iloc[0] == sum(changed) + chat.INSERT * part.inserted.sum() + chat.MERGE * part.merged.sum()
        assert [f"{int(c)}-{t}" in text for t in range(len(roles))] == [True] * len(roles)


def test_odd_conversations(spark):
    rows = [
        (None, 0, "user", None), (None, 1, "assistant", ""), (1, None, "user", "a"), (1, 2, "user", "b"), (1, 2, "user", "b"),
        (2, 0, "assistant", "x" * 200_000),
    ]
    got = chat.repair(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).toPandas().sort_values("place")
    assert len(got) == 6 and set(got[got.conv_id == 1].cost) == {2 * chat.MERGE + chat.INSERT}
    assert set(got[got.conv_id == 2].inserted) == {1} and set(got[got.conv_id.isna()].cost) == {0}
    assert chat.repair(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).count() == 0


VECTORS = "vec_id bigint, embedding array<double>, label int, node int, vec string, norm int, query int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, 1, "a", 2, 3) for i, v in rows], VECTORS)


def brute(rows, is_query, answers=5):
    good = {i: np.array(v, float) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in filter(is_query, good):
        scores = [(-float(good[q] @ v / np.sqrt((good[q] @ good[q]) * (v @ v))), i) for i, v in good.items() if i != q]
        out[q] = [(i, -s) for s, i in sorted((round(s, 12), i) for s, i in scores)[:answers]]
    return out


def test_neighbours_on_odd_and_repeated_vectors(spark):
    chance = np.random.default_rng(1)
    rows = [(i, chance.standard_normal(8).tolist()) for i in range(60)]
    rows += [(100 + i, rows[3][1]) for i in range(12)] + [(150, [0.0] * 8), (151, None), (152, [1.0, None] * 4), (153, [float("nan")] * 8)]
    rows += [(154, [float("inf")] * 8), (155, []), (None, rows[0][1]), (156, [1.0, 2.0]), rows[5]]
    got = neighbours.nearest(vectors(spark, rows), F.col("vec_id") % 10 == 0).collect()
    want = brute([r for r in rows if r[0] != 156], lambda i: i % 10 == 0)
    assert {r.query_id for r in got} == set(want)
    for q, answers in want.items():
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [m[1] for m in mine] == [i for i, _ in answers] and [m[0] for m in mine] == [1, 2, 3, 4, 5]
        assert [m[2] for m in mine] == pytest.approx([s for _, s in answers])


def test_few_and_no_vectors(spark):
    got = neighbours.nearest(vectors(spark, [(0, [1, 0]), (1, [1, 1]), (2, [0, 2])]), F.col("vec_id") == 0).collect()
    assert [(r.rank, r.vec_id) for r in sorted(got, key=lambda r: r.rank)] == [(1, 1), (2, 2)]
    assert neighbours.nearest(vectors(spark, []), F.col("vec_id") == 0).count() == 0
    assert neighbours.nearest(vectors(spark, [(0, [1, 0])]), F.col("vec_id") == 0).count() == 0


def test_recall_on_clustered_vectors(spark):
    chance = np.random.default_rng(2)
    centres = chance.standard_normal((6, 32))
    x = centres[chance.integers(0, 6, 3000)] * 0.3 + chance.standard_normal((3000, 32))
    path = scratch_path(spark, "test-vectors")
    vectors(spark, [(i, v.tolist()) for i, v in enumerate(x)]).write.parquet(path)
    got = neighbours.nearest(spark.read.parquet(path), F.col("vec_id") % 50 == 0).toPandas()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 3000, 50):
        sims = unit @ unit[q]
        sims[q] = -2
        hits += len(set(np.argsort(-sims)[:5]) & set(got[got.query_id == q].vec_id))
    assert hits / (60 * 5) >= 0.9


def test_search_starts_at_a_query_s_own_neighbours_on_both_ends(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "ENTRIES", 1)
    units = {i: [1.0, i / 100] for i in range(5)}
    nodes = spark.createDataFrame([(i, v, b"") for i, v in units.items()], "node bigint, unit array<float>, half binary")
    first = nodes.orderBy(F.xxhash64("node"), "node").first()["node"]
    q, ahead, back, further = (i for i in units if i != first)
    graph = spark.createDataFrame([(q, ahead), (back, q), (further, back)], "node bigint, neighbour bigint")
    index = neighbours.Index(nodes, nodes, graph, 2, 1)
    found = neighbours.search(index, nodes.filter(F.col("node") == q).select(F.col("node").alias("query"), "unit")).collect()
    assert sorted(r.node for r in found) == list(units)


def test_graph_is_built_until_few_edges_are_new(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "RUN", 8)
    x = np.random.default_rng(3).standard_normal((1500, 12))
    path = scratch_path(spark, "test-vectors")
    vectors(spark, [(i, v.tolist()) for i, v in enumerate(x)]).write.parquet(path)
    index = neighbours.build(neighbours.usable(spark.read.parquet(path)))
    assert index.graph.filter("fresh").count() <= 0.001 * index.graph.count()
