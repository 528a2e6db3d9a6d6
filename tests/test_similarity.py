import math
import random
from collections import defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from knotwork.operators import clusters
from knotwork.operators import graph as G
from knotwork.operators import similarity as M
from knotwork.operators import skew

# The worked example of two customers.
A = ["123 Main St", "Apex Corp", "Visa Card", "john@email.com"]
B = ["123 Main St", "Apex Corp", "555-0199"]


def frame(spark, sets):
    rows = [(n, x) for n, s in sets.items() for x in s]
    kind = "string" if rows and isinstance(rows[0][1], str) else "bigint"
    return spark.createDataFrame(rows, f"node bigint, neighbor {kind}")


def brute(sets, metric):
    n = len(sets)
    deg = defaultdict(int)
    for s in sets.values():
        for x in s:
            deg[x] += 1
    w = {x: math.log(n / d) for x, d in deg.items()}
    out = {}
    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        both = x & y
        if not both:
            continue
        s = sum(w[t] for t in both)
        tot = [sum(w[t] for t in z) for z in (x, y)]
        norm = [math.sqrt(sum(w[t] ** 2 for t in z)) for z in (x, y)]
        whole = {
            "jaccard": (len(both), len(x | y)), "overlap": (len(both), min(len(x), len(y))),
            "weighted_jaccard": (s, tot[0] + tot[1] - s), "cosine": (sum(w[t] ** 2 for t in both), norm[0] * norm[1]),
        }[metric]
        out[a, b] = whole[0] / whole[1] if whole[1] else 0.0
    return out


def hub_graph(seed=5):
    """Small sets, one neighbour of nearly everybody, twins, and one node with many neighbours."""
    rnd = random.Random(seed)
    sets = {i: {rnd.randrange(40) for _ in range(rnd.randint(1, 6))} | ({99} if i % 5 else set()) for i in range(120)}
    for i in range(120, 135):
        sets[i] = {99}
    for i in range(135, 140):
        sets[i] = {1, 2, 3}
    sets[140] = set(range(40)) | {99}
    return sets


def test_worked_example(spark):
    pairs = frame(spark, {1: A, 2: B})
    assert [tuple(r) for r in M.node_similarity(pairs).collect()] == [(1, 2, 0.4)]
    assert round(M.node_similarity(pairs, "overlap").first()["score"], 6) == 0.666667
    assert M.node_similarity(pairs, cutoff=0.45).count() == 0
    assert M.node_similarity(pairs, cutoff=0.4).count() == 1


@pytest.mark.parametrize("metric,cutoff", [("jaccard", 0.45), ("overlap", 0.7), ("weighted_jaccard", 0.3), ("cosine", 0.5)])
@pytest.mark.parametrize("direct", [False, True])
def test_all_pairs_equal_brute_force(spark, monkeypatch, metric, cutoff, direct):
    monkeypatch.setattr(M, "DIRECT_BELOW", 1e9 if direct else -1)
    monkeypatch.setattr(M, "PAIRS_PER_TASK", 50.0)
    monkeypatch.setattr(M, "SET_CHUNK", 16)
    sets = hub_graph()
    got = {(r["node1"], r["node2"]): r["score"] for r in M.node_similarity(frame(spark, sets), metric, cutoff=cutoff).collect()}
    want = {k: v for k, v in brute(sets, metric).items() if v >= cutoff - 1e-12}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - v) < 1e-9 for k, v in want.items())


@pytest.mark.parametrize("k,cutoff", [(5, 0.45), (3, 0.2)])
def test_top_k_equals_brute_force(spark, monkeypatch, k, cutoff):
    monkeypatch.setattr(M, "DIRECT_BELOW", -1)
    sets = hub_graph(9)
    best = defaultdict(list)
    for (a, b), s in brute(sets, "jaccard").items():
        if s >= cutoff - 1e-12:
            best[a].append((-s, b))
            best[b].append((-s, a))
    want = {(n, b) for n, c in best.items() for _, b in sorted(c)[:k]}
    got = {(r["node1"], r["node2"]) for r in M.node_similarity(frame(spark, sets), cutoff=cutoff, top_k=k).collect()}
    assert got == want


@pytest.mark.parametrize("least", [1, 2, 3])
def test_shared_pairs(spark, monkeypatch, least):
    monkeypatch.setattr(M, "DIRECT_BELOW", -1)
    sets = hub_graph(3)
    want = {(a, b): len(sets[a] & sets[b]) for a, b in combinations(sets, 2) if len(sets[a] & sets[b]) >= least}
    got = {(r["node1"], r["node2"]): r["shared"] for r in M.shared_neighbor_pairs(frame(spark, sets), least).collect()}
    assert got == want


def test_copies_of_a_hub_stay_far_below_its_pairs(spark, monkeypatch):
    """600 nodes at one neighbour: 180,000 pairs in cells of 1,000 repeat each entry about 20 times, not 360."""
    monkeypatch.setattr(M, "PAIRS_PER_TASK", 1000.0)
    pairs = frame(spark, {i: {5} for i in range(600)})
    counts = spark.createDataFrame([(1, 600, 600)], "key_hash bigint, n_left bigint, n_right bigint")
    cuts = skew.grid(counts, pairs_per_fragment=1000.0).first()
    assert 600 * (cuts["cuts_left"] + cuts["cuts_right"]) < 600 * 50
    assert M.shared_neighbor_pairs(pairs).count() == 600 * 599 // 2


def test_super_node_is_no_candidate_source(spark, monkeypatch):
    """Everybody shares one neighbour; the prefix leaves that neighbour out for all but its own profile."""
    monkeypatch.setattr(M, "DIRECT_BELOW", -1)
    sets = M.neighbor_profiles(M._weigh(frame(spark, {i: {i + 1000, 5} for i in range(300)}), None), "jaccard")
    met = M._meet(sets.entries, sets.entries, "jaccard", 0.45, 1, F.struct("my", "y") < F.struct("mx", "x"))
    assert met.count() == 0


def test_weights_of_super_nodes(spark):
    pairs = frame(spark, {i: {1, 100 + i // 2} for i in range(10)})
    w = {r["neighbor"]: r["weight"] for r in M.idf_weights(pairs).collect()}
    assert w[1] == 0.0 and abs(w[100] - math.log(5)) < 1e-12
    assert {r["score"] for r in M.node_similarity(frame(spark, {1: {7}, 2: {7}}), "cosine").collect()} == {0.0}
    assert [tuple(r) for r in M.super_nodes(pairs, min_degree=3).collect()] == [(1, 10)]


def test_best_existing(spark):
    old = {i: {rnd for rnd in (i % 7, 10 + i % 5, 50 + i)} for i in range(60)}
    new = {1000 + i: {i % 7, 10 + i % 5, 50 + i} if i % 2 else {777 + i} for i in range(10)}
    ready = M.prepare_existing(frame(spark, old), "cosine")
    got = {r["node1"]: r["node2"] for r in M.best_existing(frame(spark, new), ready, 0.5).collect()}
    assert got == {1000 + i: i for i in range(10) if i % 2}


@pytest.mark.parametrize("metric", ["cosine", "jaccard"])
def test_a_stored_existing_side_gives_the_same(spark, tmp_path, metric):
    old = {i: {i % 7, 10 + i % 5, 50 + i, 200 + i // 2} for i in range(80)}
    new = {1000 + i: {i % 7, 10 + i % 5, 50 + i, 900 + i % 2} for i in range(12)}
    ready = M.prepare_existing(frame(spark, old), metric)
    stored = M.store_existing(ready, str(tmp_path / "existing"), rows_per_bucket=30)
    assert stored.stored.entries.buckets > 8
    plain, found = (sorted(map(tuple, M.best_existing(frame(spark, new), e, 0.3).collect())) for e in (ready, stored))
    assert found == plain and len(plain) == 12


def test_bytes_read_for_a_batch_do_not_grow_with_the_store(spark, tmp_path):
    def touched_bytes(people):
        pairs = spark.range(people * 4).select((F.col("id") % people).alias("node"), (F.col("id") * 7 % (people * 3)).alias("neighbor"))
        stored = M.store_existing(M.prepare_existing(pairs), str(tmp_path / str(people)), rows_per_bucket=1000).stored
        batch = spark.createDataFrame([(x,) for x in (21, 84, 700)], "neighbor bigint")
        files = stored.entries.touched(batch).select("_metadata.file_path", "_metadata.file_size").distinct().collect()
        plan = stored.entries.touched(batch)._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [bucket" in plan or "PartitionFilters: [isnotnull(bucket" in plan
        return sum(r["file_size"] for r in files), stored.entries.buckets

    (small, few), (large, many) = touched_bytes(10_000), touched_bytes(20_000)
    assert many > 1.8 * few and large < 1.3 * small


def test_added_links_give_the_clusters_of_a_full_run(spark, tmp_path):
    chance = random.Random(6)
    links = [(chance.randrange(n), chance.randrange(n)) for n in [200] * 60 + [300] * 110] + [(5, 5), (7, None)]
    table = lambda rows: spark.createDataFrame(rows, "a bigint, b bigint")
    start = clusters.entity_clusters(table(links[:60]), spark.range(0, 200).select("id"))
    store = clusters.ClusterStore(start, str(tmp_path / "clusters"), rows_per_bucket=10)
    for part in (links[60:100], links[100:140], [], links[140:]):
        store.add(table(part))
    group = {i: i for i in [*range(200), *(x for pair in links[60:] if None not in pair for x in pair)]}
    for _ in range(300):
        for a, b in links:
            if b is not None:
                group[a] = group[b] = min(group[a], group[b])
    assert {r["id"]: r["cluster"] for r in store.read().collect()} == group
    touched = store.stored.touched(spark.createDataFrame([(3,), (4,)], "id bigint"))
    assert touched.select("bucket").distinct().count() <= 2 and store.renames.count() <= 170


def test_neighbor_blocks_are_bounded(spark):
    pairs = frame(spark, {1: set(range(10_000)), 2: set(range(5_000, 10_100))})
    blocks = G.neighbor_sets(pairs)
    assert max(len(r["neighbors"]) for r in blocks.collect()) <= 4096
    assert {r["node"]: r["degree"] for r in blocks.collect()} == {1: 10_000, 2: 5_100}
    both = spark.createDataFrame([(1, 2)], "node1 bigint, node2 bigint")
    rows = G.neighbor_set_algebra(both, pairs).collect()
    assert sum(len(r["shared"]) for r in rows) == 5_000 and sum(len(r["all"]) for r in rows) == 10_100


def test_text_neighbours(spark):
    """The worked example, with its text neighbours, and text nodes."""
    pairs = frame(spark, {1: A, 2: B}).withColumn("node", F.concat(F.lit("n"), F.col("node").cast("string")))
    assert {r["node"]: (r["degree"], sorted(r["neighbors"])) for r in G.neighbor_sets(pairs).collect()} == {"n1": (4, sorted(A)), "n2": (3, sorted(B))}
    both = spark.createDataFrame([("n1", "n2")], "node1 string, node2 string")
    row = G.neighbor_set_algebra(both, pairs).first()
    assert row["shared"] == sorted(set(A) & set(B)) and row["all"] == sorted(set(A) | set(B))
    many = spark.range(20_000).select(F.lit("hub").alias("node"), F.concat(F.lit("x"), F.col("id").cast("string")).alias("neighbor"))
    sizes = [len(r["neighbors"]) for r in G.neighbor_sets(many).collect()]
    assert sum(sizes) == 20_000 and max(sizes) <= 4096
    edges = spark.createDataFrame([("a", "b"), ("a", "b"), ("a", "c")], "start_id string, end_id string")
    assert [(x["id"], x["n"]) for x in G.adjacency(edges).first()["neighbors"]] == [("b", 2), ("c", 1)]
    ready = M.prepare_existing(pairs, "jaccard")
    new = spark.createDataFrame([("q", x) for x in A], "node string, neighbor string")
    assert tuple(M.best_existing(new, ready, 0.45).first()) == ("q", "n1", 1.0)


def test_dangling_edges_come_once(spark):
    edges = spark.createDataFrame([(1, 9), (9, 1), (1, 2), (9, 8)], "start_id int, end_id int")
    vertices = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    assert sorted(tuple(r) for r in G.dangling_edges(edges, vertices).collect()) == [(1, 9), (9, 1), (9, 8)]


def union_find(pairs, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("shape", ["chain", "random", "star"])
def test_clusters(spark, shape):
    rnd = random.Random(1)
    links = {
        "chain": [(i, i + 1) for i in range(150)],
        "random": [(rnd.randrange(400), rnd.randrange(400)) for _ in range(300)],
        "star": [(0, i) for i in range(1, 300)],
    }[shape]
    nodes = sorted({x for p in links for x in p} | {10_000})
    got = clusters.entity_clusters(
        spark.createDataFrame(links, "a bigint, b bigint"), spark.createDataFrame([(n,) for n in nodes], "id bigint")
    )
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(nodes) and dict(rows) == union_find(links, nodes)


def test_unsettled_clusters_fail(spark):
    with pytest.raises(RuntimeError):
        clusters.entity_clusters(spark.createDataFrame([(i, i + 1) for i in range(50)], "a bigint, b bigint"), max_rounds=1)
