import math
import random

import pytest
from pyspark.sql import functions as F

from knotwork.operators import customer
from knotwork.operators import resolution as E
from knotwork.operators import similarity as M
from knotwork.operators import skew
from knotwork.operators.skew import fragment_join
from knotwork.streaming.flows import file_feed, score_new_applications


def test_decisions(spark):
    p = spark.createDataFrame([(x,) for x in (0.95, 0.9, 0.5, 0.4, 0.39)], "probability double")
    assert [r["decision"] for r in E.match_decision(p).collect()] == ["match", "review", "review", "review", "new"]


def test_missing_fields_weigh_nothing(spark):
    pairs = spark.createDataFrame([("a", "a", "x", None), ("a", "b", None, None)], "a_f string, b_f string, a_g string, b_g string")
    params = {"f": (0.9, 0.1), "g": (0.8, 0.2)}
    w = [r["weight"] for r in E.match_weights(E.field_comparisons(pairs, {"f": None, "g": None}), params).collect()]
    assert abs(w[0] - math.log2(9)) < 1e-12 and abs(w[1] - math.log2(1 / 9)) < 1e-12


@pytest.mark.parametrize("limit,pairs", [(2, 2e7), (100_000, 2e7), (100_000, 3.0), (7, 5.0)])
def test_fragments_form_each_pair_once(spark, limit, pairs):
    left = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(90)], "id int, k string")
    right = spark.createDataFrame([(i, "hot" if i % 4 == 0 else f"k{i}") for i in range(40)], "rid int, k string")
    got = sorted((r["id"], r["rid"]) for r in fragment_join(left, right, ["k"], ["id"], ["rid"], limit, pairs).collect())
    want = sorted((r["id"], r["rid"]) for r in left.join(right, "k").collect())
    assert got == want


def test_cells_of_a_two_sided_hot_key_are_bounded(spark):
    counts = spark.createDataFrame([(1, 10**6, 10**6), (2, 10**9, 1), (3, 10, 10**7), (4, 5, 5)], "key_hash bigint, n_left bigint, n_right bigint")
    cuts = {r["key_hash"]: (r["cuts_left"], r["cuts_right"]) for r in skew.grid(counts).collect()}
    assert 4 not in cuts
    for key, left, right in ((1, 10**6, 10**6), (2, 10**9, 1), (3, 10, 10**7)):
        l, r = cuts[key]
        assert left / l <= skew.ROWS_PER_FRAGMENT and right / r <= skew.ROWS_PER_FRAGMENT and left / l * right / r <= skew.PAIRS_PER_FRAGMENT * 1.01
    assert 10**6 * sum(cuts[1]) < 5e8  # copies of both sides, not the cube of the degree
    ids = spark.range(2000).select("id", F.lit("hot").alias("k"))
    joined = fragment_join(ids, ids.withColumnRenamed("id", "rid"), ["k"], ["id"], ["rid"], 100_000, 10_000.0, many_pairs=True)
    sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in sizes) == 4_000_000 and len(sizes) > 20 and max(r["count"] for r in sizes) < 1_000_000


@pytest.mark.parametrize("limit", [1, 100_000])
def test_blocking_finds_each_pair_once(spark, monkeypatch, limit):
    monkeypatch.setattr(skew, "ROWS_PER_FRAGMENT", limit)
    schema = "id int, x string, y string"
    a = spark.createDataFrame([(1, "p", "q"), (2, "p", None), (3, None, "q")], schema)
    b = spark.createDataFrame([(10, "p", "q"), (11, "z", "q"), (12, None, None)], schema)
    rows = E.blocking_pairs(a, b, [["x"], ["y"]]).select("a_id", "b_id", "pass_no").collect()
    assert sorted(tuple(r) for r in rows) == [(1, 10, 1), (1, 11, 2), (2, 10, 1), (3, 10, 2), (3, 11, 2)]
    within = E.blocking_pairs(a, a, [["x"], ["y"]], same_table=True).select("a_id", "b_id").collect()
    assert sorted(tuple(r) for r in within) == [(1, 2), (1, 3)]


PARAMS = {"name": (0.9, 0.1), "zip": (0.8, 0.05), "phone": (0.95, 0.001), "mail": (0.9, 0.01)}


@pytest.mark.parametrize("floor", [0.05, 0.4, 0.9])
def test_likely_pairs_equal_full_comparison(spark, floor):
    rnd = random.Random(2)

    def value(n):
        return rnd.choice([None, *[str(i) for i in range(n)]])

    def table(first):
        rows = [(first + i, value(3), value(4), value(20), value(10)) for i in range(70)]
        return spark.createDataFrame(rows, "id int, name string, zip string, phone string, mail string")

    a, b = table(0), table(1000)
    got = {(r["a_id"], r["b_id"]) for r in E.likely_pairs(a, b, PARAMS, 0.01, floor).collect()}
    whole = a.select(*[F.col(c).alias(f"a_{c}") for c in a.columns]).crossJoin(b.select(*[F.col(c).alias(f"b_{c}") for c in b.columns]))
    scored = E.match_probability(E.match_weights(E.field_comparisons(whole, dict.fromkeys(PARAMS)), PARAMS), 0.01)
    want = {(r["a_id"], r["b_id"]) for r in scored.filter(F.col("probability") >= floor).collect()}
    assert want and got == want


def test_sufficient_keys_are_minimal():
    keys = E.sufficient_keys(PARAMS, 0.01, 0.4)
    assert ("phone",) in keys and all(not set(x) < set(y) for x in keys for y in keys)
    with pytest.raises(ValueError):
        E.sufficient_keys(PARAMS, 0.6, 0.4)


def test_link_and_privacy(spark, tmp_path):
    known = spark.createDataFrame([(1, "e:a"), (1, "p:1"), (2, "e:b"), (2, "p:2"), (3, "p:3")], "node bigint, neighbor string")
    feed = spark.createDataFrame([(100, ["e:a", "p:1"]), (101, ["e:new"])], "id bigint, links array<string>")
    path, out, state = (str(tmp_path / n) for n in ("feed", "out", "state"))
    feed.write.parquet(path)
    linked = score_new_applications(file_feed(spark, path, feed.schema), M.prepare_existing(known), 0.5, out, state)
    got = {r["applicant_id"]: (r["linked_id"], r["outcome"]) for r in linked.collect()}
    assert got == {100: (1, "linked"), 101: (None, "new")}
    assert E.private_result(linked).columns == ["applicant_id", "known", "score"]


def test_structure_and_name(spark):
    scores = spark.createDataFrame([(1, 2, 0.4), (1, 3, 0.9), (2, 3, 0.3)], "node1 bigint, node2 bigint, score double")
    names = spark.createDataFrame([(1, "John"), (2, "J."), (3, "Mary")], "node bigint, name string")
    from knotwork.functions.names import initial_match

    assert [(r["node1"], r["node2"]) for r in E.structural_plus_name(scores, names, initial_match).collect()] == [(1, 2)]


def test_merged_profile_takes_newest_value(spark):
    rows = spark.createDataFrame(
        [(1, "old", "p1", 1), (2, None, "p2", 5), (3, "tie", None, 1)], "id bigint, name string, phone string, seen int"
    )
    own = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "id bigint, cluster bigint")
    assert tuple(E.merged_profile(rows, own, ["name", "phone"], "seen").first()) == (1, 3, "old", "p2")
    text = rows.withColumn("id", F.concat(F.lit("k"), F.col("id").cast("string")))
    named = own.withColumn("id", F.concat(F.lit("k"), F.col("id").cast("string")))
    assert tuple(E.merged_profile(text, named, ["name", "phone"], "seen").first()) == (1, 3, "old", "p2")


def test_customer_views(spark):
    core = spark.createDataFrame([(1,), (2,)], "id int")
    orders = spark.createDataFrame([(1, 5.0), (1, 7.0)], "id int, amount double")
    rich = customer.enrich_customer(core, "id", {"orders": (orders, [F.sum("amount").alias("spent")])})
    assert sorted(tuple(r) for r in rich.collect()) == [(1, 12.0), (2, None)]
    calls = spark.sql("select 1 as user_id, timestamp'2024-01-01 09:00:00' as ts union all select 1, timestamp'2024-01-02 08:00:00'")
    assert tuple(customer.preferred_contact_hour(calls).first()) == (1, 8, 1)
    pairs = spark.createDataFrame([(1, 7), (2, 7), (3, 7), (4, 8), (1, 9), (2, 9)], "node bigint, neighbor bigint")
    flagged = spark.createDataFrame([(1,), (3,), (1,)], "node bigint")
    assert sorted(tuple(r) for r in customer.risk_connections(pairs, flagged).collect()) == [
        (1, 7, 1, 3), (2, 7, 2, 1), (2, 9, 1, 1), (3, 7, 1, 1)
    ]


def plain_paths(pairs, asked, flagged, hops):
    """Every simple walk, shortest first, then in order of its text."""
    of_node, of_neighbor, out = {}, {}, {}
    for node, neighbor in pairs:
        of_node.setdefault(node, set()).add(neighbor)
        of_neighbor.setdefault(neighbor, set()).add(node)
    for source in asked:
        front, seen = {source: []}, {source}
        for hop in range(1, hops + 1):
            after = {}
            for node, path in front.items():
                for via in of_node.get(node, ()):
                    for other in of_neighbor[via] - seen:
                        after[other] = min(after.get(other, ["~"]), [*path, via, str(other)])
            seen |= set(after)
            for node, path in after.items():
                if node in flagged:
                    out[source, node] = (hop, path[:-1])
            front = after
    return out


@pytest.mark.parametrize("hops", [1, 2, 3, 4])
def test_risk_paths_are_the_first_of_the_shortest(spark, hops):
    chance = random.Random(hops)
    pairs = [(chance.randrange(60), f"n{chance.randrange(45)}") for _ in range(110)] + [(i, "hub") for i in range(0, 60, 7)]
    asked, flagged = set(range(0, 60, 3)), set(range(0, 60, 4))
    ends = [spark.createDataFrame([(x,) for x in [*nodes, None]], "node bigint") for nodes in (asked, flagged)]
    frame = spark.createDataFrame([*pairs, pairs[0], (None, "hub"), (3, None)], "node bigint, neighbor string")
    found = {(r["node"], r["flagged"]): (r["hops"], r["path"]) for r in customer.risk_paths(frame, *ends, hops).collect()}
    assert found == plain_paths(pairs, asked, flagged, hops) and found


def test_risk_paths_over_a_hub(spark, monkeypatch):
    """3,000 customers at one address: a row per asked and flagged pair, cut into many cells."""
    monkeypatch.setattr(skew, "ROWS_PER_FRAGMENT", 500)
    pairs = spark.range(3000).select(F.col("id").alias("node"), F.lit("hub").alias("neighbor"))
    asked, flagged = (spark.range(a, b).select(F.col("id").alias("node")) for a, b in ((0, 20), (2990, 3000)))
    found = customer.risk_paths(pairs, asked, flagged, 2)
    assert found.count() == 200 and found.filter("hops <> 1 or path[0] <> 'hub' or size(path) <> 1").isEmpty()
