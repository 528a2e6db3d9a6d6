import datetime as dt
import json
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from knotwork.operators import graph as G
from knotwork.operators import ingest as I
from knotwork.operators.property_index import PropertyIndex
from knotwork.session import scratch_path, scratch_scope, written
from knotwork.sources import readers as S
from knotwork.sources import writers as W
from knotwork.streaming.flows import EdgeStore, file_feed, reingest_edges, reingest_vertices

WORDS = "amber basalt cobalt dune ember fjord glacier heath islet jetty kelp lagoon".split()


def counts(df):
    return {r["label"]: r["n"] for r in G.count_by_label(df).collect()}


def dispatches(seed=11, n=90):
    """Movements between ports: (ship, predicate, port or berth); names repeat across kinds, rows repeat."""
    chance = random.Random(seed)
    rows = []
    for _ in range(n):
        predicate = chance.choice(["CALLED_AT", "MOORED_AT", "PASSED"])
        rows.append((f"{chance.choice(WORDS)} {chance.randrange(4)}", predicate, chance.choice(WORDS), "Berth" if predicate == "MOORED_AT" else "Port"))
    return rows + chance.sample(rows, n // 5)


def test_name_triplets(spark):
    rows = dispatches()
    feed = spark.createDataFrame(rows, "subject string, predicate string, object string, o_label string")
    v, e = S.read_triplets3(feed, F.lit("Ship"), F.col("o_label"))
    named = {("Ship", s) for s, *_ in rows} | {(label, o) for *_, o, label in rows}
    assert counts(v) == Counter(label for label, _ in named) and counts(e) == Counter(p for _, p, *_ in rows)
    one_kind, _ = S.read_triplets3(feed, F.lit("Ship"), F.lit("Port"))
    assert counts(one_kind) == {"Ship": len({s for s, *_ in rows}), "Port": len({o for *_, o, _ in rows})}
    assert I.merge_vertices(v, v).count() == v.count()
    assert counts(e.unionByName(e)) == {p: 2 * n for p, n in counts(e).items()}


TRIPLET_SCHEMA = "s_label string, s_props string, predicate string, e_props string, o_label string, o_props string"


def cargo(seed=12, n=60):
    """Ships that load cargo: the same name under two registry numbers, typed values, repeated rows."""
    chance = random.Random(seed)
    ships = [{"id": i, "name": WORDS[i % 5], "ice_class": chance.random() < 0.5} for i in range(8)]
    goods = [{"id": f"{w[:2]}{i}", "tons": chance.choice([1, 1.5, "1"])} for i, w in enumerate(WORDS)]
    rows = []
    for _ in range(n):
        e = chance.choice([{}, {"holds": chance.randrange(3)}, {"sealed": True, "at": "2024-03-0" + str(chance.randrange(1, 9))}])
        rows.append(("Ship", chance.choice(ships), chance.choice(["LOADED", "SHED"]), e, "Cargo", chance.choice(goods)))
    return rows + rows[:7]


def triplet_frame(spark, rows):
    return spark.createDataFrame([tuple(json.dumps(x) if isinstance(x, dict) else x for x in r) for r in rows], TRIPLET_SCHEMA)


def canonical(props):
    return json.dumps(props, sort_keys=True, separators=(",", ":"))


def test_property_triplets(spark):
    rows = cargo()
    v, e = S.read_triplets6(triplet_frame(spark, rows))
    assert counts(v) == Counter(label for label, _ in {(r[i], canonical(r[i + 1])) for r in rows for i in (0, 4)})
    assert Counter((r["label"], r["props"]) for r in e.collect()) == Counter((r[2], canonical(r[3])) for r in rows)
    v5, e5 = S.read_triplets5(triplet_frame(spark, rows).drop("e_props"))
    assert v5.count() == v.count() and e5.count() == len(rows)
    assert I.create_edges(v, e)[1].count() == 0


def test_documents(spark, tmp_path):
    """Berths with the ids of cranes, a crane given twice, links by outer and by inner id, and three that lead nowhere."""
    cranes = [{"label": "Crane", "external_id": f"#{i % 4}", "properties": {"reach": 10 + i}} for i in range(5)]
    berths = [{"label": "Berth", "external_id": f"#{i}", "properties": {}} for i in range(2, 6)]
    ends = [
        ("SERVES", "#0", "Crane", "#3", "Berth", "accepted"), ("SERVES", 104, "Crane", 106, "Berth", "accepted"),
        ("NEXT_TO", "#5", None, "#4", None, "accepted"), ("SERVES", "#1", "Crane", "#9", "Berth", "end unresolved"),
        ("SERVES", "#1", "Crane", "#2", None, "end ambiguous"), ("SERVES", "#7", "Crane", "#2", "Berth", "start unresolved"),
    ]
    links = [
        {k: x for k, x in zip(("label", "start_vertex_id", "start_vertex_label", "end_vertex_id", "end_vertex_label"), r) if x is not None} | {"properties": {}}
        for r in ends
    ]
    path = tmp_path / "quay.json"
    path.write_text(json.dumps({"vertices": cranes + berths, "edges": links}, indent=1))
    v, e = S.read_graph_document(spark, str(path))
    resolved, rejected = I.resolve_endpoints(e, I.last_wins_ids(v.withColumn("id", F.col("pos") + 100)))
    found = sorted((r["label"], r["start_id"], r["end_id"]) for r in resolved.collect())
    assert found == [("NEXT_TO", 108, 107), ("SERVES", 104, 106), ("SERVES", 104, 106)]  # the later crane has the id
    assert {r["outcome"]: r["n"] for r in I.ingest_report(resolved, rejected).collect()} == Counter(r[-1] for r in ends)


def test_csv_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,age,city\n001,30,Rome\n,31,\n")
    (tmp_path / "b.csv").write_text("name\nX\n")
    (tmp_path / "e.csv").write_text("start_id,end_id,since\n1,2,2020\n")
    v = S.read_vertex_csv(spark, {"A": str(tmp_path / "a.csv"), "B": str(tmp_path / "b.csv")}, infer_types=True)
    rows = sorted((r["label"], r["external_id"] or "", r["props"]) for r in v.collect())
    assert rows == [("A", "", '{"age":31}'), ("A", "001", '{"age":30,"city":"Rome"}'), ("B", "", '{"name":"X"}')]
    e = S.read_edge_csv(spark, {"E": str(tmp_path / "e.csv")}).first()
    assert (e["start_ref"], e["end_ref"], e["start_label"], e["props"]) == ("1", "2", None, '{"since":"2020"}')
    table = S.read_table_csv(spark, str(tmp_path / "e.csv"))
    assert dict(table.dtypes)["since"] == "int"


def contains(whole, part):
    return all(k in whole and type(whole[k]) is type(v) and whole[k] == v for k, v in part.items())


def test_merge_by_containment(spark):
    """Whole, partial, empty and unmatched patterns bind what plain Python finds; a second load creates nothing."""
    chance = random.Random(13)
    stored = [(label, {"no": i, "kind": WORDS[i % 3], "deep": i % 2 == 0}) for i, label in enumerate(chance.choices(["Dock", "Lock", "Canal"], k=24))]
    patterns = [{"kind": WORDS[0]}, {"kind": WORDS[1], "deep": True}, {"no": 5}, {"no": "5"}, {"kind": "none"}, {}]
    rows = []
    for _ in range(25):
        a, b = chance.choices(["Dock", "Lock", "Canal"], k=2)
        rows.append((a, chance.choice(patterns), chance.choice(["FEEDS", "DRAINS"]), {"gate": chance.randrange(2)}, b, chance.choice(patterns)))
    frame = spark.createDataFrame([(label, canonical(p), f"v{i}") for i, (label, p) in enumerate(stored)], "label string, props string, id string")
    bound = {
        (label, canonical(p)): [f"v{i}" for i, (other, whole) in enumerate(stored) if other == label and contains(whole, p)]
        for r in rows for label, p in (r[:2], r[4:])
    }
    created = [k for k, ids in bound.items() if not ids]
    expected = Counter(
        (r[2], len(bound[r[0], canonical(r[1])]) > 0, len(bound[r[4], canonical(r[5])]) > 0)
        for r in rows for _ in range(max(1, len(bound[r[0], canonical(r[1])])) * max(1, len(bound[r[4], canonical(r[5])])))
    )
    grown, edges = I.merge_triplets(frame, triplet_frame(spark, rows))
    assert grown.count() == len(stored) + len(created)
    found = [(r["label"], r["start_id"].startswith("v"), r["end_id"].startswith("v")) for r in edges.collect()]
    assert Counter(found) == expected
    twice, more = I.merge_triplets(grown, triplet_frame(spark, rows))
    assert twice.count() == grown.count() and more.count() >= len(found)


def test_typed_values_do_not_match_text(spark):
    v = spark.createDataFrame([("T", '{"n":1}', 1), ("T", '{"n":"1"}', 2)], "label string, props string, id int")
    p = spark.createDataFrame([("p", "T", '{"n":1}'), ("q", "T", '{"n":1,"m":2}')], "pattern_id string, label string, props string")
    assert [tuple(r) for r in I.merge_subset_match(v, p).collect()] == [("p", 1)]


def test_edges_keep_multiplicity_and_reject_dangling(spark):
    v = spark.createDataFrame([("T", 0), ("T", 1)], "label string, id bigint")
    e = spark.createDataFrame([("E", 0, 1), ("E", 0, 1), ("E", 0, 9), ("E", 8, 9)], "label string, start_id bigint, end_id bigint")
    ok, bad = I.create_edges(v, e)
    assert ok.count() == 2
    assert sorted(r["reason"] for r in bad.collect()) == ["end missing", "start missing"]
    assert G.dangling_edges(e, v).count() == 2


def test_split_elements(spark):
    feed = spark.createDataFrame([("A", None), ("A", "E"), ("B", None)], "label string, edge_label string")
    v, e = S.split_elements(feed)
    assert (v.count(), e.count()) == (2, 1)


def test_bulk_ingest(spark):
    v = spark.createDataFrame(
        [("P", "a", '{"n":1}', 0), ("P", "a", '{"n":2}', 1), ("C", "k", "{}", 2), ("C", None, '{"x":1}', 3)],
        "label string, external_id string, props string, pos bigint",
    )
    e = spark.createDataFrame([("E", "P", "a", "C", "k", "{}"), ("E", "P", "a", "C", "k", "{}"), ("E", "P", "zz", "C", "k", "{}")],
                              "label string, start_label string, start_ref string, end_label string, end_ref string, props string")
    done = I.bulk_ingest(v, e, as_of=dt.date(2026, 1, 2))
    ids = {(r["label"], r["props"]): r["id"] for r in done.vertices.collect()}
    assert len(set(ids.values())) == 4 and {str(r["created_at"]) for r in done.vertices.collect()} == {"2026-01-02"}
    assert {(r["start_id"], r["end_id"]) for r in done.edges.collect()} == {(ids["P", '{"n":2}'], ids["C", "{}"])} and done.edges.count() == 2
    assert {r["outcome"]: r["n"] for r in done.report.collect()} == {"accepted": 2, "start unresolved": 1}
    assert sorted(map(tuple, I.bulk_ingest(v, e).vertices.select("id").collect())) == sorted(map(tuple, done.vertices.select("id").collect()))


def test_an_external_id_given_twice_needs_a_position(spark):
    e = spark.createDataFrame([("E", "P", "a", "P", "a", "{}")], "label string, start_label string, start_ref string, end_label string, end_ref string, props string")
    v = spark.createDataFrame([("P", "a", '{"n":1}'), ("P", "a", '{"n":2}'), ("C", "a", "{}"), ("P", None, "{}")], "label string, external_id string, props string")
    with pytest.raises(ValueError, match="external id a"):
        I.bulk_ingest(v, e)
    assert I.bulk_ingest(v.filter("props <> '{\"n\":1}'"), e).edges.count() == 1


def test_stored_intermediates_go_with_their_scope(spark):
    before = scratch_path(spark, "kept")
    spark.range(3).write.parquet(before)
    with scratch_scope(spark):
        outer = written(spark.range(5), "outer")
        with scratch_scope(spark):
            inner = written(outer.filter("id > 1"), "inner")
            assert inner.count() == 3
        assert outer.count() == 5
        paths = outer.inputFiles() + inner.inputFiles()
    assert paths and not any(os.path.exists(p.removeprefix("file://")) for p in paths)
    assert spark.read.parquet(before).count() == 3


def test_creation_stamp_on_insert_only(spark):
    old = spark.createDataFrame([("T", '{"a":1}', dt.date(2020, 1, 1))], "label string, props string, created_at date")
    new = spark.createDataFrame([("T", '{"a":1}'), ("T", '{"a":2}')], "label string, props string")
    merged = I.merge_vertices(old, new, as_of=dt.date(2026, 1, 2))
    assert {r["props"]: str(r["created_at"]) for r in merged.collect()} == {'{"a":1}': "2020-01-01", '{"a":2}': "2026-01-02"}


def test_look_up_through_the_stored_index(spark, tmp_path):
    v = spark.createDataFrame(
        [("T", i, json.dumps({"c": f"v{i % 5}", "n": i % 3})) for i in range(60)] + [("U", 99, '{"c":"v1","n":1}')], "label string, id bigint, props string"
    )
    path = str(tmp_path / "index")
    W.write_property_index(I.property_index(v), path)
    index = spark.read.parquet(path)
    plain, found = G.match_props(v, "T", c="v1", n=1), G.match_props(v, "T", index, c="v1", n=1)
    assert sorted(r["id"] for r in found.collect()) == sorted(r["id"] for r in plain.collect()) == [1, 16, 31, 46]
    assert [r["id"] for r in G.search_property(v, "T", "c", "v2", 3, index).collect()] == [2, 7, 12]
    plan = G.indexed_ids(index, "T", {"c": "v1"})._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(label" in plan and "EqualTo(value_text,v1)" in plan and "EqualTo(key,c)" in plan


def test_reingest_adds_nothing(spark, tmp_path):
    feed = spark.createDataFrame([("T", '{"a":1}'), ("T", '{"a":1}'), ("T", '{"a":2}')], "label string, props string")
    path, store, state = (str(tmp_path / n) for n in ("feed", "store", "state"))
    for _ in range(2):
        feed.write.mode("append").parquet(path)
        out = reingest_vertices(file_feed(spark, path, feed.schema), store, state)
        assert out.count() == 2


def edge_feed(spark, feed_id, pairs):
    rows = [(feed_id, i, "E", a, b) for i, (a, b) in enumerate(pairs)]
    return spark.createDataFrame(rows, "feed_id string, row_no bigint, label string, start_id bigint, end_id bigint")


def test_edge_feeds_are_loaded_exactly_once(spark, tmp_path):
    path, store = str(tmp_path / "feed"), str(tmp_path / "store")
    first = edge_feed(spark, "a", [(i % 5, i % 3) for i in range(40)])
    first.write.parquet(path)
    assert reingest_edges(file_feed(spark, path, first.schema, 1), store, str(tmp_path / "s1")).count() == 40
    first.filter("row_no < 25").write.mode("append").parquet(path)  # part of it again
    edge_feed(spark, "b", [(1, 2), (1, 2), (0, 0)]).write.mode("append").parquet(path)  # a new feed with repeats
    got = reingest_edges(file_feed(spark, path, first.schema, 1), store, str(tmp_path / "s1"))
    assert got.count() == 43 and got.columns == ["label", "start_id", "end_id"]
    assert got.filter("start_id = 1 and end_id = 2").count() == 2 + sum(i % 5 == 1 and i % 3 == 2 for i in range(40))
    again = reingest_edges(file_feed(spark, path, first.schema), store, str(tmp_path / "s2"))  # everything by another stream
    assert again.count() == 43
    assert {r["feed_id"]: r["n"] for r in EdgeStore(spark, store, first.schema).ledger().groupBy("feed_id").agg(F.sum("rows").alias("n")).collect()} == {"a": 40, "b": 3}


def test_a_batch_that_fails_half_way_is_not_seen_and_replaced(spark, tmp_path, monkeypatch):
    store, feed = EdgeStore(spark, str(tmp_path / "store"), edge_feed(spark, "a", [(0, 0)]).schema), edge_feed(spark, "a", [(i, i) for i in range(10)])
    whole = EdgeStore._enter

    def failing(*args):
        raise OSError("lost")

    monkeypatch.setattr(EdgeStore, "_enter", failing)
    with pytest.raises(OSError):
        store.load(feed, "x-0")
    assert store.edges().count() == 0
    monkeypatch.setattr(EdgeStore, "_enter", whole)
    store.load(feed, "y-0")  # another stream brings the feed before the first one is repeated
    assert store.edges().count() == 10
    store.load(feed, "x-0")
    assert store.edges().count() == 10


def test_only_the_buckets_of_known_feeds_are_read(spark, tmp_path):
    store = EdgeStore(spark, str(tmp_path / "store"), edge_feed(spark, "a", [(0, 0)]).schema)
    for n, name in enumerate("abcdefgh"):
        store.load(edge_feed(spark, name, [(i, n) for i in range(5)]), f"x-{n}")
    read = store.known_rows(edge_feed(spark, "c", [(0, 0)]), "x-9").collect()
    assert len(read) == 5
    plan = store.known_rows(edge_feed(spark, "c", [(0, 0)]), "x-9")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket#" in plan
    assert store.known_rows(edge_feed(spark, "new", [(0, 0)]), "x-9").count() == 0


def test_index_kept_up_to_date_equals_a_rebuild(spark, tmp_path):
    chance, index, stored = random.Random(14), PropertyIndex(spark, str(tmp_path / "index")), []
    for load in range(10):
        rows = [("T" if chance.random() < 0.7 else "U", 100 * load + i, canonical({k: chance.randrange(3) for k in chance.sample("abcd", chance.randrange(4))})) for i in range(12)]
        created = index.merge(spark.createDataFrame(rows, "label string, id bigint, props string")).collect()
        for label, i, props in sorted(rows, key=lambda r: r[1]):
            fresh = not any(o == label and contains(json.loads(w), json.loads(props)) for o, _, w in stored if _ < 100 * load)
            if fresh and not any(o == label and w == props for o, _, w in stored):
                stored.append((label, i, props))
        assert {(r["label"], r["props"]) for r in created} <= {(o, w) for o, _, w in stored}
        if load == 6:
            index.compact()
            assert len(index.table.entry()["writes"]) == 1
    frame = spark.createDataFrame(stored, "label string, id bigint, props string")
    as_rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert as_rows(index.read()) == as_rows(PropertyIndex.entries_of(frame).select(*index.read().columns))
    patterns = [(f"p{i}", chance.choice("TU"), canonical({k: chance.choice([0, 1, 2, "1", 9]) for k in chance.sample("abcd", chance.randrange(4))})) for i in range(30)]
    want = sorted((p, i) for p, label, props in patterns for o, i, w in stored if o == label and contains(json.loads(w), json.loads(props)))
    found = index.match(spark.createDataFrame(patterns, "pattern_id string, label string, props string"))
    assert sorted(map(tuple, found.collect())) == want
    assert "props" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["props", "name"])
def test_batch_duplicates(spark, key):
    rows = spark.createDataFrame([("T", "x", 2), ("T", "x", 1), ("T", "y", 3)], f"label string, {key} string, n int")
    assert sorted(tuple(r) for r in I.distinct_vertices(rows, key).collect()) == [("T", "x", 1), ("T", "y", 3)]
