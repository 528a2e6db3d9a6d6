import itertools
import json

from knotwork.operators import ingest as I


def contains(props, pattern):
    return all(k in props and props[k] == v and type(props[k]) is type(v) for k, v in pattern.items())


def test_patterns_of_frequent_entries_do_not_multiply_candidates(spark, monkeypatch):
    """Each entry is frequent, only all of them together are rare; what the joins give is little more than the matches."""
    grid = list(itertools.product(range(8), range(8), range(8)))
    props = [{"a": a, "b": str(b), "c": c} for a, b, c in grid] + [{"a": a, "b": str(b), "x": 1} for a, b, _ in grid[::5]]
    rows = [("P", i, json.dumps(p)) for i, p in enumerate(props)] + [("P", 0, json.dumps(props[0])), ("P", None, json.dumps(props[9])), ("Q", 1, "{}")]
    asked = [{"a": a, "b": str(b), "c": c} for a, b, c in grid] + [{"a": 1, "x": 1}, {"b": 1}, {"a": 7, "none": 2}]
    patterns = [(f"p{i}", "P", json.dumps(p)) for i, p in enumerate(asked)] + [("p0", "P", json.dumps(asked[0])), ("all", "Q", "{}")]
    joined = []

    def counting(*args, **kwargs):
        out = join(*args, **kwargs)
        joined.append(out.count())
        return out

    join = I.fragment_join
    monkeypatch.setattr(I, "fragment_join", counting)
    found = I.merge_subset_match(
        spark.createDataFrame(rows, "label string, id bigint, props string"), spark.createDataFrame(patterns, "pattern_id string, label string, props string")
    )
    want = [(n, i) for n, label, p in patterns for other, i, v in rows if label == other and contains(json.loads(v), json.loads(p))]
    key = lambda r: (r[0], -1 if r[1] is None else r[1])
    assert sorted(map(tuple, found.collect()), key=key) == sorted(want, key=key)
    assert sum(joined) < 2 * len(want)
