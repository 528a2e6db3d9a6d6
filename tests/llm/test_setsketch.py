"""SetSketch registers and near-duplicates against plain versions, and on odd rows."""

import random
from itertools import combinations

import numpy as np
import pytest

from knotwork.llm import setsketch
from knotwork.llm.setsketch import SetSketch

SCHEMA = "doc_id bigint, text string, key string, n int, registers string, bucket int, band int, cluster int, kept string, component_id int, elements int"


def table(spark, texts, ids=None):
    return spark.createDataFrame([(i, t, "k", 1, "r", 2, 3, 4, "x", 5, 6) for i, t in zip(ids or range(len(texts)), texts)], SCHEMA)


def plain_sets(texts, words):
    out = []
    for t in texts:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").replace("\x0b", " ").replace("\x0c", " ")
        w = [x for x in w.replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if x]
        out.append({" ".join(w[i : i + words]) for i in range(len(w) - words + 1)} or ({" ".join(w)} if w else set()))
    return out


def plain(texts, ids, words, percent):
    sets = plain_sets(texts, words)
    group = list(range(len(texts)))
    for a, b in combinations(range(len(texts)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            old, new = group[b], group[a]
            group = [new if g == old else g for g in group]
    least = {}
    for g, i in zip(group, ids):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    return [(i, len(s), least.get(g), i is not None and i == least.get(g)) for i, s, g in zip(ids, sets, group)]


def edited(chance, words, changes, tag):
    copy = list(words)
    for place in chance.sample(range(len(copy)), changes):
        copy[place] = f"{tag}x{place}"
    return " ".join(copy)


def same(found, wanted):
    assert sorted(map(tuple, found), key=repr) == sorted(wanted, key=repr)


def test_odd_rows(spark):
    long = " ".join(f"w{i % 7001}v{i % 13}" for i in range(60_000))
    texts = [None, "", " \t\n", "One two", "one TWO", "one\x0btwo\x0c", "a b c", "A b c", "é É", "é é", "É É", long, long + " end", "\x00 x y", "a b c", "ab c", None]
    ids = [4, 5, 6, 7, None, 3, 9, 9, 10, 11, 12, 13, None, 15, None, 16, None]
    found = setsketch.near_duplicates(table(spark, texts, ids).repartition(3), words=3, similarity=0.85).collect()
    same(found, plain(texts, ids, 3, 85))
    assert setsketch.near_duplicates(table(spark, texts).limit(0)).isEmpty()


@pytest.mark.parametrize("cell,rounds", [(1024, 2), (5, 0)])
def test_groups_of_edited_copies_are_those_of_all_pairs(spark, monkeypatch, cell, rounds):
    chance, texts = random.Random(8), []
    monkeypatch.setattr(setsketch, "CELL_SETS", cell)
    monkeypatch.setattr(setsketch, "HEAD_ROUNDS", rounds)
    for i in range(6):
        words = [f"w{chance.randrange(4000)}" for _ in range(chance.choice([40, 120, 300]))]
        texts += [edited(chance, words, changes, f"{i}_{j}") for j, changes in enumerate([0, 0, 1, 2, 3, 4, 6, 9, 14])]
    words = [f"w{chance.randrange(4000)}" for _ in range(200)]
    texts += [edited(chance, words, 4, f"h{j}") for j in range(40)]
    ids = chance.sample(range(10_000), len(texts))
    same(setsketch.near_duplicates(table(spark, texts, ids), 3, 0.85).collect(), plain(texts, ids, 3, 85))
    if rounds:
        same(setsketch.near_duplicates(table(spark, texts, ids)).collect(), plain(texts, ids, 5, 80))


def test_registers_merge_and_estimate():
    chance, sketch = np.random.default_rng(1), SetSketch()
    pool = chance.integers(0, 2**64, 6000, dtype=np.uint64)
    a, b = pool[:3000], pool[1000:]
    assert (np.maximum(sketch.registers(a), sketch.registers(b)) == sketch.registers(np.union1d(a, b))).all()
    assert (sketch.registers(a) == sketch.registers(a[::-1])).all() and not sketch.registers(a[:0]).any()
    errors = []
    for _ in range(60):
        pool = chance.integers(0, 2**64, 1100, dtype=np.uint64)
        shared = int(chance.integers(300, 950))
        a, b = pool[: shared + 75], np.concatenate([pool[:shared], pool[shared + 75 :][: 1025 - shared]])
        true = shared / (len(a) + len(b) - shared)
        sizes = (np.array([len(s)]) for s in (a, b))
        errors.append((sketch.estimate(*sizes, sketch.registers(a)[None], sketch.registers(b)[None])[0] - true) / sketch.spread(true))
    assert abs(np.mean(errors)) < 0.5 and np.std(errors) < 1.3 and np.max(np.abs(errors)) < 4


def test_bands_bring_similar_sets_together():
    chance, sketch, met = np.random.default_rng(2), SetSketch(), 0
    for _ in range(300):
        pool = chance.integers(0, 2**64, 400, dtype=np.uint64)
        a, b = pool[:370], pool[30:]  # 340 of 400
        met += bool(set(sketch.band_keys(sketch.registers(a))) & set(sketch.band_keys(sketch.registers(b))))
    assert met == 300


def test_pairs_looked_at_grow_with_a_group_of_copies(spark):
    """Twice as many edited copies give about twice as many pairs, not four times."""

    def looked_at(copies):
        chance = random.Random(3)
        words = [f"w{chance.randrange(4000)}" for _ in range(400)]
        docs = table(spark, [edited(chance, words, 5, f"c{j}") for j in range(copies)])
        counts = []
        with pytest.MonkeyPatch.context() as patch:
            written = setsketch.written

            def counted(df, name):
                out = written(df, name)
                if name in ("likely-pairs", "exact-links", "links-of-cells"):
                    counts.append(out.count())
                return out

            patch.setattr(setsketch, "written", counted)
            setsketch.near_duplicates(docs, 5, 0.8).collect()
        return sum(counts)

    assert looked_at(600) < 3 * looked_at(300)
