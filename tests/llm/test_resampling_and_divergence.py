"""Importance resampling and the audit of sources against plain versions, and on odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from knotwork.llm import divergence, importance, queries
from tools.check_oracle import compare

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, bucket string, n string, term int, rank int, price int, own string, base int, _tie int, _place int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, source, 1, "x", "y", 1, 2, 3, "z", 4, 5, 6) for i, t, lang, source in rows], SCHEMA)


def invented(seed, n):
    chance = random.Random(seed)
    words = ["Abc", "ab-c", "x9", "éa", "ÉA", "don't", "_", "7", "漢字", "q", "zz", "the", "Of", "\x00", "a\nb", " w", "𝒜x"]
    texts = [" ".join(chance.choices(words, k=chance.choice([0, 1, 5, 25, 60]))) for _ in range(n)] + [None, "", " \t", "Abc " * 3000]
    return [
        (chance.choice([None, *range(n)]) if chance.random() < 0.2 else i, t, chance.choice(["en", "de", None]), chance.choice(["s1", "s2", "s0", "é", None]))
        for i, t in enumerate(texts)
    ]


def words_of(text, pattern):
    return re.findall(pattern, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


WORD, TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"


def plain_resample(rows, target, longest, buckets, percent, least_words):
    def grams(text):
        w = words_of(text, WORD)
        return [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    def bucket(g):
        return zlib.crc32(g.encode()) % buckets

    s, t = (Counter(bucket(g) for x in texts for g in grams(x)) for texts in ([r[1] for r in rows], target))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    scored = []
    for doc_id, text, *_ in rows:
        g = grams(text)
        weight = sum(gain[bucket(x)] for x in g) // len(g) if g else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append((doc_id, len(words_of(text, WORD)), len(g), weight, weight + noise))
    enough = sorted((r for r in scored if r[1] >= least_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = len(enough) * percent // 100
    return scored, enough, drawn


@pytest.mark.parametrize("longest,buckets,percent", [(1, 10_000, 10), (3, 50, 40)])
def test_resampling_is_the_plain_computation(spark, longest, buckets, percent):
    rows, target = invented(1, 150), ["Abc x9 the", None, "", "éa éa zz the of q"]
    targets = spark.createDataFrame([(i, t, "x") for i, t in enumerate(target)], "item_id bigint, text string, n string")
    found = importance.resample(table(spark, rows).repartition(5), targets, percent, 20, longest, buckets).collect()
    scored, enough, drawn = plain_resample(rows, target, longest, buckets, percent, 20)
    assert sorted((tuple(r)[:4] for r in found), key=repr) == sorted(((r[0], *r[2:]) for r in scored), key=repr)
    ranked = sorted((r for r in found if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, drawn + 1))
    assert [(r["doc_id"], r["score"]) for r in ranked] == [(r[0], r[4]) for r in enough[:drawn]]


def test_scanning_with_overlaps_finds_every_run_of_words():
    scan = importance.Scanner(3, 100)
    assert list(scan.grams(b"  One, TWO;three\nfour ")) == [
        b"one", b"two", b"three", b"four", b"one two", b"two three", b"three four", b"one two three", b"two three four",
    ]
    assert list(scan.grams(b"  ,;")) == [] and list(scan.grams(b"a")) == [b"a"]
    with pytest.raises(ValueError):
        importance.Scanner(0, 10)


def test_resampling_of_empty_tables(spark):
    docs, none = table(spark, [(1, "a b", "en", "s")]), table(spark, [])
    assert importance.resample(none, docs).collect() == []
    assert [r["rank"] for r in importance.resample(docs, none, percent=100, least_words=1).collect()] == [1]


def test_numbers_run_on_over_all_ranges(spark):
    rows = spark.createDataFrame([(i % 7, i % 3) for i in range(1000)], "a int, b int")
    found = importance.numbered(rows, [rows["a"].desc(), rows["b"].asc()], "no").orderBy("no").collect()
    assert [r["no"] for r in found] == list(range(1, 1001))
    assert [(r["a"], r["b"]) for r in found] == sorted(((i % 7, i % 3) for i in range(1000)), key=lambda r: (-r[0], r[1]))


def plain_audit(rows, least_docs, top):
    held = [((r[2] or ""), (r[3] or ""), words_of(r[1], TERM)) for r in rows]
    out = []
    for lang in {h[0] for h in held}:
        docs = [h for h in held if h[0] == lang]
        df = Counter(w for d in docs for w in set(d[2]))
        kept = [w for w in df if df[w] >= least_docs]
        counts = {s: Counter(w for d in docs if d[1] == s for w in d[2]) for s in {d[1] for d in docs}}
        whole = sum(counts.values(), Counter())

        def shares(c):
            total = sum(c[w] for w in kept)
            return {w: 1 + 1_000_000_000 * (c[w] + 5) // (total + 5 * len(kept)) for w in kept}

        p, q = {s: shares(c) for s, c in counts.items()}, shares(whole)
        for s in counts:
            pairs = [("pair", o, sum(abs(p[s][w] - p[o][w]) for w in kept)) for o in counts if o != s]
            best = [("term", w, p[s][w] - q[w]) for w in kept if counts[s][w] > 0 and p[s][w] > q[w]]
            for part, keep in ((pairs, None), (best, top)):
                part.sort(key=lambda r: (-r[2], r[1].encode()))
                out += [(lang, s, *r, i + 1) for i, r in enumerate(part[:keep])]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(256, 32), (3, 2)])
def test_audit_is_the_plain_computation(spark, monkeypatch, blocks):
    monkeypatch.setattr(divergence, "BLOCK_TERMS", blocks[0])
    monkeypatch.setattr(divergence, "BLOCK_SOURCES", blocks[1])
    monkeypatch.setattr(divergence, "HELD_COUNTS", 20)
    rows = invented(3, 200)
    rows += [(900 + i, "12 34", "en", "wordless") for i in range(2)] + [(910, "one", "xx", "a"), (911, "two", "xx", "b")]
    found = divergence.audit(table(spark, rows).repartition(3), least_docs=4, top_terms=3)
    assert sorted(map(tuple, found.collect())) == plain_audit(rows, 4, 3)
    assert divergence.audit(table(spark, [])).collect() == []


def test_joint_tables_of_a_block_are_exact():
    chance = np.random.default_rng(5)
    counts = chance.integers(0, 4, (40, 6))
    prices = np.cumsum(chance.integers(1, 9, (4, 6)), axis=0)
    rows = [(f"t{t}".encode(), None, 0, 0) for t in range(40)] + [(None, f"s{s}", 0, int(prices[0, s])) for s in range(6)]
    rows += [(f"t{t}".encode(), f"s{s}", int(counts[t, s]), int(prices[counts[t, s], s])) for t in range(40) for s in range(6) if counts[t, s]]
    chance.shuffle(rows)
    term, source, n, price = (list(c) for c in zip(*rows))
    block = pa.table({"term": pa.array(term, pa.binary()), "source": source, "n": pa.array(n, pa.int64()), "price": pa.array(price, pa.int64())})
    worth = {(f"s{a}", f"s{b}"): int(sum(abs(prices[counts[t, a], a] - prices[counts[t, b], b]) for t in range(40))) for a in range(6) for b in range(a + 1, 6)}
    assert {(a, b): v for a, b, v in divergence.joint_prices(block)} == worth


@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_same_rows_as_sql(spark, key):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    assert compare(spark, con, FOLDER, key, queries.QUERIES[key], queries.ORACLES[key]).startswith("ok")
