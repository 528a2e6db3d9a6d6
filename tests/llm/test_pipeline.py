"""The pipeline stage by stage on the smallest tables."""

import random
from collections import Counter
from itertools import combinations

from pyspark.sql import functions as F

import corpus_pipeline
from knotwork.llm import fingerprints, neardup, packing, secret_tags
from knotwork.session import written

FOLDER = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, docs
    outcomes = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = written(stage(spark, before, FOLDER), f"test-{name}")
        assert after.columns == columns and after.dtypes == docs.dtypes
        outcomes[name] = (before, after)
        before = after
    for name in ("toxicity", "quality", "near_dedup"):
        old, new = outcomes[name]
        assert new.subtract(old).isEmpty() and 0 < new.count() <= old.count()
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    kept = outcomes["quality"][1].join(labels, "doc_id")
    assert kept.filter("quality = 0").count() <= 2
    groups = neardup.near_duplicate_groups(outcomes["near_dedup"][1])
    assert groups.select("root").distinct().count() == groups.count()
    old, new = outcomes["secrets"]
    assert new.count() == old.count()
    assert not any(secret_tags.base_spans(r.text) for r in new.select("text").collect())
    packed = corpus_pipeline.STAGES[-1][1](spark, before, FOLDER).toPandas()
    assert set(packed.doc_id) == {r.doc_id for r in before.select("doc_id").collect()}
    assert packed.groupby("sequence_id").length.sum().max() <= packing.CAPACITY


CLASHING = "_id string, _key int, score double, quality int, toxic int, fp string, root int, piece int, length string, part int"


def with_odd_rows(spark, docs):
    """Nulls in every column, empty, blank and very long texts, repeated rows, and columns with the names that the stages use inside."""
    long = " ".join(f"the river bends around mill number {i} and nobody minds." for i in range(8000))
    odd = [
        (None, None, None, None, None), (None, None, None, None, None), (900_001, None, "en", None, 0), (900_002, "", None, "s", 0),
        (900_003, " \n\t ", "en", "s", 4), (900_004, long, "en", None, len(long)), (900_005, long, None, "s", len(long)),
        (900_006, "one two three", "en", "s", 13), (900_006, "one two three", "en", "s", 13), (None, "one two four", "en", "s", 12),
    ]
    rows = docs.limit(0).unionByName(spark.createDataFrame(odd, docs.select("doc_id", "text", "lang", "source", "n_chars").schema))
    extra = [F.lit(None).cast(kind).alias(name) for name, kind in (pair.split() for pair in CLASHING.split(", "))]
    return docs.unionByName(rows).repartition(5).select("*", *extra)


def as_multiset(df):
    return Counter(tuple(r) for r in df.select("doc_id", "text").collect())


def test_stages_on_odd_rows(spark):
    before = written(with_odd_rows(spark, spark.read.parquet(f"{FOLDER}/documents.parquet")), "test-odd")
    columns = before.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = written(stage(spark, before, FOLDER), f"test-odd-{name}")
        assert after.columns == columns
        old, new = as_multiset(before), as_multiset(after)
        if name == "secrets":
            assert new.total() == old.total() and {k for k in new if k[1] is None} == {k for k in old if k[1] is None}
        else:
            assert not new - old and new
        if name == "toxicity":  # nothing to be found toxic in these
            assert all(new[k] == n for k, n in old.items() if not (k[1] or "").strip())
        if name == "near_dedup":
            assert max(new.values()) == 1 and sum(not (k[1] or "").strip() for k in new) <= 1
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, before, FOLDER).toPandas()
    assert (packed.piece == 0).sum() == before.count()
    assert packed.groupby("sequence_id").length.sum().max() <= packing.CAPACITY


def test_near_dedup_drops_edited_copies(spark):
    chance = random.Random(4)
    texts = []
    for i in range(12):
        words = [f"w{chance.randrange(3000)}" for _ in range(chance.choice([60, 100, 200]))]
        for j in range(5):
            copy = list(words)
            for place in chance.sample(range(len(copy)), j):
                copy[place] = f"x{i}_{j}_{place}"
            texts.append(" ".join(copy))
    sets = [{tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for t in texts]
    group = list(range(len(texts)))
    for a, b in combinations(range(len(texts)), 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            group = [group[a] if g == group[b] else g for g in group]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, FOLDER).collect()}
    assert kept == {group.index(g) for g in group} and len(kept) < len(texts)


def test_stages_on_an_empty_table(spark):
    docs = with_odd_rows(spark, spark.read.parquet(f"{FOLDER}/documents.parquet")).limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, FOLDER)
        assert after.columns == docs.columns and after.isEmpty(), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).isEmpty()


def test_operators_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    assert fingerprints.with_near_counts(fingerprints.edited_fingerprints(docs)).isEmpty()
    assert neardup.near_duplicate_groups(docs).isEmpty() and secret_tags.scan(docs).isEmpty()
