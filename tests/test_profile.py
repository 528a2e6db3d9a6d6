import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from knotwork.operators import profile as D
from knotwork.operators import transcripts as C

ROWS = [
    (22.0, 7.25, "S", 3, 0), (38.0, 71.28, "C", 1, 1), (26.0, 7.92, "S", 3, 1), (35.0, 53.1, "S", 1, 1), (None, 8.46, "Q", 3, 0),
    (54.0, 51.86, "S", 1, 0), (2.0, 21.07, None, 3, 0), (27.0, 11.13, "S", 3, 1), (14.0, 30.07, "C", 2, 1), (80.0, 512.3, "S", 1, 1),
]


@pytest.fixture(scope="module")
def flat(spark):
    df = spark.createDataFrame(ROWS, "age double, fare double, embarked string, pclass int, survived int")
    return df.withColumn("one", F.lit(1.0))


def test_describe(flat):
    rows = {r["column"]: r for r in D.describe(flat).collect()}
    ages = [r[0] for r in ROWS if r[0] is not None]
    assert rows["age"]["count"] == 9 and rows["one"]["std"] == 0.0 and "embarked" not in rows
    for q, c in ((25, "q25"), (50, "q50"), (75, "q75")):
        assert rows["age"][c] == pytest.approx(np.percentile(ages, q))
    assert rows["age"]["std"] == pytest.approx(np.std(ages, ddof=1))


def test_nulls_and_correlation(flat):
    assert {r["column"]: r["nulls"] for r in D.null_counts(flat).collect()}["age"] == 1
    m = {(r["x"], r["y"]): r["r"] for r in D.correlation_matrix(flat).collect()}
    pairs = [(r[0], r[1]) for r in ROWS if r[0] is not None]
    assert m["age", "fare"] == pytest.approx(np.corrcoef(*zip(*pairs))[0, 1]) and m["age", "fare"] == m["fare", "age"]
    assert m["one", "age"] is None and m["fare", "fare"] == pytest.approx(1.0)


@pytest.mark.parametrize("kind", ["uniform", "skewed", "equal", "few"])
def test_exact_quantiles(spark, monkeypatch, kind):
    monkeypatch.setattr(D, "LEAF_ROWS", 20)
    monkeypatch.setattr(D, "BINS_PER_PASS", 8)
    rnd = random.Random(4)
    values = {
        "uniform": [rnd.uniform(-5, 5) for _ in range(2000)], "skewed": [rnd.lognormvariate(0, 8) for _ in range(2000)],
        "equal": [3.0] * 700 + [rnd.random() for _ in range(300)], "few": [1.0, 2.0, 4.0],
    }[kind]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    qs = (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0)
    got = D.exact_quantiles(df, ["v"], qs)["v"]
    for q in qs:
        assert got[q] == pytest.approx(np.quantile(values, q), rel=1e-12)
    assert D.exact_quantiles(df.filter("v is null"), ["v"], (0.5,))["v"][0.5] is None


def test_quantiles_with_infinite_and_missing_values(spark, monkeypatch):
    monkeypatch.setattr(D, "LEAF_ROWS", 2)
    inf, nan = float("inf"), float("nan")
    values = [-inf, -inf, 1.0, 2.0, 3.0, 1.7e308, inf, inf, inf, nan, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = D.exact_quantiles(df, ["v"], (0.0, 0.25, 0.5, 0.75, 1.0))["v"]
    assert list(got.values()) == [-inf, 1.0, 3.0, inf, inf]
    assert D.describe(df.filter("v is null or isnan(v) or abs(v) < 10")).first()["count"] == 3


def test_distributions(flat):
    fares = [r[1] for r in ROWS]
    h = D.histogram(flat, "fare").orderBy("bin").collect()
    low, high = np.percentile(fares, [25, 75])
    span = max(fares) - min(fares)
    bins = max(np.log2(len(fares)) + 1, span / (2 * (high - low) * len(fares) ** (-1 / 3)))
    counts, edges = np.histogram(fares, bins=int(np.ceil(bins)))
    assert [r["n"] for r in h] == list(counts) and [r["lo"] for r in h] == pytest.approx(list(edges[:-1]))
    k = D.kde(flat, "fare", 50).orderBy("point").collect()
    grid = np.linspace(min(fares), max(fares), 50)
    width = np.std(fares, ddof=1) * len(fares) ** -0.2
    want = [np.mean(np.exp(-0.5 * ((g - np.array(fares)) / width) ** 2)) / width / np.sqrt(2 * np.pi) for g in grid]
    assert [r["density"] for r in k] == pytest.approx(want)
    box = D.box_stats(flat, "fare").first()
    assert box["outliers"] == 1 and box["whisker_hi"] == 71.28 and box["median"] == pytest.approx(np.median(fares))


def test_density_far_from_the_grid_is_kept_exact(spark):
    values = [0.0] * 5000 + [1.0] * 5000 + [1e6]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    d = D.kde(df, "v", 400).orderBy("point").collect()
    assert len(d) == 400 and all(r["density"] >= 0 for r in d) and d[0]["density"] > 0


def test_groups_and_sorting(spark, flat):
    assert {r["embarked"]: r["n"] for r in D.category_counts(flat, "embarked").collect()} == {"S": 6, "C": 2, "Q": 1}
    assert {r["outcome"]: r["n"] for r in D.outcome_counts(flat, F.col("survived") == 1).collect()} == {True: 6, False: 4}
    assert D.numeric_columns(flat) == ["age", "fare", "pclass", "survived", "one"]
    assert {r["pclass"]: r["mean"] for r in D.group_mean(flat, "pclass", "survived").collect()} == {3: 0.4, 1: 0.75, 2: 1.0}
    a, b = (spark.createDataFrame([(x,) for x in v], "x int") for v in ([1, 2, 4], [1, 3, 4]))
    assert [r[0] for r in D.merge_sorted_inputs(a, b, "x").collect()] == [1, 1, 2, 3, 4, 4]
    arrays = spark.createDataFrame([([38, 27, 43, 3, 9, 82, 10],), ([1, 60, -10, 70, -80, 85],)], "x array<int>")
    assert [r[0] for r in D.sorted_arrays(arrays, "x").collect()] == [[3, 9, 10, 27, 38, 43, 82], [-80, -10, 1, 60, 70, 85]]


def test_missing_and_infinite_numbers(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([("a", 1.0), ("a", nan), ("b", None), ("b", 3.0), (None, inf), ("c", -inf), ("c", 2.0)], "g string, v double")
    assert {r["column"]: r["nulls"] for r in D.null_counts(df).collect()} == {"g": 1, "v": 2}
    assert {r["g"]: r["mean"] for r in D.group_mean(df.filter("g != 'c'"), "g", "v").collect()} == {"a": 1.0, "b": 3.0}
    for bins in ("auto", 2):
        rows = sorted(map(tuple, D.histogram(df, "v", bins).collect()))
        assert rows[0] == (-1, -inf, -inf, 1) and rows[-1][1:] == (inf, inf, 1) and sum(r[3] for r in rows) == 5
        assert rows[1][1] == 1.0 and rows[-2][2] == 3.0
    density = D.kde(df, "v", 5).collect()
    assert all(math.isfinite(r["x"]) and math.isfinite(r["density"]) for r in density)
    only = D.histogram(df.filter("v = double('infinity')"), "v").collect()
    assert [tuple(r) for r in only] == [(0, inf, inf, 1)]


def test_correlation_with_missing_and_constant_columns(spark):
    rows = [(float(i), float(i * i % 17) + 1e9, 5.0, None if i % 4 == 0 else float(-i)) for i in range(40)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = {(r["x"], r["y"]): r["r"] for r in D.correlation_matrix(df).collect()}
    a, b = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    some = np.array([r[3] is not None for r in rows])
    assert got["a", "b"] == pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-9) and got["b", "a"] == got["a", "b"]
    assert got["a", "d"] == pytest.approx(-1.0) and got["b", "d"] == pytest.approx(np.corrcoef(b[some], -a[some])[0, 1], abs=1e-9)
    assert got["c", "c"] is None and got["a", "c"] is None and got["a", "a"] == 1.0


def test_quantiles_of_a_heavy_tail_take_three_scans(spark, tmp_path):
    path = str(tmp_path / "tail")
    spark.range(200_000).select(F.pow(F.lit(10.0), F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 50_000).alias("v")).write.parquet(path)
    df = spark.read.parquet(path)
    grouped = []
    group = type(df).groupBy
    try:
        type(df).groupBy = lambda self, *a, **k: (grouped.append(1), group(self, *a, **k))[1]  # agg() groups too
        got = D.exact_quantiles(df, ["v"], (0.25, 0.5, 0.99))["v"]
    finally:
        type(df).groupBy = group
    assert len(grouped) <= 3
    values = np.array([r[0] for r in df.collect()])
    assert all(got[q] == pytest.approx(np.quantile(values, q), rel=1e-12) for q in got)


# The token figures of the recorded exchange.
CHAT = [
    (1, 0, "user", "primes please"),
    (1, 1, "ProblemSolverExpert", "try\n```python\nprint(2)\n```\nand\n```bash\nls\n```\nprompt_tokens=177 completion_tokens=225"),
    (1, 2, "CodeExecutorAgent", "exit code: 1\nboom\nexit code: 0 exit code: 99999999999"),
    (1, 3, "ProblemSolverExpert", "done, stop... STOP prompt_tokens=429 completion_tokens=193; again prompt_tokens=1000 completion_tokens=5"),
    (1, 4, "user", "late"),
    (2, 0, "user", "stop"), (2, 1, "CodeExecutorAgent", "exit code: 0"),
]


def test_conversations(spark):
    chat = spark.createDataFrame(CHAT, "conv_id bigint, turn bigint, role string, text string")
    assert {r["conv_id"]: r["stop_turn"] for r in C.stop_turn(chat).collect()} == {1: 3, 2: None}
    cut = C.truncate_conversation(chat, 15).collect()
    assert len(cut) == 6 and {(r["conv_id"], r["reason"]) for r in cut} == {(1, "stop word"), (2, "end")}
    assert {r["reason"] for r in C.truncate_conversation(chat, 2).collect() if r["conv_id"] == 1} == {"max turns"}
    blocks = [(r["block"], r["language"], r["body"]) for r in C.code_blocks(chat).orderBy("block").collect()]
    assert blocks == [(0, "python", "print(2)\n"), (1, "bash", "ls\n")]
    outcomes = sorted((r["conv_id"], r["note"], r["exit_code"], r["success"]) for r in C.executor_outcomes(chat).collect())
    assert outcomes == [(1, 0, 1, False), (1, 1, 0, True), (2, 0, 0, True)]
    usage = {r["role"]: (r["prompt_tokens"], r["completion_tokens"]) for r in C.token_usage(chat).filter("conv_id = 1").collect()}
    assert usage["ProblemSolverExpert"] == (1606, 423) and usage["user"] == (0, 0)
