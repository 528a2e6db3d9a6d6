from pyspark.sql import functions as F

from knotwork.operators import resolution as E


def test_undecided_pairs_are_compared_once(spark):
    """Fields are costly to compare; neither the decision nor the sort may do it again."""
    compared = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def same(a, b):
        compared.add(1)
        return a == b

    people = [(i, "x" if i % 3 else None, i % 4) for i in range(20)]
    pairs = spark.createDataFrame(
        [(a, b, n, m) for a, n, k in people for b, m, j in people if k == j], "a_id bigint, b_id bigint, a_name string, b_name string"
    ).repartition(2)
    params = {"name": (0.9, 0.1)}
    weighed = E.match_weights(E.field_comparisons(pairs, {"name": lambda a, b: same(a, b)}), params)
    queue = E.review_queue(E.match_decision(E.match_probability(weighed, 0.3)))
    rows = [(r["a_id"], r["b_id"], round(r["probability"], 6)) for r in queue.collect()]
    asked = [(a, b) for a, n, k in people for b, m, j in people if k == j and n and m]
    assert rows == sorted((a, b, round(27 / 34, 6)) for a, b in asked)
    assert compared.value <= 100


def test_weights_of_missing_fields(spark):
    df = spark.createDataFrame([(1, True, None), (2, False, True), (3, None, None)], "id int, agree_a boolean, agree_b boolean")
    got = {r["id"]: r["weight"] for r in E.match_weights(df, {"a": (0.9, 0.1), "b": (0.8, 0.2)}).collect()}
    w = E.field_weights({"a": (0.9, 0.1), "b": (0.8, 0.2)})
    assert got == {1: w["a"][0], 2: w["a"][1] + w["b"][0], 3: 0.0}
