"""Finding records of the same entity: blocking, field evidence, decisions, profiles."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from knotwork.operators.skew import fragment_join, meeting_counts, spread
from knotwork.session import written

Comparator = Callable[[Column, Column], Column]


def _side(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in df.columns])


def _equi_pairs(a: DataFrame, b: DataFrame, keys: Sequence[str], counts: DataFrame) -> DataFrame:
    """Rows of a and b with equal, non-null keys; hot keys are spread over both."""
    left, right = _side(b, "b_"), _side(a, "a_")
    for i, k in enumerate(keys):
        left = left.withColumn(f"_k{i}", F.col(f"b_{k}")).filter(F.col(f"b_{k}").isNotNull())
        right = right.withColumn(f"_k{i}", F.col(f"a_{k}")).filter(F.col(f"a_{k}").isNotNull())
    on = [f"_k{i}" for i in range(len(keys))]
    return fragment_join(left, right, on, ["b_id"], ["a_id"], counts=counts).drop(*on)


def _agree_on(keys: Sequence[str]) -> Column:
    """True when all keys are present and equal on both sides."""
    same = F.lit(True)
    for k in keys:
        same = same & F.coalesce(F.col(f"a_{k}") == F.col(f"b_{k}"), F.lit(False))
    return same


def blocking_pairs(a: DataFrame, b: DataFrame, passes: Sequence[Sequence[str]], same_table: bool = False) -> DataFrame:
    """Candidate pairs from several blocking passes, each pair once.

    Both tables need ``id`` and the key columns; all columns come along as ``a_``
    and ``b_`` so that fields can be compared without further joins. A pair found
    by an earlier pass is left out of later ones by looking at its keys, so no
    duplicate removal has to be shuffled. Keys are counted in tasks of bounded size.
    """
    keys = ["id", *dict.fromkeys(k for p in passes for k in p if k != "id")]
    counts = meeting_counts(*(spread(df.select(*keys), df.count() * len(passes), *keys) for df in (b, a)), passes)
    found = None
    for i, keys in enumerate(passes):
        pairs = _equi_pairs(a, b, keys, counts.filter(F.col("set_no") == i).drop("set_no"))
        if same_table:
            pairs = pairs.filter(F.col("a_id") < F.col("b_id"))
        for earlier in passes[:i]:
            pairs = pairs.filter(~_agree_on(earlier))
        pairs = pairs.withColumn("pass_no", F.lit(i + 1))
        found = pairs if found is None else found.unionByName(pairs)
    return found


#: A shared key with more rows than this on a side is frequent; its pairs are not moved.
FREQUENT_KEY_ROWS = 100


def _shared_keys(key_sets: Sequence[tuple[DataFrame, DataFrame]]) -> tuple[DataFrame, DataFrame]:
    """The keys of each side that the other side has too, numbered: ``(a_id, no, frequent)`` and ``(b_id, no, frequent)``.

    A key set is two tables (id, key columns). Numbers of the last set are not negative, those of the others are.
    """
    found_a, found_b = [], []
    for i, (a, b) in enumerate(key_sets):
        on = [f"_k{j}" for j in range(len(a.columns) - 1)]
        a, b = a.toDF("a_id", *on).na.drop(subset=on).distinct(), b.toDF("b_id", *on).na.drop(subset=on).distinct()
        met = a.groupBy(*on).agg(F.count("*").alias("n_a")).join(b.groupBy(*on).agg(F.count("*").alias("n_b")), on)
        no = F.monotonically_increasing_id() * len(key_sets) + i
        met = written(met.select(
            *on, (no if i == len(key_sets) - 1 else -1 - no).alias("no"), (F.greatest("n_a", "n_b") > FREQUENT_KEY_ROWS).alias("frequent"),
        ), "shared-keys")
        found_a.append(a.join(met, on).select("a_id", "no", "frequent"))
        found_b.append(b.join(met, on).select("b_id", "no", "frequent"))
    return written(reduce(DataFrame.unionByName, found_a), "keys"), written(reduce(DataFrame.unionByName, found_b), "keys")


def applicant_candidates(
    a: DataFrame, b: DataFrame, passes: Sequence[Sequence[str]], a_links: DataFrame, b_links: DataFrame
) -> DataFrame:
    """New and existing records that share a block or a neighbour: (a_id, b_id, same_block, shared).

    ``a_links`` / ``b_links`` are (node, neighbor). A key that many records share makes pairs by the square of
    its records. Such a pair is final where its rows meet and is neither moved nor stored: rows carry their
    frequent keys, of which the first common one makes the pair, and what they share with whom by rarer keys.
    """
    columns = [("id", *keys) for keys in passes]
    keys_a, keys_b = _shared_keys([*((a.select(*c), b.select(*c)) for c in columns), (a_links.select("node", "neighbor"), b_links.select("node", "neighbor"))])
    rare = written(
        keys_b.filter("NOT frequent").join(keys_a.filter("NOT frequent").select("a_id", "no"), "no").groupBy("a_id", "b_id").agg(
            F.max((F.col("no") < 0).cast("int")).alias("same_block"), F.count_if(F.col("no") >= 0).alias("shared"),
        ),
        "rare-pairs",
    )

    def frequent(keys: DataFrame, name: str) -> DataFrame:
        return keys.filter("frequent").groupBy(f"{name}_id").agg(F.sort_array(F.collect_list("no")).alias(f"{name}_keys"))

    # ids may be null: within a struct they are equal then
    partners = rare.groupBy(F.col("a_id").alias("_id")).agg(F.collect_list(F.struct(F.struct("b_id").alias("who"), "same_block", "shared")).alias("rare"))
    rows_a, rows_b = written(frequent(keys_a, "a"), "frequent-keys"), written(frequent(keys_b, "b"), "frequent-keys")
    right = written(rows_a.join(partners, F.col("a_id").eqNullSafe(F.col("_id")), "left").select(
        "a_id", "a_keys", F.col("rare.who").alias("who"), F.col("rare.same_block").alias("blocks"), F.col("rare.shared").alias("counts"), F.explode("a_keys").alias("no"),
    ), "frequent-rows")
    left = written(rows_b.select("b_id", "b_keys", F.explode("b_keys").alias("no")), "frequent-rows")
    met = fragment_join(left, right, ["no"], ["b_id"], ["a_id"], many_pairs=True)
    only = (F.size("a_keys") == 1) | (F.size("b_keys") == 1)  # then the key is all that they have in common
    common = F.array_intersect("a_keys", "b_keys")
    place = F.coalesce(F.array_position("who", F.struct("b_id")), F.lit(0)).cast("int") - 1
    links = F.when(only, (F.col("no") >= 0).cast("int")).otherwise(F.size(F.filter(common, lambda no: no >= 0)))
    many = met.filter(only | (F.get(common, F.lit(0)) == F.col("no"))).select(
        "a_id", "b_id",
        F.greatest((F.col("no") < 0).cast("int"), F.coalesce(F.get("blocks", place), F.lit(0))).alias("same_block"),
        (links + F.coalesce(F.get("counts", place), F.lit(0).cast("bigint"))).alias("shared"),
    )
    few = rare.join(rows_a.withColumnRenamed("a_id", "_a"), F.col("a_id").eqNullSafe(F.col("_a")), "left").join(
        rows_b.withColumnRenamed("b_id", "_b"), F.col("b_id").eqNullSafe(F.col("_b")), "left"
    ).filter(~F.coalesce(F.arrays_overlap("a_keys", "b_keys"), F.lit(False)))
    return many.unionByName(few.select("a_id", "b_id", "same_block", "shared"))


# --- evidence -------------------------------------------------------------

def field_comparisons(pairs: DataFrame, fields: Mapping[str, Comparator | None]) -> DataFrame:
    """``agree_<field>`` per pair: true, false, or null when either side is missing."""
    out = pairs
    for f, compare in fields.items():
        x, y = F.col(f"a_{f}"), F.col(f"b_{f}")
        same = (x == y) if compare is None else compare(x, y)
        out = out.withColumn(f"agree_{f}", F.when(x.isNotNull() & y.isNotNull(), same))
    return out


def field_weights(params: Mapping[str, tuple[float, float]]) -> dict[str, tuple[float, float]]:
    """Per field (weight of agreement, weight of disagreement) from (m, u)."""
    return {f: (math.log2(m / u), math.log2((1 - m) / (1 - u))) for f, (m, u) in params.items()}


def match_weights(compared: DataFrame, params: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Sum of log2 likelihood ratios over the fields; a missing field adds nothing.

    Each comparison is named once, and the sum leaves a generator, through which the planner moves no
    expression: later steps that use it several times would compare the fields as many times.
    """
    total = F.lit(0.0)
    for f, (yes, no) in field_weights(params).items():
        total = total + F.coalesce(F.get(F.array(F.lit(no), F.lit(yes)), F.col(f"agree_{f}").cast("int")), F.lit(0.0))
    return compared.drop("weight").select("*", F.inline(F.array(F.struct(total.alias("weight")))))


def match_probability(scored: DataFrame, prior: float) -> DataFrame:
    odds = F.lit(prior / (1 - prior)) * F.pow(F.lit(2.0), F.col("weight"))
    return scored.withColumn("probability", odds / (F.lit(1.0) + odds))


def decide(p: Column, hi: float = 0.9, lo: float = 0.4) -> Column:
    return F.when(p > hi, F.lit("match")).when(p < lo, F.lit("new")).otherwise(F.lit("review"))


def match_decision(scored: DataFrame, hi: float = 0.9, lo: float = 0.4) -> DataFrame:
    """Above ``hi`` match, below ``lo`` new, both limits and all between review."""
    return scored.withColumn("decision", decide(F.col("probability"), hi, lo))


def review_queue(decided: DataFrame) -> DataFrame:
    """Undecided pairs, least certain match first.

    They are stored before they are sorted, as a sort reads its input twice.
    """
    return written(decided.filter(F.col("decision") == "review"), "review").orderBy("probability", "a_id", "b_id")


def sufficient_keys(params: Mapping[str, tuple[float, float]], prior: float, min_probability: float) -> list[tuple[str, ...]]:
    """Smallest field sets whose agreement alone can lift a pair to the probability.

    Disagreeing or missing fields never add weight, so every pair that reaches
    the probability agrees on all fields of at least one of these sets.
    """
    weights = field_weights(params)
    if any(yes <= 0 or no > 0 for yes, no in weights.values()):
        raise ValueError("every field needs m > u")
    need = math.log2(min_probability / (1 - min_probability)) - math.log2(prior / (1 - prior))
    if need <= 0:
        raise ValueError("the prior alone reaches the probability; every pair would qualify")
    found: list[tuple[str, ...]] = []
    for size in range(1, len(weights) + 1):
        for combo in combinations(weights, size):
            covers = any(set(f) <= set(combo) for f in found)
            if not covers and sum(weights[f][0] for f in combo) >= need - 1e-9:
                found.append(combo)
    return found


def likely_pairs(
    a: DataFrame, b: DataFrame, params: Mapping[str, tuple[float, float]], prior: float,
    min_probability: float = 0.4, same_table: bool = False,
) -> DataFrame:
    """All pairs with at least the given match probability, over whole tables, without blocks.

    Exact: instead of comparing within coarse blocks, one equi-join is run per
    sufficient field set, so only pairs that agree on enough evidence are formed.
    Fields are compared for equality (normalise or sound-code them beforehand).
    """
    keys = sufficient_keys(params, prior, min_probability)
    if not keys:
        keys = [tuple(params)]
    fields = ["id", *params]
    pairs = blocking_pairs(a.select(*fields), b.select(*fields), keys, same_table)
    scored = match_probability(match_weights(field_comparisons(pairs, dict.fromkeys(params)), params), prior)
    return scored.filter(F.col("probability") >= min_probability - 1e-12)


def duplicate_or_new(records: DataFrame, likely: DataFrame, hi: float = 0.9, lo: float = 0.4) -> DataFrame:
    """Decision per record from its best pair; a record without a likely pair is new."""
    best = likely.groupBy(F.col("a_id").alias("id")).agg(F.max("probability").alias("p"))
    p = F.coalesce("p", F.lit(0.0))
    return records.select("id").join(best, "id", "left").select("id", decide(p, hi, lo).alias("decision"))


# --- linking --------------------------------------------------------------

#: More names than this are first reduced to those of scored nodes.
MANY_NAMES = 100_000


def structural_plus_name(scores: DataFrame, names: DataFrame, compare: Comparator, cutoff: float = 0.4) -> DataFrame:
    """Structurally similar nodes whose names are also compatible. ``names`` is (node, name).

    There may be far more scores than nodes. Names are stored first, many of them only for nodes that have scores,
    so that the planner sees how few they are and need not move the scores; these are then computed twice.
    """
    strong = scores.filter(F.col("score") >= cutoff - 1e-12)
    names = written(names.select("node", "name"), "names")
    if names.count() > MANY_NAMES:
        asked = written(strong.select(F.explode(F.array("node1", "node2")).alias("node")).distinct(), "scored-nodes")
        names = written(names.join(asked, "node", "left_semi"), "names")
    one = names.select(F.col("node").alias("node1"), F.col("name").alias("name1"))
    two = names.select(F.col("node").alias("node2"), F.col("name").alias("name2"))
    return strong.join(one, "node1").join(two, "node2").filter(compare(F.col("name1"), F.col("name2")))


def link_or_new(applicants: DataFrame, best: DataFrame, threshold: float) -> DataFrame:
    """Every applicant with the linked existing id, or as a new customer."""
    linked = best.filter(F.col("score") > threshold).select(
        F.col("node1").alias("applicant_id"), F.col("node2").alias("linked_id"), "score"
    )
    out = applicants.select(F.col("id").alias("applicant_id")).join(linked, "applicant_id", "left")
    return out.withColumn("outcome", F.when(F.col("linked_id").isNull(), F.lit("new")).otherwise(F.lit("linked")))


def private_result(linked: DataFrame) -> DataFrame:
    """What may leave the matching side: applicant, yes/no and the score, nothing of the matched person."""
    return linked.select("applicant_id", F.col("linked_id").isNotNull().alias("known"), "score")


def merged_profile(rows: DataFrame, clusters: DataFrame, fields: Sequence[str], recency: str) -> DataFrame:
    """One row per cluster: for each field the newest non-null value, ties to the smaller id.

    Ids that are no numbers cannot be turned around inside a maximum, so the
    newest date of each field is found first and the smallest id of it then.
    """
    joined = rows.join(clusters, "id")
    if not isinstance(rows.schema["id"].dataType, T.NumericType):
        dates = joined.groupBy("cluster").agg(*[F.max(F.when(F.col(f).isNotNull(), F.col(recency))).alias(f"_newest_{f}") for f in fields])
        dated = joined.join(written(dates, "newest"), "cluster")
        return dated.groupBy("cluster").agg(F.count("*").alias("records"), *[
            F.min_by(f, F.when(F.col(f).isNotNull() & F.col(recency).eqNullSafe(F.col(f"_newest_{f}")), F.col("id"))).alias(f) for f in fields
        ])
    newest = F.struct(F.col(recency), (-F.col("id")).alias("neg"))
    return joined.groupBy("cluster").agg(
        F.count("*").alias("records"),
        *[F.max_by(f, F.when(F.col(f).isNotNull(), newest)).alias(f) for f in fields],
    )
