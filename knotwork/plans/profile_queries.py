"""Flat-table statistics, sorting and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knotwork.operators import profile as D
from knotwork.operators import transcripts as C
from knotwork.plans import fixtures as X
from knotwork.plans.fixtures import SQL_CHAT
from knotwork.plans.registry import Tables, query

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _subject(t: Tables) -> DataFrame:
    """Line items with nulls in the tax and a constant column."""
    tax = F.when(F.col("l_tax") != 0, F.col("l_tax"))
    return t.lineitem.select("l_quantity", "l_extendedprice", "l_discount", tax.alias("l_tax"), F.lit(1.0).alias("one"), "l_returnflag")


_SUBJECT = """s AS (SELECT l_quantity, l_extendedprice, l_discount, nullif(l_tax, 0.0) AS l_tax, 1.0::DOUBLE AS one, l_returnflag FROM lineitem)"""


def _describe_sql(c: str) -> str:
    q = ", ".join(f"round(quantile_cont({c}, {p}), 5) AS {n}" for n, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)))
    return (f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 5) AS mean, round(stddev_samp({c}), 5) AS std, "
            f"round(min({c}), 5) AS min, {q}, round(max({c}), 5) AS max FROM s")


@query("describe", f"WITH {_SUBJECT} " + " UNION ALL ".join(_describe_sql(c) for c in [*MEASURES, "one"]))
def _(t: Tables) -> DataFrame:
    d = D.describe(_subject(t))
    return d.select("column", "count", *[F.round(c, 5).alias(c) for c in d.columns[2:]])


@query("null_counts", f"WITH {_SUBJECT} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls FROM s" for c in [*MEASURES, "one", "l_returnflag"]))
def _(t: Tables) -> DataFrame:
    return D.null_counts(_subject(t))


def _corr_sql(x: str, y: str) -> str:
    both = f"FILTER ({x} IS NOT NULL AND {y} IS NOT NULL)"
    return (f"SELECT '{x}' AS x, '{y}' AS y, round(covar_samp({x}, {y}) {both} / "
            f"nullif(stddev_samp({x}) {both} * stddev_samp({y}) {both}, 0), 6) AS r FROM s")


@query("correlation_matrix", f"WITH {_SUBJECT} " + " UNION ALL ".join(_corr_sql(x, y) for x in [*MEASURES, "one"] for y in [*MEASURES, "one"]))
def _(t: Tables) -> DataFrame:
    return D.correlation_matrix(_subject(t)).withColumn("r", F.round("r", 6))


@query("histogram", """WITH s AS (SELECT count(value) AS n, min(value) AS lo, max(value) AS hi,
  quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr FROM events),
b AS (SELECT *, greatest(1, ceil((hi - lo) / least(2 * iqr / pow(n, 1.0 / 3), (hi - lo) / (log2(n) + 1))))::BIGINT AS bins FROM s),
c AS (SELECT least(floor((value - lo) / (hi - lo) * bins), bins - 1)::BIGINT AS bin, count(*) AS n FROM events, b GROUP BY 1)
SELECT g.bin, round(lo + g.bin * (hi - lo) / bins, 6) AS lo, round(lo + (g.bin + 1) * (hi - lo) / bins, 6) AS hi, coalesce(c.n, 0) AS n
FROM b, (SELECT unnest(range((SELECT bins FROM b))) AS bin) g LEFT JOIN c ON c.bin = g.bin""")
def _(t: Tables) -> DataFrame:
    h = D.histogram(t.events, "value")
    return h.withColumns({"lo": F.round("lo", 6), "hi": F.round("hi", 6)})


@query("kde", """WITH s AS (SELECT count(value) AS n, min(value) AS lo, max(value) AS hi, stddev_samp(value) AS sd FROM events),
k AS (SELECT *, sd * pow(n, -0.2) AS h, (hi - lo) / 199 AS step FROM s)
SELECT point, round(any_value(lo + point * step), 6) AS x,
round(sum(exp(-0.5 * pow((lo + point * step - value) / h, 2))) / any_value(n * h * sqrt(2 * pi())), 6) AS density
FROM events, k, (SELECT unnest(range(200)) AS point) GROUP BY point""")
def _(t: Tables) -> DataFrame:
    d = D.kde(t.events, "value")
    return d.withColumns({"x": F.round("x", 6), "density": F.round("density", 6)})


@query("box_stats", """WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3 FROM events)
SELECT any_value(round(q1, 6)) AS q1, any_value(round(median, 6)) AS median, any_value(round(q3, 6)) AS q3,
min(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_lo,
max(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_hi,
count(*) FILTER (value NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers FROM events, q""")
def _(t: Tables) -> DataFrame:
    b = D.box_stats(t.events, "value")
    return b.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3")})


@query("category_counts", "SELECT CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS segment, count(*) AS n FROM customer WHERE c_mktsegment <> 'BUILDING' GROUP BY 1")
def _(t: Tables) -> DataFrame:
    segment = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
    return D.category_counts(t.customer.select(segment.alias("segment")), "segment")


@query("group_mean", "SELECT c_mktsegment, round(avg(c_acctbal), 6) AS mean FROM customer GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return D.group_mean(t.customer, "c_mktsegment", "c_acctbal").withColumn("mean", F.round("mean", 6))


@query("outcome_counts", "SELECT CASE WHEN l_returnflag = 'R' THEN 'returned' ELSE 'kept' END AS outcome, count(*) AS n FROM lineitem GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return D.outcome_counts(t.lineitem, F.when(F.col("l_returnflag") == "R", "returned").otherwise("kept"))


@query("numeric_columns", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def _(t: Tables) -> DataFrame:
    return D.numeric_only(t.customer)


@query("drop_null", f"WITH {_SUBJECT} SELECT l_quantity, l_tax FROM s WHERE l_tax IS NOT NULL")
def _(t: Tables) -> DataFrame:
    return D.drop_null(_subject(t), "l_tax").select("l_quantity", "l_tax")


@query("xy_points", f"WITH {_SUBJECT} SELECT l_extendedprice, l_tax FROM s WHERE l_extendedprice IS NOT NULL AND l_tax IS NOT NULL")
def _(t: Tables) -> DataFrame:
    return D.xy_points(_subject(t), "l_extendedprice", "l_tax")


@query("xy_bins", f"""WITH {_SUBJECT} SELECT floor(l_extendedprice / 5000) * 5000 AS l_extendedprice, floor(l_quantity / 10) * 10 AS l_quantity, count(*) AS n
FROM s GROUP BY 1, 2""")
def _(t: Tables) -> DataFrame:
    return D.xy_bins(_subject(t), "l_extendedprice", "l_quantity", 5000.0, 10.0).withColumns(
        {c: F.col(c).cast("double") for c in ("l_extendedprice", "l_quantity")}
    )


@query("global_sort", "SELECT l_extendedprice FROM lineitem ORDER BY 1")
def _(t: Tables) -> DataFrame:
    return D.global_sort(t.lineitem.select("l_extendedprice"), "l_extendedprice")


@query("merge_sorted_inputs", "SELECT s_name AS name, s_acctbal AS balance FROM supplier UNION ALL SELECT c_name, c_acctbal FROM customer ORDER BY 2, 1")
def _(t: Tables) -> DataFrame:
    a = t.supplier.select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    b = t.customer.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    return D.merge_sorted_inputs(a, b, "balance", "name")


# --- conversations --------------------------------------------------------

@query("stop_turn", f"WITH {SQL_CHAT} SELECT conv_id, min(turn) FILTER (contains(text, 'STOP')) AS stop_turn FROM chat GROUP BY conv_id")
def _(t: Tables) -> DataFrame:
    return C.stop_turn(X.chat(t))


@query("truncate_conversation", f"""WITH {SQL_CHAT}, st AS (SELECT conv_id, min(turn) FILTER (contains(text, 'STOP')) AS s, max(turn) AS l FROM chat GROUP BY conv_id)
SELECT conv_id, turn, role, CASE WHEN s < 4 THEN 'stop word' WHEN l >= 4 THEN 'max turns' ELSE 'end' END AS reason
FROM chat JOIN st USING (conv_id) WHERE turn <= CASE WHEN s < 4 THEN s ELSE 3 END""")
def _(t: Tables) -> DataFrame:
    return C.truncate_conversation(X.chat(t), max_turns=4).select("conv_id", "turn", "role", "reason")


@query("code_blocks", f"""WITH {SQL_CHAT}, b AS (SELECT conv_id, turn, regexp_extract_all(text, '(?s)```(\\w*)\\n(.*?)```') AS w FROM chat),
u AS (SELECT conv_id, turn, unnest(range(len(w))) AS block, w FROM b)
SELECT conv_id, turn, block::INT AS block, regexp_extract(w[block + 1], '(?s)```(\\w*)\\n(.*?)```', 1) AS language,
regexp_extract(w[block + 1], '(?s)```(\\w*)\\n(.*?)```', 2) AS body FROM u""")
def _(t: Tables) -> DataFrame:
    return C.code_blocks(X.chat(t))


@query("executor_outcomes", f"""WITH {SQL_CHAT}, c AS (SELECT conv_id, turn, regexp_extract_all(text, 'exit code: (\\d+)', 1) AS codes FROM chat),
n AS (SELECT conv_id, turn, unnest(range(len(codes))) AS note, codes FROM c)
SELECT conv_id, turn, note::INT AS note, codes[note + 1]::INT AS exit_code, codes[note + 1]::INT = 0 AS success FROM n""")
def _(t: Tables) -> DataFrame:
    return C.executor_outcomes(X.chat(t))


def _all_tokens(kind: str) -> str:
    return f"coalesce(sum(list_sum(list_transform(regexp_extract_all(text, '{kind}_tokens=(\\d+)', 1), lambda n: try_cast(n AS BIGINT)))), 0)::BIGINT AS {kind}_tokens"


@query("token_usage", f"WITH {SQL_CHAT} SELECT conv_id, role, {_all_tokens('prompt')}, {_all_tokens('completion')} FROM chat GROUP BY ALL")
def _(t: Tables) -> DataFrame:
    return C.token_usage(X.chat(t))


@query("role_counts", "SELECT role, count(*) AS n FROM conversations GROUP BY role")
def _(t: Tables) -> DataFrame:
    return C.role_counts(t.conversations)
