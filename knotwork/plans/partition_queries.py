"""Partition assignment, reports and life cycle."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knotwork.functions.properties import prop_date
from knotwork.operators import partitions as R
from knotwork.operators.graph import label_catalog
from knotwork.plans import fixtures as X
from knotwork.plans.fixtures import SQL_E, SQL_ORDER_V, SQL_V
from knotwork.plans.registry import Tables, query

_DAY = "try_cast(props ->> '$.created_at' AS DATE)"
_KEY = "(id & ((1::BIGINT << 48) - 1))"
VERTEX_YEARS_SQL = f"CASE WHEN year({_DAY}) BETWEEN 1999 AND 2002 THEN 'y' || year({_DAY}) ELSE 'default' END"


def _orders(t: Tables) -> DataFrame:
    v = X.order_vertices(t)
    return v.withColumn("created_at", prop_date(F.col("props"), "created_at"))


def _by_year(t: Tables) -> DataFrame:
    return _orders(t).withColumn("part", R.year_partition(F.col("created_at"), X.AS_OF))


def _order_spec() -> list[R.Range]:
    return R.year_ranges("Order", range(X.AS_OF.year - 2, X.AS_OF.year + 2), with_default=True)


def _key(df: DataFrame):
    return F.col("id").bitwiseAND(F.lit((1 << 48) - 1))


@query("assign_range", f"""WITH {SQL_V} SELECT id, CASE
WHEN label = 'Customer' THEN CASE WHEN {_KEY} < 500 THEN 'c_low' WHEN {_KEY} >= 1000 THEN 'c_high' ELSE 'c_rest' END
WHEN label = 'Product' AND {_KEY} >= 100 AND {_KEY} < 1000 THEN 'p_mid' END AS part FROM v""")
def _(t: Tables) -> DataFrame:
    spec = [
        R.Range("Customer", "c_low", 0, 500), R.Range("Customer", "c_high", 1000, None),
        R.Range("Customer", "c_rest", None, None, True), R.Range("Product", "p_mid", 100, 1000),
    ]
    v = X.vertices(t)
    return v.select("id", R.assign_range(_key(v), F.col("label"), spec).alias("part"))


@query("year_partition", f"SELECT id, {VERTEX_YEARS_SQL} AS part FROM ({SQL_ORDER_V})")
def _(t: Tables) -> DataFrame:
    return _by_year(t).select("id", "part")


@query("year_partition_strict", f"""SELECT id, CASE WHEN year({_DAY}) IN (1996, 1997, 1998) THEN 'y' || year({_DAY}) ELSE 'rejected' END AS part
FROM ({SQL_ORDER_V})""")
def _(t: Tables) -> DataFrame:
    placed, refused = R.year_partition_strict(_orders(t), F.col("created_at"), [1996, 1997, 1998])
    return placed.select("id", "part").unionByName(refused.select("id", F.lit("rejected").alias("part")))


@query("id_range_partition", f"""WITH {SQL_V} SELECT id, CASE WHEN k < 0 THEN 'rejected' WHEN k < 1000000 THEN 'id_0'
WHEN k < 2000000 THEN 'id_1000000' ELSE 'id_2000000' END AS part
FROM (SELECT id, ({_KEY} - 5) * 400 AS k FROM v WHERE label = 'Product')""")
def _(t: Tables) -> DataFrame:
    v = X.product_vertices(t)
    placed, refused = R.id_range_partition(v, R.VERTEX_ID_BOUNDS, (_key(v) - 5) * 400)
    return placed.select("id", "part").unionByName(refused.select("id", F.lit("rejected").alias("part")))


@query("property_id_partition", f"""WITH {SQL_V} SELECT id, CASE WHEN k >= 1 AND k < 1000 THEN 'id_1' WHEN k >= 1001 AND k < 2000 THEN 'id_1001'
ELSE 'rejected' END AS part FROM (SELECT id, (props ->> '$.id')::BIGINT AS k FROM v WHERE label = 'Product')""")
def _(t: Tables) -> DataFrame:
    placed, refused = R.property_id_partition(X.product_vertices(t))
    return placed.select("id", "part").unionByName(refused.select("id", F.lit("rejected").alias("part")))


@query("hash_partition", f"""WITH {SQL_V} SELECT 8::BIGINT AS parts, count(*) AS n, true AS even FROM v""")
def _(t: Tables) -> DataFrame:
    """Number of parts, rows in all, and whether no part has more than twice another's share."""
    parts = R.hash_partition(X.vertices(t), 8).groupBy("part").agg(F.count("*").alias("n"))
    return parts.agg(F.count("*").alias("parts"), F.sum("n").alias("n"), (F.max("n") <= 2 * F.min("n")).alias("even"))


@query("fill_missing_date", f"""SELECT id, CASE WHEN list_contains(json_keys(props), 'created_at') THEN props
ELSE json_object('created_at', '2001-06-30', 'id', (props ->> '$.id')::BIGINT, 'status', props ->> '$.status')::VARCHAR END AS props
FROM ({SQL_ORDER_V})""")
def _(t: Tables) -> DataFrame:
    return X.order_vertices(t).select("id", R.fill_missing_date(F.col("props"), "created_at", X.AS_OF).alias("props"))


@query("partition_strategy", f"""WITH {SQL_V}, {SQL_E}, names AS (SELECT DISTINCT label AS name FROM v UNION SELECT DISTINCT label FROM e)
SELECT name, CASE WHEN name IN ('Customer', 'PURCHASED') THEN 'date' WHEN name IN ('Product', 'LOCATED_IN') THEN 'id' ELSE 'none' END AS strategy,
CASE name WHEN 'Customer' THEN 'created_at' WHEN 'PURCHASED' THEN 'start_date' WHEN 'Product' THEN 'id' WHEN 'LOCATED_IN' THEN 'id' END AS "column" FROM names""")
def _(t: Tables) -> DataFrame:
    return R.partition_strategy(t.spark, label_catalog(X.vertices(t), X.edges(t)))


@query("partition_distribution", f"""WITH p AS (SELECT label, {VERTEX_YEARS_SQL} AS part FROM ({SQL_ORDER_V}))
SELECT label, part, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY label), 1)::DOUBLE AS pct,
(sum(count(*)) OVER (PARTITION BY label))::BIGINT AS total FROM p GROUP BY label, part""")
def _(t: Tables) -> DataFrame:
    return R.partition_distribution(_by_year(t))


@query("partition_distribution_empty", f"""WITH p AS (SELECT {VERTEX_YEARS_SQL} AS part FROM ({SQL_ORDER_V})),
d(part) AS (VALUES ('y1999'), ('y2000'), ('y2001'), ('y2002'), ('default')), c AS (SELECT part, count(*) AS n FROM p GROUP BY part),
j AS (SELECT part, coalesce(n, 0) AS n FROM d FULL JOIN c USING (part))
SELECT 'Order' AS label, part, n, round(100.0 * n / sum(n) OVER (), 1)::DOUBLE AS pct, (sum(n) OVER ())::BIGINT AS total FROM j""")
def _(t: Tables) -> DataFrame:
    return R.partition_distribution(_by_year(t), R.spec_frame(t.spark, _order_spec()))


@query("share_of_total", "SELECT event_type, count(*) AS n, round(count(*)::DOUBLE / sum(count(*)) OVER (), 6) AS share FROM events GROUP BY event_type")
def _(t: Tables) -> DataFrame:
    return R.share_of_total(t.events, "event_type")


@query("partition_info", f"""WITH p AS (SELECT {VERTEX_YEARS_SQL} AS part FROM ({SQL_ORDER_V})),
spec(name, lo, hi) AS (VALUES ('y1999','1999-01-01','2000-01-01'), ('y2000','2000-01-01','2001-01-01'), ('y2001','2001-01-01','2002-01-01'),
('y2002','2002-01-01','2003-01-01'), ('default',NULL,NULL)),
c AS (SELECT name, lo, hi, (SELECT count(*) FROM p WHERE part = name) AS n FROM spec)
SELECT 'Order' AS label, string_agg(name || '[' || coalesce(lo, '') || ',' || coalesce(hi, '') || ')=' || n, ' ' ORDER BY name) AS partitions FROM c""")
def _(t: Tables) -> DataFrame:
    info = R.partition_info(_by_year(t), R.spec_frame(t.spark, _order_spec()))
    text = F.transform("partitions", lambda p: F.concat(
        p["name"], F.lit("["), F.coalesce(p["lo"], F.lit("")), F.lit(","), F.coalesce(p["hi"], F.lit("")), F.lit(")="),
        p["n"].cast("string"),
    ))
    return info.select("label", F.array_join(text, " ").alias("partitions"))


# --- life cycle: the spec is the set of years that occur in the data --------

def _spec_from_data(t: Tables) -> DataFrame:
    years = t.orders.select(F.year("o_orderdate").alias("y")).distinct()
    text = F.col("y").cast("string")
    return years.select(
        F.lit("Order").alias("label"), F.concat(F.lit("y"), text).alias("name"), F.concat(text, F.lit("-01-01")).alias("lo"),
        F.concat((F.col("y") + 1).cast("string"), F.lit("-01-01")).alias("hi"), F.lit(False).alias("is_default"),
    )


@query("future_partitions", """WITH have AS (SELECT DISTINCT 'y' || year(o_orderdate) AS name FROM orders),
plan AS (SELECT y FROM (SELECT unnest([2000, 2001, 2002, 2003]) AS y))
SELECT 'Order' AS label, 'y' || y AS name, y || '-01-01' AS lo, (y + 1) || '-01-01' AS hi, false AS is_default
FROM plan WHERE 'y' || y NOT IN (SELECT name FROM have)""")
def _(t: Tables) -> DataFrame:
    return R.future_partitions(_spec_from_data(t), dt.date(1999, 12, 31), years_ahead=4)


@query("expired_partitions", """SELECT DISTINCT 'orders_y' || year(o_orderdate) AS name, year(o_orderdate)::INT AS year,
CASE WHEN year(o_orderdate) < 1998 THEN 'expired' ELSE 'kept' END AS status FROM orders
UNION ALL SELECT DISTINCT 'orders_y' || o_orderstatus, NULL, 'unparsable' FROM orders""")
def _(t: Tables) -> DataFrame:
    names = t.orders.select(F.explode(F.array(
        F.concat(F.lit("orders_y"), F.year("o_orderdate").cast("string")),
        F.concat(F.lit("orders_y"), "o_orderstatus"),
        F.lit("orders_default"),
    )).alias("name")).distinct()
    return R.expired_partitions(names, X.AS_OF)


@query("retention_split", f"""SELECT CASE WHEN year({_DAY}) < 1998 THEN 'archived' ELSE 'kept' END AS side, count(*) AS n FROM ({SQL_ORDER_V}) GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    day = F.col("created_at")
    rows = _orders(t).withColumn("part", F.coalesce(F.concat(F.lit("y"), F.year(day).cast("string")), F.lit(R.DEFAULT)))
    kept, archived = R.retention_split(rows, X.AS_OF)
    return kept.select(F.lit("kept").alias("side")).unionByName(archived.select(F.lit("archived").alias("side"))).groupBy(
        "side"
    ).agg(F.count("*").alias("n"))


@query("range_spec_check", """WITH r AS (SELECT DISTINCT p_brand AS label, p_size AS lo FROM part),
b AS (SELECT label, lo, lo + 2 - (lo + 1) % 3 AS hi FROM r),
m AS (SELECT *, max(hi) OVER (PARTITION BY label ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM b)
SELECT label, CASE WHEN lo < reach THEN 'overlap' ELSE 'gap' END AS kind, least(lo, reach)::VARCHAR AS "from",
(CASE WHEN lo < reach THEN least(hi, reach) ELSE lo END)::VARCHAR AS "to" FROM m WHERE reach IS NOT NULL AND lo <> reach""")
def _(t: Tables) -> DataFrame:
    lo = F.col("p_size")
    spec = t.part.select(
        F.col("p_brand").alias("label"), lo.cast("string").alias("lo"),
        (lo + 2 - (lo + 1) % 3).cast("string").alias("hi"), F.lit(False).alias("is_default"),
    ).distinct()
    return R.range_spec_check(spec)
