"""Graph- and person-shaped tables derived from the test tables.

Each fixture exists twice: as DataFrame code and, below, as SQL text for the
oracle. Neither is generated from the other.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knotwork.functions.properties import prop_get
from knotwork.model import graph_id
from knotwork.operators.transcripts import FENCE
from knotwork.plans.registry import Tables

AS_OF = dt.date(2001, 6, 30)
CUSTOMER, SUPPLIER, PRODUCT, COUNTRY, REGION, ORDER = range(1, 7)


def _vertex(df: DataFrame, label: str, number: int, key: str, **props: str) -> DataFrame:
    fields = [F.col(c).alias(name) for name, c in sorted(props.items())]
    return df.select(
        F.lit(label).alias("label"),
        graph_id(number, F.col(key)).alias("id"),
        F.col(key).cast("string").alias("external_id"),
        F.to_json(F.struct(*fields)).alias("props"),
    )


def order_rows(t: Tables) -> DataFrame:
    """Orders with the creation date, left out for every tenth order."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return t.orders.withColumn("created_at", F.when(F.col("o_orderkey") % 10 != 0, day))


def order_vertices(t: Tables) -> DataFrame:
    return _vertex(order_rows(t), "Order", ORDER, "o_orderkey", id="o_orderkey", status="o_orderstatus", created_at="created_at")


def customer_vertices(t: Tables) -> DataFrame:
    return _vertex(t.customer, "Customer", CUSTOMER, "c_custkey", id="c_custkey", name="c_name", segment="c_mktsegment")


def product_vertices(t: Tables) -> DataFrame:
    return _vertex(t.part, "Product", PRODUCT, "p_partkey", id="p_partkey", name="p_name", brand="p_brand", size="p_size")


def vertices(t: Tables) -> DataFrame:
    return (
        customer_vertices(t)
        .unionByName(_vertex(t.supplier, "Supplier", SUPPLIER, "s_suppkey", id="s_suppkey", name="s_name"))
        .unionByName(product_vertices(t))
        .unionByName(_vertex(t.nation, "Country", COUNTRY, "n_nationkey", id="n_nationkey", name="n_name"))
        .unionByName(_vertex(t.region, "Region", REGION, "r_regionkey", id="r_regionkey", name="r_name"))
        .unionByName(order_vertices(t))
    )


def _edge(df: DataFrame, label: str, start: tuple[str, int, str], end: tuple[str, int, str], **props) -> DataFrame:
    fields = [c.alias(name) for name, c in sorted(props.items())]
    return df.select(
        F.lit(label).alias("label"),
        F.lit(start[0]).alias("start_label"), graph_id(start[1], F.col(start[2])).alias("start_id"),
        F.lit(end[0]).alias("end_label"), graph_id(end[1], F.col(end[2])).alias("end_id"),
        (F.to_json(F.struct(*fields)) if fields else F.lit("{}")).alias("props"),
    )


def placed(t: Tables) -> DataFrame:
    return _edge(
        t.orders, "PLACED", ("Customer", CUSTOMER, "o_custkey"), ("Order", ORDER, "o_orderkey"),
        start_date=F.date_format("o_orderdate", "yyyy-MM-dd"),
    )


def edges(t: Tables) -> DataFrame:
    order_day = F.date_format("o_orderdate", "yyyy-MM-dd")
    bought = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    country = ("Country", COUNTRY)
    return (
        placed(t)
        .unionByName(_edge(
            t.lineitem, "CONTAINS", ("Order", ORDER, "l_orderkey"), ("Product", PRODUCT, "l_partkey"),
            line=F.col("l_linenumber"), quantity=F.col("l_quantity").cast("bigint"),
        ))
        .unionByName(_edge(
            bought, "PURCHASED", ("Customer", CUSTOMER, "o_custkey"), ("Product", PRODUCT, "l_partkey"),
            start_date=order_day,
        ))
        .unionByName(_edge(
            t.lineitem.select("l_suppkey", "l_partkey").distinct(), "SUPPLIES",
            ("Supplier", SUPPLIER, "l_suppkey"), ("Product", PRODUCT, "l_partkey"),
        ))
        .unionByName(_edge(t.customer, "LOCATED_IN", ("Customer", CUSTOMER, "c_custkey"), (*country, "c_nationkey")))
        .unionByName(_edge(t.supplier, "LOCATED_IN", ("Supplier", SUPPLIER, "s_suppkey"), (*country, "s_nationkey")))
        .unionByName(_edge(t.nation, "LOCATED_IN", (*country, "n_nationkey"), ("Region", REGION, "n_regionkey")))
    )


def edges_with_dangling(t: Tables) -> DataFrame:
    """Order edges; every hundredth points to a customer that does not exist."""
    broken = t.orders.withColumn(
        "o_custkey", F.when(F.col("o_orderkey") % 100 == 0, F.col("o_custkey") + 1_000_000_000).otherwise(F.col("o_custkey"))
    )
    return _edge(
        broken, "PLACED", ("Customer", CUSTOMER, "o_custkey"), ("Order", ORDER, "o_orderkey"),
        start_date=F.date_format("o_orderdate", "yyyy-MM-dd"),
    )


def user_props(t: Tables) -> DataFrame:
    """Users and the property values they used, as (node, neighbor)."""
    return t.events.select(
        F.col("user_id").alias("node"), prop_get(F.col("props"), "k").cast("bigint").alias("neighbor")
    )


def customer_parts(t: Tables) -> DataFrame:
    return t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_custkey").alias("node"), F.col("l_partkey").alias("neighbor")
    )


# Name parts of the messy people.
LAST_HEADS = ["Ander", "Bal", "Car", "Dur", "Ells", "Fos", "Gra", "Hol", "Ive", "Jen", "Kel"]
LAST_TAILS = ["son", "ton", "berg", "man", "ley", "worth", "field"]
FIRST_NAMES = [
    "John", "Jon", "Mary", "Maria", "Alice", "Robert", "Bob", "Chen", "Ravi", "Fatima", "Olga", "Pedro", "Nina",
]
BUSINESSES = ["Retail", "Bakery", "Clinic", "Garage", "School"]
NEW_ID = 1_000_000_000_000
STRANGER = 1_000_000_007


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _person(df: DataFrame, *keep: str) -> DataFrame:
    """Person fields from the key column ``k``."""
    k = F.col("k")
    return df.select(
        "id", *keep,
        F.concat(_pick(LAST_HEADS, k % 11), _pick(LAST_TAILS, F.floor(k / 11) % 7)).alias("last_name"),
        _pick(FIRST_NAMES, k % 13).alias("first_name"),
        F.lpad((k * 7919 % 100000).cast("string"), 5, "0").alias("zip"),
        F.concat(F.lit("555-"), F.lpad((k * 104729 % 10000000).cast("string"), 7, "0")).alias("phone"),
        F.concat(F.lit("h"), F.floor(k / 2).cast("string"), F.lit("@mail.test")).alias("email"),
        _pick(BUSINESSES, k % 5).alias("business"),
    )


def people(t: Tables) -> DataFrame:
    """Existing customers as person records."""
    return _person(t.customer.select(F.col("c_custkey").alias("id"), F.col("c_custkey").alias("k")))


def applicants(t: Tables) -> DataFrame:
    """Every customer applies again: exact, typo, initial, fields missing, or somebody else."""
    k = F.col("c_custkey")
    chosen = t.customer.select(
        (k + NEW_ID).alias("id"), F.when(k % 5 == 4, k + STRANGER).otherwise(k).alias("k"), (k % 5).alias("kind")
    )
    kind = F.col("kind")
    return _person(chosen, "kind").select(
        "id",
        F.when(kind == 1, F.expr("substr(last_name, 1, length(last_name) - 1)")).otherwise(F.col("last_name")).alias("last_name"),
        F.when(kind == 2, F.concat(F.substring("first_name", 1, 1), F.lit("."))).otherwise(F.col("first_name")).alias("first_name"),
        F.when(kind != 3, F.col("zip")).alias("zip"),
        F.when(kind != 3, F.col("phone")).alias("phone"),
        "email", "business",
    )


def with_block_keys(persons: DataFrame) -> DataFrame:
    """Blocking key: three letters of the last name with three zip digits."""
    block = F.concat(F.lower(F.substring("last_name", 1, 3)), F.substring("zip", 1, 3))
    return persons.withColumn("name_zip", block)


def identifiers(persons: DataFrame) -> DataFrame:
    """Identifiers of a person as (node, neighbor): phone, email, last name with zip, business."""
    return persons.select(
        F.col("id").alias("node"),
        F.explode(F.array_compact(F.array(
            F.concat(F.lit("p:"), "phone"), F.concat(F.lit("e:"), "email"),
            F.concat(F.lit("n:"), "last_name", F.lit("/"), "zip"), F.concat(F.lit("b:"), "business"),
        ))).alias("neighbor"),
    )


def customer_links(t: Tables) -> DataFrame:
    """Chains of three customers out of every four keys, as (a, b)."""
    k = F.col("c_custkey")
    return t.customer.filter(k % 4 < 2).select(k.alias("a"), (k + 1).alias("b")).join(
        t.customer.select(k.alias("b")), "b", "left_semi"
    ).select("a", "b")


def chat(t: Tables) -> DataFrame:
    """Conversations with stop words, fenced code, failed and repeated runs and usage notes, some twice in a message, put in by rule."""
    fence = F.lit(f"\n{FENCE}python\nprint(1)\n{FENCE}\nthen\n{FENCE}sh\nls\n{FENCE}")
    conv, turn = F.col("conv_id"), F.col("turn")
    code = F.when(conv % 10 == 0, F.lit("1, again\nexit code: 0")).otherwise(F.lit("0"))
    usage = F.concat(
        F.lit("\nprompt_tokens="), (F.length("text") + conv % 7).cast("string"),
        F.lit(" completion_tokens="), (turn * 10 + conv % 5).cast("string"),
        F.when(conv % 4 == 0, F.lit("\nprompt_tokens=11 completion_tokens=13")).otherwise(F.lit("")),
    )
    nothing = F.lit("")
    return t.conversations.select(
        "conv_id", "turn", "role",
        F.concat(
            "text",
            F.when(turn % 4 == 1, fence).otherwise(nothing),
            F.when((conv % 5 == 0) & (turn == 3), F.concat(F.lit("\nexit code: "), code)).otherwise(nothing),
            F.when(F.col("role") == "assistant", usage).otherwise(nothing),
            F.when((conv % 3 == 0) & (turn == 2), F.lit(" STOP")).otherwise(nothing),
        ).alias("text"),
    )


# --- the same fixtures as SQL ---------------------------------------------

def _sql_list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


SQL_ORDER_V = """
SELECT 'Order' AS label, (6::BIGINT << 48) + o_orderkey AS id, o_orderkey::VARCHAR AS external_id,
       CASE WHEN o_orderkey % 10 = 0 THEN json_object('id', o_orderkey, 'status', o_orderstatus)
            ELSE json_object('created_at', strftime(o_orderdate, '%Y-%m-%d'), 'id', o_orderkey, 'status', o_orderstatus)
       END::VARCHAR AS props FROM orders"""

SQL_V = f"""v AS (
SELECT 'Customer' AS label, (1::BIGINT << 48) + c_custkey AS id, c_custkey::VARCHAR AS external_id,
       json_object('id', c_custkey, 'name', c_name, 'segment', c_mktsegment)::VARCHAR AS props FROM customer
UNION ALL SELECT 'Supplier', (2::BIGINT << 48) + s_suppkey, s_suppkey::VARCHAR,
       json_object('id', s_suppkey, 'name', s_name)::VARCHAR FROM supplier
UNION ALL SELECT 'Product', (3::BIGINT << 48) + p_partkey, p_partkey::VARCHAR,
       json_object('brand', p_brand, 'id', p_partkey, 'name', p_name, 'size', p_size)::VARCHAR FROM part
UNION ALL SELECT 'Country', (4::BIGINT << 48) + n_nationkey, n_nationkey::VARCHAR,
       json_object('id', n_nationkey, 'name', n_name)::VARCHAR FROM nation
UNION ALL SELECT 'Region', (5::BIGINT << 48) + r_regionkey, r_regionkey::VARCHAR,
       json_object('id', r_regionkey, 'name', r_name)::VARCHAR FROM region
UNION ALL {SQL_ORDER_V})"""

SQL_E = """e AS (
SELECT 'PLACED' AS label, 'Customer' AS start_label, (1::BIGINT << 48) + o_custkey AS start_id,
       'Order' AS end_label, (6::BIGINT << 48) + o_orderkey AS end_id,
       json_object('start_date', strftime(o_orderdate, '%Y-%m-%d'))::VARCHAR AS props FROM orders
UNION ALL SELECT 'CONTAINS', 'Order', (6::BIGINT << 48) + l_orderkey, 'Product', (3::BIGINT << 48) + l_partkey,
       json_object('line', l_linenumber, 'quantity', l_quantity::BIGINT)::VARCHAR FROM lineitem
UNION ALL SELECT 'PURCHASED', 'Customer', (1::BIGINT << 48) + o_custkey, 'Product', (3::BIGINT << 48) + l_partkey,
       json_object('start_date', strftime(o_orderdate, '%Y-%m-%d'))::VARCHAR
       FROM orders JOIN lineitem ON o_orderkey = l_orderkey
UNION ALL SELECT 'SUPPLIES', 'Supplier', (2::BIGINT << 48) + l_suppkey, 'Product', (3::BIGINT << 48) + l_partkey, '{}'
       FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem)
UNION ALL SELECT 'LOCATED_IN', 'Customer', (1::BIGINT << 48) + c_custkey, 'Country', (4::BIGINT << 48) + c_nationkey, '{}' FROM customer
UNION ALL SELECT 'LOCATED_IN', 'Supplier', (2::BIGINT << 48) + s_suppkey, 'Country', (4::BIGINT << 48) + s_nationkey, '{}' FROM supplier
UNION ALL SELECT 'LOCATED_IN', 'Country', (4::BIGINT << 48) + n_nationkey, 'Region', (5::BIGINT << 48) + n_regionkey, '{}' FROM nation)"""

SQL_BAD_E = """e AS (
SELECT 'PLACED' AS label, 'Customer' AS start_label,
       (1::BIGINT << 48) + o_custkey + CASE WHEN o_orderkey % 100 = 0 THEN 1000000000 ELSE 0 END AS start_id,
       'Order' AS end_label, (6::BIGINT << 48) + o_orderkey AS end_id,
       json_object('start_date', strftime(o_orderdate, '%Y-%m-%d'))::VARCHAR AS props FROM orders)"""

SQL_USER_PROPS = """up AS (
SELECT DISTINCT user_id AS node, (props ->> '$.k')::BIGINT AS neighbor FROM events)"""

SQL_CUSTOMER_PARTS = """cp AS (
SELECT DISTINCT o_custkey AS node, l_partkey AS neighbor FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"""


def _sql_person(source: str, extra: str = "") -> str:
    return f"""SELECT id{extra},
  {_sql_list(LAST_HEADS)}[1 + k % 11] || {_sql_list(LAST_TAILS)}[1 + (k // 11) % 7] AS last_name,
  {_sql_list(FIRST_NAMES)}[1 + k % 13] AS first_name,
  lpad((k * 7919 % 100000)::VARCHAR, 5, '0') AS zip,
  '555-' || lpad((k * 104729 % 10000000)::VARCHAR, 7, '0') AS phone,
  'h' || (k // 2) || '@mail.test' AS email,
  {_sql_list(BUSINESSES)}[1 + k % 5] AS business
  FROM ({source})"""


SQL_PEOPLE = f"people AS ({_sql_person('SELECT c_custkey AS id, c_custkey AS k FROM customer')})"

_APPLICANT_KEYS = (
    "SELECT c_custkey + 1000000000000 AS id, CASE WHEN c_custkey % 5 = 4 THEN c_custkey + 1000000007 "
    "ELSE c_custkey END AS k, c_custkey % 5 AS kind FROM customer"
)

SQL_APPLICANTS = f"""applicants AS (
SELECT id,
  CASE WHEN kind = 1 THEN substr(last_name, 1, length(last_name) - 1) ELSE last_name END AS last_name,
  CASE WHEN kind = 2 THEN substr(first_name, 1, 1) || '.' ELSE first_name END AS first_name,
  CASE WHEN kind <> 3 THEN zip END AS zip,
  CASE WHEN kind <> 3 THEN phone END AS phone, email, business
FROM ({_sql_person(_APPLICANT_KEYS, ", kind")}))"""


def sql_identifiers(name: str, persons: str) -> str:
    return f"""{name} AS (
SELECT id AS node, 'p:' || phone AS neighbor FROM {persons} WHERE phone IS NOT NULL
UNION ALL SELECT id, 'e:' || email FROM {persons}
UNION ALL SELECT id, 'n:' || last_name || '/' || zip FROM {persons} WHERE zip IS NOT NULL
UNION ALL SELECT id, 'b:' || business FROM {persons})"""


SQL_LINKS = """links AS (
SELECT c_custkey AS a, c_custkey + 1 AS b FROM customer
WHERE c_custkey % 4 < 2 AND c_custkey + 1 IN (SELECT c_custkey FROM customer))"""

SQL_CHAT = """chat AS (
SELECT conv_id, turn, role, text
  || CASE WHEN turn % 4 = 1 THEN chr(10) || '```python' || chr(10) || 'print(1)' || chr(10) || '```' || chr(10) || 'then'
     || chr(10) || '```sh' || chr(10) || 'ls' || chr(10) || '```' ELSE '' END
  || CASE WHEN conv_id % 5 = 0 AND turn = 3 THEN chr(10) || 'exit code: ' || CASE WHEN conv_id % 10 = 0 THEN '1, again' || chr(10) || 'exit code: 0' ELSE '0' END ELSE '' END
  || CASE WHEN role = 'assistant' THEN chr(10) || 'prompt_tokens=' || (length(text) + conv_id % 7)
     || ' completion_tokens=' || (turn * 10 + conv_id % 5)
     || CASE WHEN conv_id % 4 = 0 THEN chr(10) || 'prompt_tokens=11 completion_tokens=13' ELSE '' END ELSE '' END
  || CASE WHEN conv_id % 3 = 0 AND turn = 2 THEN ' STOP' ELSE '' END AS text
FROM conversations)"""
