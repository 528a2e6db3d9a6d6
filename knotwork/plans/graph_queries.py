"""Labels, properties, look-ups, expansion, counts, layouts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knotwork.functions import properties as P
from knotwork.operators import graph as G
from knotwork.operators.ingest import property_index
from knotwork.plans import fixtures as X
from knotwork.plans.fixtures import SQL_BAD_E, SQL_E, SQL_ORDER_V, SQL_USER_PROPS, SQL_V
from knotwork.plans.registry import Tables, query
from knotwork.session import scratch_path
from knotwork.sources.readers import drop_reserved
from knotwork.sources.writers import write_property_index

DECLARED_SQL = """declared(name, kind) AS (VALUES
('Person','v'),('Company','v'),('Product','v'),('City','v'),('Country','v'),('Employee','v'),('Customer','v'),
('Supplier','v'),('Department','v'),('Project','v'),
('WORKS_AT','e'),('LOCATED_IN','e'),('PURCHASED','e'),('MANUFACTURED_BY','e'),('SUPPLIES','e'))"""
CATALOG_SQL = "catalog AS (SELECT DISTINCT label AS name, 'v' AS kind FROM v UNION SELECT DISTINCT label, 'e' FROM e)"


# --- labels ---------------------------------------------------------------

@query("label_catalog", f"WITH {SQL_V}, {SQL_E}, {CATALOG_SQL} SELECT name, kind FROM catalog")
def _(t: Tables) -> DataFrame:
    return G.label_catalog(X.vertices(t), X.edges(t))


@query("label_check", f"WITH {SQL_V}, {SQL_E}, {CATALOG_SQL}, {DECLARED_SQL} SELECT name, kind FROM catalog "
                      "WHERE (name, kind) NOT IN (SELECT name, kind FROM declared)")
def _(t: Tables) -> DataFrame:
    return G.label_check(G.label_catalog(X.vertices(t), X.edges(t)), G.declared_labels(t.spark))


@query("normalize_label", f"WITH {SQL_V} SELECT lower(label) AS physical_name, count(*) AS n FROM v GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return X.vertices(t).groupBy(G.normalize_label(F.col("label")).alias("physical_name")).agg(F.count("*").alias("n"))


# --- properties -----------------------------------------------------------

@query("props_json", """SELECT o_orderkey, json_object('o_orderdate', strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S'),
       'o_orderkey', o_orderkey, 'o_orderpriority', o_orderpriority)::VARCHAR AS props FROM orders""")
def _(t: Tables) -> DataFrame:
    o = t.orders
    return o.select("o_orderkey", P.props_json(o, ["o_orderkey", "o_orderdate", "o_orderpriority"]).alias("props"))


@query("props_stringified", """SELECT p_partkey, json_object('cheap', CASE WHEN p_retailprice < 1000 THEN 'True' ELSE 'False' END,
       'p_name', p_name, 'p_size', p_size::VARCHAR)::VARCHAR AS props FROM part""")
def _(t: Tables) -> DataFrame:
    p = t.part.withColumn("cheap", F.col("p_retailprice") < 1000)
    return p.select("p_partkey", P.props_stringified(p, ["p_name", "p_size", "cheap"]).alias("props"))


@query("props_typed", """SELECT o_orderkey, json_object('big', o_totalprice > 100000, 'day', strftime(o_orderdate, '%Y-%m-%d'),
       'o_custkey', o_custkey, 'tags', '[' || o_orderstatus || ', ' || o_orderpriority || ']')::VARCHAR AS props FROM orders""")
def _(t: Tables) -> DataFrame:
    o = t.orders.withColumns({
        "day": F.col("o_orderdate").cast("date"),
        "big": F.col("o_totalprice") > 100000,
        "tags": F.array("o_orderstatus", "o_orderpriority"),
    })
    return o.select("o_orderkey", P.props_typed(o, ["o_custkey", "day", "big", "tags"]).alias("props"))


def _sql_quoted(key: str) -> str:
    return f"'{key}: ''' || replace(props ->> '$.{key}', '''', '\\''') || ''''"


def _sql_bare(key: str) -> str:
    return f"'{key}: ' || (props ->> '$.{key}')"


_ID, _NAME = _sql_bare("id"), _sql_quoted("name")


@query("props_literal_text", f"""WITH {SQL_V} SELECT id, CASE label
       WHEN 'Product' THEN concat_ws(', ', {_sql_quoted('brand')}, {_ID}, {_NAME}, {_sql_bare('size')})
       WHEN 'Customer' THEN concat_ws(', ', {_ID}, {_NAME}, {_sql_quoted('segment')})
       WHEN 'Order' THEN concat_ws(', ', {_sql_quoted('created_at')}, {_ID}, {_sql_quoted('status')})
       ELSE concat_ws(', ', {_ID}, {_NAME}) END AS literal FROM v""")
def _(t: Tables) -> DataFrame:
    return X.vertices(t).select("id", P.props_literal_text(F.col("props")).alias("literal"))


@query("prop_get", "SELECT event_id, (props ->> '$.k')::BIGINT AS k FROM events")
def _(t: Tables) -> DataFrame:
    return t.events.select("event_id", P.prop_get(F.col("props"), "k").cast("bigint").alias("k"))


@query("prop_exists", f"SELECT id, list_contains(json_keys(props), 'created_at') AS dated FROM ({SQL_ORDER_V})")
def _(t: Tables) -> DataFrame:
    return X.order_vertices(t).select("id", P.prop_exists(F.col("props"), "created_at").alias("dated"))


@query("prop_set", f"""WITH {SQL_V} SELECT id, CASE
       WHEN label = 'Customer' THEN json_object('id', (props ->> '$.id')::BIGINT, 'name', 'renamed', 'segment', props ->> '$.segment')
       WHEN label = 'Product' THEN json_object('brand', props ->> '$.brand', 'id', (props ->> '$.id')::BIGINT, 'name', 'renamed', 'size', (props ->> '$.size')::INT)
       WHEN label = 'Order' AND props ->> '$.created_at' IS NOT NULL THEN json_object('created_at', props ->> '$.created_at',
            'id', (props ->> '$.id')::BIGINT, 'name', 'renamed', 'status', props ->> '$.status')
       WHEN label = 'Order' THEN json_object('id', (props ->> '$.id')::BIGINT, 'name', 'renamed', 'status', props ->> '$.status')
       ELSE json_object('id', (props ->> '$.id')::BIGINT, 'name', 'renamed') END::VARCHAR AS props FROM v""")
def _(t: Tables) -> DataFrame:
    return X.vertices(t).select("id", P.prop_set(F.col("props"), "name", F.lit("renamed")).alias("props"))


@query("prop_date", f"SELECT id, strftime(try_cast(props ->> '$.created_at' AS DATE), '%Y-%m-%d') AS created_at FROM ({SQL_ORDER_V})")
def _(t: Tables) -> DataFrame:
    return X.order_vertices(t).select("id", P.prop_date(F.col("props"), "created_at").cast("string").alias("created_at"))


@query("format_created_at", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS created_at FROM events")
def _(t: Tables) -> DataFrame:
    return t.events.select("event_id", P.format_created_at(F.col("ts")).alias("created_at"))


@query("props_explode", f"""WITH {SQL_V}, k AS (SELECT id, props, unnest(json_keys(props)) AS key FROM v)
       SELECT id, key, json_extract_string(props, '$.' || key) AS value, key = 'name' AS matched FROM k""")
def _(t: Tables) -> DataFrame:
    return P.props_explode(X.vertices(t).select("id", "props"), "name")


@query("display_label", f"WITH {SQL_V} SELECT id, coalesce(nullif(props ->> '$.name', ''), nullif(props ->> '$.id', ''), '') AS display FROM v")
def _(t: Tables) -> DataFrame:
    return X.vertices(t).select("id", P.display_label(F.col("props")).alias("display"))


# --- look-ups -------------------------------------------------------------

@query("match_label_project", f"SELECT props ->> '$.created_at' AS created_at, props ->> '$.status' AS status FROM ({SQL_ORDER_V})")
def _(t: Tables) -> DataFrame:
    return G.match_label_project(X.vertices(t), "Order", "created_at", "status")


@query("match_props", f"WITH {SQL_V} SELECT id, props FROM v WHERE label = 'Customer' AND props ->> '$.segment' = 'BUILDING'")
def _(t: Tables) -> DataFrame:
    return G.match_props(X.vertices(t), "Customer", segment="BUILDING").select("id", "props")


@query("search_property", f"""WITH {SQL_V} SELECT id, props FROM v WHERE label = 'Product' AND props ->> '$.size' = '7'
       ORDER BY id LIMIT 10""")
def _(t: Tables) -> DataFrame:
    return G.search_property(X.vertices(t), "Product", "size", 7, limit=10).select("id", "props")


def _stored_index(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "property-index")
    write_property_index(property_index(X.vertices(t)), path)
    return t.spark.read.parquet(path)


@query("match_props_indexed", f"""WITH {SQL_V} SELECT id, props FROM v WHERE label = 'Product' AND props ->> '$.size' = '7'
       AND props ->> '$.brand' = 'Brand#11'""")
def _(t: Tables) -> DataFrame:
    return G.match_props(X.vertices(t), "Product", _stored_index(t), size=7, brand="Brand#11").select("id", "props")


@query("search_property_indexed", f"""WITH {SQL_V} SELECT id, props FROM v WHERE label = 'Product' AND props ->> '$.size' = '7'
       ORDER BY id LIMIT 10""")
def _(t: Tables) -> DataFrame:
    return G.search_property(X.vertices(t), "Product", "size", 7, 10, _stored_index(t)).select("id", "props")


@query("range_scan", f"""SELECT id, props FROM ({SQL_ORDER_V}) WHERE props ->> '$.created_at' >= '1997-03-01'
       AND props ->> '$.created_at' < '1998-02-01'""")
def _(t: Tables) -> DataFrame:
    v = G.promoted_key(X.order_vertices(t), "created_at", "date")
    return G.range_scan(v, "Order", "created_at", dt.date(1997, 3, 1), dt.date(1998, 2, 1)).select("id", "props")


@query("table_page", f"""WITH {SQL_V} SELECT id, props, (SELECT count(*) FROM v WHERE label = 'Customer') AS total
       FROM v WHERE label = 'Customer' ORDER BY id LIMIT 10""")
def _(t: Tables) -> DataFrame:
    return G.table_page(X.vertices(t), "Customer", 10).select("id", "props", "total")


@query("sample_rows", f"WITH {SQL_V} SELECT id, props FROM v WHERE label = 'Supplier' ORDER BY id LIMIT 5")
def _(t: Tables) -> DataFrame:
    return G.sample_rows(X.vertices(t), "Supplier", 5).select("id", "props")


@query("match_all", f"WITH {SQL_V} SELECT label, id, external_id, props FROM v")
def _(t: Tables) -> DataFrame:
    return G.match_all(X.vertices(t))


@query("drop_reserved", f"WITH {SQL_E} SELECT label, props FROM e")
def _(t: Tables) -> DataFrame:
    return drop_reserved(X.edges(t), ["start_id", "end_id", "start_label", "end_label", "absent"])


@query("order_by_id_limit", f"WITH {SQL_V} SELECT label, id FROM v ORDER BY id LIMIT 25")
def _(t: Tables) -> DataFrame:
    return G.order_by_id_limit(X.vertices(t).select("label", "id"), 25)


# --- expansion ------------------------------------------------------------

@query("edge_expand", f"""WITH {SQL_V}, {SQL_E} SELECT e.label, s.label AS s_label, s.props AS s_props, d.label AS e_label,
       d.props AS e_props, e.props FROM e JOIN v s ON s.id = e.start_id JOIN v d ON d.id = e.end_id""")
def _(t: Tables) -> DataFrame:
    expanded = G.edge_expand(X.edges(t), X.vertices(t))
    return expanded.select("label", "s_label", "s_props", "e_label", "e_props", "props")


@query("undirected", f"""WITH {SQL_E}, u AS (SELECT start_id AS node, end_id AS neighbor FROM e UNION ALL SELECT end_id, start_id FROM e)
       SELECT node, count(*) AS incident, count(DISTINCT neighbor) AS neighbors FROM u GROUP BY node""")
def _(t: Tables) -> DataFrame:
    return G.incident_counts(X.edges(t))


@query("dangling_edges", f"""WITH {SQL_V}, {SQL_BAD_E} SELECT e.label, e.start_id, e.end_id, e.props FROM e
       WHERE start_id NOT IN (SELECT id FROM v) OR end_id NOT IN (SELECT id FROM v)""")
def _(t: Tables) -> DataFrame:
    return G.dangling_edges(X.edges_with_dangling(t), X.vertices(t)).select("label", "start_id", "end_id", "props")


# --- counts ---------------------------------------------------------------

@query("vertex_counts", f"WITH {SQL_V} SELECT label, count(*) AS n FROM v GROUP BY label ORDER BY label")
def _(t: Tables) -> DataFrame:
    return G.vertex_counts(X.vertices(t))


@query("edge_counts", f"WITH {SQL_E} SELECT label, count(*) AS n FROM e GROUP BY label ORDER BY label")
def _(t: Tables) -> DataFrame:
    return G.edge_counts(X.edges(t))


@query("graph_stats", f"""WITH {SQL_V}, {SQL_E} SELECT 'vertices_' || label AS name, count(*) AS n FROM v GROUP BY 1
       UNION ALL SELECT 'edges_' || label, count(*) FROM e GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    return G.graph_stats(X.vertices(t), X.edges(t))


@query("row_count", "SELECT count(*) AS n FROM lineitem")
def _(t: Tables) -> DataFrame:
    return G.row_count(t.lineitem)


# --- layouts --------------------------------------------------------------

@query("property_index", f"""WITH {SQL_V}, k AS (SELECT label, id, props, unnest(json_keys(props)) AS key FROM v)
       SELECT label, key, json_extract(props, '$.' || key)::VARCHAR AS value,
       json_extract_string(props, '$.' || key) AS value_text, id FROM k""")
def _(t: Tables) -> DataFrame:
    return property_index(X.vertices(t))


@query("promoted_key", f"WITH {SQL_V} SELECT label, id, props ->> '$.name' AS name FROM v")
def _(t: Tables) -> DataFrame:
    return G.promoted_key(X.vertices(t), "name").select("label", "id", "name")


@query("adjacency", f"""WITH {SQL_E}, c AS (SELECT start_id AS id, end_id AS other, count(*) AS n FROM e GROUP BY ALL)
       SELECT id, other >> 12 AS block, string_agg(other || 'x' || n, ',' ORDER BY other) AS neighbors FROM c GROUP BY ALL""")
def _(t: Tables) -> DataFrame:
    text = F.transform("neighbors", lambda x: F.concat(x["id"].cast("string"), F.lit("x"), x["n"].cast("string")))
    return G.adjacency(X.edges(t), "out").select("id", "block", F.array_join(text, ",").alias("neighbors"))


@query("adjacency_text", f"""WITH {SQL_E} SELECT 'v' || start_id AS id, 'v' || end_id AS other, count(*) AS n FROM e GROUP BY ALL""")
def _(t: Tables) -> DataFrame:
    """Lists of text ids; their blocks are by hash, so the entries are compared."""
    named = X.edges(t).select(*[F.concat(F.lit("v"), F.col(c).cast("string")).alias(c) for c in ("start_id", "end_id")])
    return G.adjacency(named, "out").select("id", F.inline("neighbors").alias("other", "n"))


@query("neighbor_sets", f"""WITH {SQL_USER_PROPS}, d AS (SELECT node, count(*) AS degree FROM up GROUP BY node)
       SELECT node, neighbor >> 12 AS block, string_agg(neighbor, ',' ORDER BY neighbor) AS neighbors, any_value(degree) AS degree
       FROM up JOIN d USING (node) GROUP BY node, block""")
def _(t: Tables) -> DataFrame:
    sets = G.neighbor_sets(X.user_props(t))
    return sets.select("node", "block", F.array_join(F.col("neighbors").cast("array<string>"), ",").alias("neighbors"), "degree")
