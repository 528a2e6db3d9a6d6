"""Readers, writers, id resolution and merging."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knotwork.functions.properties import prop_date
from knotwork.operators import ingest as I
from knotwork.operators import partitions as R
from knotwork.operators.graph import partition_scan, range_scan
from knotwork.operators.property_index import PropertyIndex
from knotwork.operators.similarity import node_similarity
from knotwork.plans import fixtures as X
from knotwork.plans.fixtures import SQL_BAD_E, SQL_ORDER_V, SQL_USER_PROPS, SQL_V
from knotwork.plans.registry import Tables, query
from knotwork.session import scratch_path
from knotwork.sources import readers as S
from knotwork.sources import writers as W
from knotwork.sources.clustered import ClusteredTable
from knotwork.sources.snapshots import SnapshotTable
from knotwork.streaming.flows import file_feed, reingest_edges, reingest_vertices


# --- readers --------------------------------------------------------------

@query("read_vertex_csv", """
SELECT 'Customer' AS label, c_custkey::VARCHAR AS external_id,
       json_object('c_mktsegment', c_mktsegment, 'c_name', c_name, 'c_nationkey', c_nationkey)::VARCHAR AS props FROM customer
UNION ALL SELECT 'Supplier', s_suppkey::VARCHAR, json_object('s_name', s_name)::VARCHAR FROM supplier""")
def _(t: Tables) -> DataFrame:
    files = {"Customer": scratch_path(t.spark, "csv"), "Supplier": scratch_path(t.spark, "csv")}
    t.customer.select(F.col("c_custkey").alias("id"), "c_name", "c_mktsegment", "c_nationkey").write.csv(
        files["Customer"], header=True
    )
    t.supplier.select(F.col("s_suppkey").alias("id"), "s_name").write.csv(files["Supplier"], header=True)
    return S.read_vertex_csv(t.spark, files, infer_types=True)


@query("read_edge_csv", """
SELECT 'PLACED' AS label, 'Customer' AS start_label, o_custkey::VARCHAR AS start_ref, 'Order' AS end_label,
       o_orderkey::VARCHAR AS end_ref,
       json_object('o_orderpriority', o_orderpriority, 'o_orderstatus', o_orderstatus)::VARCHAR AS props FROM orders
UNION ALL SELECT 'LOCATED_IN', NULL, n_nationkey::VARCHAR, NULL, n_regionkey::VARCHAR, '{}' FROM nation""")
def _(t: Tables) -> DataFrame:
    files = {"PLACED": scratch_path(t.spark, "csv"), "LOCATED_IN": scratch_path(t.spark, "csv")}
    t.orders.select(
        F.col("o_custkey").alias("start_id"), F.col("o_orderkey").alias("end_id"),
        F.lit("Customer").alias("start_label"), F.lit("Order").alias("end_label"), "o_orderstatus", "o_orderpriority",
    ).write.csv(files["PLACED"], header=True)
    t.nation.select(F.col("n_nationkey").alias("start_id"), F.col("n_regionkey").alias("end_id")).write.csv(
        files["LOCATED_IN"], header=True
    )
    return S.read_edge_csv(t.spark, files)


def _documents(t: Tables) -> str:
    """One document per order: the order and a placeholder of its customer, and the edge between them."""
    path = scratch_path(t.spark, "documents")
    key, customer = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    order_props = F.struct(F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("id"))
    vertex = F.struct(F.lit("Order").alias("label"), key.alias("external_id"), order_props.alias("properties"))
    edge = F.struct(
        F.lit("PLACED").alias("label"), customer.alias("start_vertex_id"), F.lit("Customer").alias("start_vertex_label"),
        (F.col("o_orderkey") + 7).alias("end_vertex_id"), F.struct(F.col("o_orderpriority").alias("priority")).alias("properties"),
    )
    t.orders.select(F.array(vertex).alias("vertices"), F.array(edge).alias("edges")).write.json(path)
    return path


@query("read_graph_document", """
SELECT 'v' AS kind, 'Order' AS label, o_orderkey::VARCHAR AS ref, NULL::BIGINT AS end_id,
       json_object('id', o_orderkey, 'status', o_orderstatus)::VARCHAR AS props FROM orders
UNION ALL SELECT 'e', 'PLACED', o_custkey::VARCHAR, o_orderkey + 7, json_object('priority', o_orderpriority)::VARCHAR FROM orders""")
def _(t: Tables) -> DataFrame:
    v, e = S.read_graph_document(t.spark, _documents(t), multi_line=False)
    vertices = v.select(F.lit("v").alias("kind"), "label", F.col("external_id").alias("ref"),
                        F.lit(None).cast("bigint").alias("end_id"), "props")
    return vertices.unionByName(e.select(F.lit("e").alias("kind"), "label", F.col("start_ref").alias("ref"), "end_id", "props"))


def _sql_digest(label: str, props: str) -> str:
    return f"sha256({label} || chr(31) || {props})"


_NAME_C, _NAME_N = "json_object('name', c_name)::VARCHAR", "json_object('name', n_name)::VARCHAR"


@query("read_triplets3", f"""
SELECT 'LIVES_IN' AS label, {_sql_digest("'Customer'", _NAME_C)} AS start_id, {_sql_digest("'Country'", _NAME_N)} AS end_id
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def _(t: Tables) -> DataFrame:
    feed = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_name").alias("subject"), F.lit("LIVES_IN").alias("predicate"), F.col("n_name").alias("object")
    )
    _, edges = S.read_triplets3(feed, F.lit("Customer"), F.lit("Country"))
    return edges.select("label", "start_id", "end_id")


def _purchases(t: Tables) -> DataFrame:
    bought = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).join(
        t.part, F.col("l_partkey") == F.col("p_partkey")
    ).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    text = F.col("c_custkey").cast("string")
    return bought.select(
        F.lit("Customer").alias("s_label"),
        F.to_json(F.struct(text.alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))).alias("s_props"),
        F.lit("PURCHASED").alias("predicate"),
        F.to_json(F.struct(F.col("l_quantity").cast("bigint").alias("quantity"), (F.col("l_tax") == 0).alias("tax_free"))).alias("e_props"),
        F.lit("Product").alias("o_label"),
        F.to_json(F.struct(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"))).alias("o_props"),
    )


_BOUGHT = """bought AS (SELECT * FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey
JOIN customer ON o_custkey = c_custkey)"""


@query("read_triplets5", f"""WITH {_BOUGHT}, ends AS (
SELECT 'Customer' AS label, json_object('id', c_custkey::VARCHAR, 'name', c_name)::VARCHAR AS props FROM bought
UNION SELECT 'Product', json_object('id', p_partkey::VARCHAR, 'name', p_name)::VARCHAR FROM bought)
SELECT label, {_sql_digest('label', 'props')} AS id, props FROM ends""")
def _(t: Tables) -> DataFrame:
    vertices, _ = S.read_triplets5(_purchases(t).drop("e_props"))
    return vertices


@query("read_triplets6", f"""WITH {_BOUGHT} SELECT 'PURCHASED' AS label,
{_sql_digest("'Customer'", "json_object('id', c_custkey::VARCHAR, 'name', c_name, 'segment', c_mktsegment)::VARCHAR")} AS start_id,
{_sql_digest("'Product'", "json_object('id', p_partkey::VARCHAR, 'name', p_name)::VARCHAR")} AS end_id,
json_object('quantity', l_quantity::BIGINT, 'tax_free', l_tax = 0)::VARCHAR AS props FROM bought""")
def _(t: Tables) -> DataFrame:
    _, edges = S.read_triplets6(_purchases(t))
    return edges.select("label", "start_id", "end_id", "props")


@query("split_elements", "SELECT 'vertex' AS kind, count(*) AS n FROM customer UNION ALL SELECT 'edge', count(*) FROM orders")
def _(t: Tables) -> DataFrame:
    feed = t.customer.select(F.lit("Customer").alias("label"), F.col("c_custkey").alias("key")).unionByName(
        t.orders.select(F.lit("Customer").alias("label"), F.col("o_custkey").alias("key"), F.lit("PLACED").alias("edge_label")),
        allowMissingColumns=True,
    )
    vertices, edges = S.split_elements(feed)
    return vertices.select(F.lit("vertex").alias("kind")).unionByName(edges.select(F.lit("edge").alias("kind"))).groupBy(
        "kind"
    ).agg(F.count("*").alias("n"))


@query("read_table_csv", "SELECT s_suppkey, s_name, s_nationkey, round(s_acctbal, 6) AS s_acctbal FROM supplier")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    t.supplier.write.csv(path, header=True)
    read = S.read_table_csv(t.spark, path, "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double")
    return read.withColumn("s_acctbal", F.round("s_acctbal", 6))


# --- writers --------------------------------------------------------------

def _dated_orders(t: Tables) -> DataFrame:
    v = X.order_vertices(t)
    day = prop_date(F.col("props"), "created_at")
    return v.withColumn("created_at", day).withColumn("part", R.year_partition(day, X.AS_OF))


_PART_SQL = f"""p AS (SELECT *, CASE WHEN year(try_cast(props ->> '$.created_at' AS DATE)) BETWEEN 1999 AND 2002
THEN 'y' || year(try_cast(props ->> '$.created_at' AS DATE)) ELSE 'default' END AS part FROM ({SQL_ORDER_V}))"""


@query("write_partitioned_graph", f"WITH {_PART_SQL} SELECT label, part, id, props FROM p")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "graph")
    W.write_partitioned_graph(_dated_orders(t), path, bloom_columns=("id",))
    return t.spark.read.parquet(path).select("label", "part", "id", "props")


SQL_BY_ID = f"""SELECT label, CASE WHEN o_key < 500000 THEN 'id_0' WHEN o_key < 1000000 THEN 'id_500000' ELSE 'id_1000000' END AS part,
id FROM (SELECT *, external_id::BIGINT AS o_key FROM ({SQL_ORDER_V}))"""


def _rewritten(t: Tables) -> SnapshotTable:
    """Orders loaded in two parts, then handed over in id partitions."""
    table = SnapshotTable(t.spark, scratch_path(t.spark, "versions"))
    first = F.col("external_id").cast("bigint") % 3 == 0
    table.append(X.order_vertices(t).filter(first))
    table.append(X.order_vertices(t).filter(~first))
    table.rewrite(lambda df: R.id_range_partition(df, R.EDGE_ID_BOUNDS, F.col("external_id").cast("bigint")))
    return table


@query("rewrite_partitioned", SQL_BY_ID)
def _(t: Tables) -> DataFrame:
    return _rewritten(t).read().select("label", "part", "id")


@query("snapshot_versions", f"""WITH o AS (SELECT external_id::BIGINT % 3 = 0 AS first, external_id FROM ({SQL_ORDER_V})),
v AS (SELECT 1 AS version, external_id FROM o WHERE first UNION ALL SELECT 2, external_id FROM o UNION ALL SELECT 3, external_id FROM o)
SELECT version::BIGINT AS version, ['append', 'append', 'rewrite'][version] AS operation, count(*) AS rows, max(external_id::BIGINT) AS last FROM v GROUP BY version""")
def _(t: Tables) -> DataFrame:
    """What readers of each version see."""
    table = _rewritten(t)
    seen = [table.read(v).select(F.lit(v).cast("bigint").alias("version"), F.col("external_id").cast("bigint").alias("last")) for v in table.versions()]
    rows = reduce(DataFrame.unionByName, seen).groupBy("version").agg(F.max("last").alias("last"), F.count("*").alias("n"))
    return table.history().join(rows, "version").filter("n = rows").select("version", "operation", "rows", "last")


@query("table_sizes", f"""WITH {SQL_V} SELECT label, count(*) AS rows, true AS has_bytes, true AS has_files FROM v GROUP BY label""")
def _(t: Tables) -> DataFrame:
    """Rows per label; bytes and files depend on the writer, so only that there are some is compared."""
    path = scratch_path(t.spark, "graph")
    W.write_partitioned_graph(X.vertices(t), path, partition_by=("label",))
    sizes = R.table_sizes(t.spark, path)
    return sizes.select("label", "rows", (F.col("bytes") > 0).alias("has_bytes"), (F.col("files") > 0).alias("has_files"))


@query("partition_scan", f"WITH {_PART_SQL} SELECT id, props FROM p WHERE part = 'y2000'")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "graph")
    W.write_partitioned_graph(_dated_orders(t), path)
    return partition_scan(t.spark.read.parquet(path), "Order", "y2000").select("id", "props")


@query("range_scan_pruned", f"""WITH {_PART_SQL} SELECT id, props FROM p WHERE props ->> '$.created_at' >= '1997-03-01'
AND props ->> '$.created_at' < '2000-02-01'""")
def _(t: Tables) -> DataFrame:
    """The range begins before the partitioned years, so the default partition belongs to it."""
    path = scratch_path(t.spark, "graph")
    W.write_partitioned_graph(_dated_orders(t), path)
    spec = R.year_ranges("Order", range(X.AS_OF.year - 2, X.AS_OF.year + 2), with_default=True)
    stored = t.spark.read.parquet(path)
    return range_scan(stored, "Order", "created_at", dt.date(1997, 3, 1), dt.date(2000, 2, 1), spec).select("id", "props")


@query("range_scan_id_pruned", f"""SELECT id, props FROM ({SQL_ORDER_V}) WHERE external_id::BIGINT >= 400 AND external_id::BIGINT < 2500""")
def _(t: Tables) -> DataFrame:
    """Orders in id ranges with a default behind them; the wanted ids lie in two ranges and in the default."""
    path = scratch_path(t.spark, "graph")
    spec = [*R.id_ranges("Order", [(0, 500), (500, 1000), (1000, 2000)]), R.Range("Order", R.DEFAULT, None, None, True)]
    key = F.col("external_id").cast("bigint")
    placed, _ = R.assign_partition(X.order_vertices(t).withColumn("key", key), F.col("key"), spec)
    W.write_partitioned_graph(placed, path)
    return range_scan(t.spark.read.parquet(path), "Order", "key", 400, 2500, spec).select("id", "props")



@query("range_scan_clustered", f"""SELECT id, props FROM ({SQL_ORDER_V}) WHERE external_id::BIGINT >= 200 AND external_id::BIGINT < 1100
AND props ->> '$.created_at' >= '1997-03-01' AND props ->> '$.created_at' < '2000-02-01'""")
def _(t: Tables) -> DataFrame:
    """Orders by number and by day at once, from the files of a Z-curve that can hold them."""
    orders = X.order_vertices(t).select(
        "id", "props", F.col("external_id").cast("bigint").alias("number"), prop_date(F.col("props"), "created_at").alias("day"),
    )
    table = ClusteredTable(t.spark, scratch_path(t.spark, "clustered"))
    table.write(orders, ["number", "day"], 16)
    return table.scan({"number": (200, 1100), "day": (dt.date(1997, 3, 1), dt.date(2000, 2, 1))}).select("id", "props")


SQL_JACCARD_UP = f"""{SQL_USER_PROPS}, deg AS (SELECT node, count(*) AS d FROM up GROUP BY node),
sh AS (SELECT a.node AS node1, b.node AS node2, count(*) AS i FROM up a JOIN up b ON a.neighbor = b.neighbor AND a.node < b.node GROUP BY ALL),
jac AS (SELECT node1, node2, i::DOUBLE / (x.d + y.d - i) AS score FROM sh JOIN deg x ON x.node = node1 JOIN deg y ON y.node = node2)"""

SQL_TOP5_UP = f"""{SQL_JACCARD_UP}, both_ways AS (SELECT node1, node2, score FROM jac UNION ALL SELECT node2, node1, score FROM jac),
ranked AS (SELECT *, row_number() OVER (PARTITION BY node1 ORDER BY score DESC, node2) AS r FROM both_ways WHERE score >= 0.45 - 1e-12)"""


@query("write_similar_edges", f"""WITH {SQL_TOP5_UP}
SELECT 'SIMILAR_TO' AS label, node1 AS start_id, node2 AS end_id, round(score, 6) AS score FROM ranked WHERE r <= 5""")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "similar")
    W.write_similar_edges(node_similarity(X.user_props(t), cutoff=0.45, top_k=5), path, "User")
    return t.spark.read.parquet(path).select("label", "start_id", "end_id", F.round("score", 6).alias("score"))


# --- resolution and merge -------------------------------------------------

def _raw_order_edges(t: Tables) -> DataFrame:
    """Order edges by external id; every hundredth customer is unknown, every third start has no label."""
    k = F.col("o_orderkey")
    return t.orders.select(
        F.lit("PLACED").alias("label"),
        F.when(k % 3 != 0, F.lit("Customer")).alias("start_label"),
        F.when(k % 100 == 0, F.concat(F.lit("x"), F.col("o_custkey").cast("string")))
        .when(k % 3 == 0, F.concat(F.lit("C"), F.col("o_custkey").cast("string")))
        .otherwise(F.col("o_custkey").cast("string")).alias("start_ref"),
        F.when(k % 7 != 0, F.lit("Order")).alias("end_label"),
        k.cast("string").alias("end_ref"),
        F.lit("{}").alias("props"),
    )


def _known_vertices(t: Tables) -> DataFrame:
    """Customers under two external ids, orders and products (so that bare numbers are ambiguous)."""
    c = X.customer_vertices(t)
    with_alias = c.unionByName(c.withColumn("external_id", F.concat(F.lit("C"), "external_id")))
    return with_alias.unionByName(X.order_vertices(t)).unionByName(X.product_vertices(t)).withColumn("pos", F.lit(0))


_RESOLVE_SQL = f"""known AS (
SELECT 'Customer' AS label, c_custkey::VARCHAR AS ref, (1::BIGINT << 48) + c_custkey AS id FROM customer
UNION ALL SELECT 'Customer', 'C' || c_custkey, (1::BIGINT << 48) + c_custkey FROM customer
UNION ALL SELECT 'Product', p_partkey::VARCHAR, (3::BIGINT << 48) + p_partkey FROM part
UNION ALL SELECT 'Order', o_orderkey::VARCHAR, (6::BIGINT << 48) + o_orderkey FROM orders),
bare AS (SELECT ref, count(DISTINCT label) AS owners, min(id) AS id FROM known GROUP BY ref),
raw AS (SELECT CASE WHEN o_orderkey % 3 <> 0 THEN 'Customer' END AS sl,
  CASE WHEN o_orderkey % 100 = 0 THEN 'x' || o_custkey WHEN o_orderkey % 3 = 0 THEN 'C' || o_custkey ELSE o_custkey::VARCHAR END AS sr,
  CASE WHEN o_orderkey % 7 <> 0 THEN 'Order' END AS el, o_orderkey::VARCHAR AS er FROM orders),
res AS (SELECT raw.*, CASE WHEN sl IS NULL THEN CASE WHEN sb.owners = 1 THEN sb.id END ELSE s.id END AS start_id,
  CASE WHEN el IS NULL THEN CASE WHEN eb.owners = 1 THEN eb.id END ELSE e.id END AS end_id,
  CASE WHEN sl IS NULL THEN sb.owners END AS so, CASE WHEN el IS NULL THEN eb.owners END AS eo
  FROM raw LEFT JOIN known s ON s.label = sl AND s.ref = sr LEFT JOIN bare sb ON sb.ref = sr
  LEFT JOIN known e ON e.label = el AND e.ref = er LEFT JOIN bare eb ON eb.ref = er)"""


@query("resolve_endpoints", f"WITH {_RESOLVE_SQL} SELECT 'PLACED' AS label, start_id, end_id FROM res WHERE start_id IS NOT NULL AND end_id IS NOT NULL")
def _(t: Tables) -> DataFrame:
    resolved, _ = I.resolve_endpoints(_raw_order_edges(t), I.last_wins_ids(_known_vertices(t)))
    return resolved.select("label", "start_id", "end_id")


@query("ingest_report", f"""WITH {_RESOLVE_SQL} SELECT CASE WHEN start_id IS NULL AND so > 1 THEN 'start ambiguous'
WHEN start_id IS NULL THEN 'start unresolved' WHEN end_id IS NULL AND eo > 1 THEN 'end ambiguous'
WHEN end_id IS NULL THEN 'end unresolved' ELSE 'accepted' END AS outcome, count(*) AS n FROM res GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    resolved, rejected = I.resolve_endpoints(_raw_order_edges(t), I.last_wins_ids(_known_vertices(t)))
    return I.ingest_report(resolved, rejected)


@query("create_edges", f"""WITH {SQL_V}, {SQL_BAD_E} SELECT e.label, e.start_id, e.end_id, e.props FROM e
WHERE start_id IN (SELECT id FROM v) AND end_id IN (SELECT id FROM v)""")
def _(t: Tables) -> DataFrame:
    created, _ = I.create_edges(X.vertices(t), X.edges_with_dangling(t))
    return created.select("label", "start_id", "end_id", "props")


_STORED_CUSTOMERS = "SELECT 'Customer' AS label, json_object('name', c_name)::VARCHAR AS props FROM customer WHERE c_acctbal > 0"


@query("merge_vertices", f"""SELECT label, props FROM ({_STORED_CUSTOMERS}) UNION
SELECT 'Customer', json_object('name', c_name)::VARCHAR FROM customer JOIN orders ON o_custkey = c_custkey""")
def _(t: Tables) -> DataFrame:
    named = t.customer.select("c_custkey", "c_acctbal", F.lit("Customer").alias("label"), S.name_props(F.col("c_name")).alias("props"))
    stored = named.filter(F.col("c_acctbal") > 0).select("label", "props")
    feed = named.join(t.orders, F.col("o_custkey") == F.col("c_custkey")).select("label", "props")
    return I.merge_vertices(stored, feed)


@query("bulk_ingest", """WITH c AS (SELECT c_custkey, c_nationkey FROM customer), n AS (SELECT n_nationkey, n_regionkey FROM nation)
SELECT 'vertex' AS kind, 'Customer' AS name, count(*) AS n FROM c UNION ALL SELECT 'vertex', 'Country', count(*) FROM n
UNION ALL SELECT 'edge ' || n_regionkey, 'LOCATED_IN', count(*) FROM c JOIN n ON n_nationkey = c_nationkey GROUP BY n_regionkey
UNION ALL SELECT 'report', 'accepted', count(*) FROM c JOIN n ON n_nationkey = c_nationkey
UNION ALL SELECT 'report', 'end unresolved', count(*) FROM orders WHERE o_custkey % 7 = 0""")
def _(t: Tables) -> DataFrame:
    """Customers and countries with their edges, and for some orders an edge to a country that nobody loads."""
    def vertex(df: DataFrame, label: str, key: str, props: Column) -> DataFrame:
        return df.select(F.lit(label).alias("label"), F.col(key).cast("string").alias("external_id"), props.alias("props"))

    country = F.to_json(F.struct(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region")))
    v = vertex(t.customer, "Customer", "c_custkey", F.to_json(F.struct(F.col("c_name").alias("name")))).unionByName(
        vertex(t.nation, "Country", "n_nationkey", country))

    def edge(df: DataFrame, start: Column, end: Column) -> DataFrame:
        return df.select(
            F.lit("LOCATED_IN").alias("label"), F.lit("Customer").alias("start_label"), start.cast("string").alias("start_ref"),
            F.lit("Country").alias("end_label"), end.cast("string").alias("end_ref"), F.lit("{}").alias("props"),
        )

    lost = t.orders.filter(F.col("o_custkey") % 7 == 0)
    e = edge(t.customer, F.col("c_custkey"), F.col("c_nationkey")).unionByName(edge(lost, F.col("o_custkey"), F.lit("nowhere")))
    done = I.bulk_ingest(v, e)

    def counted(df: DataFrame, kind: Column, name: Column) -> DataFrame:
        return df.groupBy(kind.alias("kind"), name.alias("name")).agg(F.count("*").alias("n"))

    region = done.vertices.filter("label = 'Country'").select(F.col("id").alias("end_id"), F.get_json_object("props", "$.region").alias("region"))
    return counted(done.vertices, F.lit("vertex"), F.col("label")).unionByName(
        counted(done.edges.join(region, "end_id"), F.concat(F.lit("edge "), "region"), F.col("label"))
    ).unionByName(done.report.select(F.lit("report").alias("kind"), F.col("outcome").alias("name"), "n"))


def _patterns(t: Tables) -> DataFrame:
    """Every pair of a brand and a size that a product has, and the empty pattern on regions."""
    wanted = t.part.select("p_brand", "p_size").distinct()
    patterns = wanted.select(
        F.concat("p_brand", F.lit("/"), F.col("p_size").cast("string")).alias("pattern_id"), F.lit("Product").alias("label"),
        F.to_json(F.struct(F.col("p_brand").alias("brand"), F.col("p_size").alias("size"))).alias("props"),
    )
    return patterns.unionByName(
        t.region.select(F.lit("any region").alias("pattern_id"), F.lit("Region").alias("label"), F.lit("{}").alias("props")).distinct()
    )


@query("merge_subset_match", f"""WITH {SQL_V},
pat AS (SELECT DISTINCT 'Product' AS label, p_brand AS brand, p_size AS size FROM part)
SELECT pat.brand || '/' || pat.size AS pattern_id, v.id FROM pat JOIN v ON v.label = pat.label
AND v.props ->> '$.brand' = pat.brand AND (v.props ->> '$.size')::INT = pat.size
UNION ALL SELECT 'any region', id FROM v WHERE label = 'Region'""")
def _(t: Tables) -> DataFrame:
    return I.merge_subset_match(X.vertices(t), _patterns(t))


@query("merge_subset_match_indexed", f"""WITH {SQL_V},
pat AS (SELECT DISTINCT 'Product' AS label, p_brand AS brand, p_size AS size FROM part)
SELECT pat.brand || '/' || pat.size AS pattern_id, v.id FROM pat JOIN v ON v.label = pat.label
AND v.props ->> '$.brand' = pat.brand AND (v.props ->> '$.size')::INT = pat.size
UNION ALL SELECT 'any region', id FROM v WHERE label = 'Region'""")
def _(t: Tables) -> DataFrame:
    """The same patterns from an index that was built from a third of the vertices and kept up to date by two more loads."""
    index, third = PropertyIndex(t.spark, scratch_path(t.spark, "index")), F.pmod(F.xxhash64("id"), F.lit(3))
    for part in range(3):
        index.add(X.vertices(t).filter(third == part))
    index.compact()
    return index.match(_patterns(t))


@query("merge_triplets", f"""WITH {SQL_V},
feed AS (SELECT s_name, p_brand, p_name, p_size FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey),
s AS (SELECT props ->> '$.name' AS s_name, id FROM v WHERE label = 'Supplier'),
o AS (SELECT props ->> '$.brand' AS p_brand, props ->> '$.name' AS p_name, (props ->> '$.size')::INT AS p_size, id FROM v WHERE label = 'Product')
SELECT 'SUPPLIES' AS label, s.id::VARCHAR AS start_id, o.id::VARCHAR AS end_id FROM feed JOIN s USING (s_name) JOIN o USING (p_brand, p_name, p_size)
UNION ALL SELECT 'SOLD_BY', o.id::VARCHAR, sha256('Shop' || chr(31) || json_object('name', s_name)::VARCHAR) FROM feed JOIN o USING (p_brand, p_name, p_size)""")
def _(t: Tables) -> DataFrame:
    """Suppliers and products are stored and bound by some of their properties; shops are not and get created."""
    bought = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    product = F.to_json(F.struct(F.col("p_brand").alias("brand"), F.col("p_name").alias("name"), F.col("p_size").alias("size")))
    by_name = S.name_props(F.col("s_name"))

    def triplet(s_label: str, s_props: Column, predicate: str, o_label: str, o_props: Column) -> Column:
        return F.struct(
            F.lit(s_label).alias("s_label"), s_props.alias("s_props"), F.lit(predicate).alias("predicate"),
            F.lit("{}").alias("e_props"), F.lit(o_label).alias("o_label"), o_props.alias("o_props"),
        )

    feed = bought.select(F.inline(F.array(
        triplet("Supplier", by_name, "SUPPLIES", "Product", product), triplet("Product", product, "SOLD_BY", "Shop", by_name),
    )))
    _, edges = I.merge_triplets(X.vertices(t).withColumn("id", F.col("id").cast("string")), feed)
    return edges.select("label", "start_id", "end_id")


@query("last_wins_ids", """SELECT 'Order' AS label, o_custkey::VARCHAR AS external_id, max(o_orderkey) AS id FROM orders GROUP BY o_custkey""")
def _(t: Tables) -> DataFrame:
    rows = t.orders.select(
        F.lit("Order").alias("label"), F.col("o_custkey").cast("string").alias("external_id"),
        F.col("o_orderkey").alias("id"), F.col("o_orderkey").alias("pos"),
    )
    return I.last_wins_ids(rows)


@query("distinct_vertices", """SELECT 'Customer' AS label, json_object('id', o_custkey)::VARCHAR AS props, min(o_orderkey) AS first_order
FROM orders GROUP BY o_custkey""")
def _(t: Tables) -> DataFrame:
    feed = t.orders.select(
        F.lit("Customer").alias("label"), F.to_json(F.struct(F.col("o_custkey").alias("id"))).alias("props"),
        F.col("o_orderkey").alias("first_order"),
    )
    return I.distinct_vertices(feed)


@query("union_dated_undated", f"""SELECT id, coalesce(props ->> '$.created_at', '2001-06-30') AS created_at,
list_contains(json_keys(props), 'created_at') AS was_dated FROM ({SQL_ORDER_V})""")
def _(t: Tables) -> DataFrame:
    dated = R.union_dated_undated(X.order_vertices(t), "created_at", X.AS_OF)
    return dated.select("id", F.col("created_at").cast("string").alias("created_at"), "was_dated")


@query("idempotent_reingest", f"WITH {SQL_V} SELECT label, props FROM v")
def _(t: Tables) -> DataFrame:
    feed_path, store, state = (scratch_path(t.spark, n) for n in ("feed", "store", "state"))
    feed = X.vertices(t).select("label", "props")
    feed.write.parquet(feed_path)
    reingest_vertices(file_feed(t.spark, feed_path, feed.schema), store, state)
    feed.write.mode("append").parquet(feed_path)
    return reingest_vertices(file_feed(t.spark, feed_path, feed.schema), store, state)


@query("idempotent_reingest_edges", """SELECT 'PLACED' AS label, o_custkey::VARCHAR AS start_ref, o_orderkey::VARCHAR AS end_ref FROM orders
UNION ALL SELECT 'PLACED', o_custkey::VARCHAR, o_orderkey::VARCHAR FROM orders WHERE o_orderkey % 3 = 0""")
def _(t: Tables) -> DataFrame:
    """All orders by two feeds, delivered twice; then some of them again by a feed of its own."""
    path, store = scratch_path(t.spark, "feed"), scratch_path(t.spark, "store")
    k = F.col("o_orderkey")
    all_orders = t.orders.select(
        F.concat(F.lit("orders-"), (k % 2).cast("string")).alias("feed_id"), k.alias("row_no"),
        F.lit("PLACED").alias("label"), F.col("o_custkey").cast("string").alias("start_ref"), k.cast("string").alias("end_ref"),
    )
    state = scratch_path(t.spark, "state")
    all_orders.write.parquet(path)
    reingest_edges(file_feed(t.spark, path, all_orders.schema), store, state)
    all_orders.write.mode("append").parquet(path)
    all_orders.filter(k % 3 == 0).withColumn("feed_id", F.lit("corrections")).write.mode("append").parquet(path)
    return reingest_edges(file_feed(t.spark, path, all_orders.schema), store, state)
