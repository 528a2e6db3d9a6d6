"""Label registry, pattern look-ups, expansion and counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from knotwork.functions.properties import prop_get
from knotwork.model import EDGE_LABELS, VERTEX_LABELS
from knotwork.operators.partitions import Range, touched_partitions
from knotwork.operators.skew import spread
from knotwork.session import written


# --- label registry -------------------------------------------------------

def label_catalog(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """``(name, kind)`` of every label in use; kind is v or e."""
    return (
        vertices.select(F.col("label").alias("name"), F.lit("v").alias("kind"))
        .unionByName(edges.select(F.col("label").alias("name"), F.lit("e").alias("kind")))
        .distinct()
    )


def declared_labels(spark: SparkSession) -> DataFrame:
    rows = [(n, "v") for n in VERTEX_LABELS] + [(n, "e") for n in EDGE_LABELS]
    return spark.createDataFrame(rows, "name string, kind string")


def label_check(catalog: DataFrame, declared: DataFrame) -> DataFrame:
    """Labels used by data but not declared."""
    return catalog.join(declared, ["name", "kind"], "left_anti")


def normalize_label(label: Column) -> Column:
    return F.lower(label)


# --- projections and look-ups ---------------------------------------------

def match_all(vertices: DataFrame) -> DataFrame:
    return vertices


def match_label_project(vertices: DataFrame, label: str, *keys: str) -> DataFrame:
    """Named properties of every vertex of a label, as text."""
    return vertices.filter(F.col("label") == label).select(*[prop_get(F.col("props"), k).alias(k) for k in keys])


def indexed_ids(index: DataFrame, label: str, equal: Mapping[str, object]) -> DataFrame:
    """Ids of a label that have all the given property texts, from a stored property index.

    Label is a folder of the index, key and value are pushed to its sorted files;
    each wanted pair counts once for each id.
    """
    found = None
    for k, v in equal.items():
        one = index.filter((F.col("label") == label) & (F.col("key") == k) & (F.col("value_text") == str(v))).select("id")
        found = one if found is None else found.join(one, "id", "left_semi")
    return found


def match_props(vertices: DataFrame, label: str, index: DataFrame | None = None, **equal: object) -> DataFrame:
    """Vertices of a label whose properties equal the given texts; through the property index if there is one."""
    found = vertices.filter(F.col("label") == label)
    if index is not None and equal:
        return found.join(indexed_ids(index, label, equal), "id", "left_semi")
    for k, v in equal.items():
        found = found.filter(prop_get(F.col("props"), k) == str(v))
    return found


def search_property(df: DataFrame, label: str, name: str, value: object, limit: int = 10, index: DataFrame | None = None) -> DataFrame:
    """First rows by id whose property equals the value as text.

    With the property index the first ids are found in it, and only their rows are fetched.
    """
    if index is not None:
        first = order_by_id_limit(indexed_ids(index, label, {name: value}).distinct(), limit)
        return order_by_id_limit(df.filter(F.col("label") == label).join(first, "id", "left_semi"), limit)
    hits = df.filter((F.col("label") == label) & (prop_get(F.col("props"), name) == str(value)))
    return order_by_id_limit(hits, limit)


def order_by_id_limit(df: DataFrame, limit: int, *ids: str) -> DataFrame:
    return df.orderBy(*(ids or ("id",))).limit(limit)


def sample_rows(df: DataFrame, label: str, limit: int = 10) -> DataFrame:
    """A few rows of a label; ordered by id so that the answer is repeatable."""
    return order_by_id_limit(df.filter(F.col("label") == label), limit)


def table_page(df: DataFrame, label: str, limit: int = 10, part: str | None = None) -> DataFrame:
    """First rows by id, each with the total row count of the label or partition."""
    rows = df.filter(F.col("label") == label)
    if part is not None:
        rows = rows.filter(F.col("part") == part)
    return order_by_id_limit(rows, limit).withColumn("total", rows.agg(F.count("*")).scalar())


def partition_scan(df: DataFrame, label: str, part: str, limit: int | None = None) -> DataFrame:
    """Rows of one partition; both filters are partition filters of the stored table."""
    rows = df.filter((F.col("label") == label) & (F.col("part") == part))
    return rows if limit is None else order_by_id_limit(rows, limit)


def range_scan(
    df: DataFrame, label: str, col: str, lo: object, hi: object, spec: Sequence[Range] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Rows with ``lo <= col < hi`` on a promoted column.

    ``spec`` is the range spec that the stored table was partitioned by on that
    column: only the folders that can hold values of the range are read, the
    default among them unless the ranges cover the whole of it.
    """
    rows = df.filter((F.col("label") == label) & (F.col(col) >= F.lit(lo)) & (F.col(col) < F.lit(hi)))
    if spec is not None:
        rows = rows.filter(F.col("part").isin(touched_partitions(spec, label, lo, hi)))
    return rows if limit is None else order_by_id_limit(rows, limit)


# --- expansion ------------------------------------------------------------

def edge_expand(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """Every edge with both endpoint rows (``s_`` and ``e_`` columns); dangling edges drop out."""

    def end(prefix: str, key: str) -> DataFrame:
        renamed = vertices.select(*[F.col(c).alias(f"{prefix}{c}") for c in vertices.columns])
        return renamed.withColumnRenamed(f"{prefix}id", key)

    return edges.join(end("s_", "start_id"), "start_id").join(end("e_", "end_id"), "end_id")


def undirected(edges: DataFrame, start: str = "start_id", end: str = "end_id") -> DataFrame:
    """Both orientations of every edge as ``(node, neighbor)``, multiplicity kept."""
    there = F.struct(F.col(start).alias("node"), F.col(end).alias("neighbor"))
    back = F.struct(F.col(end).alias("node"), F.col(start).alias("neighbor"))
    return edges.select(F.inline(F.array(there, back)))


def incident_counts(edges: DataFrame, start: str = "start_id", end: str = "end_id") -> DataFrame:
    """Incident edges and distinct neighbours of every node of the undirected graph: ``(node, incident, neighbors)``."""
    ends = edges.select(start, end)
    per_pair = spread(undirected(ends, start, end), 2 * ends.count(), "node", "neighbor").groupBy("node", "neighbor").agg(F.count("*").alias("n"))
    return per_pair.groupBy("node").agg(F.sum("n").alias("incident"), F.count("*").alias("neighbors"))


def dangling_edges(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """Edges with at least one endpoint that is not a vertex."""
    ids = vertices.select("id")
    start, end = ids.withColumnRenamed("id", "start_id"), ids.withColumnRenamed("id", "end_id")
    unstarted = edges.join(start, "start_id", "left_anti").select(*edges.columns)
    unended = edges.join(start, "start_id", "left_semi").join(end, "end_id", "left_anti").select(*edges.columns)
    return unstarted.unionByName(unended)


# --- counts ---------------------------------------------------------------

def count_by_label(df: DataFrame) -> DataFrame:
    return df.groupBy("label").agg(F.count("*").alias("n")).orderBy("label")


def vertex_counts(vertices: DataFrame) -> DataFrame:
    return count_by_label(vertices)


def edge_counts(edges: DataFrame) -> DataFrame:
    return count_by_label(edges)


def graph_stats(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """``vertices_<label>`` / ``edges_<label>`` and their counts."""

    def named(df: DataFrame, kind: str) -> DataFrame:
        return df.groupBy(F.concat(F.lit(f"{kind}_"), "label").alias("name")).agg(F.count("*").alias("n"))

    return named(vertices, "vertices").unionByName(named(edges, "edges"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


# --- look-up layouts ------------------------------------------------------

def promoted_key(df: DataFrame, key: str, dtype: str = "string") -> DataFrame:
    """One property as a typed column, so that filters on it reach the file scan."""
    return df.withColumn(key, prop_get(F.col("props"), key).try_cast(dtype))


ADJACENCY_BLOCK_BITS = 12
#: Stands for the null block in join keys.
NO_BLOCK = -(2**63)


def _numeric(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.IntegralType)


def _blocked(df: DataFrame, by: Sequence[str], other: str, block_bits: int) -> DataFrame:
    """Rows with the ``block`` of ``other`` within the list of ``by``; those that are blocked by hash are dealt by list and block.

    Whole numbers are blocked by range, 2**block_bits to a block. Other ids are
    blocked by hash, into as many blocks as the length of the list asks for at
    half the size, so that uneven hashes stay below it; only longer lists are looked up.
    """
    if _numeric(df, other):
        return df.withColumn("block", F.shiftright(other, block_bits).cast("bigint"))
    df = written(df.dropna(subset=list(by)), "lists")
    rows, most = df.count(), 1 << (block_bits - 1)
    length = spread(df.select(*by), rows, *by).groupBy(*by).agg(F.count("*").alias("_n")).filter(F.col("_n") > most)
    long = written(length.select(*by, F.ceil(F.col("_n") / most).alias("_blocks")), "long-lists")
    if long.isEmpty():
        blocked = df.withColumn("block", F.lit(0).cast("bigint"))
    else:
        blocked = df.join(long, list(by), "left").withColumn("block", F.pmod(F.xxhash64(other), F.coalesce("_blocks", F.lit(1)))).drop("_blocks")
    return spread(blocked, rows, *by, "block")


def _entries(edges: DataFrame, by: str, other: str, block_bits: int) -> DataFrame:
    """Distinct (by, other) with their number of rows ``n`` and their ``block``, dealt by list and block."""
    pairs = edges.select(by, other)
    rows = pairs.count()
    if _numeric(pairs, other):
        dealt = spread(_blocked(pairs, [by], other, block_bits), rows, by, "block")
        return dealt.groupBy(by, "block", other).agg(F.count("*").alias("n"))
    return _blocked(spread(pairs, rows, by, other).groupBy(by, other).agg(F.count("*").alias("n")), [by], other, block_bits)


def adjacency(edges: DataFrame, direction: str = "out", block_bits: int = ADJACENCY_BLOCK_BITS) -> DataFrame:
    """Neighbour lists ``(id, block, neighbors[{id, n}])`` by start (out) or end (in).

    A list covers one block of neighbour ids and repeated edges are counted, so
    no list exceeds about 2**block_bits entries even for a super-node.
    """
    node, other = ("start_id", "end_id") if direction == "out" else ("end_id", "start_id")
    entries = _entries(edges.select(F.col(node).alias("id"), F.col(other).alias("other")), "id", "other", block_bits)
    return entries.groupBy("id", "block").agg(F.sort_array(F.collect_list(F.struct(F.col("other").alias("id"), "n"))).alias("neighbors"))


def neighbor_blocks(pairs: DataFrame, block_bits: int = ADJACENCY_BLOCK_BITS) -> DataFrame:
    """Neighbour sets ``(node, block, neighbors)``; bounded as in ``adjacency``."""
    entries = _entries(pairs, "node", "neighbor", block_bits)
    return entries.groupBy("node", "block").agg(F.sort_array(F.collect_list("neighbor")).alias("neighbors"))


def neighbor_sets(pairs: DataFrame, block_bits: int = ADJACENCY_BLOCK_BITS) -> DataFrame:
    """Neighbour sets with the degree of the node on each block row."""
    blocks = neighbor_blocks(pairs, block_bits)
    degree = blocks.groupBy("node").agg(F.sum(F.size("neighbors")).alias("degree"))
    return blocks.join(degree, "node")


def neighbor_set_algebra(node_pairs: DataFrame, pairs: DataFrame, block_bits: int = ADJACENCY_BLOCK_BITS) -> DataFrame:
    """Intersection and union of the neighbour sets of given ``(node1, node2)``, block by block.

    Blocks are those of the union, as in ``adjacency``: of number ranges, or by hash for other ids.
    Lists are compared as arrays, so a pair moves one row per block. Number ranges are the same for
    both sides; by hash, only pairs whose sets together may need several blocks are compared entry by entry.
    """
    known = pairs.select("node", "neighbor").distinct()
    if _numeric(pairs, "neighbor"):
        # the null block stands for null neighbours, which no list holds
        return _array_algebra(written(node_pairs.select("node1", "node2").distinct(), "pairs"), neighbor_blocks(known, block_bits))
    most = 1 << (block_bits - 1)
    sizes = written(known.groupBy("node").agg(F.count("*").alias("size")), "sizes")
    sized = node_pairs.select("node1", "node2").distinct().dropna()
    widest = sizes.agg(F.max("size")).first()[0] or 0
    if 2 * widest <= most:  # then no two sets need several blocks, and pairs are not joined to tell
        whole = known.groupBy("node").agg(F.sort_array(F.collect_list("neighbor")).alias("neighbors"))
        return _array_algebra(written(sized, "pairs"), whole.withColumn("block", F.lit(0).cast("bigint")))
    for name in ("node1", "node2"):  # a node without neighbours may stand on either side
        sized = sized.join(sizes.select(F.col("node").alias(name), F.col("size").alias(f"_{name}")), name, "left")
    sized = written(sized.withColumn("_both", F.coalesce("_node1", F.lit(0)) + F.coalesce("_node2", F.lit(0))), "pairs")
    whole = known.join(sizes.filter(F.col("size") <= most), "node", "left_semi").groupBy("node").agg(
        F.sort_array(F.collect_list("neighbor")).alias("neighbors")
    ).withColumn("block", F.lit(0).cast("bigint"))
    small = _array_algebra(sized.filter(F.col("_both") <= most).select("node1", "node2"), whole)
    large = sized.filter(F.col("_both") > most).select("node1", "node2")
    return small if large.isEmpty() else small.unionByName(_entry_algebra(large, known, block_bits))


def _array_algebra(node_pairs: DataFrame, blocks: DataFrame) -> DataFrame:
    """``neighbor_set_algebra`` of distinct pairs from lists (node, block, neighbors) with common blocks."""
    blocks = written(blocks.withColumn("_block", F.coalesce("block", F.lit(NO_BLOCK).cast("bigint"))), "blocks")
    empty = F.array().cast(blocks.schema["neighbors"].dataType)
    one = blocks.select(F.col("node").alias("node1"), "_block", "block", F.col("neighbors").alias("_l"))
    two = blocks.select(F.col("node").alias("node2"), "_block", F.col("neighbors").alias("_r"))
    ids = [r["_block"] for r in blocks.select("_block").distinct().limit(2).collect()]
    if len(ids) == 1:  # one list for each node, so a pair needs no other row
        both = node_pairs.join(one.drop("_block", "block"), "node1", "left").join(two.drop("_block"), "node2", "left").filter("_l IS NOT NULL OR _r IS NOT NULL")
        left, right = F.coalesce("_l", empty), F.coalesce("_r", empty)
        return both.select(
            "node1", "node2", F.lit(None if ids[0] == NO_BLOCK else ids[0]).cast(blocks.schema["block"].dataType).alias("block"),
            F.sort_array(F.array_intersect(left, right)).alias("shared"), F.sort_array(F.array_union(left, right)).alias("all"),
        )
    met = node_pairs.join(one, "node1").join(two, ["node2", "_block"], "left").withColumn("_r", F.coalesce("_r", empty))
    # blocks that only the second node has
    alone = node_pairs.join(two.select("node2", "_block"), "node2").join(one.select("node1", "_block"), ["node1", "_block"], "left_anti")
    rest = alone.join(blocks.select(F.col("node").alias("node2"), "_block", "block", F.col("neighbors").alias("_r")), ["node2", "_block"])
    columns = ["node1", "node2", "block"]
    return met.select(
        *columns, F.sort_array(F.array_intersect("_l", "_r")).alias("shared"), F.sort_array(F.array_union("_l", "_r")).alias("all")
    ).unionByName(rest.select(*columns, empty.alias("shared"), F.col("_r").alias("all")))


def _entry_algebra(node_pairs: DataFrame, known: DataFrame, block_bits: int) -> DataFrame:
    """``neighbor_set_algebra`` of distinct pairs entry by entry, however long the lists are."""

    def side(name: str) -> DataFrame:
        return node_pairs.join(known.withColumnRenamed("node", name), name).select("node1", "node2", "neighbor")

    marked = side("node1").withColumn("own", F.lit(1)).unionByName(side("node2").withColumn("own", F.lit(2)))
    merged = marked.groupBy("node1", "node2", "neighbor").agg(F.bit_or("own").alias("own"))
    return _blocked(merged, ["node1", "node2"], "neighbor", block_bits).groupBy("node1", "node2", "block").agg(
        F.sort_array(F.collect_list(F.when(F.col("own") == 3, F.col("neighbor")))).alias("shared"),
        F.sort_array(F.collect_list("neighbor")).alias("all"),
    )
