"""Approximate nearest neighbours: a graph built by NN-descent, queried by greedy search from node to node."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from knotwork.llm.common import arrow_map
from knotwork.session import written

NEIGHBOURS = 20  # of a node in the graph
TREES = 16  # orders of the nodes that give the first graph
SIGNS = 16
RUN = 2048  # nodes next to each other in an order that are compared
OFFERS = 8  # of each local join to each node
ENOUGH = 0.001  # share of new edges below which building ends
ENTRIES = 1024
SEEDS = 16
BEAM = 160
KEPT = 12  # neighbours that one run gives to a node
STEP = 24  # nodes of a beam that are visited in a round


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def usable(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``(vec_id, vec, norm)`` of the vectors that take part, in double precision.

    Left out are rows with a null id, null, empty or zero vectors and those with
    null or non-finite components, and vectors of another than the most frequent
    length. Components too large or small to be squared are scaled by the largest.
    Repeated rows count once.
    """
    rows = vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0)).filter(F.coalesce(finite, F.lit(False)))
    lengths = rows.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    rows = rows.filter(F.size("vec") == (lengths[0]["d"] if lengths else 0))
    largest = F.array_max(F.transform("vec", F.abs))
    norm = F.sqrt(dot(F.col("vec"), F.col("vec")))
    odd = (norm == 0) | (norm == F.lit(float("inf")))
    rows = rows.filter(largest > 0).withColumn("vec", F.when(odd, F.transform("vec", lambda x: x / largest)).otherwise(F.col("vec")))
    return rows.dropDuplicates(["vec_id", "vec"]).withColumn("norm", norm)


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _halves(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Unit vectors from their half-precision bytes."""
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, dtype="<f2").reshape(len(column), -1).astype(np.float32)


def _edges(a: np.ndarray, b: np.ndarray, sim: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sim, pa.float32())], names=["node", "neighbour", "sim"]
    )


def _best(rows: DataFrame, most: int) -> DataFrame:
    """The ``most`` nearest of each node; the limit works before the shuffle too."""
    order = Window.partitionBy("node").orderBy(F.desc("sim"), "neighbour")
    return rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most).drop("place")


def _runs(batches: Iterable[pa.RecordBatch], key: str, most: int | None = None) -> Iterator[pa.Table]:
    """Rows that follow each other with the same key, cut into runs of at most ``most`` rows."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        bounds = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), batch.num_rows]
        for start, stop in zip(bounds[:-1], bounds[1:]):
            if held and held[0].column(key)[0].as_py() != keys[start]:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            while most and size + stop - start >= most:
                held.append(batch.slice(start, most - size))
                yield pa.Table.from_batches(held)
                start, held, size = start + most - size, [], 0
            if stop > start:
                held.append(batch.slice(start, stop - start))
                size += stop - start
    if held:
        yield pa.Table.from_batches(held)


def first_graph(nodes: DataFrame, dimensions: int, k: int = NEIGHBOURS, trees: int = TREES, seed: int = 5) -> DataFrame:
    """``(node, neighbour, sim)`` from runs of nodes in several orders.

    Each order sorts the nodes by the signs of random projections and then by one
    more projection. It is cut into runs of 2048, so a crowded region only gives
    more runs, never a longer one.
    """
    chance = np.random.default_rng(seed)
    planes = chance.standard_normal((trees, SIGNS + 1, dimensions)).astype(np.float32)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _halves(batch.column("half"))
            if not len(x):
                continue
            for tree in range(trees):
                side = x @ planes[tree].T
                code = ((side[:, :SIGNS] > 0) << np.arange(SIGNS)[::-1]).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), tree), pa.int32()), pa.array(code, pa.int64()), pa.array(side[:, SIGNS], pa.float32()), batch.column("node"), batch.column("half")],
                    names=["tree", "code", "along", "node", "half"],
                )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches, "tree", RUN):
            node, x = run.column("node").to_numpy(), _halves(run.column("half"))
            sims = x @ x.T
            np.fill_diagonal(sims, -np.inf)
            most = min(k, KEPT, len(node) - 1)
            if most > 0:
                near = np.argpartition(-sims, most - 1, axis=1)[:, :most]
                yield _edges(np.repeat(node, most), node[near.ravel()], np.take_along_axis(sims, near, 1).ravel())

    placed = arrow_map(nodes.select("node", "half"), place, "tree int, code bigint, along float, node bigint, half binary")
    ordered = placed.repartitionByRange("tree", "code", "along", "node").sortWithinPartitions("tree", "code", "along", "node")
    found = arrow_map(ordered, compare, "node bigint, neighbour bigint, sim float").filter("node != neighbour")
    return _best(found.groupBy("node", "neighbour").agg(F.max("sim").alias("sim")), k)


def descend(graph: DataFrame, nodes: DataFrame, k: int = NEIGHBOURS) -> DataFrame:
    """One round: neighbours of the same node, on either end of an edge, are introduced to each other.

    Of the nodes that point to a node, ``k`` / 2 are taken by hash, as the method
    samples them. Vectors travel in half precision. Pairs that met before are not compared again. A pair is offered
    to a node only if it is nearer than the farthest of its neighbours.
    """
    ahead = graph.select(F.col("node").alias("centre"), F.col("neighbour").alias("member"), "fresh")
    order = Window.partitionBy("centre").orderBy(F.xxhash64("member", "centre"))
    back = graph.select(F.col("neighbour").alias("centre"), F.col("node").alias("member"), "fresh")
    back = back.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k // 2).drop("place")
    met = ahead.unionByName(back).groupBy("centre", "member").agg(F.max("fresh").alias("fresh"))
    met = written(met, "met")
    met = met.join(met.filter("fresh").select("centre").distinct(), "centre", "left_semi")
    farthest = graph.groupBy("node").agg(F.when(F.count("*") >= k, F.min("sim")).otherwise(F.lit(-2.0)).cast("float").alias("farthest"))
    known = nodes.select("node", "half").join(farthest, "node", "left").withColumnRenamed("node", "member")
    groups = met.join(written(known.withColumn("farthest", F.coalesce("farthest", F.lit(-2.0).cast("float"))), "known"), "member")

    def introduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches, "centre"):
            member, fresh = run.column("member").to_numpy(), run.column("fresh").to_numpy()
            if len(member) < 2 or not fresh.any():
                continue
            x = _halves(run.column("half"))
            sims = x @ x.T
            np.fill_diagonal(sims, -np.inf)
            sims[~(fresh[:, None] | fresh[None, :])] = -np.inf
            sims[sims <= run.column("farthest").to_numpy()[:, None]] = -np.inf
            most = min(OFFERS, len(member) - 1)
            near = np.argpartition(-sims, most - 1, axis=1)[:, :most]
            found = np.take_along_axis(sims, near, 1).ravel()
            real = found > -np.inf
            if real.any():
                yield _edges(np.repeat(member, most)[real], member[near.ravel()[real]], found[real])

    laid = groups.repartition("centre").sortWithinPartitions("centre")
    offers = arrow_map(laid.select("centre", "member", F.col("fresh"), "half", "farthest"), introduce, "node bigint, neighbour bigint, sim float")
    old = graph.select("node", "neighbour", "sim", F.lit(False).alias("fresh"))
    both = old.unionByName(offers.withColumn("fresh", F.lit(True)))
    merged = both.groupBy("node", "neighbour").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    return _best(merged, k)


@dataclass
class Index:
    """Stored tables: distinct vectors (node, unit, half), their rows (node, vec_id, vec, norm; the smallest ids) and the graph."""

    nodes: DataFrame
    members: DataFrame
    graph: DataFrame
    dimensions: int
    rounds: int


def build(vectors: DataFrame, k: int = NEIGHBOURS, answers: int = 5) -> Index:
    """Index all usable vectors (see ``usable``). Equal vectors are one node, of which ``answers`` + 1 smallest ids can be returned."""
    vectors = written(vectors, "vectors")
    order = Window.partitionBy("vec").orderBy("vec_id")
    few = vectors.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= answers + 1).drop("place")
    groups = vectors.groupBy("vec").agg(F.min("vec_id").alias("node"))
    members = written(few.join(groups, "vec").select("node", "vec_id", "vec", "norm"), "members")
    first = members.filter(F.col("node") == F.col("vec_id"))
    units = first.select("node", F.transform("vec", lambda x: (x / F.col("norm")).cast("float")).alias("unit")).dropDuplicates(["node"])

    def halve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            half = [row.tobytes() for row in _matrix(batch.column("unit")).astype("<f2")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(half, pa.binary())], names=["node", "unit", "half"])

    nodes = written(arrow_map(units, halve, "node bigint, unit array<float>, half binary"), "nodes")
    size = nodes.limit(1).select(F.size("unit")).first()
    dimensions = size[0] if size else 0
    graph = written(first_graph(nodes, dimensions, k).withColumn("fresh", F.lit(True)), "graph")
    rounds = 0
    while True:  # the lists of neighbours only get nearer, so it ends
        rounds += 1
        graph = written(descend(graph, nodes, k), "graph")
        new, edges = graph.agg(F.sum(F.col("fresh").cast("long")), F.count("*")).first()
        if not edges or (new or 0) <= ENOUGH * edges:
            break
    return Index(nodes, members, graph, dimensions, rounds)


def search(index: Index, queries: DataFrame, beam: int = BEAM, seeds: int = SEEDS) -> DataFrame:
    """``(query, node, sim)``: the nodes in the final beam of each query ``(query, unit)``.

    Every query starts at the best of a fixed number of entry nodes and, where
    it is a node itself, at its own neighbours in the graph. In each round the
    best 24 nodes of its beam that were not yet visited show their neighbours on
    either end of an edge; it ends when all of the beam were visited.
    """
    entries = index.nodes.orderBy(F.xxhash64("node"), "node").limit(ENTRIES).collect()
    entry_ids = np.array([r["node"] for r in entries], dtype=np.int64)
    entry_units = np.array([r["unit"] for r in entries], dtype=np.float32).reshape(len(entries), -1 if entries else 1)

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("unit"))
            if not len(x) or not len(entry_ids):
                continue
            sims = x @ entry_units.T
            most = min(seeds, len(entry_ids))
            near = np.argpartition(-sims, most - 1, axis=1)[:, :most]
            ids = batch.column("query").to_numpy()
            yield _edges(np.repeat(ids, most), entry_ids[near.ravel()], np.take_along_axis(sims, near, 1).ravel())

    def score(shown: DataFrame) -> DataFrame:
        found = shown.join(index.nodes.select("node", F.col("unit").alias("there")), "node").join(queries, "query")
        sim = dot(F.col("unit").cast("array<double>"), F.col("there").cast("array<double>")).cast("float")
        return found.select("query", "node", sim.alias("sim"), F.lit(False).alias("done"))

    queries = written(queries.select("query", "unit"), "queries")
    edges = index.graph.select("node", "neighbour")
    edges = written(edges.unionByName(edges.select(F.col("neighbour").alias("node"), F.col("node").alias("neighbour"))).distinct(), "edges")
    own = score(edges.join(queries.select(F.col("query").alias("node")), "node").select(F.col("node").alias("query"), F.col("neighbour").alias("node")))
    seen = arrow_map(queries, enter, "node bigint, neighbour bigint, sim float")
    seen = seen.select(F.col("node").alias("query"), F.col("neighbour").alias("node"), "sim", F.lit(False).alias("done"))
    seen = written(seen.unionByName(own).groupBy("query", "node").agg(F.max("sim").alias("sim"), F.first("done").alias("done")), "seen")
    order = Window.partitionBy("query").orderBy(F.desc("sim"), "node")
    while True:
        waiting = F.sum((~F.col("done")).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
        ranked = seen.withColumns({"place": F.row_number().over(order), "waiting": waiting})
        is_open = (F.col("place") <= beam) & ~F.col("done") & (F.col("waiting") <= STEP)
        ranked = written(ranked.withColumn("open", is_open).drop("place", "waiting"), "ranked")
        if ranked.filter("open").isEmpty():
            break
        shown = ranked.filter("open").join(edges, "node").select("query", F.col("neighbour").alias("node")).distinct()
        shown = shown.join(ranked.select("query", "node"), ["query", "node"], "left_anti")
        seen = written(ranked.select("query", "node", "sim", (F.col("done") | F.col("open")).alias("done")).unionByName(score(shown)), "seen")
    return ranked.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= beam).select("query", "node", "sim")


def nearest(vectors: DataFrame, is_query: Column, answers: int = 5, k: int = NEIGHBOURS, beam: int = BEAM) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each query row the nearest found other rows by cosine, ties to the smaller id.

    Scores are exact on the given vectors. Queries with fewer other rows get all
    that were found. An empty table gives no rows; extra columns are ignored.
    """
    rows = written(usable(vectors), "usable")
    index = build(rows, k, answers)
    asked = rows.filter(is_query).select(F.col("vec_id").alias("query_id"), "vec", "norm")
    groups = index.members.filter(F.col("node") == F.col("vec_id")).select("node", "vec").dropDuplicates(["vec"])
    asked = written(asked.join(groups, "vec").withColumnRenamed("node", "query"), "asked")
    units = index.nodes.join(asked.select(F.col("query").alias("node")).distinct(), "node", "left_semi")
    found = written(search(index, units.withColumnRenamed("node", "query"), beam), "found")
    pairs = asked.join(found.select("query", "node"), "query")
    there = index.members.select("node", "vec_id", F.col("vec").alias("there"), F.col("norm").alias("there_norm"))
    scored = pairs.join(there, "node").filter(F.col("vec_id") != F.col("query_id")).select(
        "query_id", "vec_id", (dot(F.col("vec"), F.col("there")) / (F.col("norm") * F.col("there_norm"))).alias("score")
    )
    scored = scored.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= answers).select("query_id", "rank", "vec_id", "score")
