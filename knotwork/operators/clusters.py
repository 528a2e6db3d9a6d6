"""Connected components of entity links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knotwork.session import written
from knotwork.sources.bucketed import Bucketed


def _both(links: DataFrame) -> DataFrame:
    there, back = F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))
    return links.select(F.inline(F.array(there, back)))


def _large_star(links: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest one it knows."""
    both = _both(links)
    least = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
    return both.filter(F.col("b") > F.col("a")).join(least, "a").select(
        F.col("b").alias("a"), F.col("m").alias("b")
    ).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = written(down.groupBy("a").agg(F.min("b").alias("m")), "least")
    joined = down.join(least, "a")
    return (
        joined.filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(least.select("a", F.col("m").alias("b")))
        .distinct()
    )


def entity_clusters(links: DataFrame, nodes: DataFrame | None = None, max_rounds: int | None = None) -> DataFrame:
    """``(id, cluster)`` with the smallest member as cluster name.

    ``links`` is (a, b). Large-star and small-star rounds (Kiveris et al., 2014)
    halve long chains, so a component of diameter d takes about log d rounds
    instead of d. A node's links are only ever reduced to their minimum, never
    gathered. The minima are stored before they are joined back, so that both sides
    of that join are plain shuffles, which adaptive execution can split at a hub.
    Each round is a table in the shared folder; two numbers per round come to the
    driver. A long chain goes on until it settles unless ``max_rounds`` is given.
    """
    current = written(
        links.select("a", "b").filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    seen, rounds = None, 0
    while max_rounds is None or rounds < max_rounds:
        rounds += 1
        current = written(_small_star(_large_star(current)), "links")
        state = tuple(current.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"clusters not settled after {max_rounds} rounds")
    stars = current.select(F.col("a").alias("id"), F.col("b").alias("cluster"))
    roots = current.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("cluster"))
    found = stars.unionByName(roots)
    if nodes is None:
        return found
    return nodes.select("id").join(found, "id", "left").select("id", F.coalesce("cluster", "id").alias("cluster"))


class ClusterStore:
    """Stored clusters (id, cluster) that take in new links without a full run.

    The table lies in buckets by id. ``add`` reads the buckets of the ids in the
    new links, contracts the links to cluster names and runs the stars on those
    names only. What it changes is kept beside the table, as names that became
    other names and as ids that came anew, both no larger than the links;
    ``read`` applies it. A merged cluster has the smallest of its names, which is
    its smallest member, so names are those of a full run.
    """

    def __init__(self, clusters: DataFrame, path: str, rows_per_bucket: int | None = None) -> None:
        self.stored = Bucketed.store(clusters.select("id", "cluster"), "id", path, rows_per_bucket)
        empty = clusters.sparkSession.createDataFrame([], clusters.select("id", "cluster").schema)
        self.added = written(empty, "added-members")
        self.renames = written(empty.withColumnsRenamed({"id": "name", "cluster": "new_name"}), "cluster-renames")

    def _named(self, ids: DataFrame) -> DataFrame:
        """``(id, cluster)`` of the ids that are known, with their names of today."""
        known = self.stored.rows_of(ids).unionByName(self.added.join(ids, "id", "left_semi"))
        return self._renamed(known)

    def _renamed(self, rows: DataFrame) -> DataFrame:
        return rows.join(self.renames, F.col("cluster") == F.col("name"), "left").select("id", F.coalesce("new_name", "cluster").alias("cluster"))

    def add(self, links: DataFrame) -> None:
        """Take in links (a, b); ids without a cluster get one. Null ends link nothing."""
        links = written(links.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL"), "new-links")
        ids = written(links.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "linked-ids")
        known = written(self._named(ids), "known-names")
        names = written(ids.join(known, "id", "left").withColumn("fresh", F.col("cluster").isNull()).withColumn("cluster", F.coalesce("cluster", "id")), "names")
        one = names.select(F.col("id").alias("a"), F.col("cluster").alias("x"))
        other = names.select(F.col("id").alias("b"), F.col("cluster").alias("y"))
        contracted = links.join(one, "a").join(other, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
        merged = written(entity_clusters(contracted).filter("id != cluster").select(F.col("id").alias("name"), F.col("cluster").alias("new_name")), "merged-names")
        fresh = names.filter("fresh").select("id", "cluster")
        # names that stand for a merged name already go on to its new one
        old = self.renames.join(merged.select(F.col("name").alias("new_name"), F.col("new_name").alias("last")), "new_name", "left")
        old = old.select("name", F.coalesce("last", "new_name").alias("new_name"))
        self.renames = written(old.unionByName(merged), "cluster-renames")
        self.added = written(self.added.unionByName(fresh), "added-members")

    def read(self) -> DataFrame:
        """``(id, cluster)`` of all ids."""
        return self._renamed(self.stored.rows.select("id", "cluster").unionByName(self.added))
