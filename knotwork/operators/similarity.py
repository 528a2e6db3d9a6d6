"""Node similarity over shared neighbours.

The input is a set of ``(node, neighbor)`` pairs. Scoring all pairs of nodes that
meet at some neighbour costs the square of every neighbour's degree, which a
super-node makes impossible. With a cutoff most of that work is never done, and
the answer is still exact:

* Nodes with equal neighbour sets score alike, so each distinct set is compared once.
* All sets are ordered by one neighbour order, rare first. If two sets reach the
  cutoff, they share a neighbour among the first few of each (the prefix); popular
  neighbours come last and hardly ever produce candidates.
* The smaller side needs a shorter prefix than the larger one.
* Only candidates that survive are scored on their whole sets.
* Where many sets lie over few neighbours, so that nearly all pairs would be
  candidates, the sets are compared in cells instead (``cells``).
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from knotwork.operators import cells
from knotwork.operators.skew import fragment_join
from knotwork.session import written
from knotwork.sources.bucketed import Bucketed

METRICS = ("jaccard", "overlap", "weighted_jaccard", "cosine")
EPS = 1e-9
SET_CHUNK = 4096
PAIRS_PER_TASK = 2e7
DIRECT_BELOW = 64
#: Sets are compared in cells if they would meet this often at least, and a meeting stands for no more products than this.
CELLS_FROM = 1e7
PRODUCTS_PER_MEETING = 1000
#: Codes of sets that a neighbour lists, that a set can get, and that a task counts.
CODES_PER_LIST, CODES_PER_SET, CODES_PER_TASK = 20_000, 5_000_000, 2_000_000


# --- degrees and weights --------------------------------------------------

def distinct_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.select("node", "neighbor").distinct()


def degrees(pairs: DataFrame, by: str = "neighbor") -> DataFrame:
    """Distinct partners per neighbour (or node)."""
    return distinct_pairs(pairs).groupBy(by).agg(F.count("*").alias("degree"))


def idf_weights(pairs: DataFrame) -> DataFrame:
    """``ln(nodes / nodes connected to the neighbour)`` per neighbour."""
    nodes = pairs.select("node").distinct().agg(F.count("*")).scalar()
    return degrees(pairs).select("neighbor", "degree", F.ln(nodes / F.col("degree")).alias("weight"))


def super_nodes(pairs: DataFrame, min_degree: int | None = None, quantile: float | None = None) -> DataFrame:
    """Neighbours with abnormally many connections, most connected first.

    The quantile is exact; it is taken over the histogram of degrees, which has
    at most about sqrt(2 * edges) entries.
    """
    degree = degrees(pairs)
    if quantile is not None:
        shape = degree.groupBy("degree").agg(F.count("*").alias("f"))
        limit = shape.agg(F.percentile("degree", F.lit(quantile), F.col("f"))).scalar()
    else:
        limit = F.lit(min_degree)
    return degree.filter(F.col("degree") >= limit).orderBy(F.desc("degree"), "neighbor")


# --- exact candidate reduction --------------------------------------------

def _weigh(pairs: DataFrame, weights: DataFrame | None, unseen: float = 0.0) -> DataFrame:
    """Distinct pairs with the degree of the neighbour and its weight ``w`` (1 without weights)."""
    if weights is None:
        return distinct_pairs(pairs).join(degrees(pairs), "neighbor").withColumn("w", F.lit(1.0))
    return _weighed(distinct_pairs(pairs), weights, unseen)


def _weighed(pairs: DataFrame, weights: DataFrame, unseen: float) -> DataFrame:
    """Pairs that are distinct already, with degree and weight."""
    return pairs.join(weights, "neighbor", "left").select(
        "node", "neighbor",
        F.coalesce("degree", F.lit(1)).alias("degree"),
        F.coalesce("weight", F.lit(unseen)).alias("w"),
    )


class NeighborSets(NamedTuple):
    """Neighbour sets made ready for comparison, stored in the shared folder.

    entries   profile, neighbor, degree, m, mass, rest
    members   node, profile, members, size, total, squares

    A profile stands for all nodes with the same neighbours and is named by the
    smallest of them. ``m`` is the neighbour's share of the set's ``mass`` (count,
    weight or squared weight) and ``rest`` the mass from its class on.
    ``direct`` tells that no popular neighbours exist: an average entry meets few
    others, so counting all meetings is cheaper than finding candidates first.
    """

    entries: DataFrame
    members: DataFrame
    direct: bool

    @property
    def profiles(self) -> DataFrame:
        return self.members.filter(F.col("node") == F.col("profile")).drop("node")

    @property
    def membership(self) -> DataFrame:
        return self.members.select("node", "profile")


def neighbor_profiles(weighted: DataFrame, metric: str) -> NeighborSets:
    """Collapse equal neighbour sets and order the neighbours of each set.

    Sets are told apart by their size and an order-free 128-bit digest. Within a
    set neighbours are ordered by class: a power of two of the degree, cut into
    32 by hash, rare first. There are at most some 1,300 classes, so summing
    over the classes of one set is a bounded window however large the set is.
    """
    weighted = written(weighted, "weighted")
    prints = weighted.groupBy("node").agg(
        F.count("*").alias("size"),
        F.sum("w").alias("total"),
        F.sum(F.col("w") * F.col("w")).alias("squares"),
        F.bit_xor(F.xxhash64(F.lit(11), "neighbor")).alias("h1"),
        F.bit_xor(F.xxhash64(F.lit(97), F.lit(5), "neighbor")).alias("h2"),
    )
    same = ["size", "h1", "h2"]
    heads = prints.groupBy(*same).agg(F.min("node").alias("profile"), F.count("*").alias("members"))
    members = written(
        prints.join(heads, same).select("node", "profile", "members", "size", "total", "squares"), "members"
    )
    mass = {"weighted_jaccard": F.col("total"), "cosine": F.col("squares")}.get(metric, F.col("size").cast("double"))
    own = F.col("w") * F.col("w") if metric == "cosine" else F.col("w")
    met_per_entry = weighted.agg(F.avg("degree")).first()[0] or 0.0
    direct = met_per_entry <= DIRECT_BELOW
    order = F.floor(F.log2("degree")).cast("int") * 32 + F.pmod(F.xxhash64("neighbor"), F.lit(32)).cast("int")
    head_sets = members.filter(F.col("node") == F.col("profile")).select("profile", mass.alias("mass"))
    banded = weighted.withColumnRenamed("node", "profile").join(head_sets, "profile").select(
        "profile", "neighbor", "degree", own.alias("m"), "mass", order.alias("band")
    )
    if direct:
        plain = banded.drop("band").withColumn("rest", F.col("mass"))
        return NeighborSets(written(plain, "entries"), members, True)
    onward = Window.partitionBy("profile").orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, 0)
    rest = banded.groupBy("profile", "band").agg(F.sum("m").alias("_m")).select(
        "profile", "band", F.sum("_m").over(onward).alias("rest")
    )
    return NeighborSets(written(banded.join(rest, ["profile", "band"]).drop("band"), "entries"), members, False)


def _bounds(metric: str, cutoff: float, min_shared: int) -> tuple[Column | None, Column | None]:
    """Least shared mass a qualifying pair has, as known to its smaller and its larger set."""
    mass = F.col("mass")
    if metric == "shared":
        return (None, None) if min_shared <= 1 else (F.lit(float(min_shared)),) * 2
    if cutoff <= 0:
        return None, None
    if metric == "overlap":
        return F.lit(cutoff) * mass, None
    if metric == "cosine":
        return (F.lit(cutoff * cutoff) * mass,) * 2
    return F.lit(2 * cutoff / (1 + cutoff)) * mass, F.lit(cutoff) * mass


def _prefix(entries: DataFrame, bound: Column | None, name: str) -> DataFrame:
    """Entries of the prefix: the mass from their class on can still reach the bound.

    The class at the boundary is kept whole, which only adds candidates.
    """
    kept = entries if bound is None else entries.filter(F.col("rest") >= bound * (1 - EPS) - EPS)
    return kept.select("neighbor", F.col("profile").alias(name), F.col("mass").alias(f"m{name}"), "m")


def _meet(
    small: DataFrame, large: DataFrame, metric: str, cutoff: float, min_shared: int, order: Column, direct: bool = False
) -> DataFrame:
    """Candidates (x, y): x has a neighbour in the larger set's prefix, y in the smaller one's.

    The pairs of a popular neighbour, counted by the entries that are left in the
    prefixes, form a grid of cells of about PAIRS_PER_TASK pairs each; there are as
    many tasks as that takes. Without bounds every shared neighbour is met, and
    ``s`` is the exact shared mass.
    """
    low, high = (None, None) if direct else _bounds(metric, cutoff, min_shared)
    xs, ys = _prefix(large, high, "x"), _prefix(small, low, "y").drop("m")
    met = fragment_join(xs, ys, ["neighbor"], ["x"], ["y"], pairs_per_fragment=PAIRS_PER_TASK, many_pairs=True).filter(order)
    if metric in ("jaccard", "weighted_jaccard"):
        met = met.filter(F.col("my") >= F.lit(cutoff) * F.col("mx") * (1 - EPS) - EPS)
    if low is None and high is None:
        return met.groupBy("x", "y").agg(F.sum("m").alias("s"))
    return met.select("x", "y", "mx", "my").distinct()


def _shared_mass(candidates: DataFrame, xs: NeighborSets, ys: NeighborSets, weighted: bool) -> DataFrame:
    """Exact shared count or mass of each candidate (x, y and what else is known of the pair), from whole sets.

    Sets travel as arrays. A set of more than SET_CHUNK entries is cut by
    neighbour hash into a power of two of chunks, as many as it needs by itself.
    A pair is compared chunk by chunk of its finer side, each against that chunk
    of the coarser side which holds the same hashes.
    """
    if "s" in candidates.columns:
        return candidates
    pair = candidates.columns
    limit = SET_CHUNK // 8 if weighted else SET_CHUNK

    def large(sets: NeighborSets, name: str) -> DataFrame:
        bits = F.ceil(F.log2(F.col("size") / limit)).cast("int")
        return sets.profiles.filter(F.col("size") > limit).select(F.col("profile").alias(name), bits.alias(f"bits_{name}"))

    large_x, large_y = written(large(xs, "x"), "large"), written(large(ys, "y"), "large")
    cut_x, cut_y = not large_x.isEmpty(), not large_y.isEmpty()

    def part(hashed: Column, bits: Column) -> Column:
        return hashed.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), bits) - 1)

    def chunks(entries: DataFrame, name: str, with_mass: bool, bits: DataFrame | None) -> DataFrame:
        rows = entries.withColumnRenamed("profile", name)
        if bits is not None:
            rows = rows.join(bits, name, "left")
            rows = rows.withColumn(f"chunk_{name}", part(F.xxhash64("neighbor"), F.coalesce(f"bits_{name}", F.lit(0))))
        else:
            rows = rows.withColumn(f"chunk_{name}", F.lit(0).cast("bigint"))
        grouped = rows.groupBy(name, f"chunk_{name}")
        if not with_mass:
            return grouped.agg(F.collect_list("neighbor").alias(f"set_{name}"))
        return grouped.agg(F.map_from_entries(F.collect_list(F.struct("neighbor", "m"))).alias(f"map_{name}"))

    sets = chunks(xs.entries, "x", False, large_x if cut_x else None)
    other = chunks(ys.entries, "y", weighted, large_y if cut_y else None)
    for name, bits, cut in (("x", large_x, cut_x), ("y", large_y, cut_y)):
        candidates = candidates.join(bits, name, "left") if cut else candidates.withColumn(f"bits_{name}", F.lit(0))
    both = [F.coalesce(f"bits_{name}", F.lit(0)) for name in ("x", "y")]
    if cut_x or cut_y:
        last = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.greatest(*both)) - 1
        candidates = candidates.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    else:
        candidates = candidates.withColumn("_part", F.lit(0).cast("bigint"))
    candidates = candidates.select(*pair, part(F.col("_part"), both[0]).alias("chunk_x"), part(F.col("_part"), both[1]).alias("chunk_y"))
    if weighted:
        shared = F.aggregate(
            F.array_intersect("set_x", F.map_keys("map_y")), F.lit(0.0),
            lambda acc, k: acc + F.element_at(F.col("map_y"), k),
        )
    else:
        shared = F.size(F.array_intersect("set_x", "set_y")).cast("double")
    compared = candidates.join(sets, ["x", "chunk_x"]).join(other, ["y", "chunk_y"])
    if not (cut_x or cut_y):
        return compared.select(*pair, shared.alias("s"))
    return compared.groupBy(*pair).agg(F.sum(shared).alias("s"))


def _score(metric: str) -> Column:
    s = F.col("s")
    if metric == "jaccard":
        return F.try_divide(s, F.col("x_size") + F.col("y_size") - s)
    if metric == "weighted_jaccard":
        return F.try_divide(s, F.col("x_total") + F.col("y_total") - s)
    if metric == "overlap":
        return F.try_divide(s, F.least("x_size", "y_size"))
    if metric == "cosine":
        return F.try_divide(s, F.sqrt(F.col("x_squares") * F.col("y_squares")))
    return s


def _scored(
    candidates: DataFrame, xs: NeighborSets, ys: NeighborSets, metric: str, cutoff: float, min_shared: int
) -> DataFrame:
    shared = _shared_mass(candidates, xs, ys, metric in ("weighted_jaccard", "cosine"))
    floor = float(min_shared) if metric == "shared" else float(cutoff)
    if metric == "shared":
        return shared.select("x", "y", F.col("s").alias("score")).filter(F.col("score") >= floor - 1e-12)

    def totals(sets: NeighborSets, name: str) -> DataFrame:
        return sets.profiles.select(
            F.col("profile").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in ("size", "total", "squares")]
        )

    if "mx" in shared.columns:  # the mass of a set is the one total that its metric needs
        facts = [F.col(f"m{name}").alias(f"{name}_{c}") for name in ("x", "y") for c in ("size", "total", "squares")]
        totalled = shared.select("x", "y", "s", *facts)
    else:
        totalled = shared.join(totals(xs, "x"), "x").join(totals(ys, "y"), "y")
    scored = totalled.select("x", "y", F.coalesce(_score(metric), F.lit(0.0)).alias("score"))
    return scored.filter(F.col("score") >= floor - 1e-12)


def _self_score(metric: str) -> Column:
    """Score of two nodes with the same neighbours."""
    if metric == "shared":
        return F.col("size").cast("double")
    whole = {"weighted_jaccard": F.col("total"), "cosine": F.col("squares")}.get(metric, F.col("size"))
    return F.when(whole > 0, F.lit(1.0)).otherwise(F.lit(0.0))


#: Nodes are compared in cells one by one if there are no more of them than so many times their profiles.
NODES_PER_PROFILE = 1024


def _dense(sets: NeighborSets, metric: str, cutoff: float, min_shared: int) -> tuple[int, int] | None:
    """Number of profiles and of neighbours if comparing all pairs in cells is cheaper than meeting at neighbours.

    A meeting is shuffled, a product is part of a matrix product. With weights and
    no cutoff pairs of no shared mass would count, which only meetings can tell.
    """
    if sets.direct or (metric in ("weighted_jaccard", "cosine") and cutoff <= 1e-9):
        return None
    low, high = _bounds(metric, cutoff, min_shared)

    def kept(bound: Column | None) -> Column:
        return F.count("*") if bound is None else F.count_if(F.col("rest") >= bound * (1 - EPS) - EPS)

    met = sets.entries.groupBy("neighbor").agg(kept(high).cast("double").alias("nx"), kept(low).cast("double").alias("ny"))
    neighbors, meetings = met.agg(F.count("neighbor"), F.sum(F.col("nx") * F.col("ny"))).first()
    profiles = sets.profiles.count()
    if neighbors > cells.MOST_NEIGHBORS or (meetings or 0.0) < CELLS_FROM:
        return None
    return (profiles, neighbors) if float(profiles) ** 2 * neighbors <= PRODUCTS_PER_MEETING * meetings else None


def _code() -> Column:
    """A short name of a profile, not always its own."""
    return F.hash("profile")


def _often_met(sets: NeighborSets, least: int) -> DataFrame | None:
    """``(x, y, s)``: profiles that share at least ``least`` neighbours, with their number, if no set or neighbour is large.

    Where neighbours are rare, most pairs that meet do so once or twice. They are not shuffled as rows: a set gets
    from each neighbour the 32-bit codes of the other sets there, those below its own code, as one array, and counts
    the codes. A code that several sets have only brings up candidates, which are compared as whole sets. Where every
    pair counts, the arrays hold the names of the sets, so that no code needs to be resolved.
    """
    met, degree = sets.entries.agg(F.sum("degree"), F.max("degree")).first()
    size = sets.members.agg(F.max("size")).first()[0]
    if not met or degree > CODES_PER_LIST or degree * size > CODES_PER_SET:
        return None
    code = _code() if least > 1 else F.col("profile")
    coded = sets.entries.select("neighbor", F.col("profile").alias("x"), code.alias("code"))
    lists = coded.groupBy("neighbor").agg(F.sort_array(F.collect_list("code")).alias("codes"))
    below = F.slice("codes", 1, F.array_position("codes", F.col("code")).cast("int") - 1)
    tasks = max(int(sets.entries.sparkSession.conf.get("spark.sql.shuffle.partitions")), met // 2 // CODES_PER_TASK + 1)
    heard = coded.join(lists, "neighbor").select("x", below.alias("codes")).filter(F.size("codes") > 0).repartition(tasks, "x")
    often = heard.select("x", F.explode("codes").alias("code")).groupBy("x", "code").agg(F.count("*").alias("s")).filter(F.col("s") >= least)
    if least <= 1:
        return often.select("x", F.col("code").alias("y"), F.col("s").cast("double").alias("s"))
    named = sets.profiles.select(F.col("profile").alias("y"), code.alias("code"))
    shared = written(named.groupBy("code").agg(F.count("*").alias("n")).filter("n > 1").select("code"), "shared-codes")
    if shared.isEmpty():
        return often.join(named, "code").select("x", "y", F.col("s").cast("double").alias("s"))
    often = written(often, "often")
    sure = often.join(shared, "code", "left_anti").join(named, "code").select("x", "y", F.col("s").cast("double").alias("s"))
    alike = named.join(shared, "code", "left_semi")
    within = alike.select("code", F.col("y").alias("x")).join(alike, "code").filter(F.col("x") < F.col("y"))
    doubtful = often.join(alike, "code").select("x", "y").unionByName(within.select("x", "y"))
    return sure.unionByName(_shared_mass(written(doubtful, "doubtful"), sets, sets, False).filter(F.col("s") >= least))


def _in_cells(sets: NeighborSets, metric: str, cutoff: float, min_shared: int, n_sets: int, n_neighbors: int, membership: DataFrame | None = None) -> DataFrame:
    floor = float(min_shared) if metric == "shared" else float(cutoff)
    return cells.cell_scores(sets.entries, sets.profiles, metric, floor, metric in ("weighted_jaccard", "cosine"), n_sets, n_neighbors, membership)


def _met_scores(sets: NeighborSets, metric: str, cutoff: float, min_shared: int) -> DataFrame:
    """Scores between different profiles that meet at neighbours."""
    if metric == "shared" and sets.direct and (often := _often_met(sets, min_shared)) is not None:
        return often.withColumnRenamed("s", "score")
    smaller_first = F.struct("my", "y") < F.struct("mx", "x")
    met = _meet(sets.entries, sets.entries, metric, cutoff, min_shared, smaller_first, sets.direct)
    return _scored(met, sets, sets, metric, cutoff, min_shared)


def _profile_scores(sets: NeighborSets, metric: str, cutoff: float, min_shared: int = 1) -> DataFrame:
    """Scores between different profiles."""
    if (size := _dense(sets, metric, cutoff, min_shared)) is not None:
        return _in_cells(sets, metric, cutoff, min_shared, *size)
    return _met_scores(sets, metric, cutoff, min_shared)


def _node_scores(sets: NeighborSets, metric: str, cutoff: float, min_shared: int = 1) -> DataFrame:
    """Scores between nodes ``(node1, node2, score)``, node1 < node2.

    Cells compare nodes rather than profiles, so no pair is moved to be expanded, unless most nodes are alike.
    """
    if (size := _dense(sets, metric, cutoff, min_shared)) is None:
        scores = _met_scores(sets, metric, cutoff, min_shared)
    elif (nodes := sets.members.count()) <= NODES_PER_PROFILE * size[0]:
        found = _in_cells(sets, metric, cutoff, min_shared, nodes, size[1], sets.membership)
        return found.select(F.col("x").alias("node1"), F.col("y").alias("node2"), "score")
    else:
        scores = _in_cells(sets, metric, cutoff, min_shared, *size)
    return _expand_all(scores, sets, metric, float(min_shared) if metric == "shared" else cutoff)


# --- public operators -----------------------------------------------------

def node_similarity(
    pairs: DataFrame,
    metric: str = "jaccard",
    weights: DataFrame | None = None,
    cutoff: float = 0.0,
    top_k: int | None = None,
) -> DataFrame:
    """Similar nodes ``(node1, node2, score)`` among ``(node, neighbor)`` pairs.

    Without ``top_k`` each pair sharing a neighbour and reaching the cutoff comes
    once (node1 < node2). With ``top_k`` every node gets its best partners, ties
    by smaller id. ``weights`` is ``(neighbor, degree, weight)``, see
    ``idf_weights``.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    if metric in ("weighted_jaccard", "cosine") and weights is None:
        weights = idf_weights(pairs)
    weights = weights if metric in ("weighted_jaccard", "cosine") else None
    sets = neighbor_profiles(_weigh(pairs, weights), metric)
    if top_k is None:
        return _node_scores(sets, metric, cutoff)
    return _expand_top(_profile_scores(sets, metric, cutoff), sets, metric, cutoff, top_k)


def shared_neighbor_pairs(pairs: DataFrame, min_shared: int = 1) -> DataFrame:
    """Pairs (node1 < node2) sharing at least ``min_shared`` neighbours, with the count.

    With ``min_shared`` above 1 the most popular ``min_shared - 1`` neighbours of
    a node bring up no candidates, so a super-node alone costs nothing.
    """
    sets = neighbor_profiles(_weigh(pairs, None), "shared")
    found = _node_scores(sets, "shared", 0.0, min_shared)
    return found.select("node1", "node2", F.col("score").cast("bigint").alias("shared"))


def _expand_all(scores: DataFrame, sets: NeighborSets, metric: str, cutoff: float) -> DataFrame:
    """Scores of profiles as scores of their nodes. Only profiles of several nodes are joined; without any no pair is moved."""
    many = written(sets.members.filter((F.col("members") > 1) & F.col("node").isNotNull()), "alike")
    if many.isEmpty():
        return scores.select(F.least("x", "y").alias("node1"), F.greatest("x", "y").alias("node2"), "score")
    one = many.select(F.col("profile").alias("x"), F.col("node").alias("a"))
    two = many.select(F.col("profile").alias("y"), F.col("node").alias("b"))
    across = scores.join(one, "x", "left").join(two, "y", "left").select(
        F.coalesce("a", "x").alias("a"), F.coalesce("b", "y").alias("b"), "score"
    )
    twins = many.filter(_self_score(metric) >= cutoff - 1e-12).select(
        F.col("profile").alias("x"), F.col("node").alias("a"), _self_score(metric).alias("score")
    )
    within = fragment_join(twins, twins.select("x", F.col("a").alias("b")), ["x"], ["a"], ["b"]).filter(
        F.col("a") < F.col("b")
    )
    both = across.unionByName(within.select("a", "b", "score"))
    return both.select(F.least("a", "b").alias("node1"), F.greatest("a", "b").alias("node2"), "score")


def _expand_top(
    scores: DataFrame, sets: NeighborSets, metric: str, cutoff: float, top_k: int
) -> DataFrame:
    """Best partners per node.

    Only the ``top_k + 1`` smallest members of a partner profile can be among the
    best of any node (one of them may be the node itself), so profiles with many
    members are ranked without forming their pairs.
    """
    in_profile = F.row_number().over(Window.partitionBy("profile").orderBy("node"))
    firsts = sets.membership.withColumn("_r", in_profile).filter(F.col("_r") <= top_k + 1).select(
        F.col("profile").alias("y"), F.col("node").alias("node2")
    )
    own = sets.profiles.select(
        F.col("profile").alias("x"), F.col("profile").alias("y"), _self_score(metric).alias("score")
    ).filter(F.col("score") >= cutoff - 1e-12)
    directed = mirrored(scores, "x", "y").unionByName(own)
    best_first = [F.desc("score"), F.col("node2")]
    ranked = directed.join(firsts, "y").withColumn(
        "_r", F.row_number().over(Window.partitionBy("x").orderBy(*best_first))
    ).filter(F.col("_r") <= top_k + 1).select("x", "node2", "score")
    per_node = sets.membership.select(F.col("profile").alias("x"), F.col("node").alias("node1")).join(ranked, "x").filter(
        F.col("node1") != F.col("node2")
    )
    return top_k_similar(per_node.select("node1", "node2", "score"), top_k)


def top_k_similar(scores: DataFrame, top_k: int = 5, cutoff: float | None = None) -> DataFrame:
    """Best ``top_k`` rows per node1 by score, ties by smaller node2."""
    if cutoff is not None:
        scores = scores.filter(F.col("score") >= cutoff)
    rank = F.row_number().over(Window.partitionBy("node1").orderBy(F.desc("score"), "node2"))
    return scores.withColumn("_r", rank).filter(F.col("_r") <= top_k).drop("_r")


def mirrored(scores: DataFrame, one: str = "node1", two: str = "node2") -> DataFrame:
    """Both directions of undirected scores, from a single evaluation of them."""
    there = F.struct(F.col(one), F.col(two), F.col("score"))
    back = F.struct(F.col(two).alias(one), F.col(one).alias(two), F.col("score"))
    return scores.select(F.inline(F.array(there, back)))


def similarity_desc(scores: DataFrame) -> DataFrame:
    return scores.orderBy(F.desc("score"), "node1", "node2")


class Existing(NamedTuple):
    """Existing nodes prepared once for any number of new batches, and where they are stored by ``store_existing``."""

    sets: NeighborSets
    weights: DataFrame
    unseen: float
    metric: str
    stored: StoredSets | None = None


class StoredSets(NamedTuple):
    """The tables of an existing side by hash: weights and entries of the neighbour, members and entries again of the profile."""

    weights: Bucketed
    entries: Bucketed
    members: Bucketed
    by_profile: Bucketed


def prepare_existing(existing: DataFrame, metric: str = "cosine") -> Existing:
    """Weights and neighbour sets of the existing nodes.

    A neighbour nobody has yet weighs as if one existing node had it.
    """
    pairs = written(distinct_pairs(existing), "pairs")
    counted = pairs.groupBy("neighbor").agg(F.count("*").alias("degree"))
    if metric in ("weighted_jaccard", "cosine"):
        nodes, unnamed = pairs.agg(F.count_distinct("node"), F.count_if(F.col("node").isNull())).first()
        all_nodes = F.lit(nodes + (1 if unnamed else 0))  # the null node counts in the weights, as in idf_weights
        weights = written(counted.withColumn("weight", F.ln(all_nodes / F.col("degree"))), "weights")
        unseen = math.log(nodes) if nodes else 0.0
    else:
        weights = written(counted.withColumn("weight", F.lit(1.0)), "weights")
        unseen = 1.0
    sets = neighbor_profiles(_weighed(pairs, weights, unseen), metric)
    return Existing(sets, weights, unseen, metric)


def store_existing(existing: Existing, path: str, rows_per_bucket: int | None = None) -> Existing:
    """Store the existing side so that a batch reads what it meets, not the whole side.

    Buckets keep their size when the side grows, and so does what a batch of a given size reads.
    """
    sets = existing.sets
    stored = StoredSets(
        Bucketed.store(existing.weights, "neighbor", f"{path}/weights", rows_per_bucket),
        Bucketed.store(sets.entries, "neighbor", f"{path}/entries", rows_per_bucket),
        Bucketed.store(sets.members, "profile", f"{path}/members", rows_per_bucket),
        Bucketed.store(sets.entries, "profile", f"{path}/profiles", rows_per_bucket),
    )
    return existing._replace(stored=stored)


def best_existing(new: DataFrame, existing: Existing, cutoff: float = 0.45) -> DataFrame:
    """For each new node the most similar existing node ``(node1, node2, score)``, if any reaches the cutoff.

    Ties go to the smaller existing id.
    """
    if cutoff <= 0:
        raise ValueError("a positive cutoff is needed")
    metric, b = existing.metric, existing.sets
    # of the existing side only what the batch can meet is moved, and then the whole sets of candidates
    asked, stored = written(new.select("neighbor").distinct(), "asked"), existing.stored
    weights = existing.weights if stored is None else stored.weights.rows_of(asked)
    a = neighbor_profiles(_weigh(new, weights, existing.unseen), metric)
    near = b.entries.join(asked, "neighbor", "left_semi") if stored is None else stored.entries.rows_of(asked)
    if metric == "cosine":  # its bound is the same for the smaller and the larger set, so one meeting finds both
        met = _meet(near, a.entries, metric, cutoff, 1, F.lit(True))
    else:
        new_small = _meet(a.entries, near, metric, cutoff, 1, F.col("my") <= F.col("mx")).select(
            F.col("y").alias("x"), F.col("x").alias("y"), F.col("my").alias("mx"), F.col("mx").alias("my")
        )
        met = new_small.unionByName(_meet(near, a.entries, metric, cutoff, 1, F.col("my") < F.col("mx")))
    candidates = written(met, "candidates")
    found = written(candidates.select(F.col("y").alias("profile")).distinct(), "candidate-profiles")
    whole = b.entries.join(found, "profile", "left_semi") if stored is None else stored.by_profile.rows_of(found)
    members = b.members if stored is None else stored.members.rows_of(found)
    scored = _scored(candidates, a, NeighborSets(whole, members, b.direct), metric, cutoff, 1)
    best = scored.groupBy("x").agg(F.min(F.struct((-F.col("score")).alias("below"), "y")).alias("b"))
    return a.membership.join(best.withColumnRenamed("x", "profile"), "profile").select(
        F.col("node").alias("node1"), F.col("b.y").alias("node2"), (-F.col("b.below")).alias("score")
    )
