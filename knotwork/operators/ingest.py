"""Merge-or-create loading with rejected rows kept as data."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from knotwork.functions.properties import canonical_json, property_entries, typed_map
from knotwork.model import content_id
from knotwork.operators.skew import fragment_join
from knotwork.session import written

ANY_LABEL = "*"


def split_valid(df: DataFrame, checks: list[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass every check, and refused rows with their first ``reason``.

    A check is (reason, condition that marks a bad row); an undefined condition
    counts as passed.
    """
    reason = F.coalesce(*[F.when(bad, F.lit(why)) for why, bad in checks], F.lit(None).cast("string"))
    marked = df.withColumn("reason", reason)
    return marked.filter(F.col("reason").isNull()).drop("reason"), marked.filter(F.col("reason").isNotNull())


def ingest_report(accepted: DataFrame, rejected: DataFrame) -> DataFrame:
    """Row counts by outcome: ``accepted`` and every reject reason."""
    return (
        accepted.select(F.lit("accepted").alias("outcome"))
        .unionByName(rejected.select(F.col("reason").alias("outcome")))
        .groupBy("outcome").agg(F.count("*").alias("n"))
    )


# --- external ids ---------------------------------------------------------

def last_wins_ids(vertices: DataFrame, pos: str = "pos") -> DataFrame:
    """``(label, external_id) -> id`` of the row with the highest position.

    A max over (position, id) is combined on the map side, so an external id
    repeated in a large share of the rows is no bottleneck.
    """
    return (
        vertices.filter(F.col("external_id").isNotNull())
        .groupBy("label", "external_id")
        .agg(F.max(F.struct(F.col(pos).alias("p"), "id"))["id"].alias("id"))
    )


def _lookup(ids: DataFrame) -> DataFrame:
    """Per (label, external id) and, for references without a label, per external id alone."""
    labelled = ids.select("label", "external_id", "id", F.lit(1).cast("bigint").alias("owners"))
    anywhere = ids.groupBy("external_id").agg(F.min("id").alias("id"), F.count("*").alias("owners"))
    return labelled.unionByName(anywhere.withColumn("label", F.lit(ANY_LABEL)))


def resolve_endpoints(edges: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """External endpoint references to internal ids; returns (resolved, rejected).

    ``edges`` has start_ref / end_ref (external ids) and may have start_id /
    end_id (internal ids, used as they are). A reference without a label is
    accepted when exactly one label owns that external id.
    """
    lookup = _lookup(ids)
    found = edges
    for side in ("start", "end"):
        if f"{side}_id" not in found.columns:
            found = found.withColumn(f"{side}_id", F.lit(None).cast(dict(ids.dtypes)["id"]))
        one = lookup.select(
            F.col("label").alias(f"_{side}_label"),
            F.col("external_id").alias(f"{side}_ref"),
            F.col("id").alias(f"_{side}_id"),
            F.col("owners").alias(f"_{side}_owners"),
        )
        found = found.withColumn(f"_{side}_label", F.coalesce(f"{side}_label", F.lit(ANY_LABEL))).join(
            one, [f"_{side}_label", f"{side}_ref"], "left"
        )
    bound = found.withColumns(
        {f"{s}_id": F.coalesce(f"{s}_id", F.when(F.col(f"_{s}_owners") == 1, F.col(f"_{s}_id"))) for s in ("start", "end")}
    )
    checks = []
    for s in ("start", "end"):
        checks.append((f"{s} ambiguous", F.col(f"{s}_id").isNull() & (F.col(f"_{s}_owners") > 1)))
        checks.append((f"{s} unresolved", F.col(f"{s}_id").isNull()))
    ok, bad = split_valid(bound, checks)
    helper = [f"_{s}_{x}" for s in ("start", "end") for x in ("label", "id", "owners")]
    return ok.drop(*helper, "start_ref", "end_ref"), bad.drop(*helper)


def create_edges(vertices: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges whose endpoints both exist, and the refused rest with a reason.

    Repeated edges stay repeated.
    """
    ids = vertices.select("id").distinct()
    marked = edges.join(ids.select(F.col("id").alias("start_id"), F.lit(True).alias("_s")), "start_id", "left").join(
        ids.select(F.col("id").alias("end_id"), F.lit(True).alias("_e")), "end_id", "left"
    )
    ok, bad = split_valid(
        marked, [("start missing", F.col("_s").isNull()), ("end missing", F.col("_e").isNull())]
    )
    return ok.select(*edges.columns), bad.select(*edges.columns, "reason")


# --- bulk loading ---------------------------------------------------------

def assign_ids(vertices: DataFrame) -> DataFrame:
    """Loaded vertices with an ``id``: a digest of label, external id, content and position.

    It needs no counter and no table, and is the same when a task or the whole
    load is repeated. Rows that agree in all of these are one vertex.
    """
    parts = ["label", *[c for c in ("external_id", "props", "pos") if c in vertices.columns]]
    text = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in parts]
    return vertices.withColumn("id", F.sha2(F.concat_ws("\u001f", *text), 256))


class Ingested(NamedTuple):
    """Outcome of a bulk load."""

    vertices: DataFrame
    edges: DataFrame
    rejects: DataFrame
    report: DataFrame


def bulk_ingest(vertices: DataFrame, edges: DataFrame, as_of: dt.date | None = None) -> Ingested:
    """Vertices and edges of the readers, bound to each other, with refused edges and a report.

    External ids bind to the last row that has them, by ``pos``. Without that
    column no row is last, and an external id that several rows of a label have is
    an error. With ``as_of`` every vertex gets ``created_at``.
    """
    loaded = assign_ids(vertices)
    if as_of is not None:
        loaded = loaded.withColumn("created_at", F.lit(as_of))
    loaded = written(loaded.dropDuplicates(["id"]), "loaded")
    placed = loaded
    if "pos" not in loaded.columns:
        owners = loaded.filter(F.col("external_id").isNotNull()).groupBy("label", "external_id").agg(F.count("*").alias("n"))
        if twice := owners.filter("n > 1").first():
            raise ValueError(f"{twice['n']} rows of {twice['label']} have the external id {twice['external_id']}; name a pos column that tells the last")
        placed = loaded.withColumn("pos", F.lit(0).cast("bigint"))
    texts = {f"{s}_id": F.col(f"{s}_id").cast("string") for s in ("start", "end") if f"{s}_id" in edges.columns}
    resolved, unresolved = resolve_endpoints(edges.withColumns(texts) if texts else edges, last_wins_ids(placed))
    bound = written(resolved, "bound")
    accepted, dangling = create_edges(loaded, bound)
    rejects = unresolved.unionByName(dangling, allowMissingColumns=True)
    return Ingested(loaded, accepted, rejects, ingest_report(accepted, rejects))


# --- merge ----------------------------------------------------------------

def distinct_vertices(new: DataFrame, key: str = "props") -> DataFrame:
    """One row per (label, key) of a batch: the one with the smallest remaining columns.

    A plain ``dropDuplicates`` would keep an arbitrary row; the minimum is the
    same on every run and is combined on the map side.
    """
    rest = [c for c in new.columns if c not in ("label", key)]
    if not rest:
        return new.distinct()
    return (
        new.groupBy("label", key)
        .agg(F.min(F.struct(*[F.col(c) for c in rest])).alias("_v"))
        .select("label", key, "_v.*").select(*new.columns)
    )


def merge_vertices(vertices: DataFrame, new: DataFrame, key: str = "props", as_of: dt.date | None = None) -> DataFrame:
    """Stored vertices plus the new ones that no stored vertex of the same label and key matches.

    With ``as_of`` the created ones get it as ``created_at``; stored ones keep theirs.
    """
    created = distinct_vertices(new, key).join(vertices.select("label", key), ["label", key], "left_anti")
    if as_of is not None:
        created = created.withColumn("created_at", F.lit(as_of))
    return vertices.unionByName(created, allowMissingColumns=True)


def merge_subset_match(vertices: DataFrame, patterns: DataFrame) -> DataFrame:
    """``(pattern_id, id)`` for every vertex that contains the pattern's properties.

    Patterns with the same label and keys are matched in the cheaper of two ways: on their rarest (label, key,
    value) entry, the others being checked on the matched rows, so a value shared by most vertices does not
    multiply candidates when the pattern has anything rarer; or, if that would give more candidates than there
    are vertices with these keys, on all values at once, where every match is one row. An empty pattern matches
    every vertex of its label.
    """
    def valued(props: Column) -> Column:
        """Keys with a value; a pattern's key without one asks for none, and finds no vertex."""
        return F.array_sort(F.map_keys(F.map_filter(props, lambda _, v: v.isNotNull())))

    parsed = written(
        vertices.join(patterns.select("label").distinct(), "label", "left_semi")
        .select("label", "id", typed_map(F.col("props")).alias("_map")).withColumn("_keys", valued(F.col("_map"))),
        "parsed",
    )
    need = patterns.select("pattern_id", "label", typed_map(F.col("props")).alias("_need"))
    entry_key = ["label", "key", "value"]
    pattern_entries = need.select("pattern_id", "label", F.explode("_need").alias("key", "value"))
    entries = written(
        parsed.select("label", "id", "_map", F.explode("_map").alias("key", "value")).join(
            pattern_entries.select(*entry_key).distinct(), entry_key, "left_semi"
        ),
        "entries",
    )
    rarity = entries.groupBy(*entry_key).agg(F.count("*").alias("n"))
    rarest = (
        pattern_entries.join(rarity, entry_key)
        .groupBy("pattern_id").agg(F.min(F.struct("n", "key", "value")).alias("r"))
        .select("pattern_id", F.col("r.key").alias("key"), F.col("r.value").alias("value"), F.col("r.n").alias("n"))
    )
    probes = written(need.join(rarest, "pattern_id").withColumn("_shape", valued(F.col("_need"))), "probes")
    shape = ["label", "_shape"]
    owners = parsed.groupBy("label", "_keys").agg(F.count("*").alias("rows")).join(
        probes.groupBy(*shape).agg(F.sum("n").alias("candidates")), "label"
    ).filter(F.size(F.array_except("_shape", "_keys")) == 0)
    most = Window.partitionBy(*shape)
    at_once = written(
        owners.withColumn("all", F.sum("rows").over(most)).filter("candidates > all").select("label", "_keys", "_shape"), "shapes"
    )
    one_entry = probes.join(at_once.select(*shape).distinct(), shape, "left_anti")
    holders = entries.join(one_entry.select(*entry_key).distinct(), entry_key, "left_semi")
    hit = fragment_join(holders, one_entry, entry_key, ["id"], ["pattern_id"])

    def values(props: str) -> Column:
        return F.transform("_shape", lambda k: F.element_at(F.col(props), k))

    if not at_once.isEmpty():
        whole = parsed.join(at_once, ["label", "_keys"]).withColumn("_values", values("_map")).select(*shape, "_values", "id", "_map")
        wanted = probes.join(at_once.select(*shape).distinct(), shape, "left_semi").withColumn("_values", values("_need"))
        met = fragment_join(whole, wanted.select(*shape, "_values", "pattern_id", "_need"), [*shape, "_values"], ["id"], ["pattern_id"])
        hit = hit.select("pattern_id", "id", "_map", "_need").unionByName(met.select("pattern_id", "id", "_map", "_need"))
    hit = hit.filter(F.forall(F.map_entries("_need"), lambda e: F.element_at(F.col("_map"), e["key"]).eqNullSafe(e["value"])))
    everything = need.filter(F.size("_need") == 0)
    found = hit.select("pattern_id", "id")
    if everything.isEmpty():
        return found
    whole_label = fragment_join(vertices.select("label", "id"), everything.select("label", "pattern_id"), ["label"], ["id"], ["pattern_id"])
    return found.unionByName(whole_label.select("pattern_id", "id"))


def merge_triplets(
    vertices: DataFrame, triplets: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Load (s_label, s_props, predicate, e_props, o_label, o_props) rows onto stored vertices.

    An endpoint pattern binds every stored vertex containing it; a pattern that
    nobody contains creates one vertex. A pattern bound to k vertices yields k
    edges. Patterns of one batch do not see vertices created by other partial
    patterns of the same batch.
    """
    texts = triplets.select(F.inline(F.array(*[
        F.struct(F.col(f"{e}_label").alias("label"), F.col(f"{e}_props").alias("_text")) for e in ("s", "o")
    ]))).distinct()  # properties are read once for each text, not for each triplet
    ends = written(
        texts.withColumn("props", canonical_json(F.col("_text"))).withColumn("pattern_id", content_id(F.col("label"), F.col("props"))), "ends"
    )
    patterns = written(ends.select("label", "props", "pattern_id").distinct(), "patterns")
    stored = written(merge_subset_match(vertices, patterns), "bound")
    created = patterns.join(stored, "pattern_id", "left_anti")
    bound = stored.unionByName(created.select("pattern_id", F.col("pattern_id").alias("id")))
    grown = vertices.unionByName(
        created.select("label", F.col("pattern_id").alias("id"), "props"), allowMissingColumns=True
    )
    by_text = written(ends.select("label", "_text", "pattern_id").join(bound, "pattern_id").drop("pattern_id"), "bound-texts")

    def bind(rows: DataFrame, prefix: str, name: str) -> DataFrame:
        one = by_text.select(F.col("label").alias("_label"), "_text", F.col("id").alias(f"{name}_id"))
        same = F.col(f"{prefix}_label").eqNullSafe(F.col("_label")) & F.col(f"{prefix}_props").eqNullSafe(F.col("_text"))
        return rows.join(one, same).drop("_label", "_text")

    edges = bind(bind(triplets, "s", "start"), "o", "end").select(
        F.col("predicate").alias("label"), F.col("s_label").alias("start_label"), "start_id",
        F.col("o_label").alias("end_label"), "end_id", canonical_json(F.col("e_props")).alias("props"),
    )
    return grown, edges


def property_index(vertices: DataFrame) -> DataFrame:
    """Inverted table (label, key, value, value_text, id); value is typed JSON text."""
    return property_entries(vertices, "label", "id")
