"""Node similarity, entity resolution and customer views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knotwork.functions import names as N
from knotwork.operators import clusters, customer
from knotwork.operators import graph as G
from knotwork.operators import resolution as E
from knotwork.operators import similarity as M
from knotwork.plans import fixtures as X
from knotwork.plans.fixtures import (
    SQL_APPLICANTS, SQL_CUSTOMER_PARTS, SQL_LINKS, SQL_PEOPLE, SQL_USER_PROPS, sql_identifiers,
)
from knotwork.plans.ingest_queries import SQL_JACCARD_UP, SQL_TOP5_UP
from knotwork.plans.registry import Tables, query
from knotwork.session import scratch_path
from knotwork.streaming.flows import file_feed, score_new_applications

CUTOFF = 0.45


def _round(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in cols})


# --- neighbour statistics -------------------------------------------------

SQL_IDF = """n AS (SELECT count(DISTINCT node)::DOUBLE AS n FROM up),
w AS (SELECT neighbor, count(*) AS degree, ln(any_value(n.n) / count(*)) AS weight FROM up, n GROUP BY neighbor)"""


@query("idf_weights", f"WITH {SQL_USER_PROPS}, {SQL_IDF} SELECT neighbor, degree, round(weight, 6) AS weight FROM w")
def _(t: Tables) -> DataFrame:
    return _round(M.idf_weights(X.user_props(t)), "weight")


@query("super_nodes", f"""WITH {SQL_CUSTOMER_PARTS}, d AS (SELECT neighbor, count(*) AS degree FROM cp GROUP BY neighbor)
SELECT neighbor, degree FROM d WHERE degree >= (SELECT quantile_cont(degree, 0.99) FROM d)""")
def _(t: Tables) -> DataFrame:
    return M.super_nodes(X.customer_parts(t), quantile=0.99)


@query("shared_neighbor_pairs", f"""WITH {SQL_CUSTOMER_PARTS} SELECT a.node AS node1, b.node AS node2, count(*) AS shared
FROM cp a JOIN cp b ON a.neighbor = b.neighbor AND a.node < b.node GROUP BY ALL""")
def _(t: Tables) -> DataFrame:
    """Every pair of customers that bought a part in common."""
    return M.shared_neighbor_pairs(X.customer_parts(t))


@query("shared_neighbor_pairs_all", f"""WITH {SQL_USER_PROPS} SELECT a.node AS node1, b.node AS node2, count(*) AS shared
FROM up a JOIN up b ON a.neighbor = b.neighbor AND a.node < b.node GROUP BY ALL""")
def _(t: Tables) -> DataFrame:
    return M.shared_neighbor_pairs(X.user_props(t), min_shared=1)


@query("neighbor_set_algebra_text", f"""WITH {SQL_JACCARD_UP}, p AS (SELECT node1, node2 FROM jac WHERE score >= 0.45 - 1e-12),
x AS (SELECT node1, node2, neighbor, 1 AS l, 0 AS r FROM p JOIN up ON node = node1 UNION ALL SELECT node1, node2, neighbor, 0, 1 FROM p JOIN up ON node = node2),
m AS (SELECT node1, node2, neighbor, sum(l) AS l, sum(r) AS r FROM x GROUP BY ALL)
SELECT 'u' || node1 AS node1, 'u' || node2 AS node2, count(*) FILTER (l > 0 AND r > 0) AS shared, count(*) AS "all" FROM m GROUP BY node1, node2""")
def _(t: Tables) -> DataFrame:
    """Sets of text neighbours of text nodes; their blocks are by hash, so sizes are added up over them."""
    pairs = X.user_props(t)
    near = M.node_similarity(pairs, cutoff=CUTOFF).select(*[F.concat(F.lit("u"), c).alias(c) for c in ("node1", "node2")])
    named = pairs.select(F.concat(F.lit("u"), "node").alias("node"), F.concat(F.lit("n"), "neighbor").alias("neighbor"))
    return G.neighbor_set_algebra(near, named).groupBy("node1", "node2").agg(
        F.sum(F.size("shared")).cast("bigint").alias("shared"), F.sum(F.size("all")).cast("bigint").alias("all")
    )


@query("neighbor_set_algebra", f"""WITH {SQL_JACCARD_UP}, p AS (SELECT node1, node2 FROM jac WHERE score >= 0.45 - 1e-12),
x AS (SELECT node1, node2, neighbor, 1 AS l, 0 AS r FROM p JOIN up ON node = node1 UNION ALL SELECT node1, node2, neighbor, 0, 1 FROM p JOIN up ON node = node2),
m AS (SELECT node1, node2, neighbor, sum(l) AS l, sum(r) AS r FROM x GROUP BY ALL)
SELECT node1, node2, neighbor >> 12 AS block, coalesce(string_agg(neighbor, ',' ORDER BY neighbor) FILTER (l > 0 AND r > 0), '') AS shared,
string_agg(neighbor, ',' ORDER BY neighbor) AS "all" FROM m GROUP BY node1, node2, block""")
def _(t: Tables) -> DataFrame:
    pairs = X.user_props(t)
    sets = G.neighbor_set_algebra(M.node_similarity(pairs, cutoff=CUTOFF), pairs)
    return sets.withColumns({c: F.array_join(F.col(c).cast("array<string>"), ",") for c in ("shared", "all")})


# --- node similarity ------------------------------------------------------

@query("jaccard_similarity", f"WITH {SQL_JACCARD_UP} SELECT node1, node2, round(score, 6) AS score FROM jac")
def _(t: Tables) -> DataFrame:
    """Every pair of users that share a value, whatever its score."""
    return _round(M.node_similarity(X.user_props(t), "jaccard"), "score")


@query("overlap_similarity", f"""WITH {SQL_JACCARD_UP} SELECT node1, node2, round(i::DOUBLE / least(x.d, y.d), 6) AS score
FROM sh JOIN deg x ON x.node = node1 JOIN deg y ON y.node = node2 WHERE i::DOUBLE / least(x.d, y.d) >= 0.65 - 1e-12""")
def _(t: Tables) -> DataFrame:
    return _round(M.node_similarity(X.user_props(t), "overlap", cutoff=0.65), "score")


_SHARED_WEIGHTS = f"""{SQL_USER_PROPS}, {SQL_IDF}, uw AS (SELECT node, neighbor, weight FROM up JOIN w USING (neighbor)),
tot AS (SELECT node, sum(weight) AS total, sqrt(sum(weight * weight)) AS norm FROM uw GROUP BY node),
sh AS (SELECT a.node AS node1, b.node AS node2, sum(a.weight) AS s, sum(a.weight * a.weight) AS q FROM uw a JOIN uw b
       ON a.neighbor = b.neighbor AND a.node < b.node GROUP BY ALL),
sc AS (SELECT node1, node2, s / (x.total + y.total - s) AS wj, q / (x.norm * y.norm) AS cosine
       FROM sh JOIN tot x ON x.node = node1 JOIN tot y ON y.node = node2)"""


@query("weighted_jaccard", f"WITH {_SHARED_WEIGHTS} SELECT node1, node2, round(wj, 6) AS score FROM sc WHERE wj >= 0.45 - 1e-12")
def _(t: Tables) -> DataFrame:
    return _round(M.node_similarity(X.user_props(t), "weighted_jaccard", cutoff=CUTOFF), "score")


@query("cosine_idf", f"WITH {_SHARED_WEIGHTS} SELECT node1, node2, round(cosine, 6) AS score FROM sc WHERE cosine >= 0.6 - 1e-12")
def _(t: Tables) -> DataFrame:
    return _round(M.node_similarity(X.user_props(t), "cosine", cutoff=0.6), "score")


@query("similarity_topk", f"WITH {SQL_TOP5_UP} SELECT node1, node2, round(score, 6) AS score FROM ranked WHERE r <= 5")
def _(t: Tables) -> DataFrame:
    return _round(M.node_similarity(X.user_props(t), "jaccard", cutoff=CUTOFF, top_k=5), "score")


@query("top_k_similar", f"""WITH {SQL_TOP5_UP.replace('0.45', '0.4')} SELECT node1, node2, round(score, 6) AS score FROM ranked WHERE r <= 3""")
def _(t: Tables) -> DataFrame:
    scores = M.node_similarity(X.user_props(t), "jaccard", cutoff=0.4)
    return _round(M.top_k_similar(M.mirrored(scores), top_k=3), "score")


@query("similarity_desc", f"WITH {SQL_JACCARD_UP} SELECT node1, node2, round(score, 6) AS score FROM jac WHERE score >= 0.45 - 1e-12 ORDER BY score DESC, node1, node2")
def _(t: Tables) -> DataFrame:
    return _round(M.similarity_desc(M.node_similarity(X.user_props(t), cutoff=CUTOFF)), "score")


# --- name comparison ------------------------------------------------------

_BLOCKS = f"""{SQL_PEOPLE}, {SQL_APPLICANTS},
pk AS (SELECT *, lower(substr(last_name, 1, 3)) || substr(zip, 1, 3) AS name_zip FROM people),
ak AS (SELECT *, lower(substr(last_name, 1, 3)) || substr(zip, 1, 3) AS name_zip FROM applicants),
pairs AS (SELECT a.id AS a_id, b.id AS b_id, a.last_name AS al, b.last_name AS bl, a.first_name AS af, b.first_name AS bf,
  a.zip AS az, b.zip AS bz, a.phone AS ap, b.phone AS bp, a.email AS ae, b.email AS be, a.business AS ab, b.business AS bb,
  CASE WHEN a.name_zip = b.name_zip THEN 1 ELSE 2 END AS pass_no
  FROM ak a JOIN pk b ON a.name_zip = b.name_zip OR a.email = b.email)"""
PASSES = [["name_zip"], ["email"]]


def _blocked(t: Tables) -> DataFrame:
    return E.blocking_pairs(X.with_block_keys(X.applicants(t)), X.with_block_keys(X.people(t)), PASSES)


@query("blocking_pairs", f"WITH {_BLOCKS} SELECT a_id, b_id, pass_no::INT AS pass_no FROM pairs")
def _(t: Tables) -> DataFrame:
    return _blocked(t).select("a_id", "b_id", "pass_no")


@query("name_edit_distance", f"WITH {_BLOCKS} SELECT a_id, b_id, levenshtein(al, bl)::INT AS distance FROM pairs")
def _(t: Tables) -> DataFrame:
    return _blocked(t).select("a_id", "b_id", N.edit_distance(F.col("a_last_name"), F.col("b_last_name")).alias("distance"))


def _sql_soundex(c: str) -> str:
    """Letter codes with H and W skipped, runs joined, vowels dropped."""
    codes = f"translate(regexp_replace(upper({c}), '[HW]', '', 'g'), 'ABCDEFGIJKLMNOPQRSTUVXYZ', '012301202245501262301202')"
    for d in "123456":
        codes = f"regexp_replace({codes}, '{d}+', '{d}', 'g')"
    return f"upper(substr({c}, 1, 1)) || rpad(substr(replace(substr({codes}, 2), '0', ''), 1, 3), 3, '0')"


@query("name_soundex", f"WITH {SQL_PEOPLE} SELECT id, {_sql_soundex('last_name')} AS code, {_sql_soundex('first_name')} = {_sql_soundex('last_name')} AS alike FROM people")
def _(t: Tables) -> DataFrame:
    return X.people(t).select(
        "id", F.soundex("last_name").alias("code"), N.same_sound(F.col("first_name"), F.col("last_name")).alias("alike")
    )


_BARE = "regexp_replace(lower({}), '[^a-z]', '', 'g')"
_AF, _BF = _BARE.format("af"), _BARE.format("bf")
_INITIAL = f"""({_AF} <> '' AND {_BF} <> '' AND ({_AF} = {_BF} OR (length({_AF}) = 1 AND starts_with({_BF}, {_AF}))
OR (length({_BF}) = 1 AND starts_with({_AF}, {_BF}))))"""


@query("initial_match", f"WITH {_BLOCKS} SELECT a_id, b_id, {_INITIAL} AS compatible FROM pairs")
def _(t: Tables) -> DataFrame:
    return _blocked(t).select("a_id", "b_id", N.initial_match(F.col("a_first_name"), F.col("b_first_name")).alias("compatible"))


# --- evidence and decisions -----------------------------------------------

# m and u per field are inputs of the model; these are the ones of the test people.
PARAMS = {
    "last_name": (0.9, 0.02), "first_name": (0.9, 0.08), "zip": (0.85, 0.001),
    "phone": (0.95, 0.0001), "email": (0.9, 0.001), "business": (0.95, 0.2),
}
PRIOR = 0.000001


def _near(a, b):
    return F.levenshtein(a, b) <= 1


FIELDS = {"last_name": _near, "first_name": N.initial_match, "zip": None, "phone": None, "email": None, "business": None}
_AGREE_SQL = {
    "last_name": ("al", "bl", "levenshtein(al, bl) <= 1"), "first_name": ("af", "bf", _INITIAL), "zip": ("az", "bz", "az = bz"),
    "phone": ("ap", "bp", "ap = bp"), "email": ("ae", "be", "ae = be"), "business": ("ab", "bb", "ab = bb"),
}
_COMPARED = _BLOCKS + ", cmp AS (SELECT a_id, b_id, " + ", ".join(
    f"CASE WHEN {x} IS NULL OR {y} IS NULL THEN NULL ELSE {c} END AS agree_{f}" for f, (x, y, c) in _AGREE_SQL.items()
) + " FROM pairs)"


def _weight_sql() -> str:
    terms = [
        f"CASE WHEN agree_{f} THEN log2({m}::DOUBLE / {u}::DOUBLE) WHEN NOT agree_{f} THEN log2((1 - {m}::DOUBLE) / (1 - {u}::DOUBLE)) ELSE 0 END"
        for f, (m, u) in PARAMS.items()
    ]
    return " + ".join(terms)


def _odds_sql(weight: str) -> str:
    return f"({PRIOR}::DOUBLE / (1 - {PRIOR}::DOUBLE) * pow(2, {weight}))"


_DECIDED = (
    f"{_COMPARED}, wt AS (SELECT *, {_weight_sql()} AS weight FROM cmp), "
    f"pr AS (SELECT *, {_odds_sql('weight')} / (1 + {_odds_sql('weight')}) AS probability FROM wt), "
    "dec AS (SELECT *, CASE WHEN probability > 0.9 THEN 'match' WHEN probability < 0.4 THEN 'new' ELSE 'review' END AS decision FROM pr)"
)


def _decided(t: Tables) -> DataFrame:
    weighed = E.match_weights(E.field_comparisons(_blocked(t), FIELDS), PARAMS)
    return E.match_decision(E.match_probability(weighed, PRIOR))


@query("field_comparisons", f"WITH {_COMPARED} SELECT * FROM cmp")
def _(t: Tables) -> DataFrame:
    compared = E.field_comparisons(_blocked(t), FIELDS)
    return compared.select("a_id", "b_id", *[f"agree_{f}" for f in FIELDS])


@query("match_weights", f"WITH {_DECIDED} SELECT a_id, b_id, round(weight, 6) AS weight FROM wt")
def _(t: Tables) -> DataFrame:
    return _round(_decided(t).select("a_id", "b_id", "weight"), "weight")


@query("match_probability", f"WITH {_DECIDED} SELECT a_id, b_id, round(probability, 6) AS probability FROM pr")
def _(t: Tables) -> DataFrame:
    return _round(_decided(t).select("a_id", "b_id", "probability"), "probability")


@query("match_decision", f"WITH {_DECIDED} SELECT a_id, b_id, decision FROM dec")
def _(t: Tables) -> DataFrame:
    return _decided(t).select("a_id", "b_id", "decision")


@query("review_queue", f"WITH {_DECIDED} SELECT a_id, b_id, round(probability, 6) AS probability FROM dec WHERE decision = 'review'")
def _(t: Tables) -> DataFrame:
    return _round(E.review_queue(_decided(t)).select("a_id", "b_id", "probability"), "probability")


_EQUAL_SQL = {"last_name": ("al", "bl"), "first_name": ("af", "bf"), "zip": ("az", "bz"), "phone": ("ap", "bp"), "email": ("ae", "be"), "business": ("ab", "bb")}
_LIKELY = (
    f"{SQL_PEOPLE}, {SQL_APPLICANTS}, cmp AS (SELECT a.id AS a_id, b.id AS b_id, "
    + ", ".join(f"a.{f} = b.{f} AS agree_{f}" for f in PARAMS)
    + " FROM applicants a CROSS JOIN people b), "
    f"wt AS (SELECT *, {_weight_sql()} AS weight FROM cmp), "
    f"pr AS (SELECT *, {_odds_sql('weight')} / (1 + {_odds_sql('weight')}) AS probability FROM wt)"
)


@query("likely_pairs", f"WITH {_LIKELY} SELECT a_id, b_id, round(probability, 6) AS probability FROM pr WHERE probability >= 0.4 - 1e-12")
def _(t: Tables) -> DataFrame:
    likely = E.likely_pairs(X.applicants(t), X.people(t), PARAMS, PRIOR, 0.4)
    return _round(likely.select("a_id", "b_id", "probability"), "probability")


@query("duplicate_or_new", f"""WITH {_LIKELY}, best AS (SELECT a_id, max(probability) AS p FROM pr GROUP BY a_id)
SELECT CASE WHEN p > 0.9 THEN 'match' WHEN p < 0.4 THEN 'new' ELSE 'review' END AS decision, count(*) AS n FROM best GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    applicants = X.applicants(t)
    likely = E.likely_pairs(applicants, X.people(t), PARAMS, PRIOR, 0.4)
    return E.duplicate_or_new(applicants, likely).groupBy("decision").agg(F.count("*").alias("n"))


# --- linking applicants ---------------------------------------------------

_IDS = f"{SQL_PEOPLE}, {SQL_APPLICANTS}, {sql_identifiers('pi', 'people')}, {sql_identifiers('ai', 'applicants')}"


@query("applicant_candidates", f"""WITH {_BLOCKS}, {sql_identifiers('pi', 'people')}, {sql_identifiers('ai', 'applicants')},
lk AS (SELECT ai.node AS a_id, pi.node AS b_id, count(*) AS shared FROM ai JOIN pi USING (neighbor) GROUP BY ALL),
bl AS (SELECT DISTINCT a_id, b_id FROM pairs WHERE pass_no = 1)
SELECT coalesce(lk.a_id, bl.a_id) AS a_id, coalesce(lk.b_id, bl.b_id) AS b_id, CASE WHEN bl.a_id IS NULL THEN 0 ELSE 1 END::INT AS same_block,
coalesce(shared, 0)::BIGINT AS shared FROM lk FULL JOIN bl ON lk.a_id = bl.a_id AND lk.b_id = bl.b_id""")
def _(t: Tables) -> DataFrame:
    new, known = X.with_block_keys(X.applicants(t)), X.with_block_keys(X.people(t))
    return E.applicant_candidates(new, known, PASSES[:1], X.identifiers(new), X.identifiers(known))


_BEST = f"""{_IDS}, n AS (SELECT count(DISTINCT node)::DOUBLE AS n FROM pi),
w AS (SELECT neighbor, ln(any_value(n.n) / count(DISTINCT node)) AS weight FROM pi, n GROUP BY neighbor),
aw AS (SELECT node, neighbor, coalesce(weight, ln(n.n)) AS weight FROM ai LEFT JOIN w USING (neighbor), n),
pw AS (SELECT node, neighbor, weight FROM pi JOIN w USING (neighbor)),
an AS (SELECT node, sqrt(sum(weight * weight)) AS norm FROM aw GROUP BY node),
pn AS (SELECT node, sqrt(sum(weight * weight)) AS norm FROM pw GROUP BY node),
sc AS (SELECT a.node AS node1, b.node AS node2, sum(a.weight * b.weight) / any_value(an.norm * pn.norm) AS score
  FROM aw a JOIN pw b USING (neighbor) JOIN an ON an.node = a.node JOIN pn ON pn.node = b.node GROUP BY ALL),
best AS (SELECT node1, node2, score FROM (SELECT *, row_number() OVER (PARTITION BY node1 ORDER BY score DESC, node2) AS r FROM sc WHERE score > 0.5) WHERE r = 1)"""
_LINKED = "SELECT id AS applicant_id, node2 AS linked_id, round(score, 6) AS score, CASE WHEN node2 IS NULL THEN 'new' ELSE 'linked' END AS outcome FROM applicants LEFT JOIN best ON node1 = id"
THRESHOLD = 0.5


def _existing(t: Tables) -> M.Existing:
    return M.prepare_existing(X.identifiers(X.people(t)), "cosine")


def _linked(t: Tables) -> DataFrame:
    new = X.applicants(t)
    return E.link_or_new(new, M.best_existing(X.identifiers(new), _existing(t), THRESHOLD), THRESHOLD)


@query("link_or_new", f"WITH {_BEST} {_LINKED}")
def _(t: Tables) -> DataFrame:
    return _round(_linked(t), "score")


@query("link_or_new_text", f"WITH {_BEST} SELECT 'a' || lpad(applicant_id::VARCHAR, 20, '0') AS applicant_id, 'p' || lpad(linked_id::VARCHAR, 20, '0') AS linked_id, score, outcome FROM ({_LINKED})")
def _(t: Tables) -> DataFrame:
    """Text ids on both sides, of equal length so that ties go the same way."""

    def named(df: DataFrame, sign: str, column: str) -> DataFrame:
        return df.withColumn(column, F.concat(F.lit(sign), F.lpad(F.col(column).cast("string"), 20, "0")))

    new = X.applicants(t)
    known = M.prepare_existing(named(X.identifiers(X.people(t)), "p", "node"), "cosine")
    best = M.best_existing(named(X.identifiers(new), "a", "node"), known, THRESHOLD)
    return _round(E.link_or_new(named(new.select("id"), "a", "id"), best, THRESHOLD), "score")


@query("private_result", f"WITH {_BEST} SELECT applicant_id, linked_id IS NOT NULL AS known, score FROM ({_LINKED})")
def _(t: Tables) -> DataFrame:
    return _round(E.private_result(_linked(t)), "score")


@query("score_new_applications", f"WITH {_BEST} {_LINKED}")
def _(t: Tables) -> DataFrame:
    feed_path, out, state = (scratch_path(t.spark, n) for n in ("feed", "linked", "state"))
    new = X.applicants(t)
    links = X.identifiers(new).groupBy(F.col("node").alias("id")).agg(F.collect_list("neighbor").alias("links"))
    links.write.parquet(feed_path)
    feed = file_feed(t.spark, feed_path, links.schema)
    existing = M.store_existing(_existing(t), scratch_path(t.spark, "existing"), rows_per_bucket=2000)
    return _round(score_new_applications(feed, existing, THRESHOLD, out, state), "score")


@query("structural_plus_name", f"""WITH {SQL_JACCARD_UP}, {SQL_PEOPLE} SELECT node1, node2, round(score, 6) AS score FROM jac
JOIN people p ON p.id = node1 JOIN people q ON q.id = node2
WHERE score >= 0.4 - 1e-12 AND (levenshtein(p.first_name, q.first_name) <= 2 OR substr(p.first_name, 1, 1) = substr(q.first_name, 1, 1))""")
def _(t: Tables) -> DataFrame:
    names = X.people(t).select(F.col("id").alias("node"), F.col("first_name").alias("name"))
    scores = M.node_similarity(X.user_props(t), cutoff=0.4)

    def compatible(a, b):
        return (N.edit_distance(a, b) <= 2) | (F.substring(a, 1, 1) == F.substring(b, 1, 1))

    return _round(E.structural_plus_name(scores, names, compatible).select("node1", "node2", "score"), "score")


@query("hashed_identifiers", f"WITH {SQL_PEOPLE} SELECT id, sha256('pepper' || lower(trim(phone))) AS phone, sha256('pepper' || lower(trim(email))) AS email FROM people")
def _(t: Tables) -> DataFrame:
    return X.people(t).select("id", *[N.hashed_identifier(F.col(c), "pepper").alias(c) for c in ("phone", "email")])


# --- clusters and profiles ------------------------------------------------

_CLUSTERS = f"""{SQL_LINKS}, both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(id, other) AS (SELECT c_custkey, c_custkey FROM customer UNION SELECT r.id, w.b FROM reach r JOIN both_ways w ON w.a = r.other),
cl AS (SELECT id, min(other) AS cluster FROM reach GROUP BY id)"""


def _clusters(t: Tables) -> DataFrame:
    return clusters.entity_clusters(X.customer_links(t), t.customer.select(F.col("c_custkey").alias("id")))


@query("entity_clusters", f"WITH RECURSIVE {_CLUSTERS} SELECT id, cluster FROM cl")
def _(t: Tables) -> DataFrame:
    return _clusters(t)


@query("entity_clusters_added", f"WITH RECURSIVE {_CLUSTERS} SELECT id, cluster FROM cl")
def _(t: Tables) -> DataFrame:
    """Half of the customers and links in a full run, then the others in two loads; the same clusters as in one run."""
    k, links = F.col("id"), X.customer_links(t)
    first = t.customer.select(F.col("c_custkey").alias("id")).filter(k % 8 < 4)
    both_known = (F.col("a") % 8 < 4) & (F.col("b") % 8 < 4)
    store = clusters.ClusterStore(clusters.entity_clusters(links.filter(both_known & (F.col("a") % 16 < 8)), first), scratch_path(t.spark, "clusters"), 500)
    store.add(links.filter(both_known & (F.col("a") % 16 >= 8)))
    alone = t.customer.select(F.col("c_custkey").alias("a"), F.col("c_custkey").alias("b")).filter(F.col("a") % 8 >= 4)
    store.add(links.filter(~both_known).unionByName(alone))
    return store.read()


def _profile_sql(field: str) -> str:
    return (f"(SELECT {field} FROM rows r WHERE r.cluster = c.cluster AND {field} IS NOT NULL ORDER BY seen DESC, id LIMIT 1) AS {field}")


_MERGED = f"""WITH RECURSIVE {_CLUSTERS}, {SQL_PEOPLE},
rows AS (SELECT p.id, cluster, last_name, CASE WHEN p.id % 3 <> 0 THEN phone END AS phone, CASE WHEN p.id % 5 <> 0 THEN email END AS email, p.id % 10 AS seen
  FROM people p JOIN cl ON cl.id = p.id),
f AS (SELECT cluster, count(*) AS records, first(last_name ORDER BY seen DESC, id) FILTER (last_name IS NOT NULL) AS last_name,
  first(phone ORDER BY seen DESC, id) FILTER (phone IS NOT NULL) AS phone, first(email ORDER BY seen DESC, id) FILTER (email IS NOT NULL) AS email
  FROM rows GROUP BY cluster) SELECT * FROM f"""


def _profile_rows(t: Tables) -> DataFrame:
    k = F.col("id")
    return X.people(t).withColumns({
        "phone": F.when(k % 3 != 0, F.col("phone")), "email": F.when(k % 5 != 0, F.col("email")), "seen": k % 10,
    })


@query("merged_profile", _MERGED)
def _(t: Tables) -> DataFrame:
    return E.merged_profile(_profile_rows(t), _clusters(t), ["last_name", "phone", "email"], "seen")


@query("merged_profile_text", _MERGED.replace("SELECT * FROM f", "SELECT 'c' || lpad(cluster::VARCHAR, 20, '0') AS cluster, * EXCLUDE (cluster) FROM f"))
def _(t: Tables) -> DataFrame:
    """The same with ids as text of equal length, so that their order is that of the numbers."""

    def named(df: DataFrame, *columns: str) -> DataFrame:
        return df.withColumns({c: F.concat(F.lit("c"), F.lpad(F.col(c).cast("string"), 20, "0")) for c in columns})

    clusters = named(_clusters(t), "id", "cluster")
    return E.merged_profile(named(_profile_rows(t), "id"), clusters, ["last_name", "phone", "email"], "seen")


# --- customer views -------------------------------------------------------

@query("enrich_customer", """WITH o AS (SELECT o_custkey AS k, count(*) AS orders, round(sum(o_totalprice), 2) AS spent,
strftime(max(o_orderdate), '%Y-%m-%d') AS last_order FROM orders GROUP BY 1),
e AS (SELECT user_id AS k, count(*) AS events, count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY 1)
SELECT c_custkey AS customer_id, c_name AS name, orders, spent, last_order, events, errors FROM customer
LEFT JOIN o ON o.k = c_custkey LEFT JOIN e ON e.k = c_custkey""")
def _(t: Tables) -> DataFrame:
    core = t.customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"))
    orders = t.orders.withColumnRenamed("o_custkey", "customer_id")
    events = t.events.withColumnRenamed("user_id", "customer_id")
    return customer.enrich_customer(core, "customer_id", {
        "transactions": (orders, [
            F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("spent"),
            F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("last_order"),
        ]),
        "interactions": (events, [
            F.count("*").alias("events"), F.count_if(F.col("event_type") == "error").alias("errors"),
        ]),
    })


@query("preferred_contact_hour", """WITH h AS (SELECT user_id, hour(ts) AS hour, count(*) AS n FROM events GROUP BY ALL)
SELECT user_id, hour::INT AS hour, n FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, hour) AS r FROM h) WHERE r = 1""")
def _(t: Tables) -> DataFrame:
    return customer.preferred_contact_hour(t.events)


@query("risk_connections", f"""WITH {SQL_CUSTOMER_PARTS}, f AS (SELECT node, neighbor FROM cp JOIN customer ON c_custkey = node WHERE c_acctbal < -900)
SELECT cp.node, cp.neighbor AS via, count(*) AS flagged, min(f.node) AS first_flagged FROM cp JOIN f ON f.neighbor = cp.neighbor AND f.node <> cp.node GROUP BY ALL""")
def _(t: Tables) -> DataFrame:
    flagged = t.customer.filter(F.col("c_acctbal") < -900).select(F.col("c_custkey").alias("node"))
    return customer.risk_connections(X.customer_parts(t), flagged)


_EVERYBODY = f"""{SQL_PEOPLE}, {SQL_APPLICANTS}, {sql_identifiers("pi", "people")}, {sql_identifiers("ai", "applicants")},
known AS (SELECT DISTINCT node, neighbor FROM (SELECT * FROM pi UNION ALL SELECT * FROM ai))"""


def _hop(number: int, before: str) -> str:
    """Level ``number`` of a search by levels: the first path in order to each node that no earlier level has."""
    return f"""v{number} AS (SELECT r.source, a.neighbor, min(list_append(r.path, a.neighbor)) AS path
  FROM h{number - 1} r JOIN known a ON a.node = r.node GROUP BY ALL),
h{number} AS (SELECT v.source, b.node, min(list_append(v.path, b.node::VARCHAR)) AS path FROM v{number} v JOIN known b ON b.neighbor = v.neighbor
  WHERE NOT EXISTS (SELECT 1 FROM ({before}) s WHERE s.source = v.source AND s.node = b.node) GROUP BY ALL)"""


_LEVELS = [f"SELECT source, node FROM h{i}" for i in range(3)]


@query("risk_paths", f"""WITH {_EVERYBODY},
h0 AS (SELECT id AS source, id AS node, []::VARCHAR[] AS path FROM applicants),
{", ".join(_hop(i, " UNION ALL ".join(_LEVELS[:i])) for i in (1, 2, 3))},
reach AS ({" UNION ALL ".join(f"SELECT source, node, {i} AS hops, path FROM h{i}" for i in (1, 2, 3))})
SELECT source AS node, node AS flagged, hops, array_to_string(path[:-2], ' > ') AS through FROM reach WHERE node % 13 = 0 AND node IN (SELECT id FROM people)""")
def _(t: Tables) -> DataFrame:
    """Applicants and the flagged customers they are connected to by up to three shared identifiers."""
    new, old = X.applicants(t), X.people(t)
    pairs = X.identifiers(old).unionByName(X.identifiers(new))
    asked, flagged = new.select(F.col("id").alias("node")), old.select(F.col("id").alias("node")).filter("node % 13 = 0")
    found = customer.risk_paths(pairs, asked, flagged, 3)
    return found.select("node", "flagged", "hops", F.array_join("path", " > ").alias("through"))
