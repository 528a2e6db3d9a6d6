"""SimHash near-duplicates through an inverted index over the byte positions of fingerprints."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce
from itertools import combinations, islice
from operator import add, xor

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knotwork.llm.common import NULL_ID, arrow_map, free_names, record, slices, whole_text
from knotwork.llm.setsketch import SetSketch, set_clusters, sketches
from knotwork.operators.clusters import entity_clusters
from knotwork.session import written

SEED = 42
BITS, BYTES = 64, 8
RADIUS = 2
#: Postings of at most so many fingerprints are compared pair by pair; the same bound holds for a list of one-bit variants.
POSTING_PAIRS = 64
HASHES_AT_ONCE = 1 << 16
#: Four byte positions of each index entry, and in how many entries a pair within the radius meets at least.
POSITIONS = [p for p in combinations(range(BYTES), 4) if not reduce(xor, p)]
GUARANTEED = min(sum(not {a, b} & set(p) for p in POSITIONS) for a, b in combinations(range(BYTES), 2))
#: Registers for similarities of 0.8: a pair of that similarity misses all bands with a probability of 0.0001.
SKETCH = SetSketch(bands=40, rows=7)

_hash = partial(xxhash.xxh64_intdigest, seed=SEED)


def _hashes(text: str, words: int) -> Iterator[int]:
    """Hashes of the shingles of a text; one of fewer words is a shingle, one without words has none."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return iter(())
    return map(_hash, [b" ".join(found)] if len(found) < words else map(b" ".join, zip(*(found[i:] for i in range(words)))))


def fingerprint(text: str, words: int = 3) -> int:
    """Majority vote of the shingle hashes, as a signed 64-bit number; 0 for a text without words."""
    ones, n = np.zeros(BITS, dtype=np.int64), 0
    hashes = _hashes(text, words)
    while len(some := np.fromiter(islice(hashes, HASHES_AT_ONCE), dtype=np.uint64)):
        ones += np.unpackbits(some[:, None].view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(some)
        if len(some) < HASHES_AT_ONCE:
            break
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_key, fp)`` of every row; a null text counts as empty, null ids stay null, other columns are left out."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [fingerprint(t) for t in part.column("text").to_pylist()]
            yield record(doc_id=part.column("doc_id"), text_key=part.column("text_key"), fp=pa.array(found, pa.int64()))

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(whole_text()).alias("text_key"), whole_text().alias("text"))
    return arrow_map(rows, work, "doc_id bigint, text_key bigint, fp bigint")


def _byte(fp: Column, position: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * position).bitwiseAND(F.lit(255))


def postings(prints: DataFrame) -> DataFrame:
    """``(positions, bytes, fp)``: index entries under the bytes at four positions at once.

    The positions are the 14 sets of four whose numbers have no bit left in their
    exclusive or; every two positions lie in three of them, so that whichever two
    are left out, three sets remain. Entries of a single byte would each hold
    1/256 of all fingerprints and make the number of pairs quadratic.
    """
    entries = []
    for no, chosen in enumerate(POSITIONS):
        key = reduce(add, [F.shiftleft(_byte(F.col("fp"), p), 8 * i) for i, p in enumerate(chosen)])
        entries.append(F.struct(F.lit(no).alias("positions"), key.alias("bytes")))
    return prints.select("fp", F.inline(F.array(*entries)))


def fingerprint_links(prints: DataFrame, radius: int = RADIUS, posting_pairs: int = POSTING_PAIRS) -> DataFrame:
    """``(a, b)`` links that connect exactly what the pairs of distinct fingerprints within ``radius`` bits connect.

    Two fingerprints within two bits differ at two byte positions at most, hence
    meet in ``GUARANTEED`` entries of the index at least. The entries in which a
    pair meets are tallied; pairs that reach that number are verified by their
    differing bits. Entries with more than ``posting_pairs`` members, whose pairs
    would grow with their square, form none: each of their fingerprints lists its
    variants of up to one flipped bit, and fingerprints with a common variant,
    which are at most 65 and lie within the radius of each other, hang on the
    smallest. That finds every pair that meets in such an entry, so what is not
    tallied there is not lost. It is exact too, for radius 2.
    """
    if radius != 2:
        raise ValueError("positions and variants are laid out for a radius of 2")
    entries = written(postings(prints), "postings")
    sizes = entries.groupBy("positions", "bytes").agg(F.count("*").alias("n")).filter("n > 1")
    sizes = written(sizes, "posting-sizes")
    short = entries.join(sizes.filter(F.col("n") <= posting_pairs).drop("n"), ["positions", "bytes"])
    short = written(short, "short-postings")
    met = short.withColumnRenamed("fp", "a").join(short.withColumnRenamed("fp", "b"), ["positions", "bytes"]).filter("a < b")
    tally = met.groupBy("a", "b").agg(F.count("*").alias("shared")).filter(F.col("shared") >= GUARANTEED)
    pairs = tally.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).select("a", "b")
    long = entries.join(sizes.filter(F.col("n") > posting_pairs).drop("n"), ["positions", "bytes"], "left_semi").select("fp").distinct()
    flips = F.array(F.lit(0).cast("bigint"), *[F.shiftleft(F.lit(1).cast("bigint"), i) for i in range(BITS)])
    variants = long.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("variant"))
    stars = (
        variants.groupBy("variant").agg(F.collect_list("fp").alias("members")).filter(F.size("members") > 1)
        .select(F.array_min("members").alias("a"), F.explode("members").alias("b")).filter("a < b").distinct()
    )
    return pairs.unionByName(stars)


def similar_links(docs: DataFrame, prints: DataFrame, similarity: float, words: int, sketch: SetSketch = SKETCH) -> DataFrame:
    """``(a, b)`` fingerprints that connect the documents whose sets of ``words``-word shingles have a Jaccard similarity of ``similarity``.

    Sets meet in bands of register values and are confirmed on all their
    elements; see ``setsketch.set_clusters``. Null and empty texts and texts
    without words have no set and take no part. ``prints`` is ``fingerprints(docs)``, stored.
    """
    sketched = written(sketches(docs, words, sketch), "shingle-sketches")
    linked = written(set_clusters(docs, sketched, words, similarity, sketch), "linked-sets")
    sets = sketched.filter("key IS NOT NULL").groupBy("text_key").agg(F.min("key").alias("key"))
    named = sets.join(linked, "key", "left").select("text_key", F.coalesce("cluster", "key").alias("cluster"))
    members = prints.groupBy("text_key").agg(F.min("fp").alias("b")).join(named, "text_key").select("cluster", "b").distinct()
    members = written(members, "prints-of-sets")
    least = members.groupBy("cluster").agg(F.min("b").alias("a"))
    return members.join(least, "cluster").filter("a != b").select("a", "b").distinct()


def near_duplicate_groups(docs: DataFrame, radius: int = RADIUS, similarity: float | None = None, words: int = 5) -> DataFrame:
    """One row per document: ``(doc_id, text_key, fp, root, component_id)``.

    ``component_id`` is the smallest doc_id that is reachable over links of at
    most ``radius`` differing bits, ``root`` names the group by one of its
    fingerprints. Null texts count as empty; texts without words share the
    fingerprint zero. Null ids are never smallest; a group of nothing else has
    a null component. Repeated rows are each returned. Extra columns are ignored.
    With ``similarity``, documents whose sets of ``words``-word shingles reach it are
    linked too; texts without words have no shingles, so that adds nothing to them.
    """
    prints = written(fingerprints(docs), "fingerprints")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    links = fingerprint_links(distinct.select("fp"), radius)
    if similarity is not None:
        links = links.unionByName(similar_links(docs, prints, similarity, words))
    linked = written(entity_clusters(links).select(F.col("id").alias("fp"), F.col("cluster").alias("root")), "linked-fingerprints")
    least = written(
        distinct.join(linked, "fp").groupBy("root").agg(F.min("least").alias("component_id")), "groups",
    )
    named = linked.join(least, "root")
    groups = written(
        distinct.join(named, "fp", "left").select(
            "fp", F.coalesce("root", "fp").alias("root"),
            F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"),
        ),
        "fingerprint-groups",
    )
    return prints.join(groups, "fp")


def keep_one_of_each_group(docs: DataFrame, radius: int = RADIUS, similarity: float | None = None, words: int = 5) -> DataFrame:
    """The documents with one row per near-duplicate group: its smallest doc_id (null last), then the smallest text hash."""
    no, key = free_names(docs, "_id", "_key")
    found = near_duplicate_groups(docs, radius, similarity, words)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key"))
    kept = found.groupBy("root").agg(first.alias("first")).select(
        F.coalesce("first.doc_id", F.lit(NULL_ID)).alias(no), F.col("first.text_key").alias(key),
    )
    kept = written(kept, "kept")
    rows = docs.withColumns({no: F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_ID)), key: F.xxhash64(whole_text())})
    return rows.join(kept, [no, key]).dropDuplicates([no, key]).drop(no, key)
