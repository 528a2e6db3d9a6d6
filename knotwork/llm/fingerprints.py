"""SimHash fingerprints of documents and exact search within a Hamming radius; DataFrame functions only."""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from knotwork.llm.common import NULL_ID, whole_text
from knotwork.session import written

HALVES = ("hi", "lo")  # a fingerprint is two signed 64-bit numbers
BITS = 128
RADIUS = 3
_FIELD = 0x0000000100000001
_LOW = 0xFFFFFFFF


def terms(text: Column) -> Column:
    """Array of (h, w): hash and weight of each term, a term being a word with the one after it.

    The weight is the length of the first word, as longer words tell more about a
    text than short ones. The weights of a text sum to less than its characters.
    """
    words = F.split(F.lower(text), r"\s+")
    return F.zip_with(
        words, F.slice(words, 2, F.size(words)),
        lambda a, b: F.struct(F.xxhash64(a, b).alias("h"), F.length(a).cast("bigint").alias("w")),
    )


def simhash(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` with the fingerprint (hi, lo) of the texts under them; keys must be unique, null texts count as empty.

    Every term adds its weight to the vote for each set bit of its hash; a bit of
    the fingerprint is set if it has more than half of all weight. One sum counts
    two bits, 32 bits apart, in the halves of a 64-bit number: a text has fewer
    than 2**31 characters, so the lower half cannot flow over. Texts without
    words have the fingerprint zero. Rows of one text lie in one task, so sums are
    complete before anything is exchanged.
    """
    rows = texts.select(*keys, F.inline(terms(F.coalesce(F.col(text), F.lit("")))))
    hashes = {"hi": F.col("h"), "lo": F.xxhash64("h")}
    rows = rows.select(*keys, "w", *[c.alias(half) for half, c in hashes.items()])
    votes = [
        F.sum(F.shiftrightunsigned(half, i).bitwiseAND(F.lit(_FIELD)) * F.col("w")).alias(f"{half}{i}")
        for half in HALVES for i in range(32)
    ]
    summed = rows.groupBy(*keys).agg(F.sum("w").alias("weight"), *votes)

    def bits(half: str) -> Column:
        def one(votes: Column, bit: int) -> Column:
            return F.when(2 * votes > F.col("weight"), F.shiftleft(F.lit(1).cast("bigint"), bit)).otherwise(F.lit(0).cast("bigint"))

        parts = []
        for i in range(32):
            both = F.col(f"{half}{i}")
            parts += [one(both.bitwiseAND(F.lit(_LOW)), i), one(F.shiftrightunsigned(both, 32), i + 32)]
        return reduce(lambda a, b: a.bitwiseOR(b), parts)

    return summed.select(*keys, *[bits(half).alias(half) for half in HALVES])


def as_text(hi: str, lo: str) -> Column:
    return F.concat(*[F.lpad(F.lower(F.hex(c)), 16, "0") for c in (hi, lo)])


def differing(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    return reduce(add, [F.bit_count(x.bitwiseXOR(y)) for x, y in zip(a, b)])


def block_tables(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The rows once per table: ``(table, block, ...)``, each table keyed by another block of bits brought to the front.

    With radius + 1 blocks, two fingerprints within the radius agree in one block
    at least, so they meet in a table. ``radius`` is 1 or 3 here.
    """
    if radius not in (1, 3):
        raise ValueError("128 bits are cut into 2 or 4 blocks: radius is 1 or 3")
    per_half = (radius + 1) // 2
    width = 64 // per_half
    blocks = []
    for half in HALVES:
        for i in range(per_half):
            blocks.append(F.col(half) if width == 64 else F.shiftrightunsigned(half, width * i).bitwiseAND(F.lit((1 << width) - 1)))
    keyed = F.array(*[F.struct(F.lit(no).alias("table"), b.alias("block")) for no, b in enumerate(blocks)])
    return prints.select("*", F.inline(keyed))


def near_fingerprints(queries: DataFrame, prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(hi, lo, near_hi, near_lo, <other columns of prints>)``: all of ``prints`` within ``radius`` bits of each query.

    Both sides are (hi, lo, ...) without repeats. A pair is reported by the first
    table in which it meets; no bucket is cut short. Buckets are joined by key,
    so adaptive execution can split long ones.
    """
    ours = block_tables(queries.select("hi", "lo"), radius)
    theirs = block_tables(prints.withColumnsRenamed({"hi": "near_hi", "lo": "near_lo"}).select(
        "*", F.col("near_hi").alias("hi"), F.col("near_lo").alias("lo")), radius).drop("hi", "lo")
    left, right = ours.alias("q"), theirs.alias("p")
    xor = [F.col("q.hi").bitwiseXOR(F.col("p.near_hi")), F.col("q.lo").bitwiseXOR(F.col("p.near_lo"))]
    per_half = (radius + 1) // 2
    width = 64 // per_half
    agree = []
    for no in range(radius + 1):
        part = xor[no // per_half]
        part = part if width == 64 else F.shiftrightunsigned(part, width * (no % per_half)).bitwiseAND(F.lit((1 << width) - 1))
        agree.append(part == 0)
    earlier = [reduce(or_, [agree[t] for t in range(no)]) & (F.col("q.table") == no) for no in range(1, radius + 1)]
    met = left.join(
        right,
        (F.col("q.table") == F.col("p.table")) & (F.col("q.block") == F.col("p.block"))
        & (reduce(add, [F.bit_count(x) for x in xor]) <= radius) & ~reduce(or_, earlier),
    )
    return met.select("q.hi", "q.lo", *[F.col(f"p.{c}") for c in theirs.columns if c not in ("table", "block")])


def next_documents(docs: DataFrame) -> DataFrame:
    """``(idk, th, n, copies, rank, next_idk, next_th)``: each document with the next in descending doc_id, the last with the first.

    Documents are rows of different (doc_id, text hash); repeated rows are one
    with a number of copies. Equal ids follow by text hash, null ids come last.
    Only ids, hashes and lengths are sorted, by ranges; a row's rank is the rows
    in the ranges before plus its place in its own.
    """
    found = docs.groupBy("idk", "th", "n").agg(F.count("*").alias("copies"))
    order = [F.col("idk").desc(), F.col("th").desc()]  # NULL_ID is smaller than other ids
    places = found.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    places = written(places, "order").withColumn("part", F.shiftright("at", 33))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    bases = written(places.groupBy("part").agg(F.count("*").alias("rows")), "ranges")
    bases = bases.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0).cast("bigint")).alias("base"))
    ranked = places.join(bases, "part").select(
        "idk", "th", "n", "copies", (F.col("base") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).alias("rank")
    )
    ranked = written(ranked, "ranked")
    total = max(1, ranked.count())
    after = ranked.select(
        F.pmod(F.col("rank") - 1, F.lit(total)).alias("rank"), F.col("idk").alias("next_idk"), F.col("th").alias("next_th"),
        F.lit(total).alias("total"),
    )
    return ranked.join(after, "rank")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text; one row per row of ``docs``, ids may be null or repeated.

    The edited text has its last floor(n / 3) characters replaced by the first
    as many of the next document. Columns: doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next, hi, lo. Likeness is
    the share of equal bits. Extra columns of ``docs`` are ignored; null texts
    count as empty; a table of one row has itself as the next.
    """
    base = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_ID)).alias("idk"), whole_text().alias("text"))
    base = base.select("idk", F.xxhash64("text").alias("th"), "text")
    order = written(next_documents(base.select("idk", "th", F.length("text").cast("bigint").alias("n"))), "next")
    share = F.floor(F.col("n") / 3).cast("int")
    wanted = order.select(
        F.col("next_idk").alias("idk"), F.col("next_th").alias("th"), F.col("idk").alias("owner"), F.col("th").alias("owner_th"), "n",
    )
    heads = base.join(wanted, ["idk", "th"]).select("idk", "th", "owner", "owner_th", "n", F.substring("text", F.lit(1), share).alias("head"))
    heads = heads.dropDuplicates(["idk", "th"]).select(F.col("owner").alias("idk"), F.col("owner_th").alias("th"), "n", "head")
    both = base.join(heads, ["idk", "th"]).select(
        "idk", "th", "text", F.concat(F.substring("text", F.lit(1), F.col("n").cast("int") - share), "head").alias("edited"),
    )
    both = both.dropDuplicates(["idk", "th"])
    texts = both.select("idk", "th", F.inline(F.array(
        F.struct(F.lit(0).alias("which"), F.lit("").alias("sha"), F.col("text").alias("text")),
        F.struct(F.lit(1).alias("which"), F.sha2("edited", 256).alias("sha"), F.col("edited").alias("text")),
    )))
    prints = written(simhash(texts, ["idk", "th", "which", "sha"]), "simhashes")
    plain = prints.filter("which = 0").select("idk", "th", "hi", "lo")
    edited = prints.filter("which = 1").select("idk", "th", "sha", F.col("hi").alias("ehi"), F.col("lo").alias("elo"))
    nexts = plain.select(F.col("idk").alias("next_idk"), F.col("th").alias("next_th"), F.col("hi").alias("nhi"), F.col("lo").alias("nlo"))
    rows = order.join(plain, ["idk", "th"]).join(edited, ["idk", "th"]).join(nexts, ["next_idk", "next_th"])
    own = (F.col("hi"), F.col("lo"))
    return rows.select(
        F.when(F.col("idk") != NULL_ID, F.col("idk")).alias("doc_id"), F.col("n").alias("n_chars"), F.col("sha").alias("edited_sha256"),
        as_text("hi", "lo").alias("fingerprint"), as_text("ehi", "elo").alias("edited_fingerprint"),
        (1 - differing(own, (F.col("ehi"), F.col("elo"))) / BITS).alias("near_edited"),
        (1 - differing(own, (F.col("nhi"), F.col("nlo"))) / BITS).alias("near_next"),
        "hi", "lo", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    ).drop("copy")


def with_near_counts(rows: DataFrame, every: int = 20, radius: int = RADIUS) -> DataFrame:
    """``rows`` with ``n_near``: for ids divisible by ``every``, how many other documents have a fingerprint within ``radius`` bits."""
    rows = written(rows, "fingerprinted")
    distinct = written(rows.groupBy("hi", "lo").agg(F.count("*").alias("documents")), "distinct-simhashes")
    asked = rows.filter(F.col("doc_id") % every == 0).select("hi", "lo").distinct()
    near = near_fingerprints(asked, distinct, radius).groupBy("hi", "lo").agg(F.sum("documents").alias("documents"))
    counted = rows.join(written(near, "near-counts"), ["hi", "lo"], "left")
    return counted.withColumn("n_near", F.when(F.col("doc_id") % every == 0, F.col("documents") - 1)).drop("documents")
