"""How the sources of a language differ in their words, priced from joint tables of count levels."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from knotwork.llm.common import arrow_map, record, ship, slices, whole_text
from knotwork.session import written

SMOOTHING = 5
SCALE = 1_000_000_000
LEAST_DOCS = 30
TOP_TERMS = 50
#: Size of a matrix block: so many terms of a language against so many of its sources.
BLOCK_TERMS, BLOCK_SOURCES = 256, 32
#: Different (source, term) counts that a task holds before it sends them.
HELD_COUNTS = 300_000
#: A-Z to a-z; small letters and all bytes of other characters stay; every other byte ends a term.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text in order."""
    return text.translate(_LETTERS).split()


def term_counts(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)``, terms as UTF-8 bytes; each group has a row with a null term, even without terms.

    Tasks add up their documents before anything is shuffled, and send what they
    hold whenever that reaches ``HELD_COUNTS`` entries.
    """

    def sent(n: dict, docs: dict) -> pa.RecordBatch:
        rows = [(lang, source, term, k, docs[lang, source][term]) for (lang, source), found in n.items() for term, k in found.items()]
        rows += [(lang, source, None, 0, 0) for lang, source in n]
        lang, source, term, k, d = zip(*rows)
        return record(
            lang=pa.array(lang, pa.string()), source=pa.array(source, pa.string()), term=pa.array(term, pa.binary()),
            n=pa.array(k, pa.int64()), docs=pa.array(d, pa.int64()),
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, docs = defaultdict(Counter), defaultdict(Counter)
        for part in slices(batches):
            for lang, source, text in zip(*(part.column(c).to_pylist() for c in ("lang", "source", "text"))):
                found = terms(text)
                n[lang, source].update(found)
                docs[lang, source].update(set(found))
            if sum(map(len, n.values())) >= HELD_COUNTS:
                yield sent(n, docs)
                n.clear(), docs.clear()
        if n:
            yield sent(n, docs)

    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")), whole_text().cast("binary").alias("text"))
    found = arrow_map(rows, work, "lang string, source string, term binary, n bigint, docs bigint")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def price(n: Column, total: Column, vocabulary: Column) -> Column:
    """1 + floor(scale (n + smoothing) / (total + smoothing x vocabulary)), exactly."""
    wide = "decimal(20,0)"
    over = (n + SMOOTHING).cast(wide) * F.lit(SCALE).cast("decimal(10,0)")
    under = total.cast(wide) + vocabulary.cast(wide) * F.lit(SMOOTHING).cast("decimal(1,0)")
    return F.lit(1).cast("bigint") + F.call_function("div", over, under)


def joint_prices(block: pa.Table) -> Iterator[tuple[bytes, bytes, int]]:
    """``(a, b, value)`` for the pairs of sources of one matrix block, a before b.

    Every (source, count level) is an indicator column over the terms of the
    block, level 0 included. The product of a source's columns, transposed, with
    all columns holds its joint tables: how many terms have level i in the one and
    level j in the other. Products are exact in single precision as a block has
    far below 2^24 terms. A joint table is priced by the distance of its levels' prices.
    """
    term, source = block.column("term").combine_chunks(), block.column("source").combine_chunks()
    n, cost = (block.column(c).to_numpy() for c in ("n", "price"))
    is_term, is_source = source.is_null().to_numpy(False), term.is_null().to_numpy(False)
    row_of = {t: i for i, t in enumerate(term.filter(pa.array(is_term)).to_pylist())}
    names = sorted(source.filter(pa.array(is_source)).to_pylist())
    column_of = {s: i for i, s in enumerate(names)}
    counts, prices = np.zeros((2, len(row_of), len(names)), dtype=np.int64)
    for s, c in zip(source.to_pylist(), np.where(is_source, cost, -1).tolist()):
        if c >= 0:
            prices[:, column_of[s]] = c
    at = np.flatnonzero(~is_term & ~is_source)
    rows = [row_of[t] for t in term.take(pa.array(at)).to_pylist()]
    columns = [column_of[s] for s in source.take(pa.array(at)).to_pylist()]
    counts[rows, columns], prices[rows, columns] = n[at], cost[at]
    level, level_price, starts = np.empty_like(counts), [], []
    for s in range(len(names)):
        _, first, inverse = np.unique(counts[:, s], return_index=True, return_inverse=True)
        starts.append(sum(map(len, level_price)))
        level[:, s] = inverse + starts[-1]
        level_price.append(prices[first, s])
    of_level = np.concatenate(level_price)
    indicator = np.zeros((len(row_of), len(of_level)), dtype=np.float32)
    np.put_along_axis(indicator, level, 1, axis=1)
    for s, own in enumerate(level_price):
        joint = indicator[:, starts[s] : starts[s] + len(own)].T @ indicator
        worth = (joint.astype(np.int64) * np.abs(own[:, None] - of_level[None, :])).sum(axis=0)
        for other, value in zip(names[s + 1 :], np.add.reduceat(worth, starts)[s + 1 :].tolist()):
            yield names[s], other, value


def _pair_values(groups: DataFrame, counts: DataFrame, kept: DataFrame) -> DataFrame:
    """``(lang, a, b, value)`` for the pairs of sources of a language that has kept terms."""
    sources = groups.groupBy("lang").agg(F.count("*").alias("sources"))
    sizes = groups.select("lang", "vocabulary").distinct().join(sources, "lang").filter("vocabulary > 0 AND sources > 1").select(
        "lang", F.ceil(F.col("vocabulary") / BLOCK_TERMS).alias("term_blocks"), F.ceil(F.col("sources") / BLOCK_SOURCES).alias("source_blocks"),
    )
    sizes = written(sizes, "block-sizes")  # a row per language
    term_block = F.pmod(F.xxhash64("term"), "term_blocks").alias("term_block")
    source_block = F.pmod(F.xxhash64("source"), "source_blocks").alias("source_block")
    others, blank = F.explode(F.expr("sequence(0L, source_blocks - 1)")).alias("other"), F.lit(None)

    def paired(rows: DataFrame) -> DataFrame:
        return rows.select(
            "lang", "term_block", F.least("source_block", "other").alias("i"), F.greatest("source_block", "other").alias("j"),
            "term", "source", "n", "price",
        )

    found = counts.join(sizes, "lang").select("lang", term_block, source_block, others, "term", "source", "n", "price")
    all_terms = kept.join(sizes, "lang").select("lang", term_block, "source_blocks", others, "term").select(
        "lang", "term_block", F.explode(F.expr("sequence(0L, other)")).alias("source_block"), "other",
        "term", blank.cast("string").alias("source"), F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("price"),
    )
    all_sources = groups.join(sizes, "lang").select("lang", source_block, "term_blocks", others, "source", "zero").select(
        "lang", F.explode(F.expr("sequence(0L, term_blocks - 1)")).alias("term_block"), "source_block", "other",
        blank.cast("binary").alias("term"), "source", F.lit(0).cast("bigint").alias("n"), F.col("zero").alias("price"),
    )
    cells = paired(found).unionByName(paired(all_terms)).unionByName(paired(all_sources))

    def work(key: tuple[pa.Scalar, ...], block: pa.Table) -> pa.Table:
        across = key[2].as_py() != key[3].as_py()
        rows = list(joint_prices(block))
        if across:  # pairs within one block of sources come from its own cell
            place = dict(zip(block.column("source").to_pylist(), block.column("own").to_pylist()))
            rows = [r for r in rows if place[r[0]] != place[r[1]]]
        return pa.table({
            "lang": pa.array([key[0].as_py()] * len(rows), pa.string()), "a": pa.array([r[0] for r in rows], pa.string()),
            "b": pa.array([r[1] for r in rows], pa.string()), "value": pa.array([r[2] for r in rows], pa.int64()),
        })

    ship(groups.sparkSession)
    owned = cells.join(sizes.select("lang", "source_blocks"), "lang").withColumn("own", F.pmod(F.xxhash64("source"), "source_blocks")).drop("source_blocks")
    parts = owned.groupBy("lang", "term_block", "i", "j").applyInArrow(work, "lang string, a string, b string, value bigint")
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: distances of a source to the others, and the terms it prefers most.

    A language keeps the terms that ``least_docs`` of its documents hold. Part
    ``pair`` has a row for every other source of the language with the sum over
    all kept terms of the distance of their smoothed shares, in units of 1 /
    ``SCALE``, which is 0 without kept terms; part ``term`` has the ``top_terms``
    terms whose share in the source exceeds that in the language most. Ties are
    ordered by the bytes of the item.

    Null text, lang and source count as ''. Groups without terms take part in
    pairs. Repeated rows count as documents of their own. Texts are never cut.
    Extra columns are ignored; an empty table gives no rows.
    """
    counts = written(term_counts(docs), "term-counts")
    kept = counts.filter("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
    kept = written(kept.filter(F.col("docs") >= least_docs).drop("docs"), "kept-terms")
    vocabulary = kept.groupBy("lang").agg(F.count("*").alias("vocabulary"), F.sum("lang_n").alias("lang_total"))
    held = written(counts.drop("docs").join(kept, ["lang", "term"]), "kept-counts")
    totals = held.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    none = F.lit(0).cast("bigint")
    groups = counts.filter("term IS NULL").select("lang", "source").join(totals, ["lang", "source"], "left").join(vocabulary, "lang", "left")
    groups = groups.select("lang", "source", *(F.coalesce(c, none).alias(c) for c in ("total", "vocabulary", "lang_total")))
    priced = F.when(F.col("vocabulary") > 0, price(none, F.col("total"), F.col("vocabulary"))).otherwise(none)
    groups = written(groups.withColumn("zero", priced), "source-totals")
    held = held.join(groups.drop("zero"), ["lang", "source"]).withColumns({
        "price": price(F.col("n"), F.col("total"), F.col("vocabulary")),
        "lang_price": price(F.col("lang_n"), F.col("lang_total"), F.col("vocabulary")),
    })
    held = written(held.select("lang", "source", "term", "n", "price", "lang_price"), "priced-counts")

    values = written(_pair_values(groups, held, kept), "pair-values")
    back = values.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value")
    others = groups.select("lang", F.col("source").alias("b"))
    pairs = groups.select("lang", F.col("source").alias("a")).join(others, "lang").filter("a != b")
    pairs = pairs.join(values.unionByName(back), ["lang", "a", "b"], "left").select(
        "lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), F.coalesce("value", none).alias("value"),
    )
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pairs = pairs.withColumn("rank", F.row_number().over(by_value))
    best = held.filter("n > 0 AND price > lang_price").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("price") - F.col("lang_price")).alias("value"),
    )
    best = best.withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= top_terms)
    return pairs.unionByName(best.withColumn("item", F.col("item").cast("string")))
