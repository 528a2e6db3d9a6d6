"""Best-fit packing of documents into sequences, planned on the histogram of piece lengths."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from knotwork.llm.common import arrow_map, record, slices, whole_text
from knotwork.llm.word_ids import LeadingSpace, word_ids
from knotwork.session import written

CAPACITY = 1024


def cut(n_tokens: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: whole if it fits, else full pieces behind a first that may be shorter."""
    first = n_tokens % capacity or min(n_tokens, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n_tokens, capacity)]


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: ``(doc_id, piece, start, length, ids_crc32, part, nth)``.

    ``nth`` numbers the pieces of one length within the task ``part``; the table
    must be stored before it is used twice. Null texts are empty and have the end id only.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part_no = word_ids(tokenizer, LeadingSpace), TaskContext.get().partitionId()
        end, seen = np.array([end_id], dtype="<u4").tobytes(), np.zeros(capacity + 1, dtype=np.int64)
        for part in slices(batches):
            out = []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                data = memoryview(words.ids(text) + end)
                for no, (start, length) in enumerate(cut(len(data) // 4, capacity)):
                    out.append((doc_id, no, start, length, zlib.crc32(data[4 * start : 4 * (start + length)]), int(seen[length])))
                    seen[length] += 1
            doc_id, no, start, length, crc, nth = zip(*out)
            yield record(
                doc_id=pa.array(doc_id, pa.int64()), piece=pa.array(no, pa.int32()), start=pa.array(start, pa.int64()),
                length=pa.array(length, pa.int64()), ids_crc32=pa.array(crc, pa.int64()),
                part=pa.array([part_no] * len(out), pa.int64()), nth=pa.array(nth, pa.int64()),
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    return arrow_map(
        rows, work, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part bigint, nth bigint"
    )


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[dict[str, int]]:
    """Best-fit decreasing over a histogram ``{length: pieces}``.

    Sequences with the same content are one group with a count. A length goes to
    the groups with the least room that still holds it, as many pieces to each
    sequence as fit, then to new sequences: what best fit does piece by piece.
    A length adds at most four groups, so there are at most 4 x capacity groups
    whatever the number of documents, and a group holds fewer than
    sqrt(2 x capacity) different lengths. Rows are slots: pieces of ``length``
    with ranks from ``first_rank`` to ``end_rank`` lie ``each`` to a sequence,
    from ``first_sequence`` on, the first at ``offset``.
    """
    room: dict[int, list[tuple[int, tuple[tuple[int, int], ...]]]] = {}

    def put(free: int, sequences: int, content: tuple[tuple[int, int], ...]) -> None:
        if sequences:
            room.setdefault(free, []).append((sequences, content))

    for length in sorted((n for n, c in counts.items() if c), reverse=True):
        left = counts[length]
        for free in sorted(f for f in room if f >= length):
            if not left:
                break
            for sequences, content in room.pop(free):
                each = free // length
                full = min(sequences, left // each)
                rest = min(left - full * each, each) if full < sequences else 0
                put(free - each * length, full, (*content, (length, each)))
                put(free - rest * length, 1 if rest else 0, (*content, (length, rest)))
                put(free, sequences - full - (1 if rest else 0), content)
                left -= full * each + rest
        each = capacity // length
        put(capacity - each * length, left // each, ((length, each),))
        put(capacity - left % each * length, 1 if left % each else 0, ((length, left % each),))
    slots, ranks, sequence = [], dict.fromkeys(counts, 0), 0
    for groups in room.values():
        for sequences, content in groups:
            offset = 0
            for length, each in content:
                first = ranks[length]
                ranks[length] = first + each * sequences
                slots.append({
                    "length": length, "first_rank": first, "end_rank": ranks[length], "each": each,
                    "first_sequence": sequence, "offset": offset,
                })
                offset += each * length
            sequence += sequences
    return slots


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` of every piece.

    The histogram is all that comes to the driver (``capacity`` rows at most),
    and the plan, of bounded size for any input, is all that is broadcast.
    Pieces meet their slot by length and by their rank within the length: the
    number of such pieces in the tasks before plus the number within the task,
    so no length is ever gathered or sorted. An empty table gives no rows;
    repeated rows and null ids are packed like any other; extra columns are ignored.
    """
    spark = docs.sparkSession
    rows = written(pieces(docs, tokenizer, end_id, capacity), "pieces")
    tallies = written(rows.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-tallies")
    counts = {r["length"]: r["n"] for r in tallies.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    schema = "length bigint, first_rank bigint, end_rank bigint, each bigint, first_sequence bigint, offset bigint"
    slots = spark.createDataFrame([tuple(s.values()) for s in plan(counts, capacity)], schema)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = written(tallies.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0).cast("bigint")).alias("base")), "piece-bases")
    ranked = rows.join(bases, ["part", "length"]).withColumn("rank", F.col("base") + F.col("nth"))
    slot = F.broadcast(slots.withColumnRenamed("length", "slot_length"))
    placed = ranked.join(
        slot,
        (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("end_rank")),
    )
    place = F.col("rank") - F.col("first_rank")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first_sequence") + F.floor(place / F.col("each")).cast("bigint")).alias("sequence_id"),
        (F.col("offset") + place % F.col("each") * F.col("length")).alias("offset"),
    )
