"""SentencePiece encoding and decoding through a table of distinct marked words."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knotwork.llm.common import arrow_map, record, slices, whole_text
from knotwork.session import written

MARK = "▁"
BLOCK_BYTES = 16 << 20
BYTES_PER_BUCKET, MOST_BUCKETS = 32 << 20, 1 << 16
CACHED_WORDS = 400_000
_MARKED = re.compile(f"{MARK}+[^{MARK}]*")


@lru_cache(maxsize=2)
def _processor(model: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=model)


def check_model(model: str) -> None:
    """Raise unless white space markers only stand at the start of pieces, so that no piece crosses from word to word."""
    processor = _processor(model)
    crossing = [p for i in range(processor.get_piece_size()) if MARK in (p := processor.id_to_piece(i)).lstrip(MARK)]
    if crossing:
        raise ValueError(f"pieces cross white space markers: {crossing[:5]}")


def marked_words(text: str) -> list[str]:
    """A text as the model sees it (a mark in front, marks for spaces), cut before each run of marks; the first mark is left out."""
    if not text:
        return []
    if "  " not in text and MARK not in text and text[0] != " ":
        return text.split(" ")
    return [w[1:] for w in _MARKED.findall(MARK + text.replace(" ", MARK))]


def segment(words: list[str], model: str) -> list[list[int]]:
    """Ids of marked words (given without their first mark)."""
    processor = _processor(model)
    found = processor.encode([w.replace(MARK, " ") for w in words], num_threads=1)
    return [ids if w else [processor.piece_to_id(MARK)] for w, ids in zip(words, found)]


def _squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _join(words: list[str]) -> bytes:
    lengths = np.array([len(w) for w in words], dtype="<u4")
    return _squeeze(len(words).to_bytes(4, "little") + lengths.tobytes() + "".join(words).encode("utf-8", "surrogatepass"))


def _split(data: bytes) -> list[str]:
    data = zstandard.ZstdDecompressor().decompress(data)
    n = int.from_bytes(data[:4], "little")
    ends = np.cumsum(np.frombuffer(data, "<u4", n, 4)).tolist()
    text = data[4 + 4 * n :].decode("utf-8", "surrogatepass")
    return [text[a:b] for a, b in zip([0, *ends[:-1]], ends)]


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """Runs of about 16 MB of text, named by their content, so that both passes name them alike."""
    held, size = [], 0
    for part in slices(batches):
        held.append(part)
        size += part.column("text").nbytes
        if size >= BLOCK_BYTES:
            yield _named(held)
            held, size = [], 0
    if held:
        yield _named(held)


def _named(parts: list[pa.RecordBatch]) -> tuple[int, list[pa.RecordBatch]]:
    name = xxhash.xxh3_64()
    for p in parts:
        name.update(repr(p.column("doc_id").to_pylist()).encode())
        for text in p.column("text").to_pylist():
            name.update(text.encode("utf-8", "surrogatepass"))
            name.update(b"\xff")
    return name.intdigest() - (1 << 63), parts


def bucket_count(docs: DataFrame) -> int:
    """Buckets for the words of a table: a task each, more than the session's shuffle partitions if the table is large."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(size // BYTES_PER_BUCKET, MOST_BUCKETS))


def encode_table(docs: DataFrame, model: str, buckets: int | None = None) -> DataFrame:
    """``(block, kind, bucket, data)`` with kind 0: the ids of the distinct words of each block of documents.

    Words are dealt by hash into ``buckets`` (``bucket_count`` by default); each bucket segments every distinct word of the whole input
    once and answers all blocks. A row holds the words of one block and bucket,
    sorted and compressed, and comes back with their ids in the same order.
    """
    n = buckets or bucket_count(docs)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, parts in _blocks(batches):
            words: set[str] = set()
            for p in parts:
                for text in p.column("text").to_pylist():
                    words.update(marked_words(text))
            dealt = defaultdict(list)
            for w in words:
                dealt[xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) % n].append(w)
            del words
            for some in np.array_split(sorted(dealt), 1 + len(dealt) // 64):
                yield record(
                    block=pa.array([block] * len(some), pa.int64()), bucket=pa.array(some, pa.int32()),
                    data=pa.array([_join(sorted(dealt[b])) for b in some.tolist()], pa.binary()),
                )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, bytes] = {}
        last = None
        for batch in batches:
            for block, bucket, data in zip(*(batch.column(c).to_pylist() for c in ("block", "bucket", "data"))):
                if bucket != last or len(known) > CACHED_WORDS:
                    known, last = {}, bucket
                words = _split(data)
                new = [w for w in words if w not in known]
                known.update(zip(new, segment(new, model)))
                ids = [known[w] for w in words]
                counts = np.array([len(i) for i in ids], dtype="<u4").tobytes()
                flat = np.array([i for one in ids for i in one], dtype="<u4").tobytes()
                both = len(words).to_bytes(4, "little") + counts + flat
                yield record(
                    block=pa.array([block], pa.int64()), kind=pa.array([0], pa.int32()), bucket=pa.array([bucket], pa.int32()),
                    data=pa.array([data], pa.binary()), ids=pa.array([_squeeze(both)], pa.binary()),
                )

    found = arrow_map(docs, collect, "block bigint, bucket int, data binary")
    return arrow_map(
        found.repartition("bucket").sortWithinPartitions("bucket"), answer,
        "block bigint, kind int, bucket int, data binary, ids binary"
    )


def _table(rows: Iterable[tuple[bytes, bytes]]) -> tuple[dict[str, str], list[str], list[list[int]]]:
    csv, words_all, ids_all = {}, [], []
    for data, squeezed in rows:
        words, raw = _split(data), zstandard.ZstdDecompressor().decompress(squeezed)
        n = int.from_bytes(raw[:4], "little")
        counts = np.frombuffer(raw, "<u4", n, 4)
        flat = np.frombuffer(raw, "<u4", -1, 4 + 4 * n)
        text, at = list(map(str, flat.tolist())), 0
        for word, count in zip(words, counts.tolist()):
            csv[word] = ",".join(text[at : at + count])
            at += count
        words_all += words
    return csv, words_all, ids_all


def encode_decode(docs: DataFrame, model: str, buckets: int | None = None, as_read: bool = False) -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded)`` digests of every whole text; see ``op8``.

    Blocks of documents and their answered word tables meet in one task, the
    table first; ids are then joined by each word's position in its text. Null
    texts count as empty and have no ids. Repeated rows, null ids and texts of
    any length are encoded like others; extra columns are ignored.

    The rows are gone through twice and must come in the same order both times.
    They are stored first for that, unless ``as_read`` says that ``docs`` is read
    from files as they lie, without a shuffle, which gives the same blocks every time.
    """
    check_model(model)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    rows = rows if as_read else written(rows, "texts-in-order")
    n = buckets or bucket_count(rows)
    table = encode_table(rows, model, n)

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, parts in _blocks(batches):
            for no, part in enumerate(parts):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_batch(pa.RecordBatch.from_arrays([pa.concat_arrays([c]) for c in part.columns], schema=part.schema))
                yield record(
                    block=pa.array([block], pa.int64()), kind=pa.array([1], pa.int32()), bucket=pa.array([no], pa.int32()),
                    data=pa.array([sink.getvalue().to_pybytes()], pa.binary()), ids=pa.array([None], pa.binary()),
                )

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, csv, other = None, {}, {}
        processor = _processor(model)
        for batch in batches:
            for block, kind, data, ids in zip(*(batch.column(c).to_pylist() for c in ("block", "kind", "data", "ids"))):
                if block != last:
                    last, csv, other = block, {}, {}
                if kind == 0:
                    found, words, _ = _table([(data, ids)])
                    csv.update(found)
                    decoded = processor.decode([list(map(int, found[w].split(","))) for w in words])
                    other.update((w, d) for w, d in zip(words, decoded) if d != w)
                    continue
                with pa.ipc.open_stream(data) as stream:
                    part = stream.read_next_batch()
                out = []
                for text in part.column("text").to_pylist():
                    words = marked_words(text)
                    joined = ",".join(map(csv.__getitem__, words))
                    back = text
                    if other and not other.keys().isdisjoint(words):
                        back = " ".join(other.get(w, w) for w in words)
                    out.append((
                        joined.count(",") + 1 if words else 0, hashlib.sha256(joined.encode()).hexdigest(),
                        hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest(),
                    ))
                n_tokens, ids_sha, text_sha = zip(*out)
                yield record(
                    doc_id=part.column("doc_id"), n_tokens=pa.array(n_tokens, pa.int64()),
                    ids_sha256=pa.array(ids_sha), decoded_sha256=pa.array(text_sha),
                )

    both = table.unionByName(arrow_map(rows, carry, "block bigint, kind int, bucket int, data binary, ids binary"))
    return arrow_map(
        both.repartition("block").sortWithinPartitions("block", "kind", "bucket"), assemble,
        "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
