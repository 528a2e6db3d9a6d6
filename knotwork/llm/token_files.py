"""Token-id files: one id array, and document boundaries as Elias-Fano sequences with a select structure."""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from knotwork.llm.common import arrow_map, record, slices, whole_text
from knotwork.llm.word_ids import DroppedSpace, word_ids
from knotwork.session import written

# Fixed values of the file format.
MAGIC = b"KWIDS1\n\0"
SELECT_BLOCK = 512  # bits of the upper vector per entry of the select directory
FOOTER = struct.Struct("<Q8s")

IDS_PER_READ = 1 << 21
POPCOUNT = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


class EliasFano:
    """A non-decreasing sequence of numbers from 0 in about 2 + log2(universe / n) bits each.

    The low bits of each number are packed; the high parts are written in unary
    as a bit vector. ``select`` finds the i-th one through a directory of ones
    before each block of 512 bits, 32 bits an entry.
    """

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray) -> None:
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        ones = POPCOUNT[high]
        per_block = np.add.reduceat(ones, np.arange(0, len(high), SELECT_BLOCK // 8), dtype=np.uint32) if len(high) else np.zeros(0, np.uint32)
        self.before = np.concatenate([[0], np.cumsum(per_block)]).astype(np.uint32)

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        if n == 0:
            return cls(0, 0, np.zeros(0, np.uint8), np.zeros(0, np.uint8))
        low_bits = max(0, ((int(values[-1]) + 1) // n).bit_length() - 1)
        low = np.zeros(0, np.uint8)
        if low_bits:
            shifts = np.arange(low_bits, dtype=np.uint64)
            low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        places = (values >> np.uint64(low_bits)) + np.arange(n, dtype=np.uint64)
        bits = np.zeros(int(places[-1]) + 1, dtype=np.uint8)
        bits[places] = 1
        return cls(n, low_bits, low, np.packbits(bits, bitorder="little"))

    def to_bytes(self) -> bytes:
        return struct.pack("<QBQQ", self.n, self.low_bits, len(self.low), len(self.high)) + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, low_bits, n_low, n_high = struct.unpack_from("<QBQQ", data)
        at = struct.calcsize("<QBQQ")
        return cls(n, low_bits, np.frombuffer(data, np.uint8, n_low, at), np.frombuffer(data, np.uint8, n_high, at + n_low))

    def select(self, i: int) -> int:
        """Place of the i-th one in the upper vector."""
        block = int(np.searchsorted(self.before, i, side="right")) - 1
        start = block * SELECT_BLOCK // 8
        bits = np.unpackbits(self.high[start : start + SELECT_BLOCK // 8], bitorder="little")
        return start * 8 + int(np.flatnonzero(bits)[i - int(self.before[block])])

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        return int(self.values(i, i + 1)[0])

    def values(self, start: int, stop: int) -> np.ndarray:
        """Entries ``start`` to ``stop``, found by two selects."""
        if stop <= start:
            return np.zeros(0, np.uint64)
        first, last = self.select(start), self.select(stop - 1)
        bits = np.unpackbits(self.high[first // 8 : last // 8 + 1], bitorder="little")
        places = np.flatnonzero(bits).astype(np.uint64) + np.uint64(first // 8 * 8)
        places = places[(places >= first) & (places <= last)]
        upper = (places - np.arange(start, stop, dtype=np.uint64)) << np.uint64(self.low_bits)
        if not self.low_bits:
            return upper
        bit = start * self.low_bits
        some = np.unpackbits(self.low[bit // 8 : (stop * self.low_bits + 7) // 8], bitorder="little")
        some = some[bit % 8 : bit % 8 + (stop - start) * self.low_bits].reshape(-1, self.low_bits).astype(np.uint64)
        return upper + (some << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


class ShardWriter:
    """Ids first, as they come; then the boundaries, the doc ids and a footer. The file appears under its name when whole."""

    def __init__(self, folder: str, name: str, width: int) -> None:
        self.fs, root = _file_system(folder)
        self.path, self.uri = f"{root}/{name}", f"{folder}/{name}"
        self.part = f"{self.path}.{uuid.uuid4().hex}.part"
        self.fs.create_dir(root, recursive=True)
        self.out, self.width = self.fs.open_output_stream(self.part), width
        self.out.write(MAGIC)
        self.ends, self.doc_ids, self.no_id, self.n_ids = [], [], 0, 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.out.write(ids.astype(f"<u{self.width}").tobytes())
        self.n_ids += len(ids)
        self.ends.append(self.n_ids)
        if doc_id is None:
            self.no_id += 1
        else:
            self.doc_ids.append(doc_id)

    def close(self) -> None:
        least = self.doc_ids[0] if self.doc_ids else 0
        bounds = EliasFano.of(np.array([0, *self.ends], dtype=np.uint64)).to_bytes()
        names = EliasFano.of(np.array([d - least for d in self.doc_ids], dtype=np.uint64)).to_bytes()
        head = json.dumps({
            "width": self.width, "n_docs": len(self.ends), "n_ids": self.n_ids, "no_id": self.no_id, "least_id": least,
            "bounds": len(bounds), "names": len(names),
        }).encode()
        index = head.ljust(256) + bounds + names
        self.out.write(index + FOOTER.pack(len(index), MAGIC))
        self.out.close()
        self.fs.move(self.part, self.path)

    def abandon(self) -> None:
        self.out.close()
        with suppress(OSError):
            self.fs.delete_file(self.part)


class ShardReader:
    """Random access to one file: boundaries by select, ids by offset."""

    def __init__(self, uri: str) -> None:
        fs, path = _file_system(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        length, magic = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} is no id file")
        index = self.file.read_at(length, size - FOOTER.size - length)
        self.head = json.loads(index[:256])
        self.bounds = EliasFano.from_bytes(index[256 : 256 + self.head["bounds"]])
        self.names = EliasFano.from_bytes(index[256 + self.head["bounds"] :])
        self.n_docs = self.head["n_docs"]

    def ids(self, start: int, stop: int) -> np.ndarray:
        width = self.head["width"]
        return np.frombuffer(self.file.read_at((stop - start) * width, len(MAGIC) + start * width), dtype=f"<u{width}")

    def doc_ids(self, start: int, stop: int) -> list[int | None]:
        """Null ids come first."""
        no_id, least = self.head["no_id"], self.head["least_id"]
        named = self.names.values(max(start - no_id, 0), max(stop - no_id, 0))
        return [None] * (min(stop, no_id) - min(start, no_id)) + [int(v) + least for v in named]

    def document(self, i: int) -> np.ndarray:
        return self.ids(self.bounds[i], self.bounds[i + 1])

    def close(self) -> None:
        self.file.close()


def write_id_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> DataFrame:
    """Encode every text, append ``end_id``, and write files in ascending doc_id order; returns the stored manifest.

    One file per range partition of doc_id; its rows are streamed, only the
    boundaries are held. Manifest rows are (shard, path, n_docs, n_ids, base):
    shards in doc_id order, ``base`` being the ids in all shards before. Null ids
    come first, equal ids follow in the order of their texts' hashes, null texts
    are empty. A repeated task writes the same file again and replaces it whole.
    Ids take two bytes each if the vocabulary allows it, else four.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer, DroppedSpace)
        width = 2 if max(words.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        shard, end, out = TaskContext.get().partitionId(), np.array([end_id], dtype="<u4").tobytes(), None
        try:
            for part in slices(batches):
                out = out or ShardWriter(folder, f"ids-{shard:08d}.kw", width)
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    out.add(doc_id, np.frombuffer(words.ids(text) + end, dtype="<u4"))
            if out:
                out.close()
        except BaseException:
            if out:
                out.abandon()
            raise
        if out:
            yield record(
                shard=pa.array([shard], pa.int64()), path=[out.uri],
                n_docs=pa.array([len(out.ends)], pa.int64()), n_ids=pa.array([out.n_ids], pa.int64()),
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), F.xxhash64("text")
    )
    manifest = written(arrow_map(ordered, work, "shard bigint, path string, n_docs bigint, n_ids bigint"), "shards")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file, not for each document
    return written(manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("bigint"))), "manifest")


def read_id_files(manifest: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, from the files alone; ``start`` counts over all shards."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
                shard = ShardReader(path)
                done = 0
                while done < shard.n_docs:
                    first = shard.bounds[done]
                    stop = min(done + 4096, shard.n_docs)
                    bounds = shard.bounds.values(done, stop + 1).astype(np.int64)
                    stop = done + max(1, int(np.searchsorted(bounds, first + IDS_PER_READ, side="right")) - 1)
                    stop = min(stop, shard.n_docs, done + 4096)
                    bounds = bounds[: stop - done + 1]
                    data = shard.ids(int(bounds[0]), int(bounds[-1])).astype("<u4")
                    cuts = bounds - bounds[0]
                    crcs = [zlib.crc32(data[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
                    yield record(
                        doc_id=pa.array(shard.doc_ids(done, stop), pa.int64()), start=pa.array(bounds[:-1] + base, pa.int64()),
                        n_tokens=pa.array(np.diff(bounds), pa.int64()), ids_crc32=pa.array(crcs, pa.int64()),
                    )
                    done = stop
                shard.close()

    files = max(1, manifest.count())
    return arrow_map(
        manifest.select("path", "base").repartition(files), work,
        "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
