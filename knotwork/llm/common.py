"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import knotwork

#: Stands for a null id in join keys; rows keep their null.
NULL_ID = -(2**63)
BYTES_PER_BATCH = 8 << 20


def whole_text(name: str = "text") -> Column:
    """The text column with null read as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of ``df`` has them."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = BYTES_PER_BATCH) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that Python holds about ``limit`` bytes of text at a time, and one row at least."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        total = max(batch.column(column).nbytes, 1)
        step = max(1, int(batch.num_rows * limit / total))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application; they need not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(knotwork.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="knotwork-code-")) / "knotwork_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent).as_posix())
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


#: What frees the caches of a worker process, and the operator that it works for.
RELEASES: list[Callable[[], None]] = []
_AT_WORK: list[str] = [""]


def start_work(operator: str) -> None:
    """Worker processes outlive stages; one that gets a task of another operator frees the caches of the last."""
    if _AT_WORK[0] != operator:
        _AT_WORK[0] = operator
        for release in RELEASES:
            release()


def arrow_map(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with this package on the executors."""
    ship(df.sparkSession)
    operator = work.__module__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start_work(operator)
        yield from work(batches)

    return df.mapInArrow(run, schema)


def record(**columns: pa.Array | list) -> pa.RecordBatch:
    arrays = [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c) for c in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))
