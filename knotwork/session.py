"""Session defaults and the shared folder used for checkpoints and scratch tables."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "knotwork", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark. On a cluster the submitter configures the session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A temporary folder is picked only for a local master that names none; on a
    cluster a missing setting is an error, because a machine-local folder would
    be lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _LOCAL_DIRS:
        _LOCAL_DIRS[context.applicationId] = tempfile.mkdtemp(prefix="knotwork-")
    return _LOCAL_DIRS[context.applicationId]


_SCOPES: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, so that runs never overwrite each other."""
    path = f"{shared_dir(spark)}/knotwork-{name}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes what was stored in the shared folder inside the block when it ends.

    Write or collect results before that; tables that are read later do not
    belong inside. Scopes may be nested; each deletes its own paths only.
    """
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Store an intermediate result in the shared folder and read it back.

    Used where a result feeds several later steps: it is computed once, its
    lineage is cut, it survives lost executors, and the planner sees its size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
