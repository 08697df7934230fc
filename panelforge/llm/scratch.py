"""Intermediate tables in the shared folder that the cluster names in spark.checkpoint.dir."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Spark's setting that drops the shuffle files of a query as soon as it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LIBC = ctypes.CDLL(None)
_own_dirs: dict[str, str] = {}
_written: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or where it is unset and all runs on one machine (tests) a temporary folder of this session."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if not context.master.startswith("local[") and context.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _own_dirs:
        _own_dirs[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="panelforge-")
    return _own_dirs[context.applicationId]


@contextmanager
def dropping_shuffles(spark: SparkSession):
    """Shuffle files of what is written meanwhile go with the end of the write."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut and no executor holds the only copy."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/panelforge-{uuid.uuid4().hex}"
    with dropping_shuffles(df.sparkSession):
        df.write.parquet(path)
    _written.append(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._panelforge_path = path
    return back


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def discard(*frames: DataFrame) -> None:
    """Delete what ``materialize`` wrote for ``frames``; nothing may read it later."""
    for df in frames:
        if path := getattr(df, "_panelforge_path", None):
            _delete(df.sparkSession, path)


def materialize_alone(make: Callable[[], DataFrame]) -> DataFrame:
    """The table of what ``make`` returns; the tables written on the way there are deleted."""
    before = len(_written)
    out = materialize(make())
    for path in _written[before:-1]:
        _delete(out.sparkSession, path)
    del _written[before:]
    return out


def text_slices(batch, column: int, size: int = 1 << 20):
    """(first row, texts) of a few rows of an Arrow batch at a time, of about ``size`` bytes, so that no batch is held twice."""
    texts = batch.column(column)
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(ends):
        before = int(ends[first - 1]) if first else 0
        stop = max(first + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield first, texts.slice(first, stop - first).to_pylist()
        first = stop


def give_back() -> None:
    """Return freed memory to the system; a worker lives on after its task and would keep the largest stage's."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def returning(run):
    """A task function that gives back its memory when it ends."""

    def tidy(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidy


def tasks(spark: SparkSession) -> int:
    """Shuffle partitions of the session, the task count of keyed Python stages."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
