"""Shared working storage.

Everything a job must be able to read again after losing an executor goes below the folder the
cluster names in ``spark.checkpoint.dir``. Only a local session without that setting gets a
temporary folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}
#: Where the rows of a frame from ``materialise`` lie, and what the innermost ``temporary_rows`` has to remove.
_stored_at: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_to_remove: ContextVar[list[str] | None] = ContextVar("to_remove", default=None)
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_root(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = _local_roots.get(context.applicationId)
    if root is None:
        root = tempfile.mkdtemp(prefix="fraudlane-")
        _local_roots[context.applicationId] = root
        context.setCheckpointDir(root)
    return root


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A path nobody has used; the first writer creates it."""
    return f"{scratch_root(spark)}/{unique_name(purpose)}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries started inside have their shuffle files removed as soon as they end.

    Left to itself Spark removes them when the driver's collector has found their plans unused, which a driver with memory
    to spare puts off for long. For queries whose rows are stored, as nothing reads the files again.
    """
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once and continue from the stored rows; what the write shuffled is removed when it has ended."""
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    with shuffles_removed(spark):
        df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    _stored_at[stored] = path
    if (inner := _to_remove.get()) is not None:
        inner.append(path)
    return stored


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def discard(*frames: DataFrame) -> None:
    """Remove rows that ``materialise`` stored and that nothing will read again, also no frame made of them.

    Other frames are left alone, so no file that this library has not written is ever removed.
    """
    for frame in frames:
        path = _stored_at.pop(frame, None)
        if path is not None:
            _remove(frame.sparkSession, path)
            if (inner := _to_remove.get()) and path in inner:
                inner.remove(path)


@contextmanager
def temporary_rows(spark: SparkSession) -> Iterator[Callable[..., None]]:
    """Rows that ``materialise`` stores inside are removed at the end, all but those of the frames that are passed to
    what this yields; these belong to the block around, if there is one. After an error everything stays."""
    around, inner, kept = _to_remove.get(), [], set()

    def keep(*frames: DataFrame) -> None:
        kept.update(_stored_at[f] for f in frames if f in _stored_at)

    token = _to_remove.set(inner)
    try:
        yield keep
    finally:
        _to_remove.reset(token)
        if around is not None:
            around.extend(p for p in inner if p in kept)
    for path in inner:
        if path not in kept:
            _remove(spark, path)
