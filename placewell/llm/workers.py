"""Python workers: the package on their path, small batches, and memory given back."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
BATCH_BYTES = 8 << 20  # of an Arrow batch, in the executor and in the worker
Work = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def importable(spark: SparkSession) -> None:
    """Add the folder of the package to the workers' path, and keep their batches small.

    Enough where executors see that folder; elsewhere ship the package with the job, for
    example with ``--py-files``. A batch has as many rows as fit into BATCH_BYTES; a row
    that is larger comes alone. No result depends on that.
    """
    known = spark.sparkContext.environment
    paths = known.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        known["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


@lru_cache(maxsize=1)
def trimmer() -> Callable[[int], int] | None:
    """The C library's way to give freed memory back, where it has one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Give the memory that this process has freed back to the machine.

    Workers live on from task to task; what they keep for later counts against the
    executor that runs beside them.
    """
    pa.default_memory_pool().release_unused()
    trim = trimmer()
    if trim is not None:
        trim(0)


@lru_cache(maxsize=1)
def be_thrifty() -> None:
    """Have this process give large arrays back as soon as they are freed.

    The C library otherwise takes blocks of up to 32 MB from its heap once some have been
    freed, and keeps them; the pool of Arrow keeps what it has, too.
    """
    pa.set_memory_pool(pa.system_memory_pool())
    options = getattr(ctypes.CDLL(None), "mallopt", None)
    if options is not None:
        options(-3, 1 << 20)  # M_MMAP_THRESHOLD


def lean(work: Work, thrifty: bool = True) -> Work:
    """``work``, with its memory given back when the task ends, and large arrays at once if ``thrifty``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if thrifty:
            be_thrifty()
        try:
            yield from work(batches)
        finally:
            release()

    return run


def with_field(batches: Iterator[pa.RecordBatch], struct: str, field: str, name: str) -> Iterator[pa.RecordBatch]:
    """The batches with a field of a struct as a column beside it, not copied."""
    for batch in batches:
        yield batch.append_column(name, batch.column(struct).field(field))
