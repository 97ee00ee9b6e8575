"""What Python workers need: this package, and memory given back between tasks."""

from __future__ import annotations

import ctypes
import gc
import shutil
import tempfile
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import SparkSession

_shipped: set[str] = set()
# Caches of this process that outlive its tasks.
_kept: list = []


def ship_package(spark: SparkSession) -> None:
    """Send the package to the workers of a session, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="stintlab-package-")) / package.name
    archive = shutil.make_archive(str(target), "zip", package.parent, package.name)
    # Spark itself hands the file to the executors.
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def kept_in_worker(maxsize: int) -> Callable:
    """An lru_cache that lasts from task to task of a worker process, up to the first that does not name it."""

    def wrap(fn: Callable):
        _kept.append(lru_cache(maxsize=maxsize)(fn))
        return _kept[-1]

    return wrap


def give_back(*keep) -> None:
    """Return to the system what earlier tasks of this worker process have freed, and their caches but those to keep.

    Workers live on from task to task, and neither the allocator nor Arrow's pool gives memory back by
    itself, so without this a worker keeps the most that any of its tasks has needed.
    """
    for cache in _kept:
        if cache not in keep:
            cache.cache_clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(task: Callable[[Iterator], Iterator], *keep) -> Callable[[Iterator], Iterator]:
    """The task, giving memory back before and after it: a worker that waits holds no more than the caches to keep."""

    def run(batches):
        give_back(*keep)
        yield from task(batches)
        give_back(*keep)

    return run
