"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwork.sinks.scratch import scratch_path

#: Whether Spark deletes a query's shuffle files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder: cuts the lineage and survives lost executors.

    What was shuffled for it goes as soon as it is written, not when the driver happens to collect garbage.
    """
    path, conf = scratch_path(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def renamed(df: DataFrame, **cols: str) -> DataFrame:
    """Only the named columns, under the operator's own names: further columns of the input can't clash with them."""
    return df.select(*(df[source].alias(name) for name, source in cols.items()))


T = TypeVar("T")


def worker_state(key: str, make: Callable[[], T]) -> T:
    """What ``make`` gave the first time in this worker process; what was kept under another key goes.

    Functions travel to the workers by value, each time with globals of their own, so what should outlast a task (a
    loaded vocabulary, words seen) is kept in a module that the process registers itself. There is one such thing at a
    time: workers outlive the stage that needs it.
    """
    state = vars(sys.modules.setdefault("tickwork_worker_state", types.ModuleType("tickwork_worker_state")))
    kept = state.get("kept")
    if kept is None or kept[0] != key:
        state["kept"] = kept = None
        give_back()
        state["kept"] = kept = (key, make())
        give_back()  # what reading a vocabulary took besides
    return kept[1]


def give_back() -> None:
    """Return freed memory to the system: what one stage has used would stay with the worker through the next ones."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # another C library
        pass


def forget_state() -> None:
    """Free what an earlier stage has kept in this worker process."""
    worker_state("", lambda: None)
    give_back()


def text_chunks(texts: list, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``limit`` characters each (one row at least), so scratch arrays stay small."""
    begin = size = 0
    for k, text in enumerate(texts):
        n = len(text or "")
        if k > begin and size + n > limit:
            yield begin, k
            begin, size = k, 0
        size += n
    if begin < len(texts):
        yield begin, len(texts)


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``: texts become Python strings few at a time."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id's decimal text mod 4 is 2; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
