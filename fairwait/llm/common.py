"""Helpers that the corpus operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from fairwait.session import scratch_path

# A Python worker handles so many bytes of text at once, whatever the rows' sizes.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again: cut lineage, computed once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def met_by_sort(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is never broadcast: operators of many joins else keep one small table each in the driver's memory."""
    return df.hint("merge")


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose ``column`` (text, bytes or a list of 32-bit numbers) holds about ``limit`` bytes; a longer row comes alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column)
        lengths = pc.multiply(pc.list_value_length(values), 4) if pa.types.is_list(values.type) else pc.binary_length(values)
        sizes = pc.fill_null(lengths, 0).to_numpy(zero_copy_only=False)
        parts = np.cumsum(sizes.astype(np.int64)) // limit
        cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1), batch.num_rows]
        for a, z in zip(cuts, cuts[1:]):
            yield batch.slice(a, z - a)


def give_back() -> None:
    """Return what a worker holds but no longer uses to the system: it stays idle beside the next stage's work."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow, with ``give_back`` at the end of each task."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return whole


def texts(column: pa.Array) -> list[str]:
    """Python strings, null as empty."""
    return [t or "" for t in column.to_pylist()]


def list_array(values: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


def unused(df: DataFrame, *wanted: str) -> list[str]:
    """Names like the wanted ones that ``df`` does not use (without regard to case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
