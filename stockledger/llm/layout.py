"""Rows in a global order, with running positions, without one task that sees them all."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockledger.llm.scratch import written

PART, START = "part", "start_in_part"
Mapper = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def tidy(mapper: Mapper) -> Mapper:
    """``mapper``, giving memory that it has freed back to the system when a task ends.

    Python workers serve one task after another; what their allocators keep would count beside the next task's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from mapper(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return run


def ordered(
    df: DataFrame, order: list[Column | str], length: str, name: str, mapper: Mapper | None = None, schema: str = ""
) -> DataFrame:
    """``df`` range-partitioned and sorted by ``order``, written, with ``part`` (the partition's place in the
    order, int) and ``start_in_part`` (the sum of ``length`` before the row within it, long).

    A ``mapper`` turns the sorted rows into rows of ``schema`` first. Spark reads ``df`` twice, once to draw the
    ranges, so costly work belongs into the mapper or into a written table. The result is written so that
    positions stay the same when an executor is lost: a second sampling of the ranges could cut the partitions
    elsewhere. Rows that tie in ``order`` keep whatever order they were written in.
    """
    fields = T._parse_datatype_string(schema).fields if mapper else df.schema.fields
    schema_out = T.StructType([*fields, T.StructField(PART, T.IntegerType()), T.StructField(START, T.LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in mapper(batches) if mapper else batches:
            sizes = batch.column(batch.schema.get_field_index(length)).to_numpy(zero_copy_only=False).astype("int64")
            starts = at + sizes.cumsum() - sizes
            at += int(sizes.sum())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * len(sizes), pa.int32()), pa.array(starts, pa.int64())],
                names=schema_out.names,
            )

    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(sorted_rows.mapInArrow(tidy(number), schema_out), name)


def part_starts(table: DataFrame, length: str) -> dict[int, int]:
    """Where each part of an ``ordered`` table begins: one number for each partition."""
    sums = table.groupBy(PART).agg(F.sum(length).alias("n")).orderBy(PART).collect()
    found, at = {}, 0
    for row in sums:
        found[row[PART]] = at
        at += row["n"]
    return found


def slices(batch: pa.RecordBatch, column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in pieces that hold about ``most`` bytes of a text or binary column, one row at least."""
    sizes = batch.column(batch.schema.get_field_index(column))
    at, held = 0, 0
    for k, value in enumerate(sizes):
        held += len(value.as_buffer()) if value.is_valid else 0
        if held >= most:
            yield batch.slice(at, k + 1 - at)
            at, held = k + 1, 0
    if at < batch.num_rows:
        yield batch.slice(at)
