"""Values of keys that many documents share, asked for once a block of documents.

A block is what one task gathers until its texts or distinct keys reach a bound.  It numbers its keys,
keeps of each document only (place of the key, times), and asks for each key once, in rows packed by
bucket.  The answers come back to the block, where each document sums the values of its own keys.  So a
key that every document holds costs one item a block, and no document's keys are ever joined one by one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import list_array


def first_block() -> int:
    """Where a task begins to number its blocks."""
    return TaskContext.get().partitionId() << 32


def packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32 by byte plane: the planes of small numbers are all zeros and compress to nothing."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def entry_columns(places: list[np.ndarray], times: list[np.ndarray]) -> list[pa.Array]:
    """``places, times`` of documents: where their distinct keys are in the block, ascending, and how often."""
    steps = [packed(np.diff(at, prepend=0)) for at in places]
    return [pa.array(steps, pa.binary()), pa.array([packed(n) for n in times], pa.binary())]


def asked(block: int, buckets: np.ndarray, keys: pa.Array, counts: np.ndarray | None = None) -> dict[str, pa.Array]:
    """Columns ``block, bucket, at, keys`` (and ``n``): the keys of a block as one row for each bucket."""
    order = np.argsort(buckets, kind="stable")
    ordered = buckets[order]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(ordered)))
    offsets = pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))
    columns = {
        "block": pa.array(np.full(len(starts), block)),
        "bucket": pa.array(ordered[starts].astype(np.int32)),
        "at": list_array(order.astype(np.int32), sizes, pa.int32()),
        "keys": pa.ListArray.from_arrays(offsets, keys.take(pa.array(order))),
    }
    if counts is not None:
        columns["n"] = list_array(counts[order], sizes, pa.int64())
    return columns


def padded_batch(columns: dict[str, pa.Array], schema: pa.Schema) -> pa.RecordBatch:
    """A batch of the schema; columns that are not given are null."""
    rows = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [columns[field.name].cast(field.type) if field.name in columns else pa.nulls(rows, field.type) for field in schema],
        schema=schema,
    )


def delivered(
    documents: DataFrame, answers: DataFrame, total: Callable[[pa.Table, np.ndarray, np.ndarray, np.ndarray], pa.Table], schema: str
) -> DataFrame:
    """What ``total`` makes of the documents of each block and the values of its keys.

    ``documents`` has ``block, places, times`` and its own columns, ``answers`` ``block, at, value`` with
    arrays.  ``total`` gets the documents, the values of all their entries, their times, and where each
    document's entries begin (and the last ends).  A block is bounded where it is made.
    """

    def run(rows: pa.Table, found: pa.Table) -> pa.Table:
        rows, found = rows.combine_chunks(), found.combine_chunks()
        at = _flat(found.column("at"))
        value = np.zeros(int(at.max()) + 1 if len(at) else 0, np.int64)
        value[at] = _flat(found.column("value"))
        places = [np.cumsum(unpacked(data)) for data in rows.column("places").to_pylist()]
        times = [unpacked(data) for data in rows.column("times").to_pylist()]
        bounds = np.cumsum([0, *map(len, places)])
        nothing = np.zeros(0, np.int64)
        return total(rows, value[np.concatenate([nothing, *places])], np.concatenate([nothing, *times]), bounds)

    return documents.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    parts = [chunk.flatten().to_numpy(zero_copy_only=False) for chunk in column.chunks]
    return np.concatenate([np.zeros(0, np.int64), *parts]).astype(np.int64)


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The sum of each document's part of ``values``."""
    before = np.concatenate([[0], np.cumsum(values)])
    return before[bounds[1:]] - before[bounds[:-1]]


def split_kinds(written: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of documents, and the rows that ask, of one written table."""
    return written.filter(F.col("bucket").isNull()), written.filter(F.col("bucket").isNotNull())


def batches_of(columns: dict[str, pa.Array], schema: pa.Schema, rows: int = 1_000) -> Iterator[pa.RecordBatch]:
    whole = padded_batch(columns, schema)
    for begin in range(0, len(whole), rows):
        yield whole.slice(begin, rows)
