"""Vector tables: which rows take part, and searching a stated query set block by block."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# (row numbers, row vectors, row extras, query numbers, query vectors, query extras) -> rows of the result.
Search = Callable[..., pa.RecordBatch | None]


def usable(rows: DataFrame, number: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, vector``: vectors as doubles, without null, empty-handed or non-finite ones.

    Rows without a number or vector, or with a null or non-finite component, take no part.  Rows that
    repeat a number count once, with the smallest of their vectors.
    """
    values = F.transform(rows[vector], lambda x: x.cast("double"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    picked = rows.select(rows[number].cast("long").alias("vec_id"), values.alias("vector"))
    picked = picked.filter("vec_id is not null and vector is not null").filter(finite)
    return picked.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def padded(vector: Column | str, size: int) -> Column:
    """Shorter vectors end in zeros, so that all have ``size`` components."""
    column = F.col(vector) if isinstance(vector, str) else vector
    return F.concat(column, F.array_repeat(F.lit(0.0), F.lit(size) - F.size(column)))


def blockwise(rows: DataFrame, queries: DataFrame, search: Search, schema: str, size: int) -> DataFrame:
    """Searches every query of a block in the rows of that block.

    Both have ``block long, id long, vector array<double>, extra array<long>``; the rows of one block
    must be few, its queries may be many: they are streamed past the rows in Arrow batches.
    """

    def matrix(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list]:
        vectors = part.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(len(part), size)
        return part.column("id").to_numpy(), vectors, part.column("extra").to_pylist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, ready = None, [], None
        for batch in batches:
            blocks, kinds = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
            turns = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1
            for begin, end in zip([0, *turns.tolist()], [*turns.tolist(), len(batch)]):
                if begin == end:
                    continue
                part = batch.slice(begin, end - begin)
                if blocks[begin] != block:
                    block, held, ready = blocks[begin], [], None
                if kinds[begin] == 0:
                    held.append(matrix(part))
                    continue
                if not held:
                    continue
                if ready is None:
                    ids, vectors, extras = zip(*held)
                    ready = np.concatenate(ids), np.concatenate(vectors), [x for extra in extras for x in extra]
                found = search(*ready, *matrix(part))
                if found is not None and len(found):
                    yield found

    columns = ["block", "id", "vector", "extra"]
    both = rows.select(*columns, F.lit(0).alias("kind")).unionByName(queries.select(*columns, F.lit(1).alias("kind")))
    return both.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(run, schema)
