"""Exact meetings of hashed items, in packed rows.

Each task sorts what it found by hash and sends one row a bucket, with the hashes and their origins as
arrays; a bucket decides with array operations.  What a task can decide from its own rows is not asked:
of the items of one hash it sends only the one that speaks for the others, so that a hash that a third
of all documents hold costs one item a task.  Such early answers travel in the same rows, without a hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import list_array

# The number, a hash of the text and the place in it; a null number sorts after all others.
ORIGIN = ["doc", "mark", "at"]
NO_NUMBER = np.iinfo(np.int64).max
_KINDS = {"hash": np.int64, "check": np.int64, "doc": np.int64, "mark": np.int32, "at": np.int64}
PACKED = "bucket int, hash array<long>, check array<long>, doc array<long>, mark array<int>, at array<long>"
ANSWERS = "doc_id long, mark int, found array<long>"
KEYS = ["doc_id", "mark"]

Items = dict[str, np.ndarray]


def marked(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, mark, text``: rows of equal number and text (null: empty) are the same document twice."""
    text = F.coalesce(docs["text"], F.lit(""))
    carried = [F.struct(*[docs[name] for name in carry]).alias("carried")] if carry else []
    number = docs["doc_id"].cast("long").alias("doc_id")
    return docs.select(number, F.hash(text).alias("mark"), text.alias("text"), *carried)


def gather(parts: list[Items]) -> Items:
    names = parts[0] if parts else ORIGIN
    return {name: np.concatenate([np.zeros(0, _KINDS[name]), *[part[name] for part in parts]]) for name in names}


def take(items: Items, which) -> Items:
    return {name: values[which] for name, values in items.items()}


def _packed(buckets: np.ndarray, items: Items) -> pa.RecordBatch | None:
    """One row a bucket; what ``items`` do not have is left empty."""
    if not len(buckets):
        return None
    # By document, so that numbers and marks come in runs, which compress well.
    order = np.lexsort((items["at"], items["doc"], buckets))
    buckets = buckets[order]
    starts = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]]))
    counts = np.diff(np.append(starts, len(buckets)))
    columns = [pa.array(buckets[starts].astype(np.int32))]
    for name, kind in _KINDS.items():
        values = items[name][order] if name in items else np.zeros(0, kind)
        columns.append(list_array(values.astype(kind), counts if name in items else [0] * len(counts), pa.from_numpy_dtype(kind)))
    return pa.RecordBatch.from_arrays(columns, names=["bucket", *_KINDS])


def _by_document(items: Items, buckets: int) -> np.ndarray:
    mixed = items["doc"].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)


def sent(asks: Items, answered: Items, buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows of what is asked (by its hash) and of what is answered already (by its document)."""
    asked_in = (asks["hash"].view(np.uint64) % np.uint64(buckets)).astype(np.int32)
    for where, items in ((asked_in, asks), (_by_document(answered, buckets), answered)):
        batch = _packed(where, items)
        if batch is not None:
            yield batch


def _unpacked(table: pa.Table) -> Iterator[Items]:
    """The rows of a bucket; empty arrays are left out."""
    for batch in table.to_batches():
        for i in range(len(batch)):
            values = {name: batch.column(name)[i].values for name in _KINDS}
            yield {name: x.to_numpy(zero_copy_only=False) for name, x in values.items() if x is not None and len(x)}


def _answer_rows(items: Items) -> pa.Table:
    """One row for each document with the places found in it."""
    order = np.lexsort((items["at"], items["mark"], items["doc"]))
    doc, mark, at = (items[name][order] for name in ORIGIN)
    other = (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1])
    new = np.concatenate([[True], other | (at[1:] != at[:-1])]) if len(at) else np.zeros(0, bool)
    doc, mark, at = doc[new], mark[new], at[new]
    starts = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1])])) if len(at) else np.zeros(0, np.int64)
    counts = np.diff(np.append(starts, len(doc)))
    numbers = pa.array(doc[starts], pa.int64(), mask=doc[starts] == NO_NUMBER)
    marks = pa.array(mark[starts].astype(np.int32))
    return pa.Table.from_arrays([numbers, marks, list_array(at, counts, pa.int64())], names=["doc_id", "mark", "found"])


def delivered(found: DataFrame) -> DataFrame:
    """``doc_id, mark, found`` of packed rows whose buckets are those of the documents; one row a document."""

    def run(table: pa.Table) -> pa.Table:
        return _answer_rows(gather([{name: item[name] for name in ORIGIN} for item in _unpacked(table)]))

    return found.groupBy("bucket").applyInArrow(run, ANSWERS)


def packed_answers(items: Items, buckets: int) -> pa.Table:
    """Origins as packed rows on their way to their documents."""
    empty = pa.schema([("bucket", pa.int32()), *[(name, pa.list_(pa.from_numpy_dtype(kind))) for name, kind in _KINDS.items()]])
    # Fewer buckets of documents than of hashes, since each of these sends a row to each of those.
    batch = _packed(_by_document(items, max(8, buckets // 8)), items)
    return pa.Table.from_batches([batch.cast(empty)] if batch is not None else [], empty)


def settle(packed: DataFrame, decide: Callable[[Items], Items], buckets: int) -> DataFrame:
    """``doc_id, mark, found``: early answers, and the origins that ``decide`` makes of each bucket's items."""

    def run(table: pa.Table) -> pa.Table:
        asked, found = [], []
        for item in _unpacked(table):
            if "hash" in item:
                asked.append(item)
            else:
                found.append(item)
        if asked:
            found.append(decide(gather(asked)))
        return packed_answers(gather(found), buckets)

    return delivered(packed.groupBy("bucket").applyInArrow(run, PACKED))


def with_found(rows: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """Rows with what was found in them; keys may be null."""
    right = found.select(F.col("doc_id").alias("_doc"), F.col("mark").alias("_mark"), "found")
    return rows.join(right, rows["doc_id"].eqNullSafe(right["_doc"]) & (rows["mark"] == right["_mark"]), how).drop("_doc", "_mark")


def origins(items: Items, which) -> Items:
    return take({name: items[name] for name in ORIGIN}, which)


def group_bounds(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorting order of the columns (the first leads), where each group of equal ones starts, and each row's group."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for column in columns:
        ordered = column[order]
        new[1:] |= ordered[1:] != ordered[:-1]
    return order, np.flatnonzero(new), np.cumsum(new) - 1
