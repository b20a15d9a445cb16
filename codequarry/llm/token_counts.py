"""Token counts of whole texts without materialising ids.

A text splits into pre-tokens, and merges never cross them, so a text has the sum of its pre-tokens'
pieces.  Each distinct pre-token is encoded once in its bucket, the number of pieces goes back to the
blocks that hold it, and each document sums pieces times frequency.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import asked, batches_of, delivered, entry_columns, first_block, split_kinds, sums
from .common import bucket_count, list_array, materialize
from .vocabulary import added_tokens, library, odd_characters, pre_tokens

_SCHEMA = pa.schema([
    ("block", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_added", pa.int64()),
    ("places", pa.binary()), ("times", pa.binary()),
    ("bucket", pa.int32()), ("at", pa.list_(pa.int32())), ("keys", pa.list_(pa.string())),
])
_FIELDS = (
    "block long, doc_id long, n_bytes long, n_added long, places binary, times binary,"
    " bucket int, at array<int>, keys array<string>"
)
_REMEMBERED = 1_000_000


def pre_token_frequencies(
    docs: DataFrame, vocabulary: str, buckets: int, block_bytes: int = 32 << 20, block_keys: int = 500_000
) -> DataFrame:
    """Rows of documents (``block, doc_id, n_bytes, n_added, places, times``) and rows that ask (``block, bucket, at, keys``).

    ``n_added`` counts the definition's added tokens in the text; what lies between them is split.
    """
    odd, added = odd_characters(vocabulary), sorted(added_tokens(vocabulary), key=len, reverse=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = pre_tokens(vocabulary, odd)
        marks = regex.compile("|".join(map(regex.escape, added))) if added else None
        block, size = first_block(), 0
        number: dict[str, int] = {}
        held: list[tuple] = []

        def flush() -> Iterator[pa.RecordBatch]:
            doc_id, n_bytes, n_added, places, times = zip(*held)
            columns = {"block": pa.array(np.full(len(held), block)), "doc_id": pa.array(doc_id, pa.int64())}
            columns |= {"n_bytes": pa.array(n_bytes, pa.int64()), "n_added": pa.array(n_added, pa.int64())}
            columns["places"], columns["times"] = entry_columns(places, times)
            yield from batches_of(columns, _SCHEMA)
            chosen = np.fromiter((zlib.crc32(key.encode()) % buckets for key in number), np.int64, len(number))
            yield from batches_of(asked(block, chosen, pa.array(list(number), pa.string())), _SCHEMA, 64)

        for batch in batches:
            for doc_id, n_bytes, text in zip(*(batch.column(name).to_pylist() for name in ("doc_id", "n_bytes", "text"))):
                parts = marks.split(text) if marks else [text]
                counts: Counter = Counter()
                for part in parts:
                    counts.update(split(part))
                places = np.fromiter((number.setdefault(key, len(number)) for key in counts), np.int64, len(counts))
                times = np.fromiter(counts.values(), np.int64, len(counts))
                order = np.argsort(places)
                held.append((doc_id, n_bytes, len(parts) - 1, places[order], times[order]))
                size += n_bytes
                if size >= block_bytes or len(number) >= block_keys:
                    yield from flush()
                    block, size, number, held = block + 1, 0, {}, []
        if held:
            yield from flush()

    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    return rows.mapInArrow(run, _FIELDS)


def pieces_of(asks: DataFrame, vocabulary: str) -> DataFrame:
    """``block, at, value``: the number of pieces of each key that is asked for.

    The rows of a bucket meet in one task, which encodes a pre-token when it first sees it.  It starts
    anew after a million distinct ones, so its memory is bounded.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = library(vocabulary)
        seen: dict[str, int] = {}
        for batch in batches:
            keys = batch.column("keys").flatten().to_pylist()
            if len(seen) > _REMEMBERED:
                seen.clear()
            new = [key for key in dict.fromkeys(keys) if key not in seen]
            for key, found in zip(new, coder.encode_batch_fast(new, add_special_tokens=False)):
                seen[key] = len(found)
            values = np.fromiter(map(seen.__getitem__, keys), np.int32, len(keys))
            sizes = batch.column("keys").value_lengths().to_numpy()
            value = list_array(values, sizes, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("at"), value], names=["block", "at", "value"])

    return asks.select("bucket", "block", "at", "keys").repartition("bucket").mapInArrow(run, "block long, at array<int>, value array<int>")


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 512, **bounds) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of each row of ``docs``, as the library of a byte-level
    BPE definition counts them by default: added tokens in a text are one token, none is added at its ends.

    Null texts are empty: no bytes, no tokens.  Null and repeated numbers and repeated rows are kept as
    they are, one row each; other columns are ignored.
    """
    buckets = bucket_count(docs, 64 << 20)
    written = materialize(pre_token_frequencies(docs, vocabulary, buckets, **bounds), "pre-tokens")
    documents, asks = split_kinds(written)

    def total(rows: pa.Table, pieces: np.ndarray, times: np.ndarray, bounds: np.ndarray) -> pa.Table:
        n_tokens = sums(pieces * times, bounds) + rows.column("n_added").to_numpy()
        return rows.select(["doc_id", "n_bytes"]).append_column("n_tokens", pa.array(n_tokens))

    found = delivered(
        documents.select("block", "doc_id", "n_bytes", "n_added", "places", "times"),
        pieces_of(asks, vocabulary), total, "doc_id long, n_bytes long, n_tokens long",
    )
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
