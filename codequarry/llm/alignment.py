"""Alignment of two tokenizers' tokens by coalescing byte intervals.

Both token lists of a text cover the same bytes.  All intervals are sorted by start and the running
maximum of their ends is taken: where a start reaches it, a group breaks.  Within groups the overlaps are
expanded to links of one A and one B token.  How many links hold an id pair, in the whole corpus, is
summed over blocks of documents and given back to them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import asked, batches_of, delivered, entry_columns, first_block, split_kinds, sums
from .common import bucket_count, list_array, materialize
from .vocabulary import encoding, ids_of, odd_characters

_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
_SCHEMA = pa.schema([
    ("block", pa.int64()), ("doc_id", pa.int64()), *[(name, pa.int64()) for name in _COUNTS],
    ("groups", pa.string()), ("places", pa.binary()), ("times", pa.binary()),
    ("bucket", pa.int32()), ("at", pa.list_(pa.int32())), ("keys", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())),
])
_FIELDS = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string,"
    " places binary, times binary, bucket int, at array<int>, keys array<long>, n array<long>"
)
# Texts are aligned some at a time, so that arrays stay small; a longer one alone.
_BYTES_AT_ONCE = 4 << 20


@dataclass(frozen=True)
class Aligned:
    """Token lists in one row of bytes: each token's group, and the linked tokens as places in both lists."""

    a_group: np.ndarray
    b_group: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def coalesce(a_sizes: np.ndarray, b_sizes: np.ndarray) -> Aligned:
    """Groups and links of two lists of token sizes that cover the same bytes."""
    a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
    a_starts, b_starts = a_ends - a_sizes, b_ends - b_sizes
    starts, ends = np.concatenate([a_starts, b_starts]), np.concatenate([a_ends, b_ends])
    side = np.repeat([0, 1], [len(a_sizes), len(b_sizes)])
    order = np.lexsort((side, starts))
    reach = np.maximum.accumulate(ends[order])
    breaks = np.zeros(len(order), np.int64)
    breaks[1:] = starts[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks)
    # What overlaps an A token are the B tokens from the first that ends after its start to the last that starts before its end.
    first, last = np.searchsorted(b_ends, a_starts, side="right"), np.searchsorted(b_starts, a_ends, side="left")
    count = last - first
    link_a = np.repeat(np.arange(len(a_sizes)), count)
    link_b = np.arange(len(link_a)) - np.repeat(np.cumsum(count) - count - first, count)
    return Aligned(group[: len(a_sizes)], group[len(a_sizes) :], link_a, link_b)


class Pair:
    """Both tokenizers of a worker: ids and bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str, odd: frozenset[str]):
        self.coder, self.encode_a = encoding(a_path), ids_of(a_path, odd)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        size = max(self.coder.max_token_value + 1, self.coder.n_vocab)
        a_tokens = [b""] * size
        for token in self.coder.token_byte_values():
            a_tokens[self.coder.encode_single_token(token)] = token
        self.b_tokens = [self._bytes(number) for number in range(self.b.get_piece_size())]
        self.a_sizes = np.array([len(token) for token in a_tokens], np.int64)
        self.b_sizes = np.array([len(token) for token in self.b_tokens], np.int64)
        # Every id with what stands between it and the next token: of its side, of the other side or group, nothing.
        a_names, b_names = map(str, range(size)), map(str, range(len(self.b_tokens)))
        self.names = np.array([f"{name}{mark}" for name in a_names for mark in ",|"] + [f"{name}{mark}" for name in b_names for mark in (",", ";")], object)

    def _bytes(self, number: int) -> bytes:
        piece = self.b.id_to_piece(number)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(number) else piece.replace("▁", " ").encode()

    def ids(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of both for each text, or none for empty texts and those whose bytes are not those of a space and the text."""
        filled = [text for text in texts if text]
        pieces, out = iter(self.b.encode(filled, num_threads=1) if filled else []), []
        for text in texts:
            if not text:
                out.append(([], []))
                continue
            a, b, whole = self.encode_a(f" {text}"), next(pieces), f" {text}".encode()
            same = b"".join(map(self.b_tokens.__getitem__, b)) == whole and self.coder.decode_bytes(a) == whole
            out.append((a, b) if same else ([], []))
        return out

    def written(self, a: np.ndarray, b: np.ndarray, aligned: Aligned, a_begins: list[int], b_begins: list[int]) -> list[str]:
        """The groups of each text as ``a1,a2|b1;a3|b2,b3``."""
        last_a, last_b = (np.append(group[1:] != group[:-1], True)[: len(group)] for group in (aligned.a_group, aligned.b_group))
        codes = np.concatenate([2 * a + last_a, 2 * (len(self.a_sizes) + b) + last_b])
        sides = np.repeat([0, 1], [len(a), len(b)])
        order = np.lexsort((sides, np.concatenate([aligned.a_group, aligned.b_group])))
        names = self.names[codes[order]].tolist()
        # The groups of a text lie together, so its tokens do.
        ends = [i + j for i, j in zip(a_begins, b_begins)]
        return ["".join(names[begin:end])[:-1] for begin, end in zip(ends, ends[1:])]


@lru_cache(maxsize=1)
def _pair(a_path: str, b_path: str, odd: frozenset[str]) -> Pair:
    return Pair(a_path, b_path, odd)


def linked_documents(
    docs: DataFrame, a_path: str, b_path: str, buckets: int, keep_groups: bool = False, block_links: int = 4_000_000
) -> DataFrame:
    """Rows of documents (``block, doc_id, n_a, n_b, n_groups, n_links, groups, places, times``) and rows that
    ask for id pairs (``block, bucket, at, keys, n``).

    ``groups`` is the SHA-256 of the written groups, or the groups themselves.
    """
    odd = odd_characters(a_path)

    def some(pair: Pair, numbers: list, texts: list[str]) -> tuple[dict, list[np.ndarray]]:
        """Columns of these documents, and the id pair of each of their links."""
        ids = pair.ids(texts)
        a_begins, b_begins = (np.cumsum([0, *[len(found[side]) for found in ids]]) for side in (0, 1))
        a, b = (np.fromiter((i for found in ids for i in found[side]), np.int64) for side in (0, 1))
        aligned = coalesce(pair.a_sizes[a], pair.b_sizes[b])
        keys = a[aligned.link_a] << 32 | b[aligned.link_b]
        bounds = np.searchsorted(aligned.link_a, a_begins)
        groups = pair.written(a, b, aligned, a_begins.tolist(), b_begins.tolist())
        firsts = np.concatenate([[True], aligned.a_group[1:] != aligned.a_group[:-1]])[: len(a)]
        before = np.concatenate([[0], np.cumsum(firsts)])
        columns = {
            "doc_id": numbers,
            "n_a": np.diff(a_begins).tolist(),
            "n_b": np.diff(b_begins).tolist(),
            "n_groups": np.diff(before[a_begins]).tolist(),
            "n_links": np.diff(bounds).tolist(),
            "groups": [text if keep_groups or not text else hashlib.sha256(text.encode()).hexdigest() for text in groups],
        }
        return columns, [keys[begin:end] for begin, end in zip(bounds, bounds[1:])]

    def flush(block: int, columns: dict[str, list], links: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        place, keys = pd.factorize(np.concatenate([np.zeros(0, np.int64), *links]))
        n = np.bincount(place, minlength=len(keys))
        places, times, begin = [], [], 0
        for found in links:
            at, count = np.unique(place[begin : begin + len(found)], return_counts=True)
            places.append(at)
            times.append(count)
            begin += len(found)
        arrays = {name: pa.array(values, _SCHEMA.field(name).type) for name, values in columns.items()}
        arrays["block"] = pa.array(np.full(len(links), block))
        arrays["places"], arrays["times"] = entry_columns(places, times)
        yield from batches_of(arrays, _SCHEMA)
        mixed = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        chosen = ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        yield from batches_of(asked(block, chosen, pa.array(keys), n), _SCHEMA, 64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, block = _pair(a_path, b_path, odd), first_block()
        columns: dict[str, list] = {}
        links: list[np.ndarray] = []
        size = 0
        for batch in batches:
            numbers, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            ends = np.cumsum([len(text) for text in texts]) // _BYTES_AT_ONCE
            cuts = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), len(texts)]
            for begin, end in zip(cuts, cuts[1:]):
                if begin == end:
                    continue
                found, keys = some(pair, numbers[begin:end], texts[begin:end])
                for name, values in found.items():
                    columns.setdefault(name, []).extend(values)
                links += keys
                size += sum(map(len, keys))
                if size >= block_links:
                    yield from flush(block, columns, links)
                    block, columns, links, size = block + 1, {}, [], 0
        if links:
            yield from flush(block, columns, links)

    text = F.coalesce(docs["text"], F.lit("")).alias("text")
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text).mapInArrow(run, _FIELDS)


def pair_counts(asks: DataFrame) -> DataFrame:
    """``bucket, keys, n``: how many links of the whole corpus hold each id pair (A's id times 2^32 plus B's)."""

    def run(table: pa.Table) -> pa.Table:
        keys, inverse = np.unique(_flat(table.column("keys")), return_inverse=True)
        n = np.bincount(inverse, weights=_flat(table.column("n")), minlength=len(keys)).astype(np.int64)
        bucket = table.column("bucket")[:1].combine_chunks()
        arrays = [bucket, list_array(keys, [len(keys)], pa.int64()), list_array(n, [len(n)], pa.int64())]
        return pa.Table.from_arrays(arrays, names=["bucket", "keys", "n"])

    return asks.select("bucket", "keys", "n").groupBy("bucket").applyInArrow(run, "bucket int, keys array<long>, n array<long>")


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *[chunk.flatten().to_numpy(zero_copy_only=False) for chunk in column.chunks]])


def highest_counts(counts: DataFrame) -> dict[int, int]:
    """The highest count of any pair of each B id; as many numbers as the B vocabulary has entries at most."""
    pairs = counts.select(F.explode(F.arrays_zip("keys", "n")).alias("p"))
    b = F.col("p.keys").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b")
    return {row["b"]: row["n"] for row in pairs.groupBy(b).agg(F.max("p.n").alias("n")).collect()}


def align(docs: DataFrame, a_path: str, b_path: str, keep_groups: bool = False, **bounds) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups`` of each row of ``docs``.

    A (a byte-level BPE definition) reads a space and the text, B (a sentencepiece model) the text; marks
    of either in a text are plain text.  ``n_best`` counts the links whose pair is, corpus-wide, the most
    frequent of its B id (ties included), ``count_sum`` sums the counts of all links.  ``groups`` is
    their SHA-256, or with ``keep_groups`` the groups, as ``a1,a2|b1;a3|b2,b3``.  Texts that are null or
    empty, or that B does not give back byte for byte, have no tokens: zeros and an empty string.  Null and
    repeated numbers and repeated rows are kept, one row each, and repeated rows count each time.
    """
    buckets = bucket_count(docs, 16 << 20)
    written = materialize(linked_documents(docs, a_path, b_path, buckets, keep_groups, **bounds), "aligned")
    documents, asks = split_kinds(written)
    counts = materialize(pair_counts(asks), "pair-counts")
    highest = highest_counts(counts)
    most = np.zeros(max(highest, default=0) + 1, np.int64)
    most[list(highest)] = list(highest.values())
    shared = docs.sparkSession.sparkContext.broadcast(most)

    def answer(asked_rows: pa.Table, known: pa.Table) -> pa.Table:
        asked_rows = asked_rows.combine_chunks()
        keys, n = _flat(known.column("keys")), _flat(known.column("n"))
        wanted = _flat(asked_rows.column("keys"))
        count = n[np.searchsorted(keys, wanted)]
        # The count and, as its last bit, whether it is the highest of the B id.
        value = 2 * count + (count == shared.value[wanted & 0xFFFFFFFF])
        at = asked_rows.column("at").combine_chunks()
        sizes = np.concatenate([np.zeros(0, np.int64), *[chunk.value_lengths().to_numpy() for chunk in asked_rows.column("at").chunks]])
        return pa.Table.from_arrays([asked_rows.column("block"), at, list_array(value, sizes, pa.int64())], names=["block", "at", "value"])

    answers = (
        asks.select("bucket", "block", "at", "keys")
        .groupBy("bucket")
        .cogroup(counts.groupBy("bucket"))
        .applyInArrow(answer, "block long, at array<int>, value array<long>")
    )
    same = ["doc_id", *_COUNTS, "groups"]

    def total(rows: pa.Table, value: np.ndarray, times: np.ndarray, bounds: np.ndarray) -> pa.Table:
        found = rows.select(same)
        found = found.append_column("n_best", pa.array(sums((value & 1) * times, bounds)))
        return found.append_column("count_sum", pa.array(sums((value >> 1) * times, bounds)))

    schema = ", ".join(["doc_id long", *[f"{name} long" for name in _COUNTS], "groups string, n_best long, count_sum long"])
    return delivered(documents.select("block", *same, "places", "times"), answers, total, schema)


def digests(aligned: DataFrame) -> DataFrame:
    """The result of ``align`` without ``keep_groups``, its groups named as the digest they are."""
    return aligned.withColumnRenamed("groups", "groups_sha256")
