"""Approximate nearest neighbours by shifted space-filling curves.

Vectors are projected to a few random directions, shifted and quantised; their Hilbert keys give one
ordering for each curve.  The ordering is range-partitioned into blocks of about equal size, a query is
compared with the blocks in a window around its own key, and what the curves find is merged and ranked
by the exact measure.  Equal vectors share one place on a curve and are told apart only in the result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import list_array, materialize
from .vectors import blockwise, padded


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of integer cells with ``bits`` bits in each dimension."""
    dims = cells.shape[1]
    axes = [cells[:, i].astype(np.int64) for i in range(dims)]
    for level in range(bits - 1, 0, -1):
        bit, below = 1 << level, (1 << level) - 1
        for i in range(dims):
            flip = (axes[i] & bit) != 0
            swap = np.where(flip, 0, (axes[0] ^ axes[i]) & below)
            axes[i] = axes[i] ^ swap if i else axes[i]
            axes[0] = np.where(flip, axes[0] ^ below, axes[0] ^ swap)
    for i in range(1, dims):
        axes[i] = axes[i] ^ axes[i - 1]
    undo = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, 0, -1):
        undo = np.where((axes[-1] >> level) & 1, undo ^ ((1 << level) - 1), undo)
    key = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            key = (key << 1) | (((axis ^ undo) >> level) & 1)
    return key


class Curves:
    """Random directions and shifts, by seed; inner products become distances by one more component."""

    def __init__(self, size: int, longest: float, curves: int, dims: int, bits: int, seed: int):
        rng = np.random.default_rng(seed)
        self.longest, self.bits = longest or 1.0, bits
        self.dims = min(dims, size + 1)
        self.directions = [np.linalg.qr(rng.normal(size=(size + 1, self.dims)))[0] for _ in range(curves)]
        self.shifts = rng.random((curves, self.dims)) * 0.5

    def keys(self, vectors: np.ndarray, as_query: bool) -> np.ndarray:
        norms = np.linalg.norm(vectors, axis=1)
        if as_query:
            points = np.column_stack([vectors / np.where(norms > 0, norms, 1)[:, None], np.zeros(len(vectors))])
        else:
            scaled = vectors / self.longest
            points = np.column_stack([scaled, np.sqrt(np.maximum(0, 1 - (norms / self.longest) ** 2))])
        out = []
        for directions, shift in zip(self.directions, self.shifts):
            # A projection of a unit vector has about the deviation 1 / sqrt(size); the logistic curve spreads it evenly.
            even = 1 / (1 + np.exp(np.clip(-1.7 * math.sqrt(points.shape[1]) * (points @ directions), -50, 50)))
            cells = np.minimum((even + shift) / 1.5 * (1 << self.bits), (1 << self.bits) - 1)
            out.append(hilbert_keys(cells.astype(np.int64), self.bits))
        return np.column_stack(out)


def _with_keys(rows: DataFrame, curves: Curves, as_query: bool, size: int) -> DataFrame:
    """One row for each vector and curve, with its ``key`` there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), size)
            keys = curves.keys(vectors, as_query)
            offsets = pa.array(np.arange(len(batch) + 1, dtype=np.int32) * keys.shape[1])
            yield batch.append_column("keys", pa.ListArray.from_arrays(offsets, pa.array(keys.ravel())))

    fields = [f"`{field.name}` {field.dataType.simpleString()}" for field in rows.schema]
    keyed = rows.mapInArrow(run, ", ".join([*fields, "keys array<long>"]))
    return keyed.select("*", F.posexplode("keys").alias("curve", "place")).drop("keys")


def nearest(
    candidates: DataFrame,
    queries: DataFrame,
    k: int = 20,
    window: float = 0.4,
    curves: int = 5,
    dims: int = 4,
    bits: int = 5,
    block_rows: int = 2048,
    seed: int = 7,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: about the k largest inner products of each query.

    Both tables have ``vec_id, vector`` with finite doubles and unique numbers; zero vectors and a
    query's own number are left out.  ``window`` is the share of each ordering that is compared with a
    query: vectors without structure, whose neighbours are hardly nearer than others, need a large one.
    Equal scores go to the smaller number; fewer candidates than k give all that were found.
    """
    nonzero = F.exists("vector", lambda x: x != 0)
    candidates, queries = candidates.filter(nonzero), queries.filter(nonzero)
    size, longest = candidates.agg(
        F.max(F.size("vector")), F.max(F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x, F.sqrt))
    ).first()
    if not size:
        return queries.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # Equal vectors become one; of their numbers the k + 1 smallest can be in a result.
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    distinct = materialize(
        candidates.withColumn("vector", padded("vector", size))
        .withColumn("place", place)
        .filter(F.col("place") <= k + 1)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("extra"))
        .withColumn("id", F.col("extra")[0]),
        "distinct-vectors",
    )
    asked = queries.filter(F.size("vector") <= size).select(F.col("vec_id").alias("id"), padded("vector", size).alias("vector"))
    shared = Curves(size, float(longest), curves, dims, bits, seed)

    # A key ends in bits of the number, so that vectors of one cell can be told apart and split.
    tie = F.pmod(F.xxhash64("id"), F.lit(1 << 20))
    key = F.shiftleft("place", 20).bitwiseOR(tie)
    rows = _with_keys(distinct, shared, False, size).withColumn("key", key)
    asked = _with_keys(asked, shared, True, size).withColumn("key", key)
    blocks = max(1, math.ceil(distinct.count() / block_rows))
    fractions = F.array(*[F.lit(i / blocks) for i in range(1, blocks)])
    bounds: dict[int, list[int]] = {curve: [] for curve in range(curves)}
    if blocks > 1:
        ranges = rows.groupBy("curve").agg(F.percentile_approx("key", fractions, max(10_000, 20 * blocks)).alias("bounds"))
        bounds |= {row["curve"]: list(row["bounds"]) for row in ranges.collect()}

    ends = [np.array(bounds[curve], np.int64) for curve in range(curves)]

    @F.pandas_udf("long")
    def block_of(curve: pd.Series, key: pd.Series) -> pd.Series:
        at = np.zeros(len(key), np.int64)
        for number, end in enumerate(ends):
            own = (curve == number).to_numpy()
            at[own] = np.searchsorted(end, key[own].to_numpy(), side="right")
        return pd.Series(at)

    def search(row_ids, vectors, numbers, query_ids, query_vectors, _):
        scores = query_vectors @ vectors.T
        few = min(k + 1, scores.shape[1])
        least = np.partition(scores, -few, axis=1)[:, -few]
        found, values = [], []
        for i in range(len(query_ids)):
            at = np.flatnonzero(scores[i] >= least[i])
            at = at[np.lexsort((row_ids[at], -scores[i][at]))[:few]]
            # The sum component by component, so that it doesn't depend on the block.
            values.append(np.cumsum(query_vectors[i] * vectors[at], axis=1)[:, -1])
            found.append([numbers[j] for j in at.tolist()])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(query_ids),
                pa.array(found, pa.list_(pa.list_(pa.int64()))),
                list_array(np.concatenate(values), [few] * len(values), pa.float64()),
            ],
            names=["query_id", "numbers", "scores"],
        )

    def best(own: int, parts: list[tuple[list, list]]) -> list[tuple[float, int]]:
        """The k best of what the blocks and curves found for a query, as negative score and number."""
        every = {
            (-score, number)
            for numbers, scores in parts
            for equal, score in zip(numbers, scores)
            for number in equal
            if number != own
        }
        return heapq.nsmallest(k, every)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ranked(own: int, parts: list) -> pa.RecordBatch:
            kept = best(own, parts)
            columns = [[own] * len(kept), range(1, len(kept) + 1), [number for _, number in kept], [-score for score, _ in kept]]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.float64()]
            arrays = [pa.array(list(column), kind) for column, kind in zip(columns, kinds)]
            return pa.RecordBatch.from_arrays(arrays, names=["query_id", "rank", "vec_id", "score"])

        own, parts = None, []
        for batch in batches:
            for query, numbers, scores in zip(*(batch.column(name).to_pylist() for name in ("query_id", "numbers", "scores"))):
                if query != own and parts:
                    yield ranked(own, parts)
                    parts = []
                own = query
                parts.append((numbers, scores))
                if len(parts) > 64:  # keep what the best are made of
                    parts = [([[number] for _, number in kept], [-score for score, _ in kept]) for kept in [best(own, parts)]]
        if parts:
            yield ranked(own, parts)

    base = F.col("curve").cast("long") * blocks
    wide = min(blocks, max(1, math.ceil(window * blocks)))
    first = F.least(F.greatest(F.col("at") - wide // 2, F.lit(0)), F.lit(blocks - wide))
    targets = F.explode(F.sequence(base + first, base + first + (wide - 1))).alias("block")
    no_extra = F.array().cast("array<long>").alias("extra")
    found = blockwise(
        rows.withColumn("at", block_of("curve", "key")).select((base + F.col("at")).alias("block"), "id", "vector", "extra"),
        asked.withColumn("at", block_of("curve", "key")).select(targets, "id", "vector", no_extra),
        search,
        "query_id long, numbers array<array<long>>, scores array<double>",
        size,
    )
    together = found.repartition("query_id").sortWithinPartitions("query_id")
    return together.mapInArrow(merged, "query_id long, rank int, vec_id long, score double")
