"""Exact top-k search by distributed histogram selection.

Every candidate is scored for every query, block by block.  Histograms of the scores, summed over all
blocks, locate the range that holds each query's k-th best score; the range is refined until it is one
value.  Then only better scores, and as many equal ones as are still needed, are kept; equal scores go
to the smaller number.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize
from .vectors import blockwise, padded, usable

_BITS = 12


def _scores(row_ids, rows, query_ids, queries) -> np.ndarray:
    """Inner products of integer-valued vectors, exactly; a query's own row gets the least of all."""
    most = np.abs(rows).max(initial=0) * np.abs(queries).max(initial=0) * max(1, rows.shape[1])
    if most < 2**53:
        scores = (queries @ rows.T).astype(np.int64)
    else:
        scores = queries.astype(np.int64) @ rows.astype(np.int64).T
    scores[query_ids[:, None] == row_ids[None, :]] = np.iinfo(np.int64).min
    return scores


def _histogram(shift: int):
    """Per query the counts of the highest bins, down to the one in which this block alone has enough."""

    def search(row_ids, rows, _, query_ids, queries, states):
        scores = _scores(row_ids, rows, query_ids, queries)
        lowest, need = np.array(states, np.int64).T
        out: list[tuple[np.ndarray, ...]] = []
        bins = 1 << _BITS
        at = (scores - lowest[:, None]) >> shift
        inside = (scores >= lowest[:, None]) & (at < bins)
        for i in range(len(query_ids)):
            counts = np.bincount(at[i][inside[i]], minlength=bins)
            from_top = np.cumsum(counts[::-1])
            enough = bins - int(np.searchsorted(from_top, need[i])) - 1
            kept = np.flatnonzero(counts[max(0, enough) :]) + max(0, enough)
            out.append((np.full(len(kept), query_ids[i]), kept, counts[kept]))
        ids, kept, counts = (np.concatenate(column) for column in zip(*out))
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(kept), pa.array(counts)], names=["id", "bin", "n"])

    return search


def _select(row_ids, rows, _, query_ids, queries, states):
    """Scores above the k-th, and of those equal to it the smallest numbers."""
    scores = _scores(row_ids, rows, query_ids, queries)
    out = []
    for i, (kth, need) in enumerate(states):
        own = scores[i] == np.iinfo(np.int64).min
        better = np.flatnonzero((scores[i] > kth) & ~own)
        equal = np.flatnonzero((scores[i] == kth) & ~own)
        equal = equal[np.argsort(row_ids[equal], kind="stable")[:need]]
        kept = np.concatenate([better, equal])
        out.append((np.full(len(kept), query_ids[i]), row_ids[kept], scores[i][kept]))
    ids, found, values = (np.concatenate(column) for column in zip(*out))
    names = ["query_id", "vec_id", "score"]
    return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(found), pa.array(values)], names=names)


def top_k(candidates: DataFrame, queries: DataFrame, k: int, block_rows: int = 4096) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k highest integer inner products of each query.

    Both tables have ``vec_id, vector`` with integer-valued components and unique numbers; a query's own
    number is no candidate.  Queries with fewer than k candidates get all.  Raises if a score could
    exceed a long.
    """
    size, most, count = candidates.unionByName(queries).agg(
        F.max(F.size("vector")), F.max(F.array_max(F.transform("vector", F.abs))), F.count("*")
    ).first()
    size, bound = size or 0, int(most or 0) ** 2 * (size or 0)
    if bound >= 2**62:
        raise ValueError("inner products may exceed a 64-bit integer")
    blocks = max(1, math.ceil(count / block_rows))
    shape = [F.col("vec_id").alias("id"), padded("vector", size).alias("vector")]
    no_extra = F.array().cast("array<long>").alias("extra")
    rows = candidates.select(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("long").alias("block"), *shape, no_extra)
    asked = queries.select(*shape)

    def search(states: DataFrame, extra: Column, how, schema: str) -> DataFrame:
        everywhere = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
        stated = asked.join(states, "id").select(everywhere.alias("block"), "id", "vector", extra.alias("extra"))
        return blockwise(rows, stated, how, schema, size)

    # Of each query: the least score of the range that holds its k-th best, and how many that range still owes.
    states = asked.select("id", F.lit(-bound).cast("long").alias("lowest"), F.lit(k).cast("long").alias("need"))
    bits = max(1, (2 * bound).bit_length())
    levels = math.ceil(bits / _BITS)
    for level in range(levels - 1, -1, -1):
        shift = level * _BITS
        found = search(states, F.array("lowest", "need"), _histogram(shift), "id long, bin long, n long")
        from_top = F.sum("n").over(Window.partitionBy("id").orderBy(F.desc("bin")))
        kth = (
            found.groupBy("id", "bin")
            .agg(F.sum("n").alias("n"))
            .join(states, "id")
            .withColumn("reached", from_top)
            .filter("reached >= need and reached - n < need")
            .select(
                "id",
                (F.col("lowest") + F.shiftleft("bin", shift)).alias("new_lowest"),
                (F.col("need") - F.col("reached") + F.col("n")).alias("new_need"),
            )
        )
        states = materialize(
            states.join(kth, "id", "left").select(
                "id", F.coalesce("new_lowest", "lowest").alias("lowest"), F.coalesce("new_need", "need").alias("need")
            ),
            "topk-states",
        )
    found = search(states, F.array("lowest", "need"), _select, "query_id long, vec_id long, score long")
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", best).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def quantized(rows: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id, vector`` of the usable rows of ``vec_id, embedding``, components as floor(scale * x)."""
    return usable(rows).withColumn("vector", F.transform("vector", lambda x: F.floor(x * scale).cast("double")))
