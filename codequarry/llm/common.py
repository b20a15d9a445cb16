"""Helpers shared by the operators: row keys, tables cut from their lineage, text buffers, buckets."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codequarry.session import prepare, shared_dir

# Two rows of equal number and text are the same document twice; they get equal results.
KEY = ["doc_id", "text_hash"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "embeddings")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """Number, hash and whole text (null: empty) of each document; other columns are left behind."""
    text = F.coalesce(docs["text"], F.lit(""))
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.xxhash64(text).alias("text_hash"),
        text.alias("text"),
        *[docs[name] for name in more],
    )


def join_by_key(left: DataFrame, right: DataFrame, how: str = "left", keys: Sequence[str] = KEY) -> DataFrame:
    """Join on keys of which any may be null; the right side's keys are dropped."""
    renamed = right.withColumnsRenamed({name: f"_right_{name}" for name in keys})
    match = F.lit(True)
    for name in keys:
        match = match & left[name].eqNullSafe(renamed[f"_right_{name}"])
    return left.join(renamed, match, how).drop(*[f"_right_{name}" for name in keys])


def materialize(rows: DataFrame, label: str) -> DataFrame:
    """Write rows to the cluster's shared folder and read them back, so that nothing is computed again."""
    spark = rows.sparkSession
    path = shared_dir(spark, f"llm-{label}")
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def bucket_count(rows: DataFrame, bytes_per_bucket: int = 8 << 20) -> int:
    """Number of buckets for work that is dealt out by hash; it follows the planner's size of the input."""
    spark = rows.sparkSession
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    least = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    if size > 1 << 60:  # tables made in memory have no known size
        return least
    return max(least, min(size // bytes_per_bucket, 1 << 20))


def is_remainder(column: str, modulus: int, remainder: int):
    """Whether crc32 of the number as text leaves the remainder; null numbers leave none."""
    hashed = F.crc32(F.col(column).cast("string").cast("binary"))
    return F.coalesce(F.pmod(hashed, F.lit(modulus)) == remainder, F.lit(False))


def byte_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary or string column without nulls, and where each value begins (and the last ends)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and len(column) else np.zeros(0, np.uint8)
    starts = starts.astype(np.int64) if len(column) else np.zeros(1, np.int64)
    return whole[starts[0] : starts[-1]], starts - starts[0]


def list_array(values: np.ndarray, counts: Sequence[int], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(np.asarray(counts, dtype=np.int64))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
