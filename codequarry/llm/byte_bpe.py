"""Byte-level BPE over whole texts by overlapping chunks.

Texts above ``chunk`` characters are cut into chunks that overlap.  Chunks are pre-tokenised in
parallel, each from its own beginning; where a boundary of one chunk is also a boundary of the next,
both agree from there on, because the pattern never looks back.  The text between two such places is
a piece that is encoded alone.  Decoding concatenates the raw bytes of the ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from public_tokenizers import PATTERN
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KEY, join_by_key, list_array, texts
from .vocabulary import encoding


def _boundaries(chunk: int, overlap: int):
    """For each chunk, the token boundaries in its first and in its last ``overlap`` characters."""
    pattern = regex.compile(PATTERN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads, tails = [], []
            for number, text in zip(batch.column("chunk").to_pylist(), batch.column("text").to_pylist()):
                begins = np.fromiter((match.start() for match in pattern.finditer(text)), np.int64)
                heads.append(begins[begins < overlap] + number * chunk)
                # A chunk's own end may cut a contraction, so its last letters are not believed.
                tails.append(begins[(begins >= chunk) & (begins < len(text) - 3)] + number * chunk)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(name) for name in (*KEY, "chunk")],
                    list_array(np.concatenate([np.zeros(0, np.int64), *heads]), [len(x) for x in heads], pa.int64()),
                    list_array(np.concatenate([np.zeros(0, np.int64), *tails]), [len(x) for x in tails], pa.int64()),
                ],
                names=[*KEY, "chunk", "heads", "tails"],
            )

    return run


def split_pieces(rows: DataFrame, chunk: int = 32_768, overlap: int = 512) -> tuple[DataFrame, DataFrame]:
    """``doc_id, text_hash, piece, pieces, text``: short texts, and the pieces of long ones.

    Each piece can be encoded alone.

    A text in which two neighbouring chunks share no boundary (a run without any, longer than the
    overlap) stays one piece.
    """
    long = rows.filter(F.length("text") > chunk)
    chunks = (
        long.withColumn("chunk", F.explode(F.sequence(F.lit(0), ((F.length("text") - 1) / chunk).cast("int"))))
        .withColumn("text", F.expr(f"substring(text, chunk * {chunk} + 1, {chunk + overlap})"))
    )
    marks = chunks.mapInArrow(
        _boundaries(chunk, overlap),
        "doc_id long, text_hash long, chunk int, heads array<long>, tails array<long>",
    )
    seams = (
        marks.dropDuplicates([*KEY, "chunk"])
        .groupBy(*KEY)
        .agg(F.sort_array(F.collect_list(F.struct("chunk", "heads", "tails"))).alias("c"))
        .withColumn(
            "cuts",
            F.expr(
                "transform(sequence(1, size(c) - 1),"
                " i -> array_min(array_intersect(c[i].heads, c[i - 1].tails)))"
            ),
        )
        .select(
            *KEY,
            F.when(F.exists("cuts", F.isnull), F.array().cast("array<long>")).otherwise(F.col("cuts")).alias("cuts"),
        )
    )
    cut = (
        join_by_key(long, seams, "inner")
        .withColumn("begins", F.concat(F.array(F.lit(0).cast("long")), "cuts"))
        .withColumn("ends", F.concat("cuts", F.array(F.length("text").cast("long"))))
        .select(*KEY, "text", F.size("ends").alias("pieces"), F.posexplode(F.arrays_zip("begins", "ends")).alias("piece", "at"))
        .withColumn("text", F.expr("substring(text, int(at.begins) + 1, int(at.ends - at.begins))"))
        .select(*KEY, "piece", "pieces", "text")
    )
    whole = rows.filter(F.length("text") <= chunk)
    whole = whole.select(*KEY, F.lit(0).alias("piece"), F.lit(1).alias("pieces"), "text")
    return whole, cut


def _encode(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(vocabulary)
        for batch in batches:
            found = [np.array(coder.encode_ordinary(text), np.int32) for text in batch.column("text").to_pylist()]
            ids = list_array(np.concatenate([np.zeros(0, np.int32), *found]), [len(x) for x in found], pa.int32())
            kept = [name for name in batch.schema.names if name != "text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(name) for name in kept], ids], names=[*kept, "ids"])

    return run


def encode(docs: DataFrame, vocabulary: str, chunk: int = 32_768, overlap: int = 512) -> DataFrame:
    """``doc_id, text_hash, ids``: the token ids of each whole text, one row for each row of ``docs``.

    Null texts are empty and have no ids; null and repeated numbers are kept as they are.
    """
    whole, long_pieces = split_pieces(texts(docs), chunk, overlap)
    schema = "doc_id long, text_hash long, piece int, pieces int, ids array<int>"

    def encoded(rows: DataFrame) -> DataFrame:
        return rows.mapInArrow(_encode(vocabulary), schema)

    # Rows of equal number and text have equal pieces: the set holds each once.
    joined = (
        encoded(long_pieces)
        .groupBy(*KEY)
        .agg(F.sort_array(F.collect_set(F.struct("piece", "ids"))).alias("parts"), F.expr("count(1) div max(pieces)").alias("copies"))
        .select(*KEY, F.flatten(F.transform("parts", lambda part: part["ids"])).alias("ids"), "copies")
        .select(*KEY, F.explode(F.array_repeat("ids", F.col("copies").cast("int"))).alias("ids"))
    )
    return encoded(whole).select(*KEY, "ids").unionByName(joined)


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """Adds ``decoded``, the raw bytes of the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(vocabulary)
        for batch in batches:
            decoded = [coder.decode_bytes(ids) for ids in batch.column("ids").to_pylist()]
            yield batch.append_column("decoded", pa.array(decoded, pa.binary()))

    return encoded.mapInArrow(run, "doc_id long, text_hash long, ids array<int>, decoded binary")


def digests(decoded: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of encoded and decoded texts."""
    written = F.array_join(F.transform("ids", lambda number: number.cast("string")), " ")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(written, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
