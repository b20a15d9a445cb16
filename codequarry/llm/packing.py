"""Best-fit packing of token sequences by exact complements.

Only the counts of each length (at most ``capacity`` numbers) decide which lengths share a sequence.
Single, pair and triple sums that fill a sequence exactly are consumed first, as often as the counts
allow; the lengths left over go, longest first, to the open sequence with the least room that fits.
The plan says how often a combination occurs, so its size follows the capacity and not the corpus.
Pieces are numbered within their length and look their place up in the plan.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import KEY, list_array, materialize, texts
from .vocabulary import ids_of, odd_characters

# What a sequence holds: (length, times) runs in their order; and how many sequences hold it.
Combination = tuple[tuple[tuple[int, int], ...], int]


def _runs(lengths: list[int]) -> tuple[tuple[int, int], ...]:
    return tuple((length, lengths.count(length)) for length in sorted(set(lengths), reverse=True))


def exact_complements(left: np.ndarray, capacity: int, most: int = 3) -> list[Combination]:
    """Takes from ``left`` (how many of each length) what fills sequences exactly: one, two or three lengths, ``most`` at most."""
    plan: list[Combination] = []

    def take(lengths: list[int]) -> None:
        runs = _runs(lengths)
        times = min(int(left[length]) // k for length, k in runs)
        if times:
            plan.append((runs, times))
            for length, k in runs:
                left[length] -= times * k

    take([capacity])
    for longer in range(capacity - 1, (capacity - 1) // 2, -1) if most > 1 else ():
        take([longer, capacity - longer])
    for longest in range(capacity - 2, 0, -1) if most > 2 else ():
        rest = capacity - longest
        if not left[longest]:
            continue
        # The index of pair sums: both lengths of a pair that exactly fills the rest.
        middle = np.arange(min(longest, rest - 1), (rest - 1) // 2, -1)
        for second in middle[(left[middle] > 0) & (left[rest - middle] > 0)].tolist():
            if not left[longest]:
                break
            take([longest, second, rest - second])
    return plan


def best_fit(left: np.ndarray, capacity: int) -> list[Combination]:
    """Places what is left, longest first, each where the least room remains after it."""
    open_bins: dict[int, list[Combination]] = {}
    rooms = np.zeros(capacity + 1, bool)
    for length in np.flatnonzero(left)[::-1].tolist():
        count = int(left[length])
        while count:
            fitting = np.flatnonzero(rooms[length:])
            if len(fitting):
                room = length + int(fitting[0])
                runs, times = open_bins[room].pop()
                fits = min(room // length, count)
                moved = min(times, count // fits)
                if moved < times:
                    open_bins[room].append((runs, times - moved))
                rooms[room] = bool(open_bins[room])
            else:
                room, runs = capacity, ()
                fits = min(capacity // length, count)
                moved = count // fits
            count -= moved * fits
            after = room - fits * length
            open_bins.setdefault(after, []).append((runs + ((length, fits),), moved))
            rooms[after] = True
    return [combination for bins in open_bins.values() for combination in bins]


def plan_lengths(counts: dict[int, int], capacity: int) -> list[Combination]:
    """Which lengths share a sequence, and in how many sequences; uses every length exactly as often as counted.

    Triples and pairs may take the small lengths that would fill gaps later, so the plan is made with
    combinations of up to three, two and one lengths, and that of fewest sequences counts.
    """
    plans = []
    for most in (3, 2, 1):
        left = np.zeros(capacity + 1, np.int64)
        for length, count in counts.items():
            left[length] = count
        plans.append(exact_complements(left, capacity, most) + best_fit(left, capacity))
    return min(plans, key=lambda plan: sum(times for _, times in plan))


def _places(plan: list[Combination]) -> tuple[np.ndarray, ...]:
    """Per run of the plan: length, first number within the length, times per sequence, first sequence, offset."""
    rows, used, sequence = [], {}, 0
    for runs, times in plan:
        offset = 0
        for length, k in runs:
            rows.append((length, used.get(length, 0), k, sequence, offset))
            used[length] = used.get(length, 0) + k * times
            offset += length * k
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return tuple(table.T)


def token_pieces(
    docs: DataFrame, vocabulary: str, capacity: int = 2048, keep_ids: bool = False, special_as_text: bool = True
) -> DataFrame:
    """``doc_id, text_hash, piece, start, length, ids_crc32`` (and ``ids``): each text's ids and a closing 0.

    Null texts are empty.  Without ``special_as_text`` the definition's added tokens are read as its own
    library reads them by default, as one id wherever a text holds them.  Only what is longer than ``capacity`` is cut: the first piece takes the rest
    of the division, all others are full.
    """

    odd = odd_characters(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = ids_of(vocabulary, odd, special_as_text)
        for batch in batches:
            rows, parts = [], []
            for at, text in enumerate(batch.column("text").to_pylist()):
                ids = np.array([*encode(text), 0], "<u4")
                ends = np.arange(len(ids) % capacity or capacity, len(ids) + 1, capacity).tolist()
                start = 0
                for piece, end in enumerate(ends if len(ids) > capacity else [len(ids)]):
                    part = ids[start:end]
                    rows.append((at, piece, start, end - start, zlib.crc32(part.tobytes())))
                    if keep_ids:
                        parts.append(part)
                    start = end
            at, piece, start, length, crc = np.array(rows, np.int64).reshape(-1, 5).T
            columns = {name: batch.column(name).take(pa.array(at)) for name in KEY}
            columns |= {"piece": pa.array(piece.astype(np.int32)), "start": pa.array(start)}
            columns |= {"length": pa.array(length), "ids_crc32": pa.array(crc)}
            if keep_ids:
                flat = np.concatenate([np.zeros(0, "<u4"), *parts]).astype(np.int32)
                columns["ids"] = list_array(flat, length.tolist(), pa.int32())
            yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, text_hash long, piece int, start long, length long, ids_crc32 long"
    return texts(docs).mapInArrow(run, schema + (", ids array<int>" if keep_ids else ""))


def numbered(pieces: DataFrame, groups: int) -> DataFrame:
    """Adds ``number``: 0, 1, 2, ... within each length, dealt over ``groups`` groups of each length."""
    order = [*KEY, "piece"]
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64(*order), F.lit(groups)))
    before = Window.partitionBy("length").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("length", "group")
        .count()
        .withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0)))
        .select("length", "group", "before")
    )
    within = F.row_number().over(Window.partitionBy("length", "group").orderBy(*order))
    return (
        dealt.withColumn("within", within)
        .join(offsets, ["length", "group"])
        .withColumn("number", F.col("before") + F.col("within") - 1)
        .drop("group", "within", "before")
    )


def pack(pieces: DataFrame, capacity: int = 2048, groups: int | None = None) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces that have a ``length`` of 1 to ``capacity``.

    The plan is made of the counts of all lengths; ``pieces`` should be a written table, because it is
    read twice.  No pieces, no rows.
    """
    spark = pieces.sparkSession
    counts = {row["length"]: row["count"] for row in pieces.groupBy("length").count().collect()}
    lengths, firsts, times, sequences, offsets = _places(plan_lengths(counts, capacity))
    keys = (lengths << 44) + firsts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("length", "number"))
            at = np.searchsorted(keys, (length << 44) + number, side="right") - 1
            within = number - firsts[at]
            sequence = sequences[at] + within // times[at]
            offset = offsets[at] + (within % times[at]) * length
            names = [name for name in batch.schema.names if name != "number"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(name) for name in names], pa.array(sequence), pa.array(offset)],
                names=[*names, "sequence_id", "offset"],
            )

    ranked = numbered(pieces, groups or int(spark.conf.get("spark.sql.shuffle.partitions")))
    fields = [f"`{field.name}` {field.dataType.simpleString()}" for field in ranked.schema if field.name != "number"]
    return ranked.mapInArrow(run, ", ".join([*fields, "sequence_id long", "offset long"]))


def pack_documents(
    docs: DataFrame, vocabulary: str, capacity: int = 2048, keep_ids: bool = False, special_as_text: bool = True
) -> DataFrame:
    """Whole documents as packed pieces: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``).

    Null texts are empty, a closing 0 alone; null and repeated numbers and repeated rows are packed each.
    """
    pieces = materialize(token_pieces(docs, vocabulary, capacity, keep_ids, special_as_text), "pieces")
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return pack(pieces, capacity).select(*names, *(["ids"] if keep_ids else []))


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids``: the packed token sequences themselves, of pieces that kept their ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda part: part["ids"])).alias("ids"))
