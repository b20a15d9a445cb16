"""Suffix-array dedup of bytes by prefix-free parsing.

A window of ``GRAM`` bytes whose hash meets a condition is a trigger; triggers cut texts into phrases.
The first trigger of a repeated string is the same in all its copies, so a string is known by its
phrase suffix (the bytes before that trigger, fewer than the phrase has) and by what follows from the
trigger on in the parse.  Two sorted orders decide: the suffix array of the dictionary (phrase suffixes,
read backwards from the trigger) and that of the parse (the text from the trigger on).  Where
neighbours agree for ``a`` bytes in the one and ``length - a`` bytes in the other, the string repeats.

Only distinct phrases in distinct surroundings are sorted.  A first meeting by hash finds them: a trigger
whose near surroundings occur once is done, and so is one whose whole surroundings occur again.
Strings without any trigger meet by their own hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucket_count, materialize
from .meeting import (
    KEYS,
    NO_NUMBER,
    PACKED,
    Items,
    delivered,
    gather,
    group_bounds,
    marked,
    origins,
    packed_answers,
    sent,
    settle,
    take,
    with_found,
)

GRAM = 8
_SPARSE_BITS = 5  # one position in 32 is a trigger
_FLUSH = 400_000
# Triggers with more distinct surroundings than this meet string by string.
_CROWD = 20_000

# What is said of a place: its strings repeat; its surroundings are to be sorted, or its strings compared.
REPEATS, SORT, SPLIT = 0, 1, 2
# Strings are told apart by the distance of their first trigger: near, far, or none at all.
NEAR, FAR, NONE = 0, 1, 2


def _code(at, kind, said):
    return at * 16 + kind * 4 + said


def triggers(text: np.ndarray) -> np.ndarray:
    """Where windows of ``GRAM`` bytes with a sparse hash begin."""
    count = len(text) - GRAM + 1
    if count <= 0:
        return np.zeros(0, np.int64)
    grams = np.empty(count, np.uint64)
    for shift in range(GRAM):
        part = text[shift : shift + (len(text) - shift) // GRAM * GRAM].view("<u8")
        grams[shift::GRAM] = part[: len(grams[shift::GRAM])]
    return np.flatnonzero((grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SPARSE_BITS) == 0)


class Parse:
    """Triggers of a text and which strings of ``length`` bytes have each as their first one.

    String i belongs to the first trigger t of i..i + length - GRAM; ``a`` is t - i.
    """

    def __init__(self, data: bytes, length: int):
        self.data, self.length = data, length
        self.split = (length + 1) // 2
        at = triggers(np.frombuffer(data, np.uint8))
        before = np.concatenate([[-1], at[:-1]]) if len(at) else at
        least = np.maximum(0, at + length - len(data))
        most = np.minimum(at - before - 1, length - GRAM)
        self.kinds = []
        for kind, low, high in ((NEAR, 0, self.split - 1), (FAR, self.split, length)):
            a0, a1 = np.maximum(least, low), np.minimum(most, high)
            keep = a0 <= a1
            self.kinds.append((kind, at[keep], a0[keep], a1[keep]))
        free = np.zeros(max(0, len(data) - length + 1), bool)
        free[:] = True
        cover = np.zeros(len(data) + 2, np.int64)
        np.add.at(cover, np.maximum(0, at - (length - GRAM)), 1)
        np.add.at(cover, at + 1, -1)
        free &= np.cumsum(cover)[: len(free)] == 0
        self.without = np.flatnonzero(free)

    def items(self, doc: int, mark: int) -> Iterator[Items]:
        data, near, whole = self.data, xxhash.xxh3_64_intdigest, xxhash.xxh3_128_digest
        for kind, at, a0, a1 in self.kinds:
            if not len(at):
                continue
            # Strings of one kind share at least the bytes between the kind's own limits.
            low = 0 if kind == NEAR else self.split
            high = self.split - 1 if kind == NEAR else self.length - GRAM
            begins, ends = (at - low).tolist(), (at + self.length - high).tolist()
            firsts, lasts = (at - a1).tolist(), (at + self.length - a0).tolist()
            shared = np.fromiter((near(data[b:e], kind + 1) for b, e in zip(begins, ends)), np.uint64, len(at))
            around = np.fromiter((near(data[b:e], t - b) for b, e, t in zip(firsts, lasts, at.tolist())), np.uint64, len(at))
            yield _items(shared.view(np.int64), around.view(np.int64), doc, mark, _code(at, kind, 0))
        if len(self.without):
            found = b"".join([whole(data[i : i + self.length]) for i in self.without.tolist()])
            pair = np.frombuffer(found, "<i8").reshape(-1, 2)
            yield _items(pair[:, 0], pair[:, 1], doc, mark, _code(self.without, NONE, 0))


def _items(hashes, checks, doc, mark, at) -> Items:
    count = len(at)
    return {"hash": hashes, "check": checks, "doc": np.full(count, doc), "mark": np.full(count, mark, np.int32), "at": at}


def _first_speakers(items: Items, buckets: int) -> Iterator[pa.RecordBatch]:
    """One item for each hash and surroundings asks; if a task has several, all are answered."""
    order, starts, group = group_bounds(items["hash"], items["check"])
    items = take(items, order)
    sizes = np.diff(np.append(starts, len(order)))
    asks = take(items, starts)
    asks["at"] = asks["at"] + (sizes > 1)
    yield from sent(asks, origins(items, (sizes > 1)[group]), buckets)


def _parsed(length: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            for doc, mark, text in zip(*(batch.column(name).to_pylist() for name in (*KEYS, "text"))):
                for items in Parse(text, length).items(NO_NUMBER if doc is None else doc, mark) if len(text) >= length else ():
                    held.append(items)
                    count += len(items["at"])
                if count > _FLUSH:
                    yield from _first_speakers(gather(held), buckets)
                    held, count = [], 0
        if held:
            yield from _first_speakers(gather(held), buckets)

    return run


def _first_meeting(crowd: int):
    def decide(items: Items) -> Items:
        order, starts, group = group_bounds(items["hash"], items["check"])
        items = take(items, order)
        several = (items["at"] & 1) == 1
        items["at"] = items["at"] - several
        repeats = (np.diff(np.append(starts, len(order))) > 1) | np.logical_or.reduceat(several, starts)
        # Surroundings of one hash: which hashes have several of them, one at least not repeated.
        hashes = items["hash"][starts]
        new = np.concatenate([[True], hashes[1:] != hashes[:-1]])
        of = np.cumsum(new) - 1
        distinct, alone = np.bincount(of), np.bincount(of, weights=~repeats)
        meet = ((distinct > 1) & (alone > 0))[of]
        crowded = (distinct > crowd)[of]
        told = origins(items, repeats[group] & ~several)
        one = starts[meet & ~crowded], starts[meet & crowded]
        parts = [told]
        for which, said in zip(one, (SORT, SPLIT)):
            part = origins(items, which)
            part["at"] = part["at"] + said
            parts.append(part)
        return gather(parts)

    return decide


_SURROUNDINGS = "bucket int, hash long, check long, doc long, mark int, at long, kind int, known boolean, a0 int, a1 int, data binary"


def _surroundings(length: int, buckets: int):
    """Rows to be sorted: what the strings of a trigger cover; and single strings of crowded triggers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            columns = (batch.column(name).to_pylist() for name in (*KEYS, "text"))
            for doc, mark, text, found in zip(*columns, batch.column("found")):
                codes = found.values.to_numpy()
                at, kinds, said = codes >> 4, (codes >> 2) & 3, codes & 3
                doc = NO_NUMBER if doc is None else doc
                for kind, places, a0, a1 in Parse(text, length).kinds:
                    known = np.isin(places, at[(kinds == kind) & (said == REPEATS)])
                    low = 0 if kind == NEAR else (length + 1) // 2
                    high = (length + 1) // 2 - 1 if kind == NEAR else length - GRAM
                    for i in np.flatnonzero(np.isin(places, at[(kinds == kind) & (said == SORT)])).tolist():
                        t, first, last = int(places[i]), int(a0[i]), int(a1[i])
                        shared = xxhash.xxh3_64_intdigest(text[t - low : t + length - high], kind + 1)
                        hashed = shared - (1 << 64) if shared >> 63 else shared
                        out.append((shared % buckets, hashed, 0, doc, mark, t, kind, bool(known[i]), first, last, text[t - last : t + length - first]))
                    for i in np.flatnonzero(np.isin(places, at[(kinds == kind) & (said == SPLIT)])).tolist():
                        for a in range(int(a0[i]), int(a1[i]) + 1):
                            begin = int(places[i]) - a
                            pair = np.frombuffer(xxhash.xxh3_128_digest(text[begin : begin + length]), "<i8")
                            out.append((int(pair[0]) % buckets, int(pair[0]), int(pair[1]), doc, mark, begin, NONE, bool(known[i]), 0, 0, b""))
                    if len(out) > 20_000:
                        yield _surrounding_rows(out)
                        out = []
            if out:
                yield _surrounding_rows(out)

    return run


def _surrounding_rows(out: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.bool_(), pa.int32(), pa.int32(), pa.binary()]
    names = ["bucket", "hash", "check", "doc", "mark", "at", "kind", "known", "a0", "a1", "data"]
    return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*out), kinds)], names=names)


def _order(hashes: np.ndarray, sides: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of the sides within each hash, and how far each agrees with the one before it (-1: other hash)."""
    lengths = np.fromiter(map(len, sides), np.int64, len(sides))
    padded = np.array(sides, f"S{width}")
    order = np.lexsort((lengths, padded, hashes))
    letters = padded[order].view(np.uint8).reshape(-1, width)
    agree = np.full(len(sides), -1)
    for begin in range(1, len(sides), 50_000):
        rows = slice(begin, begin + 50_000)
        differ = letters[rows] != letters[begin - 1 : begin - 1 + len(letters[rows])]
        agree[rows] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    agree[1:] = np.minimum(agree[1:], np.minimum(lengths[order][1:], lengths[order][:-1]))
    other = hashes[order][1:] != hashes[order][:-1]
    agree[1:][other] = -1
    return order, agree


def repeated_strings(hashes, first, last, data: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """``row, a`` of each string that begins ``a`` bytes before its row's trigger and occurs in another row.

    ``data`` of a row runs from ``last`` bytes before the trigger to ``length - first`` after it.
    """
    count = len(data)
    back = [text[:at][::-1] for text, at in zip(data, last.tolist())]
    on = [text[at:] for text, at in zip(data, last.tolist())]
    dictionary, suffix_agree = _order(hashes, back, length)
    parse, parse_agree = _order(hashes, on, length)
    rows, distances = [], []
    left, right = np.empty(count, np.int64), np.empty(count, np.int64)
    for a in range(int(first.min(initial=0)), int(last.max(initial=-1)) + 1):
        valid = np.flatnonzero((first <= a) & (a <= last))
        if len(valid) < 2:
            continue
        left[dictionary] = np.cumsum(suffix_agree < a)
        right[parse] = np.cumsum(parse_agree < length - a)
        pair = left[valid] * (count + 1) + right[valid]
        order = np.argsort(pair, kind="stable")
        same = pair[order][1:] == pair[order][:-1]
        again = np.zeros(len(valid), bool)
        again[order[1:]] |= same
        again[order[:-1]] |= same
        rows.append(valid[again])
        distances.append(np.full(int(again.sum()), a))
    nothing = [np.zeros(0, np.int64)]
    return np.concatenate(nothing + rows), np.concatenate(nothing + distances)


def _sorted_meeting(length: int, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        columns = {name: table.column(name).to_numpy() for name in ("hash", "check", "doc", "mark", "at", "kind", "a0", "a1")}
        known = table.column("known").to_numpy(zero_copy_only=False).astype(bool)
        single = columns["kind"] == NONE
        found = []
        if single.any():
            items = {name: columns[name][single] for name in ("hash", "check", "doc", "mark", "at")}
            order, starts, group = group_bounds(items["hash"], items["check"])
            again = np.empty(len(order), bool)
            again[order] = (np.diff(np.append(starts, len(order))) > 1)[group]
            found.append(origins(items, again & ~known[single]))
        rest = np.flatnonzero(~single)
        if len(rest):
            data = table.column("data").combine_chunks().take(pa.array(rest)).to_pylist()
            rows, distances = repeated_strings(columns["hash"][rest], columns["a0"][rest], columns["a1"][rest], data, length)
            new = ~known[rest][rows]
            part = {name: columns[name][rest][rows[new]] for name in ("doc", "mark", "at")}
            part["at"] = part["at"] - distances[new]
            found.append(part)
        for part in found:
            part["at"] = _code(part["at"], NONE, REPEATS)
        return packed_answers(gather(found), buckets)

    return run


def repeats(docs: DataFrame, length: int = 200, crowd: int = _CROWD) -> tuple[DataFrame, DataFrame]:
    """Marked rows, and ``doc_id, mark, found``: coded places of which strings repeat."""
    if length < 4 * GRAM:
        raise ValueError(f"strings of {length} bytes are too short for windows of {GRAM}")
    buckets = bucket_count(docs)
    rows = marked(docs)
    binary = rows.withColumn("text", F.col("text").cast("binary"))
    first = settle(binary.mapInArrow(_parsed(length, buckets), PACKED), _first_meeting(crowd), buckets)
    first = materialize(first, "first-meeting")
    open_ones = first.filter(F.exists("found", lambda code: code.bitwiseAND(3) != REPEATS))
    asked = with_found(rows, open_ones, "inner").withColumn("text", F.col("text").cast("binary"))
    around = asked.select(*KEYS, "text", "found").mapInArrow(_surroundings(length, buckets), _SURROUNDINGS)
    second = delivered(around.groupBy("bucket").applyInArrow(_sorted_meeting(length, buckets), PACKED))
    both = first.unionByName(second).groupBy(*KEYS).agg(F.flatten(F.collect_list("found")).alias("found"))
    return rows, both


def covered(text: bytes, found: np.ndarray, length: int) -> np.ndarray:
    """Which bytes lie in a string that repeats."""
    at, kinds, said = found >> 4, (found >> 2) & 3, found & 3
    marks = np.zeros(len(text) + 1, np.int64)
    singles = at[(kinds == NONE) & (said == REPEATS)]
    np.add.at(marks, singles, 1)
    np.add.at(marks, singles + length, -1)
    if (kinds != NONE).any():
        for kind, places, a0, a1 in Parse(text, length).kinds:
            which = np.isin(places, at[(kinds == kind) & (said == REPEATS)])
            np.add.at(marks, (places - a1)[which], 1)
            np.add.at(marks, (places - a0)[which] + length, -1)
    return np.cumsum(marks)[:-1] > 0


def deduplicate(docs: DataFrame, length: int = 200, crowd: int = _CROWD) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept``: whole texts without the bytes of repeated strings.

    A byte goes if a string of ``length`` bytes over it also starts anywhere else, in the same document
    or another; strings are judged on the input.  Null texts are empty; rows that repeat number and text
    are separate documents, so all of a repeated text of ``length`` bytes or more goes.  ``n_spans``
    counts the maximal removed runs, ``kept`` is the remaining bytes.
    """
    rows, found = repeats(docs, length, crowd)
    joined = with_found(rows, found, "left").withColumn("text", F.col("text").cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, kept = [], []
            for text, places in zip(batch.column("text").to_pylist(), batch.column("found")):
                if not places.is_valid:
                    numbers.append((len(text), 0, 0))
                    kept.append(text)
                    continue
                gone = covered(text, places.values.to_numpy(), length)
                spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                numbers.append((len(text), int(gone.sum()), spans))
                kept.append(np.frombuffer(text, np.uint8)[~gone].tobytes() if spans else text)
            size, removed, spans = np.array(numbers, np.int64).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(size), pa.array(removed), pa.array(spans), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    return joined.select(*KEYS, "text", "found").mapInArrow(run, schema)


def digests(deduplicated: DataFrame) -> DataFrame:
    return deduplicated.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
