"""Substring dedup by difference-cover anchors.

Anchors are windows of words that start only at cover positions: those whose remainder by a period is in
a difference cover, a set whose differences give every remainder.  Any two equal windows of ``window``
words then hold, at one common distance from their starts, an anchor at a cover position of both documents.
From the anchors that several documents share the match is extended: of each document only the windows
that hold a shared anchor are compared as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucket_count
from .meeting import KEYS, NO_NUMBER, PACKED, Items, gather, group_bounds, marked, origins, sent, settle, take, with_found

# Perfect difference covers by period.
COVERS = {7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
_FLUSH = 400_000


class _Words:
    """Words of a text, joined by single spaces, and where each begins there."""

    def __init__(self, text: bytes):
        words = text.split()
        self.count = len(words)
        self.joined = b" ".join(words)
        lengths = np.fromiter(map(len, words), np.int64, self.count)
        self.ends = np.cumsum(lengths + 1) - 1
        self.starts = self.ends - lengths

    def digests(self, at: np.ndarray, width: int, digest) -> np.ndarray:
        """Hashes of the ``width`` words from each place, as columns of 64 bits."""
        text, begins, ends = self.joined, self.starts[at].tolist(), self.ends[at + width - 1].tolist()
        found = b"".join([digest(text[begin:end]) for begin, end in zip(begins, ends)])
        return np.frombuffer(found, "<i8").reshape(len(at), -1)


def period_for(window: int) -> int:
    """The longest period that leaves anchors of at least two fifths of the window."""
    return max([period for period in COVERS if 5 * (window - period + 1) >= 2 * window], default=0)


def anchor_places(count: int, window: int, period: int) -> np.ndarray:
    """Cover positions of a document of ``count`` words at which an anchor fits; none if it has no window."""
    if count < window:
        return np.zeros(0, np.int64)
    every = np.arange(count - (window - period + 1) + 1)
    return every[np.isin(every % period, COVERS[period])]


def _items(digests: np.ndarray, at: np.ndarray, doc: int | None, mark: int) -> Items:
    number = NO_NUMBER if doc is None else doc
    hashes = {name: digests[:, i] for i, name in enumerate(("hash", "check")[: digests.shape[1]])}
    where = {"doc": np.full(len(at), number), "mark": np.full(len(at), mark, np.int32), "at": at.astype(np.int64)}
    return hashes | where


def _by_hash(items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order by hash and document; of each item there: its document, and the least and greatest of its hash."""
    hashes = [items[name] for name in ("hash", "check") if name in items]
    order, _, _ = group_bounds(*hashes, items["doc"])
    _, starts, group = group_bounds(*hashes)
    doc = items["doc"][order]
    return order, doc, doc[starts][group], doc[np.append(starts[1:], len(doc)) - 1][group]


def _speakers(items: Items, answer_least: bool, buckets: int) -> Iterator[pa.RecordBatch]:
    """Of each hash the items of the least document ask; those of other documents are answered.

    ``answer_least``: the asking items are answered too if another document was there.
    """
    order, doc, least, greatest = _by_hash(items)
    items = take(items, order)
    answered = (doc != least) | ((greatest != least) & answer_least)
    yield from sent(take(items, doc == least), origins(items, answered), buckets)


def _anchors(window: int, period: int, buckets: int):
    width = window - period + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            for doc, mark, text in zip(*(batch.column(name).to_pylist() for name in (*KEYS, "text"))):
                words = _Words(text)
                at = anchor_places(words.count, window, period)
                if len(at):
                    held.append(_items(words.digests(at, width, xxhash.xxh3_64_digest), at, doc, mark))
                    count += len(at)
                if count > _FLUSH:
                    yield from _speakers(gather(held), True, buckets)
                    held, count = [], 0
        if held:
            yield from _speakers(gather(held), True, buckets)

    return run


def _shared(items: Items) -> Items:
    """Items whose hash occurs in more than one document."""
    order, _, least, greatest = _by_hash(items)
    return origins(items, order[least != greatest])


def _repeated(items: Items) -> Items:
    """Items whose hash occurs in a document with a smaller number."""
    order, doc, least, _ = _by_hash(items)
    return origins(items, order[doc > least])


def _windows(window: int, period: int, buckets: int):
    width = window - period + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            columns = (batch.column(name).to_pylist() for name in (*KEYS, "text"))
            for doc, mark, text, found in zip(*columns, batch.column("found")):
                words = _Words(text)
                shared = np.zeros(words.count + 1, np.int64)
                shared[1:][found.values.to_numpy()] = 1
                before = np.cumsum(shared)
                # A window holds the anchors that start in its first ``window - width + 1`` places.
                begins = np.arange(words.count - window + 1)
                at = begins[before[begins + window - width + 1] > before[begins]]
                if len(at):
                    held.append(_items(words.digests(at, window, xxhash.xxh3_128_digest), at, doc, mark))
                    count += len(at)
                if count > _FLUSH:
                    yield from _speakers(gather(held), False, buckets)
                    held, count = [], 0
        if held:
            yield from _speakers(gather(held), False, buckets)

    return run


def repeated_windows(docs: DataFrame, window: int = 50, period: int | None = None) -> DataFrame:
    """``doc_id, mark, found``: where windows start whose words also start in a smaller-numbered document."""
    period = period or period_for(window)
    if period not in COVERS or period > window:
        raise ValueError(f"no difference cover of period {period} for windows of {window} words")
    buckets = bucket_count(docs)
    rows = marked(docs)
    texts = rows.withColumn("text", F.col("text").cast("binary"))
    anchors = settle(texts.mapInArrow(_anchors(window, period, buckets), PACKED), _shared, buckets)
    candidates = with_found(rows, anchors, "inner").withColumn("text", F.col("text").cast("binary"))
    return settle(candidates.mapInArrow(_windows(window, period, buckets), PACKED), _repeated, buckets)


def deduplicate(
    docs: DataFrame, window: int = 50, period: int | None = None, carry: tuple[str, ...] = (), untouched: bool = False
) -> DataFrame:
    """``doc_id, mark, n_words, n_removed, kept``: whole texts without words of windows seen before.

    Columns named in ``carry`` come along as the struct ``carried``.

    A word is removed if a window over it also starts in a document with a smaller number; windows are
    judged on the input.  Null texts have no words; a null number is greater than all others; rows of
    equal number do not remove each other's words.  ``kept`` holds the other words, joined by spaces; with
    ``untouched`` a text that loses none is kept as it is.
    """
    rows = with_found(marked(docs, carry), repeated_windows(docs, window, period), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, kept = [], [], []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("found")):
                words = text.split()
                covered = np.zeros(len(words) + 1, np.int64)
                if found.is_valid:
                    starts = found.values.to_numpy()
                    np.add.at(covered, starts, 1)
                    np.add.at(covered, starts + window, -1)
                gone = np.cumsum(covered)[: len(words)] > 0
                counts.append(len(words))
                removed.append(int(gone.sum()))
                if removed[-1]:
                    kept.append(b" ".join(word for word, out in zip(words, gone.tolist()) if not out))
                else:
                    kept.append(text if untouched else b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(name) for name in same],
                    pa.array(counts, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array([text.decode() for text in kept], pa.string()),
                ],
                names=[*same, "n_words", "n_removed", "kept"],
            )

    same = [*KEYS, *(["carried"] if carry else [])]
    binary = rows.withColumn("text", F.col("text").cast("binary")).select(*same, "text", "found")
    kept = ", ".join(f"{name} {dict(binary.dtypes)[name]}" for name in same)
    return binary.mapInArrow(run, f"{kept}, n_words long, n_removed long, kept string")


def digests(deduplicated: DataFrame) -> DataFrame:
    return deduplicated.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
