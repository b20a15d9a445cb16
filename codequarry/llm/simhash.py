"""SimHash near-duplicates by the generalised pigeonhole principle.

The bits of all fingerprints are grouped so that correlated ones share a partition.  With thresholds
t_i, whose t_i + 1 sum to the distance + 1, two fingerprints within the distance lie within t_i in some
partition i.  Partitions and their unequal thresholds are those of least estimated cost (rows probed and
candidates met), found by dynamic programming on counts over all fingerprints.  Each fingerprint is
listed under its own value of a partition and under the values within the threshold; fingerprints that
meet are verified on all bits.  A meeting place yields a spanning forest and never all of its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KEY, join_by_key, materialize, texts
from .components import connected_components

_BITS = 64
# Places with more rows than this are linked through midpoints instead of comparisons.
_CROWD = 20_000


def fingerprint(text: bytes, shingle: int) -> int:
    """Bits that are set in over half of the hashes of all shingles; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    width = min(shingle, len(words))
    shingles = len(words) - width + 1
    ones = np.zeros(_BITS, np.int64)
    for begin in range(0, shingles, 1 << 14):
        some = range(begin, min(shingles, begin + (1 << 14)))
        hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(words[i : i + width]), 42) for i in some), "<u8", len(some))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > shingles, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id, text_hash, bits`` (64 bits as a signed long) of each whole text; null texts have no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text, shingle) for text in batch.column("text").to_pylist()]
            bits = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*[batch.column(name) for name in KEY], bits], names=[*KEY, "bits"])

    rows = texts(docs).withColumn("text", F.col("text").cast("binary"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, bits long")


def _bit_matrix(bits: np.ndarray) -> np.ndarray:
    return np.unpackbits(bits.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def correlations(distinct: DataFrame) -> np.ndarray:
    """Absolute correlation of each two bits over all fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        together, count = np.zeros((_BITS, _BITS)), 0
        for batch in batches:
            matrix = _bit_matrix(batch.column("bits").to_numpy()).astype(np.float64)
            together += matrix.T @ matrix
            count += len(matrix)
        cells = np.append(together.ravel(), count).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], names=["cell", "n"])

    sums = distinct.select("bits").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    cells = np.array([n for _, n in sorted(sums.collect())], np.float64)
    share = cells[:-1].reshape(_BITS, _BITS) / max(cells[-1], 1)
    ones = np.diag(share)
    spread = np.sqrt(ones * (1 - ones))
    scale = np.outer(spread, spread)
    return np.abs(np.divide(share - np.outer(ones, ones), scale, out=np.zeros_like(scale), where=scale > 0))


def group_bits(correlated: np.ndarray, parts: int) -> list[list[int]]:
    """Partitions of about equal size, each grown from a bit by those most correlated with its members."""
    left, groups = set(range(_BITS)), []
    for part in range(parts, 0, -1):
        group = [max(left, key=lambda bit: (correlated[bit, list(left)].sum(), -bit))]
        left.discard(group[0])
        while len(group) < math.ceil((len(left) + len(group)) / part):
            group.append(max(left, key=lambda bit: (correlated[bit, group].sum(), -bit)))
            left.discard(group[-1])
        groups.append(sorted(group))
    return groups


def allocate(costs: list[list[float]], distance: int) -> tuple[float, list[int]]:
    """Thresholds (-1: partition unused) of least total cost whose t + 1 sum to distance + 1.

    ``costs[i][t]`` is the estimated cost of threshold t in partition i.
    """
    best: list[tuple[float, list[int]]] = [(0.0, [])] + [(math.inf, [])] * (distance + 1)
    for cost in costs:
        best = [
            min(
                ((best[total - spent][0] + (cost[spent - 1] if spent else 0.0), best[total - spent][1] + [spent - 1])
                 for spent in range(total + 1)),
                key=lambda option: option[0],
            )
            for total in range(distance + 2)
        ]
    return best[-1]


def _values(bits: np.ndarray, group: list[int]) -> np.ndarray:
    """The bits of a partition as one number."""
    out = np.zeros(len(bits), np.uint64)
    for place, bit in enumerate(group):
        out |= ((bits >> np.uint64(bit)) & np.uint64(1)) << np.uint64(place)
    return out


def _place(part: int, values: np.ndarray) -> np.ndarray:
    """A partition's value as one key of all partitions."""
    return values.astype(np.int64) | np.int64(part << 58) if part else values.astype(np.int64)


def choose_partitions(distinct: DataFrame, distance: int) -> list[tuple[list[int], int]]:
    """``(bits, threshold)`` of each partition that is probed."""
    correlated = correlations(distinct)
    layouts = [group_bits(correlated, parts) for parts in range(2, distance + 2)] or [group_bits(correlated, 2)]
    groups = [group for layout in layouts for group in layout]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch.column("bits").to_numpy().view(np.uint64)
            for part, group in enumerate(groups):
                part_of = pa.array(np.full(len(bits), part, np.int32))
                values = pa.array(_values(bits, group).astype(np.int64))
                yield pa.RecordBatch.from_arrays([part_of, values], names=["part", "value"])

    met = distinct.select("bits").mapInArrow(run, "part int, value long").groupBy("part", "value").count()
    sums = met.groupBy("part").agg(F.sum("count").alias("n"), F.sum(F.col("count").cast("double") ** 2).alias("pairs"))
    counted = {row["part"]: (row["n"], row["pairs"]) for row in sums.collect()}
    best, part = (math.inf, []), 0
    for layout in layouts:
        costs = []
        for group in layout:
            rows, pairs = counted.get(part, (0, 0.0))
            around = [sum(math.comb(len(group), k) for k in range(t + 1)) for t in range(distance + 1)]
            costs.append([count * (rows + 0.2 * pairs) for count in around])
            part += 1
        total, thresholds = allocate(costs, distance)
        if total < best[0]:
            best = (total, [(group, t) for group, t in zip(layout, thresholds) if t >= 0])
    return best[1]


def _listings(partitions: list[tuple[list[int], int]]):
    """Rows ``place, probe, bits``: each fingerprint at its own value and at the values around it.

    Of two values that differ, only the one with the highest differing bit set goes to the other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch.column("bits").to_numpy().view(np.uint64)
            for part, (group, threshold) in enumerate(partitions):
                values = _values(bits, group)
                for flips in range(threshold + 1):
                    for flipped in combinations(range(len(group)), flips):
                        mask = np.uint64(sum(1 << place for place in flipped))
                        own = (values >> np.uint64(flipped[-1])) & np.uint64(1) == 1 if flips else slice(None)
                        places = _place(part, values[own] ^ mask)
                        if len(places):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(places), pa.array(np.full(len(places), flips > 0)), pa.array(bits[own].view(np.int64))],
                                names=["place", "probe", "bits"],
                            )

    return run


def _forest(bits: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is connected by distances of at most ``distance``."""
    waiting, left, right = bits, [], []
    while len(waiting):
        stack, waiting = [waiting[0]], waiting[1:]
        while stack and len(waiting):
            here = stack.pop()
            near = np.bitwise_count(waiting ^ here) <= distance
            if near.any():
                found = waiting[near]
                left.append(np.full(len(found), here))
                right.append(found)
                stack.extend(found)
                waiting = waiting[~near]
    nothing = np.zeros(0, np.uint64)
    return np.concatenate([nothing, *left]), np.concatenate([nothing, *right])


def _verified(distance: int, small: int = 32):
    """Links within each place of rows sorted by place and probe."""

    def links(places, probe, bits) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
        sizes = np.diff(np.append(starts, len(places)))
        keep = np.repeat((sizes <= small) & (sizes > 1) & ~probe[starts], sizes)
        out = [_forest(np.unique(bits[start : start + size]), distance)
               for start, size in zip(starts.tolist(), sizes.tolist()) if size > small and not probe[start]]
        places, probe, bits = places[keep], probe[keep], bits[keep]
        for step in range(1, small):
            same = (places[step:] == places[:-step]) & ~probe[:-step]
            if not same.any():
                break
            a, b = bits[:-step][same], bits[step:][same]
            near = (np.bitwise_count(a ^ b) <= distance) & (a != b)
            out.append((a[near], b[near]))
        if out:
            a, b = (np.concatenate(side).view(np.int64) for side in zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            if not len(batch):
                continue
            columns = [
                batch.column("place").to_numpy(),
                batch.column("probe").to_numpy(zero_copy_only=False).astype(bool),
                batch.column("bits").to_numpy().view(np.uint64),
            ]
            held.append(columns)
            first, last = held[0][0][0], columns[0][-1]
            if first == last or sum(len(part[0]) for part in held) < 50_000:
                continue  # a place may go on in the next batch
            places, probe, bits = (np.concatenate(column) for column in zip(*held))
            cut = int(np.searchsorted(places, last)) if places[0] <= places[-1] else 0
            yield from links(places[:cut], probe[:cut], bits[:cut])
            held = [[places[cut:], probe[cut:], bits[cut:]]]
        if held:
            yield from links(*(np.concatenate(column) for column in zip(*held)))

    return run


def _midpoint_links(crowd: DataFrame, distance: int) -> DataFrame:
    """Links of a crowd without comparing it: fingerprints meet at every value half the distance away.

    Two within the distance share a value that is within half of it (rounded down) of one and within
    the rest of the other; at each value all are linked to the least one of the nearer kind.
    """
    near, far = distance // 2, distance - distance // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch.column("bits").to_numpy().view(np.uint64)
            for flips in range(far + 1):
                for flipped in combinations(range(_BITS), flips):
                    middle = (bits ^ np.uint64(sum(1 << bit for bit in flipped))).view(np.int64)
                    columns = [pa.array(middle), pa.array(np.full(len(bits), flips <= near)), batch.column("bits")]
                    yield pa.RecordBatch.from_arrays(columns, names=["middle", "near", "bits"])

    rows = crowd.select("bits").distinct().mapInArrow(run, "middle long, near boolean, bits long")
    hubs = rows.filter("near").groupBy("middle").agg(F.min("bits").alias("hub"))
    linked = rows.join(hubs, "middle").filter("bits != hub").select(F.col("bits").alias("a"), F.col("hub").alias("b"))
    return linked.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance).distinct()


def near_links(distinct: DataFrame, distance: int = 3, crowd: int = _CROWD) -> DataFrame:
    """``a, b``: links that connect exactly those ``bits`` that distances of at most ``distance`` connect.

    No two rows of ``distinct`` are equal.  The links are a forest in large groups, not all pairs.
    """
    partitions = choose_partitions(distinct, distance)
    listed = distinct.select("bits").mapInArrow(_listings(partitions), "place long, probe boolean, bits long")

    # A place gets rows from the values around it; only values with many rows can make it crowded.
    most_around = max(sum(math.comb(len(group), k) for k in range(t + 1)) for group, t in partitions)
    own = distinct.select("bits").mapInArrow(
        _listings([(group, 0) for group, _ in partitions]), "place long, probe boolean, bits long"
    )
    heavy = materialize(own.groupBy("place").count().filter(F.col("count") > crowd / most_around), "heavy-values")
    crowds = None
    if not heavy.isEmpty():
        def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                places, counts = batch.column("place").to_numpy(), batch.column("count").to_numpy()
                for part, (group, threshold) in enumerate(partitions):
                    mine = (places >> 58) == part
                    for flips in range(threshold + 1):
                        for flipped in combinations(range(len(group)), flips):
                            met = places[mine] ^ np.int64(sum(1 << place for place in flipped))
                            yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(counts[mine])], names=["place", "n"])

        met = heavy.mapInArrow(around, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
        crowds = materialize(met.filter(F.col("n") > crowd).select("place"), "crowded-places")
        if crowds.isEmpty():
            crowds = None
    usual = listed if crowds is None else listed.join(crowds, "place", "left_anti")
    sorted_rows = usual.repartition("place").sortWithinPartitions("place", "probe")
    links = sorted_rows.mapInArrow(_verified(distance), "a long, b long")
    if crowds is not None:
        links = links.unionByName(_midpoint_links(listed.join(crowds, "place", "left_semi"), distance))
    return links


def components(docs: DataFrame, shingle: int = 3, distance: int = 3, crowd: int = _CROWD) -> DataFrame:
    """``doc_id, text_hash, bits, component, component_id`` of each row of ``docs``.

    Documents of equal fingerprint are one node.  ``component_id`` is the least number that is reached;
    it is null where no number is; ``component`` is a fingerprint of the component.
    """
    marked = materialize(fingerprints(docs, shingle), "fingerprints")
    groups = materialize(marked.groupBy("bits").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    if groups.isEmpty():
        return marked.withColumn("component", F.col("bits")).withColumn("component_id", F.col("doc_id"))
    found = connected_components(near_links(groups, distance, crowd))
    joined = groups.join(found, groups["bits"] == found["node"], "left").drop("node")
    joined = joined.withColumn("component", F.coalesce("component", "bits"))
    least = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    by_bits = materialize(joined.join(least, "component").select("bits", "component", "component_id"), "components")
    return marked.join(by_bits, "bits").select(*KEY, "bits", "component", "component_id")


def digests(marked: DataFrame) -> DataFrame:
    written = F.lower(F.lpad(F.hex("bits"), 16, "0"))
    return marked.select("doc_id", written.alias("fingerprint"), "component_id")


def remove_near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """``docs`` with one document of each component of ``components``: the one with the smallest number.

    Null numbers come after all others.  Of different texts of that number the one of the smallest hash
    stays, of rows that repeat number and text any one.  Null and empty texts have no words and are alike.
    """
    found = components(docs, shingle, distance).groupBy(*KEY, "component", "component_id").count()
    found = materialize(found, "found")
    is_first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    first = found.filter(is_first)
    tied = first.groupBy("component").agg(F.count("*").alias("several"), F.min("text_hash").alias("least"))
    tied = first.join(tied.filter("several > 1"), "component").filter("text_hash != least")
    gone = found.filter(~is_first).select(*KEY).unionByName(tied.select(*KEY)).withColumn("gone", F.lit(True))
    repeated = first.filter("count > 1").select(*KEY, F.lit(True).alias("repeated"))
    decisions = (
        gone.unionByName(repeated, allowMissingColumns=True)
        .groupBy(*KEY)
        .agg(F.max("gone").alias("gone"), F.max("repeated").alias("repeated"))
    )
    decisions = materialize(decisions, "decisions")
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("text_hash"),
        F.struct(*[docs[name] for name in docs.columns]).alias("row"),
    )
    decided = join_by_key(rows, decisions).filter("gone is null")
    if decisions.filter("repeated and gone is null").isEmpty():
        return decided.select("row.*")
    once = decided.filter("repeated").dropDuplicates(KEY)
    return decided.filter("repeated is null").unionByName(once).select("row.*")
