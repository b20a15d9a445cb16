"""Semi- and anti-joins of wide rows with a key set."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codequarry.session import written_once

MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 32 << 20


def fits_broadcast(
    keys: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """Whether a key table is within both bounds, by counting at most ``max_rows + 1`` rows."""
    width = F.lit(0)
    for name in keys.columns:
        width = width + F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0))
    found = keys.limit(max_rows + 1).agg(F.count("*"), F.sum(width)).first()
    return found[0] <= max_rows and (found[1] or 0) <= max_bytes


@dataclass(frozen=True)
class KeySet:
    """Distinct keys, written once, and whether they are within the bounds of a broadcast."""

    table: DataFrame
    small: bool


def key_set(
    keys: DataFrame, on: str, max_rows: int | None = None, max_bytes: int | None = None
) -> KeySet:
    """The ``on`` values of ``keys``, which are evaluated this one time."""
    table = written_once(keys.select(on).distinct(), "keys")
    rows = MAX_BROADCAST_ROWS if max_rows is None else max_rows
    size = MAX_BROADCAST_BYTES if max_bytes is None else max_bytes
    return KeySet(table, fits_broadcast(table, rows, size))


def salts_for(rows: DataFrame, bytes_per_task: int = 256 << 20) -> int:
    """Parts for a key that holds a third of all rows, by the planner's size of the input; 32 where it is unknown."""
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return 32 if size > 1 << 60 else max(1, size // 3 // bytes_per_task)


def keep_matching(
    rows: DataFrame,
    keys: DataFrame | KeySet,
    on: str,
    *,
    spread: Sequence[str | Column],
    also: Column | None = None,
    max_rows: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """``rows`` whose ``on`` value is among ``keys``, and those for which ``also`` is true.

    A key set measured to be small is broadcast, so the rows do not move.  A larger one is joined by
    shuffle with a salt taken from the ``spread`` columns, so that a key holding a large share of all
    rows reaches many tasks; every key is repeated once per salt, which keeps the result exact.
    ``keys`` are evaluated once, at once, and written; a ``key_set`` is taken as it is.
    """
    found = keys if isinstance(keys, KeySet) else key_set(keys, on, max_rows, max_bytes)
    wanted = found.table.withColumnRenamed(found.table.columns[0], on)
    columns, by = rows.columns, [on]
    if found.small:
        wanted = F.broadcast(wanted)
    else:
        salts = salts_for(rows)
        rows = rows.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
        wanted = wanted.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        by = [on, "_salt"]
    if also is None:
        return rows.join(wanted, by, "left_semi").select(*columns)
    found = rows.join(wanted.withColumn("_hit", F.lit(True)), by, "left")
    return found.filter(F.col("_hit").isNotNull() | also).select(*columns)
