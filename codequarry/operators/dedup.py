"""Exact deduplication by content hash over the whole corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codequarry.functions.text import content_hash
from codequarry.session import written_once

_PREFIX_BYTES = 7


def content_survivors(
    records: DataFrame, *, text: str = "text", id: str = "id", order_by: str | None = None
) -> DataFrame:
    """One surviving id per distinct text, as (content_hash, id): the smallest id, or the id with
    the smallest ``order_by``.

    Only hash, id and order cross the shuffle, and a text shared by a large share of all rows is
    collapsed by the map-side aggregation.  String ids are written once, next to their hashes, and
    compared by ``least_strings``.  NULL texts have no content and are left out.
    """
    if order_by in (None, id) and isinstance(records.schema[id].dataType, T.StringType):
        hashed = records.select(content_hash(F.col(text)).alias("content_hash"), F.col(id))
        # The filter runs on what was written: above the scan it would hash every text twice.
        hashed = written_once(hashed, "content-hashes").filter(F.col("content_hash").isNotNull())
        return least_strings(hashed, "content_hash", id)
    hashed = records.select(
        content_hash(F.col(text)).alias("content_hash"),
        F.col(id),
        *([] if order_by in (None, id) else [F.col(order_by)]),
    )
    # Null texts make a group of their own without an id.  A filter on the text or the hash would be
    # pushed down to the scan and compute it a second time.
    chosen = F.min(id) if order_by is None else F.min_by(id, order_by)
    hash_groups = hashed.groupBy("content_hash").agg(
        F.when(F.col("content_hash").isNotNull(), chosen).alias(id)
    )
    return hash_groups.filter(F.col(id).isNotNull())


def prefix_key(value: Column) -> Column:
    """The first bytes of a string as a LONG in the order of the strings; a shorter one ends in zeros."""
    digits = F.hex(F.substring(value.cast("binary"), 1, _PREFIX_BYTES))
    return F.conv(F.rpad(digits, 2 * _PREFIX_BYTES, "0"), 16, 10).cast("long")


def least_strings(rows: DataFrame, group: str, value: str) -> DataFrame:
    """The smallest ``value`` of each ``group``, as (group, value), by aggregations that hash.

    The smallest of a string needs a sort, so what is aggregated is the number of its first bytes, and
    how many rows of the group have it.  The rows with the least number are then looked up by group and
    number, so a group that holds a large share of all rows is spread.  Only where several rows of a
    group share their first bytes are these compared as a whole.  ``rows`` are read several times:
    they should be narrow and written.  NULL values and groups are left out.
    """
    keyed = rows.select(group, value, prefix_key(F.col(value)).alias("_key"))
    keyed = keyed.filter(F.col(value).isNotNull() & F.col(group).isNotNull())
    counted = keyed.groupBy(group, "_key").agg(F.count("*").alias("_rows"))
    least = counted.groupBy(group).agg(
        F.min("_key").alias("_key"), F.min_by("_rows", "_key").alias("_rows")
    )
    alone = keyed.join(least.filter("_rows = 1"), [group, "_key"], "left_semi")
    tied = keyed.join(least.filter("_rows > 1"), [group, "_key"], "left_semi")
    # The limit on the rank is pushed below the shuffle, so each task sends one row of a group.
    place = F.row_number().over(Window.partitionBy(group).orderBy(value))
    first = tied.withColumn("_place", place).filter("_place = 1")
    return alone.select(group, value).unionByName(first.select(group, value))


def keep_survivors(records: DataFrame, survivors: DataFrame, *, id: str = "id") -> DataFrame:
    """Records with a surviving id; if ids repeat, every row with a surviving id stays.

    The survivor set grows with the corpus, so it is never hinted to be broadcast; AQE picks the
    join by the measured sizes.
    """
    return records.join(survivors.select(id), id, "left_semi").select(*records.columns)


def exact_dedup(
    records: DataFrame,
    *,
    text: str = "text",
    id: str = "id",
    order_by: str | None = None,
    keep_null_text: bool = False,
) -> DataFrame:
    """One record per distinct text.  ``records`` is scanned twice, so ids must be reproducible.

    With string ids the first scan runs at once, and its hashes are written to the shared folder.
    """
    survivors = content_survivors(records, text=text, id=id, order_by=order_by)
    kept = keep_survivors(records, survivors, id=id)
    if keep_null_text:
        kept = kept.filter(F.col(text).isNotNull())
        kept = kept.unionByName(records.filter(F.col(text).isNull()))
    return kept


def dedup_summary(records: DataFrame, *, text: str = "text") -> DataFrame:
    """One row: loaded documents, unique documents and the share of duplicates.

    Counted per hash first, so a hot hash is collapsed before the shuffle and no row is expanded.
    """
    per_hash = records.groupBy(content_hash(F.col(text)).alias("_hash")).agg(
        F.count("*").alias("_rows")
    )
    totals = per_hash.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("loaded"), F.count("_hash").alias("unique")
    )
    rate = F.when(F.col("loaded") > 0, 1 - F.col("unique") / F.col("loaded"))
    return totals.withColumn("duplicate_rate", F.coalesce(rate, F.lit(0.0)))
