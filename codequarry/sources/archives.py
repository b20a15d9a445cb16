"""Archive listing and the archive scan: zip files to one row per member.

The scan has two Python steps with native filters between them.  The first lists central
directories, the second inflates the members that passed, so no rejected member is ever inflated
and no content crosses a shuffle.
"""

from __future__ import annotations

import functools
import io
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from codequarry.functions import names
from codequarry.schemas import DIRECTORY_PART, ENTRY, MAX_FILE_SIZE
from codequarry.sources import zip_entries
from codequarry.sources.folders import chosen_paths, list_files

SPLIT_BYTES = 128 << 20
# What one task lists of a long central directory.
DIRECTORY_BYTES = 8 << 20
# What one binary cell holds at most.
CELL_BYTES = (1 << 31) - (1 << 20)
_BATCH_ROWS = 1000
_BATCH_BYTES = 16 << 20


def list_archives(
    spark: SparkSession, directory: str, suffix: str = "zip", *, with_content: bool = False
) -> DataFrame:
    """Files of one folder, or of each that a glob names, by suffix as (archive, length, stem).

    ``with_content`` reads all of them, too; to read only some, take ``read_contents`` of the rest of a join.
    """
    path = F.col("path")
    stem = names.file_stem(names.base_file_name(path))
    listed = list_files(spark, directory, suffix).select(path.alias("archive"), "length", stem.alias("stem"))
    return read_contents(listed, 1 << 62)[0] if with_content else listed


def read_contents(archives: DataFrame, max_bytes: int = CELL_BYTES) -> tuple[DataFrame, DataFrame]:
    """(archive, length, stem, content) of listed archives, and error rows of those above ``max_bytes``.

    Only the given archives are read, each by the task that goes on with it, so no content is shuffled.
    """
    spark = archives.sparkSession
    fits = F.col("length") <= max_bytes
    paths = chosen_paths(archives.filter(fits), "archive")
    too_large = archives.filter(~fits).select(
        F.col("stem").alias("repo"), "archive", F.lit("archive above the size of a cell").alias("error")
    )
    if not paths:
        return spark.createDataFrame([], "archive string, length long, stem string, content binary"), too_large
    held = spark.read.format("binaryFile").load(paths)
    path = F.col("path")
    stem = names.file_stem(names.base_file_name(path))
    return held.select(path.alias("archive"), "length", stem.alias("stem"), "content"), too_large


def key_of_stem(stem: Column, match: str) -> Column:
    """What of a file stem is compared with repository keys."""
    if match == "exact":
        return stem
    if match == "prefix":
        return names.match_key(stem)
    raise ValueError(f"match: {match!r}")


def match_archives(archives: DataFrame, repos: DataFrame, match: str = "exact") -> DataFrame:
    """Archives of listed repositories.

    ``'exact'`` compares the whole stem with the repository key, ``'prefix'`` only the stem up to
    its first underscore, which also admits suffixed names of a listed repository.
    """
    keyed = archives.withColumn("repo_key", key_of_stem(F.col("stem"), match))
    # A listing is narrow, so Catalyst may broadcast or shuffle by its own size estimate.
    return keyed.join(repos.select("repo_key"), "repo_key", "left_semi").drop("repo_key")


def list_archive_entries(archives: DataFrame) -> DataFrame:
    """Central directory rows of (archive, stem) rows; an unreadable archive gives one error row.

    Archives are opened by their path, or read from a ``content`` column where there is one.
    """
    schema = to_arrow_schema(ENTRY)
    columns = [name for name in ("archive", "stem", "content") if name in archives.columns]

    def listing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                entries = _entries_of(row["archive"], row["stem"], row.get("content"))
                yield from _batched(entries, schema)

    return archives.select(*columns).mapInArrow(listing, ENTRY)


def _entries_of(archive: str, stem: str, content: bytes | None = None) -> Iterator[dict]:
    common = {"repo": stem, "archive": archive}
    try:
        with zip_entries.open_archive(archive) if content is None else io.BytesIO(content) as stream:
            try:
                yield from [common | entry for entry in zip_entries.list_entries(stream)]
            except zip_entries.DAMAGE:
                # ``zipfile`` reports storage errors of its first reads as damage.
                if storage_error := zip_entries.failure_of(stream):
                    raise storage_error
                raise
    except zip_entries.DAMAGE as error:
        # Storage errors, a vanished file among them, fail the task, so that it is tried again.
        yield common | {"error": f"{type(error).__name__}: {error}"}


def list_long_directories(
    archives: DataFrame, tasks: int, *, longer_than: int = SPLIT_BYTES, directory_bytes: int = DIRECTORY_BYTES
) -> DataFrame:
    """What ``list_archive_entries`` gives for (archive, stem, length) rows, with long directories listed by many tasks.

    Directories above ``directory_bytes`` in archives above ``longer_than`` are cut into byte ranges.  A first
    pass finds the first entry and the end of the last entry of each range.  Where the first range begins with
    the directory, each range begins where the one before ends, and the last ends with the directory, these
    are the directory's entries, and their counts number them.  An archive of which this does not hold, a
    damaged one for example, is listed by one task.
    """
    parts = archives.select("archive", "stem", "length").repartition(tasks)
    cut = functools.partial(_cut_directories, longer_than=longer_than, directory_bytes=directory_bytes)
    walked = parts.mapInArrow(cut, DIRECTORY_PART).repartition(tasks).mapInArrow(_walk_directories, DIRECTORY_PART)

    whole = Window.partitionBy("archive", "stem")
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("last").over(earlier), F.col("start"))
    # No entry begins in a range that the one before it covers.
    follows = F.when(F.col("first").isNull(), reached >= F.col("until")).otherwise(F.col("first") == reached)
    proven = F.coalesce(F.min("follows").over(whole) & (F.max("last").over(whole) == F.max("stop").over(whole)), F.lit(False))
    numbered = walked.withColumns({"follows": follows, "first_index": F.coalesce(F.sum("n").over(earlier), F.lit(0))})
    chosen = numbered.withColumn("proven", proven).filter(
        (F.col("proven") & (F.col("n") > 0)) | (~F.col("proven") & (F.col("part") == 0))
    )
    first = F.when(F.col("proven"), F.col("first")).alias("first")
    schema = to_arrow_schema(ENTRY)

    def listing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                entries = _entries_of if row["first"] is None else functools.partial(_entries_of_part, row)
                yield from _batched(entries(row["archive"], row["stem"]), schema)

    narrow = chosen.select("archive", "stem", first, "last", "first_index", "shift")
    return narrow.repartition(tasks).mapInArrow(listing, ENTRY)


def _cut_directories(
    batches: Iterator[pa.RecordBatch], longer_than: int, directory_bytes: int
) -> Iterator[pa.RecordBatch]:
    """Byte ranges of long directories, and one row without a range for every other archive."""

    def parts(row: dict) -> Iterator[dict]:
        found = None
        if row["length"] > max(longer_than, directory_bytes):
            with zip_entries.open_archive(row["archive"]) as stream:
                found = zip_entries.find_directory(stream)
        common = {"archive": row["archive"], "stem": row["stem"]}
        if found is None or found[1] - found[0] <= directory_bytes:
            yield common | {"part": 0}
            return
        start, stop, shift = found
        for part, begin in enumerate(range(start, stop, directory_bytes)):
            place = {"part": part, "begin": begin, "until": min(begin + directory_bytes, stop)}
            yield common | place | {"start": start, "stop": stop, "shift": shift}

    for batch in batches:
        yield from _batched((part for row in batch.to_pylist() for part in parts(row)), to_arrow_schema(DIRECTORY_PART))


def _walk_directories(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Byte ranges with the place of their entries, and how many they are."""

    def walked(row: dict) -> dict:
        if row["begin"] is None:
            return row
        with zip_entries.open_archive(row["archive"]) as stream:
            found = zip_entries.entries_between(stream, row["begin"], row["until"], row["stop"])
        return row | dict(zip(("first", "last", "n"), found or (None, None, 0)))

    for batch in batches:
        yield from _batched(map(walked, batch.to_pylist()), to_arrow_schema(DIRECTORY_PART))


def _entries_of_part(part: dict, archive: str, stem: str) -> Iterator[dict]:
    with zip_entries.open_archive(archive) as stream:
        place = (part[name] for name in ("first", "last", "first_index", "shift"))
        for entry in zip_entries.list_entries_between(stream, *place):
            yield {"repo": stem, "archive": archive} | entry


def archive_errors(entries: DataFrame) -> DataFrame:
    """The quarantine of a listing or a scan: unreadable archives, encrypted and damaged members."""
    return entries.filter(F.col("error").isNotNull()).select(
        "repo", "archive", "entry_name", "error"
    )


def readable_entries(
    entries: DataFrame, max_file_size: int = MAX_FILE_SIZE, *, with_errors: bool = False
) -> DataFrame:
    """Members worth inflating: regular files with a dot in their path, a safe path and a bounded
    size; ``with_errors`` also the error rows."""
    name = F.col("entry_name")
    wanted = (
        F.col("error").isNull()
        & (F.instr(name, ".") > 0)
        & F.col("is_file")
        & (F.col("size_in_bytes") <= max_file_size)
        & names.is_safe_path(name)
        & names.path_file_name(name).isNotNull()
    )
    return entries.filter(wanted | F.col("error").isNotNull() if with_errors else wanted)


def inflate_entries(entries: DataFrame) -> DataFrame:
    """Add ``content`` to listed members; a damaged one gets an ``error`` instead."""
    output = T.StructType([*entries.schema.fields, T.StructField("content", T.BinaryType())])
    schema = to_arrow_schema(output)

    def inflating(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(_inflated(batches), schema)

    return entries.mapInArrow(inflating, output)


def _inflated(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    opened, stream = None, None
    try:
        for batch in batches:
            for row in batch.to_pylist():
                if row["error"] is not None:
                    yield row | {"content": None}
                    continue
                if row["archive"] != opened:
                    if stream is not None:
                        stream.close()
                    stream = zip_entries.open_archive(row["archive"])
                    opened = row["archive"]
                content, error = zip_entries.read_entry(stream, row)
                yield row | {"content": content, "error": error}
    finally:
        if stream is not None:
            stream.close()


def _batched(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Arrow batches bounded by rows and by content bytes."""
    pending, size = [], 0
    for row in rows:
        pending.append(row)
        size += len(row.get("content") or b"")
        if len(pending) >= _BATCH_ROWS or size >= _BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(pending, schema)
            pending, size = [], 0
    if pending:
        yield pa.RecordBatch.from_pylist(pending, schema)


def scan_archives(
    archives: DataFrame,
    *,
    max_file_size: int = MAX_FILE_SIZE,
    keep_entries: Callable[[DataFrame], DataFrame] | None = None,
    regroup: bool = False,
    split_bytes: int = SPLIT_BYTES,
    directory_bytes: int = DIRECTORY_BYTES,
    with_errors: bool = False,
) -> DataFrame:
    """Readable members of the archives with their content.

    Damaged ones are left out, or with ``with_errors`` kept as rows with an ``error`` and no content,
    like archives that cannot be read and encrypted members.

    The listing is spread over partitions of about ``split_bytes``.  An archive up to that size is
    listed and inflated within one task, with no shuffle.  The members of a larger one are shuffled
    as listing rows, without content, by byte range, so a huge archive is inflated by many tasks, and its
    central directory, if above ``directory_bytes``, is listed by many, see ``list_long_directories``.
    ``keep_entries`` is a DataFrame function that narrows the listing before anything is inflated;
    with ``regroup``, for one that shuffles the listing, all archives are handled as larger ones are.
    """
    is_large = F.lit(True) if regroup else F.col("length") > split_bytes
    sizes = archives.agg(
        F.count("*").alias("files"),
        F.sum(F.when(~is_large, F.col("length"))).alias("small"),
        F.sum(F.when(is_large, F.col("length"))).alias("large"),
        F.max("length").alias("longest"),
    ).first()
    # Explicit numbers: listing rows are tiny, so AQE would merge them all into one task.
    cores = archives.sparkSession.sparkContext.defaultParallelism
    floor = max(1, min(sizes["files"], cores))

    def tasks(size: int | None) -> int:
        return max(floor, -(-(size or 0) // split_bytes))

    def readable(entries: DataFrame) -> DataFrame:
        found = readable_entries(entries, max_file_size, with_errors=with_errors)
        return keep_entries(found) if keep_entries else found

    scans = []
    if not regroup:
        small = archives.filter(~is_large).repartition(tasks(sizes["small"]))
        scans.append(inflate_entries(readable(list_archive_entries(small))))
    if regroup or sizes["large"]:
        large, many = archives.filter(is_large), tasks(sizes["large"])
        if (sizes["longest"] or 0) > max(split_bytes, directory_bytes):
            listers = max(many, min(cores, sizes["large"] // directory_bytes))
            listed = list_long_directories(
                large, listers, longer_than=split_bytes, directory_bytes=directory_bytes
            )
        else:
            listed = list_archive_entries(large.repartition(many))
        ranges = F.floor(F.col("header_offset") / split_bytes)
        spread = readable(listed).repartition(many, "archive", ranges)
        in_order = spread.sortWithinPartitions("archive", "header_offset")
        scans.append(inflate_entries(in_order))
    found = functools.reduce(DataFrame.unionByName, scans)
    return found if with_errors else found.filter(F.col("error").isNull())


def expand_archives(
    archives: DataFrame,
    *,
    max_file_size: int = MAX_FILE_SIZE,
    keep_entries: Callable[[DataFrame], DataFrame] | None = None,
    with_errors: bool = False,
) -> DataFrame:
    """Readable members of (archive, stem, content) rows, for archives held in a binary column.

    Every archive is one cell, so this suits archives well below the cell limit of 2 GiB on storage
    that only Spark can open.  ``with_errors`` is that of ``scan_archives``.
    """
    output = T.StructType([*ENTRY.fields, T.StructField("content", T.BinaryType())])
    schema = to_arrow_schema(output)

    def expanded(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                stream = io.BytesIO(row["content"])
                for entry in _entries_of(row["archive"], row["stem"], row["content"]):
                    entry = dict.fromkeys(ENTRY.fieldNames()) | entry
                    if entry["error"] is not None:
                        yield entry | {"content": None}
                    elif entry["is_file"] and "." in entry["entry_name"] and entry["size_in_bytes"] <= max_file_size:
                        content, error = zip_entries.read_entry(stream, entry)
                        yield entry | {"content": content, "error": error}

    def expanding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(expanded(batches), schema)

    entries = archives.select("archive", "stem", "content").mapInArrow(expanding, output)
    found = readable_entries(entries, max_file_size, with_errors=with_errors)
    return keep_entries(found) if keep_entries else found
