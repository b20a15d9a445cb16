"""A corpus kept up to date: only new and changed archives are extracted again.

A store is a folder of tables by generation: the manifest of all archives after a refresh, the records
and hashes of the archives that the refresh extracted, and what it found changed.  What was written
before is not touched, and the manifest is written last, so a refresh that fails leaves the store as it was.
The manifest names, for each archive, the generation that holds its records.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codequarry.functions.text import content_hash
from codequarry.operators.dedup import least_strings
from codequarry.plans.corpus import extract
from codequarry.schemas import RECORD_COLUMNS
from codequarry.session import written_once
from codequarry.sinks.records import write_records
from codequarry.sources import archives as archive_source
from codequarry.sources import records as record_source
from codequarry.sources import zip_entries
from codequarry.sources.folders import list_folders

_MANIFEST = "archive string, repo string, digest string, generation int"
_READ_BYTES = 4 << 20


def archive_digests(archives: DataFrame, split_bytes: int = archive_source.SPLIT_BYTES) -> DataFrame:
    """(archive, stem, length, digest): SHA-256 of listed archives, read as streams by the executors."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path in batch.column("archive").to_pylist():
                state = hashlib.sha256()
                with zip_entries.open_archive(path) as stream:
                    while part := stream.read(_READ_BYTES):
                        state.update(part)
                found.append(state.hexdigest())
            yield batch.append_column("digest", pa.array(found, pa.string()))

    total = archives.agg(F.count("*"), F.sum("length")).first()
    floor = min(total[0], archives.sparkSession.sparkContext.defaultParallelism)
    spread = archives.select("archive", "stem", "length").repartition(max(1, floor, (total[1] or 0) // split_bytes))
    return spread.mapInArrow(digests, "archive string, stem string, length long, digest string")


def _path(store: str, table: str, generation: int | None = None) -> str:
    folder = f"{store.rstrip('/')}/{table}"
    return folder if generation is None else f"{folder}/generation={generation}"


def manifest(spark: SparkSession, store: str) -> tuple[DataFrame, int]:
    """The newest manifest of a store and its generation; no rows and -1 for a store that is not there yet."""
    done = list_folders(spark, f"{_path(store, 'manifest')}/generation=*", holding="_SUCCESS")
    newest = max((int(folder.rpartition("=")[2]) for folder in done), default=-1)
    if newest < 0:
        return spark.createDataFrame([], _MANIFEST), -1
    # The folder's own number is that of the refresh, the column that of the records.
    return spark.read.schema(_MANIFEST).option("basePath", _path(store, "manifest", newest)).parquet(_path(store, "manifest", newest)), newest


def refresh(spark: SparkSession, repos: DataFrame, archive_dir: str, store: str, *, match: str = "exact", **options) -> DataFrame:
    """Bring a store up to date with the archives of the listed repositories; ``options`` are those of ``extract``.

    Repositories with an archive that is new, gone, or of other content than in the store are extracted; all
    others keep the records they have.  What is no longer listed leaves the manifest.  Returns (archive, repo,
    status) with ``new``, ``changed``, ``unchanged`` or ``gone``.
    """
    before, generation = manifest(spark, store)
    generation += 1
    listed = archive_source.list_archives(spark, archive_dir)
    matched = archive_source.match_archives(listed, repos, match).select("archive", "stem", "length")
    # The digests use it twice: once written, the listed repositories are not made and joined again.
    now = archive_digests(written_once(matched.coalesce(spark.sparkContext.defaultParallelism), "matched"))
    old = before.select("archive", F.col("repo").alias("_repo"), F.col("digest").alias("_digest"), "generation")
    status = (
        F.when(F.col("digest").isNull(), "gone")
        .when(F.col("_digest").isNull(), "new")
        .when(F.col("_digest") == F.col("digest"), "unchanged")
        .otherwise("changed")
    )
    merged = now.join(old, "archive", "full").select(
        "archive",
        F.coalesce("stem", "_repo").alias("repo"),
        "length",
        "digest",
        F.col("generation").alias("held_in"),
        status.alias("status"),
    )
    merged.write.mode("overwrite").parquet(_path(store, "status", generation))
    merged = spark.read.schema(merged.schema).parquet(_path(store, "status", generation))
    stale = merged.filter("status <> 'unchanged'").select("repo").distinct().withColumn("stale", F.lit(True))
    present = merged.filter("status <> 'gone'").join(stale, "repo", "left")
    delta = present.filter("stale").select("archive", "length", F.col("repo").alias("stem"))
    records = extract(spark, None, archive_dir, archives=delta, **options)
    folder = _path(store, "records", generation)
    write_records(records, folder, fmt="parquet")
    written = record_source.scan_record_table(spark, folder)
    hashes = written.select("repo", "id", content_hash(F.col("text")).alias("content_hash"))
    hashes.write.mode("overwrite").parquet(_path(store, "hashes", generation))
    holds = F.when(F.col("stale"), F.lit(generation)).otherwise(F.col("held_in")).cast("int")
    kept = present.select("archive", "repo", "digest", holds.alias("generation"))
    kept.write.mode("overwrite").parquet(_path(store, "manifest", generation))
    return merged.select("archive", "repo", "status")


def _current(spark: SparkSession, store: str) -> DataFrame:
    return manifest(spark, store)[0].select("repo", "generation").distinct()


def stored_records(spark: SparkSession, store: str) -> DataFrame:
    """The records of a store as the last refresh left them; folders that were replaced are not read."""
    root = _path(store, "records")
    folders = record_source.list_record_files(spark, root, layout="repo")
    number = F.regexp_extract("path", "/generation=(\\d+)/[^/]*$", 1).cast("int")
    chosen = folders.withColumn("generation", number).join(_current(spark, store), ["repo", "generation"], "left_semi")
    return record_source.scan_chosen(spark, root, chosen, layout="parquet")


def stored_unique(spark: SparkSession, store: str) -> DataFrame:
    """One record per distinct text of a store; only the hashes that were stored are compared, no text is read for it."""
    hashes = spark.read.schema("repo string, id string, content_hash string, generation int").parquet(_path(store, "hashes"))
    current = hashes.join(_current(spark, store), ["repo", "generation"], "left_semi")
    survivors = least_strings(current, "content_hash", "id")
    return stored_records(spark, store).join(survivors.select("id"), "id", "left_semi").select(*RECORD_COLUMNS, "repo")
