"""From archives to records, and from records to deduplicated records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codequarry.functions import names, text
from codequarry.functions.tokens import token_counter
from codequarry.operators.dedup import exact_dedup, least_strings
from codequarry.operators.guards import RowGuard
from codequarry.operators.joins import keep_matching, key_set
from codequarry.operators.languages import keep_languages, language_extensions
from codequarry.schemas import CATEGORY, MAX_FILE_SIZE, RECORD_COLUMNS
from codequarry.session import written_once
from codequarry.sources import archives as archive_source
from codequarry.sources import records as record_source


def assemble_records(
    entries: DataFrame,
    *,
    extension: str = "first_dot",
    record_id: str = "stable",
    with_errors: bool = False,
) -> DataFrame:
    """Archive members with content as records without ``tokens``; members that are not UTF-8 text
    are dropped, or with ``with_errors`` kept, like all error rows, with ``archive`` and ``error``.

    ``extension='last_dot'`` gives the suffix of the file name instead of everything after the first
    dot of the path.  ``record_id='uuid'`` gives random ids, which change whenever the records are
    computed again, so write such records before using them twice.
    """
    path = F.col("entry_name")
    file_name = names.path_file_name(path)
    ids = {
        "stable": text.stable_record_id(F.col("repo"), path, F.col("entry_index")),
        "uuid": F.uuid(),
    }
    extensions = {
        "first_dot": names.first_dot_extension(path),
        "last_dot": names.last_dot_extension(file_name),
    }
    for options, chosen in ((extensions, extension), (ids, record_id)):
        if chosen not in options:
            raise ValueError(f"{chosen!r} is not one of {sorted(options)}")
    content = F.col("content").cast("string")
    if with_errors:
        not_text = F.when(~F.is_valid_utf8(content), "not UTF-8 text")
        error = F.coalesce("error", not_text)
        entries = entries.withColumn("error", error)
        content, more = F.when(error.isNull(), content), ["archive", "error"]
    else:
        entries, more = entries.filter(F.is_valid_utf8(content)), []
    return entries.select(
        text.trim_text(content).alias("text"),
        ids[record_id].alias("id"),
        extensions[extension].alias("file_extension"),
        F.lit(CATEGORY).alias("category"),
        path.alias("path"),
        "size_in_bytes",
        file_name.alias("file_name"),
        "repo",
        *more,
    )


def add_tokens(records: DataFrame, vocabulary: str, *, special_as_text: bool = False) -> DataFrame:
    """Whole records: with ``tokens``, and without the texts a tokenizer refuses.

    Rows with an ``error`` column are all kept; a refused text gets an error.
    """
    count_tokens = token_counter(
        records.sparkSession, vocabulary, special_as_text=special_as_text
    )
    counted = records.withColumn("tokens", count_tokens(F.col("text")))
    if "error" in records.columns:
        refused = F.when(F.col("tokens").isNull(), "refused by the tokenizer")
        counted = counted.withColumn("error", F.coalesce("error", refused))
        return counted.select(*RECORD_COLUMNS, "repo", "archive", "error")
    return counted.filter(F.col("tokens").isNotNull()).select(*RECORD_COLUMNS, "repo")


def extract(
    spark: SparkSession,
    repos: DataFrame | None,
    archive_dir: str,
    *,
    archives: DataFrame | None = None,
    vocabulary: str | None,
    max_file_size: int = MAX_FILE_SIZE,
    match: str = "exact",
    languages: DataFrame | None = None,
    catalog: DataFrame | None = None,
    extension: str = "first_dot",
    record_id: str = "stable",
    special_as_text: bool = False,
    split_bytes: int = archive_source.SPLIT_BYTES,
    through_spark: bool = False,
    with_errors: bool = False,
    guard: RowGuard | None = None,
) -> DataFrame:
    """Records of the archives of the listed repositories, or of ``archives`` (archive, length, stem) listed before.

    ``with_errors`` adds ``archive`` and ``error`` and keeps what else is left out with a reason: archives
    that cannot be read, encrypted and damaged members, members that are no text or that the tokenizer
    refuses.  Write such rows, then take ``accepted`` and ``rejected`` of them; the archives are listed
    and read once for both.

    ``languages`` (with ``catalog``) keeps only files of these languages; the filter runs on the
    archive listing, before anything is inflated.  Without a ``vocabulary`` the records have no
    ``tokens``: counting is the costliest step, so it pays to write such records as Parquet, dedupe
    them and ``add_tokens`` to what is left.  ``through_spark`` lets Spark read the matched archives as
    whole cells, for storage that executors cannot open through Arrow; archives above the size of a cell
    are errors then.  ``guard`` watches the rows, see ``RowGuard``.
    """
    in_language = _language_filter(languages, catalog)
    matched = archives
    if matched is None:
        listed = archive_source.list_archives(spark, archive_dir)
        matched = archive_source.match_archives(listed, repos, match)
    common = {"max_file_size": max_file_size, "with_errors": with_errors}
    if through_spark:
        held, too_large = archive_source.read_contents(matched)
        entries = archive_source.expand_archives(
            held, keep_entries=in_language.get("keep_entries"), **common
        )
        if with_errors:
            entries = entries.unionByName(too_large, allowMissingColumns=True)
    else:
        entries = archive_source.scan_archives(
            matched, split_bytes=split_bytes, **in_language, **common
        )
    records = assemble_records(
        entries, extension=extension, record_id=record_id, with_errors=with_errors
    )
    if vocabulary is not None:
        records = add_tokens(records, vocabulary, special_as_text=special_as_text)
    return guard.watch(records) if guard else records


def accepted(rows: DataFrame) -> DataFrame:
    """The records of ``extract(with_errors=True)``."""
    return rows.filter(F.col("error").isNull()).drop("archive", "error")


def rejected(rows: DataFrame) -> DataFrame:
    """The quarantine of ``extract(with_errors=True)``: (repo, archive, path, error)."""
    return rows.filter(F.col("error").isNotNull()).select("repo", "archive", "path", "error")


def extract_unique(
    spark: SparkSession,
    repos: DataFrame,
    archive_dir: str,
    *,
    vocabulary: str,
    max_file_size: int = MAX_FILE_SIZE,
    match: str = "exact",
    languages: DataFrame | None = None,
    catalog: DataFrame | None = None,
    extension: str = "first_dot",
    special_as_text: bool = False,
    split_bytes: int = archive_source.SPLIT_BYTES,
    with_errors: bool = False,
) -> DataFrame:
    """What ``extract``, writing, and ``dedupe`` give, with no text written or shuffled in between.

    The archives are read twice.  The first pass, which runs at once, hashes texts and writes hash and
    id of each record; ids are a function of the listing, so the second pass drops all but the
    surviving members before it inflates any, and counts tokens of survivors only.

    ``with_errors`` adds ``archive`` and ``error``, and rows for what is left out with a reason, as in
    ``extract``: the first pass writes them next to the hashes.  Of several copies of a text that the
    tokenizer refuses, the one that would survive is named.  Split the rows with ``accepted`` and
    ``rejected``.
    """
    in_language = _language_filter(languages, catalog)
    matched = archive_source.match_archives(
        archive_source.list_archives(spark, archive_dir), repos, match
    )
    options = {"max_file_size": max_file_size, "split_bytes": split_bytes}
    entries = archive_source.scan_archives(matched, **in_language, **options, with_errors=with_errors)
    found = assemble_records(entries, with_errors=with_errors)
    account = ["repo", "archive", "path", "error"] if with_errors else []
    narrow = found.select("id", text.content_hash(F.col("text")).alias("content_hash"), *account)
    first = written_once(narrow, "first-pass")
    hashed = first.filter(F.col("content_hash").isNotNull())
    survivors = least_strings(hashed, "content_hash", "id").select(F.col("id").alias("_id"))

    def keep_survivors(listed: DataFrame) -> DataFrame:
        made = text.stable_record_id(F.col("repo"), F.col("entry_name"), F.col("entry_index"))
        listed = listed.filter(F.col("error").isNull())
        kept = listed.withColumn("_id", made).join(survivors, "_id", "left_semi")
        return kept.select(*listed.columns)

    unique = archive_source.scan_archives(
        matched, keep_entries=keep_survivors, regroup=True, **options, with_errors=with_errors
    )
    records = assemble_records(unique, extension=extension, with_errors=with_errors)
    counted = add_tokens(records, vocabulary, special_as_text=special_as_text)
    if not with_errors:
        return counted
    errors = first.filter(F.col("error").isNotNull()).select(*account)
    return counted.unionByName(errors, allowMissingColumns=True)


def _language_filter(languages: DataFrame | None, catalog: DataFrame | None) -> dict:
    """Options of an archive scan that keep the files of these languages."""
    if languages is None:
        return {}
    if catalog is None:
        raise ValueError("languages needs a catalog")
    wanted = key_set(language_extensions(catalog, languages), "extension")

    def keep_entries(entries: DataFrame) -> DataFrame:
        named = entries.withColumn("_name", names.path_file_name(F.col("entry_name")))
        failed = F.col("error").isNotNull()
        return keep_languages(named, wanted, file_name="_name", also=failed).drop("_name")

    # Too many extensions for a broadcast are joined by a shuffle of the listing.
    return {
        "keep_entries": keep_entries,
        "regroup": not wanted.small,
    }


def read_corpus(
    spark: SparkSession,
    directory: str,
    repos: DataFrame | None = None,
    *,
    layout: str = "file",
    match: str = "exact",
) -> DataFrame:
    """Valid records of the listed repositories; files of other repositories are never opened.

    ``layout`` is one of ``scan_record_lines``, or ``'parquet'`` for records written so.  ``match``
    is that of ``match_archives``.  Where a file or folder has one repository, the listing is joined
    with the list and only what matches is scanned, however many repositories are listed.  A
    ``repo_bucket`` folder has many: its rows are joined, before they are parsed.
    """
    files = None if repos is None else record_source.files_by_repository(spark, directory, layout)
    if files is not None:
        keyed = files.withColumn("repo_key", archive_source.key_of_stem(F.col("repo"), match))
        chosen = keyed.join(repos.select("repo_key"), "repo_key", "left_semi").select("path")
        rows = record_source.scan_chosen(spark, directory, chosen, layout=layout)
    else:
        rows = record_source.scan_records(spark, directory, layout=layout)
        if repos is not None:
            spread = "id" if layout == "parquet" else "value"
            keyed = rows.withColumn("repo_key", archive_source.key_of_stem(F.col("repo"), match))
            rows = keep_matching(keyed, repos, "repo_key", spread=[spread]).drop("repo_key")
    if layout != "parquet":
        rows = record_source.valid_records(record_source.parse_record_lines(rows))
    return rows.select(*RECORD_COLUMNS, "repo")


def dedupe(
    spark: SparkSession,
    repos: DataFrame | None,
    directory: str,
    *,
    layout: str = "file",
    match: str = "exact",
    guard: RowGuard | None = None,
) -> DataFrame:
    """Records of the listed repositories, one per distinct text over all of them.

    The first of its two passes, which runs at once, needs only ids and texts; with
    ``layout='parquet'`` it reads no more.  ``guard`` watches the rows, see ``RowGuard``.
    """
    kept = exact_dedup(read_corpus(spark, directory, repos, layout=layout, match=match))
    return guard.watch(kept) if guard else kept
