"""Record files: one JSON object per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codequarry.functions import names
from codequarry.schemas import RECORD
from codequarry.sources.folders import chosen_paths, decoded_path, list_files, list_leaf_folders
from codequarry.sources.repos import holds_one_value, with_json

_VARIANT_TYPE = {T.StringType(): "STRING", T.LongType(): "BIGINT"}


def scan_record_lines(spark: SparkSession, directory: str, *, layout: str = "file") -> DataFrame:
    """Raw lines with their repository: (value, repo).

    ``layout='file'`` reads the ``<repo>.jsonl`` files of one folder, or of each that a glob names, ``'repo'`` and ``'bucket'`` the
    ``repo=<repo>`` and ``repo_bucket=<n>`` folders of ``write_records``.
    """
    if layout == "file":
        return _lines(spark, directory, chosen_paths(list_record_files(spark, directory, layout=layout), "path"), layout)
    if layout in ("repo", "bucket"):
        return _lines(spark, directory, [directory], layout)
    raise ValueError(f"layout: {layout!r}")


def scan_record_table(spark: SparkSession, directory: str) -> DataFrame:
    """Records written as Parquet, in either folder layout."""
    return _table(spark, directory, [directory])


def scan_records(spark: SparkSession, directory: str, *, layout: str = "file") -> DataFrame:
    """Lines, or with ``layout='parquet'`` records."""
    return scan_record_table(spark, directory) if layout == "parquet" else scan_record_lines(spark, directory, layout=layout)


def files_by_repository(spark: SparkSession, directory: str, layout: str) -> DataFrame | None:
    """``list_record_files``, listed once, where each file or folder holds records of one repository; else None."""
    if layout not in ("file", "repo", "parquet"):
        return None
    files = list_record_files(spark, directory, layout=layout)
    return None if layout == "parquet" and files.isEmpty() else files


def list_record_files(spark: SparkSession, directory: str, *, layout: str = "file") -> DataFrame:
    """(path, repo): the files of ``layout='file'``, else the ``repo=<repo>`` folders."""
    if layout == "file":
        stem = names.file_stem(names.base_file_name(F.col("path")))
        return list_files(spark, directory, "jsonl").select("path", stem.alias("repo"))
    name = F.regexp_extract(decoded_path(F.regexp_extract("folder", "/(repo=[^/]*)$", 1)), "(?s)^repo=(.*)$", 1)
    folders = list_leaf_folders(spark, directory).select(F.col("folder").alias("path"), name.alias("repo"))
    return folders.filter(F.col("path").rlike("/repo=[^/]*$"))


def scan_chosen(spark: SparkSession, directory: str, chosen: DataFrame, *, layout: str) -> DataFrame:
    """The lines, or records, of some of the ``list_record_files`` by their path, and nothing else."""
    paths = chosen_paths(chosen, "path")
    return _table(spark, directory, paths) if layout == "parquet" else _lines(spark, directory, paths, layout)


def _lines(spark: SparkSession, directory: str, paths: list[str], layout: str) -> DataFrame:
    # Lines end at LF only; a CR before it is JSON white space.
    reader = spark.read.option("lineSep", "\n")
    if not paths:
        return spark.createDataFrame([], "value string, repo string")
    if layout == "file":
        path = decoded_path(F.col("_metadata.file_path"))
        repo = names.file_stem(names.base_file_name(path))
        return reader.text(paths).select("value", repo.alias("repo"))
    reader = reader.option("basePath", directory)
    if layout == "repo":
        # The declared type keeps a repository named 007 from being read as a number.
        return reader.schema("value string, repo string").text(paths)
    lines = reader.schema("value string, repo_bucket int").text(paths)
    return lines.select("value", F.get_json_object("value", "$.repo").alias("repo"))


def _table(spark: SparkSession, directory: str, paths: list[str]) -> DataFrame:
    schema = T.StructType([*RECORD.fields, T.StructField("repo", T.StringType())])
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.option("basePath", directory).schema(schema).parquet(*paths).select(*schema.fieldNames())


def parse_record_lines(lines: DataFrame) -> DataFrame:
    """Every line as the record columns, ``raw`` and ``is_malformed``.

    A line is a record when it is one valid UTF-8 JSON object that has every field with its own
    JSON type and no negative number; further fields are ignored.
    """
    others = [name for name in lines.columns if name != "value"]
    line = F.when(F.is_valid_utf8("value"), F.col("value"))
    parsed = with_json(lines, line, F.col("value").alias("raw"), *others)
    # Fields are generated, too: it keeps them from being taken out of the value again per use.
    raw_fields = [_json_part(f"$[0].{field.name}", f"_{field.name}") for field in RECORD.fields]
    parts = F.struct(*raw_fields, holds_one_value().alias("_whole"))
    parsed = parsed.select("raw", *others, F.inline(F.array(parts)))
    fits = F.col("_whole")
    for field in RECORD.fields:
        fits = fits & _has_own_type(field)
    return parsed.select(
        "raw",
        *others,
        *[F.col(f"_{f.name}").try_cast(f.dataType).alias(f.name) for f in RECORD.fields],
        (~F.coalesce(fits, F.lit(False))).alias("is_malformed"),
    )


def _json_part(path: str, name: str) -> Column:
    return F.try_variant_get("_json", path, "variant").alias(name)


def _has_own_type(field: T.StructField) -> Column:
    part = F.col(f"_{field.name}")
    same = F.schema_of_variant(part) == _VARIANT_TYPE[field.dataType]
    return same & (part.try_cast("long") >= 0) if field.dataType == T.LongType() else same


def valid_records(parsed: DataFrame) -> DataFrame:
    return parsed.filter(~F.col("is_malformed")).drop("raw", "is_malformed")


def malformed_records(parsed: DataFrame) -> DataFrame:
    """The quarantine next to ``valid_records``."""
    return parsed.filter("is_malformed").drop("is_malformed", *RECORD.fieldNames())
