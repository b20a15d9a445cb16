"""Listings of the direct children of folders, and scans of chosen paths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LISTING = T.StructType([T.StructField("path", T.StringType()), T.StructField("length", T.LongType())])


def list_files(spark: SparkSession, directory: str, suffix: str) -> DataFrame:
    """(path, length) of the files with a suffix that lie directly in a folder, or in each that a glob names.

    The names are matched one level deep, so what lies in subfolders is never listed; Spark looks up many
    files by a job of its own.  Raises when there is no folder; a folder without such files gives no rows.
    """
    roots = folder_roots(spark, directory)
    pattern = f"{directory.rstrip('/')}/*.{suffix}"
    if not _matches(spark, pattern):
        return spark.createDataFrame([], LISTING)
    files = spark.read.format("binaryFile").load(pattern)
    # A folder may carry the suffix, too.
    return files.filter(_lies_directly_in(F.col("path"), roots)).select("path", "length")


def list_folders(spark: SparkSession, pattern: str, holding: str) -> list[str]:
    """The folders of a glob that hold a file of a name."""
    path, filesystem = _file_system(spark, f"{pattern}/{holding}")
    return [status.getPath().getParent().toString() for status in filesystem.globStatus(filesystem.makeQualified(path)) or []]


def list_leaf_folders(spark: SparkSession, directory: str) -> DataFrame:
    """(folder) of every folder below a directory that holds files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(directory)
    return files.select(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).distinct()


def chosen_paths(rows: DataFrame, column: str) -> list[str]:
    """Paths of a listing as a scan takes them.  They are part of the files that the listing's index held."""
    return [escaped(row[0]) for row in rows.select(column).collect()]


def escaped(path: str) -> str:
    """A path whose characters all stand for themselves where globs are allowed."""
    return "".join(f"\\{c}" if c in "{}[]*?\\" else c for c in path)


def _file_system(spark: SparkSession, path: str):
    made = spark._jvm.org.apache.hadoop.fs.Path(path)
    return made, made.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _matches(spark: SparkSession, pattern: str) -> bool:
    path, filesystem = _file_system(spark, pattern)
    return bool(len(filesystem.globStatus(filesystem.makeQualified(path)) or []))


def folder_roots(spark: SparkSession, directory: str) -> list[str]:
    """The folders that a path, relative path or glob names, as Spark reports them; raises if there is none."""
    path, filesystem = _file_system(spark, directory)
    found = filesystem.globStatus(filesystem.makeQualified(path))
    roots = [status.getPath().toString() for status in found or [] if status.isDirectory()]
    if not roots:
        raise FileNotFoundError(f"no folder at {directory}")
    return roots


def _lies_directly_in(path: Column, roots: Sequence[str]) -> Column:
    """Whether a file path names a direct child of one of the ``folder_roots``."""
    one_slash = F.regexp_replace(path, "^([A-Za-z][A-Za-z0-9+.-]*):///", "$1:/")
    return F.regexp_replace(one_slash, "/[^/]*$", "").isin([root.rstrip("/") for root in roots])


def decoded_path(path: Column) -> Column:
    """A ``_metadata`` path, which is URL-encoded; a plus sign in it stands for itself."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
