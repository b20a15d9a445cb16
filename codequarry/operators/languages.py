"""Language catalog lookups and the language filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codequarry.functions import names
from codequarry.operators.joins import KeySet, keep_matching, key_set
from codequarry.schemas import CATEGORY


def _extensions(languages: DataFrame) -> DataFrame:
    return languages.select(F.explode("extensions").alias("extension"), "type").distinct()


def programming_extensions(catalog: DataFrame) -> DataFrame:
    """Extensions of all programming languages as distinct (extension, type)."""
    return _extensions(catalog.filter(F.col("type") == CATEGORY))


def language_extensions(catalog: DataFrame, requested: DataFrame) -> DataFrame:
    """Extensions of the requested languages, of any type.

    When these have none at all, the extensions of all programming languages.
    """
    named = catalog.filter(F.col("type").isNotNull())
    hits = _extensions(named.join(requested.select("language"), "language", "left_semi"))
    fallback = programming_extensions(catalog).filter(~hits.exists())
    return hits.union(fallback)


def unknown_languages(catalog: DataFrame, requested: DataFrame) -> DataFrame:
    """Requested languages the catalog does not define."""
    known = catalog.select("language")
    return requested.select("language").distinct().join(known, "language", "left_anti")


def keep_languages(
    files: DataFrame,
    extensions: DataFrame | KeySet,
    *,
    file_name: str = "file_name",
    also: Column | None = None,
) -> DataFrame:
    """Files whose last-dot extension is among ``extensions``, and those for which ``also`` is true."""
    keys = extensions if isinstance(extensions, KeySet) else key_set(extensions, "extension")
    tagged = files.withColumn("_extension", names.last_dot_extension(F.col(file_name)))
    kept = keep_matching(tagged, keys, "_extension", spread=[file_name], also=also)
    return kept.select(*files.columns)
