"""Corpus statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def records_per_repo(records: DataFrame) -> DataFrame:
    """Number of records of each repository."""
    return records.groupBy("repo").agg(F.count("*").alias("records"))


def total_records(records: DataFrame) -> DataFrame:
    """One row with the number of records."""
    return records.agg(F.count("*").alias("records"))


def corpus_stats(
    records: DataFrame,
    *,
    text: str = "text",
    tokens: str = "tokens",
    files: DataFrame | None = None,
) -> DataFrame:
    """One row per repository and a total row (``repo`` NULL).

    Columns: ``files``, ``records``, ``tokens``, ``avg_records_per_file`` (integer quotient) and
    ``avg_chars``.  ``files`` is an optional listing with a ``repo`` column, which adds repositories
    without records.  Records are aggregated once per repository before the total is formed, so the
    rollup works on that small table.
    """
    per_repo = records.groupBy("repo").agg(
        F.count("*").alias("records"),
        F.coalesce(F.sum(tokens), F.lit(0)).alias("tokens"),
        F.coalesce(F.sum(F.char_length(text)), F.lit(0)).alias("chars"),
        F.count(text).alias("texts"),
    )
    if files is not None:
        names = files.select("repo").distinct()
        empty = names.select("repo", *[F.lit(0).cast("long").alias(c) for c in per_repo.columns[1:]])
        per_repo = per_repo.union(empty).groupBy("repo").agg(
            *[F.sum(c).alias(c) for c in per_repo.columns[1:]]
        )
    totals = per_repo.groupingSets([["repo"], []], "repo").agg(
        F.count("*").alias("files"),
        *[_total(c).alias(c) for c in per_repo.columns[1:]],
    )
    return totals.select(
        "repo",
        "files",
        "records",
        "tokens",
        F.when(F.col("files") > 0, F.floor(F.col("records") / F.col("files")))
        .cast("long")
        .alias("avg_records_per_file"),
        F.when(F.col("texts") > 0, F.col("chars") / F.col("texts")).alias("avg_chars"),
    )


def _total(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0))
