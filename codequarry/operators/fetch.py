"""Fetch planning and bookkeeping as tables; nothing here touches a network."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codequarry.functions import names
from codequarry.schemas import BRANCHES


def branch_candidates(repos: DataFrame) -> DataFrame:
    """One row per repository and branch to try, in order of ``priority``."""
    branches = F.array(
        *[
            F.struct(F.lit(rank).alias("priority"), F.lit(branch).alias("branch"))
            for rank, branch in enumerate(BRANCHES, start=1)
        ]
    )
    return repos.select("*", F.inline(branches))


def pending_repos(repos: DataFrame, archives: DataFrame) -> DataFrame:
    """Distinct listed repositories without a stored archive of their name."""
    stored = archives.select(F.col("stem").alias("repo_key"))
    distinct = repos.select("user", "name", "repo_key").distinct()
    return distinct.join(stored, "repo_key", "left_anti")


def fetch_plan(repos: DataFrame, archives: DataFrame, directory: str) -> DataFrame:
    """What to fetch: (repo_key, priority, branch, url, target)."""
    return branch_candidates(pending_repos(repos, archives)).select(
        "repo_key",
        "priority",
        "branch",
        names.archive_url(F.col("user"), F.col("name"), F.col("branch")).alias("url"),
        names.archive_target(directory, F.col("user"), F.col("name")).alias("target"),
    )


def first_success(results: DataFrame) -> DataFrame:
    """The branch that served each repository, as (user, name, branch): the one of least priority.

    ``results`` has user, name, priority, branch and succeeded; a repository whose every branch failed
    has no row.
    """
    served = results.filter("succeeded").groupBy("user", "name")
    return served.agg(F.min_by("branch", F.struct("priority", "branch")).alias("branch"))


def reconcile_archives(fetched: DataFrame, stored: DataFrame) -> DataFrame:
    """Compare fetched with stored (path, content): ``new``, ``changed`` or ``unchanged``.

    Contents are hashed where they are read; only paths and hashes are joined.
    """
    new = fetched.select("path", F.sha2("content", 256).alias("_fetched"))
    old = stored.select("path", F.sha2("content", 256).alias("_stored"))
    status = (
        F.when(F.col("_stored").isNull(), "new")
        .when(F.col("_stored") == F.col("_fetched"), "unchanged")
        .otherwise("changed")
    )
    return new.join(old, "path", "left").select("path", status.alias("status"))
