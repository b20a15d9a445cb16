"""Opt-in checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class EmptyInputError(ValueError):
    """A step that needs at least one row got none."""


def require_non_empty(rows: DataFrame, label: str) -> DataFrame:
    """Return ``rows``, or raise when it has none.  Runs a job, unlike the lazy operators."""
    if rows.isEmpty():
        raise EmptyInputError(f"{label}: no rows")
    return rows


class RowGuard:
    """Raises when a job came to no rows, without a job of its own.

    ``watch`` counts the rows as they pass through the job that uses them, ``check``, after that
    job, raises if there were none.  One guard watches one DataFrame.
    """

    def __init__(self, label: str):
        self.label, self._observation = label, Observation()

    def watch(self, rows: DataFrame) -> DataFrame:
        return rows.observe(self._observation, F.count(F.lit(1)).alias("rows"))

    def check(self) -> None:
        if not self._observation.get.get("rows"):
            raise EmptyInputError(f"{self.label}: no rows")
