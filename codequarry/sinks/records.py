"""Record writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codequarry.operators.guards import RowGuard


def write_records(
    records: DataFrame,
    directory: str,
    *,
    cluster: bool = False,
    keep_other_repos: bool = False,
    buckets: int | None = None,
    fmt: str = "json",
    guard: RowGuard | None = None,
) -> None:
    """Write one ``repo=<repo>`` folder of JSON lines, or Parquet files, per repository.

    Extracted records already lie together by archive and are written where they are.  ``cluster``
    first gathers records scattered by a shuffle, such as deduplicated ones; AQE merges small
    repositories and splits a huge one over several tasks and files.  The target is replaced, or with
    ``keep_other_repos`` only the folders of repositories that have records.  For millions of
    repositories ``buckets`` writes that many ``repo_bucket`` folders with ``repo`` as a field.
    ``guard``, which watches the records, is checked once they are written.
    """
    partition = "repo"
    if buckets is not None:
        partition = "repo_bucket"
        bucket = F.pmod(F.xxhash64("repo"), F.lit(buckets)).cast("int")
        records = records.withColumn(partition, bucket)
    if cluster:
        records = records.hint("rebalance", F.col(partition))
    overwrite = "dynamic" if keep_other_repos else "static"
    writer = records.write.mode("overwrite").option("partitionOverwriteMode", overwrite)
    writer.partitionBy(partition).format(fmt).save(directory)
    if guard:
        guard.check()
