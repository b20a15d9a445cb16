"""Session helpers: settings the jobs rely on, package shipping and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_PACKAGE_DIR = os.path.dirname(os.path.abspath(__file__))

# Applied by ``prepare`` only where the session still has Spark's default.
_SETTINGS = {
    # Texts run to 128 KiB each, so Arrow batches of the default 10,000 rows would be too large.
    "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"),
    # Lets AQE turn the sort-merge join of records and survivor ids into a shuffled hash join, which
    # leaves the texts unsorted, when every build partition was measured to be below this size.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": ("0b", "64m"),
    # A task keeps this many partition folders open, so that records are written as they come; only
    # beyond that are its rows, texts included, sorted by folder first.
    "spark.sql.maxConcurrentOutputFileWriters": ("0", "64"),
    # Folders and chosen files are listed by a job.  With a task for each of up to 10,000 paths its time is
    # that of starting tasks, one after another on the driver, whatever the number of cores.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": ("10000", "128"),
}


def prepare(spark: SparkSession) -> SparkSession:
    """Ship this package to the Python workers and apply the settings the jobs rely on."""
    for key, (default, value) in _SETTINGS.items():
        if spark.conf.get(key).lower() == default:
            spark.conf.set(key, value)
    context = spark.sparkContext
    # One archive per application: its name carries the application id.
    name = f"codequarry-{context.applicationId}.zip"
    if not any(path.endswith(name) for path in context.listFiles):
        archive = os.path.join(tempfile.mkdtemp(prefix="codequarry-"), name)
        with zipfile.ZipFile(archive, "w") as out:
            for folder, _, files in os.walk(_PACKAGE_DIR):
                for file in files:
                    if file.endswith(".py"):
                        full = os.path.join(folder, file)
                        out.write(full, os.path.relpath(full, os.path.dirname(_PACKAGE_DIR)))
        context.addPyFile(archive)
    return spark


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder.

    A local session without ``spark.checkpoint.dir`` gets a temporary folder.  On a cluster that would be
    another folder on each machine, so a session without the setting raises there.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        base = tempfile.mkdtemp(prefix="codequarry-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written_once(rows: DataFrame, label: str) -> DataFrame:
    """Narrow rows written to the shared folder and read back, so that nothing is computed again.

    The folder stays, so that a lost executor's part can be read again; remove it with the others of
    the application.
    """
    path = shared_dir(rows.sparkSession, label)
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
