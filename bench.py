"""Time the headline queries; prints one JSON line.

Every query runs once to warm up and once timed, to completion and without collecting.  ``extract``
reads archives that are zipped from the documents before the clock starts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import public_tokenizers  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import workload  # noqa: E402
from codequarry.plans import corpus  # noqa: E402
from codequarry.session import prepare, shared_dir  # noqa: E402
from codequarry.sinks.records import write_records  # noqa: E402

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")

HEADLINES = [
    "exact_dedup",
    "survivor_ids",
    "dedup_summary",
    "corpus_stats",
    "repo_semi_join",
    "language_filter",
    "record_scan",
    "repo_list",
    "safe_paths",
    "archive_entries",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = prepare(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(build) -> None:
        result = build()
        if result is not None:
            result.write.format("noop").mode("overwrite").save()

    zips = workload.stored_zip_dir(spark, sf_dir)
    written = shared_dir(spark, "bench-records")

    def extract():
        repos = workload.archive_repos(spark, sf_dir)
        return corpus.extract(spark, repos, zips, vocabulary=VOCABULARY)

    def extract_unique():
        repos = workload.archive_repos(spark, sf_dir)
        return corpus.extract_unique(spark, repos, zips, vocabulary=VOCABULARY)

    def dedupe():
        repos = workload.archive_repos(spark, sf_dir)
        return corpus.dedupe(spark, repos, written, layout="repo")

    steps = {name: lambda q=workload.QUERIES[name]: q(spark, sf_dir) for name in HEADLINES}
    steps["extract"] = extract
    steps["extract_unique"] = extract_unique
    steps["write_records"] = lambda: write_records(extract(), written)
    steps["dedupe"] = dedupe

    seconds = {}
    for name, build in steps.items():
        run(build)
        start = time.perf_counter()
        run(build)
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    print(json.dumps({
        "metric": "total time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
