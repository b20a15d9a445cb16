"""What the plans must look like for the work to scale."""

import re

import pytest
from conftest import SF
from pyspark.sql import functions as F

import workload
from codequarry.operators import dedup, stats
from codequarry.plans import corpus
from codequarry.sources import archives


def executed(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def final_plan(rows):
    rows.collect()
    return executed(rows).split("Initial Plan")[0]


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_dedup_hash_pass_reads_two_columns_and_shuffles_no_text(spark):
    plan = executed(dedup.content_survivors(documents(spark), id="doc_id"))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    assert "SortAggregate" not in plan
    above = plan[: plan.index("Exchange")]
    assert "text#" not in above


def test_dedup_join_neither_sorts_texts_nor_broadcasts_at_scale(spark, no_broadcast):
    plan = final_plan(dedup.exact_dedup(documents(spark), id="doc_id"))
    assert "ShuffledHashJoin" in plan
    assert "Sort " not in plan and "BroadcastHashJoin" not in plan


def test_dedup_summary_needs_no_expand(spark):
    assert "Expand" not in executed(dedup.dedup_summary(documents(spark)))


def test_stats_expand_only_aggregated_rows(spark):
    rows = documents(spark).select(F.col("source").alias("repo"), "text",
                                   F.col("n_chars").alias("tokens"))
    plan = executed(stats.corpus_stats(rows))
    assert plan.count("Expand") == 1
    assert plan.index("Expand") < plan.rindex("partial_count")
    assert plan.count("FileScan") == 1


def test_token_count_runs_once_even_when_filtered(spark, ranks):
    entries = documents(spark).select(
        F.col("source").alias("repo"), F.col("doc_id").alias("entry_index"),
        F.col("lang").alias("entry_name"), F.col("n_chars").alias("size_in_bytes"),
        F.col("text").cast("binary").alias("content"))
    made = corpus.add_tokens(corpus.assemble_records(entries), ranks)
    assert executed(made).count("ArrowEvalPython") == 1


def test_extraction_filters_between_listing_and_inflating(spark, tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "u-r.zip", "w") as out:
        out.writestr("a.py", "1")
    scanned = archives.scan_archives(archives.list_archives(spark, str(tmp_path)))
    plan = executed(scanned)
    assert re.search(r"MapInArrow inflating.*Filter.*MapInArrow listing", plan, re.S)
    # One exchange: of the listing, before anything is opened.
    assert plan.count("Exchange") == 1
    assert plan.index("Exchange") > plan.index("MapInArrow listing")


def test_unique_extraction_shuffles_no_content(spark, no_broadcast):
    plan = executed(workload.QUERIES["extract_unique"](spark, SF))
    lines = plan.splitlines()
    shuffles = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert len(shuffles) >= 3
    for number in shuffles:
        assert not re.search(r"\b(content|text)#", lines[number + 1])
    assert plan.index("MapInArrow inflating") < plan.index("LeftSemi")


def test_repo_filter_prunes_folders_and_precedes_the_parse(spark, tmp_path):
    from codequarry.sinks.records import write_records

    target = str(tmp_path / "out")
    records = workload.records.valid_records(
        workload.records.parse_record_lines(workload.record_lines(spark, SF)))
    write_records(records.drop("doc_id").withColumn("repo", F.col("file_name")), target)
    keys = spark.createDataFrame([("en",), ("absent",)], "repo_key string")
    rows = corpus.read_corpus(spark, target, keys, layout="repo")
    plan = executed(rows)
    assert plan.count("parseJson") == 1
    # The folders were chosen before the scan, so no row is joined and no other file is in its index.
    assert "Join" not in plan and "FileScan text" in plan
    assert rows.inputFiles() and all("/repo=en/" in file for file in rows.inputFiles())


def test_reconcile_joins_hashes_not_contents(spark, no_broadcast):
    plan = executed(workload.QUERIES["reconcile"](spark, SF))
    for exchange in re.finditer(r"Exchange hashpartitioning.*?\n(.*?)\n", plan):
        assert "html#" not in exchange.group(1).split("Project")[0]
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("name", sorted(workload.QUERIES))
def test_no_cross_joins(spark, name):
    plan = executed(workload.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
