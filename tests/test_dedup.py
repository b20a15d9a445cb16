import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from codequarry.operators import dedup

SCHEMA = "id long, text string, repo string"


def frame(spark, rows, partitions=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions)


def ids(rows):
    return sorted(row.id for row in rows.collect())


def test_one_record_per_text_across_repositories(spark):
    rows = [(1, "a", "r1"), (2, "a", "r2"), (3, "", "r1"), (4, "", "r1"), (5, "a ", "r1"),
            (6, "b", "r2"), (0, "b", "r2")]
    assert ids(dedup.exact_dedup(frame(spark, rows))) == [0, 1, 3, 5]


def test_survivors_carry_the_hash(spark):
    found = dedup.content_survivors(frame(spark, [(2, "a", "r"), (1, "a", "r")])).collect()
    assert [tuple(row) for row in found] == [(hashlib.md5(b"a").hexdigest(), 1)]


def test_order_by_another_column(spark):
    rows = spark.createDataFrame([("x", "t", 9), ("y", "t", 3), ("z", "u", 1)],
                                 "id string, text string, place long")
    kept = dedup.exact_dedup(rows, order_by="place")
    assert sorted(row.id for row in kept.collect()) == ["y", "z"]


def test_every_row_with_a_surviving_id_stays(spark):
    rows = [(1, "a", "r1"), (1, "b", "r2"), (2, "b", "r3"), (3, "c", "r3")]
    kept = dedup.exact_dedup(frame(spark, rows))
    assert sorted((r.id, r.text) for r in kept.collect()) == [(1, "a"), (1, "b"), (3, "c")]


def test_null_texts_are_no_duplicates_of_each_other(spark):
    rows = [(1, None, "r"), (2, None, "r"), (3, "a", "r"), (4, "a", "r")]
    assert ids(dedup.exact_dedup(frame(spark, rows))) == [3]
    assert ids(dedup.exact_dedup(frame(spark, rows), keep_null_text=True)) == [1, 2, 3]


def test_no_rows_in_no_rows_out(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert dedup.exact_dedup(empty).count() == 0
    summary = dedup.dedup_summary(empty).first()
    assert tuple(summary) == (0, 0, 0.0)


def test_hot_text_against_brute_force(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"t{i % 700}", f"r{i % 5}") for i in range(6000)]
    first = {}
    for i, text, _ in rows:
        first.setdefault(text, i)
    made = frame(spark, rows, 8)
    assert ids(dedup.exact_dedup(made)) == sorted(first.values())
    summary = dedup.dedup_summary(made).first()
    assert (summary.loaded, summary.unique) == (6000, len(first))
    assert summary.duplicate_rate == 1 - len(first) / 6000


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(st.sampled_from(["", "a", "A", "a ", "é", "é"]) | st.text(max_size=3),
                      min_size=1, max_size=40), partitions=st.integers(1, 5))
def test_properties(spark, texts, partitions):
    texts = [t.replace("\u0000", "") for t in texts]
    rows = [(i, t, "r") for i, t in enumerate(texts)]
    kept = dedup.exact_dedup(frame(spark, rows, partitions)).collect()
    assert len(kept) == len(set(texts)) == len({row.text for row in kept})
    assert {(row.id, row.text, row.repo) for row in kept} <= set(rows)
    assert sorted(r.id for r in kept) == sorted(texts.index(t) for t in set(texts))
    again = dedup.exact_dedup(spark.createDataFrame(kept, SCHEMA))
    assert again.count() == len(kept)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(st.tuples(st.sampled_from("ab"), st.none() | st.text("ab\u00e9\U0001f642", max_size=10)), max_size=40))
def test_least_strings_against_brute_force(spark, rows):
    made = spark.createDataFrame(rows, "g string, v string").repartition(3)
    least = {}
    for group, value in rows:
        if value is not None:
            least[group] = min(least.get(group, value), value, key=str.encode)
    assert {tuple(r) for r in dedup.least_strings(made, "g", "v").collect()} == set(least.items())
    assert dedup.least_strings(made, "g", "v").count() == len(least)


def test_string_ids_with_one_beginning(spark):
    rows = [(f"record-{i:05}", "hot" if i % 3 else f"t{i}", "r") for i in range(3000, 0, -1)]
    made = spark.createDataFrame(rows, "id string, text string, repo string").repartition(7)
    kept = {r.id for r in dedup.exact_dedup(made).collect()}
    assert kept == {"record-00001", *[f"record-{i:05}" for i in range(3, 3001, 3)]}
    # Equal ids of equal texts survive together, once each in the list of survivors.
    twice = made.unionByName(made)
    assert dedup.content_survivors(twice).count() == len(kept)
    assert dedup.exact_dedup(twice).filter("text = 'hot'").count() == 2


def test_string_ids_need_no_sorted_aggregation(spark):
    made = spark.createDataFrame([("b", "t", "r"), ("a", "t", "r")], "id string, text string, repo string")
    plan = dedup.exact_dedup(made)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
